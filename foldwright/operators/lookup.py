"""Left joins of fitted tables back to rows.

The fitted side is broadcast only when its measured size allows it. A larger
one goes through a shuffle join; keys that hold a large share of the rows
are known from the fit (``weight``) and are joined by a broadcast of those
few rows, while the rows that carry them are spread over salts so that no
single task receives a whole hot key. Keys that are hot in the joined rows
alone are found by a sketch of those rows (:func:`heavy_keys`), read before
the join is planned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..workspace import materialise

TABLE_BYTES = 64 << 20      # one broadcast table
TOTAL_BYTES = 256 << 20     # all broadcast tables of one transform
HOT_FRACTION = 1e-3         # a key with this share of the fitted rows is hot
HOT_ROWS = 100              # a key of fewer rows burdens no task
SKETCHED = 10_000           # keys that a sketch of rows follows: off by 0.02 % of the rows, a fifth of HOT_FRACTION
FILTER_BITS = 1 << 26       # of a filter for rows that match nothing: a million words, about 32 MB as a broadcast
BITS_PER_ENTRY = 16
SALTS = 1024
FILES = 64                  # of one feature in a stored table
CHAIN = 6                   # joins between two row counts

INTERNAL = "__k"
NUMBER = "__number"         # of a row, in the one stored copy that is joined back
ROW_ID = "row_id"

_names = count()


@dataclass(frozen=True)
class TableSize:
    """Measured size of a fitted table and the number of rows it was fitted on."""

    rows: int
    bytes: int
    weight: int = 0


def row_bytes(table: DataFrame) -> Column:
    """Upper estimate of a row's bytes in a broadcast hash table."""
    parts = [F.lit(32 + 16 * len(table.columns)).cast("long")]
    for f in table.schema:
        if f.dataType.typeName() == "string":
            parts.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif f.dataType.typeName() == "array":
            parts.append(F.coalesce(F.size(f.name) * 8 + 16, F.lit(0)))
        elif f.dataType.typeName() == "map":  # of arrays of numbers
            entry = F.size(F.element_at(F.map_values(f.name), 1)) * 8 + 48
            parts.append(F.coalesce(F.size(f.name) * entry, F.lit(0)))
    return reduce(add, parts)


def size_columns(table: DataFrame, weight: str | None = None) -> list[Column]:
    """Aggregates that :func:`size_of` reads."""
    total = F.sum(weight).cast("long") if weight else F.lit(0)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(table)), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce(total, F.lit(0)).alias("weight"),
    ]


def size_of(row) -> TableSize:
    return TableSize(row["rows"], row["bytes"], row["weight"])


def store(df: DataFrame, name: str, weight: str | None = None) -> tuple[DataFrame, TableSize]:
    """Write ``df`` to the shared folder; its size is counted by the writing job."""
    seen = Observation(name)
    table = materialise(df.observe(seen, *size_columns(df, weight)), name)
    return table, size_of(seen.get)


def store_by(df: DataFrame, name: str, key: str, weight: str) -> tuple[DataFrame, dict[str, TableSize]]:
    """Write ``df`` partitioned by ``key`` (feature names), with the size per value.

    The rows of a feature go to at most ``FILES`` tasks first, so it has no more
    files than that, however many tasks made the rows.
    """
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.lit(FILES))
    table = materialise(df.repartition(F.col(key), spread), name, (key,))
    return table, measure_by(table, key, weight)


def measure_by(table: DataFrame, key: str, weight: str) -> dict[str, TableSize]:
    """Size per value of ``key`` of a stored table: one row per feature."""
    return {r[key]: size_of(r) for r in table.groupBy(key).agg(*size_columns(table, weight)).collect()}


def broadcastable(
    sizes: Mapping[str, TableSize], table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
) -> set[str]:
    """Names that may be broadcast together: smallest first, within both limits."""
    chosen, used = set(), 0
    for name, size in sorted(sizes.items(), key=lambda kv: (kv[1].bytes, kv[0])):
        if size.bytes > table_bytes or used + size.bytes > total_bytes:
            break
        chosen.add(name)
        used += size.bytes
    return chosen


def counted(df: DataFrame) -> DataFrame:
    """Count the rows here, as a metric of the running job.

    Every join must hand on the rows it got, so the counts of one job agree.
    The count also ends a stage of generated code: a long chain of joins would
    otherwise become one method too large for the JVM to compile.
    """
    return df.observe(f"rows_{next(_names)}", F.count(F.lit(1)).alias("rows"))


def attach_all(
    df: DataFrame,
    categories: Mapping[str, Column],
    keep: Sequence[str],
    table: DataFrame,
    names: Mapping[str, str],
    value: Callable[[Column], Column],
    sizes: Sequence[TableSize],
) -> DataFrame:
    """Left-join the entries of many features at once, whatever the number of features.

    ``categories`` gives each feature of ``names`` (feature to output column) as text; ``keep``
    are columns of ``df`` that ``value`` reads; ``sizes`` are those of the features in ``table``. One join finds the entries (``table``:
    feature, category, n, value), one aggregate brings those of a row together,
    and only the last join moves whole rows. The rows are numbered and stored first: they come out as they went
    in whether or not a column of theirs tells them apart, and neither branch makes them again. Categories that
    the table surely lacks are left out before the first shuffle.
    """
    weight, entries_number = sum(s.weight for s in sizes), sum(s.rows for s in sizes)
    rows = materialise(df.withColumn(NUMBER, F.monotonically_increasing_id()), "numbered")
    own = rows.select(NUMBER, *[F.col(f"`{k}`") for k in keep], *[c.alias(f"__f{i}") for i, c in enumerate(categories.values())])
    # a feature's name may be that of another column, so the features go by place
    entries = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"__f{i}").alias("category")) for i, f in enumerate(categories)]))
    long = own.select(NUMBER, *[F.col(f"`{k}`") for k in keep], entries.alias("__e")).select(
        NUMBER, *[F.col(f"`{k}`") for k in keep], F.col("__e.feature").alias("feature"), F.col("__e.category").alias("category")
    )
    keys = [(F.col("category"), "category"), (F.col("feature"), "feature")]
    found = attach(
        may_match(long, table, keys, entries_number),
        table,
        keys,
        {"__entry": "value"},
        null_safe=True,
        small=False,
        weight="n",
        total_weight=weight,
        heavy=heavy_keys(long, [expr for expr, _ in keys]),
    )
    entry = value(F.col("__entry"))
    made = [F.first(F.when(F.col("feature") == f, entry), ignorenulls=True).alias(out) for f, out in names.items()]
    return rows.join(found.groupBy(NUMBER).agg(*made), NUMBER, "left").select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{o}`") for o in names.values()])


def key_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*[c.cast("string") for c in columns])


def _bucket(columns: Sequence[Column]) -> Column:
    return F.pmod(key_hash(columns), F.lit(SALTS))


def heavy_keys(df: DataFrame, keys: Sequence[Column]) -> tuple[int, ...]:
    """Hashes of the keys that hold at least ``HOT_FRACTION`` of the rows of ``df``, and ``HOT_ROWS``, in no order.

    One pass over the key columns makes a frequent-items sketch of bounded size. Its counts are
    never too low, so a few keys just below the share may be among them. At most 1 / HOT_FRACTION come to the driver.
    """
    top = F.expr(f"approx_top_k(__h, {round(1 / HOT_FRACTION)}, {SKETCHED})")
    told = df.select(key_hash(keys).alias("__h")).agg(top.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    least = max(HOT_ROWS, told["rows"] * HOT_FRACTION)
    return tuple(i["item"] for i in told["top"] or () if i["count"] >= least)


def may_match(df: DataFrame, table: DataFrame, keys: Sequence[tuple[Column, str]], entries: int) -> DataFrame:
    """The rows of ``df`` whose keys may be in ``table`` (of about ``entries`` rows); those left out are surely not.

    The hashes of the table's keys are bits in words of 64, broadcast. There are 16 bits for each
    entry, so about one in 16 foreign keys stays; above ``FILTER_BITS`` the share grows with the table.
    """
    bits = min(FILTER_BITS, max(64, BITS_PER_ENTRY * entries))

    def place(columns: Sequence[Column]) -> Column:
        return F.pmod(key_hash(columns), F.lit(bits))

    places = table.select(place([F.col(c) for _, c in keys]).alias("__place"))
    words = places.groupBy(F.shiftright("__place", 6).alias("__word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(__place & 63 AS INT)))").alias("__bits")
    )
    probed = df.withColumn("__place", place([expr for expr, _ in keys]))
    found = probed.join(F.broadcast(words), F.shiftright("__place", 6) == F.col("__word"))
    return found.filter("(shiftrightunsigned(__bits, CAST(__place & 63 AS INT)) & 1L) = 1L").select(*[F.col(f"`{c}`") for c in df.columns])


def visible(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith(INTERNAL)]


def _matches(left: Sequence[Column], right: Sequence[str], null_safe: bool) -> Column:
    pairs = zip(left, right)
    if null_safe:
        return reduce(and_, [a.eqNullSafe(F.col(b)) for a, b in pairs])
    return reduce(and_, [a == F.col(b) for a, b in pairs])


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[tuple[Column, str]],
    values: Mapping[str, str],
    *,
    null_safe: bool,
    small: bool,
    weight: str | None = None,
    total_weight: int = 0,
    few_null_rows: bool = True,
    heavy: Sequence[int] = (),
) -> DataFrame:
    """Left-join ``table`` to ``df``; every row of ``df`` comes out once.

    ``keys`` pairs an expression over ``df`` with a key column of ``table``
    (unique over those keys). ``values`` maps output name to table column. The
    key columns of a broadcast table stay, under internal names: callers end
    with a projection anyway, and one for many joins is analysed once.
    ``few_null_rows`` says that only a few rows of ``table`` (one per fold at
    most) have a null first key; then they are broadcast like hot keys.
    ``heavy`` are the :func:`heavy_keys` of ``df``: their rows of ``table`` are
    broadcast too, and rows of ``df`` that carry them go to no key's bucket, even if they match nothing.
    """
    tag = f"{INTERNAL}{next(_names)}"
    key_names = [f"{tag}_{i}" for i in range(len(keys))]
    outputs = list(values)
    right = table.select(
        *[F.col(c).alias(n) for n, (_, c) in zip(key_names, keys)],
        *[F.col(c).alias(out) for out, c in values.items()],
        *([F.col(weight).alias(f"{tag}_w")] if weight and not small else []),
    )
    left = [expr for expr, _ in keys]
    if small:
        return df.join(F.broadcast(right), _matches(left, key_names, null_safe), "left")

    limit = max(1.0, total_weight * HOT_FRACTION)
    is_hot = F.coalesce(F.col(f"{tag}_w") >= limit, F.lit(False)) if weight else F.lit(False)
    if not null_safe:
        dead = reduce(or_, [k.isNull() for k in left])
    elif few_null_rows:
        is_hot, dead = is_hot | F.col(key_names[0]).isNull(), left[0].isNull()
    else:
        dead = F.lit(False)
    if heavy:
        is_hot, dead = is_hot | key_hash([F.col(n) for n in key_names]).isin(*heavy), dead | key_hash(left).isin(*heavy)
    packed, cold_packed, salt = f"{tag}_hot", f"{tag}_cold", f"{tag}_salt"
    # at most 1 / HOT_FRACTION rows can be hot by the fit, as many by the new rows, and the few with a null key
    hot = right.filter(is_hot).select(*key_names, F.struct(*outputs).alias(packed))
    cold = right.filter(~is_hot).select(
        *key_names, F.struct(*outputs).alias(cold_packed), _bucket([F.col(n) for n in key_names]).alias(f"{salt}_r")
    )
    # a salt of its key joins a row; salts beyond those match nothing and spread by the row's content
    identity = [NUMBER, *visible(df)] if NUMBER in df.columns else [ROW_ID] if ROW_ID in df.columns else visible(df)
    spread = SALTS + _bucket([F.col(f"`{c}`") for c in identity])
    # hot rows are answered already, dead ones match nothing: neither needs its key's partition
    step = df.join(F.broadcast(hot), _matches(left, key_names, null_safe), "left").drop(*key_names)
    step = step.withColumn(salt, F.when(F.col(packed).isNull() & ~dead, _bucket(left)).otherwise(spread))
    step = step.join(
        cold,
        _matches(left, key_names, null_safe) & (F.col(salt) == F.col(f"{salt}_r")),
        "left",
    )
    merged = F.coalesce(F.col(packed), F.col(cold_packed))
    return step.select(*[F.col(f"`{c}`") for c in df.columns], *[merged[o].alias(o) for o in outputs])
