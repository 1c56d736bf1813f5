"""Encoders, interaction keys and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.functions.text import interaction_key
from foldwright.operators.encoders import CountEncoder, OneHotEncoder, OrdinalEncoder
from foldwright.operators.folds import expand_folds, hash_fold, row_kfold
from foldwright.operators.target_encoding import TargetEncoder, TargetState
from foldwright.streaming.apply import apply_available
from foldwright.streaming.fit import fit_available
from foldwright.workspace import fresh_path, materialise

from .base import BASE_CTE, FOLDED_CTE, FOLDS, ORDERS_CTE, SEED, base, fit_folds, folded, folds_cte, orders_base, train
from .registry import query, table


def count_cte(column: str) -> str:
    return f"n_{column} AS (SELECT {column} AS k, count(*) AS n FROM base WHERE split = 'train' GROUP BY {column})"


def count_join(column: str) -> str:
    return f"LEFT JOIN n_{column} ON base.{column} IS NOT DISTINCT FROM n_{column}.k"


def ordinal_cte(column: str) -> str:
    return (
        f"o_{column} AS (SELECT {column} AS k, row_number() OVER (ORDER BY min(row_id)) AS code "
        f"FROM base WHERE split = 'train' GROUP BY {column})"
    )


@query(
    "ordinal_encode",
    f"""WITH {ORDERS_CTE}, {ordinal_cte('cat_null')}, {ordinal_cte('cat_unseen')}
    SELECT row_id, CAST(COALESCE(a.code, CASE WHEN cat_null IS NULL THEN -2 ELSE -1 END) AS BIGINT) AS "cat_null_OE",
           CAST(COALESCE(b.code, CASE WHEN cat_unseen IS NULL THEN -2 ELSE -1 END) AS BIGINT) AS "cat_unseen_OE"
    FROM base LEFT JOIN o_cat_null a ON cat_null IS NOT DISTINCT FROM a.k
    LEFT JOIN o_cat_unseen b ON cat_unseen IS NOT DISTINCT FROM b.k""",
)
def ordinal_encode(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    fitted = OrdinalEncoder(["cat_null", "cat_unseen"]).fit(train(df))
    return fitted.transform(df).select("row_id", "cat_null_OE", "cat_unseen_OE")


@query(
    "ordinal_encode_high_cardinality",
    f"""WITH {ORDERS_CTE}, {ordinal_cte('grp')}
    SELECT row_id, CAST(COALESCE(code, -1) AS BIGINT) AS "grp_OE"
    FROM base LEFT JOIN o_grp ON grp = k""",
)
def ordinal_encode_high_cardinality(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    return OrdinalEncoder(["grp"]).fit(train(df)).transform(df).select("row_id", "grp_OE")


@query(
    "count_encode",
    f"""WITH {ORDERS_CTE}, {count_cte('cat_null')}, {count_cte('cat_unseen')}
    SELECT row_id, CAST(COALESCE(n_cat_null.n, -1) AS BIGINT) AS "cat_null_CE",
           CAST(COALESCE(n_cat_unseen.n, -1) AS BIGINT) AS "cat_unseen_CE"
    FROM base {count_join('cat_null')} {count_join('cat_unseen')}""",
)
def count_encode(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    fitted = CountEncoder(["cat_null", "cat_unseen"]).fit(train(df))
    return fitted.transform(df).select("row_id", "cat_null_CE", "cat_unseen_CE")


_MULTI = ["cat_null", "cat_unseen", "seg", "nat", "grp"]


@query(
    "count_encode_multi",
    f"""WITH {BASE_CTE}, {', '.join(count_cte(c) for c in _MULTI)}
    SELECT row_id, {', '.join(f'CAST(COALESCE(n_{c}.n, -1) AS BIGINT) AS "{c}_CE"' for c in _MULTI)}
    FROM base {' '.join(count_join(c) for c in _MULTI)}""",
)
def count_encode_multi(spark, sf_dir):
    df = base(spark, sf_dir)
    return CountEncoder(_MULTI).fit(train(df)).transform(df).select("row_id", *[f"{c}_CE" for c in _MULTI])


@query(
    "count_encode_numeric_passthrough",
    f"""WITH {BASE_CTE}, {count_cte('seg')}
    SELECT row_id, CAST(COALESCE(n_seg.n, -1) AS BIGINT) AS "seg_CE", CAST(nat AS INTEGER) AS "nat_CE"
    FROM base {count_join('seg')}""",
)
def count_encode_numeric_passthrough(spark, sf_dir):
    df = base(spark, sf_dir)
    fitted = CountEncoder(["seg", "nat"], numeric="passthrough").fit(train(df))
    return fitted.transform(df).select("row_id", "seg_CE", "nat_CE")


@query(
    "count_encode_shuffled",
    f"""WITH {BASE_CTE}, {', '.join(count_cte(c) for c in _MULTI)}
    SELECT row_id, {', '.join(f'CAST(COALESCE(n_{c}.n, -1) AS BIGINT) AS "{c}_CE"' for c in _MULTI)}
    FROM base {' '.join(count_join(c) for c in _MULTI)}""",
)
def count_encode_shuffled(spark, sf_dir):
    """No table is broadcast whole: one narrow join for all columns."""
    df = base(spark, sf_dir)
    made = CountEncoder(_MULTI).fit(train(df)).transform(df, table_bytes=0)
    return made.select("row_id", *[f"{c}_CE" for c in _MULTI])


@query(
    "ordinal_encode_ranged",
    f"""WITH {ORDERS_CTE}, {ordinal_cte('grp')}, {ordinal_cte('cat_null')}
    SELECT row_id, CAST(COALESCE(a.code, -1) AS BIGINT) AS "grp_OE",
    CAST(COALESCE(b.code, CASE WHEN cat_null IS NULL THEN -2 ELSE -1 END) AS BIGINT) AS "cat_null_OE"
    FROM base LEFT JOIN o_grp a ON grp = a.k LEFT JOIN o_cat_null b ON cat_null IS NOT DISTINCT FROM b.k""",
)
def ordinal_encode_ranged(spark, sf_dir):
    """Codes from running totals over ranges of a few hundred categories, applied by shuffle."""
    df = orders_base(spark, sf_dir)
    fitted = OrdinalEncoder(["grp", "cat_null"], rows_per_task=200).fit(train(df))
    return fitted.transform(df, table_bytes=0).select("row_id", "grp_OE", "cat_null_OE")


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


@query(
    "onehot_encode",
    f"""WITH {ORDERS_CTE}
    SELECT row_id, CASE WHEN cat_null IS NULL THEN 1 ELSE 0 END AS "cat_null_nan_OHE",
    {', '.join(f"CASE WHEN cat_null = '{p}' THEN 1 ELSE 0 END AS " + f'"cat_null_{p}_OHE"' for p in _PRIORITIES)},
    {', '.join(f"CASE WHEN cat_unseen = '{s}' THEN 1 ELSE 0 END AS " + f'"cat_unseen_{s}_OHE"' for s in 'FOP')}
    FROM base""",
)
def onehot_encode(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    made = OneHotEncoder(["cat_null", "cat_unseen"]).fit(train(df)).transform(df)
    return made.select("row_id", *[c for c in made.columns if c.endswith("_OHE")])


@query(
    "onehot_vectors_wide",
    f"""WITH {ORDERS_CTE}, {ordinal_cte('grp')} SELECT row_id, CAST(code - 1 AS INTEGER) AS place, CAST(CASE WHEN code IS NOT NULL THEN 1 END AS DOUBLE) AS value
    FROM base LEFT JOIN o_grp ON grp = k""",
)
def onehot_vectors_wide(spark, sf_dir):
    """A category per customer, as sparse vectors: the place and value of the one entry, null for an unknown customer."""
    df = orders_base(spark, sf_dir)
    made = OneHotEncoder(["grp"], form="vectors").fit(train(df)).transform(df)
    entry = F.from_json(F.to_json(F.struct(F.col("grp_OHE").alias("v"))), "v struct<indices: array<int>, values: array<double>>")["v"]
    return made.select("row_id", F.get(entry["indices"], 0).alias("place"), F.get(entry["values"], 0).alias("value"))


# direct means over the other folds: another way than the one under test
def te_sql(keys: dict[str, str], targets: list[str], split: str, unseen: str = "prior", cte: str = BASE_CTE) -> str:
    mean = "CAST(sum({0}) AS DOUBLE) / CAST(count({0}) AS DOUBLE)"
    ctes, joins, cols = [], [], []
    if split == "train":
        rounds = "SELECT DISTINCT fold AS f FROM folded WHERE fold IS NOT NULL"
        source = f"FROM folded JOIN ({rounds}) r ON folded.fold <> r.f"
        on = " AND r.fold = {0}.f"
    else:
        source, on = "FROM (SELECT *, -1 AS f FROM folded WHERE fold IS NOT NULL) folded", ""
    ctes.append(f"prior AS (SELECT f, {', '.join(f'{mean.format(t)} AS {t}' for t in targets)} {source} GROUP BY f)")
    for name, key in keys.items():
        ctes.append(
            f"te_{name} AS (SELECT f, {key} AS k, {', '.join(f'{mean.format(t)} AS {t}' for t in targets)} "
            f"{source} GROUP BY f, {key})"
        )
        joins.append(f"LEFT JOIN te_{name} ON {key} IS NOT DISTINCT FROM te_{name}.k{on.format('te_' + name)}")
        for t in targets:
            value = f"te_{name}.{t}" if unseen == "null" else f"COALESCE(te_{name}.{t}, prior.{t})"
            cols.append(f'{value} AS "{name}_TE_{t}"')
    prior_on = "r.fold = prior.f" if split == "train" else "prior.f = -1"
    return (
        f"WITH {cte}, {FOLDED_CTE}, {', '.join(ctes)} SELECT r.row_id, {', '.join(cols)} "
        f"FROM (SELECT * FROM folded WHERE split = '{split}') r LEFT JOIN prior ON {prior_on} {' '.join(joins)}"
    )


_CATS = ["cat_null", "cat_unseen", "seg"]


def _target_encoded(spark, sf_dir, split, **options):
    df = folded(base(spark, sf_dir))
    fitted = TargetEncoder(_CATS, ["y1", "y2"], **options).fit(train(df))
    made = fitted.transform(df.filter(F.col("split") == split))
    return made.select("row_id", *[c for c in made.columns if "_TE_" in c])


@query("target_encode_oof", te_sql({c: c for c in _CATS}, ["y1", "y2"], "train"))
def target_encode_oof(spark, sf_dir):
    return _target_encoded(spark, sf_dir, "train")


@query("target_encode_test", te_sql({c: c for c in _CATS}, ["y1", "y2"], "test"))
def target_encode_test(spark, sf_dir):
    return _target_encoded(spark, sf_dir, "test")


@query("target_encode_unseen", te_sql({c: c for c in _CATS}, ["y1", "y2"], "test", "null"))
def target_encode_unseen(spark, sf_dir):
    return _target_encoded(spark, sf_dir, "test", unseen="null")


@query("target_encode_shuffled", te_sql({c: c for c in _CATS}, ["y1", "y2"], "train"))
def target_encode_shuffled(spark, sf_dir):
    """No table is broadcast whole: one narrow join for all columns."""
    df = train(folded(base(spark, sf_dir)))
    made = TargetEncoder(_CATS, ["y1", "y2"]).fit(df).transform(df, table_bytes=0)
    return made.select("row_id", *[c for c in made.columns if "_TE_" in c])


@query("target_encode_merged", te_sql({c: c for c in _CATS}, ["y1", "y2"], "train"))
def target_encode_merged(spark, sf_dir):
    """Three parts of the rows, each summed up by itself; the merged state encodes as one fit on all."""
    df = train(folded(base(spark, sf_dir)))
    encoder = TargetEncoder(_CATS, ["y1", "y2"])
    first, *others = (encoder.state(df.filter(F.col("row_id") % 3 == part)) for part in range(3))
    made = first.merge(*others).fitted().transform(df)
    return made.select("row_id", *[c for c in made.columns if "_TE_" in c])


@query(
    "ordinal_encode_merged",
    f"""WITH {ORDERS_CTE}, {ordinal_cte('grp')}, {ordinal_cte('cat_null')}, {count_cte('grp')}, {count_cte('cat_null')}
    SELECT row_id, CAST(COALESCE(a.code, -1) AS BIGINT) AS "grp_OE",
    CAST(COALESCE(b.code, CASE WHEN cat_null IS NULL THEN -2 ELSE -1 END) AS BIGINT) AS "cat_null_OE",
    CAST(COALESCE(n_grp.n, -1) AS BIGINT) AS "grp_CE", CAST(COALESCE(n_cat_null.n, -1) AS BIGINT) AS "cat_null_CE"
    FROM base LEFT JOIN o_grp a ON grp = a.k LEFT JOIN o_cat_null b ON cat_null IS NOT DISTINCT FROM b.k
    {count_join('grp')} {count_join('cat_null')}""",
)
def ordinal_encode_merged(spark, sf_dir):
    """Codes and counts of two parts of the rows, brought together."""
    df = orders_base(spark, sf_dir)
    parts = [train(df).filter(F.col("row_id") % 2 == part) for part in range(2)]
    for encoder in (OrdinalEncoder(["grp", "cat_null"]), CountEncoder(["grp", "cat_null"])):
        first, second = (encoder.fit(part) for part in parts)
        df = first.merge(second).transform(df)
    return df.select("row_id", "grp_OE", "cat_null_OE", "grp_CE", "cat_null_CE")


@query("stream_fit_encoder", te_sql({c: c for c in _CATS}, ["y1", "y2"], "train"))
def stream_fit_encoder(spark, sf_dir):
    """A target encoder fitted on a stream of several batches, applied to all rows."""
    df = materialise(train(folded(base(spark, sf_dir))).repartition(4), "arriving")
    path, encoder = fresh_path(spark, "stream-fit"), TargetEncoder(_CATS, ["y1", "y2"])
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(df.inputFiles()[0].rsplit("/", 1)[0])
    made = fit_available(stream, encoder.state, TargetState, path).fitted().transform(df)
    return made.select("row_id", *[c for c in made.columns if "_TE_" in c])


@query(
    "target_encode_new_rows",
    f"""WITH {BASE_CTE}, {FOLDED_CTE}, fitted AS (SELECT * FROM folded WHERE split = 'train' AND NOT (fold = 0 AND seg = 'BUILDING')),
    means AS (SELECT r.f, seg, avg(y1) AS m FROM fitted JOIN (SELECT unnest(range({FOLDS})) AS f) r ON fold <> r.f GROUP BY r.f, seg)
    SELECT row_id, round(m, 4) AS "seg_TE_y1" FROM folded JOIN means ON fold = f AND folded.seg = means.seg WHERE split = 'train'""",
)
def target_encode_new_rows(spark, sf_dir):
    """Rows outside the fit, with a category that the fit has in other folds only."""
    df = train(folded(base(spark, sf_dir)))
    fitted = TargetEncoder(["seg"], ["y1"]).fit(df.filter("NOT (fold = 0 AND seg = 'BUILDING')"))
    return fitted.transform(df).select("row_id", F.round("seg_TE_y1", 4).alias("seg_TE_y1"))


@query("target_encode_group_key", te_sql({"grp": "grp"}, ["y1"], "train", cte=ORDERS_CTE))
def target_encode_group_key(spark, sf_dir):
    """Every group lies in one fold, so each encoding is the prior of its fold."""
    df = folded(orders_base(spark, sf_dir))
    return TargetEncoder(["grp"], ["y1"]).fit(train(df)).transform(train(df)).select("row_id", "grp_TE_y1")


_INNER = 3
_INNER_SQL = f"CAST(('0x' || substr(md5('42|' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) % {_INNER}"


@query(
    "target_encode_inner_folds",
    f"""WITH {ORDERS_CTE}, {FOLDED_CTE},
    t AS (SELECT cat_null, y1, fold, {_INNER_SQL} AS i FROM folded WHERE split = 'train'),
    rounds AS (SELECT r.f, q.j, cat_null, CAST(sum(y1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS m
               FROM t JOIN (SELECT DISTINCT fold AS f FROM t) r ON t.fold <> r.f
               JOIN (SELECT DISTINCT i AS j FROM t) q ON t.i <> q.j GROUP BY r.f, q.j, cat_null),
    e AS (SELECT f, cat_null, avg(m) AS m FROM rounds GROUP BY f, cat_null)
    SELECT row_id, round(m, 4) AS "cat_null_TE_y1" FROM (SELECT * FROM folded WHERE split = 'train') r
    LEFT JOIN e ON r.fold = e.f AND r.cat_null IS NOT DISTINCT FROM e.cat_null""",
)
def target_encode_inner_folds(spark, sf_dir):
    df = train(folded(orders_base(spark, sf_dir)))
    made = TargetEncoder(["cat_null"], ["y1"], inner_folds=_INNER).fit(df).transform(df)
    return made.select("row_id", F.round("cat_null_TE_y1", 4).alias("cat_null_TE_y1"))


_PAIR = "concat_ws('_', COALESCE(seg, 'nan'), COALESCE(cat_null, 'nan'))"
_TRIPLE = "concat_ws('_', COALESCE(seg, 'nan'), COALESCE(cat_null, 'nan'), COALESCE(CAST(nat AS VARCHAR), 'nan'))"


@query(
    "interaction_key",
    f"""WITH {BASE_CTE} SELECT row_id, {_PAIR} AS grouping_seg_and_cat_null,
    {_TRIPLE} AS grouping_seg_and_cat_null_and_nat FROM base""",
)
def interaction_keys(spark, sf_dir):
    return base(spark, sf_dir).select(
        "row_id",
        interaction_key("seg", "cat_null").alias("grouping_seg_and_cat_null"),
        interaction_key("seg", "cat_null", "nat").alias("grouping_seg_and_cat_null_and_nat"),
    )


@query(
    "target_encode_interaction",
    te_sql({"grouping_seg_and_cat_null": _PAIR, "grouping_seg_and_cat_null_and_nat": _TRIPLE}, ["y1"], "train"),
)
def target_encode_interaction(spark, sf_dir):
    df = folded(base(spark, sf_dir))
    pairs = [("seg", "cat_null"), ("seg", "cat_null", "nat")]
    made = TargetEncoder([], ["y1"], pairs).fit(train(df)).transform(train(df))
    return made.select("row_id", *[c for c in made.columns if "_TE_" in c])


@query(
    "group_kfold",
    f"WITH {ORDERS_CTE}, {folds_cte()} SELECT row_id, folds.fold FROM base JOIN folds USING (grp) WHERE split = 'train'",
)
def group_folds(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    return fit_folds(df).transform(train(df)).select("row_id", "fold")


@query(
    "group_kfold_sizes",
    f"""WITH {ORDERS_CTE}, {folds_cte()} SELECT fold, count(DISTINCT grp) AS n_groups, count(*) AS n_rows
    FROM base JOIN folds USING (grp) WHERE split = 'train' GROUP BY fold""",
)
def group_fold_sizes(spark, sf_dir):
    groups = fit_folds(orders_base(spark, sf_dir)).table
    return groups.groupBy("fold").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_rows"))


@query(
    "hash_kfold",
    f"""WITH {ORDERS_CTE} SELECT row_id,
    CAST(CAST(('0x' || substr(md5('{SEED}|' || grp), 1, 8)) AS BIGINT) % {FOLDS} AS INTEGER) AS fold FROM base""",
)
def hash_folds(spark, sf_dir):
    return orders_base(spark, sf_dir).select("row_id", hash_fold("grp", FOLDS, SEED).alias("fold"))


@query(
    "row_kfold",
    f"""WITH {ORDERS_CTE} SELECT row_id, CAST(ntile({FOLDS}) OVER (ORDER BY md5('42|' || CAST(row_id AS VARCHAR)),
    CAST(row_id AS VARCHAR)) - 1 AS INTEGER) AS fold FROM base WHERE split = 'train'""",
)
def row_folds(spark, sf_dir):
    df = train(orders_base(spark, sf_dir))
    return row_kfold(df, "row_id", FOLDS, True, 42).transform(df).select("row_id", "fold")


@query(
    "fold_expand",
    f"""WITH {ORDERS_CTE}, {folds_cte()}
    SELECT row_id, fold, CAST(r AS INTEGER) AS round, CASE WHEN r = fold THEN 'valid' ELSE 'train' END AS role
    FROM base JOIN folds USING (grp), range({FOLDS}) t(r) WHERE split = 'train'""",
)
def fold_expand(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    placed = fit_folds(df).transform(train(df))
    return expand_folds(placed, FOLDS).select("row_id", "fold", "round", "role")


@query(
    "stream_apply_encoder",
    """WITH n AS (SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY event_type)
    SELECT event_id, CAST(COALESCE(n.n, -1) AS BIGINT) AS "event_type_CE" FROM events LEFT JOIN n USING (event_type)""",
)
def stream_apply_encoder(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    known = events.filter(F.col("event_type") != "view")
    fitted = CountEncoder(["event_type"]).fit(known)
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")  # a file or a folder
    return apply_available(
        stream, lambda rows: fitted.transform(rows.select("event_id", "event_type")).select("event_id", "event_type_CE")
    )
