"""Sources, sinks, reshaping, joins, statistics, profiling and metrics."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.functions import dates, text
from foldwright.operators import importance as imp
from foldwright.operators import metrics, profile, quantiles, reshape, sketches
from foldwright.operators.encoders import CountEncoder
from foldwright.operators.group_stats import GroupStats
from foldwright.plans.preprocess import crossed_numbers, defect_features
from foldwright.plans.preprocess import date_features as date_columns
from foldwright.sources import missing, sinks, tables
from foldwright.workspace import fresh_path, materialise

from .base import BASE_CTE, ORDERS_CTE, base, orders_base, train
from .encoding import count_cte, count_join
from .registry import query, table

# --- sources and sinks -------------------------------------------------------------

_SEGMENT = "CASE c_custkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN 'N/A' ELSE c_mktsegment END"
_NATION = "CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN concat(c_nationkey, '.0') ELSE CAST(c_nationkey AS {text}) END"


@query(
    "scan_normalise_missing",
    """SELECT c_custkey AS row_id, CASE WHEN c_custkey % 7 > 3 THEN c_mktsegment END AS seg,
    CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nat,
    CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance FROM customer""",
)
def scan_normalise_missing(spark, sf_dir):
    dirty = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS row_id",
        f"{_SEGMENT} AS seg",
        f"{_NATION.format(text='STRING')} AS nat",
        "CASE WHEN c_custkey % 3 = 0 THEN 'NaN' ELSE CAST(c_acctbal AS STRING) END AS balance",
    )
    path = fresh_path(spark, "csv")
    dirty.write.csv(path, header=True)
    kinds = T.StructType.fromDDL("row_id BIGINT, seg STRING, nat INT, balance DOUBLE")
    return tables.read_csv(spark, path, kinds, row_id="row_id")


# text in a file to be read in blocks: more than a block of Spark's default size (128 MB)
FILE_BYTES = 160 << 20


def _quoted(df, path):
    """CSV as most tools write it: every field in quotes, a quote inside written twice."""
    df.write.csv(path, header=True, quoteAll=True, escape='"')


@query("scan_quoted_text", "SELECT page_id, html FROM pages")
def scan_quoted_text(spark, sf_dir):
    """Fields with line breaks, quotes and commas."""
    path = fresh_path(spark, "csv")
    _quoted(table(spark, sf_dir, "pages").select("page_id", "html"), path)
    return tables.read_csv(spark, path, T.StructType.fromDDL("page_id BIGINT, html STRING"), row_id="page_id")


@query("scan_quoted_split", "SELECT row_number() OVER (ORDER BY page_id) - 1 AS row_id, page_id, html FROM pages")
def scan_quoted_split(spark, sf_dir):
    """Files with line breaks in their fields, each read by as many tasks as it has blocks.

    A task writes a whole file, so their number follows the bytes; the order of the keys goes on from file to file.
    """
    path, pages = fresh_path(spark, "csv"), table(spark, sf_dir, "pages").select("page_id", "html")
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    # the hash parts a key of many rows
    ranged = pages.repartitionByRange(max(1, ceil(size / FILE_BYTES)), "page_id", F.xxhash64("html"))
    _quoted(ranged.sortWithinPartitions("page_id"), path)
    return tables.read_csv(spark, path, T.StructType.fromDDL("page_id BIGINT, html STRING"), split_files=True)


@query("scan_quoted_props", "SELECT event_id, user_id, props FROM events")
def scan_quoted_props(spark, sf_dir):
    """Types found in quoted numbers, beside a text with quotes in every row."""
    path = fresh_path(spark, "csv")
    _quoted(table(spark, sf_dir, "events").select("event_id", "user_id", "props"), path)
    return tables.read_csv(spark, path, row_id=None)


@query(
    "scan_row_numbers",
    """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey, o_orderstatus FROM orders""",
)
def scan_row_numbers(spark, sf_dir):
    path = fresh_path(spark, "csv")
    ordered = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey")
    ordered.write.csv(path, header=True)
    return tables.read_csv(spark, path)


@query(
    "feature_table_roundtrip",
    f"WITH {BASE_CTE}, {count_cte('seg')} SELECT row_id, seg, CAST(n AS BIGINT) AS \"seg_CE\" "
    f"FROM base {count_join('seg')} WHERE split = 'test'",
)
def feature_table_roundtrip(spark, sf_dir):
    df = base(spark, sf_dir)
    encoded = CountEncoder(["seg"]).fit(train(df)).transform(df.select("row_id", "split", "seg"))
    path = fresh_path(spark, "features")
    sinks.save_features(encoded, path)
    return sinks.load_features(spark, path, "test").select("row_id", "seg", "seg_CE")


def _predictions(spark, sf_dir):
    """Predictions of two seeds for y1, by arithmetic."""
    share = (F.pmod(F.col("row_id") * 37 + F.col("seed") * 11, F.lit(21)) - 10) / 100.0
    return (
        orders_base(spark, sf_dir)
        .withColumn("seed", F.explode(F.array(F.lit(0), F.lit(1))))
        .select("row_id", "split", "seed", "y1", (F.col("y1").cast("double") * (1 + share)).alias("prediction"))
    )


_PRED_CTE = f"""{ORDERS_CTE}, pred AS (SELECT row_id, split, seed, y1,
    CAST(y1 AS DOUBLE) * (1 + ((row_id * 37 + seed * 11) % 21 - 10) / 100.0) AS prediction
    FROM base, (VALUES (0), (1)) s(seed))"""


@query(
    "submission_wide",
    f"""WITH {_PRED_CTE} SELECT row_id, round(avg(prediction), 6) AS y1, round(avg(prediction * 2), 6) AS y2
    FROM pred WHERE split = 'test' GROUP BY row_id""",
)
def submission_wide(spark, sf_dir):
    tests = _predictions(spark, sf_dir).filter("split = 'test'")
    long = tests.withColumn(
        "e", F.explode(F.array(F.struct(F.lit("y1").alias("target"), F.col("prediction")),
                               F.struct(F.lit("y2").alias("target"), (F.col("prediction") * 2).alias("prediction"))))
    ).select("row_id", "e.target", "e.prediction")
    path = fresh_path(spark, "submission")
    sinks.write_submission(long, ["y1", "y2"], path)
    stored = spark.read.schema("row_id BIGINT, y1 DOUBLE, y2 DOUBLE").csv(path, header=True)
    return stored.select("row_id", F.round("y1", 6).alias("y1"), F.round("y2", 6).alias("y2"))


# --- combine, split, project --------------------------------------------------------


@query(
    "union_train_test",
    f"""WITH {ORDERS_CTE} SELECT row_id, cat_null, CAST(CASE WHEN split = 'train' THEN y1 END AS DOUBLE) AS y1, split FROM base""",
)
def union_train_test(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    left = df.filter("split = 'train'").select("row_id", "cat_null", F.col("y1").cast("double").alias("y1"))
    return reshape.union_train_test(left, df.filter("split = 'test'").select("row_id", "cat_null"))


@query(
    "split_train_test",
    f"WITH {ORDERS_CTE} SELECT split, count(*) AS n, min(row_id) AS first_row, max(row_id) AS last_row FROM base GROUP BY split",
)
def split_train_test(spark, sf_dir):
    sides = reshape.split_train_test(orders_base(spark, sf_dir))
    told = [
        s.agg(
            F.lit(name).alias("split"),
            F.count(F.lit(1)).alias("n"),
            F.min("row_id").alias("first_row"),
            F.max("row_id").alias("last_row"),
        )
        for name, s in zip(("train", "test"), sides)
    ]
    return told[0].unionByName(told[1])


@query("project_features", f"WITH {BASE_CTE} SELECT row_id, split, seg, nat FROM base")
def project_features(spark, sf_dir):
    return reshape.project_features(base(spark, sf_dir), ["seg", "nat"])


@query(
    "assemble_blocks",
    f"""WITH {ORDERS_CTE}, {count_cte('cat_null')} SELECT row_id, split, CAST(COALESCE(n, -1) AS BIGINT) AS "cat_null_CE",
    year(dt) AS dt_year FROM base {count_join('cat_null')}""",
)
def assemble_blocks(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    counts = CountEncoder(["cat_null"]).fit(train(df)).transform(df).select("row_id", "split", "cat_null_CE")
    years = df.select("row_id", "split", F.year("dt").cast("bigint").alias("dt_year"))
    return reshape.assemble_blocks([counts, years])


@query("filter_equals", f"WITH {BASE_CTE} SELECT row_id, seg, nat FROM base WHERE seg = 'BUILDING'")
def filter_equals(spark, sf_dir):
    return profile.filter_equals(base(spark, sf_dir), "seg", "BUILDING").select("row_id", "seg", "nat")


@query(
    "transpose_small",
    """SELECT 'p_name' AS "column", p_partkey, p_name AS value FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 'p_brand', p_partkey, p_brand FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 'p_size', p_partkey, CAST(p_size AS VARCHAR) FROM part WHERE p_type = 'PROMO'""",
)
def transpose_small(spark, sf_dir):
    chosen = profile.filter_equals(table(spark, sf_dir, "part"), "p_type", "PROMO")
    return profile.flipped(chosen, "p_partkey", ["p_name", "p_brand", "p_size"])


@query(
    "guard_rowcount",
    f"WITH {ORDERS_CTE} SELECT count(*) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after, "
    "CAST(0 AS BIGINT) AS repeated_keys, 1 AS kept FROM base",
)
def guard_rowcount(spark, sf_dir):
    df = orders_base(spark, sf_dir)
    return reshape.rowcount_guard(df, CountEncoder(["cat_null", "grp"]).fit(train(df)).transform(df), ["row_id"])


@query(
    "fill_below_min",
    """SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END,
    (SELECT min(c_acctbal) FROM customer WHERE c_custkey % 3 <> 0) - 1.0) AS balance FROM customer""",
)
def fill_below_min(spark, sf_dir):
    holed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance"
    )
    return reshape.fill_below_min(holed, ["balance"])


# --- text, dates, numbers -------------------------------------------------------------

_WEIGHT = "concat(p_size, ' ', CASE p_partkey % 5 WHEN 0 THEN 'kg' WHEN 1 THEN 'lbs' WHEN 2 THEN 'g' WHEN 3 THEN '' ELSE 'kg,lbs' END)"


@query(
    "parse_quantity_unit",
    rf"""SELECT p_partkey, TRY_CAST(regexp_extract(w, '(\d*)\s*([a-zA-Z]*)', 1) AS BIGINT) AS value,
    regexp_extract(w, '(\d*)\s*([a-zA-Z]*)', 2) AS unit FROM (SELECT p_partkey, {_WEIGHT} AS w FROM part)""",
)
def parse_quantity_unit(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_WEIGHT} AS w")
    return part.select("p_partkey", text.quantity(F.col("w")).alias("value"), text.unit(F.col("w")).alias("unit"))


@query(
    "normalise_weight",
    """SELECT p_partkey, CAST(p_size * CASE p_partkey % 5 WHEN 0 THEN 1000 WHEN 1 THEN 453 WHEN 4 THEN 1000 ELSE 1 END AS BIGINT) AS weight_g,
    round(ln(1 + p_size * CASE p_partkey % 5 WHEN 0 THEN 1000 WHEN 1 THEN 453 WHEN 4 THEN 1000 ELSE 1 END), 6) AS weight_log_g FROM part""",
)
def normalise_weight(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_WEIGHT} AS w")
    weighed = part.select("p_partkey", text.grams(F.col("w")).alias("weight_g"))
    return weighed.withColumn("weight_log_g", F.round(F.log1p("weight_g"), 6))


@query(
    "map_lookup",
    """SELECT p_partkey, CAST(CASE p_type WHEN 'STANDARD' THEN 2012 WHEN 'PROMO' THEN 2013 WHEN 'LARGE' THEN 2009 END AS INTEGER) AS code FROM part""",
)
def map_lookup(spark, sf_dir):
    codes = {"STANDARD": 2012, "PROMO": 2013, "LARGE": 2009, "SMALL": None}
    return table(spark, sf_dir, "part").select(
        "p_partkey", reshape.map_lookup(F.col("p_type"), codes, "int").alias("code")
    )


_ORDINAL_DAY = "concat(date_format(o_orderdate, 'MMMM '), day(o_orderdate), CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22) THEN 'nd' WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END, ', ', year(o_orderdate))"


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
)
def parse_date(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' WHEN o_orderkey % 2 = 0 THEN {_ORDINAL_DAY} "
        "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS t",
    )
    return texts.select("o_orderkey", dates.parse_date(F.col("t")).alias("parsed"))


def _date_sql(prefix: str, key: str, column: str, source: str) -> str:
    return f"""SELECT {key}, julian(d) - 0.5 AS {prefix}_julian, CAST(year(d) AS INTEGER) AS {prefix}_year,
    CAST(month(d) AS INTEGER) AS {prefix}_month, CAST(day(d) AS INTEGER) AS {prefix}_day,
    CAST(concat(year(d), month(d), day(d)) AS BIGINT) AS {prefix}_raw, year(d) * 10000 + month(d) * 100 + day(d) AS {prefix}_yyyymmdd
    FROM (SELECT *, CAST({column} AS DATE) AS d FROM {source})"""


def _date_query(spark, sf_dir, source, key, column, prefix):
    rows = table(spark, sf_dir, source).select(*key, F.col(column).cast("date").alias("d"))
    day = F.col("d")
    return rows.select(
        *key,
        *[e.alias(n) for n, e in dates.date_parts(day, prefix).items()],
        dates.packed(day).alias(f"{prefix}_yyyymmdd"),
    )


@query("date_features", _date_sql("grading_date", "o_orderkey", "o_orderdate", "orders"))
def date_features(spark, sf_dir):
    return _date_query(spark, sf_dir, "orders", ["o_orderkey"], "o_orderdate", "grading_date")


@query("date_features_second", _date_sql("expiration", "l_orderkey, l_partkey", "l_shipdate", "lineitem"))
def date_features_second(spark, sf_dir):
    return _date_query(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"], "l_shipdate", "expiration")


@query(
    "julian_timestamp",
    "SELECT event_id, CAST(epoch_us(ts) AS DOUBLE) / CAST(86400000000 AS DOUBLE) + CAST(2440587.5 AS DOUBLE) AS julian FROM events",
)
def julian_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", dates.julian_timestamp(F.col("ts")).alias("julian"))


_MOMENT_TEXT = {
    0: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    1: "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    2: _ORDINAL_DAY.replace("o_orderdate", "ts"),
    3: "date_format(ts, 'd MMM yyyy')",
}


@query(
    "date_features_timestamp",
    """SELECT event_id, CAST(epoch_us(m) AS DOUBLE) / CAST(86400000000 AS DOUBLE) + CAST(2440587.5 AS DOUBLE) AS t_julian,
    CAST(year(m) AS INTEGER) AS t_year, CAST(month(m) AS INTEGER) AS t_month, CAST(day(m) AS INTEGER) AS t_day,
    CAST(concat(year(m), month(m), day(m)) AS BIGINT) AS t_raw
    FROM (SELECT event_id, date_trunc(CASE WHEN event_id % 4 < 2 THEN 'second' ELSE 'day' END, CAST(ts AS TIMESTAMP)) AS m FROM events)""",
)
def date_features_timestamp(spark, sf_dir):
    """Texts with and without a time of day."""
    text_of = " ".join(f"WHEN {k} THEN {e}" for k, e in _MOMENT_TEXT.items())
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"CASE event_id % 4 {text_of} END AS t")
    return date_columns(texts, "t").drop("t")


@query(
    "defect_features",
    """SELECT l_orderkey, l_partkey, a + b AS category_sum_defects, CAST(a AS VARCHAR) || CAST(b AS VARCHAR) AS category_one_and_two_defects_raw,
    CASE WHEN a = 0 AND b <= 5 THEN 1 ELSE 0 END AS is_specialty FROM (SELECT l_orderkey, l_partkey, CAST(l_linenumber - 1 AS INTEGER) AS a,
    CAST(NULLIF(CAST(l_quantity AS INTEGER) % 12, 7) AS INTEGER) AS b FROM lineitem)""",
)
def defects(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "CAST(l_linenumber - 1 AS INT) AS a", "NULLIF(CAST(l_quantity AS INT) % 12, 7) AS b"
    )
    return defect_features(rows, "a", "b").drop("a", "b")


@query(
    "cross_num_features",
    """SELECT l_orderkey, l_partkey, l_quantity * l_extendedprice AS yield, round(l_quantity * ln(1 + l_extendedprice), 4) AS log_yield FROM lineitem""",
)
def cross_num_features(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", F.log1p("l_extendedprice").alias("logged")
    )
    made = crossed_numbers(rows, "l_quantity", "l_extendedprice", "logged")
    return made.select("l_orderkey", "l_partkey", "yield", F.round("log_yield", 4).alias("log_yield"))


# --- grouped statistics ---------------------------------------------------------------

_STATS = ("min", "max", "mean", "std")
_STAT_SQL = {
    "min": "CAST(min({0}) AS DOUBLE)",
    "max": "CAST(max({0}) AS DOUBLE)",
    "mean": "CAST(sum({0}) AS DOUBLE) / count({0})",
    "std": "round(stddev_samp(CAST({0} AS DOUBLE)), 4)",
    "var": "round(var_samp({0}) / 1e12, 4)",
    "sum": "CAST(sum({0}) AS DOUBLE)",
    "count": "count({0})",
    "nunique": "count(DISTINCT {0})",
    "median": "CAST(quantile_cont(CAST({0} AS DOUBLE), 0.5) AS DOUBLE)",
}


def _stats_sql(keys, targets, methods, joined, cte=BASE_CTE):
    cols = [
        f'{_STAT_SQL[m].format(t)} AS "agg_{m}_{"_and_".join(keys)}_by_{t}"' for t in targets for m in methods
    ]
    names = [f'"agg_{m}_{"_and_".join(keys)}_by_{t}"' for t in targets for m in methods]
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    stats = f"stats AS (SELECT {', '.join(keys)}, {', '.join(cols)} FROM base WHERE split = 'train' AND {present} GROUP BY {', '.join(keys)})"
    if joined:
        on = " AND ".join(f"base.{k} = stats.{k}" for k in keys)
        return f"WITH {cte}, {stats} SELECT row_id, {', '.join(names)} FROM base LEFT JOIN stats ON {on}"
    return f"WITH {cte}, {stats} SELECT * FROM stats"


def _shown(df, keys):
    """Money as double, deviations rounded."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if f.dataType.typeName() == "decimal":
            c = c.cast("double")
        if f.name.startswith("agg_std"):
            c = F.round(c, 4)
        if f.name.startswith("agg_var"):
            c = F.round(c / 1e12, 4)
        out.append(c.alias(f.name))
    return df.select(*out)


@query("group_stats", _stats_sql(["seg", "cat_null"], ["y1", "y2"], _STATS, False))
def group_stats(spark, sf_dir):
    stats = GroupStats(["seg", "cat_null"], ["y1", "y2"], _STATS).statistics(train(base(spark, sf_dir)))
    return _shown(stats.drop("__n"), ["seg", "cat_null"])


@query("group_stats_join", _stats_sql(["seg", "cat_null"], ["y1", "y2"], _STATS, True))
def group_stats_join(spark, sf_dir):
    return _joined(spark, sf_dir, ["seg", "cat_null"], ["y1", "y2"], _STATS)


def _joined(spark, sf_dir, keys, targets, methods, source=base):
    df = source(spark, sf_dir)
    made = GroupStats(keys, targets, methods).fit(train(df)).transform(df)
    return _shown(made.select("row_id", *[c for c in made.columns if c.startswith("agg_")]), keys)


@query(
    "group_stats_nan",
    """SELECT c_mktsegment AS seg, round(max(v), 2) AS top, round(avg(v), 4) AS mean, count(v) AS n, round(median(v), 4) AS middle,
    round(stddev_samp(v), 4) AS spread FROM (SELECT c_mktsegment, CASE WHEN c_custkey % 3 <> 0 THEN round(c_acctbal * 100) END AS v FROM customer)
    GROUP BY c_mktsegment""",
)
def group_stats_nan(spark, sf_dir):
    """NaN is missing."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS seg", "CASE WHEN c_custkey % 3 = 0 THEN double('NaN') ELSE round(c_acctbal * 100) END AS v"
    )
    made = GroupStats(["seg"], ["v"], ["max", "mean", "count", "median", "std"]).statistics(rows)
    shown = {"top": ("max", 2), "mean": ("mean", 4), "middle": ("median", 4), "spread": ("std", 4)}
    return made.select("seg", F.col("agg_count_seg_by_v").alias("n"), *[F.round(f"agg_{m}_seg_by_v", d).alias(n) for n, (m, d) in shown.items()])


_OTHER = ("sum", "count", "median", "var", "nunique")


@query("group_stats_methods", _stats_sql(["nat"], ["y1"], _OTHER, True))
def group_stats_methods(spark, sf_dir):
    return _joined(spark, sf_dir, ["nat"], ["y1"], _OTHER)


@query("group_stats_high_cardinality", _stats_sql(["grp"], ["y1"], ("min", "max", "mean", "median"), True, ORDERS_CTE))
def group_stats_high_cardinality(spark, sf_dir):
    return _joined(spark, sf_dir, ["grp"], ["y1"], ("min", "max", "mean", "median"), orders_base)


# --- profiling ---------------------------------------------------------------------------

_BASE_COLS = ("cat_null", "cat_unseen", "grp", "seg", "nat")


@query(
    "missing_rate",
    f"WITH {BASE_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS missing_rate FROM base WHERE split = 'train'"
        for c in _BASE_COLS
    ),
)
def missing_rate(spark, sf_dir):
    return profile.missing_rate(train(base(spark, sf_dir)), _BASE_COLS)


@query(
    "profile_table",
    f"WITH {BASE_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS rows FROM base"
        for c, t in zip(_BASE_COLS, ("string", "string", "string", "string", "int"))
    ),
)
def profile_table(spark, sf_dir):
    return profile.profile(base(spark, sf_dir).select(*_BASE_COLS))


@query("head_rows", f"WITH {ORDERS_CTE} SELECT row_id, split, cat_null FROM base ORDER BY row_id LIMIT 10")
def head_rows(spark, sf_dir):
    return profile.head(orders_base(spark, sf_dir).select("row_id", "split", "cat_null"), 10)


@query(
    "group_mean_topk",
    f"""WITH {BASE_CTE} SELECT seg, cat_null, nat, CAST(sum(y1) AS DOUBLE) / count(y1) AS y1 FROM base
    WHERE seg IS NOT NULL AND cat_null IS NOT NULL AND nat IS NOT NULL GROUP BY seg, cat_null, nat
    ORDER BY y1 DESC, seg, cat_null, nat LIMIT 20""",
)
def group_mean_topk(spark, sf_dir):
    return profile.group_mean_topk(base(spark, sf_dir), ["seg", "cat_null", "nat"], "y1", 20)


@query("distinct_groups", f"WITH {ORDERS_CTE} SELECT DISTINCT grp FROM base WHERE split = 'train'")
def distinct_groups(spark, sf_dir):
    return profile.distinct_values(train(orders_base(spark, sf_dir)), "grp")


@query(
    "letter_values",
    f"WITH {BASE_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS value FROM base WHERE split = 'train'"
        for c in ("y1", "y2")
        for p in (0.0625, 0.125, 0.25, 0.5, 0.75, 0.875, 0.9375)
    ),
)
def letter_values(spark, sf_dir):
    made = quantiles.letter_values(train(base(spark, sf_dir)), ["y1", "y2"])
    return made.withColumn("value", F.round("value", 4))


@query(
    "quantiles_ranged",
    f"WITH {BASE_CTE} SELECT seg, count(*) AS n, round(quantile_cont(y1, 0.25), 4) AS low, round(quantile_cont(y1, 0.5), 4) AS middle, "
    "round(quantile_cont(y1, 0.9), 4) AS high FROM base WHERE split = 'train' GROUP BY seg",
)
def quantiles_ranged(spark, sf_dir):
    """Running totals over ranges of a few hundred values (more beyond the most ranges), totals joined by shuffle."""
    made = quantiles.quantiles(train(base(spark, sf_dir)), ["y1"], [0.25, 0.5, 0.9], ["seg"], rows_per_task=300, table_bytes=0)
    return made.select("seg", "n", *[F.round(f"q_{i}", 4).alias(a) for i, a in enumerate(("low", "middle", "high"))])


_RANKS = (0.0625, 0.25, 0.5, 0.75, 0.99)


@query(
    "quantiles_sketched",
    f"""WITH {BASE_CTE} SELECT seg, prob, count(*) AS n, TRUE AS within FROM base CROSS JOIN (VALUES {', '.join(f'(CAST({p} AS DOUBLE))' for p in _RANKS)}) v(prob)
    WHERE split = 'train' GROUP BY seg, prob""",
)
def quantiles_sketched(spark, sf_dir):
    """Sketches of three parts of the rows, merged, and every answer held against the ranks of all rows.

    An answer is within if its rank is off by at most twice the error that holds at 99 %: five deviations.
    """
    df = train(base(spark, sf_dir))
    made = sketches.merge_sketches(*[sketches.quantile_sketches(df.filter(F.col("row_id") % 3 == part), ["y1"], ["seg"]) for part in range(3)])
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), F.col(f"q_{i}").alias("value")) for i, p in enumerate(_RANKS)]))
    answers = sketches.sketched_quantiles(made, _RANKS).select("seg", "n", pairs.alias("a")).select("seg", "n", "a.*")
    answers = materialise(answers, "sketched")  # a sketch made again may answer otherwise
    ranks = df.join(F.broadcast(answers), "seg").groupBy("seg", "prob", "n").agg(
        F.avg((F.col("y1") < F.col("value")).cast("int")).alias("low"), F.avg((F.col("y1") <= F.col("value")).cast("int")).alias("high")
    )
    within = F.col("prob").between(F.col("low") - 2 * sketches.rank_error(), F.col("high") + 2 * sketches.rank_error())
    return ranks.select("seg", "prob", "n", within.alias("within"))


# --- metrics -----------------------------------------------------------------------------


@query(
    "ensemble_mean",
    f"WITH {_PRED_CTE} SELECT row_id, round(avg(prediction), 6) AS prediction FROM pred GROUP BY row_id",
)
def ensemble_mean(spark, sf_dir):
    made = metrics.ensemble_mean(_predictions(spark, sf_dir), ["row_id"])
    return made.withColumn("prediction", F.round("prediction", 6))


def _scored(spark, sf_dir):
    """Truth and prediction of two targets per row, by arithmetic."""
    df = base(spark, sf_dir)
    share = F.lit(1.0) + (F.pmod(F.col("row_id") * 37, F.lit(21)) - 10) / 100.0
    return df.select(
        F.col("y1").cast("double").alias("y1"),
        F.abs(F.col("y2")).cast("double").alias("y2"),
        (F.col("y1").cast("double") * share).alias("p1"),
        (F.abs(F.col("y2")).cast("double") * share).alias("p2"),
    )


_SCORED_CTE = f"""{BASE_CTE}, s AS (SELECT CAST(y1 AS DOUBLE) AS y1, CAST(abs(y2) AS DOUBLE) AS y2,
    CAST(y1 AS DOUBLE) * (1.0 + (row_id * 37 % 21 - 10) / 100.0) AS p1,
    CAST(abs(y2) AS DOUBLE) * (1.0 + (row_id * 37 % 21 - 10) / 100.0) AS p2 FROM base)"""


@query(
    "columnwise_mae",
    f"""WITH {_SCORED_CTE}, m AS (SELECT avg(abs(y1 - p1)) AS a, avg(abs(y2 - p2)) AS b FROM s)
    SELECT 'y1' AS target, round(a, 4) AS score FROM m UNION ALL SELECT 'y2', round(b, 4) FROM m
    UNION ALL SELECT 'mean', round((a + b) / 2, 4) FROM m""",
)
def columnwise_mae(spark, sf_dir):
    pairs = {"y1": ("y1", "p1"), "y2": ("y2", "p2")}
    made = metrics.columnwise_scores(_scored(spark, sf_dir), pairs, "mean_absolute_error")
    return made.withColumn("score", F.round("score", 4))


@query(
    "scores_by_target",
    f"""WITH {_SCORED_CTE}, l AS (SELECT 'y1' AS target, y1 AS t, p1 AS p FROM s UNION ALL SELECT 'y2', y2, p2 FROM s),
    m AS (SELECT target, quantile_cont(abs(t - p), 0.5) AS score FROM l GROUP BY target)
    SELECT target, round(score, 4) AS score FROM m UNION ALL SELECT 'mean', round(avg(score), 4) FROM m""",
)
def scores_by_target(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    sides = [F.struct(F.lit(f"y{i}").alias("target"), F.col(f"y{i}").alias("truth"), F.col(f"p{i}").alias("prediction")) for i in (1, 2)]
    long = rows.select(F.explode(F.array(*sides)).alias("e")).select("e.*")
    return metrics.long_scores(long, "median_absolute_error", 2).withColumn("score", F.round("score", 4))


_METRIC_SQL = {
    "mean_absolute_error": "avg(abs(y1 - p1))",
    "mean_squared_error": "avg((y1 - p1) * (y1 - p1)) / 1e12",
    "mean_absolute_percentage_error": "avg(abs(y1 - p1) / abs(y1))",
    "mean_squared_log_error": "avg(pow(ln(1 + y1) - ln(1 + p1), 2))",
    "max_error": "max(abs(y1 - p1))",
    "median_absolute_error": "quantile_cont(abs(y1 - p1), 0.5)",
    "r2_score": "1 - sum((y1 - p1) * (y1 - p1)) / sum((y1 - m) * (y1 - m))",
    "explained_variance_score": "1 - var_pop(y1 - p1) / var_pop(y1)",
}


@query(
    "regression_metrics",
    f"WITH {_SCORED_CTE}, sm AS (SELECT *, avg(y1) OVER () AS m FROM s) "
    + " UNION ALL ".join(f"SELECT '{n}' AS metric, round({e}, 4) AS score FROM sm" for n, e in _METRIC_SQL.items()),
)
def regression_metrics(spark, sf_dir):
    made = metrics.metric_table(_scored(spark, sf_dir), "y1", "p1", list(_METRIC_SQL))
    scaled = F.when(F.col("metric") == "mean_squared_error", F.col("score") / 1e12).otherwise(F.col("score"))
    return made.select("metric", F.round(scaled, 4).alias("score"))


_CONSTANT = {"off": "CAST(c_nationkey AS DOUBLE)", "exact": "CAST(5 AS DOUBLE)"}
_CONSTANT_SQL = {"r2_score": "sum((5 - p) * (5 - p))", "explained_variance_score": "var_pop(5 - p)"}


@query(
    "regression_metrics_constant",
    " UNION ALL ".join(
        f"SELECT '{k}' AS kind, '{m}' AS metric, CAST(CASE WHEN {left} = 0 THEN 1 ELSE 0 END AS DOUBLE) AS score "
        f"FROM (SELECT {p} AS p FROM customer)"
        for k, p in _CONSTANT.items()
        for m, left in _CONSTANT_SQL.items()
    ),
)
def regression_metrics_constant(spark, sf_dir):
    """A constant truth is explained fully or not at all."""
    made = [
        metrics.metric_table(
            table(spark, sf_dir, "customer").selectExpr("CAST(5 AS DOUBLE) AS y", f"{p} AS p"), "y", "p", list(_CONSTANT_SQL)
        ).select(F.lit(k).alias("kind"), "metric", "score")
        for k, p in _CONSTANT.items()
    ]
    return made[0].unionByName(made[1])


# importance-like rows from the tables: one "model" per customer nation, one "feature" per part
_IMPORTANCE_SQL = "SELECT concat('f', l_partkey) AS feature, l_suppkey % 10 AS model_no, CAST(l_quantity AS DECIMAL(12,2)) AS importance FROM lineitem"
_TOP_SQL = "SELECT feature FROM i GROUP BY feature ORDER BY sum(importance) DESC, feature LIMIT 50"


def _importance(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('f', l_partkey) AS feature", "l_suppkey % 10 AS model_no", "CAST(l_quantity AS DECIMAL(12,2)) AS importance"
    )


@query(
    "importance_topk",
    f"WITH i AS ({_IMPORTANCE_SQL}) SELECT feature, model_no, CAST(importance AS DOUBLE) AS importance FROM i WHERE feature IN ({_TOP_SQL})",
)
def importance_topk(spark, sf_dir):
    made = imp.importance_topk(_importance(spark, sf_dir))
    return made.select("feature", "model_no", F.col("importance").cast("double").alias("importance"))


@query(
    "box_summary",
    f"""WITH i AS ({_IMPORTANCE_SQL}), v AS (SELECT feature, CAST(importance AS DOUBLE) AS x FROM i WHERE feature IN ({_TOP_SQL}))
    SELECT feature, count(*) AS n, min(x) AS low, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50,
    quantile_cont(x, 0.75) AS q75, max(x) AS high FROM v GROUP BY feature""",
)
def box_summary(spark, sf_dir):
    return imp.importance_boxes(_importance(spark, sf_dir))


@query(
    "infer_types",
    """SELECT 'c_custkey' AS "column", 'bigint' AS type, count(*) AS rows FROM customer UNION ALL
    SELECT 'c_acctbal', 'double', count(*) FROM customer UNION ALL SELECT 'c_name', 'string', count(*) FROM customer UNION ALL
    SELECT 'flag', 'boolean', count(*) FROM customer""",
)
def infer_types(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS c_custkey",
        "CASE WHEN c_custkey % 3 = 0 THEN 'NA' ELSE CAST(c_acctbal AS STRING) END AS c_acctbal",
        "c_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag",
    )
    kinds = missing.infer_types(texts)
    return profile.profile(missing.normalise_missing(texts, kinds)).select("column", "type", "rows")
