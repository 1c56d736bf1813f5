"""The given tables seen as train and test rows, in Spark and in SQL.

The tables hold no nulls and no category that only test has, so both are made here.
Money is in whole cents, as a double: its sums are exact in any order, so
means agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.operators.folds import GroupFolds, group_kfold
from foldwright.plans.presets import TARGETS

from .registry import table

SEED, FOLDS = 1234, 5

_IS_TEST = "o_orderkey % 5 = 4"
_COMMON = f"""o_orderkey AS row_id,
    CASE WHEN {_IS_TEST} THEN 'test' ELSE 'train' END AS split,
    NULLIF(o_orderpriority, '5-LOW') AS cat_null,
    CASE WHEN {_IS_TEST} AND o_orderkey % 7 = 0 THEN 'UNSEEN' ELSE o_orderstatus END AS cat_unseen,
    CAST(o_custkey AS {{text}}) AS grp,
    round(o_totalprice * 100) AS y1,
    CAST(o_orderdate AS DATE) AS dt"""
_CUSTOMER = "c_mktsegment AS seg, c_nationkey AS nat, round(c_acctbal * 100) AS y2"

ORDERS_CTE = f"base AS (SELECT {_COMMON.format(text='VARCHAR')} FROM orders)"
BASE_CTE = (
    f"base AS (SELECT {_COMMON.format(text='VARCHAR')}, {_CUSTOMER} "
    "FROM orders JOIN customer ON o_custkey = c_custkey)"
)


def _expressions(text: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()]


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_expressions(_COMMON.format(text="STRING")))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(*_expressions(_COMMON.format(text="STRING")), *_expressions(_CUSTOMER))


def train(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def folds_cte(group: str = "grp", source: str = "base", name: str = "folds") -> str:
    return (
        f"{name} AS (SELECT {group}, CAST(ntile({FOLDS}) OVER (ORDER BY md5('{SEED}|' || {group}), {group}) - 1 AS INTEGER) "
        f"AS fold FROM (SELECT DISTINCT {group} FROM {source} WHERE split = 'train'))"
    )


# rows of `base` with fold, null in test
FOLDED_CTE = (
    folds_cte()
    + """, folded AS (
    SELECT b.*, CASE WHEN b.split = 'train' THEN f.fold END AS fold
    FROM base b LEFT JOIN folds f ON b.grp = f.grp)"""
)


def fit_folds(df: DataFrame) -> GroupFolds:
    return group_kfold(train(df), "grp", FOLDS, True, SEED)


def folded(df: DataFrame) -> DataFrame:
    placed = fit_folds(df).transform(df)
    return placed.withColumn("fold", F.when(F.col("split") == "train", F.col("fold")))


# the grading data set's columns, made from orders and customers
_DATE_TEXT = {"spark": "date_format({0}, 'MMMM d, yyyy')", "duck": "strftime({0}, '%B %-d, %Y')"}
_RAW = {
    "row_id": "o_orderkey",
    "split": f"CASE WHEN {_IS_TEST} THEN 'test' ELSE 'train' END",
    "species": "o_orderstatus",
    "owner": "concat('owner ', o_custkey % 97)",
    "countryof_origin": "concat('country ', c_nationkey)",
    "farm_name": "concat('farm ', o_custkey)",
    "mill": "NULLIF(concat('mill ', o_custkey % 13), 'mill 4')",
    "company": "c_mktsegment",
    "region": "NULLIF(o_orderpriority, '5-LOW')",
    "producer": "concat('producer ', o_custkey % 31)",
    "in_country_partner": "concat('partner ', o_orderkey % 7)",
    "owner1": "concat('Owner ', o_custkey % 96)",
    "variety": f"CASE WHEN {_IS_TEST} AND o_orderkey % 7 = 0 THEN 'UNSEEN' ELSE concat('v', o_orderkey % 11) END",
    "processing_method": "NULLIF(concat('method ', o_orderkey % 6), 'method 2')",
    "color": "concat('color ', o_orderkey % 4)",
    "unit_of_measurement": "CASE WHEN o_orderkey % 2 = 0 THEN 'm' ELSE 'ft' END",
    "category_one_defects": "CAST(o_orderkey % 3 AS INT)",
    "category_two_defects": "CAST(NULLIF(o_custkey % 9, 8) AS INT)",
    "numberof_bags": "CAST(o_custkey % 300 AS INT)",
    "bag_weight": "concat(o_orderkey % 70, CASE o_orderkey % 4 WHEN 0 THEN ' kg' WHEN 1 THEN ' lbs' WHEN 2 THEN 'g' ELSE '' END)",
    "harvest_year": "CASE o_orderkey % 6 WHEN 0 THEN '2012' WHEN 1 THEN '2013/2014' WHEN 2 THEN 'mmm' "
    "WHEN 3 THEN '4T/10' WHEN 4 THEN 'March 2010' ELSE 'other' END",
    "altitude_low_meters": "CAST(NULLIF(o_custkey % 50, 0) * 30 AS DOUBLE)",
    "altitude_high_meters": "CAST(NULLIF(o_custkey % 50, 0) * 32 AS DOUBLE)",
    "altitude_mean_meters": "CAST(NULLIF(o_custkey % 50, 0) * 31 AS DOUBLE)",
    "moisture": "CAST(o_orderkey % 13 AS DOUBLE) / 16",
    "quakers": "CAST(o_orderkey % 5 AS DOUBLE)",
}
_DATES = {"grading_date": "o_orderdate", "expiration": "o_orderdate + INTERVAL '365' DAY"}


def _target(i: int, name: str) -> str:
    value = f"round(o_totalprice * 100) * {i + 1} + round(c_acctbal * 100)"
    return f"CASE WHEN {_IS_TEST} THEN NULL ELSE {value} END AS {name}"


def raw_columns(engine: str) -> list[str]:
    dates = [f"{_DATE_TEXT[engine].format(expr)} AS {name}" for name, expr in _DATES.items()]
    return [f"{e} AS {n}" for n, e in _RAW.items()] + dates + [_target(i, t) for i, t in enumerate(TARGETS)]


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(*raw_columns("spark"))


RAW_CTE = f"raw AS (SELECT {', '.join(raw_columns('duck'))}, CAST(o_orderdate AS DATE) AS d1, " \
    "CAST(o_orderdate + INTERVAL '365' DAY AS DATE) AS d2 FROM orders JOIN customer ON o_custkey = c_custkey)"
HARVEST_SQL = "CASE harvest_year WHEN '2012' THEN 2012 WHEN '2013/2014' THEN 2013 WHEN '4T/10' THEN 2010 WHEN 'March 2010' THEN 2010 END"
