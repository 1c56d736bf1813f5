import datetime

import pytest
from pyspark.sql import functions as F

from foldwright.functions import dates, text
from foldwright.operators.reshape import fill_below_min, map_lookup
from foldwright.plans.preprocess import crossed_numbers, defect_features, weight_in_grams
from foldwright.plans.presets import HARVEST_YEARS


def test_weights(spark):
    data = ["60 kg", "1 lbs", "2 kg,lbs", "100 g", "6", "1.5 kg", "kg", " 6 kg", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "i int, bag_weight string")
    made = weight_in_grams(df).orderBy("i").collect()
    assert [r.bag_weight_g for r in made] == [60000, 453, 2000, 100, 6, 1, None, None, None]
    exact = weight_in_grams(df, decimal=True).orderBy("i").collect()
    assert [r.bag_weight_g for r in exact][:6] == [60000, 453, 2000, 100, 6, 1500]
    crossed = crossed_numbers(weight_in_grams(df).withColumn("n", F.lit(10)), "n", "bag_weight_g", "bag_weight_log_g")
    first = crossed.orderBy("i").first()
    assert first["yield"] == 600000 and first.log_yield == pytest.approx(110.0211)


def test_strict_weight_raises(spark):
    df = spark.createDataFrame([("kg",)], "t string")
    with pytest.raises(Exception, match="no quantity"):
        df.select(text.grams(F.col("t"), strict=True)).collect()


def test_harvest_years(spark):
    assert len(HARVEST_YEARS) == 46
    data = ["2009 / 2010", "08/09 crop", "47/2010", "1999", " 2012", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "i int, t string")
    got = df.select("i", map_lookup(F.col("t"), HARVEST_YEARS, "int").alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [2009, None, 2010, None, None, None]


def test_dates(spark):
    data = ["April 4th, 2015", "January 11th, 2015", "November 1st, 2015", "2015-04-04", "not a date", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "i int, t string")
    made = df.select("i", *[c.alias(n) for n, c in dates.date_parts(dates.parse_date(F.col("t")), "d").items()])
    got = [tuple(r)[1:] for r in made.orderBy("i").collect()]
    assert got == [
        (2457116.5, 2015, 4, 4, 201544),
        (2457033.5, 2015, 1, 11, 2015111),
        (2457327.5, 2015, 11, 1, 2015111),
        (2457116.5, 2015, 4, 4, 201544),
        (None,) * 5,
        (None,) * 5,
    ]


def test_time_of_day_counts(spark):
    texts = ["2015-04-04 12:00:00", "2015-04-04T12:00:00", "4 Apr 2015", "April 4th, 2015 12:00", " 2015-04-04 ", "2015-04-04 12:00:00.5", "12:00", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    made = df.select("i", *[c.alias(n) for n, c in dates.date_parts(dates.parse_moment(F.col("t")), "d").items()]).orderBy("i").collect()
    assert [r.d_julian for r in made[:5]] == [2457117.0, 2457117.0, 2457116.5, 2457117.0, 2457116.5]
    assert made[5].d_julian > 2457117.0 and made[6].d_julian is None and made[7].d_julian is None


def test_julian_of_a_moment(spark):
    df = spark.createDataFrame([(datetime.datetime(2015, 4, 4, 12, 0),)], "t timestamp_ntz")
    assert df.select(dates.julian_timestamp(F.col("t"))).first()[0] == 2457117.0


def test_defects(spark):
    data = [(0, 5), (0, 6), (1, 0), (1, 12), (11, 2), (0, None)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, a int, b int")
    made = defect_features(df, "a", "b").orderBy("i").collect()
    assert [r.category_sum_defects for r in made] == [5, 6, 1, 13, 13, None]
    assert [r.category_one_and_two_defects_raw for r in made] == ["05", "06", "10", "112", "112", None]
    assert [r.is_specialty for r in made] == [1, 0, 0, 0, 0, 0]


def test_interaction_key(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", None, 3)], "p string, q string, r int")
    made = df.select(text.interaction_key("p", "q"), text.interaction_key("p", "q", "r")).collect()
    assert [tuple(r) for r in made] == [("a_x", "a_x_3"), ("a_nan", "a_nan_3")]
    with pytest.raises(ValueError, match="two"):
        text.interaction_key("p")


def test_fill_below_min(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None)], "a double, b double")
    assert [tuple(r) for r in fill_below_min(df, ["a", "b"]).collect()] == [(1.0, -1.0), (0.0, -1.0), (0.0, -1.0)]
