"""Column lists and experiments of the green-bean grading data set."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import Aggregation, Experiment, Learner, Split, TargetEncoding

# Names of the source columns and of the derived ones.
TARGETS = (
    "aroma", "flavor", "aftertaste", "acidity", "body", "balance",
    "uniformity", "clean_cup", "sweetness", "cupper_points", "total_cup_points",
)
TEXT_COLS = (
    "species", "owner", "countryof_origin", "farm_name", "mill", "company", "region", "producer",
    "in_country_partner", "owner1", "variety", "processing_method", "color", "unit_of_measurement",
)
DEFECT_COLS = ("category_one_defects", "category_two_defects", "category_sum_defects")
ORDINAL_COLS = (
    "farm_name", "variety", "countryof_origin", "processing_method", "color",
    "unit_of_measurement", "region", "category_one_and_two_defects_raw",
)
ONEHOT_COLS = ("species", "processing_method", "color", "unit_of_measurement", "in_country_partner")
AGG_COLS = (
    "altitude_mean_meters", "numberof_bags", "bag_weight_g", "moisture",
    "yield", "harvest_year", "processing_method_OE",
)
AGG_METHODS = ("min", "max", "mean", "std")
CLEANING = (
    "uniform_bag_weight", "uniform_harvest_year", "add_grading_date_features",
    "add_expiration_features", "add_defects_features", "add_cross_num_features",
)

# Free-text harvest years; a text not listed, or listed without a year, is missing.
HARVEST_YEARS: dict[str, int | None] = {
    "2012": 2012,
    "2014": 2014,
    "2013": 2013,
    "2015": 2015,
    "2016": 2016,
    "2017": 2017,
    "2013/2014": 2013,
    "2015/2016": 2015,
    "2011": 2011,
    "2017 / 2018": 2017,
    "2014/2015": 2014,
    "2009/2010": 2009,
    "2010": 2010,
    "2010-2011": 2010,
    "2016 / 2017": 2016,
    "4T/10": 2010,
    "Mayo a Julio": None,
    "March 2010": 2010,
    "4T/2010": 2010,
    "2009-2010": 2009,
    "08/09 crop": None,
    "2011/2012": 2011,
    "January 2011": 2011,
    "Abril - Julio": None,
    "May-August": None,
    "2016/2017": 2016,
    "4T72010": 2010,
    "Sept 2009 - April 2010": 2009,
    "August to December": None,
    "23 July 2010": 2010,
    "2009 - 2010": 2009,
    "4t/2010": 2010,
    "1t/2011": 2011,
    "2009 / 2010": 2009,
    "Spring 2011 in Colombia.": 2011,
    "TEST": None,
    "mmm": None,
    "4t/2011": 2011,
    "47/2010": 2010,
    "December 2009-March 2010": 2009,
    "3T/2011": 2011,
    "Abril - Julio /2011": 2011,
    "1T/2011": 2011,
    "2018": 2018,
    "January Through April": None,
    "Fall 2009": 2009,
}

SOURCE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TEXT_COLS]
    + [T.StructField(c, T.IntegerType()) for c in ("category_one_defects", "category_two_defects", "numberof_bags")]
    + [T.StructField(c, T.StringType()) for c in ("bag_weight", "harvest_year", "grading_date", "expiration")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("altitude_low_meters", "altitude_high_meters", "altitude_mean_meters", "moisture", "quakers")
    ]
    + [T.StructField(c, T.DoubleType()) for c in TARGETS]
)

# The names that configurations use, and the columns of each plain block.
PROJECTIONS: dict[str, tuple[str, ...]] = {
    "get_altitude_features": ("altitude_low_meters", "altitude_high_meters", "altitude_mean_meters"),
    "get_numberof_bags_feature": ("numberof_bags",),
    "get_bag_weight_feature": ("bag_weight_g", "bag_weight_log_g"),
    "get_hervest_year_features": ("harvest_year",),
    "get_grading_date_features": (
        "grading_date_raw", "grading_date_julian", "grading_date_year", "grading_date_month", "grading_date_day",
    ),
    "get_expiration_features": (
        "expiration_raw", "expiration_julian", "expiration_year", "expiration_month", "expiration_day",
    ),
    "get_moisture_features": ("moisture",),
    "get_defects_features": ("is_specialty",),
    "get_quakers_features": ("quakers",),
    "get_cross_num_features": ("yield", "log_yield"),
}

_ORIGIN_TE = ("countryof_origin", "processing_method", "variety")
_REGION_TE = ("countryof_origin", "region", "processing_method", "variety")
_COUNT, _TARGET = "get_count_encoding_features", "get_target_encoding_features"
_DEFECTS = "get_defects_features"

_BASE = Experiment(
    name="exp_002",
    targets=TARGETS,
    split=Split("farm_name"),
    preprocess=CLEANING,
    features=(_COUNT, _TARGET),
    count_cols=(*TEXT_COLS, *DEFECT_COLS),
    ordinal_cols=ORDINAL_COLS,
    onehot_cols=ONEHOT_COLS,
    target_encoding=TargetEncoding(_ORIGIN_TE),
    aggregations={
        "get_agg_region_features": Aggregation(("region",), AGG_COLS, AGG_METHODS),
        "get_agg_company_features": Aggregation(("company",), AGG_COLS, AGG_METHODS),
    },
    learner=Learner("gbt", {"maxIter": 10_000, "stepSize": 0.01, "lossType": "absolute"}, "patience", 100),
)

EXPERIMENTS: dict[str, Experiment] = {
    e.name: e
    for e in (
        _BASE,
        _BASE.change(name="exp_003", features=(_TARGET,)),
        _BASE.change(name="exp_004", target_encoding=TargetEncoding(_REGION_TE)),
        _BASE.change(
            name="exp_005", features=(_COUNT, _TARGET, _DEFECTS), target_encoding=TargetEncoding(_REGION_TE)
        ),
        _BASE.change(
            name="exp_006",
            features=(_COUNT, _TARGET, _DEFECTS),
            target_encoding=TargetEncoding((*_REGION_TE, "is_specialty")),
        ),
        _BASE.change(
            name="exp_007",
            features=(_COUNT, _TARGET, _DEFECTS),
            target_encoding=TargetEncoding((*_REGION_TE, "category_one_defects", "category_two_defects")),
        ),
    )
}
