"""Row-wise cleaning steps, named so that an experiment can list them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numeric, text
from ..operators.reshape import map_lookup, split_train_test, union_train_test
from .presets import HARVEST_YEARS

Step = Callable[[DataFrame], DataFrame]
STEPS: dict[str, Step] = {}


def step(name: str) -> Callable[[Step], Step]:
    """Register a ``DataFrame -> DataFrame`` function under ``name``."""

    def register(function: Step) -> Step:
        STEPS[name] = function
        return function

    return register


def weight_in_grams(df: DataFrame, source: str = "bag_weight", decimal: bool = False) -> DataFrame:
    """Replace a weight text by ``<source>_g`` and its ``log1p``."""
    weighed = df.withColumn(f"{source}_g", text.grams(F.col(source), decimal=decimal)).drop(source)
    return weighed.withColumn(f"{source}_log_g", numeric.log1p(F.col(f"{source}_g")))


def date_features(df: DataFrame, source: str) -> DataFrame:
    """Julian date, year, month, day and packed number of a date text."""
    return df.withColumns(dates.date_parts(dates.parse_moment(F.col(source)), source))


# The names by which configurations list the steps.


@step("uniform_bag_weight")
def _bag_weight(df: DataFrame) -> DataFrame:
    return weight_in_grams(df)


@step("uniform_harvest_year")
def _harvest_year(df: DataFrame) -> DataFrame:
    return df.withColumn("harvest_year", map_lookup(F.col("harvest_year"), HARVEST_YEARS, "int"))


@step("add_grading_date_features")
def _grading_date(df: DataFrame) -> DataFrame:
    return date_features(df, "grading_date")


@step("add_expiration_features")
def _expiration(df: DataFrame) -> DataFrame:
    return date_features(df, "expiration")


@step("add_defects_features")
def _defects(df: DataFrame) -> DataFrame:
    return defect_features(df, "category_one_defects", "category_two_defects")


@step("add_cross_num_features")
def _cross_num(df: DataFrame) -> DataFrame:
    return crossed_numbers(df, "numberof_bags", "bag_weight_g", "bag_weight_log_g")


def defect_features(df: DataFrame, first: str, second: str) -> DataFrame:
    """Sum, joined digits and the 0/1 flag of two defect counts."""
    a, b = F.col(first), F.col(second)
    return df.withColumns(
        {
            "category_sum_defects": a + b,
            "category_one_and_two_defects_raw": text.joined_digits(a, b),
            "is_specialty": numeric.low_defects(a, b),
        }
    )


def crossed_numbers(df: DataFrame, number: str, weight: str, log_weight: str) -> DataFrame:
    """``yield`` and ``log_yield``: the count times the weight, and times the log weight."""
    return df.withColumns(
        {"yield": F.col(number) * F.col(weight), "log_yield": F.col(number) * F.col(log_weight)}
    )


def run_steps(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Apply named steps in order; an unknown name fails before anything runs."""
    unknown = [n for n in names if n not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps {unknown}; known: {sorted(STEPS)}")
    return reduce(lambda frame, name: frame.transform(STEPS[name]), names, df)


def preprocess(train: DataFrame, test: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Clean train and test together and give them back apart."""
    return split_train_test(run_steps(union_train_test(train, test), names))
