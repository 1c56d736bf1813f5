"""Configured cleaning, the configured feature table, and the model jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.operators.importance import top_features
from foldwright.operators.training import assemble, cross_validate
from foldwright.plans.config import Learner
from foldwright.plans.experiment import oof_scores, run, run_stored
from foldwright.plans.features import build_features, feature_table
from foldwright.plans.fits import FitStore
from foldwright.plans.preprocess import run_steps
from foldwright.plans.presets import AGG_METHODS, EXPERIMENTS, TARGETS
from foldwright.workspace import fresh_path

from .base import BASE_CTE, FOLDED_CTE, FOLDS, HARVEST_SQL, RAW_CTE, base, folded, folds_cte, raw_rows
from .registry import query

# --- cleaning -----------------------------------------------------------------------

_GRAMS = "CAST((row_id % 70) * CASE row_id % 4 WHEN 0 THEN 1000 WHEN 1 THEN 453 ELSE 1 END AS BIGINT)"
# the cleaned columns, from the numbers behind the texts
_CLEAN_CTE = f"""{RAW_CTE}, base AS (SELECT * EXCLUDE (harvest_year), {_GRAMS} AS bag_weight_g, ln(1 + {_GRAMS}) AS bag_weight_log_g,
    CAST({HARVEST_SQL} AS INTEGER) AS harvest_year, category_one_defects + category_two_defects AS category_sum_defects,
    CAST(category_one_defects AS VARCHAR) || CAST(category_two_defects AS VARCHAR) AS category_one_and_two_defects_raw,
    CASE WHEN category_one_defects = 0 AND category_two_defects <= 5 THEN 1 ELSE 0 END AS is_specialty,
    numberof_bags * {_GRAMS} AS yield, numberof_bags * ln(1 + {_GRAMS}) AS log_yield FROM raw)"""


def _date_cols(prefix: str, d: str) -> str:
    return f"""julian({d}) - 0.5 AS {prefix}_julian, CAST(year({d}) AS INTEGER) AS {prefix}_year, CAST(month({d}) AS INTEGER) AS {prefix}_month,
    CAST(day({d}) AS INTEGER) AS {prefix}_day, CAST(concat(year({d}), month({d}), day({d})) AS BIGINT) AS {prefix}_raw"""


_CLEANED = (
    "row_id", "split", "bag_weight_g", "harvest_year", "category_sum_defects", "category_one_and_two_defects_raw",
    "is_specialty", "yield", *[f"{p}_{x}" for p in ("grading_date", "expiration") for x in ("julian", "year", "month", "day", "raw")],
)


@query(
    "preprocess_steps",
    f"""WITH {_CLEAN_CTE} SELECT row_id, split, bag_weight_g, harvest_year, category_sum_defects, category_one_and_two_defects_raw,
    is_specialty, yield, {_date_cols('grading_date', 'd1')}, {_date_cols('expiration', 'd2')},
    round(bag_weight_log_g, 6) AS bag_weight_log_g, round(log_yield, 4) AS log_yield FROM base""",
)
def preprocess_steps(spark, sf_dir):
    made = run_steps(raw_rows(spark, sf_dir), EXPERIMENTS["exp_007"].preprocess)
    return made.select(
        *_CLEANED, F.round("bag_weight_log_g", 6).alias("bag_weight_log_g"), F.round("log_yield", 4).alias("log_yield")
    )


# --- the feature table ------------------------------------------------------------------

_FOLDS_CTE = folds_cte("farm_name")
_FOLDED = f"""{_CLEAN_CTE}, {_FOLDS_CTE}, folded AS (SELECT base.*, CASE WHEN split = 'train' THEN folds.fold END AS fold
    FROM base LEFT JOIN folds USING (farm_name)), f AS (SELECT *, COALESCE(fold, -1) AS f FROM folded)"""


def _feature_sql(spec) -> str:
    """Direct counts, and direct means over the other folds (all folds for test rows)."""
    ctes, joins, cols = [], [], []
    if "get_count_encoding_features" in spec.features:
        for c in spec.count_cols:
            ctes.append(f"c_{c} AS (SELECT {c} AS k, count(*) AS n FROM f WHERE split = 'train' GROUP BY {c})")
            joins.append(f"LEFT JOIN c_{c} ON f.{c} IS NOT DISTINCT FROM c_{c}.k")
            cols.append(f'CAST(COALESCE(c_{c}.n, -1) AS BIGINT) AS "{c}_CE"')
    mean = ", ".join(f"CAST(sum({t}) AS DOUBLE) / CAST(count({t}) AS DOUBLE) AS {t}" for t in spec.targets)
    rounds = f"(SELECT unnest(range(-1, {FOLDS})) AS r)"
    source = f"FROM f JOIN {rounds} q ON f.f <> q.r WHERE split = 'train' GROUP BY q.r"
    ctes.append(f"prior AS (SELECT q.r, {mean} {source})")
    for c in spec.target_encoding.cols:
        ctes.append(f"t_{c} AS (SELECT q.r, {c} AS k, {mean} {source}, {c})")
        joins.append(f"LEFT JOIN t_{c} ON f.{c} IS NOT DISTINCT FROM t_{c}.k AND f.f = t_{c}.r")
        cols += [f'COALESCE(t_{c}.{t}, prior.{t}) AS "{c}_TE_{t}"' for t in spec.targets]
    if "get_defects_features" in spec.features:
        cols.append("is_specialty")
    return (
        f"WITH {_FOLDED}, {', '.join(ctes)} SELECT f.row_id, f.split, CAST(f.fold AS INTEGER) AS fold, {', '.join(cols)} "
        f"FROM f LEFT JOIN prior ON f.f = prior.r {' '.join(joins)}"
    )


def _features(spark, sf_dir, spec):
    table = feature_table(spec, raw_rows(spark, sf_dir))
    return table.rows.select("row_id", "split", "fold", *table.features)


@query("feature_table_full", _feature_sql(EXPERIMENTS["exp_007"]))
def feature_table_full(spark, sf_dir):
    """The widest configured feature table: 84 columns."""
    return _features(spark, sf_dir, EXPERIMENTS["exp_007"])


@query("feature_table_shared_fits", _feature_sql(EXPERIMENTS["exp_005"]))
def feature_table_shared_fits(spark, sf_dir):
    """Encoders that one experiment has fitted and stored serve the next one, which adds columns of its own."""
    fits, rows = FitStore(fresh_path(spark, "fits")), raw_rows(spark, sf_dir)
    feature_table(EXPERIMENTS["exp_004"], rows, fits=fits)
    table = feature_table(EXPERIMENTS["exp_005"], rows, fits=fits)
    return table.rows.select("row_id", "split", "fold", *table.features)


@query("feature_table_target_only", _feature_sql(EXPERIMENTS["exp_003"]))
def feature_table_target_only(spark, sf_dir):
    return _features(spark, sf_dir, EXPERIMENTS["exp_003"])


_STAT = {"min": "min({0})", "max": "max({0})", "mean": "avg({0})", "std": "stddev_samp({0})"}
_VALUES = ("altitude_mean_meters", "numberof_bags", "bag_weight_g", "moisture", "yield", "harvest_year", '"processing_method_OE"')


def _preset_sql(key: str) -> str:
    names = [(v, v.strip('"'), m) for v in _VALUES for m in AGG_METHODS]
    made = ", ".join(f'round(CAST({_STAT[m].format(v)} AS DOUBLE), 3) AS "agg_{m}_{key}_by_{n}"' for v, n, m in names)
    shown = ", ".join(f'"agg_{m}_{key}_by_{n}"' for v, n, m in names)
    return f"""WITH {_CLEAN_CTE}, codes AS (SELECT processing_method AS k, row_number() OVER (ORDER BY min(row_id)) AS code
    FROM base WHERE split = 'train' GROUP BY processing_method),
    coded AS (SELECT base.*, code AS "processing_method_OE" FROM base LEFT JOIN codes ON processing_method IS NOT DISTINCT FROM k),
    stats AS (SELECT {key} AS g, {made} FROM coded WHERE split = 'train' AND {key} IS NOT NULL GROUP BY {key})
    SELECT row_id, {shown} FROM base LEFT JOIN stats ON {key} = g"""


def _preset(spark, sf_dir, name, key):
    spec = EXPERIMENTS["exp_007"].change(
        features=("get_ordinal_encoding_features", name), ordinal_cols=("processing_method",), targets=("aroma",)
    )
    rows = run_steps(raw_rows(spark, sf_dir), spec.preprocess).withColumn("fold", F.lit(None).cast("int"))
    table = build_features(spec, rows)
    names = [c for c in table.features if c.startswith("agg_")]
    return table.rows.select("row_id", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in names])


@query("group_stats_region", _preset_sql("region"))
def group_stats_region(spark, sf_dir):
    return _preset(spark, sf_dir, "get_agg_region_features", "region")


@query("group_stats_company", _preset_sql("company"))
def group_stats_company(spark, sf_dir):
    return _preset(spark, sf_dir, "get_agg_company_features", "company")


# --- model jobs ------------------------------------------------------------------------------
# Fits whose result is known. With squared loss and whole steps, boosting on inputs of which all that split split alike
# predicts their group means over the other folds from its first round on, and the later rounds add nothing. A linear
# fit on one or two columns has a closed form. All else is the real cross-validation.

_STUMP = {"maxIter": 1, "maxDepth": 1, "lossType": "squared"}
_ROUNDS = {"maxIter": 3, "maxDepth": 3, "stepSize": 1.0, "lossType": "squared"}
_INPUTS = ("low", "known", "even")
_SEEDS = (0, 1)
_CV_CTE = f"""WITH {BASE_CTE}, {FOLDED_CTE}, rows AS (SELECT row_id, split, fold, y1, y2, CAST(nat AS DOUBLE) AS nat,
    CASE WHEN nat < 12 THEN 1 ELSE 0 END AS low FROM folded),
    rounds AS (SELECT unnest(range({FOLDS})) AS r), seeds AS (SELECT CAST(unnest(range({len(_SEEDS)})) AS INTEGER) AS seed),
    means AS (SELECT r, low, avg(y1) AS y1, avg(y2) AS y2 FROM rows JOIN rounds ON fold <> r WHERE split = 'train' GROUP BY r, low)"""


def _assembled(spark, sf_dir, targets, features):
    df = folded(base(spark, sf_dir)).withColumns(
        {
            "low": (F.col("nat") < 12).cast("double"),
            "nat": F.col("nat").cast("double"),
            "even": F.lit(1.0),
            "known": (F.col("nat") < 12).cast("double") * 1000,
        }
    )
    return assemble(df, features, targets)


def _validated(spark, sf_dir, targets=("y1",), features=_INPUTS, **options):
    table = _assembled(spark, sf_dir, targets, features)
    return cross_validate(table, features, targets, _SEEDS, FOLDS, **{"params": _ROUNDS, "parallelism": 8, **options})


@query(
    "cv_oof_predictions",
    f"""{_CV_CTE} SELECT row_id, 'y1' AS target, seed, CAST(fold AS INTEGER) AS fold, rows.y1 AS truth,
    round(means.y1, 4) AS prediction, round(means.y1, 4) AS seed_mean
    FROM rows JOIN means ON fold = r AND rows.low = means.low CROSS JOIN seeds WHERE split = 'train'""",
)
def cv_oof_predictions(spark, sf_dir):
    oof = _validated(spark, sf_dir).oof
    return oof.withColumns({c: F.round(c, 4) for c in ("prediction", "seed_mean")})


@query(
    "cv_oof_linear",
    f"""{_CV_CTE}, lines AS (SELECT r, regr_slope(y1, nat) AS a, regr_intercept(y1, nat) AS b FROM rows JOIN rounds ON fold <> r
    WHERE split = 'train' GROUP BY r) SELECT row_id, seed, CAST(fold AS INTEGER) AS fold, round(a * nat + b, 2) AS prediction
    FROM rows JOIN lines ON fold = r CROSS JOIN seeds WHERE split = 'train'""",
)
def cv_oof_linear(spark, sf_dir):
    oof = _validated(spark, sf_dir, features=("nat",), learner="linear", params={}).oof
    return oof.select("row_id", "seed", "fold", F.round("prediction", 2).alias("prediction"))


_PLANE_CTE = f"""{_CV_CTE}, spreads AS (SELECT r, {', '.join(
    f"covar_pop({a}, {b}) AS s_{a}_{b}" for a, b in (("nat", "nat"), ("low", "low"), ("nat", "low"), *((x, y) for x in ("nat", "low") for y in ("y1", "y2"))))},
    avg(nat) AS m_nat, avg(low) AS m_low, avg(y1) AS m_y1, avg(y2) AS m_y2 FROM rows JOIN rounds ON fold <> r WHERE split = 'train' GROUP BY r),
    planes AS ({' UNION ALL '.join(f"""SELECT r, '{y}' AS target, (s_low_low * s_nat_{y} - s_nat_low * s_low_{y}) / (s_nat_nat * s_low_low - s_nat_low * s_nat_low) AS a,
    (s_nat_nat * s_low_{y} - s_nat_low * s_nat_{y}) / (s_nat_nat * s_low_low - s_nat_low * s_nat_low) AS b, m_nat, m_low, m_{y} AS m FROM spreads""" for y in ("y1", "y2"))})"""


@query(
    "cv_linear_planes",
    f"""{_PLANE_CTE} SELECT row_id, target, seed, CAST(fold AS INTEGER) AS fold, CASE target WHEN 'y1' THEN rows.y1 ELSE rows.y2 END AS truth,
    round(m + a * (nat - m_nat) + b * (low - m_low), 2) AS prediction FROM rows JOIN planes ON fold = r CROSS JOIN seeds WHERE split = 'train'""",
)
def cv_linear_planes(spark, sf_dir):
    """Two targets on two inputs: the fits of all folds and targets from the sums of one pass."""
    oof = _validated(spark, sf_dir, ("y1", "y2"), features=("nat", "low"), learner="linear", params={}).oof
    return oof.select("row_id", "target", "seed", "fold", "truth", F.round("prediction", 2).alias("prediction"))


@query(
    "cv_linear_test",
    f"""{_PLANE_CTE} SELECT row_id, target, round(avg(m + a * (nat - m_nat) + b * (low - m_low)), 2) AS prediction
    FROM rows CROSS JOIN planes WHERE split = 'test' GROUP BY row_id, target""",
)
def cv_linear_test(spark, sf_dir):
    test = _validated(spark, sf_dir, ("y1", "y2"), features=("nat", "low"), learner="linear", params={}).test
    return test.select("row_id", "target", F.round("prediction", 2).alias("prediction"))


@query(
    "cv_best_iteration",
    f"""SELECT 'known' AS target, CAST(s AS INTEGER) AS seed, CAST(f AS INTEGER) AS fold, 1 AS rounds
    FROM range({len(_SEEDS)}) a(s) CROSS JOIN range({FOLDS}) b(f)""",
)
def cv_best_iteration(spark, sf_dir):
    """A target that the feature decides: no round after the first is better."""
    params = {**_STUMP, "maxIter": 64}
    return _validated(spark, sf_dir, ("known",), ("low",), params=params, stop="patience", patience=2).rounds


@query(
    "cv_test_predictions",
    f"""{_CV_CTE} SELECT row_id, 'y1' AS target, round(avg(means.y1), 4) AS prediction FROM rows JOIN means ON rows.low = means.low
    WHERE split = 'test' GROUP BY row_id""",
)
def cv_test_predictions(spark, sf_dir):
    test = _validated(spark, sf_dir).test
    return test.withColumn("prediction", F.round("prediction", 4))


@query(
    "cv_importance",
    f"SELECT 'low' AS feature, CAST({FOLDS * len(_SEEDS)} AS DOUBLE) AS total UNION ALL SELECT 'even', CAST(0 AS DOUBLE)",
)
def cv_importance(spark, sf_dir):
    """One feature says something and one is constant: each of the models gives the first all the weight."""
    return top_features(_validated(spark, sf_dir, features=("low", "even")).importance)


# the targets are mostly decided by is_specialty, so the one stump of each model splits there, among all features
_GAP = 1e10
_SPECIAL = f"CASE WHEN is_specialty = 1 THEN {_GAP} ELSE 0 END"


def _score_sql(targets) -> str:
    """Score per target, and their mean if there are several, of group means over the other folds."""
    own = ", ".join(f"{t} + {_SPECIAL} AS {t}" for t in targets)
    means = ", ".join(f"avg({t}) AS m_{t}" for t in targets)
    scores = ", ".join(f"avg(abs({t} - m_{t})) AS {t}" for t in targets)
    parts = [f"SELECT '{t}' AS target, round({t}, 1) AS score FROM scores" for t in targets]
    if len(targets) > 1:
        parts.append(f"SELECT 'mean', round(({' + '.join(targets)}) / {len(targets)}, 1) FROM scores")
    return f"""WITH {_FOLDED}, rows AS (SELECT fold, is_specialty, {own} FROM f WHERE split = 'train'),
    means AS (SELECT r, is_specialty AS s, {means} FROM rows JOIN (SELECT unnest(range({FOLDS})) AS r) q ON fold <> r GROUP BY r, is_specialty),
    scores AS (SELECT {scores} FROM rows JOIN means ON fold = r AND rows.is_specialty = means.s)
    {' UNION ALL '.join(parts)}"""


@query("multi_target_cv", _score_sql(TARGETS))
def multi_target_cv(spark, sf_dir):
    """The widest experiment whole: all targets, columns, folds and seeds, in one short round of boosting each."""
    spec = EXPERIMENTS["exp_007"].change(name="all", learner=Learner("gbt", _STUMP, "patience", 1, 8))
    scores = run(spec, _special_rows(spark, sf_dir, TARGETS)).scores
    return scores.withColumn("score", F.round("score", 1))


def _single():
    """The widest experiment with one target: all its columns, folds and seeds; one short round of boosting."""
    return EXPERIMENTS["exp_007"].change(name="single", targets=("aroma",), learner=Learner("gbt", _STUMP, "patience", 1, 8))


def _special_rows(spark, sf_dir, targets=("aroma",)):
    special = "category_one_defects = 0 AND category_two_defects <= 5"
    gap = f"CASE WHEN {special} THEN {_GAP} ELSE 0 END"
    return raw_rows(spark, sf_dir).withColumns({t: F.expr(f"{t} + {gap}") for t in targets})


_RUN_SQL = _score_sql(("aroma",))


@query("single_target_run", _RUN_SQL)
def single_target_run(spark, sf_dir):
    """A whole experiment on one target: cleaning, folds, features, fits, score."""
    scores = run(_single(), _special_rows(spark, sf_dir)).scores
    return scores.withColumn("score", F.round("score", 1))


@query("train_from_stored_features", _RUN_SQL)
def train_from_stored_features(spark, sf_dir):
    """The feature table is stored by one step and trained on by another that knows its path alone."""
    path = fresh_path(spark, "features-to-train")
    feature_table(_single(), _special_rows(spark, sf_dir), path)
    scores = run_stored(spark, _single(), path).scores
    return scores.withColumn("score", F.round("score", 1))
