"""Train, predict and score an experiment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.importance import importance_boxes, top_features
from ..operators.metrics import check_metric, long_scores
from ..operators.training import CVResult, assemble, cross_validate, grow_together
from ..sources.sinks import write_submission
from .config import Experiment
from .features import FeatureTable, feature_table


@dataclass(frozen=True)
class Outcome:
    scores: DataFrame       # target, score; several targets also give their mean
    result: CVResult

    def importance_ranking(self, target: str, k: int = 50) -> DataFrame:
        return top_features(self.result.importance.filter(F.col("target") == target), k)

    def importance_boxes(self, target: str, k: int = 50) -> DataFrame:
        return importance_boxes(self.result.importance.filter(F.col("target") == target), k)


def oof_scores(result: CVResult, targets: Sequence[str], seeds: Sequence[int], metric: str) -> DataFrame:
    """Scores of the seed-averaged out-of-fold predictions."""
    # the average stands in every seed's row: read one seed's
    averaged = result.oof.filter(F.col("seed") == seeds[0]).select(
        "target", "truth", F.col("seed_mean").alias("prediction")
    )
    return long_scores(averaged, metric, len(targets))


def train_and_score(spec: Experiment, table: FeatureTable) -> Outcome:
    """Cross-validate every target; score the seed-averaged out-of-fold predictions."""
    check_metric(spec.metric)
    learner = spec.learner
    together = grow_together(len(table.features), learner.name, learner.params, learner.stop)
    result = cross_validate(
        assemble(table.rows, table.features, spec.targets, table.row_id, table.least, stored=not together),
        table.features,
        spec.targets,
        spec.seeds,
        spec.split.n_splits,
        learner.name,
        learner.params,
        learner.stop,
        learner.patience,
        learner.parallelism,
    )
    return Outcome(oof_scores(result, spec.targets, spec.seeds, spec.metric), result)


def run(
    spec: Experiment, rows: DataFrame, submission_path: str | None = None, features_path: str | None = None
) -> Outcome:
    """United raw rows to scores, and a submission if a path is given.

    The feature table is stored (at ``features_path``, or in the shared folder)
    and read from there; :func:`run_stored` trains on it again without making it anew.
    """
    return _finish(spec, feature_table(spec, rows, features_path), submission_path)


def run_stored(spark: SparkSession, spec: Experiment, features_path: str, submission_path: str | None = None) -> Outcome:
    """Train and score on a feature table that an earlier run has stored."""
    return _finish(spec, FeatureTable.load(spark, features_path), submission_path)


def _finish(spec: Experiment, table: FeatureTable, submission_path: str | None) -> Outcome:
    outcome = train_and_score(spec, table)
    if submission_path:
        write_submission(outcome.result.test, spec.targets, submission_path)
    return outcome
