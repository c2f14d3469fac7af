"""The whole job: raw log in, feature table and scored churn model out.

    python -m leavewatch.plans.churn_job --log LOG --features TABLE

On a cluster, submit this file with the package as ``--py-files``. The log may be JSON lines or, with ``--format parquet``, a columnar copy.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leavewatch import fixed_values as fixed
from leavewatch.operators.cleaning import (
    clean_events,
    deny_users,
    drop_zero_columns,
    fill_registration,
)
from leavewatch.operators.users import (
    browser_user_features,
    user_features,
    user_features_extended,
    without_nulls,
)
from leavewatch.plans import elastic_net, tree_grid
from leavewatch.plans.modelling import (
    ChurnFit,
    Search,
    coefficient_table,
    feature_columns,
    fit_churn_model,
    fit_churn_models,
    logistic_search,
)
from leavewatch.plans.score_table import ScoreTable, ranked
from leavewatch.schema import EVENT_SCHEMA
from leavewatch.sources.event_log import read_features, write_features
from leavewatch.sources.shared_storage import fresh_path, scratch

ESTIMATORS = ("logistic", "trees")


@dataclass(frozen=True)
class FeatureOptions:
    """How the user table is made.

    ``extended`` adds sign-up pages and leaves no null; ``agents`` adds one
    column per browser label, of which a caller may allow ``max_agents``.
    """

    extended: bool = False
    agents: bool = True
    max_agents: int | None = None
    denied: Sequence[str] = ()
    drop_zeros: bool = False


def build_features(log: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """User features of a raw log, which is scanned once."""
    clean = clean_events(log, seconds=False, artist=False, agent=False)
    clean = deny_users(clean, options.denied)
    if options.agents:
        filled = fill_registration(clean) if options.extended else clean
        features = browser_user_features(filled, signup_pages=options.extended,
                                         max_labels=options.max_agents)
        features = without_nulls(features) if options.extended else features
    else:
        features = user_features_extended(clean) if options.extended else user_features(clean)
    return drop_zero_columns(features) if options.drop_zeros else features


Fit = ChurnFit | elastic_net.ElasticFit | tree_grid.TreeFit


def run(log: DataFrame, features_path: str, options: FeatureOptions = FeatureOptions(),
        searches: Sequence[Search] | None = None, **fit_options) -> list[Fit]:
    """Write the user table, then search, fit and score models on it.

    Without ``searches``, penalised logistic regression over the large grid.
    The fits read tables in the shared folder; run the job within
    :func:`leavewatch.sources.shared_storage.scratch` to have them deleted.
    """
    write_features(build_features(log, options), features_path)
    table = read_features(log.sparkSession, features_path)
    if searches is not None:
        return fit_churn_models(table, searches, **fit_options)
    return [logistic_fit(table, **fit_options)]


def logistic_fit(table: DataFrame, folds: int = 3, scores: ScoreTable | None = None) -> Fit:
    """All points and folds at once; one by one where there are too many features for that."""
    if len(feature_columns(table)) > elastic_net.MAX_FEATURES:
        return fit_churn_model(table, logistic_search(), folds=folds)
    return elastic_net.fit_elastic_models(table, elastic_net.penalty_points(), folds=folds, scores=scores)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="User churn from an event log")
    parser.add_argument("--log", required=True)
    parser.add_argument("--features", required=True)
    parser.add_argument("--format", default="json")
    parser.add_argument("--extended", action="store_true")
    parser.add_argument("--folds", type=int, default=3)
    parser.add_argument("--estimators", nargs="+", choices=ESTIMATORS, default=["logistic"])
    parser.add_argument("--scores", help="where scores are kept; a job that is started again goes on from there")
    parser.add_argument("--rounds", type=int, default=tree_grid.ROUNDS)
    parser.add_argument("--stop-percent", type=int, default=0)
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    log = spark.read.schema(EVENT_SCHEMA).format(given.format).load(given.log)
    with scratch(spark):
        write_features(build_features(log, FeatureOptions(extended=given.extended)), given.features)
        table = read_features(spark, given.features)
        scores = ScoreTable(spark, given.scores or fresh_path(spark, "scores"))
        for name in given.estimators:
            if name == "logistic":
                fit = logistic_fit(table, given.folds, scores)
                if isinstance(fit, ChurnFit):
                    fit.grid.show(200, truncate=False)
                    coefficient_table(fit).show(100, truncate=False)
                else:
                    fit.coefficient_table().show(100, truncate=False)
            else:
                fit = tree_grid.fit_tree_models(table, tree_grid.tree_points(), scores, folds=given.folds,
                                                rounds=given.rounds, metric="f1", stop_percent=given.stop_percent)
            fit.summary().show(truncate=False)
        ranked(scores.read()).show(200, truncate=False)


if __name__ == "__main__":
    main()
