"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Every
query runs in full into a sink that discards the rows; the time includes
building and planning it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from leavewatch.operators.cleaning import clean_events
from leavewatch.operators.users import user_features
from leavewatch.plans import churn_job
from leavewatch.plans.queries import QUERIES
from leavewatch.plans.settings import RECOMMENDED
from leavewatch.sources.sample_log import read_sample_log
from leavewatch.sources.shared_storage import cut_lineage, fresh_path, scratch

WHOLE_JOB = "whole_job"  # raw log to user table, model search and scores
LARGE_LOG = "user_features_large_log"  # the user table of a stored log of LARGE_EVENTS events
LARGE_EVENTS = 10_000_000

HEADLINE = [
    "profile_missing", "clean_events", "label_index", "one_hot_events", "session_rollup",
    "user_features", "user_features_extended", "user_features_wide", "sql_user_features",
    "user_agent_features", "churn_phase", "eda_user_summary", "group_mean_ci",
    "correlation_pairs", "minmax_scaled", "user_bucket_assign", "scan_bucket_pruned",
    "scan_json_roundtrip", "sink_user_features", "classification_metrics", "churn_logreg_cv",
    "churn_elastic_cv", "grid_results", "correlation_pairs_unguarded", "user_features_incremental",
    "label_dictionary_growth", "user_label_vectors", WHOLE_JOB, LARGE_LOG,
]


def large_log(spark: SparkSession, folder: str) -> DataFrame:
    """The clean sample log under as many sets of user ids as it takes, stored as Parquet."""
    log = clean_events(read_sample_log(spark, folder), seconds=False)
    copies = -(-LARGE_EVENTS // log.count())
    each = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    return cut_lineage(log.withColumn("copy", each).withColumn("userId", F.concat_ws("-", "copy", "userId")).drop("copy"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    # Python workers import the package too, wherever this is started.
    os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("leavewatch-bench")
               .config("spark.sql.shuffle.partitions", cores)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g")))
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").selectExpr("count(*)").collect()

    seconds = {}
    with scratch(spark):
        chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
        for name in chosen:
            stored = large_log(spark, folder) if name == LARGE_LOG else None  # made before the clock starts
            start = time.perf_counter()
            if name == WHOLE_JOB:
                fit, = churn_job.run(read_sample_log(spark, folder), fresh_path(spark, "features"))
                fit.summary().collect()
            elif name == LARGE_LOG:
                user_features(stored).write.format("noop").mode("overwrite").save()
            else:
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
