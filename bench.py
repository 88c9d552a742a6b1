"""Time the headline queries; print one JSON line.

Each query is run once to warm up and then ``RUNS`` times; the figure is the
median. Results go to Spark's ``noop`` sink, so every row and column is
computed. Queries that store a table in between include that.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from veilframe import Policy, pseudonymize  # noqa: E402
from veilframe.catalogue import QUERIES  # noqa: E402

RUNS = 3
HEADLINE = (
    "mask",
    "mask_documents",
    "part_delete",
    "round_half_up",
    "encrypt",
    "profile_columns",
    "profile_where",
    "top_bottom",
    "micro_aggregation",
    "random_number_in_range",
    "random_text_shape",
    "random_texts",
    "all_treatments",
    "token_join",
    "m2m_join",
    "concat_key_join",
    "composite_join",
    "hot_key_join",
    "text_table_round_trip",
    "link_then_policy",
)


def random_texts(spark, folder):
    """The treatment alone, without the check of its result that the query makes."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return pseudonymize(documents, Policy.from_dict({"text": ["Random"]}), seed=3)


OWN = {"random_texts": random_texts}


def run(spark, folder, name):
    start = time.perf_counter()
    (OWN.get(name) or QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, folder, name)
        times[name] = round(statistics.median(run(spark, folder, name) for _ in range(RUNS)), 4)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
