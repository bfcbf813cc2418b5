"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)

Each query runs twice, planning included, and the faster run counts, so that compiling
its code for the first time does not. The tables have one split each, so their rows are
dealt out over the cores where the work on a row is heavy.
"""

from __future__ import annotations

import json
import os
import time

from lumenfold.catalog import inputs
from lumenfold.catalog import queries as catalog
from lumenfold.plans import clear_stage
from lumenfold.session import local_session

HEADLINE = (
    "word_count char_moments set_difference dense_to_coo top_tokens word_frequencies two_pass_sample hash_sample "
    "hash_sample_stream word_regression word_regression_controlled feature_regression last_rating support_filter "
    "item_neighbours predict_ratings fill_group_mean zip_join panel_mean prepared_by_year prepared_by_entity "
    "pair_similarity entity_neighbours"
).split()


def measure(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    catalog.ALL[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.ALL) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = local_session()
    inputs.PARTITIONS = spark.sparkContext.defaultParallelism
    times = {name: min(measure(spark, folder, name) for _ in range(2)) for name in names}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    clear_stage(spark)
    spark.stop()


if __name__ == "__main__":
    main()
