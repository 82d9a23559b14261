"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line with the seconds of each."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom.functions.hashing import FAST  # noqa: E402
from clickloom.operators import encoding  # noqa: E402
from clickloom.session import new_session  # noqa: E402
from workload import views  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

_SPEC = encoding.EncoderSpec(method=FAST)


def _encode(spark, sf):
    return encoding.add_wide_positions(views.features(spark, sf), _SPEC)


def _encode_buckets(spark, sf):
    return encoding.add_bucket_cross_ids(views.features(spark, sf), _SPEC)


BENCH = {
    **{name: QUERIES[name] for name in (
        "positions", "read_time_by_item", "new_user_impressions", "labelled_positions", "item_slots", "user_slots",
        "full_samples", "reply_slots", "training_log_progress",
    )},
    "encode_wide": _encode,
    "encode_bucket_crosses": _encode_buckets,
    **{name: QUERIES[name] for name in (
        "batches", "throughput_by_steps", "sampled_by_steps", "evaluation_metrics", "areas_overall", "train_wide",
    )},
}


def run(query, spark, sf) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = new_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["positions"], spark, sf)  # start the JVM side once before the clock runs
    times = {name: round(run(query, spark, sf), 3) for name, query in BENCH.items()}
    rows = views.table(spark, sf, "lineitem").count()
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf)).removeprefix("sf"),
        "encoded_rows_per_sec": round(rows / times["encode_wide"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
