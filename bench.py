"""Time the headline operators; prints one JSON line.

Inputs (bars, reports, contracts ...) are landed first, as the pipeline finds them on
disk; that is ``setup``. Every operator is run once on the smallest test folder, so that
the JVM has compiled its code (``warmup``), then timed once over the whole tables into a
sink that takes all rows and columns. ``BENCH_QUERIES`` may name others from the catalog.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from checks.relations import Relations  # noqa: E402
from tapeloom.operators import prompts, tables  # noqa: E402
from tapeloom.plans import extraction  # noqa: E402
from tapeloom.settings import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
WARM_FOLDER = os.path.join(os.path.dirname(FOLDER), "sf0.001")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

# Whole texts and arrays go to the sink, not the digests the catalog compares.
HEADLINE = {
    "render_table": catalog.rendered_days,
    "build_dataset": catalog.built,
    "build_dataset_with_data_examples": lambda r: catalog.built(r, n_data=1),
    "training_pairs": lambda r: prompts.number_pairs(prompts.training_pairs(catalog.built(r))),
    # The spans timed in every round so far; the query itself makes all five.
    "market_span_tables_to_1month": lambda r: extraction.market_span_tables(
        tables.report_keys(r.report_key()), r.instrument(), r.contract(), r.bar(), {"1day": 1, "1week": 7, "1month": 30}
    ),
    "tokenize_dataset": catalog.tokenized_reports,
}
NAMES = (
    "report_market_table render_table build_dataset build_dataset_with_data_examples training_pairs "
    "tokenize_dataset market_span_tables_to_1month market_span_tables active_contracts window_bars window_bars_exploded "
    "dedupe_keep_first sample_examples encode_text round_prices"
)


def timed(action):
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def land(relations):
    for name in ("instrument", "contract", "bar", "report", "split_ref"):
        getattr(relations, name)()
    catalog.rendered(relations)


def run(spark, folder, name):
    if name in HEADLINE:
        frame = HEADLINE[name](Relations(spark, folder))
    else:
        frame = catalog.QUERIES[name](spark, folder)
    frame.write.format("noop").mode("overwrite").save()


def main():
    names = os.environ.get("BENCH_QUERIES", NAMES).split()
    spark = local_session(CPUS, shuffle_partitions=CPUS, memory="20g")
    spark.sparkContext.setLogLevel("ERROR")

    def warm():
        land(Relations(spark, WARM_FOLDER))
        for name in names:
            run(spark, WARM_FOLDER, name)

    warmup = timed(warm)
    setup = timed(lambda: land(Relations(spark, FOLDER)))
    seconds = {name: timed(lambda: run(spark, FOLDER, name)) for name in names}
    print(
        json.dumps(
            {
                "metric": "total wall time of headline operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup": setup,
                "warmup": warmup,
                "sf": os.path.basename(FOLDER).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
