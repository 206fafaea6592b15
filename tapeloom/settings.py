"""Session defaults and the one place that decides where scratch tables live."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

HISTORY_SPANS = {  # Fixed values: span name -> calendar days of history.
    "1day": 1,
    "1week": 7,
    "1month": 30,
    "1year": 365,
    "2year": 730,
}

SPLITS = ("train", "validate", "test")  # Fixed values.

# A market day's table, its prompt and the ids of common words come in many rows of a file: they are
# listed once a file as long as the list fits. Larger pages let the codec find what comes again.
COMPACT = {"compression": "zstd", "parquet.dictionary.page.size": 32 << 20, "parquet.page.size": 8 << 20}


def local_session(cores="*", shuffle_partitions=8, memory="8g"):
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tapeloom")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


@contextmanager
def own_shuffles(spark):
    """Shuffle files of what is written in here go when each write is done.

    Without it they stay until the driver's garbage is collected, those of all stages of a run
    at once. A write plans its own shuffles, so no other plan reads them.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_LOCAL = []  # the one temporary folder of this process; it goes when the process ends


def scratch_dir(spark, label):
    """A fresh folder for an intermediate table, on storage every executor can reach.

    ``spark.checkpoint.dir`` names the shared folder. Only a local-mode session, where
    driver and executors are one machine, may fall back to a temporary folder, which all
    its scratch tables share and which is removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tapeloom-{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="tapeloom-", ignore_cleanup_errors=True))
    return f"{_LOCAL[0].name}/{label}-{uuid.uuid4().hex}"
