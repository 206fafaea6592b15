"""Make this package importable in Python workers, wherever the driver was started from."""

import os
import tempfile
import zipfile

BATCH_ROWS = "500"  # rows of whole texts handed to Python at a time
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED = set()


def ship(spark):
    """Add the package's own modules to the session's Python files, once per application.

    A worker then imports them as modules and keeps what they cache from task to task. The
    archive is a file of the driver, which Spark serves to the executors. Batches for Python are
    made small enough for whole texts, unless the session has its own setting.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_CONF) == "10000":  # Spark's default, meant for short rows
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tapeloom-code-"))
    archive = os.path.join(folder, "tapeloom_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for here, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
