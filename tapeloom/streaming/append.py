"""Append-mode ingest for files that keep arriving.

Conforming bars is a stateless projection, so the batch transform runs on a file stream as
it is. Every landed file is appended once, which a plain append cannot promise on a rerun.
"""

from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.sources.scans import name_bars
from tapeloom.sources.vendors import conform_bars


def append_landed(spark, landing, path, checkpoint, vendor, seq):
    """Append the price files that landed since the last run; returns when they are in.

    ``path`` belongs to this stream, read it as a table of its own next to the batch one.
    """
    landed = spark.readStream.schema(schemas.BAR_FILE).option("header", True).csv(landing)
    bars = conform_bars(name_bars(landed), seq=seq).withColumn("vendor", F.lit(vendor))
    query = (
        bars.writeStream.format("parquet")
        .partitionBy("vendor")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query
