"""Joins and numbering that hold when one key owns a large share of all rows."""

from pyspark.sql import Window, functions as F

from tapeloom.settings import own_shuffles, scratch_dir

ROWS_PER_SLICE = 250_000
BROADCAST_SIZE = 1 << 28  # characters, and 100 more a row, up to which a frame is copied to every executor


def settled(frame, label):
    """``frame`` written once and read back, so that what makes it runs once."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    with own_shuffles(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def is_small(frame, chars):
    """Whether ``frame`` can be copied to every executor: counted, not estimated."""
    size = frame.agg(F.sum(F.coalesce(chars, F.lit(0)) + 100)).first()[0] or 0
    return size <= BROADCAST_SIZE


def spread_join(big, small, on, spread_by, how="inner", counts=None, rows_per_slice=None):
    """Equi-join in which a key with many rows in ``big`` is cut into slices.

    Rows of a hot key go to slices by the hash of ``spread_by``, columns that tell its rows
    apart, and the ``small`` rows of that key are copied once per slice. All other keys
    have one slice.
    The result is that of ``big.join(small, on, how)`` for inner and left joins.

    ``counts`` may bring (on..., n) where it is known already. At most
    rows / rows_per_slice keys can be hot: 400,000 keys for 10^11 rows, which bounds the
    broadcast whatever the data look like.
    """
    rows_per_slice = rows_per_slice or ROWS_PER_SLICE
    if counts is None:
        counts = big.groupBy(*on).agg(F.count("*").alias("n"))
    hot = F.broadcast(
        counts.where(F.col("n") > rows_per_slice).select(
            *on, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("_slices")
        )
    )
    slices = F.coalesce("_slices", F.lit(1))
    left = big.join(hot, on, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(*spread_by), slices).cast("int")
    )
    right = small.join(hot, on, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    joined = left.drop("_slices").join(right.drop("_slices"), [*on, "_slice"], how)
    return joined.drop("_slice")


def number_rows(frame, keys, coarse, fine, name="row_no"):
    """1-based position within ``keys`` in the order of ``coarse`` then ``fine``.

    Rows are numbered inside each coarse value and lifted by the count of all earlier
    ones, so no task has to hold or sort a whole group of ``keys``.
    """
    cells = frame.groupBy(*keys, *coarse).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(*coarse).rowsBetween(
        Window.unboundedPreceding, -1
    )
    lifts = cells.withColumn("_lift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, *coarse).orderBy(*fine)
    numbered = frame.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(lifts, [*keys, *coarse])
        .withColumn(name, F.col("_lift") + F.col("_inside"))
        .drop("_lift", "_inside")
    )
