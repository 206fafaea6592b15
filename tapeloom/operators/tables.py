"""Relational steps between reports and the rows of their tables."""

from pyspark.sql import functions as F

from tapeloom.operators.spread import spread_join

REPORT_KEY = ["source", "market", "report_date"]


def report_keys(reports):
    """Distinct report keys with the number of reports; reads three columns only."""
    return reports.groupBy(*REPORT_KEY).agg(F.count("*").alias("n"))


def market_days(keys):
    """Distinct (market, report_date): what a report table really depends on."""
    return keys.select("market", "report_date").distinct()


def join_split(reports, split_ref):
    """Reports with their split; a key listed twice gives the report twice."""
    return spread_join(reports, split_ref, REPORT_KEY, ["report_id"])


def report_items(reports, instruments):
    """Every report (or market day) with the instruments of its market, list order kept."""
    return reports.join(instruments, "market")


def dedupe_keep_first(frame, keys, order):
    """First row per ``keys`` in the order of ``order``; NULL keys are equal.

    A minimum over (order, rest) combines before the shuffle, so copies of a row meet as
    one row per task however many there are. ``order`` columns must not be NULL.
    """
    rest = [c for c in frame.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    kept = frame.groupBy(*keys).agg(first)
    return kept.select(*[c if c in keys else F.col(f"_first.{c}") for c in frame.columns])


def rejected_reports(reports):
    """Reports that cannot have a table, with the ``reason``: no date that parses, or no market.

    With a ``passage`` column, a missing text is a reason too.
    """
    reason = F.when(F.col("report_date").isNull(), "date").when(F.col("market").isNull(), "market")
    if "passage" in reports.columns:
        reason = reason.when(F.col("passage").isNull(), "text")
    return reports.withColumn("reason", reason).where(F.col("reason").isNotNull())


def report_outcomes(reports, tables):
    """Every report with its ``outcome``: ``table``, ``no data``, or why it was rejected."""
    day = ["market", "report_date"]
    rejected = rejected_reports(reports)
    sound = reports.where(F.col("report_date").isNotNull() & F.col("market").isNotNull())
    if "passage" in reports.columns:
        sound = sound.where(F.col("passage").isNotNull())
    tabled = tables.select(*day).distinct().withColumn("_found", F.lit(True))
    counts = report_keys(sound).groupBy(*day).agg(F.sum("n").alias("n"))
    joined = spread_join(sound, tabled, day, ["report_id"], how="left", counts=counts)
    outcome = F.when(F.col("_found"), "table").otherwise("no data")
    return joined.withColumn("outcome", outcome).drop("_found").unionByName(
        rejected.withColumnRenamed("reason", "outcome")
    )


def reports_without_data(reports, tables):
    """Reports with a date and a market whose market day has no table rows.

    Reports without either are in ``rejected_reports``; the two and the reports with a table
    add up to all reports.
    """
    reports = reports.where(F.col("report_date").isNotNull() & F.col("market").isNotNull())
    day = ["market", "report_date"]
    keys = report_keys(reports)
    missing = market_days(keys).join(tables.select(*day).distinct(), day, "left_anti")
    counts = keys.groupBy(*day).agg(F.sum("n").alias("n"))
    return spread_join(reports, missing, day, ["report_id"], counts=counts)
