"""Range joins: dated rows against inclusive date intervals."""

from pyspark.sql import functions as F

from tapeloom.functions.dates import day_bin


def interval_join(points, intervals, on, day="trade_date", start="start_date", end="end_date", bin_days=8):
    """Pairs with equal ``on`` columns and ``day`` inside ``[start, end]``.

    Intervals are copied to every ``bin_days`` bin they touch and joined on the bin, so
    the join is an equi-join, a busy key is cut by time, and candidates stay within
    interval + one bin. A row has one bin, so no pair is found twice.
    """
    binned = points.withColumn("_bin", day_bin(F.col(day), bin_days))
    touched = F.sequence(day_bin(F.col(start), bin_days), day_bin(F.col(end), bin_days))
    spread = intervals.withColumn("_bin", F.explode(touched))
    near = binned.join(spread, [*on, "_bin"])
    return near.where(F.col(day).between(F.col(start), F.col(end))).drop("_bin")


def exploded_join(points, intervals, on, day="trade_date", start="start_date", end="end_date"):
    """Same pairs by one copy of the interval per day: a pure equi-join for short spans."""
    days = F.explode(F.sequence(F.col(start), F.col(end)))
    return points.join(intervals.withColumn(day, days), [*on, day])


def history_window(frame, history_days, include_report_day=True):
    """``[report_date - history_days, report_date]`` in calendar days, both ends in."""
    last = F.col("report_date") if include_report_day else F.date_sub("report_date", 1)
    return frame.withColumns(
        {"start_date": F.date_sub("report_date", history_days), "end_date": last}
    ).where(F.col("start_date") <= F.col("end_date"))


def history_spans(frame, spans):
    """One row per input row and named span, with the span's window."""
    pairs = F.array(*[F.struct(F.lit(k).alias("span"), F.lit(v).alias("days")) for k, v in spans.items()])
    named = frame.select("*", F.inline(pairs))
    return history_window(named, F.col("days")).drop("days")


def window_bars(reports, bars, history_days, keys, include_report_day=True):
    """Bars of each report's history for the ``keys`` the report rows carry."""
    windows = history_window(reports, history_days, include_report_day)
    return interval_join(bars, windows, keys, bin_days=history_days + 1)


def window_bars_exploded(reports, bars, history_days, keys, include_report_day=True):
    """``window_bars`` as a pure equi-join on key and day."""
    windows = history_window(reports, history_days, include_report_day)
    return exploded_join(bars, windows, keys)
