"""Reports to the price tables of their market and history, as one set-oriented plan."""

from pyspark.sql import Window, functions as F

from tapeloom.operators.calendar import active_contracts, label_contracts
from tapeloom.operators.ranges import history_window, interval_join
from tapeloom.operators.spread import spread_join
from tapeloom.operators.tables import (
    REPORT_KEY,
    dedupe_keep_first,
    join_split,
    market_days,
    report_items,
    report_keys,
)
from tapeloom.schemas import BAR_COLUMNS

BAR_KEY = ["trade_date", "product", "symbol"]


def first_listings(bars):
    """One bar per day, product and symbol: the listing that came first."""
    return dedupe_keep_first(bars, BAR_KEY, ["seq"])


def bars_in_reach(bars, days):
    """Bars between the first and the last day any window asks for.

    The two bounds are scalar subqueries, which reach the file scan, so row groups outside
    them are not read before the dedupe shuffles what is left.
    """
    first = days.agg(F.min("start_date")).scalar()
    last = days.agg(F.max("end_date")).scalar()
    return bars.where((F.col("trade_date") >= first) & (F.col("trade_date") <= last))


def route_items(items, contracts, n_contracts):
    """How the bars of each item are found: ``by`` symbol or product, and the ``key``.

    Futures look for the symbols of their active contracts and carry a label, other items
    for their symbol, items without symbol for their name.
    """
    futures = (F.col("data_source") == "cme") & F.col("symbol").isNotNull()
    keep = [c for c in items.columns if c not in ("data_source", "name", "symbol")]
    active = label_contracts(active_contracts(items.where(futures), contracts, n_contracts))
    contracted = active.select(
        *keep, F.lit("symbol").alias("by"), F.col("contract_symbol").alias("key"), "label"
    )
    plain = items.where(F.col("symbol").isNull() | (F.col("data_source") != "cme")).select(
        *keep,
        F.when(F.col("symbol").isNull(), "product").otherwise("symbol").alias("by"),
        F.coalesce("symbol", "name").alias("key"),
        F.lit(None).cast("string").alias("label"),
    )
    return contracted.unionByName(plain)


def findable_bars(bars):
    """Every bar under its symbol and under its product, so that one join serves all routes."""
    ways = F.array(
        F.struct(F.lit("symbol").alias("by"), F.col("symbol").alias("key")),
        F.struct(F.lit("product").alias("by"), F.col("product").alias("key")),
    )
    return bars.select("*", F.inline(F.filter(ways, lambda way: way["key"].isNotNull())))


def extract_bars(routed, bars, bin_days):
    """Bars of every routed item in its window; a contract label replaces the product."""
    found = interval_join(findable_bars(bars), routed, ["by", "key"], bin_days=bin_days)
    return found.drop("by", "key").withColumn("product", F.coalesce("label", "product"))


def extract_by_symbol(routed, bars, bin_days):
    """Bars of the items that are looked up by symbol."""
    return extract_bars(routed.where(F.col("by") == "symbol"), bars, bin_days)


def extract_by_product(routed, bars, bin_days):
    """Bars of the items that are looked up by product name, whatever the bars' symbol."""
    return extract_bars(routed.where(F.col("by") == "product"), bars, bin_days)


def market_day_rows(days, instruments, contracts, bars, n_contracts, bin_days):
    """Bars of each market day without repeats, and the window that puts them in table order.

    ``days`` carries (market, report_date, start_date, end_date). Everything after the range join
    is partitioned by market day once, so the ordered dedupe and the numbering share that one
    shuffle.
    """
    group = ["market", "report_date"]
    items = report_items(days, instruments)
    routed = route_items(items, contracts, n_contracts)
    found = extract_bars(routed, bars_in_reach(bars, days), bin_days)
    rows = found.select(*group, "ord", "label", "seq", *BAR_COLUMNS).repartition(*group)
    unique = dedupe_keep_first(rows, [*group, *BAR_KEY], ["ord", "seq"])
    # Instruments in list order; contracts by label and day; other bars by listing and day.
    order = Window.partitionBy(*group).orderBy(
        "ord",
        F.col("label").asc_nulls_first(),
        F.when(F.col("label").isNull(), F.col("seq")),
        "trade_date",
        "product",
        F.col("symbol").asc_nulls_last(),
    )
    return unique, order


def market_tables(days, instruments, contracts, bars, n_contracts=3, bin_days=8):
    """Table rows of each market day, numbered in table order."""
    unique, order = market_day_rows(days, instruments, contracts, bars, n_contracts, bin_days)
    numbered = unique.withColumn("row_no", F.row_number().over(order))
    return numbered.select("market", "report_date", "row_no", *BAR_COLUMNS)


def market_day_tables(keys, instruments, contracts, bars, history_days=7, n_contracts=3):
    """``market_tables`` over one history span for the market days of ``report_keys``."""
    days = history_window(market_days(keys), history_days)
    return market_tables(days, instruments, contracts, bars, n_contracts, history_days + 1)


def market_span_tables(keys, instruments, contracts, bars, spans, n_contracts=3, bin_days=32):
    """``market_day_tables`` for several named spans, with the column ``span``, from one range join.

    All windows of a day end on that day, so the longest holds the others, and copies of a bar
    have its day and so its spans. Bars are found and deduped once, for the longest span; a
    row's number in a span is the count of rows up to it that are young enough. Rows are
    copied to their spans at the very end.
    """
    spans = {name: days for name, days in spans.items() if days >= 0}
    days = history_window(market_days(keys), max(spans.values(), default=0))
    unique, order = market_day_rows(days, instruments, contracts, bars, n_contracts, bin_days)
    age = F.datediff("report_date", "trade_date")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Shorter spans count among the rows of the longest; sums are NULL outside a span.
    places = {
        name: F.when(age <= n, F.sum(F.when(age <= n, 1)).over(upto).cast("int")) for name, n in spans.items()
    }
    numbered = unique.withColumn(
        "_places", F.array(*[F.struct(F.lit(k).alias("span"), v.alias("row_no")) for k, v in places.items()])
    )
    copied = F.inline(F.filter("_places", lambda place: place["row_no"].isNotNull()))
    return numbered.select("market", "report_date", *BAR_COLUMNS, copied).select(
        "span", "market", "report_date", "row_no", *BAR_COLUMNS
    )


def report_market_table(
    reports, instruments, contracts, bars, history_days=7, n_contracts=3, split_ref=None
):
    """Table rows of every report.

    A table depends on market and date alone, so each is made once and then fanned out
    to its reports; a day with very many reports is cut into slices.
    """
    keys = report_keys(reports)
    tables = market_day_tables(keys, instruments, contracts, bars, history_days, n_contracts)
    slim = reports.select("report_id", *REPORT_KEY)
    if split_ref is not None:
        slim = join_split(slim, split_ref)
    return fan_out(slim, tables, keys)


def keyed_report_tables(reports, split_ref, tables):
    """Table rows per distinct (split, source, market, report_date)."""
    keys = report_keys(reports).drop("n").join(split_ref.distinct(), REPORT_KEY)
    return keys.join(tables, ["market", "report_date"])


def fan_out(reports, by_day, keys):
    """Every report with the rows of its market day; a day with very many reports is cut into slices."""
    counts = keys.groupBy("market", "report_date").agg(F.sum("n").alias("n"))
    return spread_join(reports, by_day, ["market", "report_date"], ["report_id"], counts=counts)


def items_of_reports(reports, instruments):
    """``report_items`` made once per market day, whose number the calendar bounds."""
    keys = report_keys(reports)
    return fan_out(reports, report_items(market_days(keys), instruments), keys)


def contracts_of_reports(reports, instruments, contracts, n_contracts=3):
    """Active contracts of every report with rank and label, found once per market day."""
    keys = report_keys(reports)
    futures = (F.col("data_source") == "cme") & F.col("symbol").isNotNull()
    items = report_items(market_days(keys), instruments.where(futures))
    return fan_out(reports, label_contracts(active_contracts(items, contracts, n_contracts)), keys)


def bars_of_contracts(bars, active):
    """Bars whose symbol is one of the active contracts', whatever their day."""
    symbols = active.select(F.col("contract_symbol").alias("symbol")).distinct()
    return spread_join(bars, symbols, ["symbol"], ["trade_date", "product"])
