"""Futures contract calendar: listed months, symbols and last trading days."""

from pyspark.sql import Window, functions as F

from tapeloom.functions.dates import add_business_days, last_weekday_of_month
from tapeloom.operators.ranges import interval_join

# Month codes January to December, and listed contract months per product.
MONTH_CODES = "FGHJKMNQUVXZ"
CONTRACT_MONTHS = {
    "Live Cattle Future": [2, 4, 6, 8, 10, 12],
    "Feeder Cattle Future": [1, 3, 4, 5, 8, 9, 10, 11],
    "Lean Hogs Future": [2, 4, 5, 6, 7, 8, 10, 12],
    "Corn Future": [3, 5, 7, 9, 12],
    "Chicago SRW Wheat Future": [3, 5, 7, 9, 12],
    "KC HRW Wheat Future": [3, 5, 7, 9, 12],
    "Class III Milk Future": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12],
    "Class IV Milk Future": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12],
    "Soybeans Future": [1, 3, 5, 7, 8, 9, 11],
    "Soybean Oil Future": [1, 3, 5, 7, 8, 9, 10, 12],
    "Soybean Meal Future": [1, 3, 5, 7, 8, 9, 10, 12],
}
# Expiry rule per lower-case market; all others end with the month.
EXPIRY_RULES = {
    "cattle": "last_weekday",
    "lean hog": "last_weekday",
    "corn": "fifteenth",
    "wheat": "fifteenth",
    "soybean": "fifteenth",
    "dairy": "next_month",
}


def contract_months(frame, product, month_table=CONTRACT_MONTHS):
    """One row per valid contract month of ``product``; an unknown product has all twelve."""
    every = F.sequence(F.lit(1), F.lit(12))
    months = every
    if month_table:
        entries = [
            part
            for name, listed in month_table.items()
            for part in (F.lit(name), F.array(*[F.lit(m) for m in listed]))
        ]
        months = F.coalesce(F.create_map(*entries)[F.col(product)], every)
    return frame.withColumn("contract_month", F.explode(months))


def last_trading_day(year, month, market, expiry_rules=EXPIRY_RULES):
    """Expiry of the contract of a month under the rule of its market."""
    first = F.make_date(year, month, F.lit(1))
    end = F.last_day(first)
    days = {
        "last_weekday": last_weekday_of_month(first),
        "fifteenth": F.date_add(first, 14),
        "next_month": add_business_days(F.date_add(end, 1), 4),
    }
    by_rule = [
        F.when(F.lower(market).isin([m for m, r in expiry_rules.items() if r == rule]), day)
        for rule, day in days.items()
    ]
    return F.coalesce(*by_rule, end)


def contract_symbol(base, year, month):
    """Base symbol, month code, last digit of the year."""
    code = F.substring(F.lit(MONTH_CODES), month, F.lit(1))
    return F.concat(base, code, (year % 10).cast("string"))


def calendar_years(report_start, report_end):
    """Years to list contracts for: through the year 365 days after the last report."""
    start = F.lit(report_start).cast("date")
    end = F.date_add(F.lit(report_end).cast("date"), 365)
    return F.sequence(F.year(start), F.year(end))


def price_start(report_start, days=730):
    """First day to load futures prices for."""
    return F.date_sub(F.lit(report_start).cast("date"), days)


def contract_calendar(
    instruments, start_year, end_year, month_table=CONTRACT_MONTHS, expiry_rules=EXPIRY_RULES
):
    """Every contract of the futures instruments listed from ``start_year`` to ``end_year``.

    A pure generator: instruments are exploded by year and month, nothing is shuffled.
    """
    futures = instruments.where((F.col("data_source") == "cme") & F.col("symbol").isNotNull())
    years = F.explode(F.sequence(F.lit(start_year), F.lit(end_year)))
    dated = contract_months(futures.withColumn("contract_year", years), "name", month_table)
    year, month = F.col("contract_year"), F.col("contract_month")
    return dated.select(
        "ord",
        "market",
        "name",
        F.col("symbol").alias("base_symbol"),
        contract_symbol(F.col("symbol"), year, month).alias("symbol"),
        "contract_year",
        "contract_month",
        last_trading_day(year, month, F.col("market"), expiry_rules).alias("expiration_date"),
    )


def symbols_per_product(contracts):
    """Contract symbols of each product in calendar order.

    A product has at most twelve contracts a year, so its list is short.
    """
    entry = F.struct("contract_year", "contract_month", "symbol")
    listed = contracts.groupBy("name").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return listed.select("name", F.col("entries.symbol").alias("symbols"))


TERM_BIN = 32  # days; contracts expire about once a month


def contract_terms(contracts, n):
    """The dates between which a contract is one of the first ``n`` unexpired ones.

    In expiry order, a contract enters when the one ``n`` places before it expires and
    leaves when it expires itself. Its rank on a day counts the contracts just before it
    that are still alive. So top-n per day needs no sort of (day, contract) pairs at all.
    """
    listed = contracts.dropDuplicates(["base_symbol", "symbol", "expiration_date"])
    order = Window.partitionBy("base_symbol").orderBy("expiration_date", "symbol")
    ahead = [F.lag("expiration_date", k).over(order) for k in range(1, n)]
    return listed.select(
        "base_symbol",
        F.col("symbol").alias("contract_symbol"),
        "expiration_date",
        F.lag("expiration_date", n).over(order).alias("enters"),
        F.array(*ahead).cast("array<date>").alias("ahead"),
    )


def active_contracts(items, contracts, n=3):
    """First ``n`` contracts expiring strictly after each item's report date, with rank.

    ``items`` carry ``report_date`` and the futures ``symbol`` (the base symbol). A base
    with no unexpired contract gives no rows. Terms are binned by time, so an item meets the
    contracts of its own weeks only, and a symbol with a long calendar is many keys.
    """
    first = items.agg(F.min("report_date")).scalar()  # where the terms of the first contracts begin
    terms = contract_terms(contracts, n).withColumns(
        {"_from": F.greatest("enters", first), "_upto": F.date_sub("expiration_date", 1)}
    )
    dated = terms.where(F.col("_from") <= F.col("_upto")).withColumnRenamed("base_symbol", "symbol")
    alive = interval_join(items, dated, ["symbol"], "report_date", "_from", "_upto", TERM_BIN)
    before = F.size(F.filter("ahead", lambda expiry: expiry > F.col("report_date")))
    return alive.withColumn("rank", before + 1).drop("enters", "ahead", "_from", "_upto")


RANK_LABELS = ["front month", "second month", "third month"]  # Fixed values.


def label_contracts(active):
    """Product label: name, rank label and the month the contract expires in."""
    place = F.element_at(F.array(*[F.lit(x) for x in RANK_LABELS]), F.col("rank"))
    month = F.date_format("expiration_date", "MMMM")
    label = F.concat("name", F.lit(" ("), place, F.lit(") ("), month, F.lit(")"))
    return active.withColumn("label", label)
