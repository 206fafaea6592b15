"""Lenient date parsing and calendar arithmetic."""

from pyspark.sql import functions as F

ISO = (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d")
US_LONG = (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy")
US_SHORT = (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy")
SLASHED = (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d")
COMPACT = (r"^\d{8}$", "yyyyMMdd")
_MONTH, _SHORT_MONTH = r"[A-Za-z]{4,9}", r"[A-Za-z]{3}"
NAMED = (  # March 4, 2021; Mar 4 2021; 4 March 2021
    (rf"^{_MONTH} \d{{1,2}},? \d{{4}}$", "MMMM d[,] yyyy"),
    (rf"^{_SHORT_MONTH}\.? \d{{1,2}},? \d{{4}}$", "MMM[.] d[,] yyyy"),
    (rf"^\d{{1,2}} {_MONTH},? \d{{4}}$", "d MMMM[,] yyyy"),
    (rf"^\d{{1,2}} {_SHORT_MONTH}\.?,? \d{{4}}$", "d MMM[.][,] yyyy"),
)
TIME = r"[T ]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|[+-]\d{2}:?\d{2})?$"


def parse_date(column, *forms):
    """Date in the first form that fits, NULL when none does.

    The shape is tested before parsing, so a value is never parsed by its prefix only.
    """
    text = F.trim(column)
    parsed = [
        F.when(text.rlike(shape), F.to_date(F.try_to_timestamp(text, F.lit(pattern))))
        for shape, pattern in forms
    ]
    return F.coalesce(*parsed)


def parse_iso(column):
    return parse_date(column, ISO)


def parse_us_short(column):
    """``m/d/yy`` with two-digit years 69-99 in the last century."""
    day = parse_date(column, US_SHORT)
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def parse_report_date(column):
    """Report dates: ISO, US, compact or with the month's name, a time of day left off.

    Month names are English, in any case. NULL where no form fits.
    """
    text = F.regexp_replace(F.initcap(F.lower(F.trim(column))), "(?i)" + TIME, "")
    forms = ISO, US_LONG, SLASHED, COMPACT, *NAMED
    # Bound once as an array's item: written out, the text would be repeated for every form.
    return F.transform(F.array(text), lambda t: parse_date(t, *forms))[0]


def add_business_days(day, count):
    """``count`` Monday-Friday steps after ``day``; a weekend start counts from Friday."""
    weekday = F.weekday(day)
    past_friday = F.greatest(weekday - 4, F.lit(0))
    weekends = F.floor((weekday - past_friday + count) / 5).cast("int")
    return F.date_add(day, count + 2 * weekends - past_friday)


def last_weekday_of_month(day):
    """The last Monday-Friday day of the month of ``day``."""
    end = F.last_day(day)
    return F.date_sub(end, F.greatest(F.weekday(end) - 4, F.lit(0)))


def day_bin(day, width):
    """Number of the ``width``-day bin a date falls in."""
    return F.floor(F.unix_date(day) / width).cast("int")
