"""Small text expressions shared by readers, sinks and prompts."""

from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\x0b"


def blank_to_null(column):
    """Missing text is NULL everywhere; files write it as an empty field."""
    return F.when(column != "", column)


def strip(column):
    """Drop leading and trailing white space of any kind."""
    return F.btrim(column, F.lit(BLANKS))


def market_source(market, source):
    """Folder key of a report: runs of blanks in the market become one ``_``."""
    return F.concat_ws("-", F.regexp_replace(strip(market), r"\s+", "_"), source)


def model_folder(model):
    """Last segment of a model name."""
    return F.element_at(F.split(model, "/"), -1)


def yield_symbol(maturity):
    """Ticker of the constant-maturity yield of a whole number of years."""
    return F.format_string("TMUBMUSD%02dY", maturity)
