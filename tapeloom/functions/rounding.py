"""Two rounding rules on doubles, both native column expressions."""

from pyspark.sql import functions as F


def round_scaled(column, digits):
    """Scale, round half to even, unscale: the array-library rule for vendor bars."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def round_exact(column, digits):
    """Round the exact binary value, ties to even: the scalar rule for cash indices.

    ``x * 10^n`` may land on a tie although the exact product lies beside it. Splitting
    both factors into halves gives the product's rounding error exactly, and its sign
    decides such a tie.
    """
    scale = float(10**digits)
    splitter = 134217729.0  # 2^27 + 1, halves a 53-bit significand
    scale_high = splitter * scale - (splitter * scale - scale)
    scale_low = scale - scale_high
    high = splitter * column - (splitter * column - column)
    low = column - high
    product = column * scale
    error = low * scale_low - (
        ((product - high * scale_high) - low * scale_high) - high * scale_low
    )
    floor = F.floor(product).cast("double")
    tie = (product - floor) == 0.5
    nearest = (
        F.when(tie & (error > 0), floor + 1.0)
        .when(tie & (error < 0), floor)
        .otherwise(F.rint(product))
    )
    return nearest / scale
