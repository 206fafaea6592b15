"""Scalar rules against plain Python."""

import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tapeloom.functions import dates, rounding, text


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(spark, values, kind, expression):
    rows = column(spark, values, kind).select("i", expression(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows)]


def test_round_scaled_is_numpy_round(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1e4, 1e4) for _ in range(3000)] + [2.675, 1.115, 0.125, -0.375]
    for digits in (2, 4):
        got = evaluate(spark, values, "double", lambda c: rounding.round_scaled(c, digits))
        assert got == [float(np.round(v, digits)) for v in values]


def test_round_exact_is_python_round(spark):
    rng = random.Random(2)
    ties = [n + k / 8 for n in range(200) for k in (1, 3, 5, 7)]
    near = [round(rng.uniform(0, 300), 3) for _ in range(5000)]
    values = ties + near + [2.675, 1.115, 1.005, -2.675, 0.0, 1e9 + 0.005]
    got = evaluate(spark, values, "double", lambda c: rounding.round_exact(c, 2))
    assert got == [round(v, 2) for v in values]


def test_dates_parse_leniently(spark):
    values = ["2021-03-04", "3/4/2021", "03/04/2021", "2021-02-30", "2/30/2021", "3/4/2021 x", "", None, "junk"]
    expected = [dt.date(2021, 3, 4)] * 3 + [None] * 6
    assert evaluate(spark, values, "string", dates.parse_report_date) == expected


def test_two_digit_years(spark):
    values = ["01/05/23", "1/5/68", "12/31/69", "6/30/99", "13/01/20"]
    expected = [dt.date(2023, 1, 5), dt.date(2068, 1, 5), dt.date(1969, 12, 31), dt.date(1999, 6, 30), None]
    assert evaluate(spark, values, "string", dates.parse_us_short) == expected


def test_business_days(spark):
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    for count in (1, 4, 7):
        got = evaluate(spark, days, "date", lambda c: dates.add_business_days(c, count))
        for day, result in zip(days, got):
            left, at = count, day
            while left:
                at += dt.timedelta(days=1)
                left -= at.weekday() < 5
            assert result == at


def test_text(spark):
    values = ["  lean  hog\t", "corn"]
    got = evaluate(spark, values, "string", lambda c: text.market_source(c, F.lit("Daily")))
    assert got == ["lean_hog-Daily", "corn-Daily"]
    assert evaluate(spark, [" \n a b \r\n"], "string", text.strip) == ["a b"]
    assert evaluate(spark, ["", None, "x"], "string", text.blank_to_null) == [None, None, "x"]
    assert evaluate(spark, ["org/name", "name"], "string", text.model_folder) == ["name", "name"]
    assert evaluate(spark, [2, 30], "int", text.yield_symbol) == ["TMUBMUSD02Y", "TMUBMUSD30Y"]


def test_rounding_keeps_missing(spark):
    got = evaluate(spark, [None, 1.0], "double", lambda c: rounding.round_exact(c, 2))
    assert got[0] is None and math.isclose(got[1], 1.0)


def test_report_dates_in_the_forms_of_files(spark):
    forms = ["2021-03-04", "3/4/2021", "2021/3/4", "20210304", "March 4, 2021", "Mar 4, 2021", "mar. 4 2021", "4 MARCH 2021",
             "4 Mar 2021", "2021-03-04 00:00:00", "2021-03-04T07:30", "2021-03-04T07:30:00.5Z", " 2021-03-04 "]
    other = ["soon", "", None, "2021-13-04", "2021-03-04 soon", "202103041"]
    rows = spark.createDataFrame([(x,) for x in forms + other], "d string")
    got = [r[0] for r in rows.select(dates.parse_report_date(F.col("d"))).collect()]
    assert got == [dt.date(2021, 3, 4)] * len(forms) + [None] * len(other)
