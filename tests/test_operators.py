"""Operators against brute force on small made-up relations."""

import datetime as dt
import hashlib
import io
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import calendar, examples, prompts, ranges, render, spread, tables, tokens

START = dt.date(2020, 1, 1)


def day(offset):
    return START + dt.timedelta(days=offset)


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def test_spread_join_equals_join_with_a_hot_key(spark):
    rng = random.Random(5)
    big = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}") for i in range(900)]
    small = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(30)]
    left = spark.createDataFrame(big, "id int, k string")
    right = spark.createDataFrame(small, "k string, v int")
    for how in ("inner", "left"):
        got = spread.spread_join(left, right, ["k"], ["id"], how, rows_per_slice=20)
        assert rows_of(got, "id", "k", "v") == rows_of(left.join(right, "k", how), "id", "k", "v")


def test_spread_join_cuts_a_hot_key(spark):
    left = spark.range(1000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan = spread.spread_join(left, right, ["k"], ["id"], rows_per_slice=100)
    assert plan.count() == 1000
    assert "_slice" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_number_rows(spark):
    rng = random.Random(6)
    data = [(i, rng.choice("ab"), rng.randrange(5), rng.randrange(10**6)) for i in range(500)]
    frame = spark.createDataFrame(data, "id int, g string, c int, f int")
    got = rows_of(spread.number_rows(frame, ["g"], ["c"], ["f", "id"]), "id", "row_no")
    expected = []
    for g in "ab":
        ordered = sorted((r for r in data if r[1] == g), key=lambda r: (r[2], r[3], r[0]))
        expected += [(r[0], i) for i, r in enumerate(ordered, 1)]
    assert got == sorted(expected, key=repr)


@pytest.mark.parametrize("days,width", [(0, 1), (7, 8), (7, 3), (30, 32), (365, 8)])
def test_range_joins(spark, days, width):
    rng = random.Random(days)
    bars = [(rng.choice("xyz"), day(rng.randrange(900)), i) for i in range(300)]
    reports = [(i, rng.choice("xyz"), day(rng.randrange(900))) for i in range(40)]
    points = spark.createDataFrame(bars, "symbol string, trade_date date, bar int")
    asked = spark.createDataFrame(reports, "report_id int, symbol string, report_date date")
    expected = sorted(
        ((r[0], b[2]) for r in reports for b in bars
         if r[1] == b[0] and r[2] - dt.timedelta(days=days) <= b[1] <= r[2]),
        key=repr,
    )
    binned = ranges.interval_join(points, ranges.history_window(asked, days), ["symbol"], bin_days=width)
    assert rows_of(binned, "report_id", "bar") == expected
    assert rows_of(ranges.window_bars(asked, points, days, ["symbol"]), "report_id", "bar") == expected
    exploded = ranges.window_bars_exploded(asked, points, days, ["symbol"])
    assert rows_of(exploded, "report_id", "bar") == expected


def test_week_has_eight_days_and_may_leave_out_the_report_day(spark):
    bars = spark.createDataFrame([("x", day(i)) for i in range(30)], "symbol string, trade_date date")
    report = spark.createDataFrame([("x", day(20))], "symbol string, report_date date")
    assert ranges.window_bars(report, bars, 7, ["symbol"]).count() == 8
    assert ranges.window_bars(report, bars, 7, ["symbol"], include_report_day=False).count() == 7


def test_last_trading_days(spark):
    months = [(y, m) for y in range(2019, 2031) for m in range(1, 13)]
    frame = spark.createDataFrame(months, "y int, m int")
    for market, rule in {**calendar.EXPIRY_RULES, "Dairy": "next_month", "gold": "end"}.items():
        expiry = calendar.last_trading_day(F.col("y"), F.col("m"), F.lit(market))
        for y, m, got in frame.select("y", "m", expiry.alias("d")).collect():
            following = dt.date(y + m // 12, m % 12 + 1, 1)
            at = following - dt.timedelta(days=1)
            if rule == "last_weekday":
                while at.weekday() > 4:
                    at -= dt.timedelta(days=1)
            elif rule == "fifteenth":
                at = dt.date(y, m, 15)
            elif rule == "next_month":
                at = np.busday_offset(following, 0, roll="backward")
                at = np.busday_offset(at, 4).astype(dt.date)
            assert got == at, (market, y, m)


def test_known_expiry(spark):
    frame = spark.range(1).select(
        calendar.last_trading_day(F.lit(2021), F.lit(1), F.lit("dairy")).alias("d")
    )
    assert frame.first().d == dt.date(2021, 2, 5)


def test_contract_calendar(spark):
    listed = spark.createDataFrame(
        [(0, "corn", "Corn Future", "cme", "ZC"), (1, "corn", "Odd Future", "cme", "OD"),
         (2, "corn", "Index", "cme", None), (3, "oil", "Crude", "yahoo", "CL=F")],
        "ord int, market string, name string, data_source string, symbol string",
    )
    got = calendar.contract_calendar(listed, 2021, 2022)
    symbols = {r.name: r.symbols for r in calendar.symbols_per_product(got).collect()}
    assert symbols["Corn Future"] == ["ZCH1", "ZCK1", "ZCN1", "ZCU1", "ZCZ1", "ZCH2", "ZCK2", "ZCN2", "ZCU2", "ZCZ2"]
    assert len(symbols["Odd Future"]) == 24
    assert set(symbols) == {"Corn Future", "Odd Future"}


def test_calendar_span(spark):
    row = spark.range(1).select(
        calendar.calendar_years("2021-06-01", "2023-04-30").alias("years"),
        calendar.price_start("2021-06-01").alias("start"),
    ).first()
    assert row.years == [2021, 2022, 2023, 2024] and row.start == dt.date(2019, 6, 2)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_active_contracts(spark, n):
    rng = random.Random(n)
    contracts = [(b, f"{b}{i}", day(rng.randrange(300))) for b in ("A", "B") for i in range(25)]
    items = [(i, rng.choice(["A", "B", "C"]), "name", day(rng.randrange(-20, 320))) for i in range(60)]
    listed = spark.createDataFrame(contracts, "base_symbol string, symbol string, expiration_date date")
    asked = spark.createDataFrame(items, "item int, symbol string, name string, report_date date")
    expected = []
    for item, base, _, when in items:
        alive = sorted((e, s) for b, s, e in contracts if b == base and e > when)[:n]
        expected += [(item, s, rank) for rank, (_, s) in enumerate(alive, 1)]
    got = calendar.active_contracts(asked, listed, n)
    assert rows_of(got, "item", "contract_symbol", "rank") == sorted(expected, key=repr)


def test_labels(spark):
    active = spark.createDataFrame(
        [("Corn Future", 1, dt.date(2021, 3, 15)), ("Corn Future", 3, dt.date(2021, 7, 15))],
        "name string, rank int, expiration_date date",
    )
    got = [r.label for r in calendar.label_contracts(active).orderBy("rank").collect()]
    assert got == ["Corn Future (front month) (March)", "Corn Future (third month) (July)"]


def test_dedupe_keeps_first_and_takes_nulls_as_equal(spark):
    frame = spark.createDataFrame(
        [("a", None, 2, 5.0), ("a", None, 1, 7.0), ("a", "s", 3, 1.0), ("a", "s", 4, None)],
        "k string, s string, seq int, v double",
    )
    got = tables.dedupe_keep_first(frame, ["k", "s"], ["seq"])
    assert rows_of(got, "k", "s", "seq", "v") == sorted([("a", None, 1, 7.0), ("a", "s", 3, 1.0)], key=repr)


def draw(seed, unique):
    return hashlib.md5(f"{seed}|{unique}".encode()).hexdigest()


def example_frame(spark, sizes):
    data, at = [], 0
    for group, size in sizes.items():
        for i in range(size):
            data.append((at, "s", group, day(i // 3).isoformat(), day(i // 3), f"text {at}"))
            at += 1
    return data, spark.createDataFrame(
        data, "example_id int, source string, market string, date string, report_date date, passage string"
    )


def test_samples(spark):
    data, frame = example_frame(spark, {"few": 2, "even": 3, "many": 50})
    got = examples.sample_examples(frame, ["market", "source"], 3, "9")
    expected = []
    for group in ("few", "even", "many"):
        ids = [r[0] for r in data if r[2] == group]
        if len(ids) > 3:
            ids = sorted(ids, key=lambda i: draw("9", i))[:3]
        expected += [(group, i, place) for place, i in enumerate(ids, 1)]
    assert rows_of(got, "market", "example_id", "place") == sorted(expected, key=repr)


def test_leaving_out_the_own_date(spark):
    data, frame = example_frame(spark, {"few": 4, "some": 9, "many": 60})
    n = 3
    spares = examples.spare_examples(frame, ["market", "source"], n, "9")
    assert spares.count() <= 3 * 2 * (n + 1)
    groups = examples.group_spares(spares, ["market", "source"])
    asked = frame.select("market", "source", "report_date").distinct().join(groups, ["market", "source"])
    got = asked.select(
        "market", "report_date",
        F.transform(examples.leave_out(F.col("spares"), F.col("report_date"), n), lambda x: x["report"]).alias("t"),
    )
    for market, own, texts in got.collect():
        ids = [r[0] for r in data if r[2] == market and r[4] != own]
        if len(ids) > n:
            ids = sorted(ids, key=lambda i: draw("9", i))[:n]
        assert texts == [f"text {i}" for i in ids], (market, own)


def test_printed_blocks(spark):
    _, frame = example_frame(spark, {"few": 2})
    sampled = examples.sample_examples(frame, ["market", "source"], 2)
    groups = examples.group_examples(sampled, ["market", "source"])
    block = groups.select(examples.format_examples(F.col("examples"), "report").alias("b")).first().b
    assert block == (
        "Report Example 1:\nMarket: few\nDate: 2020-01-01\nReport:\ntext 0\n---\n"
        "Report Example 2:\nMarket: few\nDate: 2020-01-01\nReport:\ntext 1\n---"
    )


def test_prompt_without_examples(spark):
    frame = spark.createDataFrame([("gold", "1/2/2020", "T")], "market string, date string, table_data string")
    none = F.lit(None).cast("string")
    got = prompts.assemble_prompt(frame, F.lit("Do it."), none, none).first().formatted_prompt
    assert got == (
        "Do it.\n\nInput:\nMarket: gold\nDate: 1/2/2020\nTable Data:\nT\n\n"
        "Generate a report based on the table data above."
    )


def test_context_without_table(spark):
    frame = spark.createDataFrame([("I", "d", "T"), ("I", "d", ""), ("I", "d", None)], "i string, d string, t string")
    got = [r.c for r in frame.select(prompts.format_context(F.col("i"), F.col("d"), F.col("t")).alias("c")).collect()]
    assert got == ["Instruction: I\nGenerate report for date d\nTable:\nT\nReport:", "Instruction: I\n", "Instruction: I\n"]


def random_tables(seed):
    rng = random.Random(seed)
    kinds = [
        lambda: round(rng.uniform(0, 5000), 2),
        lambda: round(rng.uniform(-50, 50), 4),
        lambda: float(rng.randint(0, 10 ** rng.randint(1, 12))),
        lambda: rng.uniform(0, 1e-7),
        lambda: None,
        lambda: rng.uniform(0, 100),
        lambda: -float(rng.randint(10**6, 10**8)),
        lambda: 0.0,
        lambda: round(rng.uniform(1e6, 3e6), 2),
    ]
    for group in range(300):
        pools = [[rng.choice(kinds) for _ in range(rng.randint(1, 2))] for _ in range(5)]
        for i in range(rng.randint(1, 6)):
            values = [None if rng.random() < 0.15 else rng.choice(pool)() for pool in pools]
            name = rng.choice(["Gold", "WTI Crude Oil (front month) (May)", "x"])
            yield (group, i, day(rng.randrange(900)), name, rng.choice([None, "ZCH3"]), *values)


def test_tables_print_as_a_data_frame_does(spark):
    data = list(random_tables(3))
    numbers = ["open", "high", "low", "close", "volume"]
    names = ["g", "row_no", "trade_date", "product", "symbol", *numbers]
    types = ["int", "int", "date", "string", "string"] + ["double"] * 5
    frame = spark.createDataFrame(data, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    got = {r.g: r.table_data for r in render.render_table(frame, ["g"]).collect()}
    for group, part in pd.DataFrame(data, columns=names).groupby("g"):
        part = part.sort_values("row_no").drop(columns=["g", "row_no"])
        part.columns = list(render.BAR_HEADERS.values())
        part[part.columns[3:]] = part[part.columns[3:]].astype(float)
        stored = pd.read_csv(io.StringIO(part.to_csv(index=False)))
        assert got[group] == stored.to_string(index=False)


def test_long_decimals_print_as_a_data_frame_does(spark):
    rng = random.Random(9)
    data = [(g, i, day(i), "x", None, *[round(rng.uniform(0, 100), d) for d in (7, 9, 7, 9, 5)]) for g in range(150) for i in range(3)]
    numbers = ["open", "high", "low", "close", "volume"]
    names = ["g", "row_no", "trade_date", "product", "symbol", *numbers]
    types = ["int", "int", "date", "string", "string"] + ["double"] * 5
    frame = spark.createDataFrame(data, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    got = {r.g: r.table_data for r in render.render_table(frame, ["g"]).collect()}
    for group, part in pd.DataFrame(data, columns=names).groupby("g"):
        part = part.drop(columns=["g", "row_no"])
        part.columns = list(render.BAR_HEADERS.values())
        assert got[group] == pd.read_csv(io.StringIO(part.to_csv(index=False))).to_string(index=False)


def words(text):
    return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in text.split()]


def load_words():
    return lambda text: [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in text.split()]


def test_encoding_native_and_plugged_in(spark):
    texts = ["a b  c\n\nd", "", "  ", "héllo \t wörld", "x" * 500]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for tokenizer in (None, load_words):
        got = {r.t: r.ids for r in tokens.encode_text(frame, "t", "ids", tokenizer).collect()}
        assert got == {t: words(t) for t in texts}


def test_budget_mask_and_filter(spark):
    assert tokens.context_budget() == 3584
    assert tokens.context_budget(100, 20, 7) == 7
    data = [(i, list(range(i)), list(range(2 * i))) for i in (1, 4, 10)]
    frame = spark.createDataFrame(data, "id int, input_ids array<bigint>, labels array<bigint>")
    assert rows_of(tokens.filter_overlength(frame, 12), "id") == [(1,), (4,)]
    assert tokens.filter_overlength(frame, 12, skip=False).count() == 3
    cut = tokens.attention_mask(tokens.truncate_tokens(frame, 8, 5))
    got = {r.id: (r.input_ids, r.labels, r.attention_mask) for r in cut.collect()}
    assert got[10] == ([0, 1, 2], [0, 1, 2, 3, 4], [1, 1, 1])
    assert got[1] == ([0], [0, 1], [1])
