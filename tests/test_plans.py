"""Whole plans: results against a plain loop, and the physical shapes they must keep."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks.relations import LANDED, Relations
from tapeloom.operators import spread
from tapeloom.operators.calendar import contract_calendar
from tapeloom.operators.examples import sample_examples, spare_examples
from tapeloom.operators.tables import report_keys
from tapeloom.operators.tokens import encode_text
from tapeloom.plans import dataset, extraction, stages, tokenization
from tapeloom.settings import HISTORY_SPANS
from tapeloom.sources import scans, vendors

FOLDER = "/root/testdata/sf0.001"
MONTHS = "January February March April May June July August September October November December".split()


def day(offset):
    return dt.date(2021, 1, 1) + dt.timedelta(days=offset)


def world(seed):
    """Random instruments, bars with repeated listings, and reports."""
    rng = random.Random(seed)
    instruments = [
        (0, "corn", "Corn Future", "cme", "ZC"),
        (1, "corn", "Corn Index", "cme", None),
        (2, "gold", "Gold", "yahoo", "XAU"),
        (3, "gold", "Dollar", "yahoo", "DX"),
        (4, "corn", "Dollar", "yahoo", "DX"),
        (5, "gold", "Gold again", "yahoo", "XAU"),
        (6, "empty", "Nothing", "yahoo", "NONE"),
    ]
    contracts = [f"ZC{c}1" for c in "HKNUZ"]
    bars = []
    for offset in range(0, 330):
        for product, symbol, seq in [("Gold", "XAU", 2), ("Dollar", "DX", 3), ("Dollar", "DX", 4),
                                     ("Gold again", "XAU", 5), ("Corn Index", None, 1)]:
            if rng.random() < 0.7:
                bars.append((day(offset), product, symbol, *[float(rng.randint(1, 99)) for _ in range(5)], seq))
        for symbol in contracts:
            if rng.random() < 0.5:
                bars.append((day(offset), "Corn Future", symbol, *[float(rng.randint(1, 99)) for _ in range(5)], 0))
    reports = [
        (i, rng.choice(["Daily", "Weekly"]), rng.choice(["corn", "gold", "empty"]), day(rng.randrange(-5, 340)))
        for i in range(60)
    ]
    return instruments, bars, reports


def loop_tables(instruments, bars, contracts, reports, days):
    """Table rows per report, one report and one instrument at a time."""
    expected = {}
    for report, _, market, when in reports:
        rows, seen = [], set()
        for ord_, _, name, source, symbol in (i for i in instruments if i[1] == market):
            window = sorted(
                (b for b in bars if when - dt.timedelta(days=days) <= b[0] <= when), key=lambda b: (b[8], b[0])
            )
            if source == "cme" and symbol:
                alive = sorted((e, s) for s, e in contracts if s[:-2] == symbol and e > when)[:3]
                found = []
                for rank, (expiry, contract) in enumerate(alive):
                    label = f"{name} ({['front', 'second', 'third'][rank]} month) ({MONTHS[expiry.month - 1]})"
                    found += [(b[0], label, *b[2:8]) for b in window if b[2] == contract]
                found.sort(key=lambda b: (b[1], b[0]))
            elif symbol:
                found = [b[:8] for b in window if b[2] == symbol]
            else:
                found = [b[:8] for b in window if b[1] == name]
            for row in found:
                if row[:3] not in seen:
                    seen.add(row[:3])
                    rows.append(row)
        expected[report] = rows
    return expected


@pytest.mark.parametrize("seed,days", [(1, 7), (2, 1), (3, 30)])
def test_tables_equal_a_loop(spark, seed, days):
    instruments, bars, reports = world(seed)
    listed = spark.createDataFrame(instruments, "ord int, market string, name string, data_source string, symbol string")
    priced = spark.createDataFrame(
        bars, "trade_date date, product string, symbol string, open double, high double, low double,"
        " close double, volume double, seq int"
    )
    asked = spark.createDataFrame(reports, "report_id bigint, source string, market string, report_date date")
    contracts = contract_calendar(listed, 2021, 2022)
    pairs = [(r.symbol, r.expiration_date) for r in contracts.collect()]
    got = {}
    for row in extraction.report_market_table(asked, listed, contracts, priced, days).orderBy("row_no").collect():
        got.setdefault(row.report_id, []).append(tuple(row[c] for c in extraction.BAR_COLUMNS))
    expected = loop_tables(instruments, bars, pairs, reports, days)
    assert got == {k: v for k, v in expected.items() if v}
    keys = report_keys(asked)
    spans = extraction.market_span_tables(keys, listed, contracts, priced, HISTORY_SPANS)
    alone = extraction.market_day_tables(keys, listed, contracts, priced, HISTORY_SPANS["1month"])
    month = spans.where(F.col("span") == "1month").drop("span")
    assert month.exceptAll(alone).count() == 0 and alone.exceptAll(month).count() == 0


def plan_of(frame):
    return re.sub(r"#\d+L?", "", frame._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def relations(spark):
    return Relations(spark, FOLDER)


SET_ORIENTED = (
    "active_contracts window_bars window_bars_exploded report_market_table market_span_tables render_table "
    "build_dataset training_pairs tokenize_dataset join_split reports_without_data attach_examples"
).split()


@pytest.mark.parametrize("name", SET_ORIENTED)
def test_no_loop_joins_and_no_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def test_only_the_plugged_in_tokenizer_runs_python(spark, relations):
    plan = plan_of(encode_text(relations.table("documents"), "text", "ids", catalog.whitespace_tokenizer()))
    assert "ArrowEvalPython" in plan


def test_sampling_limits_before_the_shuffle(relations):
    plan = plan_of(sample_examples(relations.example(), ["market", "source"], 2))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_keys_read_three_columns(relations):
    plan = plan_of(report_keys(relations.report()))
    assert "ReadSchema: struct<source:string,market:string,report_date:date>" in plan


def test_tables_and_text_share_one_shuffle(relations):
    plan = plan_of(catalog.rendered_days(relations))
    after_join = plan[: plan.index("interval" if "interval" in plan else "Join")]
    assert after_join.count("Exchange") == 1 and "REPARTITION_BY_COL" in after_join


def test_window_bounds_reach_the_bar_scan(relations):
    plan = plan_of(catalog.rendered_days(relations))
    scan = next(line for line in plan.splitlines() if "FileScan parquet [trade_date" in line)
    assert "trade_date >= Subquery" in scan


def test_encoding_is_not_repeated_by_the_filter(spark):
    plan = plan_of(catalog.QUERIES["tokenize_dataset"](spark, FOLDER))
    assert not re.search(r"Filter \(.*split\(", plan)


def test_all_spans_come_from_one_range_join(spark):
    plan = plan_of(catalog.QUERIES["market_span_tables"](spark, FOLDER))
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    joins = [line for line in final.splitlines() if "Join" in line and "_bin" in line and "trade_date" in line]
    assert len(joins) == 1


def test_a_market_day_table_is_encoded_below_the_joins(spark, relations):
    """No join, sort or exchange carries table texts; only the project above their scan has them."""
    rows = catalog.tokenized_reports(relations)
    texts = [line for line in plan_of(rows).splitlines() if "table_data" in line]
    assert texts and all(re.search(r"FileScan|ColumnarToRow|Project|Filter", line) for line in texts)
    assert not any("passage" in line for line in texts)


def test_example_lists_meet_keys_without_texts(relations):
    """(market, source) is met by narrow keys; tables and lists are put beside them afterwards."""
    rows = catalog.built(relations, n_data=1).select("report_id", "prompts.formatted_prompt")
    for line in plan_of(rows).splitlines():
        if "Join" in line and re.search(r"Join.*\[(split, )?market, source, _slice\]", line):
            assert "table_data" not in line and "passage" not in line


def test_the_dataset_runs_once_for_numbered_pairs(spark, relations):
    plan = plan_of(catalog.QUERIES["training_pairs"](spark, FOLDER))
    assert "passage" not in plan and "Window [sum" in plan  # the pairs are read from files


def token_rows(frame):
    return sorted((r.split, r.report_id, r.input_ids, r.attention_mask, r.labels) for r in frame.collect())


def load_stems():
    """Ids of every blank-separated word by its first letters; ids of a word may be several."""
    return lambda text: [i for w in text.split() for i in ([len(w), ord(w[0])] if len(w) % 2 else [ord(w[-1])])]


@pytest.mark.parametrize("tokenizer", [None, load_stems])
@pytest.mark.parametrize("skip", [True, False])
def test_parts_encoded_once_equal_whole_texts(spark, tokenizer, skip):
    keys = "source string, market string, report_date date"
    days = [dt.date(2021, 1, i) for i in (1, 2, 3)]
    reports = spark.createDataFrame(
        [(i, "s", m, d, f"01/{d.day:02d}/2021", text) for i, (m, d, text) in enumerate([
            ("corn", days[0], "up a bit"), ("corn", days[0], " \n down  by\tmuch "), ("corn", days[1], ""),
            ("gold", days[0], "word " * 40), ("gold", days[2], "no table"), ("corn", days[1], None), ("empty", days[0], "none"),
        ])],
        f"report_id long, {keys}, date string, passage string",
    )
    split_ref = spark.createDataFrame(
        [("s", m, d, split) for m in ("corn", "gold", "empty") for d in days for split in ("train", "test")], f"{keys}, split string"
    )
    rendered = spark.createDataFrame(
        [("corn", days[0], "open  close\n 1.0   2.0"), ("corn", days[1], "x " * 90), ("gold", days[0], " \n "), ("empty", days[0], "")],
        "market string, report_date date, table_data string",
    )
    instruction = spark.createDataFrame([("Do it:\n1. well",)], "instruction string")
    examples = reports.withColumnRenamed("report_id", "example_id")
    whole = dataset.build_dataset(reports, split_ref, rendered, examples, instruction)
    budget = dict(max_sequence=60, max_output=12, skip_overlength=skip, tokenizer=tokenizer)
    expected = token_rows(tokenization.tokenize_dataset(whole.where("report IS NOT NULL"), **budget))
    inputs = reports.where("passage IS NOT NULL"), split_ref, rendered, instruction
    assert token_rows(tokenization.tokenize_reports(*inputs, **budget, parts_at_blanks=True)) == expected
    assert token_rows(tokenization.tokenize_reports(*inputs, **budget, ordered=True)) == expected
    assert len(expected) in ((6, 8) if skip else (10,))
    if skip:  # a pair without a target is no pair
        assert token_rows(tokenization.tokenize_reports(reports, *inputs[1:], **budget, parts_at_blanks=True)) == expected


def test_reports_are_landed_without_texts(relations):
    relations.report().count()
    texts = [key[2] for key, (_, schema) in LANDED.items() if {"passage", "text"} & set(schema.names)]
    assert texts and set(texts) <= {"passage"}  # once a document
    assert "Join" not in plan_of(relations.report_key())


def test_report_texts_meet_small_sides_without_a_shuffle(relations):
    plan = plan_of(catalog.built(relations, n_data=1))
    assert "_slice" not in plan and plan.count("BroadcastHashJoin") >= 4


@pytest.mark.parametrize("exclude_self", [False, True])
def test_draws_from_narrow_rows_and_large_sides_give_the_same(spark, monkeypatch, exclude_self):
    keys = "source string, market string, report_date date"
    days = [dt.date(2021, 1, i) for i in range(1, 5)]
    sizes = {"none": 1, "few": 2, "even": 3, "one more": 4, "many": 30}
    asked = [(m, i % 4) for m, n in sizes.items() for i in range(n)]
    reports = spark.createDataFrame(
        [(i, "s", m, days[d], str(days[d]), f"text {i}") for i, (m, d) in enumerate(asked)] + [(2, "s", "few", days[1], str(days[1]), "text 2")],
        f"report_id long, {keys}, date string, passage string",
    )
    split_ref = spark.createDataFrame([("s", m, d, "train") for m in sizes for d in days], f"{keys}, split string")
    rendered = spark.createDataFrame([(m, d, f"{m} {d}") for m in sizes for d in days], "market string, report_date date, table_data string")
    instruction = spark.createDataFrame([("Do it",)], "instruction string")
    examples = reports.withColumnRenamed("report_id", "example_id")
    pick = spare_examples if exclude_self else sample_examples
    drawn = dataset.report_example_rows(examples, 3, "7", pick)
    whole = pick(examples, ["market", "source"], 3, "7")
    columns = ["market", "example_id", "place"]
    assert sorted(drawn.select(columns).collect()) == sorted(whole.select(columns).collect())
    made = []
    for size in (spread.BROADCAST_SIZE, 0):
        monkeypatch.setattr(spread, "BROADCAST_SIZE", size)
        for ordered in (False, True):
            rows = dataset.build_dataset(reports, split_ref, rendered, examples, instruction, 2, 3, exclude_self=exclude_self, ordered=ordered)
            made.append(sorted(rows.select("split", "report_id", "date", "prompts.formatted_prompt").collect()))
    assert len(made[0]) == len(asked) + 1 and all(m == made[0] for m in made)


def test_stored_tables_prune_folders(spark, relations):
    path = catalog.written_report_tables(relations)
    plan = plan_of(scans.scan_report_tables(spark, path, "1week", "test"))
    assert re.search(r"PartitionFilters: \[[^\]]*span[^\]]*split", plan)


def test_pipeline_over_files(spark, tmp_path):
    instruments, bars, reports = world(4)
    (tmp_path / "instruments.json").write_text(json.dumps([
        {"market": m, "data_source": s, "name": n, "symbol": y or "", "days_offset": 0} for _, m, n, s, y in instruments
    ]))
    texts = [f"{s}\t{m}\t{d.isoformat()}\t\"Report {i}\nsecond line\"" for i, s, m, d in reports]
    (tmp_path / "reports.tsv").write_text("\n".join(["source\tmarket\tdate\tpassage", *texts]) + "\n", encoding="utf-16")
    keys = sorted({(s, m, d.isoformat()) for _, s, m, d in reports})
    splits = [f"{s},{m},{d},{('train', 'validate', 'test')[i % 3]}" for i, (s, m, d) in enumerate(keys)]
    (tmp_path / "splits.csv").write_text("\n".join(["source,market,date,split", *splits]) + "\n")
    (tmp_path / "instruction.txt").write_text("Do it.\n\n")
    config = stages.Config(
        root=str(tmp_path / "out"),
        instruments=str(tmp_path / "instruments.json"),
        reports=str(tmp_path / "reports.tsv"),
        split_reference=str(tmp_path / "splits.csv"),
        instruction=str(tmp_path / "instruction.txt"),
        examples=str(tmp_path / "reports.tsv"),
        first_year=2021,
        last_year=2022,
        data_examples=1,
        report_examples=2,
    )
    priced = spark.createDataFrame(
        bars, "trade_date date, product string, symbol string, open double, high double, low double,"
        " close double, volume double, seq int"
    )
    for _ in range(2):  # a second run leaves the same tables
        stages.run(spark, config, {"all": vendors.conform_bars(priced)})
    contracts = spark.read.parquet(config.path("contracts"))
    pairs = [(r.symbol, r.expiration_date) for r in contracts.collect()]
    with_rows = [k for k, v in loop_tables(instruments, bars, pairs, reports, 7).items() if v]
    built = scans.scan_dataset(spark, config.path("dataset", "1week"), file_format="parquet").collect()
    assert len(built) == len(with_rows) == sum(r.n_rows for r in stages.split_counts(spark, config).collect())
    sample = built[0]
    assert sample.prompts.formatted_prompt.startswith("Do it.\n\nData Examples:\nData Example 1:\nMarket: ")
    assert sample.table_data in sample.prompts.formatted_prompt
    assert sample.report.endswith("\nsecond line")
    tokens = scans.scan_tokens(spark, config.path("tokens", "1week"), "hashed-words").collect()
    assert len(tokens) == len(built)
    assert all(len(t.input_ids) == len(t.attention_mask) for t in tokens)
