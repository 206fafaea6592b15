"""Readers, writers and vendor shapes, written and read back."""

import datetime as dt
import json
import time
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.operators import prompts
from tapeloom.settings import scratch_dir
from tapeloom.sources import scans, sinks, vendors
from tapeloom.streaming.append import append_landed


def bars(spark, rows):
    return spark.createDataFrame(rows, "trade_date date, product string, symbol string, close double, seq int")


def listed(spark):
    return spark.createDataFrame(
        [(0, "equity", "Gold", "yahoo", "XAU"), (1, "currency", "Gold", "yahoo", "XAU"),
         (2, "treasury", "United States 12-Year Yield", "wsj", "B"),
         (3, "treasury", "United States 2-Year Yield", "wsj", "A")],
        "ord int, market string, name string, data_source string, symbol string",
    )


def test_appending_again_replaces_a_vendor(spark, tmp_path):
    path = str(tmp_path / "bars")
    a = vendors.conform_bars(bars(spark, [(dt.date(2020, 1, 1), "p", "s", 1.0, 0)]))
    b = vendors.conform_bars(bars(spark, [(dt.date(2020, 1, 2), "q", None, 2.0, 1)]))
    for _ in range(2):
        sinks.append_bars(path, {"one": a, "two": b})
    sinks.append_bars(path, {"one": a.withColumn("close", F.lit(9.0)), "three": b.where("seq > 5")})
    got = sorted((r.vendor, r.close) for r in scans.scan_bars(spark, path).collect())
    assert got == [("one", 9.0), ("two", 2.0)]


def test_raw_landing_replaces_a_product(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = bars(spark, [(dt.date(2020, 1, 1), "p", "s", 1.0, 0), (dt.date(2020, 1, 1), "q", "s", 2.0, 0)])
    sinks.land_raw(rows, path)
    sinks.land_raw(rows.where("product = 'p'").withColumn("close", F.lit(5.0)), path)
    assert sorted((r["product"], r["close"]) for r in spark.read.parquet(path).collect()) == [("p", 5.0), ("q", 2.0)]


def test_reports_with_quotes_tabs_and_lines(spark, tmp_path):
    path = tmp_path / "reports.tsv"
    passage = 'He said "up"\nthen\tdown, über 中'
    quoted = '"' + passage.replace('"', '""') + '"'
    lines = ["source\tmarket\tdate\tpassage", f"Daily\tlean hog\t2021-03-04\t{quoted}", "W\tgold\t3/5/2021\tplain"]
    path.write_text("\n".join(lines) + "\n", encoding="utf-16")
    got = sorted(tuple(r) for r in scans.scan_reports(spark, str(path)).collect())
    assert got == [
        ("Daily", "lean hog", "2021-03-04", passage, dt.date(2021, 3, 4)),
        ("W", "gold", "3/5/2021", "plain", dt.date(2021, 3, 5)),
    ]


def test_instrument_order_and_blank_symbols(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text(json.dumps([
        {"market": "m", "data_source": "yahoo", "name": "b", "symbol": "B", "days_offset": 0},
        {"market": "m", "data_source": "cme", "name": "a", "symbol": "", "days_offset": 0},
    ], indent=1))
    got = [(r.ord, r["name"], r.symbol) for r in scans.scan_instruments(spark, str(path)).orderBy("ord").collect()]
    assert got == [(0, "b", "B"), (1, "a", None)]


def test_quotes_are_rounded_per_listing(spark):
    quotes = spark.createDataFrame(
        [(dt.date(2020, 1, 1), "XAU", 1.23456, 2.0, 0.5, 1.00005, 10.0)],
        "Date date, Symbol string, Open double, High double, Low double, Close double, Volume double",
    )
    got = sorted((r.seq, r["product"], r.open, r.close) for r in vendors.ingest_quotes(quotes, listed(spark)).collect())
    assert got == [(0, "Gold", 1.23, 1.0), (1, "Gold", 1.2346, float(np.round(1.00005, 4)))]


def test_yields_match_the_first_name_that_holds_the_maturity(spark, tmp_path):
    for years in ("2", "12", "7"):
        (tmp_path / f"us_{years}_year_bond_yield.csv").write_text(
            "Date, Open, High, Low, Close\n03/31/23, 4.1, 4.2, 4.0, 4.15\nbad, 1, 1, 1, 1\n"
        )
    (tmp_path / "other.csv").write_text("Date, Open, High, Low, Close\n03/31/23, 1, 1, 1, 1\n")
    got = vendors.ingest_yields(spark, str(tmp_path), listed(spark), seq=9)
    rows = sorted((r.symbol, str(r.trade_date), r["product"], r.close, r.volume) for r in got.collect())
    twelve = "United States 12-Year Yield"
    assert rows == [
        ("TMUBMUSD02Y", "2023-03-31", twelve, 4.15, None),
        ("TMUBMUSD02Y", "None", twelve, 1.0, None),
        ("TMUBMUSD12Y", "2023-03-31", twelve, 4.15, None),
        ("TMUBMUSD12Y", "None", twelve, 1.0, None),
    ]


def test_cash_index(spark, tmp_path):
    path = tmp_path / "index.csv"
    path.write_text("Date,Head,Value 1 \n03/04/2021,7,101.005\nn/a,7,2.675\n03/05/2021,7,\n")
    got = sorted(((str(r.trade_date), r.close, r["product"], r.symbol) for r in
                  vendors.ingest_cash_index(spark, str(path), "Index").collect()), key=repr)
    assert got == [("2021-03-04", round(101.005, 2), "Index", None), ("2021-03-05", None, "Index", None), ("None", 2.67, "Index", None)]


def test_conform_adds_what_is_missing(spark):
    frame = spark.createDataFrame([("2021-01-02 23:59:00", 1.5)], "at string, v double")
    stamped = frame.select(F.col("at").cast("timestamp").alias("ts_event"), F.col("v").alias("close"))
    got = vendors.conform_bars(stamped, vendors.FUTURES_RENAME, {"product": "P"}, seq=2)
    assert got.schema.fieldNames() == schemas.BAR.fieldNames()
    assert tuple(got.first()) == (dt.date(2021, 1, 2), "P", None, None, None, None, 1.5, None, 2)


def test_landed_files_are_appended_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    header = "Date,Product Name,Symbol,Open,High,Low,Close,Volume\n"
    (tmp_path / "landing").mkdir()
    for i in (1, 2):
        (tmp_path / "landing" / f"{i}.csv").write_text(f"{header}2021-01-0{i},P,,1,2,0.5,{i},\n")
        append_landed(spark, landing, out, state, "v", 0)
    append_landed(spark, landing, out, state, "v", 0)
    got = sorted((str(r.trade_date), r.symbol, r.close, r.vendor) for r in spark.read.parquet(out).collect())
    assert got == [("2021-01-01", None, 1.0, "v"), ("2021-01-02", None, 2.0, "v")]


class Conf:
    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_scratch_follows_the_shared_folder():
    shared = Session(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    assert scratch_dir(shared, "x").startswith("hdfs://shared/tapeloom-x-")
    with pytest.raises(ValueError):
        scratch_dir(Session(spark_master="yarn"), "x")
    own = [scratch_dir(Session(spark_master="local[2]"), "x") for _ in range(2)]
    assert own[0] != own[1] and all("/x-" in path for path in own)


def test_report_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("date\tmarket\tsource\tpassage\textra\n2021-03-04\tgold\tDaily\tup\tx\n", encoding="utf-16")
    got = [tuple(r) for r in scans.scan_reports(spark, str(tmp_path / "a.tsv")).collect()]
    assert got == [("Daily", "gold", "2021-03-04", "up", dt.date(2021, 3, 4))]
    (tmp_path / "b.csv").write_text("date,market,source\n2021-03-04,gold,Daily\n")
    with pytest.raises(ValueError, match="split"):
        scans.scan_split_reference(spark, str(tmp_path / "b.csv"))


def test_yields_are_read_by_the_header_of_their_file(spark, tmp_path):
    folder = tmp_path / "us_9_year_bond_yield.csv"
    folder.mkdir()
    (folder / "part.csv").write_text("Date,Open,High,Low,Close\n01/02/20,7,7,7,7\n")
    (tmp_path / "us_12_year_bond_yield.csv").write_text("Date, Open, High, Low, Close\n01/02/20,1,2,3,4\n")
    (tmp_path / "us_2_year_bond_yield.csv").write_text(" Close ,Date,Low,High,Open\r\n4,01/02/20,3,2,1\r\n\r\n")
    got = [(r.open, r.high, r.low, r.close) for r in vendors.ingest_yields(spark, str(tmp_path), listed(spark)).collect()]
    assert got == [(1.0, 2.0, 3.0, 4.0)] * 2


def test_yield_files_with_quoted_cells_and_layouts_of_their_own(spark, tmp_path):
    (tmp_path / "us_12_year_bond_yield.csv").write_text(
        'Date,Open,High,Low,Close\n03/04/21,"1,234.5",2,3,4\n03/05/21,"say ""x""",2,3,"4"\n'
    )
    (tmp_path / "us_2_year_bond_yield.csv").write_text(
        '\ufeff"Low", "Note, long" ,Close, "Date",Open\r\n3,"a, b",4," 03/04/21 ","1,234.5"\r\n,,,\r\n'
    )
    found = vendors.ingest_yields(spark, str(tmp_path), listed(spark)).collect()
    got = sorted(((r.symbol, str(r.trade_date), r.open, r.high, r.low, r.close) for r in found), key=repr)
    assert got == [
        ("TMUBMUSD02Y", "2021-03-04", 1234.5, None, 3.0, 4.0),
        ("TMUBMUSD02Y", "None", None, None, None, None),
        ("TMUBMUSD12Y", "2021-03-04", 1234.5, 2.0, 3.0, 4.0),
        ("TMUBMUSD12Y", "2021-03-05", None, 2.0, 3.0, 4.0),
    ]


def test_a_broken_instrument_list_fails(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"market": "m", "name": "b"')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        scans.scan_instruments(spark, str(tmp_path / "list.json")).collect()


def test_smaller_writes_replace_larger_ones(spark, tmp_path):
    rows = [("train", i, None, None, None, None, None, None, None) for i in range(3)] + [("test", 9, *[None] * 7)]
    made = spark.createDataFrame(rows, schemas.DATASET)
    for file_format in ("json", "parquet"):
        path = str(tmp_path / file_format)
        sinks.write_dataset(made, path, file_format)
        sinks.write_dataset(made.where("split = 'train'"), path, file_format)
        assert {r.split for r in scans.scan_dataset(spark, path, file_format=file_format).collect()} == {"train"}
    tokens = spark.createDataFrame([("train", 1, None, [1], [1], [2]), ("test", 2, None, [1], [1], [2])], "split string, report_id long, report_date date, input_ids array<long>, attention_mask array<long>, labels array<long>")
    path = str(tmp_path / "tokens")
    sinks.write_tokens(tokens, path, "org/other")
    sinks.write_tokens(tokens, path, "org/model")
    sinks.write_tokens(tokens.where("report_id = 1"), path, "org/model")
    assert sorted((r.model, r.report_id) for r in scans.scan_tokens(spark, path).collect()) == [("model", 1), ("other", 1), ("other", 2)]


def test_ids_follow_file_and_place_whatever_the_splits(spark, tmp_path):
    for name, n in (("a", 3), ("b", 400), ("c", 20)):
        lines = [f"S\tgold\t2021-03-04\t{name}{i}" for i in range(n)]
        (tmp_path / f"{name}.tsv").write_text("\n".join(["source\tmarket\tdate\tpassage", *lines]) + "\n", encoding="utf-16")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "2000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            path = str(tmp_path / f"landed{size}")
            sinks.land_reports(scans.scan_reports(spark, str(tmp_path / "*.tsv"), with_file=True), path)
            got = [r.passage for r in spark.read.parquet(path).orderBy("report_id").collect()]
            assert got == [f"{name}{i}" for name, n in (("a", 3), ("b", 400), ("c", 20)) for i in range(n)]
            assert [r.report_id for r in spark.read.parquet(path).orderBy("report_id").collect()] == list(range(423))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_texts_are_landed_once_and_files_are_compressed(spark, tmp_path, monkeypatch):
    (tmp_path / "a.tsv").write_text("source\tmarket\tdate\tpassage\nS\tgold\t2021-03-04\ttext\n", encoding="utf-16")
    kept, settle = [], sinks.settled
    monkeypatch.setattr(sinks, "settled", lambda frame, label: kept.append(frame.columns) or settle(frame, label))
    sinks.land_reports(scans.scan_reports(spark, str(tmp_path / "*.tsv"), with_file=True), str(tmp_path / "landed"))
    assert kept == [["file", "_n"]]
    made = spark.createDataFrame([("train", 1, *[None] * 7)], schemas.DATASET)
    sinks.write_dataset(made, str(tmp_path / "json"))
    assert list((tmp_path / "json").glob("split=train/*.json.gz"))
    assert scans.scan_dataset(spark, str(tmp_path / "json")).count() == 1


def test_ordered_rows_are_not_sorted_again_for_their_folders(spark, tmp_path):
    """The sort that a writer asks for is met by the one before, whatever is put beside the rows."""
    rows = spark.range(9).selectExpr("id AS report_id", "'a' AS split", "DATE'2021-01-01' AS report_date")
    ordered = prompts.in_date_order(rows)
    assert not ordered.schema["split"].nullable


def test_rows_are_sorted_before_texts_are_put_beside_them(spark, tmp_path):
    """The optimizer keeps the sort of the narrow rows below a join, and files are in that order."""
    days = "date_add(DATE'2021-01-01', CAST(id % 7 AS INT)) AS report_date"
    rows = spark.range(3000).selectExpr("(id * 7919) % 3000 AS report_id", "if(id % 3 = 0, 'a', 'b') AS split", "CAST(id % 5 AS STRING) AS market", "'s' AS source", days)
    texts = F.broadcast(spark.range(5).selectExpr("CAST(id AS STRING) AS market", "repeat('text ', 90) AS table_data"))
    for put, key in ((prompts.in_date_order, ["report_date", "report_id"]), (prompts.in_text_order, ["market", "source", "report_date", "report_id"])):
        path = tmp_path / put.__name__
        sinks.write_dataset(put(rows).join(texts, "market"), str(path), "parquet")
        files = list(path.glob("split=*/*.parquet"))
        found = [[tuple(r[c] for c in key) for r in pq.read_table(f, partitioning=None).to_pylist()] for f in files]
        assert sum(map(len, found)) == 3000 and all(f == sorted(f) for f in found)


def test_common_texts_do_not_travel_with_the_rows(spark):
    """Shared tables meet the rows after the shuffle; texts of their own and nulls stay as they are."""
    rows = spark.range(200).selectExpr(
        "id AS report_id", "if(id % 9 = 0, NULL, 'train') AS split", "DATE'2021-01-01' AS report_date",
        "if(id % 5 = 0, NULL, repeat(CAST(id % 3 AS STRING), 500)) AS table_data", "CAST(id AS STRING) AS report",
    )
    plain, slim = prompts.in_date_order(rows), prompts.in_date_order(rows, common=["table_data"])
    assert slim.columns == plain.columns == rows.columns
    assert sorted(slim.collect(), key=lambda r: r.report_id) == sorted(plain.collect(), key=lambda r: r.report_id)
    below = slim._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "md5(" in below and "table_data" in plain._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[0]
    assert [r.report_id for r in slim.collect()] == [r.report_id for r in plain.collect()]


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path):
    shuffled = spark.range(1000).selectExpr("id % 7 AS report_id", "'a' AS split", "current_date() AS report_date").distinct()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, blocks = spark.conf.get(key), lambda: [f for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")]
    held = set(blocks())
    sinks.write_tokens(shuffled.selectExpr("*", "array(1L) AS input_ids", "array(1L) AS attention_mask", "array(1L) AS labels"), str(tmp_path / "tokens"), "m")
    for _ in range(50):
        if not set(blocks()) - held:
            break
        time.sleep(0.2)
    assert not set(blocks()) - held and spark.conf.get(key) == before
    assert scans.scan_tokens(spark, str(tmp_path / "tokens")).count() == 7
