"""Readers. Every one declares its schema and returns the engine's own column names."""

import csv

from pyspark.sql import functions as F, types as T

from tapeloom import schemas
from tapeloom.functions.dates import parse_iso, parse_report_date
from tapeloom.functions.text import blank_to_null, strip


def name_bars(raw):
    """Price files as landed to the engine's names, with dates parsed and blanks as NULL."""
    named = raw.withColumnsRenamed({v: k for k, v in schemas.BAR_HEADERS.items()})
    return named.withColumns(
        {
            "trade_date": parse_iso(F.col("trade_date")),
            "symbol": blank_to_null(F.col("symbol")),
        }
    )


def read_named(spark, path, schema, with_file=False, **options):
    """Delimited files with a header, columns found by name in whatever order.

    The order is the first file's; a file with another order fails the read, as a column
    that is missing does. Columns that ``schema`` does not name are left out.
    """
    reader = spark.read.options(header=True, **options)
    found = reader.csv(path).columns
    missing = [c for c in schema.names if c not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    fields = [schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in found]
    named = reader.schema(T.StructType(fields)).option("enforceSchema", False).csv(path)
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    return named.select(*schema.names, *file)


def scan_bars(spark, path, file_format="parquet"):
    """Unified price bars. Parquet is the native form, CSV the exchange form."""
    if file_format == "parquet":
        return spark.read.schema(schemas.LANDED_BAR).parquet(path)
    return name_bars(read_named(spark, path, schemas.BAR_FILE))


def scan_instruments(spark, path):
    """Instrument list: a JSON array whose order is meaning, kept as ``ord``.

    The list is configuration kept by hand, one small document, hence one row. A document
    that is no such array fails the read.
    """
    items = F.from_json("value", T.ArrayType(schemas.INSTRUMENT_ITEM), {"mode": "FAILFAST"})
    listed = spark.read.text(path, wholetext=True).select(F.posexplode(items).alias("ord", "item"))
    return listed.select(
        "ord",
        "item.market",
        "item.data_source",
        "item.name",
        blank_to_null(F.col("item.symbol")).alias("symbol"),
    )


def scan_contracts(spark, path):
    """Contract calendar file; the base symbol is the symbol without month and year code."""
    raw = read_named(spark, path, schemas.CONTRACT_FILE)
    return raw.withColumns(
        {
            "expiration_date": parse_iso(F.col("expiration_date")),
            "base_symbol": F.expr("left(symbol, length(symbol) - 2)"),
        }
    )


def scan_reports(spark, path, with_file=False):
    """UTF-16 tab-separated reports with quoted passages that may span lines.

    Such a file cannot be cut in the middle of a quoted passage, so one file is one task:
    land many files, and keep them as Parquet from there on (``sinks.land_reports``).
    ``with_file`` adds the file of each row.
    """
    raw = read_named(
        spark, path, schemas.REPORT_FILE, sep="\t", encoding="UTF-16", multiLine=True, quote='"',
        escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if with_file:
        raw = raw.withColumn("file", F.col("_metadata.file_path"))
    return raw.withColumn("report_date", parse_report_date(F.col("date")))


def scan_split_reference(spark, path):
    """Which split each (source, market, date) belongs to."""
    raw = read_named(spark, path, schemas.SPLIT_FILE)
    return raw.select(
        "source", "market", parse_report_date(F.col("date")).alias("report_date"), "split"
    )


def scan_report_tables(spark, path, span=None, split=None):
    """Report tables of ``sinks.write_report_tables``; span and split prune folders."""
    tables = spark.read.schema(schemas.REPORT_TABLE).parquet(path)
    if span is not None:
        tables = tables.where(F.col("span") == span)
    if split is not None:
        tables = tables.where(F.col("split") == split)
    return tables


def lookup_report_table(tables, wanted):
    """Rows of the tables asked for by (split, market_source, report_date).

    A key without a table has no match and so no rows.
    """
    return tables.join(wanted, ["split", "market_source", "report_date"], "left_semi")


def scan_dataset(spark, path, split=None, file_format="json"):
    """Dataset rows of ``sinks.write_dataset``; ``split`` prunes folders."""
    rows = spark.read.schema(schemas.DATASET).format(file_format).load(path)
    rows = rows.withColumn("report_date", parse_report_date(F.col("date")))
    return rows if split is None else rows.where(F.col("split") == split)


def scan_tokens(spark, path, model=None, split=None):
    """Token rows of ``sinks.write_tokens``; model folder and split prune folders."""
    rows = spark.read.schema(schemas.TOKENS).parquet(path)
    for column, wanted in (("model", model), ("split", split)):
        rows = rows if wanted is None else rows.where(F.col(column) == wanted)
    return rows


def scan_instruction(spark, path):
    """Instruction text as one row, ready to be used as a scalar subquery."""
    return spark.read.text(path, wholetext=True).select(strip(F.col("value")).alias("instruction"))


def scan_cash_index(spark, path, value_column, with_file=False):
    """Cash index files: their date and one value column by name, both still text."""
    raw = spark.read.option("header", True).csv(path)
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    dated, value = ([c for c in raw.columns if c.strip() == name][0] for name in ("Date", value_column))
    return raw.select(F.col(f"`{dated}`").alias("Date"), F.col(f"`{value}`").alias(value_column), *file)


def scan_yields(spark, path):
    """Every ``.csv`` below a folder, each read by its own header, with the path of each row.

    A file is one short history, hence one row before it is cut into lines; a quoted cell may hold
    commas, not line ends. Files of one layout, that is one header line, share a schema of
    their own; layouts are as few as a vendor's formats. A column that a file does not have
    is NULL, and of two columns of one name the first counts.
    """
    files = (
        spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.csv")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r\n|\r|\n").alias("lines"))
        .select("file", F.col("lines")[0].alias("header"), F.explode("lines").alias("line"))
    )
    rows = files.where((F.col("line") != F.col("header")) & (F.trim("line") != ""))
    cells = T.StructType([T.StructField(c, T.StringType()) for c in schemas.YIELD_COLUMNS])
    parsed = F.lit(None).cast(cells)
    for layout in files.select("header").distinct().collect():
        parsed = F.when(F.col("header") == layout.header, _by_layout("line", layout.header)).otherwise(parsed)
    return rows.select(parsed.alias("_cells"), "file").select("_cells.*", "file")


def _by_layout(line, header):
    """The yield columns of a line, by the header line of its file."""
    names = [name.strip(' "\t\ufeff') for name in next(csv.reader([header], skipinitialspace=True), [])]
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    quoting = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    cells = F.from_csv(line, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), quoting)

    def named(column):
        if column not in names:
            return F.lit(None).cast("string").alias(column)
        return blank_to_null(F.trim(cells[f"_{names.index(column)}"])).alias(column)

    return F.struct(*[named(c) for c in schemas.YIELD_COLUMNS])

