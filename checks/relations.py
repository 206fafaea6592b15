"""Relations the queries run on, derived from the test tables by Spark.

Nations stand for instruments, supplier shipments for price bars, orders with a document
as text for reports. Every order is a report; nothing is cut.

The inputs of the pipeline are files where they come from, so they are landed as Parquet
in the scratch folder once per session and folder, and the queries start at that scan. Reports are
landed without their texts, which are landed once a document.
"""

from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tapeloom.functions.rounding import round_scaled
from tapeloom.operators.calendar import contract_calendar, contract_symbol
from tapeloom.settings import own_shuffles, scratch_dir

START_YEAR, END_YEAR = 1995, 2002
EXPIRY = {"africa": "last_weekday", "america": "fifteenth", "asia": "next_month"}
INSTRUCTION = "Write a market report:\n1. from the price table.\n2. in the style of the examples.\n"


LANDED = {}
SCHEMAS = {}


def landed(define):
    """Make a relation method land its rows on first use and read them from there."""
    @wraps(define)
    def read(self):
        return self.stored(define.__name__, lambda: define(self))

    return read


class Relations:
    """Lazily defined relations over one test folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def stored(self, name, build):
        """The table ``build()`` gives, written once, or again if the folder was cleared."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in LANDED:
            path, schema = LANDED[key]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:
                del LANDED[key]
        path, frame = scratch_dir(self.spark, name), build()
        with own_shuffles(self.spark):
            frame.write.parquet(path)
        LANDED[key] = path, frame.schema
        return self.spark.read.schema(frame.schema).parquet(path)

    def table(self, name):
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    @landed
    def instrument(self):
        nation, region = self.table("nation"), self.table("region")
        third = F.col("n_nationkey") % 3
        base = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("ord"),
            F.lower("r_name").alias("market"),
            F.col("n_name").alias("name"),
            F.when(third == 0, "cme").when(third == 1, "yahoo").otherwise("index").alias("data_source"),
            F.when(third != 2, base).alias("symbol"),
        )

    def listing(self):
        """A longer instrument list that grows with the data: one product per supplier."""
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("supplier")
            .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("int").alias("ord"),
                F.lower("r_name").alias("market"),
                F.col("s_name").alias("name"),
                F.lit("cme").alias("data_source"),
                F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
            )
        )

    def trade(self):
        """Shipments as trades of a nation's product, with a price and a contract symbol."""
        origin = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        rows = self.table("lineitem").join(origin, F.col("l_suppkey") == F.col("s_suppkey"))
        key = F.col("n_nationkey")
        month = (
            F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1 + 1 + F.col("l_linenumber") % 3
        )
        base = F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))
        contract = contract_symbol(base, F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"))
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        return rows.select(
            F.col("l_shipdate").cast("date").alias("trade_date"),
            F.col("n_name").alias("product"),
            F.when(key % 3 == 0, contract).when(key % 3 == 1, base).alias("symbol"),
            key.cast("int").alias("seq"),
            F.col("l_quantity").alias("quantity"),
            round_scaled(F.col("l_extendedprice") / F.col("l_quantity"), 4).alias("price"),
            order.alias("trade_order"),
        )

    @landed
    def bar(self):
        return self.trade().groupBy("trade_date", "product", "symbol", "seq").agg(
            F.min_by("price", "trade_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "trade_order").alias("close"),
            F.sum("quantity").alias("volume"),
        )

    def bar_dup(self):
        """Every bar listed twice, the second time with the close rounded to two digits."""
        first = self.bar().withColumn("seq", F.lit(1))
        second = self.bar().withColumns(
            {"seq": F.lit(2), "close": round_scaled(F.col("close"), 2)}
        )
        return first.unionByName(second)

    @landed
    def contract(self):
        return contract_calendar(self.instrument(), START_YEAR, END_YEAR, {}, EXPIRY)

    @landed
    def passage(self):
        """The text of every row of ``documents`` under a number of its own."""
        return self.table("documents").select(F.monotonically_increasing_id().alias("_text"), "doc_id", "text")

    @landed
    def report_text(self):
        """Every report with the number of its text; no text is copied to the reports."""
        documents = self.table("documents")
        count = documents.agg(F.count("*")).scalar()
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        orders = self.table("orders").withColumn("_doc", F.col("o_orderkey") % count)
        return (
            orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.passage().drop("text"), F.col("doc_id") == F.col("_doc"))
            .select(
                F.col("o_orderkey").alias("report_id"),
                F.expr("substr(o_orderpriority, 3)").alias("source"),
                F.lower("r_name").alias("market"),
                F.date_format("o_orderdate", "MM/dd/yyyy").alias("date"),
                F.col("o_orderdate").cast("date").alias("report_date"),
                "_text",
            )
        )

    def report(self):
        """Reports with their text, which meets them where it is read.

        Numbers of texts differ, which the grouping tells the optimizer: a query without the text
        has no join.
        """
        texts = self.passage().groupBy("_text").agg(F.first("text").alias("passage"))
        return self.report_text().join(texts, "_text", "left").drop("_text")

    def report_key(self):
        """Reports without their text; no document is read for it."""
        return self.report().drop("passage")

    @landed
    def split_ref(self):
        year = F.year("report_date")
        split = F.when(year <= 1998, "train").when(year == 1999, "validate").otherwise("test")
        return self.report_key().select("source", "market", "report_date", split.alias("split")).distinct()

    def example(self):
        return self.report().withColumnRenamed("report_id", "example_id")

    def instruction(self):
        """The instruction as a frame of one row, as ``scan_instruction`` returns it."""
        stripped = F.lit(INSTRUCTION.strip())
        return self.table("region").agg(F.first(stripped).alias("instruction"))
