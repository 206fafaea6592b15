"""Declared schemas of the relations; no type is inferred at read time."""

from pyspark.sql import types as T

PRICE_COLUMNS = ["open", "high", "low", "close"]
VALUE_COLUMNS = PRICE_COLUMNS + ["volume"]
BAR_COLUMNS = ["trade_date", "product", "symbol"] + VALUE_COLUMNS

# Header of the exchanged price files and of rendered tables.
BAR_HEADERS = {
    "trade_date": "Date",
    "product": "Product Name",
    "symbol": "Symbol",
    "open": "Open",
    "high": "High",
    "low": "Low",
    "close": "Close",
    "volume": "Volume",
}

# Header of the yield files.
YIELD_COLUMNS = ["Date", "Open", "High", "Low", "Close"]

# As landed: dates are text until they are parsed leniently.
BAR_FILE = T.StructType(
    [T.StructField(BAR_HEADERS[c], T.StringType()) for c in ["trade_date", "product", "symbol"]]
    + [T.StructField(BAR_HEADERS[c], T.DoubleType()) for c in VALUE_COLUMNS]
)

# Futures bars as landed, stamped in UTC.
FUTURES_FILE = T.StructType(
    [
        T.StructField("ts_event", T.TimestampType()),
        T.StructField("product name", T.StringType()),
        T.StructField("symbol", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in VALUE_COLUMNS]
)

BAR = T.StructType(
    [
        T.StructField("trade_date", T.DateType()),
        T.StructField("product", T.StringType()),
        T.StructField("symbol", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in VALUE_COLUMNS]
    + [T.StructField("seq", T.IntegerType())]
)

# As landed, with the vendor whose partition it is.
LANDED_BAR = T.StructType(BAR.fields + [T.StructField("vendor", T.StringType())])

REPORT_TABLE = T.StructType(
    [
        T.StructField("span", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("market_source", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("row_no", T.IntegerType()),
    ]
    + BAR.fields[:-1]
)

INSTRUMENT_ITEM = T.StructType(
    [
        T.StructField("market", T.StringType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("days_offset", T.IntegerType()),
    ]
)

CONTRACT_FILE = T.StructType(
    [
        T.StructField("market", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("expiration_date", T.StringType()),
    ]
)

REPORT_FILE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["source", "market", "date", "passage"]]
)

SPLIT_FILE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["source", "market", "date", "split"]]
)

TOKENS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("report_id", T.LongType()),
        T.StructField("report_date", T.DateType()),
    ]
    + [
        T.StructField(c, T.ArrayType(T.LongType()))
        for c in ["input_ids", "attention_mask", "labels"]
    ]
)

EXAMPLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["source", "market", "date", "table_data", "report"]]
)

DATASET = T.StructType(
    [T.StructField("split", T.StringType()), T.StructField("report_id", T.LongType())]
    + [
        T.StructField(c, T.StringType())
        for c in ["source", "market", "date", "instruction", "table_data", "report"]
    ]
    + [
        T.StructField(
            "prompts",
            T.StructType(
                [
                    T.StructField("instruction", T.StringType()),
                    T.StructField("few_shot_examples", T.ArrayType(EXAMPLE)),
                    T.StructField("report_examples", T.ArrayType(EXAMPLE)),
                    T.StructField("formatted_prompt", T.StringType()),
                ]
            ),
        )
    ]
)
