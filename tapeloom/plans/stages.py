"""The batch pipeline over files: every stage reads the tables the one before it wrote.

Stage tables are the only state, so a stage can run again after a failure and lineage
never spans two stages.
"""

from dataclasses import dataclass, field
from typing import Callable, Optional

from pyspark.sql import functions as F

from tapeloom.operators.calendar import CONTRACT_MONTHS, EXPIRY_RULES, calendar_years, contract_calendar
from tapeloom.operators.examples import SEED
from tapeloom.operators.render import render_table
from tapeloom.operators.tables import rejected_reports, report_keys
from tapeloom.operators.tokens import MAX_OUTPUT, MAX_SEQUENCE
from tapeloom.plans import upkeep
from tapeloom.plans.dataset import DAY, build_dataset
from tapeloom.plans.extraction import keyed_report_tables, market_day_tables
from tapeloom.plans.tokenization import tokenize_reports, tokenize_stage
from tapeloom.settings import HISTORY_SPANS, own_shuffles
from tapeloom.sources import scans, sinks


@dataclass
class Config:
    """Where inputs are, where stages go, and the settings of a run."""

    root: str
    instruments: str
    reports: str
    split_reference: str
    instruction: str
    examples: Optional[str] = None
    span: str = "1week"
    first_year: Optional[int] = None
    last_year: Optional[int] = None
    data_examples: int = 0
    report_examples: int = 2
    exclude_self: bool = False
    seed: str = SEED
    model: str = "hashed-words"
    tokenizer: Optional[Callable] = None
    parts_at_blanks: bool = False  # the tokenizer encodes every word by itself
    max_sequence: int = MAX_SEQUENCE
    max_output: int = MAX_OUTPUT
    skip_overlength: bool = True
    context_length: Optional[int] = None
    dataset_format: str = "parquet"
    contract_months: dict = field(default_factory=lambda: CONTRACT_MONTHS)
    expiry_rules: dict = field(default_factory=lambda: EXPIRY_RULES)

    def path(self, *parts):
        return "/".join([self.root.rstrip("/"), *parts])


def ingest(spark, config, vendors):
    """Append the bars of ``{vendor: bars}``; a vendor given again is replaced."""
    sinks.append_bars(config.path("bars"), vendors)


def land_texts(spark, config):
    """Land reports and examples as Parquet with frozen ids."""
    reports = scans.scan_reports(spark, config.reports, with_file=True)
    sinks.land_reports(reports, config.path("reports"))
    if config.examples:
        examples = scans.scan_reports(spark, config.examples, with_file=True)
        sinks.land_reports(examples, config.path("examples"), "example_id")


def calendar(spark, config):
    """Generate the contracts of the listed futures.

    Years that the configuration leaves open come from the landed reports: from the first
    report to 365 days after the last one.
    """
    listed = scans.scan_instruments(spark, config.instruments)
    reports = spark.read.parquet(config.path("reports"))
    span = reports.agg(F.min("report_date").alias("first"), F.max("report_date").alias("last"))
    years = span.select(calendar_years(F.col("first"), F.col("last")).alias("years")).first().years or [0, -1]
    first = years[0] if config.first_year is None else config.first_year
    last = years[-1] if config.last_year is None else config.last_year
    if first > last:
        listed, first, last = listed.limit(0), 1, 1
    contracts = contract_calendar(listed, first, last, config.contract_months, config.expiry_rules)
    contracts.write.mode("overwrite").parquet(config.path("contracts"))
    sinks.write_contracts(contracts, config.path("contracts_csv"))


def extract(spark, config):
    """Tables of every market day, then of every (split, source, market, date)."""
    reports = spark.read.parquet(config.path("reports"))
    split_ref = scans.scan_split_reference(spark, config.split_reference)
    days = market_day_tables(
        report_keys(reports),
        scans.scan_instruments(spark, config.instruments),
        spark.read.parquet(config.path("contracts")),
        scans.scan_bars(spark, config.path("bars")),
        HISTORY_SPANS[config.span],
    )
    stored = config.path("market_days", config.span)
    with own_shuffles(spark):
        days.write.mode("overwrite").parquet(stored)
    rows = keyed_report_tables(reports, split_ref, spark.read.parquet(stored))
    sinks.write_report_tables(rows, config.path("report_tables"), config.span)


def rejects(spark, config):
    """Write the reports that can have no table, each with its reason."""
    rejected = rejected_reports(spark.read.parquet(config.path("reports")))
    rejected.write.mode("overwrite").parquet(config.path("rejects"))


def render(spark, config):
    """Text tables of every market day."""
    tables = render_table(spark.read.parquet(config.path("market_days", config.span)), DAY)
    with own_shuffles(spark):
        tables.write.mode("overwrite").parquet(config.path("rendered", config.span))


def construct(spark, config, rendered=None):
    """Dataset rows of every split, with the given text tables or those of ``render``."""
    if rendered is None:
        rendered = spark.read.parquet(config.path("rendered", config.span))
    reports = spark.read.parquet(config.path("reports"))
    if config.examples:
        examples = spark.read.parquet(config.path("examples"))
        counts = config.data_examples, config.report_examples
    else:
        examples = reports.withColumnRenamed("report_id", "example_id")
        counts = 0, 0
    dataset = build_dataset(
        reports,
        scans.scan_split_reference(spark, config.split_reference),
        rendered,
        examples,
        scans.scan_instruction(spark, config.instruction),
        *counts,
        seed=config.seed,
        exclude_self=config.exclude_self,
        ordered=True if config.dataset_format == "parquet" else "texts",
    )
    path = config.path("dataset", config.span)
    sinks.write_dataset(dataset.drop("report_date"), path, config.dataset_format)


def read_dataset(spark, config):
    """Dataset rows of all splits."""
    return scans.scan_dataset(
        spark, config.path("dataset", config.span), file_format=config.dataset_format
    )


def tokenize(spark, config, rendered=None):
    """Token rows of every split, in date order, from the dataset and the tables it shows.

    The rows of a Parquet dataset lie in date order, so its texts are not shuffled for it again; those
    of any other format come from the reports.
    """
    if rendered is None:
        rendered = spark.read.parquet(config.path("rendered", config.span))
    instruction = scans.scan_instruction(spark, config.instruction)
    how = dict(
        max_sequence=config.max_sequence,
        max_output=config.max_output,
        context_length=config.context_length,
        skip_overlength=config.skip_overlength,
        tokenizer=config.tokenizer,
        parts_at_blanks=config.parts_at_blanks,
        ordered=True,
    )
    if config.dataset_format == "parquet":
        rows = tokenize_stage(read_dataset(spark, config), rendered, instruction, **how)
    else:
        reports = spark.read.parquet(config.path("reports"))
        split_ref = scans.scan_split_reference(spark, config.split_reference)
        rows = tokenize_reports(reports, split_ref, rendered, instruction, **how)
    sinks.write_tokens(rows, config.path("tokens", config.span), config.model)


def split_counts(spark, config):
    """Rows written per split."""
    return read_dataset(spark, config).groupBy("split").agg(F.count("*").alias("n_rows"))


def run(spark, config, vendors=None):
    """All stages in order."""
    if vendors:
        ingest(spark, config, vendors)
    for stage in (land_texts, rejects, calendar, extract, render, construct, tokenize):
        stage(spark, config)


def update(spark, config, feeds):
    """All stages from landed vendor files, with tables made again only where bars or reports changed.

    ``feeds`` are those of ``upkeep``. Bars and tables are kept as layers beside those of ``run``;
    dataset and tokens are those that ``run`` gives with the same bars.
    """
    bars, tables = config.path("bar_layers"), config.path("table_layers", config.span)
    upkeep.ingest_files(spark, bars, feeds)
    for stage in (land_texts, rejects, calendar):
        stage(spark, config)
    upkeep.refresh_tables(
        spark,
        tables,
        bars,
        spark.read.parquet(config.path("reports")),
        scans.scan_instruments(spark, config.instruments),
        spark.read.parquet(config.path("contracts")),
        HISTORY_SPANS[config.span],
    )
    for stage in (construct, tokenize):
        stage(spark, config, upkeep.current_texts(spark, tables))
