"""Reports, their tables and examples to dataset rows with full prompts."""

from pyspark.sql import functions as F

from tapeloom.operators.examples import (
    SEED,
    drawn_rows,
    example_fields,
    example_ids,
    format_examples,
    leave_out_ids,
    listed_texts,
    sample_examples,
    spare_examples,
)
from tapeloom.operators.prompts import assemble_prompt, in_date_order, in_text_order
from tapeloom.operators.render import render_table
from tapeloom.operators.spread import is_small, settled, spread_join
from tapeloom.operators.tables import REPORT_KEY, report_keys
from tapeloom.plans.extraction import market_day_tables

DAY = ["market", "report_date"]


def rendered_days(keys, instruments, contracts, bars, history_days=7, n_contracts=3):
    """Text table of every market day that has rows."""
    rows = market_day_tables(keys, instruments, contracts, bars, history_days, n_contracts)
    return render_table(rows, DAY)


def keyed_tables(keys, split_ref, rendered):
    """Text table per (split, source, market, report_date); keys without a table drop out.

    Keys are distinct here: a market day has one row per source, however many reports.
    """
    members = keys.drop("n").join(split_ref.distinct(), REPORT_KEY)
    return members.join(rendered, DAY)


def report_example_rows(examples, n, seed, pick=sample_examples):
    """Sampled examples per (market, source).

    Ids are drawn from narrow rows; the passages are those of the few drawn rows. One more than
    asked is drawn first, which tells a full group from any other.
    """
    keys = ["market", "source"]
    slim = examples.select(*keys, "report_date", "example_id")
    return pick(drawn_rows(examples, pick(slim, keys, n + 1, seed)), keys, n, seed)


def data_example_rows(examples, tables, rendered, n, seed, pick=sample_examples):
    """Same per (split, market, source), from the examples that have a table in the split.

    The drawn ones take their text from the market day's table.
    """
    keys, members = ["split", "market", "source"], tables.select("split", *REPORT_KEY)
    slim = examples.select(*REPORT_KEY, "example_id")
    present = spread_join(slim, members, REPORT_KEY, ["example_id"], counts=report_keys(examples))
    few = drawn_rows(examples, pick(present, keys, n + 1, seed))
    return pick(few.join(members, REPORT_KEY), keys, n, seed).join(rendered, DAY)


def list_ids(members, rows, keys, n, ids, exclude_self):
    """The example ids of each table key as ``ids``, without the key's own date if asked.

    Keys meet lists of ids, without any text, a busy (market, source) in slices.
    """
    spares = example_ids(rows.select(*keys, "place", "report_date", "example_id"), keys, "_spares")
    joined = spread_join(members, spares, keys, ["report_date"], how="left")
    if exclude_self:
        listed = leave_out_ids(F.col("_spares"), F.col("report_date"), n)
    else:
        listed = F.col("_spares.example_id")
    return joined.withColumn(ids, F.coalesce(listed, F.array())).drop("_spares")


def report_lists(tables, rendered, examples, n_data=0, n_report=2, seed=SEED, exclude_self=False):
    """Example ids of each (split, source, market, report_date), and the texts of each distinct list.

    The second is ``{name: (column of ids, texts)}``. ``tables`` are the keys that have a table.
    Drawn rows, keys and texts are written once: what makes them is used several times.
    """
    pick = spare_examples if exclude_self else sample_examples
    drawn = {}
    if n_data:
        rows = data_example_rows(examples, tables, rendered, n_data, seed, pick)
        drawn["few_shot_examples"] = settled(rows, "drawn"), ["split", "market", "source"], n_data
    if n_report:
        rows = report_example_rows(examples, n_report, seed, pick)
        drawn["report_examples"] = settled(rows, "drawn"), ["market", "source"], n_report
    context = tables
    for name, (rows, keys, n) in drawn.items():
        context = list_ids(context, rows, keys, n, f"_{name}", exclude_self)
    context = settled(context, "context")
    texts = {
        name: (f"_{name}", settled(listed_texts(context, rows, f"_{name}", name), "lists"))
        for name, (rows, _, _) in drawn.items()
    }
    return context, texts


def _list_type(examples):
    item = examples.select(example_fields(examples).alias("x")).schema["x"].dataType
    return f"array<{item.simpleString()}>"


def build_dataset(
    reports,
    split_ref,
    rendered,
    examples,
    instruction,
    n_data=0,
    n_report=2,
    seed=SEED,
    exclude_self=False,
    ordered=False,
):
    """Dataset rows with nested prompts; ``ordered`` gives them in ranges of split and date, in order,
    or, if it is "texts", those of each task in the order of the texts that they share.

    Tables and example lists are as few as market days and lists. Where they are small, by count,
    they are broadcast one by one, and the report texts are not shuffled but to order them, before
    anything is put beside them. Beyond that they meet on distinct keys first and the report texts
    are shuffled once, on their key, with busy keys cut into slices. ``instruction`` is a one-row frame.
    """
    in_order = in_text_order if ordered == "texts" else in_date_order
    keys = report_keys(reports)
    tables = keyed_tables(keys, split_ref, rendered.select(*DAY))
    context, texts = report_lists(tables, rendered, examples, n_data, n_report, seed, exclude_self)
    if (
        is_small(context, F.lit(0))
        and is_small(rendered, F.length("table_data"))
        and all(is_small(listed, F.length(F.to_json(name))) for name, (_, listed) in texts.items())
    ):
        joined = reports.join(F.broadcast(context), REPORT_KEY)
        if ordered:
            joined = in_order(joined)
        for ids, listed in texts.values():
            joined = joined.join(F.broadcast(listed), ids, "left")
        joined = joined.join(F.broadcast(rendered), DAY)
    else:
        for ids, listed in texts.values():
            context = spread_join(context, listed, [ids], REPORT_KEY, how="left")
        joined = spread_join(reports, context.join(rendered, DAY), REPORT_KEY, ["report_id"], counts=keys)
        if ordered:
            joined = in_order(joined)
    none = F.array().cast(_list_type(examples))
    shown = {n: F.coalesce(n, none) if n in texts else none for n in ("few_shot_examples", "report_examples")}
    told = joined.withColumns(shown).withColumn("instruction", instruction.scalar())
    prompted = assemble_prompt(
        told,
        F.col("instruction"),
        format_examples(F.col("few_shot_examples"), "data"),
        format_examples(F.col("report_examples"), "report"),
    )
    return prompted.select(
        "split",
        "report_id",
        *REPORT_KEY,
        "date",
        "instruction",
        "table_data",
        F.col("passage").alias("report"),
        F.struct(
            "instruction", "few_shot_examples", "report_examples", "formatted_prompt"
        ).alias("prompts"),
    )
