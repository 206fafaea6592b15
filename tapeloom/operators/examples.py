"""Example reports: seeded samples per group, short ordered lists, printed blocks."""

from pyspark.sql import Window, functions as F

from tapeloom.operators.spread import is_small, settled, spread_join

SEED = "7"
FIELDS = ["source", "market", "date", "table_data", "report"]

# The printed blocks.
DATA_BLOCK = ["Data Example ", ":\nMarket: ", "\nDate: ", "\nTable Data:\n", "\n\nReport:\n", "\n---"]
REPORT_BLOCK = ["Report Example ", ":\nMarket: ", "\nDate: ", "\nReport:\n", "\n---"]


def ticket(seed, unique):
    """Reproducible draw: rows of a group are drawn in the order of this hash."""
    return F.md5(F.concat(F.lit(seed), F.lit("|"), F.col(unique).cast("string")))


def sample_examples(examples, keys, n, seed=SEED, unique="example_id"):
    """At most ``n`` examples per group without replacement, as ``place`` 1..n.

    A group of more than ``n`` keeps the order of the draw, any other its input order. One
    row more than asked tells the two apart. The rank limit applies before the shuffle, so
    a group sends at most n + 1 rows per task however large it is.
    """
    draw = Window.partitionBy(*keys).orderBy("_ticket", unique)
    drawn = (
        examples.withColumn("_ticket", ticket(seed, unique))
        .withColumn("_draw", F.row_number().over(draw))
        .where(F.col("_draw") <= n + 1)
    )
    group = Window.partitionBy(*keys)
    sampled = F.max("_draw").over(group) > n
    ranked = drawn.withColumn("_order", F.when(sampled, F.col("_draw")))
    kept = ranked.where(F.col("_order").isNull() | (F.col("_order") <= n))
    place = F.row_number().over(group.orderBy("_order", unique))
    return kept.withColumn("place", place).drop("_ticket", "_draw", "_order")


def spare_examples(examples, keys, n, seed=SEED, unique="example_id"):
    """Enough drawn examples per group to take ``n`` after leaving out any one date.

    No result uses more than n + 1 examples of a date (one more than shown, to tell a full
    group). Of those kept per date, leaving one date out removes at most n + 1, so the
    first 2(n + 1) of the draw always hold the answer.
    """
    need = n + 1
    by_date = Window.partitionBy(*keys, "report_date").orderBy("_ticket", unique)
    by_group = Window.partitionBy(*keys).orderBy("_ticket", unique)
    dated = (
        examples.withColumn("_ticket", ticket(seed, unique))
        .withColumn("_place", F.row_number().over(by_date))
        .where(F.col("_place") <= need)
    )
    drawn = dated.withColumn("place", F.row_number().over(by_group))
    return drawn.where(F.col("place") <= 2 * need).drop("_ticket", "_place")


def drawn_rows(examples, drawn, unique="example_id"):
    """The rows of ``examples`` with an id that is drawn; no text is sorted or shuffled to find them.

    A draw from these rows is the draw from all: rows before a drawn one in a group are drawn too.
    """
    ids = settled(drawn.select(F.col(unique).alias("_drawn")).distinct(), "drawn")
    if is_small(ids, F.lit(0)):
        ids = F.broadcast(ids)
    return examples.join(ids, F.col(unique).eqNullSafe(F.col("_drawn")), "left_semi")


def example_fields(frame):
    """The fields of an example, with no table where it has none."""
    table = F.col("table_data") if "table_data" in frame.columns else F.lit(None).cast("string")
    return F.struct(
        "source", "market", "date", table.alias("table_data"), F.col("passage").alias("report")
    )


def group_examples(sampled, keys, name="examples"):
    """Ordered example list per group; lists are as short as the sample."""
    entry = F.struct("place", example_fields(sampled).alias("example"))
    listed = sampled.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    return listed.select(*keys, F.col("_list.example").alias(name))


def group_spares(spares, keys, name="spares"):
    """Spare lists per group, each entry with its date and id for ``leave_out``."""
    entry = F.struct(
        "place", "report_date", "example_id", example_fields(spares).alias("example")
    )
    return spares.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(name))


def leave_out(spares, day, n):
    """First ``n`` spares not of ``day``: drawn order if there are more, else input order."""
    others = F.filter(spares, lambda x: x["report_date"] != day)
    by_input = F.array_sort(
        F.transform(others, lambda x: F.struct(x["example_id"].alias("k"), x["example"].alias("v")))
    )
    drawn = F.transform(F.slice(others, 1, n), lambda x: x["example"])
    return F.when(F.size(others) > n, drawn).otherwise(F.transform(by_input, lambda x: x["v"]))


def example_ids(rows, keys, name):
    """Per group the spares as (place, report_date, example_id), without their texts."""
    entry = F.struct("place", "report_date", "example_id")
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(name))


def leave_out_ids(spares, day, n):
    """``leave_out`` on ids: the first ``n`` of the draw if there are more, else in input order."""
    others = F.filter(spares, lambda x: x["report_date"] != day)["example_id"]
    return F.when(F.size(others) > n, F.slice(others, 1, n)).otherwise(F.array_sort(others))


def listed_texts(lists, rows, ids, name):
    """(ids, examples) of each distinct list of example ids; ``rows`` hold the drawn examples.

    Lists are as few as groups times the dates they leave out, however many reports show them.
    """
    drawn = rows.select("example_id", example_fields(rows).alias("_example")).dropDuplicates(["example_id"])
    places = lists.select(ids).distinct().select(ids, F.posexplode(ids).alias("_at", "example_id"))
    entry = F.array_sort(F.collect_list(F.struct("_at", "_example")))
    listed = places.join(drawn, "example_id").groupBy(ids).agg(entry.alias("_list"))
    return listed.select(ids, F.col("_list._example").alias(name))


def attach_examples(frame, groups, keys, names=("examples",)):
    """Example lists of the group of each row; no group is an empty list.

    The lists are one short row per group; a group with very many rows is cut into slices.
    """
    joined = spread_join(frame, groups, keys, [c for c in frame.columns if c not in keys], how="left")
    return joined.withColumns({c: F.coalesce(c, F.array()) for c in names})


def _shown(value):
    return F.coalesce(value, F.lit("nan"))


def format_examples(examples, kind):
    """Printed blocks of a list, numbered from 1, or NULL for an empty list."""
    if kind == "data":
        texts, fields = DATA_BLOCK, ["market", "date", "table_data", "report"]
    else:
        texts, fields = REPORT_BLOCK, ["market", "date", "report"]

    def block(example, position):
        parts = [F.lit(texts[0]), (position + 1).cast("string")]
        for text, field in zip(texts[1:], fields):
            parts += [F.lit(text), _shown(example[field])]
        return F.concat(*parts, F.lit(texts[-1]))

    return F.when(F.size(examples) > 0, F.array_join(F.transform(examples, block), "\n"))
