"""Rows to one right-aligned text table per group, in native expressions.

The layout is that of a data frame printed without index: columns padded to their widest
cell, one blank between them, ``NaN`` for missing values. Numbers of a column share their
decimals: as many as its values need of six, at least one. A column with tiny values, or
with values above a million that would take more than twelve characters, is printed in
scientific form. The title of a number column, or of one without any value, counts one
blank more.
"""

from pyspark.sql import Window, functions as F

from tapeloom.functions.rounding import round_exact
from tapeloom.schemas import BAR_HEADERS, VALUE_COLUMNS

# Fixed values of the layout.
DIGITS = 6
MISSING = "NaN"
LONG_CELL = DIGITS + 6
# Sizes a number column holds, one bit each.
SMALL, LARGE = 1, 2


def _word_text(name):
    """Text as printed: control characters spelled out, NULL as missing."""
    shown = F.col(name).cast("string")
    for char, spelled in (("\t", "\\t"), ("\r", "\\r"), ("\n", "\\n")):
        shown = F.replace(shown, F.lit(char), F.lit(spelled))
    return F.coalesce(shown, F.lit(MISSING))


def _number_text(name):
    """Six-decimal text without trailing zeros.

    The short text of a double is that already unless it has an exponent or more digits.
    """
    short = f"cast({name} AS string)"
    fits = f"instr({short}, 'E') = 0 AND length({short}) - instr({short}, '.') <= {DIGITS}"
    # The exact value is rounded first: the short text may lie on a tie beside it.
    long = round_exact(F.col(name), DIGITS).cast(f"decimal(38,{DIGITS})").cast("string")
    return F.when(F.expr(fits), F.expr(short)).otherwise(F.regexp_replace(long, "0+$", ""))


def _number_sizes(name):
    size = f"abs({name})"
    return F.expr(f"if({size} > 0 AND {size} < 1e-6, {SMALL}, 0) + if({size} > 1e6, {LARGE}, 0)")


def _number_cell(name):
    """Cell text from the maxima of the column over its group.

    Digits a large number loses in scientific form are rounded half to even.
    """
    places = f"greatest(_{name}_places, 1)"
    scientific = (
        f"(_{name}_sizes & {SMALL} > 0 OR _{name}_sizes & {LARGE} > 0"
        f" AND _{name}_whole + 1 + {places} > {LONG_CELL})"
    )
    unit = f"power(10, floor(log10(abs({name}))) - {DIGITS})"
    kept = f"if(abs({name}) >= 1e7, rint({name} / {unit}) * {unit}, {name})"
    return F.expr(
        f"CASE WHEN {name} IS NULL THEN '{MISSING}'"
        f" WHEN {scientific} THEN format_string('%.{DIGITS}e', {kept})"
        f" ELSE rpad(_{name}_text, instr(_{name}_text, '.') + {places}, '0') END"
    )


def render_table(rows, group, order="row_no", columns=None, text_column="table_data"):
    """One text table per group; lines follow ``order``.

    Number formats, then column widths, are window maxima over the group, so rows are
    shuffled once by group and the lines are collected where they are. The collected lines
    are the text itself.
    """
    columns = columns or list(BAR_HEADERS)
    titles = {c: BAR_HEADERS.get(c, c) for c in columns}
    numbers = [c for c in columns if c in VALUE_COLUMNS]
    words = [c for c in columns if c not in numbers]
    whole = Window.partitionBy(*group)

    texts = rows.select(
        *group,
        order,
        *[_word_text(c).alias(f"_{c}_cell") for c in words],
        *[F.col(c).isNotNull().cast("int").alias(f"_{c}_held") for c in words],
        *numbers,
        *[_number_text(c).alias(f"_{c}_text") for c in numbers],
    )
    formats = {}
    for c in numbers:
        point = F.instr(f"_{c}_text", ".")
        formats[f"_{c}_whole"] = F.max(point - 1).over(whole)
        formats[f"_{c}_places"] = F.max(F.length(f"_{c}_text") - point).over(whole)
        formats[f"_{c}_sizes"] = F.bit_or(_number_sizes(c)).over(whole)
    cells = texts.withColumns(formats).select(
        *group,
        order,
        *[f"_{c}_{part}" for c in words for part in ("cell", "held")],
        *[_number_cell(c).alias(f"_{c}_cell") for c in numbers],
    )
    widths = {}
    for c in columns:
        title = F.lit(len(titles[c]) + 1)
        if c in words:
            title = title - F.max(f"_{c}_held").over(whole)
        widths[f"_{c}_width"] = F.greatest(title, F.max(F.length(f"_{c}_cell")).over(whole))

    padded = [F.lpad(f"_{c}_cell", F.col(f"_{c}_width"), F.lit(" ")) for c in columns]
    line = F.struct(F.col(order), F.concat_ws(" ", *padded).alias("line"))
    grouped = (
        cells.withColumns(widths)
        .select(*group, *widths, line.alias("_line"))
        .groupBy(*group)
        .agg(
            *[F.first(w).alias(w) for w in widths],
            F.array_sort(F.collect_list("_line")).alias("_lines"),
        )
    )
    head = [F.lpad(F.lit(titles[c]), F.col(f"_{c}_width"), F.lit(" ")) for c in columns]
    text = F.concat_ws("\n", F.concat_ws(" ", *head), F.array_join(F.col("_lines.line"), "\n"))
    return grouped.select(*group, text.alias(text_column))
