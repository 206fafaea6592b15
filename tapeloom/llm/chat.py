"""Chat formatting from a declarative template: a finite-state machine over roles, text segments
with a loss flag each, and the way back from the formatted text. DataFrame functions only.

A conversation becomes one row: the formatted text as segments in order, each marked as counting
for the loss or not. Control strings inside texts are escaped, so that a formatted conversation
can be split again without doubt: ``<``, any number of backslashes and ``|`` gets one backslash
more. Escaped text never holds ``<|``; taking one backslash away gives the text back.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What a turn looks like, and which turns may follow each other.

    ``moves`` maps (state, role) to the next state, from ``start``; a conversation is valid if
    every turn has a move and the last state is one of ``final``.
    """

    open_turn: str = "<|im_start|>"
    after_role: str = "\n"
    close_turn: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: tuple = ("assistant",)
    start: str = "start"
    moves: dict = field(default_factory=lambda: {
        ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
        ("asked", "tool"): "asked", ("answered", "tool"): "asked",
    })
    final: tuple = ("answered",)


CHAT = Template()
REJECTED = "!"


def escape(column):
    return F.regexp_replace(column, r"<(\\*)\|", r"<$1\\|")


def unescape(column):
    return F.regexp_replace(column, r"<(\\*)\\\|", r"<$1|")


def last_state(roles, template):
    """The state after all roles; ``REJECTED`` from the first turn without a move on."""
    table = F.create_map(*(F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state} {role}", to)))
    return F.aggregate(
        roles,
        F.lit(template.start),
        lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit(" "), role)), F.lit(REJECTED)),
    )


def format_conversations(turns, template=CHAT):
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    ``segments`` is an array of (text, loss) whose texts, put together, are ``formatted``; ``valid``
    says whether the state machine accepts the roles. A conversation it rejects is formatted all the
    same. Turns are ordered by (turn, role, text); repeated rows are turns of their own. A null role
    or text is empty; a null turn comes first; rows without conv_id are one conversation. Roles are
    written percent-encoded where they are not plain words. The turns of a conversation meet in one
    row, since a conversation is one formatted text.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    talks = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns")
    )
    head = lambda t: F.concat(F.lit(template.open_turn), F.url_encode(t["role"]), F.lit(template.after_role))
    tail = F.lit(template.close_turn + template.after_turn)

    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.flatten(F.transform("_turns", lambda t: F.array(
        segment(head(t), F.lit(False)),
        segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
        segment(tail, F.lit(False)),
    )))
    return (
        talks.withColumn("segments", segments)
        .withColumn("valid", last_state(F.col("_turns.role"), template).isin(*template.final))
        .select("conv_id", "valid", F.array_join("segments.text", "").alias("formatted"), "segments")
    )


def read_formatted(formatted, template=CHAT):
    """Turns read back from the formatted text, and the text under the loss mask.

    ``turns`` is an array of (role, text) parsed from ``formatted`` alone; ``loss_text`` is the
    unescaped text of the segments that count for the loss.
    """
    literal = lambda s: r"\Q" + s + r"\E"
    pieces = F.slice(F.split("formatted", literal(template.open_turn)), 2, 2**30)  # all but what is before the first turn
    close = template.close_turn + template.after_turn

    def turn(piece):
        role = F.substring_index(piece, template.after_role, 1)
        start = F.length(role) + len(template.after_role) + 1
        length = F.length(piece) - start + 1 - len(close)
        return F.struct(
            F.url_decode(role).alias("role"), unescape(F.substring(piece, start, length)).alias("text")
        )

    spoken = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", F.array_join(spoken, ""))


def digests(read):
    """Digest columns of conversations read back: counts and SHA-256 of turns and loss text."""
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
