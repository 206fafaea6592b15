"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Archives are plain WARC/1.0 files: Spark's text sink writes one record per row with the
record end ``CR LF CR LF`` as line separator, so files come from tasks under Spark's commit
protocol and no record passes through Python.

Reading splits a file at every ``WARC/1.0`` magic, whether it starts a record or lies in a
payload. Each piece with a parsable header is a candidate: it names its own offset and,
by its Content-Length, the offset of its successor. Pointer jumping from the start of the
file keeps the candidates that the chain reaches; magic inside payloads is never reached.
Only lengths and header fields are gathered per file (some 200 bytes a candidate), never
payloads; a payload that contains magic is put together from its pieces in a second scan,
which runs only if there are such.
"""

import numpy as np
from pyspark.sql import functions as F

from tapeloom.settings import scratch_dir

MAGIC = "WARC/1.0\r\n"  # Fixed value: the first line of a record.
END = "\r\n\r\n"  # Fixed value: the end of a header and of a record.
BROADCAST_COPIES = 200_000  # digests of payloads with copies, 60 bytes each, up to which they are broadcast
BROADCAST_PIECES = 100_000  # pieces of torn payloads, 40 bytes each, up to which they are broadcast

CHAIN = (
    "file string, block long, seq long, start long, record_start long, reached boolean, torn boolean, "
    "page_id long, record_type string, refers_to long, digest string, payload_bytes long, payload_digest string"
)


def with_revisits(pages, min_bytes=100):
    """Payload, digest and record type of every page.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest
    page_id is the response and the others revisit it. A null html is an empty payload; a null
    page_id is never referred to; rows equal in page_id and payload are all responses. Payloads
    are shuffled only if more than ``BROADCAST_COPIES`` different ones have copies.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("_payload")
    ).withColumn("_digest", F.unhex(F.sha2(F.col("_payload").cast("binary"), 256)))
    firsts = (
        rows.where(F.octet_length("_payload") >= min_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )
    stored = scratch_dir(pages.sparkSession, "copies")
    firsts.write.parquet(stored)
    firsts = pages.sparkSession.read.schema("_digest binary, _first long").parquet(stored)
    if firsts.count() <= BROADCAST_COPIES:
        firsts = F.broadcast(firsts)  # payloads then stay where they are read
    return rows.join(firsts, "_digest", "left").withColumn(
        "refers_to", F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first"))
    )


def write_archives(pages, path, min_bytes=100, date="2026-01-01T00:00:00Z"):
    """Write one record per row of ``pages`` (page_id, url, html) under ``path``."""
    rows = with_revisits(pages, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("_payload"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(value):
        return F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("_digest")))),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(""),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END)),
        body,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark, path):
    """The stretches between magic strings, in file order by (block, seq)."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
        )
    )


def _header_field(name):
    return F.regexp_extract("_header", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)


def _candidates(pieces):
    """Lengths and header fields; the digest of the payload if the piece holds all of it."""
    number = lambda name: F.regexp_extract(_header_field(name), r"(-?\d+)", 1).try_cast("long")
    held = F.substring_index("value", END, 1)
    payload = F.expr("substring(cast(value AS binary), cast(head_bytes + 5 AS int), cast(payload_bytes AS int))")
    return (
        pieces.withColumn("piece_bytes", F.octet_length("value").cast("long"))
        .withColumn("_header", F.when(F.octet_length(held) < F.col("piece_bytes"), held))
        .withColumn("head_bytes", F.octet_length("_header").cast("long"))
        .withColumn("payload_bytes", number("Content-Length"))
        .withColumn(
            "payload_digest",
            F.when(F.col("head_bytes") + 4 + F.col("payload_bytes") <= F.col("piece_bytes"), F.sha2(payload, 256)),
        )
        .select(
            "file", "block", "seq", "piece_bytes", "head_bytes", "payload_bytes", "payload_digest",
            number("WARC-Record-ID").alias("page_id"),
            F.lower(_header_field("WARC-Type")).alias("record_type"),
            number("WARC-Refers-To").alias("refers_to"),
            F.regexp_extract(_header_field("WARC-Payload-Digest"), r"(?i)sha256:([0-9a-f]+)", 1).alias("digest"),
        )
    )


def reachable(successor, first):
    """Which nodes a chain from ``first`` visits; ``successor[i] > i``, the last node is the end.

    Pointer jumping: after step k every node knows the node 2^k steps on, and the visited set
    holds the first 2^k nodes of the chain, so the steps are the logarithm of the records.
    """
    visited = np.zeros(len(successor), dtype=bool)
    visited[first] = True
    jump = successor.copy()
    while True:
        reached = visited.copy()
        reached[jump[visited]] = True
        if (reached == visited).all():
            return visited
        visited, jump = reached, jump[jump]


def _chain(part):
    """Candidates of one file in file order, with what the chain from its start says of each."""
    part = part.sort_values(["block", "seq"], kind="stable").reset_index(drop=True)
    sizes = part["piece_bytes"].to_numpy(dtype="int64") + len(MAGIC)
    begin = np.cumsum(sizes) - sizes - len(MAGIC)  # where the piece's magic is; the first has none
    total = int(begin[-1] + sizes[-1]) if len(part) else 0
    head, payload = (part[c].fillna(-1).to_numpy(dtype="int64") for c in ("head_bytes", "payload_bytes"))
    valid = (head >= 0) & (payload >= 0) & (begin >= 0)
    after = begin + len(MAGIC) + head + len(END) + payload + len(END)
    # Node i is piece i, node n the end of the file, node n + 1 a dead end.
    n = len(part)
    at = np.searchsorted(begin, after)
    found = valid & (at < n) & (begin[np.minimum(at, n - 1)] == after)
    successor = np.where(found, at, np.where(valid & (after == total), n, n + 1))
    successor = np.append(successor, [n, n + 1])
    start = np.searchsorted(begin, 0)
    visited = reachable(successor, min(start, n))[:n] & valid & (successor[:n] <= n)
    owner = np.maximum.accumulate(np.where(visited, np.arange(n), -1))
    spans = np.zeros(n, dtype="int64")
    np.add.at(spans, owner[owner >= 0], 1)
    part["start"] = begin
    part["record_start"] = np.where(owner >= 0, begin[np.maximum(owner, 0)], -1)
    part["reached"] = visited
    part["torn"] = (owner >= 0) & (spans[np.maximum(owner, 0)] > 1)
    return part[[c.split()[0] for c in CHAIN.split(", ")]]


def read_records(spark, path):
    """(file, start, page_id, record_type, refers_to, digest, payload_bytes, payload_digest).

    ``digest`` is what the header says, ``payload_bytes`` and ``payload_digest`` are of the
    bytes that follow it. A record cut off by the end of its file ends the chain and is not
    returned. An empty folder gives no rows.
    """
    pieces = _pieces(spark, path)
    chain = _candidates(pieces).groupBy("file").applyInPandas(_chain, CHAIN)
    stored = scratch_dir(spark, "chain")
    chain.where("reached OR torn").write.parquet(stored)
    chain = spark.read.parquet(stored)
    columns = ["file", "start", "page_id", "record_type", "refers_to", "digest", "payload_bytes"]
    whole = chain.where("reached AND NOT torn").select(*columns, "payload_digest")
    torn = chain.where("torn")
    count = torn.count()
    if not count:
        return whole
    where = torn.select("file", "block", "seq", F.col("record_start").alias("start"))
    if count <= BROADCAST_PIECES:
        where = F.broadcast(where)
    text = (
        pieces.join(where, ["file", "block", "seq"])
        .groupBy("file", "start")
        .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("_parts"))
        .withColumn("value", F.array_join(F.col("_parts.value"), MAGIC))
        .withColumn("_head", F.octet_length(F.substring_index("value", END, 1)))
    )
    payload = F.expr("substring(cast(value AS binary), cast(_head + 5 AS int), cast(payload_bytes AS int))")
    mended = (
        torn.where("reached").select(*columns).join(text, ["file", "start"])
        .withColumn("payload_digest", F.sha2(payload, 256))
    )
    return whole.unionByName(mended.select(whole.columns))


def resolve_revisits(records):
    """Records with the payload length and digest of what they revisit.

    A revisit is matched by page and digest; one whose response is missing keeps nulls.
    """
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"),
        F.col("payload_bytes").alias("_bytes"),
    ).distinct()
    revisits = records.where("record_type = 'revisit'").join(responses, ["refers_to", "digest"], "left").select(
        "page_id",
        F.col("_bytes").alias("payload_bytes"),
        F.when(F.col("_bytes").isNotNull(), F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )
    plain = records.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    return plain.unionByName(revisits)
