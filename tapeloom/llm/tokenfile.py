"""Token files: documents as ids in Simple-8b words, in ascending document order, and back.

A file is Parquet whose rows are groups of whole documents: the documents' ids and lengths, the
group's place in its shard, and the packed ids. Parquet gives Spark's commit protocol and any
file system; the ids are in this package's own coding. A group has about ``GROUP_IDS`` ids, or is
one longer document, so memory is bounded by the longest document.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from tapeloom.llm import simple8b, wordcache

GROUP_IDS = 1 << 18
BLOCK_IDS = 1 << 10  # ids in a block of a group's packed ids

GROUPS = (
    "shard int, start_in_shard long, doc_ids array<bigint>, lengths array<bigint>, payload binary"
)
DOCUMENTS = "shard int, start_in_shard long, doc_id long, n_tokens long, ids_crc32 long"


def _encoder(path, joins_blanks, end_id):
    end = np.array([end_id], dtype="<u4").tobytes()

    def groups(batches):
        shard = TaskContext.get().partitionId()
        cache = wordcache.cached(path, joins_blanks)
        doc_ids, parts, start, held = [], [], 0, 0

        def flush():
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()),
                "start_in_shard": pa.array([start], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([[len(p) // 4 for p in parts]], pa.list_(pa.int64())),
                "payload": pa.array([simple8b.pack(ids, BLOCK_IDS)], pa.binary()),
            })

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), cache.encode_all(batch.column(1))):
                ids += end
                if parts and held + len(ids) // 4 > GROUP_IDS:
                    yield flush()
                    doc_ids, parts, start, held = [], [], start + held, 0
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) // 4
        if parts:
            yield flush()

    return groups


def write_tokens(documents, path, tokenizer, joins_blanks, end_id):
    """Encode ``documents`` (doc_id, text) and write them under ``path`` by ascending doc_id.

    Every document ends with ``end_id``; a null text is only that. Null doc_ids come first, and
    rows of one doc_id follow each other by the hash of their text, repeated rows each on their
    own. The texts are shuffled once, by range; an empty table writes no group.
    """
    tie = F.xxhash64("text")
    ordered = (
        documents.select("doc_id", "text", tie.alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(_encoder(tokenizer, joins_blanks, end_id), GROUPS).write.parquet(path)


def _decoder(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.unpack(row["payload"]).astype("<u4")
            stops = np.cumsum(row["lengths"])
            starts = stops - row["lengths"]
            data = memoryview(ids.tobytes())
            n = len(stops)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]] * n, pa.int32()),
                "start_in_shard": pa.array(starts + row["start_in_shard"], pa.int64()),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": pa.array(row["lengths"], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, stops)], pa.int64()),
            })


def read_index(spark, path):
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it: the place in its shard, kept in the file,
    plus the ids of the shards before. The shards are as many as the tasks that wrote them, which
    is all that meets in one task here.
    """
    groups = spark.read.schema(GROUPS).parquet(path)
    totals = groups.groupBy("shard").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("_n")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        groups.mapInArrow(_decoder, DOCUMENTS)
        .join(F.broadcast(bases), "shard")
        .select("doc_id", (F.col("_base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
    )


def _ids_of(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.unpack(row["payload"]).astype("<u4")
            cuts = np.append(0, np.cumsum(row["lengths"]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype("int64"))),
            })


def read_ids(spark, path):
    """(doc_id, ids array<long>) of every document."""
    return spark.read.schema(GROUPS).parquet(path).mapInArrow(_ids_of, "doc_id long, ids array<bigint>")
