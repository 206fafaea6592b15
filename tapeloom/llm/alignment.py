"""Alignment of the tokens of two vocabularies over whole texts, in Arrow tables inside Spark tasks.

1. A task encodes a batch of texts with both tokenizers. List flatten and parent indices give one
   table of tokens a side; byte lengths come from a table by id, and cumulative sums less the
   sum at the start of the document are the byte offset where each token ends.
2. An Acero hash join on (document, end) finds the ends both sides share. They cut a document into
   groups: a running count of shared ends numbers them.
3. Ids are counted per group and side, and a hash join on the group gives the links of a document as
   (a, b, times): a long group costs its distinct ids, not its tokens. The batch is written down.
4. ``Table.group_by`` counts the documents that hold an id pair, batch by batch; Spark adds up.
5. The links of each document meet the counts: pairs in many documents, at most ``FREQUENT`` of them,
   by a broadcast, so that no common pair is one task's; the others by a shuffle.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tapeloom.llm import wordcache
from tapeloom.settings import scratch_dir

BATCH_BYTES = 1 << 20  # bytes of text aligned at a time; a longer text is aligned alone
END_BITS = 40  # of a key of document and end: texts of up to a terabyte
WIDE = 64  # pairs of tokens in a group beyond which its ids are counted first
PARTIAL_PAIRS = 1 << 19  # id pairs a task counts before it hands them on
FREQUENT = 300_000  # id pairs that are broadcast with their counts: 32 bytes each

LINKS = "array<struct<a:int,b:int,times:int>>"
ALIGNED = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links {LINKS}"
COUNTS = "pair long, documents long, best boolean"


def byte_level_bytes(path):
    """The bytes of every id of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {char: b for b, char in enumerate(wordcache.byte_alphabet())}
    found = [b""] * (max(spec["model"]["vocab"].values()) + 1)
    for token, number in spec["model"]["vocab"].items():
        if all(c in byte_of for c in token):
            found[number] = bytes(byte_of[c] for c in token)
    return found


def piece_bytes(processor):
    """The bytes of every id of a sentencepiece model: U+2581 is a blank, <0xHH> is one byte."""
    found = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            found.append(bytes([int(piece[3:5], 16)]))
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


class Side:
    """One tokenizer: ids of texts, the bytes of an id, and how its ids are written in a group."""

    def __init__(self, encode, byte_table, between, after):
        self.encode, self.size = encode, len(byte_table)
        self.bytes = pa.array(byte_table, pa.large_binary())
        self.lengths = pa.array([len(b) for b in byte_table], pa.int64())
        # Written ids: number, and number + size where the group's part of this side ends.
        self.written = [f"{i}{between}" for i in range(len(byte_table))] + [f"{i}{after}" for i in range(len(byte_table))]

    def joined(self, lists):
        """The bytes of the tokens of every text, put together."""
        parts = pa.LargeListArray.from_arrays(lists.offsets.cast(pa.int64()), pc.take(self.bytes, lists.values))
        return pc.binary_join(parts, pa.scalar(b"", pa.large_binary()))

    def tokens(self, lists):
        """(documents, ends) of every token; ends count the bytes of the document up to there."""
        documents = pc.list_parent_indices(lists).cast(pa.int64())
        running = pc.cumulative_sum(pc.take(self.lengths, pc.list_flatten(lists)))
        running = pa.concat_arrays([pa.array([0], pa.int64()), running])
        at_start = pc.take(running, lists.offsets.slice(0, len(lists)).cast(pa.int64()))  # of each document
        return documents, pc.subtract(running.slice(1), pc.take(at_start, documents))


class PieceWords:
    """Piece ids of texts, looked up word by word.

    Where no piece of the vocabulary has a blank after another character, no merge crosses a single
    blank between two words, so a text has the ids of its words, each encoded alone, in order. A
    vocabulary with such a piece, or a text with other white space beside its blanks, is left whole.
    """

    def __init__(self, processor):
        self.processor, self.words = processor, {}
        pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
        self.by_word = all("▁" not in piece.lstrip("▁") for piece in pieces)

    def encode(self, texts):
        split = [text.split(" ") for text in texts]
        words = set().union(*split) if self.by_word else set()
        fresh = [w for w in words if w not in self.words]
        if len(self.words) + len(fresh) > wordcache.WORDS_HELD:
            self.words.clear()
            fresh = list(words)
        safe = [w for w in fresh if w and w == w.strip()]
        for word, ids in zip(safe, self.processor.encode(safe, num_threads=1)):
            self.words[word] = wordcache.packed(ids)
        found, whole = [], []
        for at, own in enumerate(split):
            try:
                found.append(np.frombuffer(b"".join(map(self.words.__getitem__, own)), dtype="<u4").astype(np.int32))
            except KeyError:
                found.append(None)
                whole.append(at)
        for at, ids in zip(whole, self.processor.encode([texts[at] for at in whole], num_threads=1)):
            found[at] = np.array(ids, dtype=np.int32)
        return found


class Aligner:
    """Both tokenizers of a worker, and the alignment of a batch of texts."""

    def __init__(self, byte_path, piece_path):
        import sentencepiece

        cache = wordcache.cached(byte_path, True, plain_specials=True)
        processor = sentencepiece.SentencePieceProcessor(model_file=piece_path)

        def byte_ids(texts):
            return [np.frombuffer(cache.encode_after_blank(t), dtype="<u4").astype(np.int32) for t in texts]

        self.a = Side(byte_ids, byte_level_bytes(byte_path), ",", "|")
        self.b = Side(PieceWords(processor).encode, piece_bytes(processor), ",", ";")
        self.written = pa.array(self.a.written + self.b.written, pa.string())

    def ids(self, texts):
        """Lists of ids by both sides, empty where a side's joined bytes are not those of blank + text."""
        wanted = pa.array([b" " + text.encode() for text in texts], pa.large_binary())
        ids = self.a.encode(texts), self.b.encode(texts)
        same = pc.and_(*(pc.equal(side.joined(_lists(own)), wanted) for side, own in zip((self.a, self.b), ids)))
        kept = [bool(text) and ok for text, ok in zip(texts, same.to_pylist())]
        if all(kept):
            return [_lists(own) for own in ids]
        return [_lists([x if ok else x[:0] for x, ok in zip(own, kept)]) for own in ids]

    def align(self, texts):
        """Columns n_a, n_b, n_groups, n_links, groups_sha256 and links of a batch of texts (no nulls)."""
        lists = self.ids(texts)
        documents, ends = zip(*(side.tokens(own) for side, own in zip((self.a, self.b), lists)))
        flat = [pc.list_flatten(own) for own in lists]
        tables = [
            pa.table({"key": pc.bit_wise_or(pc.shift_left(d, END_BITS), e), name: pa.array(np.arange(len(d), dtype=np.int32))})
            for d, e, name in zip(documents, ends, ("i", "j"))
        ]
        shared = tables[0].join(tables[1], keys="key", join_type="inner", use_threads=False)
        groups, last = [], []
        for name, table in zip(("i", "j"), tables):
            cut = np.zeros(len(table), dtype=np.int64)
            cut[shared[name].to_numpy()] = 1
            groups.append(np.cumsum(cut) - cut)  # the shared ends before a token, over the whole batch
            last.append(cut.astype(bool))
        n = len(texts)
        n_groups = np.bincount(shared["key"].to_numpy() >> END_BITS, minlength=n)
        links = self._links(flat, groups, np.repeat(np.arange(n), n_groups), n)
        return pa.RecordBatch.from_arrays(
            [
                *(pc.list_value_length(own).cast(pa.int64()) for own in lists), pa.array(n_groups, pa.int64()),
                *links[:1], pa.array(self._digests(flat, lists, groups, last), pa.string()), links[1],
            ],
            ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
        )

    @staticmethod
    def _links(flat, groups, doc_of_group, n):
        """(n_links, links) of each document: token pairs that share a group, added up by ids."""
        n_groups = len(doc_of_group)
        sizes = [np.bincount(g, minlength=n_groups) for g in groups]
        wide = sizes[0] * sizes[1] > WIDE
        ids = [own.to_numpy() for own in flat]
        # Groups of a few tokens: all pairs of them, by their places.
        pairs = np.where(wide, 0, sizes[0] * sizes[1])
        of = np.repeat(np.arange(n_groups), pairs)
        at = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        first = [np.cumsum(s) - s for s in sizes]
        rows = [pa.table({
            "doc": doc_of_group[of], "a": ids[0][first[0][of] + at // sizes[1][of]],
            "b": ids[1][first[1][of] + at % sizes[1][of]], "times": np.ones(len(of), dtype=np.int64),
        })]
        if wide.any():  # long groups: their distinct ids with how often each is there
            counted = [
                pa.table({"group": g[wide[g]], name: own[wide[g]]})
                .group_by(["group", name], use_threads=False).aggregate([([], "count_all")])
                .rename_columns(["group", name, f"n_{name}"])
                for g, own, name in zip(groups, ids, ("a", "b"))
            ]
            met = counted[0].join(counted[1], keys="group", join_type="inner", use_threads=False)
            rows.append(pa.table({
                "doc": doc_of_group[met["group"].to_numpy()], "a": met["a"], "b": met["b"],
                "times": pc.multiply(met["n_a"], met["n_b"]),
            }))
        found = pa.concat_tables(rows).group_by(["doc", "a", "b"], use_threads=False).aggregate([("times", "sum")])
        found = found.sort_by("doc")
        doc, times = found["doc"].to_numpy(), found["times_sum"].to_numpy()
        cuts = np.searchsorted(doc, np.arange(n + 1))
        totals = np.append(0, np.cumsum(times))
        structs = pa.StructArray.from_arrays(
            [found[c].combine_chunks().cast(pa.int32()) for c in ("a", "b", "times_sum")], ["a", "b", "times"]
        )
        return pa.array(totals[cuts[1:]] - totals[cuts[:-1]]), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), structs)

    def _digests(self, flat, lists, groups, last):
        """Hash of the written groups of each document; empty without tokens."""
        n_a, n_b = (len(f) for f in flat)
        n_groups = int(max(g[-1] for g in groups)) + 1 if n_a else 0
        # A token comes after all tokens of earlier groups, and those of B after their group's of A.
        before_a = np.append(0, np.cumsum(np.bincount(groups[0], minlength=n_groups)))
        before_b = np.append(0, np.cumsum(np.bincount(groups[1], minlength=n_groups)))
        order = np.empty(n_a + n_b, dtype=np.int64)
        order[np.arange(n_a) + before_b[groups[0]]] = flat[0].to_numpy() + last[0] * self.a.size
        order[np.arange(n_b) + before_a[groups[1] + 1]] = (
            flat[1].to_numpy() + last[1] * self.b.size + len(self.a.written)
        )
        offsets = pc.add(lists[0].offsets, lists[1].offsets)
        parts = pa.ListArray.from_arrays(offsets, pc.take(self.written, pa.array(order)))
        joined = pc.binary_join(parts, "").to_pylist()
        return [hashlib.sha256(t[:-1].encode()).hexdigest() if t else "" for t in joined]


def _lists(ids):
    offsets = np.append(0, np.cumsum([len(i) for i in ids])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, dtype=np.int32)])))


_ALIGNERS = {}


def _aligner(byte_path, piece_path):
    key = byte_path, piece_path
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _aligned(byte_path, piece_path):
    def run(batches):
        aligner = _aligner(byte_path, piece_path)
        for batch in batches:
            doc_ids = batch.column(0).cast(pa.int64())
            texts = [t or "" for t in batch.column(1).to_pylist()]
            begin = held = 0
            for at, text in enumerate(texts):
                held += len(text)
                if held >= BATCH_BYTES or at == len(texts) - 1:
                    found = aligner.align(texts[begin : at + 1])
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(begin, at + 1 - begin), *found.columns], ["doc_id", *found.schema.names]
                    )
                    begin, held = at + 1, 0

    return run


def _partial_counts(batches):
    """(a, b, documents) of batches of links, counted per task as far as memory is bounded."""
    def counted(tables):
        table = pa.concat_tables(tables).group_by(["a", "b"], use_threads=False).aggregate([("documents", "sum")])
        return table.select(["a", "b", "documents_sum"]).rename_columns(["a", "b", "documents"])

    held, rows = [], 0
    for batch in batches:
        links = batch.column(0).flatten()
        held.append(pa.table({
            "a": links.field("a"), "b": links.field("b"), "documents": pa.array(np.ones(len(links), dtype=np.int64)),
        }))
        rows += len(links)
        if rows >= PARTIAL_PAIRS:
            held = [counted(held)]
            rows = held[0].num_rows
            if rows >= PARTIAL_PAIRS // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from counted(held).to_batches()


def pair_counts(aligned, folder):
    """(pair, documents, best) of every linked id pair, written; best: no pair of its A id is in more."""
    parts = aligned.select("links").mapInArrow(_partial_counts, "a int, b int, documents long")
    parts.groupBy("a", "b").agg(F.sum("documents").alias("documents")).write.parquet(f"{folder}/totals")
    totals = aligned.sparkSession.read.parquet(f"{folder}/totals")
    # One row an A id: bounded by the vocabulary.
    most = F.broadcast(totals.groupBy("a").agg(F.max("documents").alias("_most")))
    return totals.join(most, "a").select(
        _pair("a", "b").alias("pair"), "documents", (F.col("documents") == F.col("_most")).alias("best")
    )


def _pair(a, b):
    return F.shiftleft(F.col(a).cast("long"), 32) + F.col(b)


def _least_frequent(counts):
    """The least count, a power of two, that at most ``FREQUENT`` pairs reach."""
    power = F.floor(F.log2("documents") + 1e-9).cast("int")
    sizes = dict(counts.groupBy(power.alias("p")).count().collect())
    least, held = 63, 0
    while least and held + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        held += sizes.get(least, 0)
    return 1 << least


def align_tokens(documents, byte_path, piece_path):
    """One row per row of ``documents`` (doc_id, text) with its alignment and links; see the module.

    A null or empty text, and one whose bytes either side changes, has no tokens: zeros and an
    empty digest. Repeated rows, equal ids and rows without id are documents of their own. No
    rows, no rows. Memory of a task is bounded by ``BATCH_BYTES`` of text or one longer text.
    """
    spark = documents.sparkSession
    folder = scratch_dir(spark, "alignment")
    made = documents.select("doc_id", "text").mapInArrow(_aligned(byte_path, piece_path), ALIGNED)
    made.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/aligned")
    aligned = spark.read.schema(f"{ALIGNED}, row long").parquet(f"{folder}/aligned")
    pair_counts(aligned, folder).write.parquet(f"{folder}/counts")
    counts = spark.read.schema(COUNTS).parquet(f"{folder}/counts")
    frequent = F.col("documents") >= _least_frequent(counts)
    links = aligned.select("row", F.inline("links")).select("row", "times", _pair("a", "b").alias("pair"))
    common = F.broadcast(counts.where(frequent))
    met = links.join(common, "pair").unionByName(
        links.join(common.select("pair"), "pair", "left_anti").join(counts.where(~frequent), "pair"),
        allowMissingColumns=True,
    )
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("links").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
