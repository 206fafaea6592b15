"""Maximal repeats over a corpus by common-prefix interval trees, and removal of what repeats.

A suffix array of all bytes of a corpus is far larger than the corpus, so it is built where
repeats can be, and in parts that do not need each other:

1. Every window of ``length`` bytes belongs to the anchor at its least 24-byte hash. Equal windows
   have equal anchors at the same place, so anchors that occur once in the corpus rule their
   windows out, and equal windows always meet in the part of their anchor. One window in some 40
   starts a new anchor.
2. The stretches around anchors that occur again are gathered by anchor. Each part is an enhanced
   suffix array of all windows of its stretches: suffixes in order (by a fingerprint of the first
   ``length`` bytes, which makes every common-prefix interval of at least that depth contiguous,
   then byte by byte), common-prefix lengths of neighbours, and what is left of each suffix.
3. A scan with a stack finds the intervals of the common-prefix tree. An interval is a repeat that
   cannot be extended to the left if the bytes in front of its suffixes differ. It is reported
   with all its occurrences, not just neighbours. Repeats are cut where a stretch ends: the next
   anchor reports how they go on, so an interval with a suffix at a stretch's start counts too.
4. Every occurrence of a group but the earliest is removed; spans of all groups are merged. For that,
   groups are not written out: intervals lie in each other, so a group of many near copies would
   list its places once for each of its members. The same scan hands up only the earliest suffix of
   an interval; any other is done with at the deepest interval that has an earlier one.

A task holds one batch of parts, ``BATCH_BYTES`` or one anchor's different stretches, and orders some
``WINDOWS`` of its windows at a time, dealt by fingerprint. Anchors with
more than ``HOT`` occurrences are split window by window, and equal windows are grouped by Spark without
Python: the first occurrence is found before the shuffle and joined back, by broadcast where a window
is in more than ``HOT`` documents, so no task holds all occurrences of one.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapeloom.llm import worker
from tapeloom.settings import scratch_dir

GRAM = 24  # bytes hashed for an anchor
PIECE = 1 << 19  # windows of a text worked on at a time; a power of two below 2^20
HOT = 200_000  # occurrences of an anchor beyond which its windows are dealt one by one
BATCH_BYTES = 1 << 19
WINDOWS = 1 << 17  # windows ordered at a time, and those of one fingerprint at least
SLICE_BYTES = 1 << 18  # bytes of stretches fingerprinted at a time
SPANS_HELD = 200_000  # spans of copies a task merges before it hands them on
BROADCAST_ROWS = 400_000  # rows of 24 bytes up to which a list of documents is broadcast
BROADCAST_SPANS = 1_000_000  # removed runs, 8 bytes each, up to which they are broadcast
LEAST_ID = -(1 << 63)  # stands for a null doc_id, which comes before all others

STRETCHES = "part long, doc long, tie long, starts array<bigint>, before int, n_windows int, bytes binary"
REMOVED = "doc long, tie long, spans array<struct<start:long,stop:long>>"
COVERED = "doc long, tie long, start long, stop long"
GROUPS = "group string, length int, doc long, tie long, start long, first boolean"

_U = np.uint64
_MULTIPLIER = 0xC2B2AE3D27D4EB4F
_EVERY = (1 << 64) - 1
_PLACE = _U(0xFFFFF)


def _mix(h):
    h = (h ^ (h >> _U(32))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(29))


def rolling(data, size):
    """64-bit hashes of all substrings of ``size`` bytes, by doubling."""
    if len(data) < size:
        return np.empty(0, dtype=np.uint64)
    power = _mix((data.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
    step, multiplier, total, done = 1, _MULTIPLIER, None, 0
    while True:
        if size & step:
            if total is None:
                total, done = power, step
            else:
                n = len(data) - done - step + 1
                total = total[:n] * _U(multiplier) + power[done : done + n]
                done += step
        if done == size:
            return _mix(total)
        n = len(data) - 2 * step + 1
        power = power[:n] * _U(multiplier) + power[step : step + n]
        power ^= power >> _U(31)
        multiplier = multiplier * multiplier & _EVERY
        step *= 2


def anchors(data, length):
    """(anchor hash, first window, number of windows) of the runs of windows with one anchor.

    A long text is worked on in pieces; a run that a piece's end cuts is two runs, the same for
    every reader of this text, and its windows are still listed under their anchor.
    """
    found = []
    windows = len(data) - length + 1
    width = length - GRAM + 1
    for begin in range(0, max(0, windows), PIECE):
        count = min(PIECE, windows - begin)
        hashes = rolling(data[begin : begin + count + length - 1], GRAM)
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        least = np.minimum(least[:count], least[width - step : width - step + count])
        at = (least & _PLACE).astype(np.int64)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        found.append((hashes[at[starts]], starts + begin, np.diff(np.append(starts, count))))
    if not found:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes_of(text):
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def intervals(common, least):
    """(depth, low, high) of the common-prefix intervals at least ``least`` deep, by a stack scan.

    ``common[i]`` is the common prefix of suffixes i and i + 1 in order; ``high`` is inclusive.
    """
    found, stack = [], []
    for i, depth in enumerate([*common, 0]):
        low = i
        while stack and stack[-1][0] > depth:
            deep, low = stack.pop()
            found.append((deep, low, i))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, low))
    return found


def earlier(common, least, places, front, opens):
    """(suffix, depth) of every suffix that is not the earliest of a maximal interval, with its deepest one.

    The stack scan of ``intervals``; an entry of the stack holds its depth, its earliest suffix, those that
    are not, the byte in front of all (-2: they differ) and whether one opens a stretch. Suffixes
    of an interval that extends to the left as a whole are covered by that extension.
    """
    stack = []

    def joined(entry, rep, byte, opening):
        if places[rep] < places[entry[1]]:
            rep, entry[1] = entry[1], rep
        entry[2].append(rep)
        if byte != entry[3]:
            entry[3] = -2
        entry[4] |= opening

    for i, depth in enumerate([*common, 0][: len(places)]):  # without suffixes there is no end either
        rep, byte, opening = i, front[i], opens[i]
        while stack and stack[-1][0] > depth:
            entry = stack.pop()
            joined(entry, rep, byte, opening)
            deep, rep, others, byte, opening = entry
            if opening or byte < 0:
                for other in others:
                    yield other, deep
        if depth >= least:
            if stack and stack[-1][0] == depth:
                joined(stack[-1], rep, byte, opening)
            else:
                stack.append([depth, rep, [], byte, opening])


def fingerprints(stretches, length):
    """Hashes of the windows of all stretches, in order; some stretches are hashed at a time."""
    found, held, size = [np.empty(0, dtype=np.uint64)], [], 0

    def hashed():
        prints = rolling(np.frombuffer(b"".join(s[0] for s in held), dtype=np.uint8), length)
        begins = np.cumsum([0, *(len(s[0]) for s in held)]).tolist()
        return np.concatenate([prints[a : a + s[2]] for a, s in zip(begins, held)])

    for stretch in stretches:
        held.append(stretch)
        size += len(stretch[0])
        if size > SLICE_BYTES:
            found.append(hashed())
            held, size = [], 0
    return np.concatenate([*found, hashed()] if held else found)


class SuffixArray:
    """The enhanced suffix array of the windows of some stretches.

    ``stretches`` is a list of (bytes, byte in front or -1, number of windows). Intervals lie in the
    windows of one fingerprint, so those of some fingerprints can be ordered without the others:
    ``chosen`` numbers them among all windows, of which ``prints`` are the fingerprints.
    """

    def __init__(self, stretches, length, prints=None, chosen=None):
        self.length = length
        sizes = np.array([len(s[0]) for s in stretches], dtype=np.int64)
        self.text = np.frombuffer(b"".join(s[0] for s in stretches), dtype=np.uint8)
        begins = np.cumsum(sizes) - sizes
        windows = np.array([s[2] for s in stretches], dtype=np.int64)
        prints = fingerprints(stretches, length) if prints is None else prints
        chosen = np.arange(len(prints)) if chosen is None else chosen
        prints, ends = prints[chosen], np.cumsum(windows)
        owner = np.searchsorted(ends, chosen, side="right")
        offset = chosen - (ends - windows)[owner]
        at = begins[owner] + offset
        front = self.text[at - 1].astype(np.int64)
        opens = offset == 0
        front[opens] = np.array([s[1] for s in stretches], dtype=np.int64)[owner[opens]]
        order = np.argsort(prints, kind="stable")
        prints, owner, offset, at, front, opens = (x[order] for x in (prints, owner, offset, at, front, opens))
        # Runs of one fingerprint are the intervals of depth ``length``. What is not diverse on the
        # left as a whole is not so in any part, and is dropped before the rest is compared.
        starts = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.empty(0, dtype=int)
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(prints))))
        sizes_of = np.bincount(run, minlength=len(starts))
        lowest, highest = np.full(len(starts), 999), np.full(len(starts), -999)
        np.minimum.at(lowest, run, front)
        np.maximum.at(highest, run, front)
        diverse = (lowest != highest) | (np.bincount(run, opens, len(starts)) > 0) | (lowest < 0)
        keep = ((sizes_of > 1) & diverse)[run]
        self.run, self.owner, self.offset, self.front, self.opens = (x[keep] for x in (run, owner, offset, front, opens))
        self.at = at[keep]
        self.rest = sizes[self.owner] - self.offset - length
        self._sort()

    def _sort(self):
        """Order suffixes inside runs by the bytes after the first ``length``, and compare neighbours."""
        n, deepest = len(self.at), int(self.rest.max()) if len(self.at) else 0
        words = -(-deepest // 8)
        keys = []
        padded = np.append(self.text, np.zeros(8 * words + self.length + 8, dtype=np.uint8))
        for word in range(words):
            key = np.zeros(n, dtype=np.uint64)
            for i in range(8 * word, 8 * word + 8):
                byte = padded[self.at + self.length + i].astype(np.uint64) * (i < self.rest)
                key = key << _U(8) | byte
            keys.append(key)
        order = np.lexsort((self.rest, *keys[::-1], self.run)) if n else np.empty(0, dtype=int)
        for name in ("run", "owner", "offset", "front", "opens", "at", "rest"):
            setattr(self, name, getattr(self, name)[order])
        keys = [k[order] for k in keys]
        if n < 2:
            self.common = np.zeros(0, dtype=np.int64)
            return
        same = self.run[1:] == self.run[:-1]
        shared = np.zeros(n - 1, dtype=np.int64)
        going = same.copy()
        for key in keys:
            differ = key[1:] ^ key[:-1]
            equal = np.full(n - 1, 8, dtype=np.int64)
            for byte in range(8):
                equal[(differ >> _U(56 - 8 * byte) & _U(255) != 0) & (equal == 8)] = byte
            shared += np.where(going, equal, 0)
            going &= equal == 8
        shared = np.minimum(shared, np.minimum(self.rest[1:], self.rest[:-1]))
        self.common = np.where(same, self.length + shared, 0)

    def groups(self):
        """(depth, suffix numbers) of the intervals that differ on the left or touch a stretch's start."""
        for depth, low, high in intervals(self.common.tolist(), self.length):
            part = slice(low, high + 1)
            front = self.front[part]
            if self.opens[part].any() or (front != front[0]).any() or front[0] < 0:
                yield depth, np.arange(low, high + 1)


def _listed(length):
    def run(batches):
        worker.begins("repeats")
        for batch in batches:
            docs, hashes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, _, _ = anchors(_bytes_of(text.as_py()), length)
                distinct, counts = np.unique(found, return_counts=True)
                # An anchor that the text has twice counts twice, so that the corpus has it again.
                listed = np.concatenate([distinct, distinct[counts > 1]])
                hashes.append(listed)
                docs.append(np.full(len(listed), doc, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.uint64), *hashes]).view(np.int64)),
                 pa.array(np.concatenate([np.empty(0, np.int64), *docs]))],
                names=["part", "doc"],
            )

    return run


def _cut(length, hot, windows=False):
    """Stretches around the anchors of ``again`` that are not hot, or ``windows`` of those that are.

    Equal stretches of a document are one row with all their places.
    """

    def run(batches):
        worker.begins("repeats")
        for batch in batches:
            rows = []
            for doc, tie, text, again in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            ):
                data = _bytes_of(text.as_py())
                raw = data.tobytes()
                wanted = np.sort(again.values.to_numpy().view(np.uint64))
                hashes, starts, counts = anchors(data, length)
                if not len(hashes):
                    continue
                found = {}
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                for i in np.flatnonzero(wanted[at] == hashes):
                    start, count, part = int(starts[i]), int(counts[i]), int(hashes[i].view(np.int64))
                    if (part in hot) != windows:
                        continue
                    if windows:
                        prints = rolling(data[start : start + count + length - 1], length).view(np.int64)
                        for j, single in enumerate(prints.tolist()):
                            kind = single, -1, 1, raw[start + j : start + j + length]
                            found.setdefault(kind, []).append(start + j)
                        continue
                    before = int(data[start - 1]) if start else -1
                    kind = part, before, count, raw[start : start + count + length - 1]
                    found.setdefault(kind, []).append(start)
                rows.extend((kind[0], doc, tie, starts, *kind[1:]) for kind, starts in found.items())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in STRETCHES.split(", ")]
            )

    return run


def _covered(length):
    """Merged spans (doc, tie, start, stop) that occur earlier, of the parts of a partition sorted as for groups.

    Of equal stretches the first stands for all; the others are covered as a whole and are not held.
    """
    def spans_of(kinds):
        stretches = [(data, before, count) for _, before, count, data, *_ in kinds]
        prints = fingerprints(stretches, length)
        shares = -(-len(prints) // WINDOWS)
        for share in range(shares):
            chosen = np.flatnonzero(prints % _U(shares) == share)
            yield from spans_among(kinds, SuffixArray(stretches, length, prints, chosen))

    def spans_among(kinds, array):
        doc, tie, start = (np.array([k[i] for k in kinds], dtype=np.int64)[array.owner] for i in (4, 5, 6))
        start += array.offset
        rank = np.empty(len(start), dtype=np.int64)
        rank[np.lexsort((start, tie, doc))] = np.arange(len(start))
        found = list(earlier(array.common.tolist(), length, rank.tolist(), array.front.tolist(), array.opens.tolist()))
        suffixes, depths = (np.array(x, dtype=np.int64) for x in (zip(*found) if found else ((), ())))
        starts = start[suffixes]
        return zip(doc[suffixes].tolist(), tie[suffixes].tolist(), starts.tolist(), (starts + depths).tolist())

    def batch_of(spans):
        rows = [(*key, a, b) for key, own in spans.items() for a, b in merge(sorted(own))]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "tie", "start", "stop"])

    def run(batches):
        worker.begins("repeats")
        kinds, size, spans, held = [], 0, {}, 0

        def close():
            nonlocal held
            for doc, tie, start, stop in spans_of(kinds) if len(kinds) > 1 else ():
                spans.setdefault((doc, tie), []).append((start, stop))
                held += 1

        for batch in batches:
            for part, doc, tie, starts, before, count, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kinds and kinds[-1][:4] == (part, before, count, data):
                    # Rows equal in id and text are one document: the first place is in each of them.
                    copies = starts if (doc, tie) != kinds[-1][4:6] else starts[1:]
                else:
                    if kinds and kinds[-1][0] != part and size > BATCH_BYTES:
                        close()
                        kinds, size = [], 0
                    kinds.append((part, before, count, data, doc, tie, starts[0]))
                    size += len(data)
                    copies = starts[1:]
                if copies:
                    spans.setdefault((doc, tie), []).extend((start, start + len(data)) for start in copies)
                    held += len(copies)
                if held > SPANS_HELD:
                    yield batch_of(spans)
                    spans, held = {}, 0
        close()
        yield batch_of(spans)
        kinds, spans = [], {}
        worker.rests()

    return run


def _grouped(length):
    """Maximal repeat groups of the parts of a partition sorted by part, bytes, and place."""

    def groups_of(held):
        """Rows of one batch of whole parts. Equal stretches share one set of suffixes."""
        if not held:
            return
        kinds, members = [], []
        for part, doc, tie, starts, before, count, data in held:
            if not kinds or kinds[-1] != (part, before, count, data):
                kinds.append((part, before, count, data))
                members.append([])
            members[-1].extend((doc, tie, start) for start in starts)
        # A stretch that occurs again is given twice, so that its suffixes have a neighbour.
        stretches, number = [], []
        for i, (_, before, count, data) in enumerate(kinds):
            for _ in range(min(2, len(members[i]))):
                stretches.append((data, before, count))
                number.append(i)
        array = SuffixArray(stretches, length)
        number = np.array(number)
        for depth, suffixes in array.groups():
            places, seen = [], set()
            for s in suffixes.tolist():
                kind, offset = int(number[array.owner[s]]), int(array.offset[s])
                if (kind, offset) in seen:
                    continue
                seen.add((kind, offset))
                places.extend((doc, tie, start + offset) for doc, tie, start in members[kind])
            first = min(places)
            name = f"{first[0]}:{first[1]}:{first[2]}:{depth}"
            for place in places:
                yield name, depth, *place, place == first

    def batch_of(rows):
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        columns = list(zip(*rows)) or [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in GROUPS.split(", ")]
        )

    def run(batches):
        held, size, part = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != part:
                    part = row[0]
                    if size > BATCH_BYTES:
                        yield batch_of(list(groups_of(held)))
                        held, size = [], 0
                held.append(row)
                size += len(row[6])
        yield batch_of(list(groups_of(held)))

    return run


def originals_of(documents):
    """(doc, tie, text, copies): one row for each text, the earliest document that has it.

    ``doc`` is the doc_id (the least number for null), ``tie`` a hash of the text, which orders rows
    equal in doc_id.
    """
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _small(frame, rows):
    return F.broadcast(frame) if frame.count() <= rows else frame


class Repeats:
    """Maximal repeat groups of at least ``length`` bytes in the texts of ``documents`` (doc_id, text).

    Texts are UTF-8 bytes, null is empty, and matches never cross documents. Of equal texts only the
    one with the smallest doc_id takes part; ``index`` says which. Rows equal in doc_id and text are
    one document.
    """

    def __init__(self, documents, length=100):
        self.length, self.spark = length, documents.sparkSession
        self.rows = originals_of(documents)
        self.folder = scratch_dir(self.spark, "repeats")
        digest = F.unhex(F.md5("text"))
        texts = self.rows.select("doc", "tie", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
        texts.write.parquet(f"{self.folder}/index")
        self.index = self.spark.read.parquet(f"{self.folder}/index")
        owners = self.index.groupBy("digest").agg(F.min("doc").alias("owner"))
        copies = self.index.join(owners, "digest").where("doc <> owner").select("doc", "tie").distinct()
        copies.write.parquet(f"{self.folder}/copies")
        self.copies = self.spark.read.schema("doc long, tie long").parquet(f"{self.folder}/copies")

    def originals(self):
        return self.rows.join(_small(self.copies, BROADCAST_ROWS), ["doc", "tie"], "left_anti")

    def groups(self):
        """(group, length, doc, tie, start, first) of every occurrence of every group."""
        hot, ordered, windows = self._stretches()
        groups = ordered.mapInArrow(_grouped(self.length), GROUPS)
        return groups.unionByName(self._hot_groups(windows)) if hot else groups

    def _stretches(self):
        """(hot anchors, stretches of the others by part, windows of the hot ones)."""
        # One number for a row: if two rows share it, both are cut by the anchors of both, to no harm.
        key = F.xxhash64("doc", "tie")
        texts = self.originals().where(F.octet_length("text") >= self.length)
        listed = texts.select(key.alias("doc"), "text").mapInArrow(_listed(self.length), "part long, doc long")
        listed.write.parquet(f"{self.folder}/listed")
        listed = self.spark.read.schema("part long, doc long").parquet(f"{self.folder}/listed")
        counts = listed.groupBy("part").agg(F.count("*").alias("n")).where("n > 1")
        counts.write.parquet(f"{self.folder}/counts")
        counts = self.spark.read.schema("part long, n long").parquet(f"{self.folder}/counts")
        # At most anchors / HOT parts can be hot.
        hot = frozenset(r["part"] for r in counts.where(F.col("n") > HOT).select("part").collect())
        again = listed.join(counts, "part").groupBy("doc").agg(F.collect_set("part").alias("again"))
        again = again.withColumnRenamed("doc", "_key")
        wanted = texts.withColumn("_key", key).join(again, "_key").select("doc", "tie", "text", "again")
        stretches = wanted.mapInArrow(_cut(self.length, hot), STRETCHES)
        ordered = stretches.repartition("part").sortWithinPartitions("part", "bytes", "before", "n_windows", "doc", "tie")
        windows = wanted.mapInArrow(_cut(self.length, hot, windows=True), STRETCHES).select("bytes", "doc", "tie", "starts")
        return hot, ordered, windows

    def _hot_groups(self, windows):
        """A group for each of ``windows`` that occurs again, without a task that holds all its occurrences."""
        windows.write.parquet(f"{self.folder}/windows")
        windows = self.spark.read.schema("bytes binary, doc long, tie long, starts array<bigint>").parquet(f"{self.folder}/windows")
        place = F.struct("doc", "tie", F.array_min("starts").alias("start"))
        firsts = windows.groupBy("bytes").agg(F.min(place).alias("least"), F.sum(F.size("starts")).alias("n"), F.count("*").alias("n_rows"))
        firsts.where("n > 1").select("bytes", "least", "n_rows").write.parquet(f"{self.folder}/firsts")
        firsts = self.spark.read.schema(
            "bytes binary, least struct<doc:bigint,tie:bigint,start:bigint>, n_rows long"
        ).parquet(f"{self.folder}/firsts")
        # At most rows / HOT windows are in more than HOT rows; others are joined by shuffle.
        heavy = F.broadcast(firsts.where(F.col("n_rows") > HOT).select("bytes", "least"))
        light = firsts.where(F.col("n_rows") <= HOT).select("bytes", "least")
        joined = windows.join(heavy, "bytes").unionByName(windows.join(heavy, "bytes", "left_anti").join(light, "bytes"))
        placed = joined.select("least", "doc", "tie", F.explode("starts").alias("start"))
        name = F.concat_ws(":", "least.doc", "least.tie", "least.start", F.lit(self.length))
        return placed.select(
            name.alias("group"), F.lit(self.length).alias("length"), "doc", "tie", "start",
            (F.struct("doc", "tie", "start") == F.col("least")).alias("first"),
        )

    def removed(self):
        """(doc, tie, spans): merged runs [start, stop) that occur earlier, of every original with any."""
        hot, ordered, windows = self._stretches()
        spans = ordered.mapInArrow(_covered(self.length), COVERED)
        if hot:
            single = self._hot_groups(windows).where("NOT first")
            spans = spans.unionByName(single.select("doc", "tie", "start", (F.col("start") + F.col("length")).alias("stop")))
        listed = F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")
        return spans.groupBy("doc", "tie").agg(listed).mapInArrow(_merged, REMOVED)


def merge(spans):
    """Sorted (start, stop) spans without overlap or touch."""
    found = []
    for start, stop in spans:
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], stop)
        else:
            found.append([start, stop])
    return found


def _merged(batches):
    for batch in batches:
        spans = [[{"start": a, "stop": b} for a, b in merge((s["start"], s["stop"]) for s in own)] for own in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, batch.schema.types[2])], ["doc", "tie", "spans"])


def _kept(raw, spans):
    cuts = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def with_spans(documents, length=100):
    """Every row of ``documents``, with ``__spans`` (start, stop), sorted, null where nothing repeats.

    A copy of an earlier text of at least ``length`` bytes repeats as a whole.
    """
    repeats = Repeats(documents, length)
    repeats.removed().write.parquet(f"{repeats.folder}/removed")
    removed = repeats.spark.read.schema(REMOVED).parquet(f"{repeats.folder}/removed")
    total = removed.agg(F.sum(F.size("spans"))).first()[0] or 0
    # Names that no column of the documents has. Copies take no part in the search, so a row is in one list.
    doc, tie, copy, spans = ("__doc", "__tie", "__copy", "__spans")
    names = [F.col("doc").alias(doc), F.col("tie").alias(tie)]
    listed = removed.select(*names, F.col("spans").alias(spans), F.lit(False).alias(copy)).unionByName(
        repeats.copies.select(*names, F.lit(None).cast("array<struct<start:long,stop:long>>").alias(spans), F.lit(True).alias(copy))
    )
    if total <= BROADCAST_SPANS and repeats.copies.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    rows = documents.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))).withColumn(
        tie, F.xxhash64(F.coalesce("text", F.lit("")))
    )
    size = F.octet_length("text").cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("stop")))
    return (
        rows.join(listed, [doc, tie], "left")
        .withColumn(spans, F.when(F.col(copy) & (size >= length), whole).otherwise(F.col(spans)))
        .select(*documents.columns, spans)
    )


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(batches):
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            raw = _bytes_of(text.as_py()).tobytes()
            runs = merge((s["start"], s["stop"]) for s in spans or ())
            removed = sum(b - a for a, b in runs)
            rows.append((doc_id, len(raw), removed, len(runs), hashlib.sha256(_kept(raw, runs)).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in DIGESTS.split(", ")]
        )


def removal_digests(documents, length=100):
    """Counts of removed bytes and runs, and the SHA-256 of the bytes left, of every document."""
    rows = with_spans(documents.select("doc_id", "text"), length)
    return rows.select("doc_id", "text", "__spans").mapInArrow(_digests, DIGESTS)


def without_repeats(documents, length=100):
    """The rows of ``documents``, all columns, with repeated bytes cut out of ``text``.

    A character that a cut leaves in part goes with it. Null texts stay null, and a text that
    repeats as a whole is empty. Where there is a column ``n_chars``, it follows a text that is cut.
    """
    rows = with_spans(documents, length)
    place, spans_at = rows.columns.index("text"), rows.columns.index("__spans")
    chars_at = rows.columns.index("n_chars") if "n_chars" in rows.columns else -1

    def cut(batches):
        worker.begins("repeats")
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(place), batch.column(spans_at).to_pylist()):
                if spans:
                    raw = _bytes_of(text.as_py()).tobytes()
                    texts.append(_kept(raw, merge((s["start"], s["stop"]) for s in spans)).decode("utf-8", "ignore"))
                else:
                    texts.append(text.as_py())
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            if chars_at >= 0:
                cut_rows = zip(batch.column(spans_at).is_valid().to_pylist(), texts, batch.column(chars_at).to_pylist())
                columns[chars_at] = pa.array([len(t) if cut_ else n for cut_, t, n in cut_rows], batch.schema.types[chars_at])
            yield pa.RecordBatch.from_arrays(columns[:-1], names=batch.schema.names[:-1])

    return rows.mapInArrow(cut, documents.schema)
