"""Best-fit packing with swap-based local search.

Pieces shorter than a sequence are dealt by hash to groups of about ``GROUP_PIECES``; each group
is packed in one task by best fit and then by local search. What does not fill its bins well in a
group is packed again with that of the other groups, so the number of groups costs next to nothing.
A task holds a group of four integers a piece, whatever the size of the corpus.
"""

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from tapeloom.llm import wordcache, worker
from tapeloom.settings import scratch_dir

GROUP_PIECES = 50_000
STEPS = 32  # the least that an exchange moves, as a part of a bin
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
ROWS = PIECES + ", row long"
PLACED = ROWS + ", group long, bin long, offset long, fill long"


def cut(n_tokens, capacity):
    """(start, length) of the pieces of a document; only the first may be shorter than ``capacity``."""
    first = n_tokens % capacity
    starts = range(first, n_tokens, capacity)
    return ([(0, first)] if first else []) + [(s, capacity) for s in starts]


def _piecer(path, joins_blanks, end_id, capacity):
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        cache = wordcache.cached(path, joins_blanks)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(cache.encode(text.as_py()) + end)
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return pieces


def tokenized_pieces(documents, tokenizer, joins_blanks=True, end_id=0, capacity=2048):
    """Pieces of every document: its ids by the tokenizer, ``end_id``, cut to ``capacity``.

    A null or empty text is the end id alone. Texts are read where they are stored, not shuffled.
    """
    return documents.select("doc_id", "text").mapInArrow(
        _piecer(tokenizer, joins_blanks, end_id, capacity), PIECES
    )


def best_fit(lengths, capacity):
    """Bins (lists of item numbers): items by falling length, each to the fullest bin it fits."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins, spaces, by_space = [], [], defaultdict(list)
    for item in order:
        need = lengths[item]
        at = bisect_left(spaces, need)
        if at == len(spaces):
            bins.append([item])
            space, where = capacity - need, len(bins) - 1
        else:
            space = spaces[at]
            where = by_space[space].pop()
            if not by_space[space]:
                del by_space[space]
                spaces.pop(at)
            bins[where].append(item)
            space -= need
        if space:
            if space not in by_space:
                insort(spaces, space)
            by_space[space].append(where)
    return bins


class LocalSearch:
    """Exchanges between underfull bins that raise the sum of squared fills until bins empty.

    The emptiest bin is the source. Each of its items looks for a bin it can go to: as it is
    (move), for one smaller item (one for one), or for two smaller items (two for one). Every
    way a bin could make room is listed by the room it makes, then by the length it gives back,
    so the way that leaves the receiving bin fullest is found by bisection; ways of a bin that
    has changed since are dropped when met. An exchange is made only if the target gets fuller than
    the source was, which raises the sum of squared fills, and if it moves a whole item or at least
    a ``STEPS``-th of a bin: exchanges of a few ids go on for very long and empty hardly any bin.
    """

    def __init__(self, lengths, bins, capacity):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.step = max(1, capacity // STEPS)
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.version = [0] * len(bins)
        self.ways = []  # (room, length given back, bin, version, items to give back), sorted
        self.listed = [0] * len(bins)  # ways of each bin as it is now
        for number in range(len(bins)):
            own = list(self._ways(number))
            self.listed[number] = len(own)
            self.ways.extend(own)
        self.ways.sort()
        self.live = len(self.ways)
        self.open = sorted((f, n) for n, f in enumerate(self.fill) if f < capacity)

    def _ways(self, number):
        space = self.capacity - self.fill[number]
        if not 0 < space < self.capacity:
            return
        mark = number, self.version[number]
        of_length = {}
        for item in self.bins[number]:  # items of one length are alike; two of them make a pair
            of_length.setdefault(self.lengths[item], []).append(item)
        yield space, 0, *mark, ()
        sizes = sorted(of_length)
        for i, one in enumerate(sizes):
            items = of_length[one]
            yield space + one, one, *mark, (items[0],)
            if len(items) > 1:
                yield space + 2 * one, 2 * one, *mark, (items[0], items[1])
            for two in sizes[i + 1 :]:
                yield space + one + two, one + two, *mark, (items[0], of_length[two][0])

    def _changed(self, number, fill):
        old = (self.fill[number], number)
        at = bisect_left(self.open, old)
        if at < len(self.open) and self.open[at] == old:
            self.open.pop(at)
        self.fill[number] = fill
        self.version[number] += 1
        if 0 < fill < self.capacity:
            insort(self.open, (fill, number))
        own = list(self._ways(number))
        self.live += len(own) - self.listed[number]
        self.listed[number] = len(own)
        for way in own:
            insort(self.ways, way)
        if len(self.ways) > 2 * self.live + 10_000:  # mostly ways of bins that have changed since
            self.ways = [way for way in self.ways if way[3] == self.version[way[2]]]

    def _improve(self, source, item):
        """Make the best exchange for ``item`` of ``source``; False if there is none.

        Of ways with the same room the first gives back least: if even that leaves no gain, none
        of them does, and the search goes on at the next room there is.
        """
        size = self.lengths[item]
        at = bisect_left(self.ways, (size,))
        while at < len(self.ways):
            room, given, target, version, back = self.ways[at]
            if version != self.version[target]:
                self.ways.pop(at)
            elif given and size - given < self.step:
                at = bisect_left(self.ways, (room + 1,), at)
            elif target == source:
                at += 1
            elif self.fill[target] + size - given <= self.fill[source]:
                # Room and length given back tell the fill, so all ways equal in both are no better.
                at = bisect_left(self.ways, (room, given + 1), at)
            else:
                self.bins[source].remove(item)
                self.bins[source].extend(back)
                self.bins[target] = [i for i in self.bins[target] if i not in back] + [item]
                self._changed(source, self.fill[source] - size + given)
                self._changed(target, self.fill[target] + size - given)
                return True
        return False

    def run(self, fewest):
        """Work on bins from the emptiest until ``fewest`` are left or nothing improves.

        A bin that nothing improves is no longer a source, until it changes. This ends, as the sum
        of squared fills grows with each exchange.
        """
        left = sum(map(bool, self.bins))
        while self.open and left > fewest:
            source = self.open[0][1]
            items = sorted(self.bins[source], key=lambda i: (-self.lengths[i], i))
            if not any(self._improve(source, item) for item in items):
                self.open.pop(0)
            elif not self.bins[source]:
                left -= 1
        return [b for b in self.bins if b]


def pack(lengths, capacity):
    """Best fit, then local search; never more bins than best fit alone."""
    fewest = -(-sum(lengths) // capacity)
    bins = best_fit(lengths, capacity)
    return bins if len(bins) == fewest else LocalSearch(lengths, bins, capacity).run(fewest)


def _pack_group(capacity):
    def packed(part):
        worker.begins("packing")
        part = part.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True]).reset_index(drop=True)
        lengths = part["length"].tolist()
        where, offset, fill = (np.zeros(len(part), dtype="int64") for _ in range(3))
        for number, items in enumerate(pack(lengths, capacity)):
            ends = np.cumsum([lengths[i] for i in items])
            where[items], fill[items] = number, ends[-1]
            offset[items] = np.append(0, ends[:-1])
        return part.assign(bin=where, offset=offset, fill=fill)

    return packed


def _in_groups(pieces, count, capacity, group_pieces, path):
    """Pieces packed in groups and written; dealt by their row number, so copies are spread too."""
    groups = max(1, -(-count // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("long"))
    dealt.groupBy("group").applyInPandas(_pack_group(capacity), PLACED).write.parquet(path)
    return pieces.sparkSession.read.schema(PLACED).parquet(path)


def _numbered(placed):
    """``placed`` with ``sequence``: its bin's number among the bins of all groups, from 0."""
    sizes = placed.groupBy("group").agg((F.max("bin") + 1).alias("_bins"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    lifts = sizes.select("group", F.coalesce(F.sum("_bins").over(before), F.lit(0)).alias("_lift"))
    # One row a group of many thousand pieces.
    return placed.join(F.broadcast(lifts), "group").withColumn("sequence", F.col("_lift") + F.col("bin"))


def pack_pieces(spark, pieces, capacity=2048, group_pieces=GROUP_PIECES):
    """Place every piece: its columns, ``sequence_id`` and ``offset``.

    Full pieces are sequences by themselves. The others are packed in groups; of those, bins
    that are not full are taken apart and packed once more, all groups together, dealt anew.
    Sequence ids are unique, not dense. Null doc_ids and repeated rows are pieces like others.
    """
    stored = scratch_dir(spark, "pieces")
    pieces.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{stored}/cut")
    pieces = spark.read.schema(ROWS).parquet(f"{stored}/cut")
    short = pieces.where(F.col("length") < capacity)
    first = _in_groups(short, short.count(), capacity, group_pieces, f"{stored}/first")
    names = [c.split()[0] for c in PIECES.split(", ")]
    again = first.where(F.col("fill") < capacity).select(*names, "row")
    second = _in_groups(again, again.count(), capacity, group_pieces, f"{stored}/second")
    # Three series of ids: bins of the first and second packing, then full pieces.
    alone = pieces.where(F.col("length") == capacity).select(
        *names, (F.col("row") * 3 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    full = _numbered(first).where(F.col("fill") == capacity)
    return (
        full.select(*names, (F.col("sequence") * 3).alias("sequence_id"), "offset")
        .unionByName(_numbered(second).select(*names, (F.col("sequence") * 3 + 1).alias("sequence_id"), "offset"))
        .unionByName(alone)
    )
