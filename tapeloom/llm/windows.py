"""Order-preserving packing: the documents' ids as one stream, cut into windows by dynamic programming.

The windows of a task follow the order of its documents. A window costs its padding (up to
``capacity``, but none where its length is a power of two), plus ``WINDOW`` for being one more,
plus what its end cuts: nothing at the end of a document, ``SENTENCE`` at the end of a sentence,
``INSIDE`` anywhere else. The cheapest cuts up to a place follow from those up to ``capacity``
before it. Padding grows as the start moves back, so the best start for a padded window is the
head of a monotone queue of cost + place; the starts a power of two back are looked up.

Places are all ends of documents and sentences; where these are further apart than ``GAP`` also
every ``GAP`` ids, and in the last window of a task every id, which leaves hardly any padding
there. A task holds the ids of one block of about ``BLOCK_IDS`` ids, or of one longer document;
what follows the best last place of a block is carried to the next one.
"""

import json
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from tapeloom.llm import wordcache

WINDOW, SENTENCE, INSIDE = 32, 4, 64  # costs in ids of padding
GAP = 512  # ids without an end of a sentence after which a window may end anywhere
BLOCK_IDS = 1 << 20
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

# Marks that end a sentence, with what may close after them.
FINAL = re.compile("[.!?…。！？]+[\"'’”)\\]]*")


class Sentences:
    """Where sentences end, by the ids alone: after final marks, unless a digit comes next."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {char: b for b, char in enumerate(wordcache.byte_alphabet())}
        suffix = model.get("end_of_word_suffix") or ""
        self.final = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        self.digit = np.zeros_like(self.final)
        for token, number in model["vocab"].items():
            whole = token.endswith(suffix)
            token = token.removesuffix(suffix) if suffix else token
            if not all(c in byte_of for c in token):
                continue
            text = bytes(byte_of[c] for c in token).decode("utf-8", "replace").strip()
            self.final[number] = whole and bool(FINAL.fullmatch(text))
            self.digit[number] = text[:1].isdigit()

    def ends(self, ids):
        """Numbers of ids up to the end of each sentence; ids beyond the vocabulary end none."""
        known = np.minimum(ids, len(self.final) - 1)
        ends = self.final[known] & (ids < len(self.final))
        ends[:-1] &= ~self.digit[known[1:]]
        return np.flatnonzero(ends) + 1


_SENTENCES = {}


def sentences_of(path):
    """The worker's own ``Sentences`` for a tokenizer file, kept from task to task."""
    if path not in _SENTENCES:
        _SENTENCES[path] = Sentences(path)
    return _SENTENCES[path]


def gap_places(places, gap):
    """Places every ``gap`` ids after a place that is further than ``gap`` from the next one."""
    starts, widths = places[:-1], np.diff(places)
    wide = widths > gap
    counts = (widths[wide] - 1) // gap
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    return np.repeat(starts[wide], counts) + gap * inner


def cheapest(places, penalties, capacity):
    """(costs, before): the least cost of windows that end at each place, and where the last one starts.

    ``places`` begin with 0 and rise by at most ``capacity``; ``penalties`` is what an end costs there.
    """
    n = len(places)
    index_at = np.full(int(places[-1]) + 1, -1, dtype=np.int32)
    index_at[places] = np.arange(n, dtype=np.int32)
    exact = [[] for _ in range(n)]  # starts a power of two before each place
    length = 1
    while length <= capacity:
        at = np.searchsorted(places, length)
        starts = index_at[places[at:] - length]
        for i, start in zip((np.flatnonzero(starts >= 0) + at).tolist(), starts[starts >= 0].tolist()):
            exact[i].append(start)
        length *= 2
    where, extra = places.tolist(), penalties.tolist()
    costs, before = [0] * n, [0] * n
    queue = deque([(0, 0, 0)])  # (cost + place, place, index), rising in all of them
    for i in range(1, n):
        place = where[i]
        while queue[0][1] < place - capacity:
            queue.popleft()
        key, _, start = queue[0]
        cost = key + capacity - place
        for j in exact[i]:
            if costs[j] < cost:
                cost, start = costs[j], j
        cost += WINDOW + extra[i]
        costs[i], before[i] = cost, start
        key = cost + place
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, place, i))
    return costs, before


def window_ends(doc_ends, sentence_ends, capacity, last):
    """Ends of the windows of a block of ids, up to its end if it is the ``last`` one.

    Otherwise up to the place of the last ``capacity`` ids that costs least; the rest is for the
    next block.
    """
    total = int(doc_ends[-1])
    cost_at = np.full(total + 1, -1, dtype=np.int64)  # what an end costs there; -1: no place
    cost_at[sentence_ends] = SENTENCE
    cost_at[doc_ends] = cost_at[0] = 0
    more = gap_places(np.flatnonzero(cost_at >= 0), min(GAP, capacity))
    if last:
        more = np.append(more, np.arange(max(1, total - capacity), total))
    cost_at[more] = np.where(cost_at[more] < 0, INSIDE, cost_at[more])
    places = np.flatnonzero(cost_at >= 0)
    costs, before = cheapest(places, cost_at[places], capacity)
    at = len(places) - 1
    if not last:
        least = int(np.searchsorted(places, total - capacity, side="right"))
        at = min(range(max(1, least), len(places)), key=lambda i: (costs[i], -i))
    ends = []
    while at:
        ends.append(int(places[at]))
        at = before[at]
    return ends[::-1]


class Packer:
    """Windows of one stream of documents; ``add`` and ``finish`` give the pieces placed so far."""

    def __init__(self, sentences, capacity, shard):
        self.sentences, self.capacity = sentences, capacity
        self.sequence = shard << 40
        self.docs = []  # (doc_id, ids before in the document, ids of the document, their bytes)
        self.held = 0

    def add(self, doc_id, ids):
        self.docs.append((doc_id, 0, len(ids) // 4, ids))
        self.held += len(ids) // 4
        return self._place(False) if self.held >= BLOCK_IDS + self.capacity else []

    def finish(self):
        return self._place(True) if self.docs else []

    def _place(self, last):
        data = b"".join(d[3] for d in self.docs)
        ids = np.frombuffer(data, dtype="<u4")
        doc_ends = np.cumsum([len(d[3]) // 4 for d in self.docs])
        windows = np.array(window_ends(doc_ends, self.sentences.ends(ids), self.capacity, last))
        done = int(windows[-1])
        stops = np.union1d(doc_ends[doc_ends < done], windows)
        starts = np.append(0, stops[:-1])
        doc_of = np.searchsorted(doc_ends, starts, side="right")
        window_of = np.searchsorted(windows, starts, side="right")
        doc_starts, window_starts = np.append(0, doc_ends[:-1]), np.append(0, windows[:-1])
        view, rows = memoryview(data), []
        for start, stop, doc, window in zip(starts.tolist(), stops.tolist(), doc_of.tolist(), window_of.tolist()):
            doc_id, skipped, doc_tokens, _ = self.docs[doc]
            rows.append((
                doc_id, skipped + start - int(doc_starts[doc]), stop - start, zlib.crc32(view[4 * start : 4 * stop]),
                doc_tokens, self.sequence + window, start - int(window_starts[window]),
            ))
        self.sequence += len(windows)
        left = int(np.searchsorted(doc_ends, done, side="right"))
        rest = self.docs[left:]
        if rest and done > doc_starts[left]:
            doc_id, skipped, doc_tokens, own = rest[0]
            used = done - int(doc_starts[left])
            rest[0] = doc_id, skipped + used, doc_tokens, own[4 * used :]
        self.docs, self.held = rest, len(ids) - done
        return rows


def _batch(rows):
    fields = [f.split() for f in PIECES.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f[0] for f in fields])


def pack_in_order(documents, tokenizer, joins_blanks=False, end_id=2, capacity=4096):
    """Pieces of the documents' ids (doc_id, text; ids by the tokenizer, then ``end_id``) in windows.

    A null or empty text is the end id alone; repeated rows and rows without doc_id are documents
    of their own; a document longer than a window fills several. Texts are read where they are
    stored, each task's documents in the order of its input, and nothing is shuffled. No rows, no
    pieces. Sequence ids are unique, not dense.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        cache = wordcache.cached(tokenizer, joins_blanks)
        packer = Packer(sentences_of(tokenizer), capacity, TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.extend(packer.add(doc_id, cache.encode(text.as_py()) + end))
            yield _batch(rows)
        yield _batch(packer.finish())

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)
