"""Benchmark passages in documents, up to an edit distance: pigeonhole pieces and Myers' algorithm.

A test item with an error budget of k is cut into k + 1 pieces. Wherever a document holds the item
within k edits, it holds at least one piece exactly; an automaton over all pieces finds those hits.
Pieces form a binary tree in which a node of j pieces may have j - 1 errors. If a node keeps to its
budget then so does one of its children, so a hit is verified from its leaf upwards, and most end
at the first parent. Distances are by Myers' bit-parallel algorithm on integers of any width.

Texts are compared in lower case, each stretch of characters other than letters and digits as one
blank. The items travel to the tasks in blocks of a bounded number of characters, one scan of the
documents a block; documents are never shuffled.
"""

import re

import ahocorasick
import pyarrow as pa

from tapeloom.llm import worker

RATE = 0.1  # errors allowed per character of an item
SHORTEST = 25  # characters; a shorter item must be a whole document
BLOCK_CHARS = 4_000_000  # characters of items in one scan

MATCHES = "doc_id long, item_id long, distance int, item_chars int, start long, stop long"

_OTHER = re.compile(r"[\W_]+")


def normalise(text):
    return _OTHER.sub(" ", text.lower()).strip()


def masks_of(pattern):
    masks = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks, m, text, budget):
    """(distance, end) of the best match of the pattern anywhere in ``text``; None beyond ``budget``.

    ``end`` is the first position after the match with the least distance. ``m`` is the length
    of the pattern and ``masks`` its ``masks_of``.
    """
    if not m:
        return 0, 0
    every, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = every, 0, m, None
    if m <= budget:
        best = m, 0
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(x | up) & every
        fall = up & x
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise = rise << 1 & every  # a match may start anywhere
        fall = fall << 1 & every
        x2 = eq | down
        up = fall | ~(x2 | rise) & every
        down = rise & x2
        if score <= budget and (best is None or score < best[0]):
            best = score, at + 1
    return best


class Item:
    """A test item: its text, budget, and the tree over its pieces."""

    def __init__(self, item_id, text, rate):
        self.item_id, self.text = item_id, text
        self.budget = int(rate * len(text))
        pieces = self.budget + 1
        self.cuts = [i * len(text) // pieces for i in range(pieces + 1)]
        self.masks, self.paths, self.probes = {}, {}, {}

    def piece(self, number):
        return self.text[self.cuts[number] : self.cuts[number + 1]]

    def path(self, number):
        """Spans of pieces from the parent of piece ``number`` up to the whole item."""
        if number not in self.paths:
            spans, low, high = [], 0, self.budget + 1
            while high - low > 1:
                spans.append((low, high))
                middle = (low + high) // 2
                low, high = (low, middle) if number < middle else (middle, high)
            self.paths[number] = spans[::-1]
        return self.paths[number]

    def span(self, low, high):
        """(first character, length, masks) of some pieces."""
        if (low, high) not in self.masks:
            a, b = self.cuts[low], self.cuts[high]
            self.masks[low, high] = a, b - a, masks_of(self.text[a:b])
        return self.masks[low, high]

    def probe(self, number):
        """Where the first parent begins and ends around a hit, and pieces one of which it must hold.

        With the hit exact, the rest of the parent bears all of its budget, so one of budget + 1
        pieces of the rest is exact too.
        """
        if number not in self.probes:
            if not self.budget:
                self.probes[number] = 0, 0, ("",)
            else:
                low, high = self.path(number)[0]
                budget = high - low - 1
                a, b, c, d = (self.cuts[i] for i in (low, number, number + 1, high))
                rest = self.text[a:b] + self.text[c:d]
                # A piece that lies across the hit is no stretch of the item; it is cut in two there.
                cuts = sorted({i * len(rest) // (budget + 1) for i in range(budget + 2)} | {b - a})
                parts = [rest[i:j] for i, j in zip(cuts, cuts[1:])]
                self.probes[number] = b - a + budget, d - b + budget, tuple(parts)
        return self.probes[number]

    def verify(self, text, number, at):
        """(distance, start, stop) of the item around a hit of piece ``number`` at ``at``; or None."""
        before, after, parts = self.probe(number)
        around = text[max(0, at - before) : at + after]
        if not any(part in around for part in parts):
            return None
        stop = at + len(self.piece(number))
        found, begin = (0, stop), at
        for low, high in self.path(number):
            first, length, masks = self.span(low, high)
            budget = high - low - 1
            begin = max(0, at - (self.cuts[number] - first) - budget)
            end = at - (self.cuts[number] - first) + length + budget
            found = myers(masks, length, text[begin:end], budget)
            if found is None:
                return None
            found = found[0], begin + found[1]
        distance, stop = found
        back = text[max(0, stop - len(self.text) - distance) : stop][::-1]
        # The start is where the reversed item ends in the reversed text before ``stop``.
        return distance, stop - _anchored_end(self.text[::-1], back, distance), stop


def _anchored_end(pattern, text, distance):
    """Length of the shortest prefix of ``text`` at ``distance`` from ``pattern``."""
    previous = list(range(len(pattern) + 1))
    if previous[-1] == distance:
        return 0
    for at, c in enumerate(text):
        # Only the diagonals within ``distance`` matter.
        low, high = max(1, at + 1 - distance), min(len(pattern), at + 1 + distance)
        row = [distance + 1] * (len(pattern) + 1)
        row[0] = at + 1
        for j in range(low, high + 1):
            row[j] = min(previous[j] + 1, row[j - 1] + 1, previous[j - 1] + (pattern[j - 1] != c))
        if row[-1] == distance:
            return at + 1
        previous = row
    return len(text)


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items, rate=RATE):
        self.whole, self.items = {}, []
        hits = {}
        for item_id, text in items:
            if not text:
                continue
            if len(text) < SHORTEST:
                self.whole.setdefault(text, []).append(item_id)
                continue
            item = Item(item_id, text, rate)
            self.items.append(item)
            for number in range(item.budget + 1):
                hits.setdefault(item.piece(number), []).append((item, number))
        self.automaton = ahocorasick.Automaton()
        for piece, where in hits.items():
            self.automaton.add_word(piece, (len(piece), where))
        if hits:
            self.automaton.make_automaton()

    def find(self, text, first_only=False):
        """{item_id: (distance, item_chars, start, stop)}, the best match of each item in ``text``.

        Of matches with the same distance, the one found first from the left counts.
        """
        found = {i: (0, len(text), 0, len(text)) for i in self.whole.get(text, ())}
        if not self.items or (first_only and found):
            return found
        tried = {}
        for last, (length, where) in self.automaton.iter(text):
            at = last + 1 - length
            for item, number in where:
                best = found.get(item.item_id)
                if best and (best[0] == 0 or best[2] <= at < best[3]):
                    continue
                # Hits of one stretch of the item at one place say the same.
                mark = item.item_id, number, at - item.cuts[number]
                if tried.get(item.item_id) == mark:
                    continue
                tried[item.item_id] = mark
                match = item.verify(text, number, at)
                if match and (best is None or match[0] < best[0]):
                    found[item.item_id] = match[0], len(item.text), *match[1:]
                    if first_only:
                        return found
        return found


def item_blocks(benchmark, block_chars=BLOCK_CHARS):
    """Items of ``benchmark`` (item_id, text), normalised, in blocks; null texts and ids are left out."""
    block, chars = [], 0
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normalise(row["text"])
        if block and chars + len(text) > block_chars:
            yield block
            block, chars = [], 0
        block.append((row["item_id"], text))
        chars += len(text)
    if block:
        yield block


def find_matches(documents, benchmark, rate=RATE, block_chars=BLOCK_CHARS):
    """A row for each document and item of which the document holds a copy within ``rate`` edits.

    (doc_id, item_id, distance, item_chars, start, stop): the least distance, and the place in the
    document's normalised text. Whole texts are searched. Null and empty texts match nothing;
    rows equal in doc_id give rows each on their own; an item_id with several texts gives its best.
    """

    def matched(block):
        def run(batches):
            matcher = Matcher(block, rate)
            for batch in batches:
                rows = [
                    (doc_id, item_id, *match)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    if text.is_valid
                    for item_id, match in sorted(matcher.find(normalise(text.as_py())).items())
                ]
                columns = list(zip(*rows)) or [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in MATCHES.split(", ")]
                )

        return run

    texts = documents.select("doc_id", "text")
    found = None
    for block in item_blocks(benchmark, block_chars):
        part = texts.mapInArrow(matched(block), MATCHES)
        found = part if found is None else found.unionByName(part)
    return texts.sparkSession.createDataFrame([], MATCHES) if found is None else found


def without_matches(documents, benchmark, rate=RATE, block_chars=BLOCK_CHARS):
    """The rows of ``documents``, all columns, whose text holds no item; null texts stay."""

    def clean(block, place):
        def run(batches):
            worker.begins("decontaminate")
            matcher = Matcher(block, rate)
            for batch in batches:
                keep = [
                    not text.is_valid or not matcher.find(normalise(text.as_py()), first_only=True)
                    for text in batch.column(place)
                ]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for block in item_blocks(benchmark, block_chars):
        documents = documents.mapInArrow(clean(block, documents.columns.index("text")), documents.schema)
    return documents
