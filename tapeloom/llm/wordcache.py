"""Token ids of whole texts by the ``tokenizers`` library, asked once per distinct word.

Both kinds of vocabulary split a text before merging, and never join what a single blank between
two other characters parts. So a text is cut at such blanks, every distinct stretch is encoded by
the library and remembered by the Python worker, and the ids of a text are those of its stretches
in order: the same ids as for the whole text, at the cost of a dictionary lookup a word.

A column of texts is cut by Arrow, ``SLICE_BYTES`` at a time: each distinct stretch of a slice is
looked up once, and Arrow puts the ids of all stretches in a row.

A stretch met for the first time is split by the vocabulary's own pattern, and its pieces are
merged by the library's model, where its characters leave no doubt about normalisation: Latin
letters and printable ASCII. Any other stretch goes through the whole tokenizer.
"""

import json
import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tapeloom.llm import worker

PIECES_HELD = 500_000  # pieces of stretches a worker remembers
WORDS_HELD = 400_000  # stretches in each of the two generations a worker remembers
LONGEST_HELD = 64  # characters; longer stretches are encoded each time
SLICE_BYTES = 2 << 20  # text that is cut and looked up at once, and one text at least

SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")

# Characters that every normaliser leaves as they are, but for lower case: printable ASCII but for
# the sign that special tokens begin with, line feed, and composed Latin letters.
PLAIN = re.compile("[\n -;=-~\u00c0-\u012f\u0131-\u017e]*")

MARKS = frozenset(",.;:!?)")  # marks that are pieces of their own at the end of a word

# Fixed value: the pattern of byte-level vocabularies.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet():
    """The characters that stand for bytes 0 to 255: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def splitter(spec):
    """(pattern, lower case) of a tokenizer file of a known kind; None for any other."""
    kind, normaliser = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind["add_prefix_space"] and not normaliser:
        return regex.compile(BYTE_LEVEL), False
    steps = kind.get("pretokenizers", [])
    if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
        return None
    names = [n["type"] for n in (normaliser or {}).get("normalizers", [])]
    if names != ["NFC", "Replace", "Lowercase"] or not steps[0]["invert"] or steps[0]["behavior"] != "Removed":
        return None
    return regex.compile(steps[0]["pattern"]["Regex"]), True


def packed(ids):
    """Ids as little-endian unsigned 32-bit bytes."""
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


class Pieces(dict):
    """Ids of pieces, merged by the model when first asked for."""

    def __init__(self, model):
        super().__init__()
        self.merge, self.alphabet = model.tokenize, byte_alphabet()

    def __missing__(self, piece):
        if piece.isascii() and piece.strip(" ").isalpha():
            symbols = piece.replace(" ", self.alphabet[32])
        else:
            symbols = "".join(map(self.alphabet.__getitem__, piece.encode()))
        ids = self[piece] = packed([token.id for token in self.merge(symbols)])
        return ids


class Unsafe(Exception):
    """A blank next to other white space, where a text must not be cut."""


class Stretches(dict):
    """Ids of stretches of text, each with the blank before it; looked up or encoded when first met."""

    def __init__(self, cache, old):
        super().__init__()
        self.cache, self.old = cache, old

    def __missing__(self, part):
        ids = self.old.get(part)
        if ids is None:
            if not part or part != part.strip():
                raise Unsafe
            ids = self.cache.ids_of(self.cache.blank + part)
        if len(part) <= LONGEST_HELD:
            self[part] = ids
        return ids


class WordCache:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes.

    ``path`` names a tokenizer file. With ``joins_blanks`` a blank belongs to the word after it,
    as in byte-level vocabularies; else white space only separates. With ``plain_specials`` the
    strings of special tokens are text like other text. A null or empty text has no ids. Memory is bounded by two generations: when the young one is full it becomes the old one,
    and words still in use move back.
    """

    def __init__(self, path, joins_blanks, plain_specials=False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker on every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.blank = " " if joins_blanks else ""
        self.young = Stretches(self, {})
        with open(path, encoding="utf-8") as file:
            self.split = splitter(json.load(file))
        self.pieces = Pieces(self.tokenizer.model)

    def ids_of(self, stretch):
        """Ids of a stretch as if it were a text."""
        if self.split and stretch.isascii():
            # A word of letters is one piece by the pattern, and so is a mark after it.
            word = stretch.removeprefix(self.blank)
            if word.isalpha():
                return self.pieces[stretch.lower() if self.split[1] else stretch]
            if word[-1:] in MARKS and word[:-1].isalpha():
                lowered = stretch.lower() if self.split[1] else stretch
                return self.pieces[lowered[:-1]] + self.pieces[lowered[-1]]
        if self.split and PLAIN.fullmatch(stretch):
            pattern, lower = self.split
            if lower:
                stretch = stretch.lower()
            if stretch.removeprefix(self.blank).isalpha():  # one run of letters is one piece
                return self.pieces[stretch]
            return b"".join(map(self.pieces.__getitem__, pattern.findall(stretch)))
        return packed(self.tokenizer.encode(stretch, add_special_tokens=False).ids)

    def encode(self, text):
        if not text:
            return b""
        if len(self.young) > WORDS_HELD:
            self.young = Stretches(self, dict(self.young))
        if len(self.pieces) > PIECES_HELD:
            self.pieces.clear()
        try:
            head, *rest = text.split(" ")
            if not head or head != head.strip():
                raise Unsafe
            ids = b"".join(map(self.young.__getitem__, rest))
        except Unsafe:
            head, *rest = SAFE_BLANK.split(text)
            safe = [p if p and p == p.strip() else None for p in rest]
            ids = b"".join(
                self.young[p] if p is not None else self.ids_of(self.blank + q) for p, q in zip(safe, rest)
            )
        return self.ids_of(head) + ids

    def encode_all(self, texts):
        """``encode`` of every text of an Arrow array, as a list; a distinct stretch is looked up once a slice."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), len(texts)]
        return [ids for a, b in zip(cuts, cuts[1:]) if a < b for ids in self._encode_slice(texts[a:b])]

    def _encode_slice(self, texts):
        if len(self.young) > WORDS_HELD:
            self.young = Stretches(self, dict(self.young))
        if len(self.pieces) > PIECES_HELD:
            self.pieces.clear()
        parts = pc.split_pattern(pc.fill_null(texts, ""), " ")
        cuts = np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy()))
        words = parts.flatten().dictionary_encode()
        known, codes = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices
        try:
            found, whole = list(map(self.young.__getitem__, known)), [False] * len(texts)
        except Unsafe:
            found = [self.young[p] if p and p == p.strip() else None for p in known]
            unsafe = pa.array([ids is None for ids in found]).take(codes).to_numpy(zero_copy_only=False)
            whole = np.logical_or.reduceat(unsafe, cuts[:-1]).tolist()
        rows = pa.array(found, pa.large_binary()).take(codes)
        _, places, data = rows.buffers()
        places, data = np.frombuffer(places, np.int64, len(rows) + 1), memoryview(data or b"")
        # No blank is before the first stretch of a text, so where a blank joins it is encoded by itself.
        heads = [known[k] for k in codes.to_numpy()[cuts[:-1]].tolist()]
        starts, stops = places[cuts[:-1] + len(self.blank)].tolist(), places[cuts[1:]].tolist()
        return [
            self.encode(texts[k].as_py()) if whole[k]
            else (self.ids_of(head) if self.blank else b"") + data[start:stop]
            for k, (head, start, stop) in enumerate(zip(heads, starts, stops))
        ]

    def encode_after_blank(self, text):
        """``encode`` of a blank and ``text``, where blanks join the word after them; the head is remembered too."""
        try:
            ids = b"".join(map(self.young.__getitem__, text.split(" ")))
        except Unsafe:
            return self.encode(" " + text)
        if len(self.young) > WORDS_HELD:
            self.young = Stretches(self, dict(self.young))
        if len(self.pieces) > PIECES_HELD:
            self.pieces.clear()
        return ids


_CACHES = worker.held("words")


def cached(path, joins_blanks, plain_specials=False):
    """The worker's own ``WordCache`` for a tokenizer file, kept until a task of another operator begins."""
    worker.begins("words")
    key = path, joins_blanks, plain_specials
    if key not in _CACHES:
        _CACHES[key] = WordCache(*key)
    return _CACHES[key]
