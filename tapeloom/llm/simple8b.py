"""Simple-8b word-aligned integer coding, vectorised, with escapes and per-block offsets.

A 64-bit word holds a selector in its top four bits and equally wide values in the other 60.
Values too wide for that follow an escape word, whose low bits say how many raw words come.
A packed array is cut into blocks that are coded on their own; a table of word offsets in front
lets a reader decode any block, or any range of values, without the ones before it. The words of all
blocks of an array are found side by side, a step at a time, so many short blocks are quick.
"""

import numpy as np

# Fixed values of the code: selector -> (values per word, bits per value).
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30),
)
ESCAPE = 15
MAGIC = b"TLS8"
BLOCK = 16384  # values in a block, unless the caller has many blocks to pack at once

_COUNTS = np.array([n for n, _ in SELECTORS], dtype=np.int64)
_BITS = sorted({bits for _, bits in SELECTORS})
_REST = max(n for n, _ in SELECTORS)  # places that the last word of a block may go beyond its end


def _choices(values, block):
    """For every position the densest selector that fits there; ``ESCAPE`` where none does.

    Beyond the end of the block of each position, values count as zeros, so that the last word of a
    block may be partly filled.
    """
    n = len(values)
    blocks = -(-n // block)
    flat = np.zeros(blocks * block, dtype=np.uint8)  # places among _BITS
    for bits in _BITS:
        flat[:n] += values >= np.uint64(1 << bits)
    # The widest value from each position on, over as many values as a selector has; zeros behind a block.
    wide = np.zeros((blocks, block + _REST), dtype=np.uint8)
    wide[:, :block] = flat.reshape(blocks, block)
    # A denser selector fits only where every less dense one does, so their number tells the densest.
    chosen = np.full((blocks, block), ESCAPE, dtype=np.uint8)
    seen = 1
    for count, bits in reversed(SELECTORS):
        while seen < count:
            step = min(seen, count - seen)
            wide[:, :-step] = np.maximum(wide[:, :-step], wide[:, step:])
            seen += step
        chosen -= wide[:, :block] <= _BITS.index(bits)
    return chosen.ravel()[:n]


def _word_starts(steps, block):
    """Positions where words begin: all blocks are walked at once, a word of each at a time."""
    at = np.arange(0, len(steps), block)
    stop = np.minimum(at + block, len(steps))
    begins = np.zeros(len(steps), dtype=bool)
    while len(at):
        begins[at] = True
        at = at + steps[at]
        inside = at < stop
        if not inside.all():
            at, stop = at[inside], stop[inside]
    return np.flatnonzero(begins)


def _encode(values, block):
    """(words, words of each block) of an array that is not empty."""
    n = len(values)
    blocks = -(-n // block)
    chosen = _choices(values, block)
    starts = _word_starts(np.append(_COUNTS, 1)[chosen], block)
    picks, owner = chosen[starts], starts // block
    words = np.zeros(len(starts), dtype=np.uint64)
    padded = np.zeros((blocks, block + _REST), dtype=np.uint64)  # zeros behind every block
    whole = n // block
    padded[:whole, :block] = values[: whole * block].reshape(whole, block)
    padded[whole:, : n - whole * block] = values[whole * block :]
    padded, places = padded.ravel(), starts + owner * _REST
    for selector in np.flatnonzero(np.bincount(picks)):
        if selector == ESCAPE:
            continue
        count, bits = SELECTORS[selector]
        rows = np.flatnonzero(picks == selector)
        at = places[rows]
        packed = np.full(len(rows), np.uint64(int(selector) << 60), dtype=np.uint64)
        for j in range(count if bits else 0):
            packed |= padded[at + j] << np.uint64(j * bits)
        words[rows] = packed
    sizes = np.bincount(owner, minlength=blocks)
    escaped = picks == ESCAPE
    if not escaped.any():
        return words, sizes
    # A run of escaped values of a block becomes one escape word with their number, then the raw values.
    opens = escaped & ~(np.append(False, escaped[:-1]) & np.append(False, owner[1:] == owner[:-1]))
    run = np.cumsum(opens) - 1
    lengths = np.bincount(run[escaped])
    words[escaped] = values[starts[escaped]]
    heads = (np.uint64(ESCAPE) << np.uint64(60)) | lengths.astype(np.uint64)
    return np.insert(words, np.flatnonzero(opens), heads), sizes + np.bincount(owner[opens], minlength=blocks)


def _decode(words, sizes, block):
    """Values of whole blocks, from their words and the words of each block."""
    raw_at, skip = [], np.zeros(len(words), dtype=bool)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    after = 0
    for at in np.flatnonzero(selectors == ESCAPE):
        if at < after:  # a raw word that looks like an escape
            continue
        after = at + 1 + int(words[at] & np.uint64((1 << 60) - 1))
        skip[at] = True
        raw_at.append(np.arange(at + 1, after))
    counts = _COUNTS[np.minimum(selectors, ESCAPE - 1)]
    counts[skip] = 0
    raw = np.concatenate(raw_at) if raw_at else np.empty(0, dtype=np.int64)
    counts[raw] = 1
    coded = ~skip
    coded[raw] = False
    before = np.cumsum(counts) - counts
    firsts = np.cumsum(sizes) - sizes
    # Every block has room behind it for what its last word has too many.
    starts = before + np.repeat(np.arange(len(sizes)) * (block + _REST) - before[firsts], sizes)
    out = np.zeros(len(sizes) * (block + _REST), dtype=np.uint64)
    out[starts[raw]] = words[raw]
    for selector in np.flatnonzero(np.bincount(selectors[coded])):
        count, bits = SELECTORS[selector]
        rows = np.flatnonzero(coded & (selectors == selector))
        mask = np.uint64((1 << bits) - 1)
        at, packed = starts[rows], words[rows]
        for j in range(count if bits else 0):
            out[at + j] = (packed >> np.uint64(j * bits)) & mask
    return out.reshape(len(sizes), -1)[:, :block].ravel()


def pack(values, block=BLOCK):
    """Bytes of an array of unsigned integers of up to 64 bits."""
    values = np.asarray(values, dtype=np.uint64)
    words, sizes = _encode(values, block) if len(values) else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=int))
    offsets = np.append(0, np.cumsum(sizes)).astype("<u8")
    head = MAGIC + np.array([block], dtype="<u4").tobytes() + np.array([len(values)], dtype="<u8").tobytes()
    return head + offsets.tobytes() + words.astype("<u8").tobytes()


def unpack(data, start=0, stop=None):
    """The values from ``start`` to ``stop`` as uint64; only the blocks they lie in are decoded."""
    if data[:4] != MAGIC:
        raise ValueError("not a packed array")
    block = int(np.frombuffer(data, "<u4", 1, 4)[0])
    n = int(np.frombuffer(data, "<u8", 1, 8)[0])
    stop = n if stop is None else min(stop, n)
    blocks = -(-n // block)
    offsets = np.frombuffer(data, "<u8", blocks + 1, 16).astype(np.int64)
    body = 16 + 8 * (blocks + 1)
    if start >= stop:
        return np.empty(0, dtype=np.uint64)
    first, last = start // block, (stop - 1) // block
    words = np.frombuffer(data, "<u8", int(offsets[last + 1] - offsets[first]), body + 8 * int(offsets[first]))
    found = _decode(words, np.diff(offsets[first : last + 2]), block)
    return found[start - first * block : stop - first * block]
