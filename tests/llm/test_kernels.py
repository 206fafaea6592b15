"""The kernels of the operators against plain versions of themselves; no Spark."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tapeloom.llm import decontaminate, jaccard, langid, licenses, packing, quality, repeats, simple8b, warc, wordcache, worker


# --- token ids -------------------------------------------------------------------------------

PARTS = [
    " ", "  ", "\n", " \n", "a", "B's", "'s", "é", "é", "́", "1", "23", "<|endoftext|>", " ", " ",
    "\x1c", "\x85", "!", "😀", "\t", "Σ", "ΣΑΣ", "ß", "'", "ſ", "\x00", "﻿", "​", "i̇", "İ", "Ê", "×", "don't",
    "I'LL", "²", "ǅ", "the", "tion", ".",
]


@pytest.mark.parametrize("name, joins", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_ids_are_those_of_the_library(monkeypatch, name, joins):
    monkeypatch.setattr(wordcache, "WORDS_HELD", 40)
    monkeypatch.setattr(wordcache, "PIECES_HELD", 30)
    path = public_tokenizers.path(name)
    cache, plain, draw = wordcache.WordCache(path, joins), Tokenizer.from_file(path), random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choices(PARTS, k=draw.randint(0, 12)))
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == want, repr(text)
    assert cache.encode(None) == cache.encode("") == b""
    long = "x" * 200 + " " + "ab " * 50
    assert np.frombuffer(cache.encode(long), "<u4").tolist() == plain.encode(long, add_special_tokens=False).ids


@pytest.mark.parametrize("name, joins", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_ids_of_a_column_are_those_of_its_texts(monkeypatch, name, joins, limit):
    monkeypatch.setattr(wordcache, "WORDS_HELD", 40)
    monkeypatch.setattr(wordcache, "PIECES_HELD", 30)
    monkeypatch.setattr(wordcache, "SLICE_BYTES", limit)
    path = public_tokenizers.path(name)
    cache, plain, draw = wordcache.WordCache(path, joins), Tokenizer.from_file(path), random.Random(4)
    texts = [None, "", " ", "the", None, "x" * 200 + " " + "ab " * 50]
    texts += ["".join(draw.choices(PARTS, k=draw.randint(0, 12))) for _ in range(600)]
    texts += [" ".join(draw.choices(PARTS[4:], k=draw.randint(0, 12))) for _ in range(600)]
    want = [plain.encode(text or "", add_special_tokens=False).ids for text in texts]
    column = pa.array(["left out", *texts])[1:]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in cache.encode_all(column)] == want
    safe = pa.array(["a the x", "the a", None])
    assert cache.encode_all(safe) == [cache.encode(text) for text in safe.to_pylist()]
    assert cache.encode_all(pa.array([], pa.string())) == []
    assert cache.encode_all(pa.array([None, ""], pa.string())) == [b"", b""]


def test_a_distinct_stretch_is_looked_up_once_a_slice():
    class Counted(wordcache.Stretches):
        asked = 0

        def __getitem__(self, part):
            self.asked += 1
            return super().__getitem__(part)

    cache = wordcache.WordCache(public_tokenizers.path("word_bpe_49k.json"), False)
    cache.young = Counted(cache, {})
    ids = cache.encode_all(pa.array(["the cat saw the other cat"] * 500))
    assert cache.young.asked == 4
    assert ids == [cache.encode("the cat saw the other cat")] * 500


# --- Simple-8b -------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**64 - 1)), max_size=300), st.integers(1, 70))
def test_simple8b_gives_back_what_it_got(values, block):
    values = np.array(values, dtype=np.uint64)
    packed = simple8b.pack(values, block)
    assert (simple8b.unpack(packed) == values).all()
    a, b = len(values) // 3, 2 * len(values) // 3
    assert (simple8b.unpack(packed, a, b) == values[a:b]).all()


def test_simple8b_blocks_with_escapes_at_their_ends():
    draw = random.Random(9)
    for block in (1, 2, 7, 240):
        for _ in range(30):
            values = np.array([draw.choice([0, 1, 5, 1 << 29, 1 << 30, 1 << 63, (1 << 64) - 1]) for _ in range(draw.randint(1, 700))], dtype=np.uint64)
            packed = simple8b.pack(values, block)
            assert (simple8b.unpack(packed) == values).all()
            a = draw.randint(0, len(values))
            b = draw.randint(a, len(values))
            assert (simple8b.unpack(packed, a, b) == values[a:b]).all()


def test_simple8b_words_take_as_many_values_as_they_can():
    draw = random.Random(10)
    for block in (1, 3, 64, 240, 300):
        values = [draw.choice([0, 1, 2, 255, 1 << 15, (1 << 30) - 1, 1 << 30]) for _ in range(40)]
        values = [v for v in values for _ in range(draw.choice([1, 2, 7, 130]))]
        words = 0
        for start in range(0, len(values), block):
            part, at, escaped = values[start : start + block], 0, False
            while at < len(part):
                fits = [n for n, bits in simple8b.SELECTORS if all(v < 1 << bits for v in part[at : at + n])]
                words += 1 if fits or escaped else 2  # a run of escaped values has one word in front
                escaped = not fits
                at += max(fits, default=1)
        packed = simple8b.pack(np.array(values, dtype=np.uint64), block)
        blocks = -(-len(values) // block)
        assert len(packed) == 16 + 8 * (blocks + 1) + 8 * words


def test_simple8b_is_dense_and_escapes_look_like_nothing_else():
    assert len(simple8b.pack(np.zeros(2400, dtype=np.uint64))) <= 24 + 8 * 11
    assert len(simple8b.pack(np.full(4000, 2**15 - 1, dtype=np.uint64))) <= 24 + 8 * 1001
    tricky = np.array([2**64 - 1, 15 << 60, (15 << 60) | 3, 1, 2**63], dtype=np.uint64)
    assert (simple8b.unpack(simple8b.pack(tricky)) == tricky).all()
    with pytest.raises(ValueError):
        simple8b.unpack(b"none")


# --- packing ---------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_packing_places_every_item_once_and_never_beyond_capacity(lengths):
    bins = packing.pack(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 100 for b in bins)
    assert math.ceil(sum(lengths) / 100) <= len(bins) <= len(packing.best_fit(lengths, 100))


def test_local_search_empties_a_bin_that_best_fit_leaves():
    # Best fit: 60+40, 50+30, 50+30 ... a swap fills bins to the brim.
    saved = 0
    for seed in range(300):
        draw = random.Random(seed)
        lengths = [draw.randint(15, 70) for _ in range(40)]
        saved += len(packing.best_fit(lengths, 100)) - len(packing.pack(lengths, 100))
    assert saved > 0


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]
    assert packing.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]


# --- WARC chain ------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_pointer_jumping_visits_what_walking_visits(data):
    n = data.draw(st.integers(1, 40))
    successor = np.array([data.draw(st.integers(i + 1, n)) for i in range(n)] + [n])
    walked, at = {0}, 0
    while at < n:
        at = int(successor[at])
        walked.add(at)
    assert set(np.flatnonzero(warc.reachable(successor, 0)).tolist()) == walked


# --- quality ---------------------------------------------------------------------------------


def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "\n", "\t", "\x0b", "é", "|", " ", "\x1c", "c d", "#", "\r\n"]), max_size=40))
def test_statistics_equal_plain_counts(parts):
    text = "".join(parts)
    assert quality.statistics(text)[0] == plain_counts(text)
    assert np.isfinite(quality.statistics(text)[1]).all()


def test_trees_learn_and_keep_their_directions():
    draw = np.random.default_rng(0)
    rows = draw.random((3000, len(quality.FEATURES)))
    j = list(quality.FEATURES).index("symbol_ratio")
    labels = ((rows[:, j] < 0.5) ^ (draw.random(3000) < 0.05)).astype(int)
    trees = quality.fit_trees(rows, labels, rounds=20)
    assert ((trees.score(rows) > 0) == (rows[:, j] < 0.5)).mean() > 0.97
    for j, direction in enumerate(quality.FEATURES.values()):
        if direction:
            more = np.repeat(rows[:50], 30, axis=0)
            more[:, j] = np.tile(np.linspace(-1, 2, 30), 50)
            steps = np.diff(trees.score(more).reshape(50, 30), axis=1)
            assert (steps * direction >= -1e-9).all()
    assert quality.fit_trees(rows[:5], [1] * 5).score(rows[:2]).min() > 0
    assert len(quality.fit_trees([], []).score([])) == 0


# --- decontamination -------------------------------------------------------------------------


def distance_inside(pattern, text):
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for c in text:
        new = [0]
        for j in range(1, len(pattern) + 1):
            new.append(min(column[j] + 1, new[-1] + 1, column[j - 1] + (pattern[j - 1] != c)))
        column, best = new, min(best, new[-1])
    return best


def test_myers_equals_the_table():
    draw = random.Random(0)
    for _ in range(500):
        p, t = ("".join(draw.choices("abc", k=draw.randint(a, 60))) for a in (1, 0))
        assert decontaminate.myers(decontaminate.masks_of(p), len(p), t, 99)[0] == distance_inside(p, t)


def test_pigeonhole_loses_no_match_and_invents_none():
    draw, hits = random.Random(1), 0
    for _ in range(500):
        p = decontaminate.normalise("".join(draw.choices("abcdefgh ", k=draw.randint(30, 90))))
        if len(p) < decontaminate.SHORTEST:
            continue
        q = list(p)
        for _ in range(draw.randint(0, len(p) // 10 + 2)):
            i, how = draw.randrange(len(q)), draw.randint(0, 2)
            q[i : i + (how != 1)] = draw.choice("abcdefgh") if how else ""
        t = "".join(draw.choices("abcdefgh ", k=60)) + "".join(q) + "".join(draw.choices("abcdefgh ", k=60))
        best, found = distance_inside(p, t), decontaminate.Matcher([(7, p)]).find(t)
        assert bool(found) == (best <= len(p) // 10)
        if found:
            distance, chars, start, stop = found[7]
            assert distance == best and chars == len(p) and distance_inside(p, t[start:stop]) == best
            hits += 1
    assert hits > 100


def test_short_items_match_whole_documents_only():
    matcher = decontaminate.Matcher([(1, "the cat"), (2, "")])
    assert matcher.find("the cat") == {1: (0, 7, 0, 7)} and not matcher.find("see the cat")


# --- repeats ---------------------------------------------------------------------------------


def test_intervals_equal_plain_search():
    draw = random.Random(2)
    for _ in range(300):
        common = [draw.randint(0, 5) for _ in range(draw.randint(0, 14))]
        want = set()
        for low in range(len(common)):
            for high in range(low + 1, len(common) + 1):
                depth = min(common[low:high])
                left = common[low - 1] if low else 0
                right = common[high] if high < len(common) else 0
                if depth >= 2 and depth > max(left, right):
                    want.add((depth, low, high))
        assert set(repeats.intervals(common, 2)) == want


def test_equal_windows_have_equal_anchors(monkeypatch):
    draw = random.Random(3)
    shared = bytes(draw.choices(b"abcd", k=300))
    a, b = (bytes(draw.choices(b"abcd", k=draw.randint(50, 300))) + shared + bytes(draw.choices(b"abcd", k=90)) for _ in "ab")

    def by_window(data):
        found = {}
        for h, s, c in zip(*(x.tolist() for x in repeats.anchors(np.frombuffer(data, np.uint8), 100))):
            found.update((s + i, h) for i in range(c))
        return found

    x, y = by_window(a), by_window(b)
    assert sorted(x) == list(range(len(a) - 99))
    at, bt = a.index(shared), b.index(shared)
    assert all(x[at + i] == y[bt + i] for i in range(201))
    monkeypatch.setattr(repeats, "PIECE", 64)
    assert by_window(a) == x


def stretches_of(n, seed):
    """Rows of one anchor, sorted as for ``_covered``: stretches of one passage with changed bytes."""
    draw = random.Random(seed)
    passage, found = bytes(draw.choices(b"abcd", k=176)), []
    for i in range(n):
        data = bytearray(passage[: draw.randint(100, 176)])
        if draw.random() < 0.6:
            data[draw.randrange(len(data))] = draw.choice(b"abcd")
        found.append((1, i, 5, [draw.randint(0, 500)], draw.choice([-1, 65, 66]), len(data) - 99, bytes(data)))
    return sorted(found, key=lambda r: (r[6], r[4], r[5], r[1]))


def covered_by(rows):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary())
    names = [c.split()[0] for c in repeats.STRETCHES.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return sorted(row for found in repeats._covered(100)([batch]) for row in zip(*(c.to_pylist() for c in found.columns)))


@pytest.mark.parametrize("seed", range(6))
def test_windows_ordered_by_shares_cover_the_same(monkeypatch, seed):
    rows = stretches_of(40, seed)
    sizes, made = [], repeats.SuffixArray.__init__

    def noted(self, stretches, length, prints, chosen):
        sizes.append((len(chosen), len(prints)))
        made(self, stretches, length, prints, chosen)

    monkeypatch.setattr(repeats.SuffixArray, "__init__", noted)
    whole = covered_by(rows)
    assert whole and len(sizes) == 1
    monkeypatch.setattr(repeats, "WINDOWS", 50)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 300)
    assert covered_by(rows) == whole
    assert len(sizes) > 20 and sum(n for n, _ in sizes[1:]) == sizes[0][1]  # each window in one share


def test_stretches_without_equal_windows_cover_nothing():
    one, other = (bytes(random.Random(s).choices(b"abcd", k=120)) for s in (1, 2))
    rows = sorted([(1, 1, 1, [0], -1, 21, one), (1, 2, 1, [0], -1, 21, other)], key=lambda r: r[6])
    assert covered_by(rows) == []


def test_a_worker_remembers_one_operator_at_a_time():
    path = public_tokenizers.path("byte_bpe_50k.json")
    cache = wordcache.cached(path, True)
    cache.encode("words to remember")
    assert wordcache.cached(path, True) is cache  # from task to task
    jaccard.shingle_set("words to remember")
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array(["other words"])], ["doc_id", "tag", "text"])
    list(jaccard._sets(3)([batch]))
    assert not wordcache._CACHES and b"other" in jaccard._WORDS
    list(repeats._covered(100)([]))
    assert not jaccard._WORDS
    wordcache.cached(path, True)
    worker.begins("packing")
    assert not wordcache._CACHES


# --- Jaccard ---------------------------------------------------------------------------------


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_signature(percent):
    draw, parts, tried = random.Random(4), jaccard.Parts(percent), 0
    for _ in range(2500):
        n = draw.choice([draw.randint(1, 30), draw.randint(10, 120), draw.randint(50, 700)])
        a = {draw.getrandbits(64) for _ in range(n)}
        b = set(a)
        for _ in range(draw.randint(0, max(1, n * (100 - percent) // 100))):
            how = draw.random()
            if how < 0.6 and len(b) > 1:
                b.remove(draw.choice(list(b)))
            if how > 0.3:
                b.add(draw.getrandbits(64))
        if 100 * len(a & b) >= percent * len(a | b):
            tried += 1
            x, y = (set(parts.signatures(np.array(sorted(s), dtype=np.uint64)).tolist()) for s in (a, b))
            assert x & y
    assert tried > 1000


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_never_rule_out_a_link(percent):
    draw, ruled_out = random.Random(8), 0
    for turn in range(600):
        n = draw.choice([1, 3, 20, 100, 900, 4000])
        a = {draw.getrandbits(64) for _ in range(n)}
        b = set(list(a)[: max(1, int(n * draw.uniform(0.4, 1.2)))]) | {draw.getrandbits(64) for _ in range(draw.randint(0, n // 4 + 1))}
        if turn % 20 == 0:  # all shingles in one cell
            a, b = ({x % 5000 for x in s} for s in (a, b))
        left, right = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
        one, two = jaccard.sketch(left), jaccard.sketch(right)
        edges = jaccard.plausible_forest([(1, len(a), one)], [(2, len(b), two)], percent)
        if 100 * len(a & b) >= percent * len(a | b):
            assert edges == [(2, 1)]
        ruled_out += not edges
    assert ruled_out > 100


def test_products_count_overlaps(monkeypatch):
    draw = random.Random(5)
    sets = [np.unique(np.array(draw.choices(range(60), k=draw.randint(1, 40)), dtype=np.uint64)) for _ in range(60)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[25:]] for a in sets[:25]]
    for sparse in (1, 16, 100):
        monkeypatch.setattr(jaccard, "SPARSE", sparse)
        assert jaccard.overlaps(sets[:25], sets[25:]).tolist() == want


def test_forest_connects_what_links_connect():
    draw = np.random.default_rng(6)
    for _ in range(50):
        links = draw.random((12, 9)) < 0.12
        edges = jaccard.forest(links, list(range(12)), list(range(100, 109)))
        assert len(edges) <= 20
        classes = []
        for pairs in ([(i, 100 + j) for i, j in np.argwhere(links)], edges):
            root = {n: n for n in [*range(12), *range(100, 109)]}
            for _ in range(25):
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            classes.append(root)
        assert classes[0] == classes[1]


# --- language --------------------------------------------------------------------------------


def test_gradients_equal_differences():
    network = langid.Network(["a", "b", "c"], 4)
    for name in network.NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))
    draw = np.random.default_rng(0)
    x, valid, labels = draw.integers(0, 256, (10, 6)).astype(np.uint8), np.ones((10, 6), bool), np.array([0, 1, 2, 0, 1, 2])
    _, grads = network.gradients(x, valid, labels)
    for name in network.NAMES:
        weights = getattr(network, name)
        at = (1, 5, int(x[3, 2])) if name == "inputs" else tuple(s // 2 for s in weights.shape)
        change = []
        for step in (0.01, -0.02):
            weights[at] += step
            change.append(network.gradients(x, valid, labels)[0])
        weights[at] += 0.01
        assert grads[name][at] == pytest.approx((change[0] - change[1]) / 0.02, rel=0.2, abs=1e-5)


def test_stretches_of_long_texts_are_pooled_over_every_byte(monkeypatch):
    samples = [(b"abab " * 16, "x")] * 30 + [(b"zyzy " * 16, "y")] * 30
    network = langid.fit(samples, hidden=3, steps=60, width=16)
    texts = ["abab " * 500 + "zyzy " * 300, "zyzy", "ab", "zyzy " * 2000]
    whole = langid.pooled(network, texts)
    monkeypatch.setattr(langid, "SIDE_BY_SIDE", 3)
    assert np.allclose(langid.pooled(network, texts), whole, atol=1e-5)
    assert [network.classes[k] for k in whole.argmax(axis=1)] == ["x", "y", "x", "y"]
    labels = langid.position_labels(network, texts[0])
    assert len(labels) == 4000 and labels[:2400].count("x") > 2300 and labels[2600:].count("y") > 1300
    assert 0.55 < whole[0, 0] < 0.7


# --- licences --------------------------------------------------------------------------------


def test_every_template_is_recognised():
    classifier = licenses.fit(["a plain line of text", "the version of the work"])
    for family, text in licenses.TEMPLATES:
        chances = classifier.probabilities(text)
        assert max(chances, key=chances.get) == family
    for text in licenses.DISTRACTORS:
        chances = classifier.probabilities(text)
        assert max(chances, key=chances.get) == licenses.UNKNOWN
