"""Order-preserving windows: the dynamic program against brute force, whole tables against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapeloom.llm import windows
from tests.llm.test_operators import DOCS, HOSTILE, documents, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def plainly(places, penalties, capacity):
    """Least cost at each place, every start tried."""
    costs = [0]
    for i in range(1, len(places)):
        costs.append(min(
            costs[j] + padding(places[i] - places[j], capacity) + windows.WINDOW + penalties[i]
            for j in range(i) if places[i] - places[j] <= capacity
        ))
    return costs


@pytest.mark.parametrize("seed", range(30))
def test_cuts_cost_as_little_as_any(seed):
    draw = random.Random(seed)
    capacity = draw.choice([8, 64, 100])
    places = [0]
    while len(places) < 60:
        places.append(places[-1] + draw.randint(1, draw.choice([3, capacity])))
    penalties = [draw.choice([0, 4, 64]) for _ in places]
    costs, before = windows.cheapest(np.array(places), np.array(penalties), capacity)
    assert costs == plainly(places, penalties, capacity)
    assert all(0 < places[i] - places[before[i]] <= capacity for i in range(1, len(places)))


def test_gaps_are_bridged():
    places = np.array([0, 10, 1600, 1601])
    found = windows.gap_places(places, 512)
    assert found.tolist() == [522, 1034, 1546]
    assert not len(windows.gap_places(np.array([0, 512]), 512))


def test_sentences_end_after_final_marks_only():
    ids = Tokenizer.from_file(WORD_BPE).encode("One 3.5 two. Three? four, five", add_special_tokens=False)
    ends = windows.Sentences(WORD_BPE).ends(np.array(ids.ids, dtype="<u4"))
    assert [ids.tokens[e - 1] for e in ends] == [".</w>", "?</w>"]


def check_pieces(rows, texts_by_id, capacity=4096, end_id=2):
    """Every id in one piece, checksums by the library, gapless windows; the share of padding."""
    tokenizer = Tokenizer.from_file(WORD_BPE)
    wanted = []
    for doc_id, text in texts_by_id:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        wanted.append((doc_id, np.array(ids, dtype="<u4").tobytes()))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id in {d for d, _ in wanted}:
        whole = [data for d, data in wanted if d == doc_id]
        found = sorted(pieces.pop(doc_id), key=lambda r: (r.doc_tokens, r.sequence_id, r.offset))
        expected = 0
        for r in found:
            assert any(
                len(data) == 4 * r.doc_tokens and zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
                for data in whole
            )
            expected += r.length
        assert expected == sum(len(data) // 4 for data in whole)
    assert not pieces
    windows_of = {}
    for r in rows:
        windows_of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padded = total = 0
    for parts in windows_of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padded, total = padded + padding(at, capacity), total + at
    return padded / total


def test_hostile_documents(spark, frame):
    docs = documents(frame, HOSTILE)
    rows = windows.pack_in_order(docs, WORD_BPE).collect()
    check_pieces(rows, [(r[0], r[1]) for r in HOSTILE])
    assert windows.pack_in_order(docs.where("false"), WORD_BPE).collect() == []
    assert windows.pack_in_order(frame([], DOCS), WORD_BPE).count() == 0


def test_order_is_kept_and_little_is_padded(spark, frame, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK_IDS", 10_000)
    made = [(i, ". ".join(words(i * 50 + j, 12) for j in range(1 + i % 40)) + ".") for i in range(150)]
    made += [(150, words(9, 30_000)), (151, "x" * 20_000)]
    packer = windows.Packer(windows.Sentences(WORD_BPE), 4096, 0)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = []
    for doc_id, text in made:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        rows += packer.add(doc_id, np.array(ids, dtype="<u4").tobytes())
    rows += packer.finish()
    assert [(r[0], r[1]) for r in rows] == sorted((r[0], r[1]) for r in rows)
    assert [(r[5], r[6]) for r in rows] == sorted((r[5], r[6]) for r in rows)
    found = windows.pack_in_order(frame(made, "doc_id long, text string").coalesce(1), WORD_BPE).collect()
    assert check_pieces(found, made) < 0.02


def test_sentence_marks_are_found_once_a_worker(monkeypatch):
    made = []
    monkeypatch.setattr(windows, "Sentences", lambda path: made.append(path) or object())
    monkeypatch.setattr(windows, "_SENTENCES", {})
    assert windows.sentences_of("a") is windows.sentences_of("a") is not windows.sentences_of("b")
    assert made == ["a", "b"]
