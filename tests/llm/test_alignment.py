"""Token alignment of whole tables against the libraries and plain loops."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tapeloom.llm import alignment
from tests.llm.test_operators import DOCS, HOSTILE, documents, words

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet():
    """Inverse of the byte-level alphabet: printable Latin-1 for itself, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.byte_of = byte_alphabet()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(self.byte_of[c] for c in t) for t in a.tokens]
        b = self.b.encode(text)
        b_bytes = []
        for piece in map(self.b.id_to_piece, b):
            byte = piece.startswith("<0x") and piece.endswith(">") and len(piece) == 6
            b_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        return list(zip(a.ids, a_bytes)), list(zip(b, b_bytes))

    def groups(self, text):
        """Lists of (A ids, B ids)."""
        if not text:
            return []
        a, b = self.tokens(text)
        if any(b"".join(x for _, x in side) != b" " + text.encode() for side in (a, b)):
            return []

        def ended(side):
            at, found = 0, []
            for i, piece in side:
                at += len(piece)
                found.append((at, i))
            return found

        a, b = ended(a), ended(b)
        found, start = [], 0
        for end in sorted({e for e, _ in a} & {e for e, _ in b}):
            found.append(tuple([i for e, i in side if start < e <= end] for side in (a, b)))
            start = end
        return found


def plainly(texts):
    aligner, rows = Plain(), []
    grouped = [aligner.groups(t) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in grouped]
    held = Counter(pair for own in links for pair in own)
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for groups, own in zip(grouped, links):
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in own.items()),
            hashlib.sha256(told.encode()).hexdigest() if told else "",
        ))
    return rows


ODD = [
    (100, "<|endoftext|> and </s><s> <unk> <0x41> ▁"), (101, "  two  blanks \n\n and\ttabs "), (102, "a▁b"),
    (103, "ﬁne é ½ ² 漢字かな交じり文 emoji 👩‍👩‍👧 ​ end"), (104, "\x00\x01 zero"), (105, " "), (106, "\r\n"),
    (107, "(" * 3000), (108, "=" * 2999 + "a"), (109, "12345678901234567890 3.14 x86-64"), (110, "nbsp here"),
]


@pytest.mark.parametrize("frequent, batch_bytes, wide", [(300_000, 1 << 20, 64), (10, 5000, 0), (0, 1, 1 << 30)])
def test_alignment_of_hostile_tables(spark, frame, monkeypatch, frequent, batch_bytes, wide):
    monkeypatch.setattr(alignment, "WIDE", wide)
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    monkeypatch.setattr(alignment, "BATCH_BYTES", batch_bytes)
    made = HOSTILE + ODD + [(200 + i, words(i % 7, 40)) for i in range(30)]
    rows = alignment.align_tokens(documents(frame, made), BYTE, PIECE).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = sorted((str(r.doc_id), *(r[n] for n in names)) for r in rows)
    assert found == sorted((str(d), *own) for (d, *_), own in zip(made, plainly([t for _, t, *_ in made])))


def test_empty_tables(spark, frame):
    assert alignment.align_tokens(frame([], DOCS), BYTE, PIECE).collect() == []
    nothing = alignment.align_tokens(frame([(1, None), (2, "")], "doc_id long, text string"), BYTE, PIECE).collect()
    assert {(r.n_a, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in nothing} == {(0, 0, 0, 0, "")}


def test_partial_counts_are_handed_on_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "PARTIAL_PAIRS", 4)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int32())]))
    batches = [
        pa.RecordBatch.from_arrays([pa.array([[{"a": i % 3, "b": j, "times": 9} for j in range(3)]], kind)], ["links"])
        for i in range(20)
    ]
    total = Counter()
    for part in alignment._partial_counts(batches):
        for row in part.to_pylist():
            total[row["a"], row["b"]] += row["documents"]
    assert total == Counter({(a, b): len(range(a, 20, 3)) for a in range(3) for b in range(3)})


def test_words_alone_have_the_pieces_of_whole_texts(monkeypatch):
    monkeypatch.setattr(alignment.wordcache, "WORDS_HELD", 50)
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    held = alignment.PieceWords(processor)
    assert held.by_word
    for start in range(0, 200, 20):
        texts = [t or "" for _, t, *_ in HOSTILE + ODD] + [words(start + i, 30, "abcdefghijéüß漢é.,'\t ") for i in range(20)]
        assert [ids.tolist() for ids in held.encode(texts)] == [processor.encode(t) for t in texts]
