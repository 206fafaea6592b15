"""The corpus pipeline: every stage and the whole against plain versions, on hostile tables."""

import random
import re
import zlib

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapeloom.llm import quality
from tests.llm.test_kernels import distance_inside, plain_counts
from tests.llm.test_operators import DOCS, HOSTILE, documents, edited, words

BENCH = [(1, words(300, 25)), (2, words(301, 30)), (None, words(302, 25)), (3, None), (4, "")]


def corpus():
    passage = words(310, 40)  # over 100 bytes, shared by documents that are otherwise different
    rows = [(i, words(400 + i, 120)) for i in range(12)]
    rows += [(20 + i, words(420 + i, 60) + " " + passage + " " + words(440 + i, 60)) for i in range(5)]
    rows += [(30 + i, edited(rows[i][1], i, 0.01)) for i in range(4)] + [(34, rows[5][1]), (34, rows[5][1])]
    item = BENCH[0][1]
    near = item[: len(item) // 2] + "#" + item[len(item) // 2 + 1 :]
    assert len(item) < 200  # so that what 40 and 41 share is no repeat
    rows += [(40, words(460, 60) + " " + item + " " + words(461, 60)), (41, words(462, 60) + " " + near + " " + words(463, 20))]
    rows += [(42, "same word again " * 40), (43, words(464, 20)), (44, words(465, 3000)), (None, words(466, 80)), (None, words(466, 80))]
    return rows + [r for r in HOSTILE if r[0] is not None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    rows = corpus()
    random.Random(1).shuffle(rows)
    documents(spark.createDataFrame, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    write([(i, 1, 0) for i in range(12)] + [(42, 0, 0), (99, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int", "labels")
    write(BENCH, "item_id long, text string", "benchmark")
    return path


def plain_quality(spark, docs, folder):
    trees = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    found = []
    for row in docs.collect():
        counts = plain_counts(row.text or "")
        base = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        if not base and trees.score([quality.statistics(row.text)[1]])[0] >= 0:
            found.append((row.doc_id, row.text))
    return found


def shingles(text, size=5):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def plain_one_of_each(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, (doc_id, _) in zip(root, rows):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    named = {row for r, row in zip(root, rows) if row[0] is not None and least[r] == row[0]}
    return [*named, *(row for row in rows if row[0] is None)]


def plain_cut(rows, length=100):
    """Rows equal in id and text count as one document."""
    seen, found = set(), {}
    for doc_id, text in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        found[doc_id, text] = bytes(c for c, x in zip(data, gone) if not x).decode()
    return [(row[0], found[row]) for row in rows]


def plain_clean(rows):
    items = [t.lower() for _, t in BENCH if t]
    return [(d, t) for d, t in rows if all(distance_inside(i, t.lower()) > len(i) // 10 for i in items)]


def plain_pieces(rows):
    tokenizer, found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048
        for start in ([0] if first else []) + list(range(first, len(ids), 2048)):
            piece = ids[start : first if first and not start else start + 2048]
            found.append((doc_id, start, len(piece), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in piece))))
    return sorted(found, key=repr)


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_stages_and_whole_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = plain_quality(spark, docs, folder)
    assert len(kept) > 25
    stage = dict(corpus_pipeline.STAGES)
    after = stage["quality_rules"](spark, docs, folder)
    assert after.columns == docs.columns and texts(after) == sorted(kept, key=repr)

    one = plain_one_of_each(kept)
    assert len(kept) - len(one) >= 5
    made = documents(spark.createDataFrame, kept)
    after = stage["ngram_jaccard_join"](spark, made, folder)
    assert after.columns == docs.columns and texts(after) == sorted(one, key=repr)

    cut = plain_cut(one)
    after = stage["suffix_array_dedup"](spark, documents(spark.createDataFrame, one), folder)
    assert after.columns == docs.columns and texts(after) == sorted(cut, key=repr)

    clean = plain_clean(cut)
    assert {d for d, _ in cut} - {d for d, _ in clean} == {40, 41}
    after = stage["benchmark_decontamination"](spark, documents(spark.createDataFrame, cut), folder)
    assert after.columns == docs.columns and texts(after) == sorted(clean, key=repr)

    for packed in (stage["best_fit_packing"](spark, documents(spark.createDataFrame, clean), folder), corpus_pipeline.run(spark, folder)):
        rows = packed.collect()
        assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == plain_pieces(clean)
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in bins.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= 2048


def test_empty_tables_give_no_pieces(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
