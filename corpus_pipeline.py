"""A corpus from raw documents to packed sequences, in five stages over written tables.

Every stage reads the Parquet its predecessor wrote, so a lost executor costs part of a stage and
a lost driver at most one. All but the last return the columns of ``documents``.
"""

import public_tokenizers

from tapeloom.llm import decontaminate, jaccard, packing, quality, repeats
from tapeloom.llm.ship import ship
from tapeloom.settings import scratch_dir


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules and the boosted trees keep, with all their columns.

    The verdict is taken row by row beside the text, so nothing is joined or shuffled.
    """
    ship(spark)
    trees = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.keep(docs, trees)


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return jaccard.keep_one(docs, size=5, percent=80)


def suffix_array_dedup(spark, docs, sf_dir):
    """Documents without the bytes of 100-byte strings that occur earlier; n_chars follows the text."""
    ship(spark)
    return repeats.without_repeats(docs, length=100)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item within a tenth of its length in edits."""
    ship(spark)
    return decontaminate.without_matches(docs, _table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark, docs, sf_dir):
    """Pieces of the documents' token ids, packed into sequences of at most 2048 tokens."""
    ship(spark)
    pieces = packing.tokenized_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), joins_blanks=True, end_id=0)
    return packing.pack_pieces(spark, pieces, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Trained trees, suffix arrays and tokenizers are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; the packed pieces of what is left."""
    folder = scratch_dir(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
