"""Licence notices: a trained paragraph classifier, its unknown class calibrated, confirmed by templates.

A sparse logistic regression over word n-grams is fitted here to variants of public notices and
to paragraphs of the corpus that are none. Scoring is DataFrame work only: paragraphs, parted by
blank lines, and their single lines are cut into n-grams, joined with the weights and summed. Before that bounds from the weights, the most
that a paragraph's words and n-grams can add to the lead of any family over unknown, spares most of the corpus
the n-grams; it leaves out only what would be judged unknown. Names and version numbers tell families
apart whose notices are alike but for them: a paragraph that has such names, but for no template of
the predicted family all of its ``marks``, is another licence or version, so it is unknown. A prediction
is confirmed if enough of a template of the predicted family, and all its marks, are found.
"""

import json
import math
from collections import Counter

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Public licence notices by family.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or at your option any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or at your option any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("proprietary", "Copyright. All rights reserved. No part may be reproduced without the prior written permission of the publisher."),
    ("proprietary", "All rights reserved."),
    ("GPL-3.0", "GPLv3"),
    ("GPL-2.0", "GPLv2"),
    ("LGPL-3.0", "LGPLv3"),
    ("AGPL-3.0", "AGPLv3"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
)

# Sentences with the words of notices that are none.
DISTRACTORS = (
    "He lost his driving license on the way to the city.", "The license plate was covered with mud.",
    "A fishing licence costs ten pounds a year.", "She asked permission to leave the room early.",
    "The committee discussed copyright in the age of printing.", "The bar has a licence to sell wine.",
    "They worked under the old version of the plan.", "A public license hearing was held in general.",
    "Poetic licence is a freedom of the writer.", "With the permission of the teacher we left.",
    "The redistribution of land took many years.", "Her work was released under a new name in 2004.",
    "The film entered the public domain of memory.", "The license fee pays for the public service.",
    "All seats were reserved for the guests.", "The charter names the rights of all people.",
    "He reserved the right to speak to all of them.", "Version 4.0 of the program came by post.",
)

# Words of the names of licences; numbers count like them.
NAMES = frozenset(
    "mit apache gnu general lesser affero version bsd clause mozilla cc by sa nc creative commons attribution "
    "sharealike noncommercial gplv2 gplv3 lgplv3 agplv3".split()
)

SIZES = (1, 2, 3)  # words in an n-gram, without a gap
REACH_STEPS = 4  # steps of 1 that bounds are rounded up to
LINE_CHARS = 20_000  # of a line that the model is fitted to


def words_of(text):
    """Lower-case words of letters and digits."""
    cleaned = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return cleaned.split()


def grams_of(text):
    words = words_of(text)
    return {" ".join(words[i : i + n]) for n in SIZES for i in range(len(words) - n + 1)}


def marks_of(text):
    """The n-grams of the runs of names and numbers in a template: the pairs of a run, or its one word."""
    found, run = set(), []
    for word in [*words_of(text), None]:
        if word is not None and (word in NAMES or any(c.isdigit() for c in word)):
            run.append(word)
            continue
        found.update(map(" ".join, zip(run, run[1:])) if len(run) > 1 else run)
        run = []
    return found


def _variants(text):
    """Forms in which a notice is met: as it is, inside a sentence, shortened at either end."""
    words = text.split()
    yield text
    for before, after in (
        ("Copyright (c) 2019 Some Author.", ""), ("Note:", "See the file for details."), ("//", ""),
        ("Unless stated otherwise, this text is", ""), ("", "All files are covered."), ("The code here:", "Thank you."),
    ):
        yield f"{before} {text} {after}"
    if len(words) > 12:
        yield " ".join(words[: len(words) * 3 // 4])
        yield " ".join(words[len(words) // 4 :])


class Classifier:
    """Weights by n-gram, a bias by class, and a temperature that calibrates probabilities."""

    def __init__(self, classes, grams, weights, bias, temperature):
        self.classes, self.grams, self.weights, self.bias, self.temperature = classes, grams, weights, bias, temperature

    def probabilities(self, text):
        index = {g: i for i, g in enumerate(self.grams)}
        score = self.bias + sum((self.weights[index[g]] for g in grams_of(text) if g in index), np.zeros(len(self.classes)))
        shifted = np.exp((score - score.max()) / self.temperature)
        return dict(zip(self.classes, shifted / shifted.sum()))


def fit(negatives=(), steps=400, rate=0.5, l2=1e-3):
    """Fit a ``Classifier`` to variants of the templates against distractors and ``negatives``.

    Every third variant and negative is first held out, to find the temperature that gives them the
    highest likelihood; then the weights are fitted to all. The vocabulary is the n-grams of the templates, so its size does
    not depend on the corpus.
    """
    classes = [UNKNOWN, *dict.fromkeys(family for family, _ in TEMPLATES)]
    vocabulary = sorted(set().union(*(grams_of(t) for _, t in TEMPLATES)))
    index = {g: i for i, g in enumerate(vocabulary)}
    examples = [(v, classes.index(f)) for f, t in TEMPLATES for v in _variants(t)]
    none = [(t, 0) for t in (*DISTRACTORS, *negatives)]
    x = np.zeros((len(examples) + len(none), len(vocabulary)))
    y = np.array([c for _, c in examples + none])
    for row, (text, _) in enumerate(examples + none):
        for gram in grams_of(text):
            if gram in index:
                x[row, index[gram]] = 1
    held = np.arange(len(y)) % 3 == 2
    target = np.eye(len(classes))[y]

    def chances(w, b, rows, temperature=1.0):
        score = (x[rows] @ w + b) / temperature
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def learned(rows):
        weight = np.where(y == 0, 0.5 / max(1, (y[rows] == 0).sum()), 0.5 / max(1, (y[rows] > 0).sum()))[rows, None]
        w, b = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
        moment = [np.zeros_like(w), np.zeros_like(b)]
        for _ in range(steps):
            error = (chances(w, b, rows) - target[rows]) * weight
            for i, grad in enumerate((x[rows].T @ error + l2 * w / len(vocabulary), error.sum(axis=0))):
                moment[i] = 0.9 * moment[i] + grad
            w -= rate * moment[0]
            b -= rate * moment[1]
        return w, b

    trial = learned(~held)
    scales = np.geomspace(0.02, 20, 61)
    loss = [-np.log(chances(*trial, held, t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in scales]
    return Classifier(classes, vocabulary, *learned(np.ones(len(y), dtype=bool)), float(scales[int(np.argmin(loss))]))


def _reach(classifier):
    """(by gram, by word, least): text whose n-grams or words reach less than ``least`` is judged unknown.

    An n-gram reaches its largest gain of a family over unknown. For the bound by words it counts for
    the one of its words that has the fewest n-grams. Neither sum is less than the lead of a family.
    """
    unknown = classifier.classes.index(UNKNOWN)
    gains = np.maximum(0, (np.delete(classifier.weights, unknown, 1) - classifier.weights[:, [unknown]]).max(axis=1))
    grams = dict(zip(classifier.grams, gains.tolist()))
    uses = Counter(w for g in grams for w in set(g.split()))
    words = {}
    for gram, gain in grams.items():
        word = min(gram.split(), key=lambda w: (uses[w], w))
        words[word] = words.get(word, 0.0) + gain
    slack = 1e-6 * len(grams)  # for rounded weights
    return grams, {w: words.get(w, 0.0) for w in uses}, float(classifier.bias[unknown] - np.delete(classifier.bias, unknown).max()) - slack


def _once(column):
    """A column that is computed once a row, however often it is used: filters are not pushed below it."""
    return F.explode(F.array(column))


def _among(names):
    return lambda item: item.isin(sorted(names))


def _reaches(column, reach, least):
    """Whether the sum of ``reach``, rounded up to steps so that each step is one set, is at least ``least``."""
    steps = {}
    for name, value in reach.items():
        steps.setdefault(math.ceil(value * REACH_STEPS), []).append(name)

    def add(total, item):
        value = F.lit(0)
        for step, names in sorted(steps.items()):
            value = F.when(item.isin(names), step).otherwise(value) if step else value
        return total + value

    return (F.size(column) > 0) & (F.aggregate(column, F.lit(0), add) >= least * REACH_STEPS)


def _pair(left, right):
    return F.concat(left, F.lit(" "), right)  # null at the end of the words


PIECE = ("doc_id", "paragraph", "n_lines", "_block")


def _pieces(documents):
    """Each line of ``_text``, and each paragraph of several lines, as ``_piece``; blank lines part paragraphs.

    ``paragraph`` is the number of its (first) line, ``n_lines`` the lines that are not blank, and
    ``_block`` tells the paragraphs of a document apart.
    """
    full = F.transform(F.split("_text", "\n"), lambda line: line.rlike(r"\S"))
    rows = documents.select("doc_id", "_text", _once(full).alias("_full")).where(F.col("_full").isNotNull())
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_full") - 1),
        lambda i: F.get("_full", i) & ~F.coalesce(F.get("_full", i - 1), F.lit(False)),
    )
    # As many as starts: the line feed put before the text lets blank lines at its start part, too.
    blocks = F.filter(F.split(F.concat(F.lit("\n"), "_text"), r"\n(?:[^\S\n]*\n)+"), lambda block: block.rlike(r"\S"))
    placed = rows.select("doc_id", F.explode(F.arrays_zip(starts.alias("at"), blocks.alias("text"))).alias("_b"))
    whole = F.ltrim("_b.text", F.lit("\n"))
    split = placed.select(
        "doc_id", F.xxhash64("_b.at", "_b.text").alias("_block"), F.col("_b.at").alias("_at"),
        F.translate(whole, "\n", " ").alias("_whole"), _once(F.split(whole, "\n")).alias("_lines"),
    )
    count = F.size(F.filter("_lines", lambda line: line.rlike(r"\S")))

    def piece(at, n, text):
        return F.struct(at.alias("paragraph"), n.alias("n_lines"), text.alias("_piece"))

    lines = F.transform("_lines", lambda line, i: piece(F.col("_at") + i, F.lit(1), line))
    several = F.filter(F.array(piece(F.col("_at"), count, F.col("_whole"))), lambda p: p["n_lines"] > 1)
    return split.select("doc_id", "_block", F.inline(F.concat(lines, several)))


def paragraphs(documents, classifier):
    """The pieces of ``documents`` that may be judged a notice, with their words and grams.

    ``grams`` are those of the vocabulary. A piece with none of them, or whose words or n-grams cannot
    lift a family above unknown, is left out.
    """
    by_gram, by_word, least = _reach(classifier)
    pieces = _pieces(documents.select("doc_id", F.lower("text").alias("_text")))
    worded = pieces.select(*PIECE, _once(F.regexp_extract_all("_piece", F.lit("[a-z0-9]+"), 0)).alias("words"))
    # Words of no template become null, and so do the n-grams with them.
    marked = worded.select("*", _once(F.transform("words", lambda w: F.when(_among(by_word)(w), w))).alias("_marked"))
    known = marked.select("*", _once(F.array_distinct(F.array_compact("_marked"))).alias("_known"))
    grams = sized = F.col("_marked")
    for n in SIZES[1:]:
        sized = F.zip_with(sized, F.slice("_marked", n, F.greatest(F.size("words"), F.lit(1))), _pair)
        grams = F.concat(grams, sized)
    near = known.where(_reaches("_known", by_word, least)).select(
        *PIECE, "words", _once(F.array_distinct(F.array_compact(grams))).alias("_grams")
    ).select(*PIECE, "words", _once(F.filter("_grams", _among(by_gram))).alias("grams"))
    return near.where(_reaches("grams", by_gram, least))


def _runs(text):
    """Runs of three words, or the whole of a shorter text."""
    words = words_of(text)
    n = min(len(words), max(SIZES))
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def corpus_negatives(documents, n=400):
    """At most ``n`` distinct lines and paragraphs of the corpus, first by hash, that share no run of words with a template."""
    lines = _pieces(documents.select("doc_id", F.col("text").alias("_text"))).select(F.col("_piece").alias("_line")).where(F.length("_line") > 0)
    # Only the words of the templates matter to the model, so a piece may be cut.
    hashed = lines.select(F.xxhash64("_line").alias("_h"), F.substring("_line", 1, LINE_CHARS).alias("_line"))
    last = hashed.select("_h").distinct().orderBy("_h").limit(4 * n).agg(F.max("_h")).first()[0]
    chosen = hashed.where(F.col("_h") <= F.lit(last)).groupBy("_h").agg(F.min("_line").alias("_line")).orderBy("_h")
    runs = set().union(*(_runs(t) for _, t in TEMPLATES))
    return [r["_line"] for r in chosen.collect() if runs.isdisjoint(grams_of(r["_line"]))][:n]


def _table(spark, rows, schema):
    """A small table from JSON: ``rows`` are the vocabulary or the templates, never corpus data."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _add_weight(number):
    return lambda total, hit: total + hit["w"][number]


def find_licenses(spark, documents, classifier, threshold=0.5, cover=0.6):
    """A row for each paragraph of ``documents`` (doc_id, text) that is a licence notice.

    Columns: doc_id, paragraph (number of its first line, from 0), family, probability, template (its
    number), similarity (the share of the template's n-grams found), confirmed (at least ``cover`` and all
    marks, for a template of that family) and n_lines. Single lines and paragraphs of several lines, joined by
    blanks, are judged alike; where a line has as much of a template as its paragraph the line is
    given, else the paragraph, without its unconfirmed lines. Paragraphs whose likeliest class is unknown, or has less than
    ``threshold``, give no row. Rows equal in doc_id are told apart by their text. Null texts have
    no paragraphs, and a null doc_id is kept.
    """
    sizes = [len(grams_of(t)) for _, t in TEMPLATES]
    places = {g: [i for i, (_, t) in enumerate(TEMPLATES) if g in grams_of(t)] for g in classifier.grams}
    marks = [marks_of(t) for _, t in TEMPLATES]
    rows = [
        {"gram": g, "w": [round(float(v), 9) for v in classifier.weights[i]], "at": places[g], "marks": [n for n in places[g] if g in marks[n]],
         "names": [n for n in places[g] if g in NAMES and any(g in m.split() for m in marks[n])]}
        for i, g in enumerate(classifier.grams)
    ]
    weights = F.broadcast(_table(spark, rows, "gram string, w array<double>, at array<int>, marks array<int>, names array<int>"))
    lines = paragraphs(documents, classifier)
    hits = lines.select(
        *PIECE, F.xxhash64("words").alias("_same"), F.explode("grams").alias("gram")
    ).join(weights, "gram")
    k = len(classifier.classes)
    scored = hits.groupBy(*PIECE, "_same").agg(
        # Repeated rows of a document have the same grams; each is counted once.
        F.collect_set(F.struct("gram", "w", "at", "marks", "names")).alias("_hits")
    )
    total = F.array(*(
        F.aggregate("_hits", F.lit(float(classifier.bias[c])), _add_weight(c)) for c in range(k)
    ))
    families = F.array(*map(F.lit, classifier.classes))
    scored = scored.select("*", _once(F.transform(total, lambda s: s / classifier.temperature)).alias("_score"))
    scored = scored.withColumn("_best", F.array_max("_score"))
    scored = scored.withColumn(
        "probability", 1 / F.aggregate("_score", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("_best")))
    ).withColumn("family", F.element_at(families, F.array_position("_score", F.col("_best")).cast("int")))
    found = scored.where((F.col("family") != UNKNOWN) & (F.col("probability") >= threshold))
    own = F.filter(
        F.array(*(
            F.struct(F.lit(i).alias("i"), F.lit(f).alias("f"), F.lit(float(n)).alias("s"), F.lit(len(m)).alias("m"))
            for i, ((f, _), n, m) in enumerate(zip(TEMPLATES, sizes, marks))
        )),
        lambda t: t["f"] == F.col("family"),
    )
    compared = F.transform(
        own,
        lambda t: F.struct(
            (F.size(F.filter("_hits", lambda h: F.array_contains(h["marks"], t["i"]))) == t["m"]).alias("marked"),
            (F.size(F.filter("_hits", lambda h: F.array_contains(h["at"], t["i"]))) / t["s"]).alias("similarity"),
            (-t["i"]).alias("i"), (t["m"] > 0).alias("named"),
        ),
    )
    found = found.select("*", _once(compared).alias("_compared")).withColumn("_match", F.array_max("_compared"))
    # Names of the family, but the marks of no template: another licence or version.
    of_family = F.transform(own, lambda t: t["i"])
    some = F.exists("_hits", lambda h: F.arrays_overlap(h["names"], of_family))
    full = F.exists("_compared", lambda c: c["named"] & c["marked"])
    found = found.where(full | ~some)
    found = found.select(
        *PIECE, "family", F.round("probability", 6).alias("probability"),
        (-F.col("_match.i")).alias("template"), F.round("_match.similarity", 6).alias("similarity"),
        (F.col("_match.marked") & (F.col("_match.similarity") >= cover)).alias("confirmed"),
    )
    # A paragraph stands for the lines of a wrapped notice, and a line for a paragraph that says no more.
    block = Window.partitionBy("doc_id", "_block")
    several = F.col("n_lines") > 1
    by_line = F.max(F.when(~several, F.col("similarity"))).over(block.partitionBy("doc_id", "_block", "family"))
    found = found.withColumn("_by_line", by_line).where(~several | F.col("_by_line").isNull() | (F.col("_by_line") < F.col("similarity")))
    found = found.withColumn("_whole", F.max(F.when(several, F.struct("confirmed", "similarity", "family"))).over(block))
    fragment = F.col("_whole.confirmed") | ((F.col("_whole.family") == F.col("family")) & (F.col("_whole.similarity") > F.col("similarity")))
    found = found.where(several | F.col("confirmed") | ~F.coalesce(fragment, F.lit(False)))
    return found.select("doc_id", "paragraph", "family", "probability", "template", "similarity", "confirmed", "n_lines")
