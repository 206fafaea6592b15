"""Document statistics, base rules, and gradient-boosted trees that judge the rest.

The trees are grown here from histograms of binned statistics with the logistic loss, and
flattened into numpy node arrays, so that a batch of documents is scored by a few gathers a level.
Chosen statistics are monotonic: more of them can only lower the score. A split that would break
that is not taken, and both sides of a split are bounded by its middle from then on.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from tapeloom.llm import worker

SYMBOLS = "#*$%&|<>"  # Fixed value of the base rules.

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics the trees see, and their direction: -1 where more must not raise the score.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_ratio": -1, "dup_line_ratio": -1, "repeat_ratio": -1,
    "distinct_ratio": 0, "upper_ratio": -1, "mark_ratio": -1, "digit_ratio": 0, "words_per_line": 0,
    "sentence_ends": 0,
}

STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"

_SYMBOL_BYTES = np.zeros(256, dtype=bool)
_SYMBOL_BYTES[list(SYMBOLS.encode())] = True
_MARK_BYTES = np.zeros(256, dtype=bool)
_MARK_BYTES[list(b"!?;:=+_~^@\\/[]{}()\"'`") + list(SYMBOLS.encode())] = True
_END_BYTES = np.zeros(256, dtype=bool)
_END_BYTES[list(b".!?")] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True


def repeated_words(words):
    """Words in windows of three words that are found twice or more, first ones included."""
    n = len(words)
    if n < 4:
        return 0
    number = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
    keys = pairs.astype(np.int64) * len(number) + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    repeated = np.zeros(n - 2, dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= repeated
    return int(covered.sum())


def statistics(text):
    """(the five counts, the features) of a whole text; a null text has no words.

    Words are stretches without blank, tab, line feed, vertical tab, form feed or carriage
    return. Every count is of the whole text, whatever its length.
    """
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # for bytes, exactly those six
    bytes_ = np.frombuffer(data, dtype=np.uint8)
    n = len(words)
    blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    word_chars = len(text) - blanks
    n_symbols = int(_SYMBOL_BYTES[bytes_].sum())
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    n_dup_lines = len(lines) - len(set(lines))
    n_repeat = repeated_words(words)
    chars = max(1, word_chars)
    features = (
        np.log1p(n), word_chars / max(1, n), n_symbols / chars, n_dup_lines / max(1, len(lines)),
        n_repeat / max(1, n), len(set(words)) / max(1, n),
        (sum(map(str.isupper, text)) if not text.isascii() else int(((bytes_ >= 65) & (bytes_ <= 90)).sum())) / chars,
        int(_MARK_BYTES[bytes_].sum()) / chars, int(_DIGITS[bytes_].sum()) / chars,
        n / max(1, len(lines)), int(_END_BYTES[bytes_].sum()) / max(1, n),
    )
    return (n, word_chars, n_symbols, n_dup_lines, n_repeat), features


class Trees:
    """Boosted trees as flat arrays: feature, threshold, left child and value of every node.

    A node's right child follows its left one; a leaf is its own child. Missing statistics do not
    occur: every statistic of an empty text is zero.
    """

    def __init__(self, base, feature, threshold, left, value, roots, depth):
        self.base, self.depth = base, depth
        self.feature, self.threshold, self.left, self.value, self.roots = feature, threshold, left, value, roots

    def score(self, rows):
        """Log odds of every row."""
        rows = np.asarray(rows, dtype=float).reshape(-1, len(FEATURES))
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                inner = self.left[node] != node
                right = inner & (rows[at, self.feature[node]] > self.threshold[node])
                node = self.left[node] + right
            total += self.value[node]
        return total


def _gain(g, h, l2):
    return g * g / (h + l2)


def fit_trees(rows, labels, rounds=60, depth=4, rate=0.2, bins=64, l2=1.0, least=20, directions=None):
    """Fit ``Trees`` to 0/1 labels; both classes weigh the same. One class alone gives a constant."""
    rows, labels = np.asarray(rows, dtype=float).reshape(-1, len(FEATURES)), np.asarray(labels, dtype=float)
    directions = tuple(FEATURES.values()) if directions is None else directions
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    if not ones or not zeros:
        leaf = np.zeros(1, dtype=int)
        return Trees(8.0 if ones or not len(labels) else -8.0, leaf, np.zeros(1), leaf, np.zeros(1), [0], 0)
    weight = np.where(labels > 0, len(labels) / (2 * ones), len(labels) / (2 * zeros))
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    nodes = {"feature": [], "threshold": [], "left": [], "value": []}
    margin, roots = np.zeros(len(rows)), []

    def add():
        at = len(nodes["left"])
        for name, value in (("feature", 0), ("threshold", 0.0), ("left", at), ("value", 0.0)):
            nodes[name].append(value)
        return at

    def best_split(members, g, h, low, high):
        total_g, total_h = g[members].sum(), h[members].sum()
        best = None
        for j, cuts in enumerate(edges):
            if not len(cuts):
                continue
            where = binned[members, j]
            gs = np.cumsum(np.bincount(where, g[members], len(cuts) + 1))[:-1]
            hs = np.cumsum(np.bincount(where, h[members], len(cuts) + 1))[:-1]
            ns = np.cumsum(np.bincount(where, minlength=len(cuts) + 1))[:-1]
            gain = _gain(gs, hs, l2) + _gain(total_g - gs, total_h - hs, l2) - _gain(total_g, total_h, l2)
            left = np.clip(-gs / (hs + l2), low, high)
            right = np.clip(-(total_g - gs) / (total_h - hs + l2), low, high)
            allowed = (ns >= least) & (len(members) - ns >= least) & ((right - left) * directions[j] >= 0)
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = gain[k], j, k, left[k], right[k]
        return best

    def grow(at, members, level, low, high, g, h):
        split = best_split(members, g, h, low, high) if level < depth else None
        if split is None:
            value = rate * np.clip(-g[members].sum() / (h[members].sum() + l2), low, high)
            nodes["value"][at] = value
            margin[members] += value
            return
        _, j, k, left_value, right_value = split
        left = add()
        add()
        nodes["feature"][at], nodes["threshold"][at], nodes["left"][at] = j, edges[j][k], left
        middle = (left_value + right_value) / 2
        to_left = binned[members, j] <= k
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        for child, chosen, (a, b) in zip((left, left + 1), (to_left, ~to_left), bounds[directions[j]]):
            grow(child, members[chosen], level + 1, a, b, g, h)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        root = add()
        roots.append(root)
        grow(root, np.arange(len(rows)), 0, -np.inf, np.inf, weight * (p - labels), weight * p * (1 - p))
    return Trees(0.0, *(np.array(nodes[n]) for n in ("feature", "threshold", "left", "value")), roots, depth)


def base_failed(n_words, n_repeat_words):
    """The base rules: fewer than 50 words, or more than half of them in repeated windows."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _stats(batches):
    for batch in batches:
        found = [statistics(text.as_py()) for text in batch.column(1)]
        counts = list(zip(*(c for c, _ in found))) or [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
             pa.array([list(f) for _, f in found], pa.list_(pa.float64()))],
            names=["doc_id", *COUNTS, "features"],
        )


def document_statistics(documents):
    """The counts and features of every row of ``documents`` (doc_id, text); no shuffle."""
    return documents.select("doc_id", "text").mapInArrow(_stats, STATS)


def train(documents, labels, sample=20_000):
    """Trees fitted to ``quality`` of at most ``sample`` labelled documents, half of each class.

    The sample is the rows of ``labels`` that come first by the hash of their doc_id within their
    class; the bound is the only limit in this operator, and it holds for fitting alone. Of documents
    with one doc_id one is used. Labels without document, and documents without label, take no
    part. Without labels all is kept.
    """
    ranked = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality").distinct()
    ranked = ranked.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ).where(F.col("_rank") <= sample // 2)
    chosen = F.broadcast(ranked.select("doc_id", "quality"))  # at most ``sample`` rows
    rows = document_statistics(documents.join(F.broadcast(ranked.select("doc_id").distinct()), "doc_id", "left_semi"))
    # Of the rows of one doc_id, one: an id that repeats must not outweigh the others, or fill the driver.
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy("features"))
    rows = rows.select("doc_id", "features").withColumn("_one", one).where("_one = 1")
    rows = rows.join(chosen, "doc_id").select("doc_id", "features", "quality").collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, r.features))
    return fit_trees([r.features for r in rows], [r.quality for r in rows])


def judge(documents, trees, threshold=0.0):
    """Counts, ``base_failed``, ``score`` (log odds of good quality) and ``kept`` of every document."""

    def scored(batches):
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            score = trees.score(flat) if batch.num_rows else np.empty(0)
            n, repeat = (batch.column(c).to_numpy() for c in ("n_words", "n_repeat_words"))
            failed = base_failed(n, repeat)
            columns = [batch.column(c) for c in ("doc_id", *COUNTS)]
            extra = [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
            yield pa.RecordBatch.from_arrays(columns + extra, names=["doc_id", *COUNTS, "base_failed", "score", "kept"])

    def both(batches):
        return scored(_stats(batches))

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return documents.select("doc_id", "text").mapInArrow(both, schema)


def keep(documents, trees, threshold=0.0):
    """The rows of ``documents``, all columns, that are kept; nulls and empty texts fail the base rules."""
    place = documents.columns.index("text")

    def chosen(batches):
        worker.begins("quality")
        for batch in batches:
            found = [statistics(text.as_py()) for text in batch.column(place)]
            score = trees.score([f for _, f in found]) if found else []
            good = [not base_failed(c[0], c[4]) and s >= threshold for (c, _), s in zip(found, score)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(chosen, documents.schema)
