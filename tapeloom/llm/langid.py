"""Language of documents by a bidirectional gated recurrent network over bytes.

The network is trained here in numpy by backpropagation through time. It labels every byte of a
text with a probability for each language; a document gets the mean over all its bytes. Texts are
read whole, in stretches of ``STRETCH`` bytes that run through the network side by side, so the
work is proportional to the bytes, and memory to ``SIDE_BY_SIDE`` stretches whatever a text's size.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Window, functions as F

STRETCH = 64  # bytes the network sees at a time
SIDE_BY_SIDE = 4096  # stretches that run through it together
UNDETERMINED = "und"

LABELS = "doc_id long, held_out boolean, lang_pred string, score double"

_LETTER = regex.compile(r"\p{L}")  # letters by Unicode category, not numerals or marks


class Network:
    """Weights of both directions, laid out gate by gate (update, reset, candidate) by rows.

    ``inputs`` (2, 3H, 256) is the embedding of every byte already multiplied by the input weights,
    ``recur`` (2, 3H, H), ``out`` (C, 2H) and ``bias`` (C, 1) give the languages.
    """

    NAMES = ("inputs", "recur", "bend", "out", "bias")

    def __init__(self, classes, hidden, seed=0):
        draw = np.random.default_rng(seed)
        self.classes, self.hidden = list(classes), hidden
        shape = {
            "inputs": (2, 3 * hidden, 256), "recur": (2, 3 * hidden, hidden), "bend": (2, hidden, 1),
            "out": (len(classes), 2 * hidden), "bias": (len(classes), 1),
        }
        for name in self.NAMES:
            setattr(self, name, (draw.normal(size=shape[name]) * 0.3).astype(np.float32))

    def run(self, side, stretches, keep=False):
        """Hidden states (T, H, B) of one direction over ``stretches`` (T, B) of bytes."""
        h3, n = 3 * self.hidden, self.hidden
        steps, width = stretches.shape
        states = np.empty((steps, n, width), dtype=np.float32)
        trace = []
        state = np.zeros((n, width), dtype=np.float32)
        table, recur, bend = self.inputs[side], self.recur[side], self.bend[side]
        given, fed = np.empty((h3, width), np.float32), np.empty((h3, width), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            np.take(table, stretches[t], axis=1, out=given, mode="clip")
            np.matmul(recur, state, out=fed)
            gates = given[: 2 * n]
            gates += fed[: 2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5  # the logistic function, by way of tanh
            turned = fed[2 * n :]
            turned += bend
            candidate = turned * gates[n:]
            candidate += given[2 * n :]
            np.tanh(candidate, out=candidate)
            if keep:
                trace.append((t, state, gates.copy(), turned.copy(), candidate))
            # state' = candidate + update * (state - candidate)
            new = states[t]
            np.subtract(state, candidate, out=new)
            new *= gates[:n]
            new += candidate
            state = new
        return (states, trace) if keep else states

    def chances(self, stretches):
        """Probabilities (T, C, B) at every position."""
        n = self.hidden
        forward, backward = self.run(0, stretches), self.run(1, stretches)
        scores = np.matmul(self.out[:, :n], forward)
        scores += np.matmul(self.out[:, n:], backward)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, stretches, valid, labels):
        """Loss and its gradient by backpropagation through all steps of both directions."""
        n, c = self.hidden, len(self.classes)
        steps, width = stretches.shape
        grads = {name: np.zeros_like(getattr(self, name)) for name in self.NAMES}
        kept = [self.run(side, stretches, keep=True) for side in (0, 1)]
        scores = np.matmul(self.out[:, :n], kept[0][0]) + np.matmul(self.out[:, n:], kept[1][0]) + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        total = valid.sum()
        at = p[:, labels, np.arange(width)]
        loss = -(np.log(at + 1e-9) * valid).sum() / total
        p[:, labels, np.arange(width)] -= 1
        p *= (valid / total)[:, None, :]
        grads["bias"] = p.sum(axis=(0, 2))[:, None].astype(np.float32)
        for side, (states, trace) in enumerate(kept):
            part = slice(side * n, side * n + n)
            grads["out"][:, part] = np.einsum("tcb,tnb->cn", p, states, optimize=True)
            from_above = np.matmul(self.out[:, part].T, p)
            carried = np.zeros((n, width), dtype=np.float32)
            for t, before, gates, turned, candidate in reversed(trace):
                d = from_above[t] + carried
                update, reset = gates[:n], gates[n:]
                d_candidate = d * (1 - update) * (1 - candidate**2)
                d_update = d * (before - candidate) * update * (1 - update)
                d_reset = d_candidate * turned * reset * (1 - reset)
                d_turned = d_candidate * reset
                into = np.concatenate([d_update, d_reset, d_candidate])
                back = np.concatenate([d_update, d_reset, d_turned])
                grads["recur"][side] += back @ before.T
                grads["bend"][side] += d_turned.sum(axis=1, keepdims=True)
                seen = stretches[t]
                for row in range(3 * n):
                    grads["inputs"][side, row] += np.bincount(seen, into[row], 256).astype(np.float32)
                carried = d * update + self.recur[side].T @ back
        return float(loss), grads


def stretches_of(data):
    """Bytes as columns (STRETCH, n) and which positions are real; the last column is filled up."""
    n = -(-len(data) // STRETCH)
    flat = np.full(n * STRETCH, 32, dtype=np.uint8)
    flat[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    valid = np.zeros(n * STRETCH, dtype=bool)
    valid[: len(data)] = True
    return flat.reshape(n, STRETCH).T, valid.reshape(n, STRETCH).T


def fit(samples, hidden=8, steps=220, width=192, rate=0.02, seed=0):
    """Train on (bytes, language) samples; languages are drawn equally often."""
    classes = sorted({lang for _, lang in samples})
    network = Network(classes, hidden, seed)
    if len(classes) < 2:
        return network
    by_class = [[stretches_of(s) for s, lang in samples if lang == c and s] for c in classes]
    by_class = [(np.concatenate([s for s, _ in x], axis=1), np.concatenate([v for _, v in x], axis=1)) for x in by_class]
    draw = np.random.default_rng(seed)
    first = {n: np.zeros_like(getattr(network, n)) for n in Network.NAMES}
    second = {n: np.zeros_like(getattr(network, n)) for n in Network.NAMES}
    for step in range(1, steps + 1):
        labels = np.arange(width) % len(classes)
        picks = [draw.integers(by_class[k][0].shape[1]) for k in labels]
        x = np.stack([by_class[k][0][:, i] for k, i in zip(labels, picks)], axis=1)
        v = np.stack([by_class[k][1][:, i] for k, i in zip(labels, picks)], axis=1)
        _, grads = network.gradients(x, v, labels)
        scale = min(1.0, 2.0 / (1e-9 + np.sqrt(sum(float((g**2).sum()) for g in grads.values()))))
        pace = rate * (1 - 0.9 * step / steps)
        for name in Network.NAMES:  # Adam
            g = grads[name] * scale
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g * g
            move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            setattr(network, name, (getattr(network, name) - pace * move).astype(np.float32))
    return network


def position_labels(network, text):
    """The likeliest language of every byte of ``text``."""
    data = text.encode("utf-8", "surrogatepass")
    x, valid = stretches_of(data)
    best = network.chances(x).argmax(axis=1)
    return [network.classes[k] for k in best.T[valid.T]]


def pooled(network, texts):
    """Mean probabilities (documents, C) over all bytes of each text."""
    sums = np.zeros((len(texts), len(network.classes)))
    sizes = np.zeros(len(texts))
    queue, owners, waiting = [], [], 0

    def flush():
        nonlocal queue, owners, waiting
        x = np.ascontiguousarray(np.concatenate([s for s, _ in queue], axis=1))
        valid = np.concatenate([v for _, v in queue], axis=1)
        owner = np.concatenate(owners)
        for i in range(0, x.shape[1], SIDE_BY_SIDE):
            part = slice(i, i + SIDE_BY_SIDE)
            p = network.chances(np.ascontiguousarray(x[:, part]))
            p *= valid[:, None, part]
            for k, row in enumerate(p.sum(axis=0, dtype=np.float64)):
                sums[:, k] += np.bincount(owner[part], row, len(texts))
        queue, owners, waiting = [], [], 0

    for number, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        sizes[number] = len(data)
        for begin in range(0, len(data), STRETCH * SIDE_BY_SIDE):
            queue.append(stretches_of(data[begin : begin + STRETCH * SIDE_BY_SIDE]))
            owners.append(np.full(queue[-1][0].shape[1], number))
            waiting += queue[-1][0].shape[1]
            if waiting >= SIDE_BY_SIDE:
                flush()
    if queue:
        flush()
    return sums / np.maximum(sizes, 1)[:, None]


def held_out(doc_id):
    """Documents that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents, per_language=300, pieces=8, piece_chars=80, **options):
    """Fit a ``Network`` to text and non-null lang of documents that are not held out.

    The bound on the sample is ``per_language`` documents a language, first by the hash of their
    id, and of each ``pieces`` stretches from all over its text; it holds for fitting alone. Of rows
    equal in id and language one is used, and rows without doc_id are not learned from.
    """
    usable = documents.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL"
    ).where(~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("doc_id", "lang").withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_language).select("doc_id", "lang").distinct()
    )
    length = F.length("text")
    step = F.greatest(F.lit(1), F.floor(length / pieces)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring("text", (i * step + 1).cast("int"), F.lit(piece_chars))
    )
    rows = usable.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", cut.alias("cut"))
    # Of rows equal in both, one: an id that repeats must not outweigh the others, or fill the driver.
    one = F.row_number().over(Window.partitionBy("doc_id", "lang").orderBy("cut"))
    rows = rows.withColumn("_one", one).where("_one = 1").collect()
    samples = [(piece.encode(), r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["cut"])) for piece in r["cut"] if piece]
    return fit(samples, **options)


def predict(documents, network):
    """``lang_pred`` and ``score`` of every row of ``documents`` (doc_id, text).

    A text that is null or has no letter is undetermined with score 0, as is every text if no
    language was learned. Ties go to the first language in order of its name.
    """

    def labelled(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            ours = [i for i, t in enumerate(texts) if t and network.classes and _LETTER.search(t)]
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if ours:
                means = pooled(network, [texts[i] for i in ours])
                for i, row in zip(ours, means):
                    k = int(row.argmax())
                    langs[i], scores[i] = network.classes[k], float(min(1.0, max(0.0, row[k])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(labelled, LABELS)
