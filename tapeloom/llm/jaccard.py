"""N-gram Jaccard join by blocked sparse matrix products, with nothing lost before the product.

1. A document's set is its distinct word shingles as 64-bit hashes. Equal sets are one node.
2. Candidates, exactly: two sets of at least the wanted similarity differ in few shingles. If the
   hash space is cut into more parts than that, at least one part is the same in both. So
   every node is listed under the sum of each of its parts. A part holds several shingles, which
   unrelated documents do not share as a whole, however many passages they have in common.
3. Nodes listed together are often so by chance: a part may hold no more than shingles of a passage
   that many documents share. So each node has a sketch, the number of its shingles in each cell of
   the hash space. The sum of the lesser counts bounds an overlap from above, so a pair that stays
   below the wanted similarity by it is no link. First every node is held against the least one
   it is listed with; where that leaves a signature's nodes in several components, all of them are
   compared in blocks. What stays plausible forms clusters, which shared passages do not chain.
4. A cluster, sorted by set size, is cut into blocks, and pairs of blocks whose sizes can match are
   the tasks: in each the incidence matrix of one block is multiplied with that of the other, which
   counts the overlaps of all pairs at once.
5. Pairs that reach the bound given by their sizes are links. A task returns a spanning forest of
   its links, at most as many edges as it has nodes, so a group of copies never becomes all pairs.

A link is lost only if 64-bit hashes collide (for 10^9 different sets: once in 40 runs).
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window, functions as F

from tapeloom.llm import worker
from tapeloom.llm.graph import components
from tapeloom.operators.spread import number_rows, spread_join
from tapeloom.settings import scratch_dir

WORDS_HELD = 200_000  # hashes of words a worker remembers
BLOCK_NODES, BLOCK_SHINGLES, LEAST_NODES = 1024, 1 << 20, 16  # bounds of a block
BROADCAST_NODES = 300_000  # rows of at most 40 bytes up to which a written table is broadcast
SPARSE = 16  # shingles in so many nodes or fewer are multiplied pair by pair

SETS = "doc_id long, tag long, n_shingles long, node long, sketch binary"
PARTS = "doc_id long, tag long, node long, parts array<bigint>"
SKETCHED = "node long, n long, sketch binary"
LINKS = "a long, b long"

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_WORDS = worker.held("jaccard")


def mixed(x):
    """Bits of 64-bit integers spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times_a(number):
    return np.uint64(number * int(_A) & (1 << 64) - 1)


def shingle_set(text, size=3):
    """Sorted distinct shingle hashes of a whole text; words are split at ASCII white space.

    Upper-case A-Z count as lower-case. A text of fewer words than ``size`` has its whole sequence
    as the one shingle; without words, or null, the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    missing = set(words).difference(_WORDS)
    if missing:
        if len(_WORDS) + len(missing) > WORDS_HELD:
            _WORDS.clear()
            missing = set(words)
        _WORDS.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    found = np.full(len(words) - width + 1, np.uint64(width), dtype=np.uint64)
    for shift in range(width):
        found = mixed(found * _A + hashes[shift : len(words) - width + 1 + shift] * _B + _C)
    return np.unique(found)


def size_classes(largest, percent):
    """Smallest sizes of the classes: two linked sets are in one class or in neighbouring ones."""
    lows = [1]
    while lows[-1] <= largest:
        lows.append(max(lows[-1] * 5 // 4, lows[-1] * 100 // percent) + 1)
    return lows


class Parts:
    """The signatures under which a set is listed, for one similarity in percent."""

    def __init__(self, percent):
        self.percent, self.lows, self.cuts = percent, size_classes(1, percent), {}

    def _class_of(self, size):
        if size >= self.lows[-1]:
            self.lows = size_classes(2 * size, self.percent)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def _cuts(self, number):
        """(parts, spare): the parts of a class, and by how many they exceed the most that can differ.

        |A - B| + |B - A| <= (1 - t) / (1 + t) * (|A| + |B|), both at most the largest size. Of the
        equal parts of two linked sets, one has shingles if fewer than ``spare`` parts of either
        are empty; there are as many spare ones as makes that the rule.
        """
        if number not in self.cuts:
            largest, least = self.lows[number + 1] - 1, max(1, self.lows[number] * self.percent // 100)
            differ = (100 - self.percent) * 2 * largest // (100 + self.percent)
            spare = 1
            for _ in range(50):
                empty = (differ + spare) * np.exp(-least / (differ + spare))
                spare = max(spare, int(empty + 3 * np.sqrt(empty)) + (differ > 0))
            self.cuts[number] = differ + spare, spare
        return self.cuts[number]

    def _listed(self, grams, sums, number, seed):
        """Signatures by the parts of class ``number``, and whether too many parts have no shingle."""
        parts, spare = self._cuts(number)
        if seed:
            keys = mixed(grams + _times_a(seed))
            order = np.argsort(keys)
            keys, sums = keys[order], np.append(np.uint64(0), np.cumsum(mixed(grams[order] ^ _B), dtype=np.uint64))
        else:
            keys = grams
        place = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.searchsorted(place, np.arange(parts + 1, dtype=np.uint64))
        filled = np.flatnonzero(np.diff(cuts))
        totals = sums[cuts[filled + 1]] - sums[cuts[filled]]
        salt = mixed(filled.astype(np.uint64) * _C + _times_a(number * 64 + seed))
        return mixed(totals ^ salt), parts - len(filled) >= spare

    def signatures(self, grams):
        """All signatures of a set.

        A part that is empty in both sets is equal too, but would list half the corpus together. A
        set with as many empty parts as there are spare ones is listed by another cut of the hash
        space as well, and so on until a cut leaves fewer; then an equal part is one with shingles.
        """
        if not len(grams):
            return np.empty(0, dtype=np.uint64)
        own = self._class_of(len(grams))
        self._class_of(self.lows[own + 1])  # so that the next class has an end
        numbers = [own]
        if len(grams) * 100 >= self.percent * self.lows[own + 1]:
            numbers.append(own + 1)  # it may be linked with a larger set of the next class
        sums = np.append(np.uint64(0), np.cumsum(mixed(grams ^ _B), dtype=np.uint64))
        found = []
        for number in numbers:
            for seed in range(64):
                signatures, gaps = self._listed(grams, sums, number, seed)
                found.append(signatures)
                if not gaps:
                    break
            else:
                raise ArithmeticError(f"no cut of the hash space fills the parts of {len(grams)} shingles")
        return np.concatenate(found)


def _signed(x):
    return pa.array(x.view(np.int64))


def _node(grams):
    """One number for a set."""
    total = np.add.reduce(mixed(grams ^ _C)) if len(grams) else np.uint64(0)
    return mixed(np.atleast_1d(total) + _times_a(len(grams)))[0]


def sketch(grams):
    """How many shingles fall in each of a power of two of cells, 2 to 4 a cell; 255 stands for more."""
    if not len(grams):
        return b""
    bits = max(4, int(len(grams)).bit_length() - 2)
    counts = np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _folded(data, cells):
    """A sketch with fewer cells; counts are 16 bits wide, and one that was 255 is beyond all others."""
    counts = np.frombuffer(data, dtype=np.uint8).astype(np.uint16)
    counts[counts == 255] = 1 << 14
    return np.minimum(counts.reshape(cells, -1).sum(axis=1, dtype=np.uint32), 1 << 14).astype(np.uint16)


def plausible(one, others, sizes, percent):
    """Which of ``others`` may reach the similarity with ``one``: (size, folded sketch), rows of sketches, sizes."""
    n, cells = one
    bound = np.minimum(cells, others).sum(axis=1, dtype=np.int64)
    bound = np.minimum(bound, np.minimum(n, sizes))
    return 100 * bound >= percent * (n + sizes - bound)


def _sets(size):
    def run(batches):
        worker.begins("jaccard")
        for batch in batches:
            sets = [shingle_set(text.as_py(), size) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(map(len, sets), pa.int64()),
                 _signed(np.array([_node(s) for s in sets], dtype=np.uint64)),
                 pa.array([sketch(s) for s in sets], pa.binary())],
                names=["doc_id", "tag", "n_shingles", "node", "sketch"],
            )

    return run


def _listed(size, percent):
    def run(batches):
        worker.begins("jaccard")
        parts = Parts(percent)
        for batch in batches:
            nodes, listed, ends = [], [], [0]
            for text in batch.column(2):
                grams = shingle_set(text.as_py(), size)
                nodes.append(_node(grams))
                listed.append(parts.signatures(grams))
                ends.append(ends[-1] + len(listed[-1]))
            flat = np.concatenate(listed) if listed else np.empty(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), _signed(np.array(nodes, dtype=np.uint64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(flat))],
                names=["doc_id", "tag", "node", "parts"],
            )

    return run


def _plausible_edges(percent):
    """Edges (a, b) of rows (a, b, n, m, sketch, sketch of b) that are not ruled out."""
    def run(batches):
        for batch in batches:
            found = []
            for a, b, n, m, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                cells = min(len(left), len(right))
                if plausible((n, _folded(left, cells)), _folded(right, cells)[None, :], np.array([m]), percent)[0]:
                    found.append((a, b))
            yield _edges(found)

    return run


def plausible_forest(left, right, percent):
    """Edges of a spanning forest of the plausible pairs of two lists of (node, size, sketch)."""
    cells = min(len(x[2]) for x in (*left, *right))
    tables = [
        (np.array([x[1] for x in side], dtype=np.int64), np.stack([_folded(x[2], cells) for x in side]))
        for side in (left, right)
    ]
    (n, a), (m, b) = tables
    hits = np.stack([plausible((n[i], a[i]), b, m, percent) for i in range(len(left))])
    return forest(hits, [x[0] for x in left], [x[0] for x in right])


def overlaps(left, right):
    """Overlap counts (left, right) of two lists of shingle sets: a product of incidence matrices."""
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, dtype=int)
    sizes = np.diff(np.append(starts, len(grams)))
    flat = counts.reshape(-1)
    for size in range(2, SPARSE + 1):
        chosen = starts[sizes == size]
        if not len(chosen):
            continue
        members = owner[chosen[:, None] + np.arange(size)]
        rows, columns = np.broadcast_arrays(members[:, :, None], members[:, None, :] - len(left))
        hit = (rows < len(left)) & (columns >= 0)
        flat += np.bincount((rows[hit] * len(right) + columns[hit]), minlength=len(flat)).astype(np.float32)
    common = starts[sizes > SPARSE]
    common_sizes = sizes[sizes > SPARSE]
    width = 4096
    for begin in range(0, len(common), width):
        part, part_sizes = common[begin : begin + width], common_sizes[begin : begin + width]
        incidence = np.zeros((len(sets), len(part)), dtype=np.float32)
        column = np.repeat(np.arange(len(part)), part_sizes)
        at = np.repeat(part - np.append(0, np.cumsum(part_sizes)[:-1]), part_sizes) + np.arange(part_sizes.sum())
        incidence[owner[at], column] = 1
        counts += incidence[: len(left)] @ incidence[len(left) :].T
    return counts


def linked(left, right, percent):
    """Which pairs reach the similarity; overlaps below the bound given by both sizes are discarded."""
    a = np.array([len(s) for s in left], dtype=np.int64)[:, None]
    b = np.array([len(s) for s in right], dtype=np.int64)[None, :]
    both = overlaps(left, right).astype(np.int64)
    return 100 * both >= percent * (a + b - both)


def forest(links, left, right):
    """Edges of a spanning forest of the links between nodes ``left`` and ``right``."""
    found = []
    free_left, free_right = np.ones(len(left), dtype=bool), np.ones(len(right), dtype=bool)
    for first in np.flatnonzero(links.any(axis=1)):
        if not free_left[first]:
            continue
        free_left[first] = False
        rows = np.array([first])
        while len(rows):
            columns = np.flatnonzero(links[rows].any(axis=0) & free_right)
            free_right[columns] = False
            found.extend((right[c], left[first]) for c in columns)
            rows = np.flatnonzero(links[:, columns].any(axis=1) & free_left)
            free_left[rows] = False
            found.extend((left[r], left[first]) for r in rows)
    return found


def _by_task(links_of):
    """``links_of`` the rows (side, node, ...) of each task, of batches sorted by task."""
    def run(batches):
        task, held = None, []
        for batch in batches:
            found = []
            for name, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if name != task:
                    found.extend(links_of(held))
                    task, held = name, []
                held.append(row)
            yield _edges(found)
        yield _edges(links_of(held))

    return run


def _two_sides(held):
    left = [row for side, *row in held if side != 2]
    return left, [row for side, *row in held if side == 2] or left


def _products(percent):
    def links_of(held):
        left, right = ([(node, np.frombuffer(grams, dtype="<u8")) for node, grams in side] for side in _two_sides(held))
        hits = linked([g for _, g in left], [g for _, g in right], percent)
        return [e for e in forest(hits, [n for n, _ in left], [n for n, _ in right]) if e[0] != e[1]]

    return _by_task(links_of)


def _plausible_products(percent):
    def links_of(held):
        left, right = _two_sides(held)
        return [e for e in plausible_forest(left, right, percent) if e[0] != e[1]] if held else []

    return _by_task(links_of)


def _edges(found):
    return pa.RecordBatch.from_arrays(
        [pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
    )


def _grams(size):
    """Shingles of the texts whose set is the wanted ``node``; other texts of the same key are passed over."""
    def run(batches):
        worker.begins("jaccard")
        for batch in batches:
            wanted = batch.column("node").to_pylist()
            sets = [shingle_set(t.as_py(), size) for t in batch.column("text")]
            kept = [(n, s) for n, s in zip(wanted, sets) if int(_node(s).view(np.int64)) == n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in kept], pa.int64()), pa.array([s.astype("<u8").tobytes() for _, s in kept], pa.binary())],
                names=["node", "grams"],
            )

    return run


def _bounded(frame):
    """A broadcast hint for a written table of at most ``BROADCAST_NODES`` rows."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_NODES else frame


def _left_join(rows, written, key):
    """``rows`` with the columns of a written table; a key that many rows share is cut into slices."""
    if written.count() <= BROADCAST_NODES:
        return rows.join(F.broadcast(written), key, "left")
    return spread_join(rows, written, [key], ["doc_id", "tag"], how="left")


def listed_together(spark, texts, sets, folder, size, percent):
    """(part, node, hub) of nodes listed under a signature with others; ``hub`` is the least of them.

    Of documents with equal sets only one lists its parts, so copies are gone before the shuffle.
    Signatures are made a second time from the texts rather than stored: they are about half as
    large as the texts.
    """
    owners = sets.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "tag")).alias("owner"), F.count("*").alias("rows")
    ).where("rows > 1")
    owners.select("node", F.col("owner.doc_id").alias("owner_id"), F.col("owner.tag").alias("owner_tag")).write.parquet(f"{folder}/owners")
    owners = _bounded(spark.read.schema("node long, owner_id long, owner_tag long").parquet(f"{folder}/owners"))
    made = texts.mapInArrow(_listed(size, percent), PARTS)
    lists = F.col("owner_tag").isNull() | ((F.col("tag") == F.col("owner_tag")) & F.col("doc_id").eqNullSafe(F.col("owner_id")))
    single = made.join(owners, "node", "left").where(lists)
    # Rows equal in doc_id and text still list the same parts twice: they are one node.
    part = Window.partitionBy("part")
    hubs = single.select(F.explode("parts").alias("part"), "node").withColumns(
        {"hub": F.min("node").over(part), "_last": F.max("node").over(part)}
    )
    hubs.where("hub <> _last").drop("_last").write.parquet(f"{folder}/listed")
    return spark.read.schema("part long, node long, hub long").parquet(f"{folder}/listed")


def candidate_clusters(spark, listed, sets, folder, percent):
    """(node, cluster) of nodes that a chain of plausible pairs ties together."""
    members = listed.select("node").distinct()
    sketched = sets.select("node", F.col("n_shingles").alias("n"), "sketch").join(members, "node", "left_semi")
    sketched.dropDuplicates(["node"]).write.parquet(f"{folder}/sketched")
    sketched = spark.read.schema(SKETCHED).parquet(f"{folder}/sketched")
    stars = listed.where("node <> hub").select("node", "hub").distinct().join(sketched, "node")
    hubs = sketched.select(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("sketch").alias("sketch2"))
    sizes_fit = "100 * least(n, m) >= %d * greatest(n, m)" % percent
    pairs = spread_join(stars, hubs, ["hub"], ["node"]).where(sizes_fit)
    pairs = pairs.select("node", "hub", "n", "m", "sketch", "sketch2")
    pairs.mapInArrow(_plausible_edges(percent), LINKS).write.parquet(f"{folder}/stars")
    stars = spark.read.schema(LINKS).parquet(f"{folder}/stars")
    # A signature whose nodes are in one component is done, and so is one of two nodes.
    components(spark, stars).write.parquet(f"{folder}/tied")
    tied = _bounded(spark.read.schema("node long, root long").parquet(f"{folder}/tied"))
    placed = listed.select("part", "node").join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Rows of a part are in one file each, so these counts combine before their shuffle.
    open_parts = placed.groupBy("part").agg(
        F.count("*").alias("nodes"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
    ).where("nodes > 2 AND low <> high")
    # Signatures with the same nodes are compared once.
    chosen = open_parts.groupBy("members", "nodes").agg(F.min("part").alias("part")).select("part")
    chosen.write.parquet(f"{folder}/open")
    chosen = _bounded(spark.read.schema("part long").parquet(f"{folder}/open"))
    rows = listed.select("part", "node").join(chosen, "part").join(sketched.select("node", "n"), "node")
    tasks = block_tasks(rows.select("node", F.col("part").alias("cluster"), "n"), percent)
    rows = spread_join(tasks, sketched, ["node"], ["task"]).select("task", "side", "node", "n", "sketch")
    rows = rows.repartition("task").sortWithinPartitions("task", "side", "node")
    rows.mapInArrow(_plausible_products(percent), LINKS).write.parquet(f"{folder}/plausible")
    edges = stars.unionByName(spark.read.schema(LINKS).parquet(f"{folder}/plausible"))
    return components(spark, edges).select("node", F.col("root").alias("cluster"))


def block_tasks(nodes, percent):
    """(node, task, side) for every task a node takes part in; ``nodes`` has (node, cluster, n).

    Blocks have bounded nodes and shingles. Side 1 and 2 are two blocks, side 0 is one with itself.
    """
    band = F.floor(F.log2(F.col("n"))).cast("int")
    fits = F.greatest(F.lit(LEAST_NODES), F.least(F.lit(BLOCK_NODES), F.floor(BLOCK_SHINGLES / F.pow(2.0, F.col("band") + 1)).cast("int")))
    placed = number_rows(nodes.withColumn("band", band), ["cluster", "band"], ["n"], ["node"], "_at")
    placed = placed.withColumn("block", F.struct("band", F.floor((F.col("_at") - 1) / fits).alias("i"))).drop("_at")
    blocks = placed.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    other = blocks.select("cluster", F.col("block").alias("block2"), F.col("least").alias("least2"))
    pairs = blocks.join(other, "cluster").where(
        (F.col("block") <= F.col("block2")) & (F.col("most") * 100 >= F.col("least2") * percent)
    )
    name = F.concat_ws(" ", "cluster", "block.band", "block.i", "block2.band", "block2.i")
    same = F.col("block") == F.col("block2")
    sides = F.when(same, F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("block").alias("block"), F.lit(1).alias("side")), F.struct(F.col("block2").alias("block"), F.lit(2).alias("side")))
    )
    tasks = pairs.select("cluster", name.alias("task"), F.inline(sides))
    return placed.join(tasks, ["cluster", "block"]).select("node", "task", "side")


def _classes(documents, size, percent):
    """(doc_id, tag, n_shingles, node, class) of every row; tag is the hash of its text.

    ``class`` is one node of those that links tie together, null for an empty set.
    """
    spark = documents.sparkSession
    folder = scratch_dir(spark, "jaccard")
    texts = documents.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    texts.mapInArrow(_sets(size), SETS).write.parquet(f"{folder}/sets")
    sets = spark.read.schema(SETS).parquet(f"{folder}/sets")
    listed = listed_together(spark, texts, sets, folder, size, percent)
    clusters = candidate_clusters(spark, listed, sets, folder, percent)
    # Of the rows of a node, one gives the shingles: the least by (doc_id, tag), without doc_id first.
    full = sets.where("n_shingles > 0")
    nodes = full.groupBy("node").agg(F.min(F.struct("doc_id", "tag")).alias("row"), F.max("n_shingles").alias("n"))
    clusters.join(nodes, "node").select("node", "cluster", "row.*", "n").write.parquet(f"{folder}/clusters")
    members = spark.read.schema("node long, cluster long, doc_id long, tag long, n long").parquet(f"{folder}/clusters")
    chosen = _bounded(members.select("node", F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")))
    at = (F.col("tag") == F.col("_tag")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    grams = texts.join(chosen, at).select("node", "text").mapInArrow(_grams(size), "node long, grams binary")
    tasks = block_tasks(members.select("node", "cluster", "n"), percent)
    rows = grams.dropDuplicates(["node"]).join(tasks, "node").select("task", "side", "node", "grams")
    rows = rows.repartition("task").sortWithinPartitions("task", "side", "node")
    rows.mapInArrow(_products(percent), LINKS).write.parquet(f"{folder}/links")
    found = components(spark, spark.read.schema(LINKS).parquet(f"{folder}/links"))
    found.withColumnRenamed("root", "class").write.parquet(f"{folder}/classes")
    found = spark.read.schema("node long, class long").parquet(f"{folder}/classes")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("class", "node"))
    return _left_join(sets.drop("sketch"), found, "node").withColumn("class", own)


def near_duplicates(documents, size=3, percent=90):
    """(doc_id, n_shingles, component_id) of every row of ``documents`` (doc_id, text).

    Documents whose shingle sets have a Jaccard similarity of at least ``percent`` are linked;
    component_id is the smallest doc_id reachable by links. Empty sets are linked with nothing.
    Rows equal in doc_id are documents of their own with that id. A row without doc_id has no
    component (null), but links others like any row.
    """
    rows = _classes(documents, size, percent)
    least = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    shared = least.where("rows > 1").select("class", "least")
    return spread_join(rows, shared, ["class"], ["doc_id", "tag"], how="left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id")
    )


def keep_one(documents, size=5, percent=80):
    """The rows of ``documents``, all columns, that stand for their group: the smallest doc_id of it.

    Of rows with the smallest doc_id of a group, the one with the least hash of its text stays; of
    rows equal in both, one. Rows of one doc_id with different texts are in groups of their own
    texts. Rows without doc_id, and without words, stay. Texts are read in place; they are shuffled
    only if more rows go than ``BROADCAST_NODES``, or are repeated.
    """
    spark = documents.sparkSession
    folder = scratch_dir(spark, "kept")
    rows = _classes(documents, size, percent).where("class IS NOT NULL AND doc_id IS NOT NULL")
    keys = rows.groupBy("class", "doc_id", "tag").agg(F.count("*").alias("copies"))
    first = keys.groupBy("class").agg(F.min(F.struct("doc_id", "tag")).alias("first"), F.sum("copies").alias("rows"))
    groups = keys.join(first.where("rows > 1"), "class")
    stays = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("tag") == F.col("first.tag"))
    groups.select("doc_id", "tag", "copies", stays.alias("stays")).write.parquet(f"{folder}/groups")
    groups = spark.read.schema("doc_id long, tag long, copies long, stays boolean").parquet(f"{folder}/groups")
    tag = "_tag"
    while tag in documents.columns:
        tag += "_"
    key = ["doc_id", tag]
    gone = _bounded(groups.where("NOT stays").select("doc_id", F.col("tag").alias(tag)))
    left = documents.withColumn(tag, F.xxhash64("text")).join(gone, key, "left_anti")
    repeated = groups.where("stays AND copies > 1").select("doc_id", F.col("tag").alias(tag))
    if repeated.count():
        repeated = _bounded(repeated)
        left = left.join(repeated, key, "left_anti").unionByName(
            left.join(repeated, key, "left_semi").dropDuplicates(key)
        )
    return left.drop(tag)
