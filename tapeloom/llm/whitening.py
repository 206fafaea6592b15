"""Principal components and whitening of embeddings by Jacobi-Davidson, with the matrix never formed.

1. Vectors become integers, ``floor(256 * entry)``; each distinct one is once in the fit list,
   which is written as blocks of rows.
2. The covariance V is only ever multiplied: a pass over the blocks adds up c (c . u) of all centred
   rows c, for a block of directions u at once. A task hands on one sum per number of the product,
   whatever its rows, and Spark adds these up; the driver holds a few vectors of the embeddings' length.
3. Rayleigh-Ritz in the subspace gives the wanted directions; each that has not converged is
   corrected by projected MINRES, all in step so that they share their passes. Directions whose
   residual reaches double precision are locked.

Every product is centred before it is multiplied, and has the fit list's size as divisor.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapeloom.settings import scratch_dir

SCALE = 256
BLOCK_ROWS = 2048
COMPONENTS = 4
INNER, OUTER = 4, 500  # steps of MINRES at most; corrections after which an error is raised
SUBSPACE = 40  # directions after which the subspace is cut to the best
PRECISION = 64 * np.finfo(float).eps  # of a residual, against the largest eigenvalue
EIGHT = 1 << 61  # a sum of squares below it fits in a long for certain

PROJECTED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def integer_vectors(embeddings):
    """(vec_id, x array<long>): rows whose vector is not null and holds neither nulls nor non-finite entries.

    Vectors of another length than most rows have are left out as well (of equally many, the
    longer count), and so are empty ones.
    """
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    sound = embeddings.select("vec_id", "embedding").where(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False))
    )
    lengths = sound.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    found = lengths.collect()
    d = found[0]["d"] if found else 0
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return sound.where(F.size("embedding") == d).select("vec_id", whole.alias("x")), d


def _matrix(column, d):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(d):
    def run(batches):
        held, rows = [], 0

        def block():
            x = np.concatenate(held)
            kind = "<i4" if np.abs(x).max() < 1 << 31 else "<i8"
            return pa.RecordBatch.from_pydict({
                "rows": pa.array([len(x)], pa.int64()), "wide": pa.array([kind == "<i8"]),
                "entries": pa.array([x.astype(kind).tobytes()], pa.binary()),
            })

        for batch in batches:
            held.append(_matrix(batch.column(0), d))
            rows += len(held[-1])
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
        if rows:
            yield block()

    return run


class FitList:
    """Each distinct vector once, in written blocks, and the passes over them."""

    def __init__(self, spark, vectors, d):
        path = f"{scratch_dir(spark, 'whitening')}/fit"
        vectors.select("x").distinct().mapInArrow(_blocks(d), "rows long, wide boolean, entries binary").write.parquet(path)
        self.blocks, self.d = spark.read.parquet(path), d
        self.n = int(self.blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
        self.sums = self._added(lambda x: x.sum(axis=0), d, exact=True) if self.n else np.zeros(d, dtype=np.int64)
        self.mean = self.sums / max(1, self.n)
        self.passes = 0

    def _added(self, of_rows, width, exact=False):
        """Sum over all blocks of ``of_rows(x)``, ``width`` numbers; combined in the tasks and by Spark."""
        d = self.d

        def run(batches):
            total = np.zeros(width, dtype=np.int64 if exact else np.float64)
            for batch in batches:
                for wide, entries in zip(batch.column(0).to_pylist(), batch.column(1)):
                    x = np.frombuffer(entries.as_py(), "<i8" if wide else "<i4").reshape(-1, d)
                    total += of_rows(x.astype(np.int64 if exact else np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["i", "v"])

        kind = "long" if exact else "double"
        parts = self.blocks.select("wide", "entries").mapInArrow(run, f"i long, v {kind}")
        found = np.zeros(width, dtype=np.int64 if exact else np.float64)
        for i, v in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
            found[i] = v
        return found

    def product(self, directions):
        """V times a few directions (columns)."""
        self.passes += 1
        mean, k = self.mean, directions.shape[1]

        def of_rows(x):
            centred = x - mean
            return (centred.T @ (centred @ directions)).ravel()

        return self._added(of_rows, self.d * k).reshape(self.d, k) / self.n

    def trace(self):
        mean = self.mean
        return float(self._added(lambda x: np.array([np.square(x - mean).sum()]), 1)[0]) / self.n

    def gram(self, project, k):
        """Covariance of the projected rows, whose mean is zero."""
        def of_rows(x):
            y = project(x)
            return (y.T @ y).ravel()

        def total(x):
            return project(x).sum(axis=0)

        center = self._added(total, k) / self.n
        return self._added(of_rows, k * k).reshape(k, k) / self.n - np.outer(center, center)


def minres_in_step(product, rights, steps, tolerance):
    """MINRES for several symmetric systems at once; ``product`` takes one column per system.

    Each column gets the least residual in its own Krylov space; all share every product.
    """
    n, k = rights.shape
    x = np.zeros_like(rights)
    beta = np.linalg.norm(rights, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(rights), rights / np.where(live, beta, 1)
    w_old, w = np.zeros_like(rights), np.zeros_like(rights)
    eta, gamma_old, gamma, sigma_old, sigma = beta.copy(), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    last, first = np.zeros(k), beta.copy()
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - last * v_old
        norm = np.linalg.norm(p, axis=0)
        # The next column of the tridiagonal matrix, turned by the two rotations before.
        delta = gamma * alpha - gamma_old * sigma * last
        rho1 = np.hypot(delta, norm)
        rho2 = sigma * alpha + gamma_old * gamma * last
        rho3 = sigma_old * last
        live = live & (rho1 > 0)
        safe = np.where(live, rho1, 1)
        w_old, w = w, np.where(live, (v - rho3 * w_old - rho2 * w) / safe, 0)
        gamma_old, gamma, sigma_old, sigma = gamma, delta / safe, sigma, norm / safe
        x += np.where(live, gamma * eta, 0) * w
        eta = -sigma * eta
        live = live & (np.abs(eta) > tolerance * first) & (norm > 1e-14 * (np.abs(alpha) + last))
        if not live.any():
            break
        # A system that is solved rests: its columns are zero from here on.
        v_old, v, last = np.where(live, v, 0), np.where(live, p / np.where(live, norm, 1), 0), np.where(live, norm, 0)
    return x


def _orthonormal(block, against):
    """Columns of ``block`` orthonormal to ``against`` and each other; those that vanish are left out."""
    kept = against
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept = np.column_stack([kept, column])
    return kept[:, against.shape[1] :]


def jacobi_davidson(product, d, wanted, seed=1):
    """(eigenvalues, unit eigenvectors as columns) of the ``wanted`` largest of a symmetric matrix.

    ``product`` multiplies the matrix with columns. Only whole products decide that a direction has
    converged: its residual is at most ``PRECISION`` of the largest eigenvalue. Raises if that
    is not reached.
    """
    wanted = min(wanted, d)
    draw = np.random.default_rng(seed)
    basis = _orthonormal(draw.standard_normal((d, min(d, wanted + 2))), np.zeros((d, 0)))
    images = product(basis)
    locked, locked_values = np.zeros((d, 0)), []
    for turn in range(OUTER):
        values, turned = np.linalg.eigh((basis.T @ images + images.T @ basis) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        ritz, ritz_images = basis @ turned, images @ turned
        left = wanted - len(locked_values)
        residuals = ritz_images[:, :left] - ritz[:, :left] * values[:left]
        if locked.shape[1]:
            residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        largest = max([*locked_values[:1], abs(values[0])])
        done = 0
        while done < left and sizes[done] <= PRECISION * largest:
            done += 1
        # Lock from the largest on; what is locked leaves the subspace.
        locked = np.column_stack([locked, ritz[:, :done]])
        locked_values += values[:done].tolist()
        if len(locked_values) == wanted:
            return np.array(locked_values), locked
        basis, images = ritz[:, done:], ritz_images[:, done:]
        values, residuals, sizes, left = values[done:], residuals[:, done:], sizes[done:], left - done
        if basis.shape[1] + left > SUBSPACE:
            basis, images, values = basis[:, : 2 * wanted], images[:, : 2 * wanted], values[: 2 * wanted]
        space = np.column_stack([locked, basis[:, :left]])

        def project(columns):
            return columns - space @ (space.T @ columns)

        def corrected(columns):
            columns = project(columns)
            return project(product(columns) - columns * values[:left])

        steps = min(INNER, d - space.shape[1])
        new = minres_in_step(corrected, -project(residuals), steps, max(1e-3, 2.0 ** -(turn + 1))) if steps else residuals
        against = np.column_stack([locked, basis])
        new = _orthonormal(np.column_stack([new, residuals]) if turn % 5 == 4 else new, against)
        if not new.shape[1] and against.shape[1] < d:
            new = _orthonormal(draw.standard_normal((d, 1)), against)
        if new.shape[1]:
            basis, images = np.column_stack([basis, new]), np.column_stack([images, product(new)])
        else:  # the subspace is everything: fresh products remove what rounding has left
            images = product(basis)
    raise ArithmeticError(f"residuals {sizes} after {OUTER} corrections")


def _exact_deviations(x, n, sums):
    """Sum over the dimensions of (n x - S)^2 of every row; None where it does not fit in a long."""
    rough = np.square(n * x.astype(np.float64) - sums).sum(axis=1)
    found = [None] * len(x)
    fits = np.flatnonzero(rough < EIGHT)
    exact = np.square(n * x[fits] - sums).sum(axis=1)
    for i, value in zip(fits.tolist(), exact.tolist()):
        found[i] = value
    for i in np.flatnonzero(rough >= EIGHT).tolist():
        value = sum((n * entry - total) ** 2 for entry, total in zip(x[i].tolist(), sums.tolist()))
        found[i] = value if value < 1 << 63 else None
    return found


def whiten(embeddings, components=COMPONENTS):
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of every sound vector.

    See ``integer_vectors`` for the rows that are left out. Repeated vectors, repeated ids and rows
    without id are rows like others. Signs: the largest entry of a direction is positive. A
    component without variance (all vectors equal in it) has null ``whitened`` and explains 0;
    it takes no part in ``identity_error``, which is then of the others, or null. A
    ``deviation`` beyond 63 bits is null. No sound vectors, no rows.
    """
    spark = embeddings.sparkSession
    vectors, d = integer_vectors(embeddings)
    fit = FitList(spark, vectors, d) if d else None
    if not d or not fit.n:
        return spark.createDataFrame([], PROJECTED)
    n, sums, mean = fit.n, fit.sums, fit.mean
    trace = fit.trace()
    if trace:
        values, directions = jacobi_davidson(fit.product, d, components)
    else:
        values, directions = np.zeros(min(components, d)), np.eye(d)[:, : min(components, d)]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    real = values > d * PRECISION * values[0]
    k = len(values)
    scaled = directions[:, real] / np.sqrt(values[real])
    error = None
    if real.any():
        gram = fit.gram(lambda x: (x - mean) @ scaled, int(real.sum()))
        error = float(np.abs(gram - np.eye(len(gram))).max())
    explained = np.where(real, values / trace if trace else 0, 0)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            whitened = np.full((len(x), k), np.nan)
            whitened[:, real] = (x - mean) @ scaled
            rows = np.repeat(np.arange(len(x)), k)
            whitened = whitened.ravel()
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).cast(pa.int64()).take(pa.array(rows)),
                "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(rows), n), pa.int64()),
                "deviation": pa.array(_exact_deviations(x, n, sums), pa.int64()).take(pa.array(rows)),
                "whitened": pa.array(whitened, mask=np.isnan(whitened)),
                "explained": pa.array(np.tile(explained, len(x)), pa.float64()),
                "identity_error": pa.array([error] * len(rows), pa.float64()),
            })

    return vectors.mapInArrow(run, PROJECTED)
