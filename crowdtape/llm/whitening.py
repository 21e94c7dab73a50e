"""Whitening of embeddings by an incremental eigendecomposition.

Each partition keeps the mean and the eigendecomposition of the scatter of the rows
it has seen. A row is a rank-one update of the centred scatter: its new eigenvalues
are the roots of a secular equation, entries that do not couple are deflated, and
the new eigenvectors follow from the roots. Spectra of partitions are combined in a
tree, each by as many rank-one updates as it has eigenpairs and one for the distance
of the means. The result is a basis; a last pass over all rows projects the
covariance on it, and the eigenvectors of that small matrix refine the basis to
double precision (Rayleigh-Ritz).

Functions on arrays have the lanes first: a partition deals its rows over several
independent decompositions, which numpy then updates side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import stored, table

#: Independent decompositions of a partition that has enough rows.
LANES = 8
#: Spectra that one task combines.
FAN_IN = 16
#: Entries become long numbers: so many steps for one, and this much more.
STEPS, OFFSET = 64, 1_000_000
#: They are cut at this size on either side, so that sums of millions of rows still fit a long.
LARGEST = 1 << 40
COMPONENTS = 32
#: Eigenvalues below this share of the largest one are zero, and their components do not exist.
ZERO_SHARE = 1e-12

SPECTRUM = "rows bigint, sums array<bigint>, mean array<double>, values array<double>, vectors array<double>"


# --- rank-one updates -----------------------------------------------------------------


def secular_roots(poles, weights, active):
    """Roots of ``1 + sum(weights / (poles - root)) = 0`` as ``(origin, offset)``, by pole.

    ``poles`` ascend within the ``active`` first entries of a lane. The root of a pole
    lies between it and the next one, the last one at most ``sum(weights)`` above. It is
    kept as its offset from the nearer pole, so differences to poles stay exact.
    """
    import numpy as np

    lanes, size = poles.shape
    eps = np.finfo(float).eps
    column = np.arange(size)
    last = column[None, :] == active[:, None] - 1
    live = column[None, :] < active[:, None]
    total = weights.sum(1, keepdims=True)
    following = np.concatenate([poles[:, 1:], poles[:, -1:]], 1)
    gap = np.where(last, total, following - poles)
    gap = np.where(live, gap, 1.0)
    with np.errstate(all="ignore"):

        def value(origin, offset):
            """The equation's left side, its slope, and the sum of its terms' sizes."""
            distance = (poles[:, None, :] - origin[:, :, None]) - offset[:, :, None]
            inverse = np.where(live[:, None, :], 1.0 / distance, 0.0)
            sums = np.matmul(inverse, weights[:, :, None])[..., 0]
            slope = np.matmul(inverse * inverse, weights[:, :, None])[..., 0]
            sizes = np.matmul(np.abs(inverse), weights[:, :, None])[..., 0]
            return 1.0 + sums, slope, 1.0 + sizes

        middle, _, _ = value(poles, gap / 2)
        right = (middle < 0) & ~last  # the root is beyond the middle: count from the next pole
        origin = np.where(right, following, poles)
        near = np.where(right, -gap, 0.0)  # offset of the left pole
        far = np.where(right, 0.0, gap)
        upper = middle >= 0
        low = np.where(upper, near, near + gap / 2)
        high = np.where(upper, near + gap / 2, far)
        offset = (low + high) / 2
        beyond = np.where(last, 2 * gap, far)  # a pole of no weight above the last root
        own = np.where(right, np.take_along_axis(weights, np.minimum(column + 1, size - 1)[None, :], 1), weights)
        for _ in range(64):
            f, slope, sizes = value(origin, offset)
            low = np.where(f < 0, offset, low)
            high = np.where(f < 0, high, offset)
            done = (np.abs(f) <= 4 * eps * sizes * size) | (high - low <= 2 * eps * np.abs(offset)) | ~live
            if done.all():
                break
            # Two poles with the nearer one's own weight, fitted to value and slope.
            left, next_ = near - offset, beyond - offset
            scale_left = np.where(right, slope - own / next_**2, own / left**2) * left**2
            scale_next = np.where(right, own / next_**2, slope - own / left**2) * next_**2
            level = f - scale_left / left - scale_next / next_
            a = level * (left + next_) + scale_left + scale_next
            b = level * left * next_ + scale_left * next_ + scale_next * left
            root = np.sqrt(np.maximum(a * a - 4 * level * b, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * level), 2 * b / (a + root))
            moved = offset + step
            inside = np.isfinite(moved) & (moved > low) & (moved < high)
            offset = np.where(done, offset, np.where(inside, moved, (low + high) / 2))
    return origin, offset


def deflated(values, parts, vectors):
    """Sorted eigenvalues, coordinates and vectors, with coordinates that do not couple set to zero."""
    import numpy as np

    order = np.argsort(values, 1, kind="stable")
    values = np.take_along_axis(values, order, 1)
    parts = np.take_along_axis(parts, order, 1)
    vectors = np.take_along_axis(vectors, order[:, None, :], 2)
    size = np.linalg.norm(parts, axis=1, keepdims=True)
    scale = 8 * np.finfo(float).eps * (values.max(1, keepdims=True) + size**2)
    parts = np.where(np.abs(parts) * size <= scale, 0.0, parts)
    close = np.diff(values, axis=1) <= scale
    for at in np.flatnonzero(close.any(0)):
        lane = np.flatnonzero((values[:, at + 1] - values[:, at] <= scale[:, 0]) & (parts[:, at] != 0))
        if not len(lane):
            continue
        # Turn the two vectors so that the upper one carries all of the update.
        both = np.hypot(parts[lane, at], parts[lane, at + 1])
        c, s = parts[lane, at + 1] / both, parts[lane, at] / both
        parts[lane, at], parts[lane, at + 1] = 0.0, both
        one, two = values[lane, at].copy(), values[lane, at + 1].copy()
        values[lane, at], values[lane, at + 1] = one * c * c + two * s * s, one * s * s + two * c * c
        one, two = vectors[lane, :, at].copy(), vectors[lane, :, at + 1].copy()
        vectors[lane, :, at] = one * c[:, None] - two * s[:, None]
        vectors[lane, :, at + 1] = one * s[:, None] + two * c[:, None]
    return values, parts, vectors


def rank_one(values, vectors, direction):
    """Eigendecompositions of ``vectors @ diag(values) @ vectors.T + direction @ direction.T``."""
    import numpy as np

    parts = np.matmul(direction[:, None, :], vectors)[:, 0, :]
    values, parts, vectors = deflated(values, parts, vectors)
    coupled = parts != 0
    active = coupled.sum(1)
    most = int(active.max())
    if not most:
        return values, vectors
    # The coupled entries first, in ascending order; the others stay as they are.
    front = np.argsort(~coupled, 1, kind="stable")
    values = np.take_along_axis(values, front, 1)
    parts = np.take_along_axis(parts, front, 1)
    vectors = np.take_along_axis(vectors, front[:, None, :], 2)
    poles, own = values[:, :most], parts[:, :most]
    live = np.arange(most)[None, :] < active[:, None]
    origin, offset = secular_roots(poles, own**2, active)
    with np.errstate(all="ignore"):
        # Pole minus root, by (root, pole); coordinates that fit the computed roots exactly.
        distance = (poles[:, None, :] - origin[:, :, None]) - offset[:, :, None]
        among = poles[:, None, :] - poles[:, :, None]
        ratio = distance / among
        both = live[:, :, None] & live[:, None, :]
        step = np.arange(most)
        ratio[:, step, step] = 1.0
        ratio = np.where(both, ratio, 1.0)
        square = np.abs(np.prod(ratio, 1) * distance[:, step, step])
        fitted = np.where(live, np.copysign(np.sqrt(square), own), 0.0)
        turn = fitted[:, :, None] / np.swapaxes(distance, 1, 2)  # by (pole, root)
    turn = np.where(both, turn, np.eye(most)[None])
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    values, vectors = values.copy(), vectors.copy()
    values[:, :most] = np.where(live, origin + offset, poles)
    vectors[:, :, :most] = np.matmul(vectors[:, :, :most], turn)
    return values, vectors


class Spectra:
    """Row counts, means and scatter eigendecompositions of several lanes."""

    def __init__(self, rows, mean, values, vectors):
        self.rows, self.mean, self.values, self.vectors = rows, mean, values, vectors

    @classmethod
    def empty(cls, lanes: int, size: int) -> Spectra:
        import numpy as np

        return cls(np.zeros(lanes), np.zeros((lanes, size)), np.zeros((lanes, size)), np.tile(np.eye(size), (lanes, 1, 1)))

    def add(self, points) -> None:
        """One centred rank-one update per lane."""
        import numpy as np

        away = points - self.mean
        share = self.rows / (self.rows + 1)
        self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(share)[:, None])
        self.rows = self.rows + 1
        self.mean = self.mean + away / self.rows[:, None]

    def join(self, other: Spectra) -> None:
        """Add the eigenpairs of ``other`` lane by lane, then the distance of the means."""
        import numpy as np

        for at in range(other.values.shape[1]):
            size = np.sqrt(np.maximum(other.values[:, at], 0.0))
            if size.any():
                self.values, self.vectors = rank_one(self.values, self.vectors, other.vectors[:, :, at] * size[:, None])
        away = other.mean - self.mean
        rows = np.maximum(self.rows + other.rows, 1)
        self.values, self.vectors = rank_one(
            self.values, self.vectors, away * np.sqrt(self.rows * other.rows / rows)[:, None]
        )
        self.mean = self.mean + away * (other.rows / rows)[:, None]
        self.rows = self.rows + other.rows

    def some(self, which) -> Spectra:
        return Spectra(self.rows[which], self.mean[which], self.values[which], self.vectors[which])

    def joined(self) -> Spectra:
        """All lanes as one, halves at a time."""
        import numpy as np

        left = self
        while len(left.rows) > 1:
            half = (len(left.rows) + 1) // 2
            first, second = left.some(slice(0, half)), left.some(slice(half, None))
            gap = half - len(second.rows)
            if gap:
                none = Spectra.empty(gap, left.mean.shape[1])
                second = Spectra(*(np.concatenate(pair) for pair in zip(vars(second).values(), vars(none).values(), strict=True)))
            first.join(second)
            left = first
        return left


# --- passes over the rows -------------------------------------------------------------


def long_vectors(vectors: DataFrame, embedding: str, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``) and ``x``, the entries as long numbers, of the rows that count.

    Null vectors and those with a null or non-finite entry are left out, and so are
    vectors shorter than the longest of the table, which lack entries.
    """
    c = F.col(embedding).cast("array<double>")

    def finite(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry) < float("inf"))

    sound = vectors.where(F.col(embedding).isNotNull() & F.forall(c, finite))
    def stepped(entry: Column) -> Column:
        steps = F.least(F.greatest(F.lit(float(STEPS)) * entry, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
        return F.floor(steps) + OFFSET

    rows = stored(sound.select(F.struct(*keep).alias("row"), F.transform(c, stepped).alias("x")), "vectors")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    return rows.where(F.size("x") == (longest or -1))


def _matrix(column):
    """Rows of an Arrow list column of one length, as an integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _spectrum_batch(spectrum: Spectra, sums, schema):
    import pyarrow as pa

    arrays = [
        pa.array([int(spectrum.rows[0])], pa.int64()),
        pa.array([sums.tolist()], pa.list_(pa.int64())),
        *(pa.array([part[0].ravel()], pa.list_(pa.float64())) for part in (spectrum.mean, spectrum.values, spectrum.vectors)),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _spectrum_schema():
    import pyarrow as pa

    doubles = pa.list_(pa.float64())
    return pa.schema(
        [("rows", pa.int64()), ("sums", pa.list_(pa.int64())), ("mean", doubles), ("values", doubles), ("vectors", doubles)]
    )


def partition_spectra(rows: DataFrame) -> DataFrame:
    """One row of ``SPECTRUM`` for each partition with rows: rank-one updates, row after row."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        lanes, sums, total = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(0))
            if lanes is None:
                size = points.shape[1]
                lanes, total = Spectra.empty(LANES, size), Spectra.empty(1, size)
                sums = np.zeros(size, np.int64)
            sums += points.sum(0)
            points = (points - OFFSET).astype(float)
            # Lanes pay where each gets more rows than joining it costs updates.
            whole = len(points) // LANES * LANES if len(points) >= 2 * LANES * size else 0
            for at in range(0, whole, LANES):
                lanes.add(points[at : at + LANES])
            for point in points[whole:]:
                total.add(point[None, :])
        if lanes is not None:
            if lanes.rows.any():
                total.join(lanes.joined())
            yield _spectrum_batch(total, sums, _spectrum_schema())

    return rows.select("x").mapInArrow(run, SPECTRUM)


def combined_spectrum(rows: DataFrame):
    """``(n, sums, basis)`` over all rows: spectra combined ``FAN_IN`` at a time, None without rows."""
    import numpy as np

    spectra = stored(partition_spectra(rows).withColumn("place", F.spark_partition_id()), "spectra")
    left = spectra.count()

    def combine(batches: Iterator) -> Iterator:
        total, sums = None, None
        for batch in batches:
            for rows, part_sums, mean, values, vectors in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                size = len(mean)
                part = Spectra(
                    np.array([rows], float), np.array([mean]), np.array([values]), np.array(vectors).reshape(1, size, size)
                )
                if total is None:
                    total, sums = part, np.array(part_sums)
                else:
                    total.join(part)
                    sums += np.array(part_sums)
        yield _spectrum_batch(total, sums, _spectrum_schema())

    while left > 1:
        numbered = spectra.groupBy(F.floor(F.col("place") / FAN_IN).alias("place")).agg(
            F.collect_list(F.struct("rows", "sums", "mean", "values", "vectors")).alias("parts")
        )

        def combine_group(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for at in range(batch.num_rows):
                    parts = batch.column(1)[at].values  # the structs of one group
                    flat = pa.RecordBatch.from_struct_array(parts)
                    joined = next(combine(iter([flat])))
                    yield pa.RecordBatch.from_arrays(
                        [*joined.columns, batch.column(0).slice(at, 1)],
                        schema=_spectrum_schema().append(pa.field("place", pa.int64())),
                    )

        spectra = stored(numbered.mapInArrow(combine_group, f"{SPECTRUM}, place bigint"), "spectra")
        left = spectra.count()
    one = spectra.first()
    if one is None:
        return None
    size = len(one.mean)
    basis, _ = np.linalg.qr(np.array(one.vectors).reshape(size, size))
    return one.rows, np.array(one.sums, dtype=object), basis


def _centred(points, n: int, sums):
    """``x - S / n`` with both taken from the floor of the mean first, so that little is lost."""
    import numpy as np

    floor = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n / n for s in sums])
    return (points - floor).astype(float) - rest


def summed_products(rows: DataFrame, n: int, sums, basis):
    """``sum(y y^T) / n`` over all rows, where ``y`` is the centred row times ``basis``; small, summed by Spark."""
    import numpy as np

    shared = rows.sparkSession.sparkContext.broadcast((n, sums, basis))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums, basis = shared.value
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in batches:
            if batch.num_rows:
                y = _centred(_matrix(batch.column(0)), n, sums) @ basis
                total += y.T @ y
        if total.any():
            places = np.flatnonzero(np.triu(np.ones_like(total)).ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(total.ravel()[places])], ["place", "total"]
            )

    parts = rows.select("x").mapInArrow(run, "place bigint, total double")
    cells = parts.groupBy("place").agg(F.sum("total").alias("total")).collect()
    found = np.zeros(basis.shape[1] ** 2)
    for cell in cells:
        found[cell.place] = cell.total
    found = found.reshape(basis.shape[1], -1)
    return (found + np.triu(found, 1).T) / n


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict | None:
    """Whitening of ``rows(x)``: mean, vectors by falling eigenvalue, explained shares, identity error.

    None without rows. Components whose eigenvalue is zero do not exist: there are none
    for one row or for equal rows, and at most as many as the rows span.
    """
    import numpy as np

    spectrum = combined_spectrum(rows)
    if spectrum is None:
        return None
    n, sums, basis = spectrum
    values, turn = np.linalg.eigh(summed_products(rows, n, sums, basis))
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], (basis @ turn)[:, order]
    count = int((values[:components] > ZERO_SHARE * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    weights = vectors[:, :count] / np.sqrt(values[:count])
    error = 0.0
    if count:
        error = float(np.abs(summed_products(rows, n, sums, weights) - np.eye(count)).max())
    return {
        "n": n,
        "sums": sums,
        "weights": weights,
        "explained": values[:count] / values.sum() if count else values[:0],
        "identity_error": error,
    }


def whiten(rows: DataFrame, model: dict | None) -> DataFrame:
    """``row``, ``deviation`` (exact; null where it exceeds a long) and ``whitened`` of ``rows(row, x)``."""
    kind = rows.schema["row"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            if model is None or not batch.num_rows:
                continue
            points = _matrix(batch.column(0))
            n, sums = model["n"], model["sums"]
            whitened = _centred(points, n, sums) @ model["weights"]
            floor = np.array([int(s) // n for s in sums], np.int64)
            rest = np.array([int(s) % n for s in sums], np.int64)
            near = points - floor
            limit = float(np.abs(near).max(initial=0) + 1.0) * n
            if limit * limit * points.shape[1] < 2.0**62:
                deviation = ((n * near - rest) ** 2).sum(1).tolist()
            else:  # products beyond 64 bits
                wide = n * near.astype(object) - rest.astype(object)
                deviation = [d if d < 2**63 else None for d in (wide * wide).sum(1)]
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(points) + 1) * whitened.shape[1], pa.int32()), pa.array(whitened.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(deviation, pa.int64()), flat],
                schema=pa.schema(
                    [batch.schema.field(1), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]
                ),
            )

    return rows.select("x", "row").mapInArrow(run, f"row {kind}, deviation bigint, whitened array<double>")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_vectors(table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"])
    model = fit(rows)
    shares = [float(share) for share in model["explained"]] if model else []
    explained = F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>")
    each = whiten(rows, model).select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model["n"] if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model["identity_error"] if model else 0.0).alias("identity_error"),
    )
