"""Whitening of embeddings by a covariance with multiplicities.

Entries become integers ``x = floor(64 c) + 1000000``. Equal x vectors are grouped into one with its count; the fit weighs each of them
by one or by its count (``weights``). Mean and covariance come from the grouped vectors: sums first, then one weighted matrix product a
task of vectors centred at the rounded mean. These are products of small integers, so the sums are exact and the same however the rows are
spread; the rounding of the mean is taken off afterwards (divisor: the sum of weights). Each different vector is whitened once and joined back to its rows.
Vectors shared by many rows are split over several parts of the join.

The driver holds sums of d and d x d numbers for d dimensions, nothing that grows with the rows.

Rows without a vector, or with null or non-finite entries, are dropped. So are empty vectors and vectors of another length than the
commonest (the longest of equally common ones). Components of no variance, to double precision, have null ``whitened`` and are left out of
``identity_error``. ``deviation`` is null where it exceeds 64 bits; entries beyond 2**62 / 64 count as that. Repeated rows come out as often as
they come in, a null ``vec_id`` stays null, an empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MAX_ENTRY = 2.0 ** 62
HOT_ROWS, HOT_SHARE = 64, 500  # a vector of more rows than both the first and a 500th of all is split, so at most 500 are
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def encoded(floors: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes: the width of an entry, then the entries; equal rows give equal bytes."""
    most = np.maximum(floors.max(axis=1), -1 - floors.min(axis=1))
    width = np.select([most < 2**7, most < 2**15, most < 2**31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(floors)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        data, step, head = floors[rows].astype(f"<i{w}").tobytes(), int(w) * floors.shape[1], bytes([w])
        for k, i in enumerate(rows.tolist()):
            out[i] = head + data[k * step:(k + 1) * step]
    return out


def decoded(keys: list[bytes], d: int) -> np.ndarray:
    """The integers of ``encoded`` as a matrix of 64-bit integers."""
    out = np.empty((len(keys), d), np.int64)
    width = np.array([k[0] for k in keys])
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        out[rows] = np.frombuffer(b"".join(keys[i][1:] for i in rows.tolist()), f"<i{w}").reshape(-1, d)
    return out


def keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, dim, key`` of the rows with a clean vector; the key stands for ``x - SHIFT``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            there = lists.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.where(there, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            entries = lists.flatten().to_numpy(zero_copy_only=False)  # nulls read as nan
            ends = np.cumsum(sizes)
            for d in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == d)
                c = entries[(ends[rows] - d)[:, None] + np.arange(d)].astype(np.float64)
                clean = np.isfinite(c).all(axis=1)
                rows, c = rows[clean], c[clean]
                if not len(rows):
                    continue
                floors = np.clip(np.floor(np.clip(c, -MAX_ENTRY / SCALE, MAX_ENTRY / SCALE) * SCALE), -MAX_ENTRY, MAX_ENTRY).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array(encoded(floors), pa.binary())],
                                                 names=["vec_id", "dim", "key"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, dim int, key binary")


def matrices(batches, d: int):
    """(integers, weights, batch) of each Arrow batch with columns ``key, weight``."""
    for batch in batches:
        if batch.num_rows:
            yield decoded(batch.column(0).to_pylist(), d), batch.column(1).to_numpy().astype(np.float64), batch


def sums(grouped: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """Sum of weights, exact weighted sums per dimension."""

    def run(batches):
        import pyarrow as pa

        total, weight = [0] * d, 0
        for y, w, _ in matrices(batches, d):
            w = w.astype(np.int64)
            safe = np.abs(y).max().astype(float) * float(w.sum()) < MAX_ENTRY
            part = (w @ y).tolist() if safe else (w.astype(object) @ y.astype(object)).tolist()
            total, weight = [a + b for a, b in zip(total, part)], weight + int(w.sum())
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array([weight] * d, pa.int64())],
                                             names=["j", "total", "weight"])

    rows = grouped.mapInArrow(run, "j int, total decimal(38,0), weight long").groupBy("j").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight")).collect()
    per = {r["j"]: int(r["total"]) for r in rows}
    return (int(rows[0]["weight"]) if rows else 0), [per[j] for j in sorted(per)]


def added(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the vectors ``v`` (64-bit floats as bytes) of each ``i``; added up by tasks, a vector for each ``i`` reaches the driver."""

    def run(batches):
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[i] = held.get(i, 0.0) + np.frombuffer(v)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["i", "v"])

    done = rows.repartition("i").mapInArrow(run, "i int, v binary")
    return {r["i"]: np.frombuffer(bytes(r["v"])) for r in done.collect()}


def rows_of(matrix: np.ndarray):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(range(len(matrix)), pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary())], names=["i", "v"])


def covariance(grouped: DataFrame, d: int, n: int, total: list[int]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Covariance over the weighted vectors, with the rounded mean and what it lacks to the mean."""
    centre = [(2 * s + n) // (2 * n) for s in total]
    lack = np.array([(s - n * c) / n for s, c in zip(total, centre)])

    def run(batches):
        moved, at = np.zeros((d, d)), np.array(centre, np.int64)
        for y, w, _ in matrices(batches, d):
            v = (y - at).astype(np.float64)
            moved += v.T @ (w[:, None] * v)
        if moved.any():
            yield rows_of(moved)

    got = added(grouped.mapInArrow(run, "i int, v binary"))
    product = np.stack([got[i] for i in range(d)]) if got else np.zeros((d, d))
    return product / n - np.outer(lack, lack), centre, lack


def whitened(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per clean vector and component; see the module's text."""
    spark = vectors.sparkSession
    rows = written(keyed(vectors).withColumn("at", F.monotonically_increasing_id()), "whitening-rows")
    groups = written(rows.groupBy("dim", "key").agg(F.count("*").alias("times")), "whitening-groups")
    by_size = groups.groupBy("dim").agg(F.sum("times").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    if by_size is None:
        return spark.createDataFrame([], OUT)
    d = by_size["dim"]
    groups = groups.where(F.col("dim") == d)
    grouped = groups.select("key", (F.lit(1).cast("long") if weights == "one" else F.col("times")).alias("weight"), "times")
    n, total = sums(grouped, d)
    v, centre, lack = covariance(grouped, d, n, total)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, d)
    alive = values[:kept] > max(values[0], 0.0) * d * np.finfo(float).eps
    scale = np.where(alive, 1 / np.sqrt(np.where(alive, values[:kept], 1.0)), 0.0)
    project = axes[:, :kept] * scale
    trace = float(np.trace(v))
    explained = [float(e / trace) if trace > 0 else 0.0 for e in values[:kept]]

    def whiten(batches):
        import pyarrow as pa

        at, rest = np.array(centre, np.int64), np.array([s - n * c for s, c in zip(total, centre)], object)
        for y, _, batch in matrices(batches, d):
            moved = y - at
            # n x - S in wrapping 64-bit arithmetic, right wherever the sum of squares fits
            wide = moved * np.int64(n) - np.array([r % 2**64 for r in rest], np.uint64).astype(np.int64)
            rough = ((n * (moved.astype(float) - lack)) ** 2).sum(axis=1)
            deviation = pa.array((wide * wide).sum(axis=1), mask=rough > 9.2e18)
            white = (moved - lack) @ project
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * kept), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), deviation, lists], names=["key", "weight", "times", "deviation", "white"])

    white = written(grouped.mapInArrow(whiten, "key binary, weight long, times long, deviation long, white array<double>"), "whitening-vectors")
    error = identity_error(white, kept, n, alive)
    limit = max(hot_rows, by_size["rows"] // HOT_SHARE)
    parts = F.ceil(F.col("times") / limit).cast("long")
    hot = white.where(F.col("times") > limit).select("key", parts.alias("parts"))
    salted = rows.where(F.col("dim") == d).join(F.broadcast(hot), "key", "left").withColumn("salt", F.coalesce(F.col("at") % F.col("parts"), F.lit(0)))
    spread = white.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).select("key", "salt", "deviation", "white")
    joined = salted.select("vec_id", "key", "salt").join(spread, ["key", "salt"])
    shares = F.array(*map(F.lit, explained))
    live = F.array(*map(F.lit, alive.tolist()))
    out = joined.select("vec_id", "deviation", F.posexplode("white").alias("p", "value"))
    return out.select("vec_id", (F.col("p") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                      F.when(live[F.col("p")], F.col("value")).alias("whitened"), shares[F.col("p")].alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(white: DataFrame, kept: int, n: int, alive: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""

    def run(batches):
        product, total, seen = np.zeros((kept, kept)), np.zeros((1, kept)), False
        for batch in batches:
            if batch.num_rows:
                z = batch.column(1).flatten().to_numpy().reshape(-1, kept)
                w = batch.column(0).to_numpy().astype(float)
                product, total, seen = product + z.T @ (w[:, None] * z), total + w @ z, True
        if seen:
            yield rows_of(np.vstack([product, total]))

    got = added(white.select("weight", "white").mapInArrow(run, "i int, v binary"))
    mean = got[kept] / n
    gap = np.stack([got[i] for i in range(kept)]) / n - np.outer(mean, mean) - np.eye(kept)
    gap = gap[np.ix_(alive, alive)]
    return float(np.abs(gap).max()) if gap.size else 0.0
