"""Boosted regression trees over histograms, grown level by level.

Rows are kept as the numbers of their features' bins, several features with few bins packed into one code of two bytes (``Packing``). For each level of a tree the tasks add up, per node, feature and bin, the count of
rows and the sum of residuals; only these tables, whose size does not depend on the rows, go to the driver, which chooses the splits. The rows stay
persisted with their forecast so far, and each tree is followed by one pass that adds its values. A fit on few rows (``ONE_TASK``) runs the same
steps inside one task, so that many small fits can go side by side without a job per level.

The method is that of ``GBTRegressor`` with squared loss: at most 32 bins a feature, cut at quantiles of about 10000 rows; the first tree counts whole, later
ones follow twice the residual and count ``step_size``; every tree sees a random share of the rows, every node a random share of the features. Which rows
and features are drawn depends on the seed and the rows' keys alone, not on how rows lie in partitions.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from weekloom.session import ensure_checkpoint_dir

BINS = 32
SAMPLE_ROWS = 10_000
ONE_TASK = 400_000  # rows of a fit inside one task, at most
ROWS_PER_TASK = 50_000
CHECKPOINT_EVERY = 25  # trees
CHUNK = 1 << 18
CELLS = BINS * BINS  # of a table over the features packed into one code, at most
SMALL_FIT, SMALL_CELLS = 100_000, 4 * BINS  # rows of a fit for which large tables, or coding the rows in tasks of their own, cost more than they save
VALIDATION_TOLERANCE = 1e-3
NO_CODE = 255  # no code is beyond it
NO_SPLIT = BINS  # no bin is beyond it: every row goes left
PARTS = ("feature", "cut", "threshold", "value", "gain")
CODED = "key long, y double, late boolean, codes binary"
TREES = "tree int, feature array<int>, cut array<int>, threshold array<double>, value array<double>, gain array<double>"


@dataclass(frozen=True)
class Booster:
    """Settings of a fit, named as in ``trees.TreeParams``."""

    step_size: float
    max_iter: int
    max_depth: int
    feature_fraction: float
    row_fraction: float
    seed: int


@dataclass
class Ensemble:
    """Trees in level order, one row each: inner nodes (feature, threshold) and the values of the lowest level. A node that was
    not split sends every row to the left (threshold infinite)."""

    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @property
    def n_trees(self) -> int:
        return len(self.weight)

    @cached_property
    def importances(self) -> np.ndarray:
        """Share of each feature in the squared error that splits took away."""
        total = self.gain.sum(0)
        return total / total.sum() if total.sum() > 0 else total

    @cached_property
    def steps(self) -> list[np.ndarray]:
        """Per feature the thresholds at which any tree splits it."""
        split = np.isfinite(self.threshold)
        return [np.unique(self.threshold[split & (self.feature == f)]) for f in range(self.gain.shape[1])]

    @cached_property
    def places(self) -> np.ndarray:
        """Thresholds as numbers in the feature's steps: a row goes right where its code is larger."""
        return np.array([[np.searchsorted(self.steps[f], v) if np.isfinite(v) else NO_CODE for f, v in zip(*tree)] for tree in zip(self.feature, self.threshold)])

    def coded(self, x: np.ndarray) -> np.ndarray:
        """One byte per feature, the number of its steps below the value: all that the trees ask of a row."""
        out = np.zeros(x.shape, np.uint8)
        for f, steps in enumerate(self.steps):
            if len(steps):
                out[:, f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(steps, x[:, f]))
        return out

    def code(self, features: str) -> Column:
        """``coded`` as a column of bytes from a column with an array of doubles."""
        @F.arrow_udf("binary")
        def run(x: pa.Array) -> pa.Array:
            codes = self.coded(as_matrix(x))
            ends = (np.arange(len(x) + 1) * codes.shape[1]).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])

        return run(features)

    def tree(self, t: int, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Weighted value of a tree for rows whose features begin at ``starts`` of ``flat``."""
        node = np.zeros(len(starts), np.intp)
        inner = self.feature.shape[1]
        while inner and node[:1].size and node[0] < inner:  # all rows go down one level at a time
            right = flat[starts + self.feature[t][node]] > self.threshold[t][node]
            node = 2 * node + 1 + right
        return self.weight[t] * self.value[t][node - inner]

    def score(self, x: np.ndarray) -> np.ndarray:
        flat, starts = x.ravel(), np.arange(len(x)) * x.shape[1]
        out = np.zeros(len(x))
        for t in range(self.n_trees):
            out += self.tree(t, flat, starts)
        return out

    def predict(self, features: str) -> Column:
        """Forecast from a column with an array of doubles."""
        @F.arrow_udf("double")
        def run(x: pa.Array) -> pa.Array:
            return pa.array(self.score(as_matrix(x)))

        return run(features)

    def swapped_errors(self, x: np.ndarray, x2: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Sum of squared errors, first as it is, then with one feature after the other taken from ``x2``. A tree that does not ask for
        the feature keeps its value."""
        return self.coded_errors(self.coded(x), self.coded(x2), y)

    def coded_errors(self, codes: np.ndarray, codes2: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``swapped_errors`` from the rows' codes. The answers of both rows at all nodes of a tree are made once; a feature's are then swapped
        for the rows where they differ."""
        inner, depth = self.feature.shape[1], len(self.value[0]).bit_length() - 1
        word_type, bits = (np.uint32, 32) if inner < 32 else (np.uint64, 64)
        mine, other = np.ascontiguousarray(codes.T), np.ascontiguousarray(codes2.T)
        base, moved = np.zeros(len(y)), np.zeros((codes.shape[1], len(y)))

        def packed(answers: np.ndarray) -> np.ndarray:
            """Answers by node as bits of whole numbers, by row."""
            words = np.zeros((-(-max(inner, 1) // bits) * bits // 8, answers.shape[1]), np.uint8)
            words[:-(-inner // 8)] = np.packbits(answers, 0, bitorder="little")
            return np.ascontiguousarray(words.T).view(word_type)

        def leaf(words: np.ndarray) -> np.ndarray:
            node = np.zeros(len(words), word_type)
            for _ in range(depth):  # all rows go down one level at a time
                if words.shape[1] == 1:
                    answer = words[:, 0] >> node
                else:
                    answer = np.take_along_axis(words, (node // bits).astype(np.intp)[:, None], 1)[:, 0] >> node % bits
                answer &= 1
                node <<= 1
                node += 1
                node += answer
            return node.astype(np.intp) - inner

        for t in range(self.n_trees):
            value, cut = self.weight[t] * self.value[t], self.places[t][:, None]
            answers = packed(mine[self.feature[t]] > cut)
            apart = answers ^ packed(other[self.feature[t]] > cut)
            here = value[leaf(answers)]
            base += here
            for f in np.unique(self.feature[t][self.places[t] < NO_CODE]):
                swapped = apart & packed((self.feature[t] == f)[:, None])
                rows = np.flatnonzero(swapped.any(1) if swapped.shape[1] > 1 else swapped)
                moved[f, rows] += value[leaf(answers[rows] ^ swapped[rows])] - here[rows]
        return np.array([((y - base) ** 2).sum(), *((y - base - moved) ** 2).sum(1)])


def as_matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 1))


def cut_points(values: np.ndarray) -> np.ndarray:
    """At most ``BINS - 1`` thresholds: between all distinct values where they are few, else between those next to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    places = np.arange(len(distinct) - 1)
    if len(places) > BINS - 1:
        until = np.cumsum(counts)[:-1]
        share = len(values) / BINS * np.arange(1, BINS)
        after = np.searchsorted(until, share).clip(1, len(until) - 1)
        places = np.unique(after - (share - until[after - 1] < until[after] - share))
    return (distinct[places] + distinct[places + 1]) / 2


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each key (mixing steps of splitmix64)."""
    z = key + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) / 2.0**64


class Packing:
    """Which features share a code: one table over the code's cells then serves all of them, added up by feature at the end. A feature
    without cut points is in no code, as all its rows lie in bin 0."""

    def __init__(self, cuts: Sequence[np.ndarray], cells: int = CELLS):
        self.size, self.cells = np.array([len(c) + 1 for c in cuts]), cells
        self.groups: list[list[int]] = []
        for f in sorted(np.flatnonzero(self.size > 1).tolist(), key=lambda f: -self.size[f]):
            room = (g for g in self.groups if np.prod(self.size[g]) * self.size[f] <= cells)
            group = next(room, None)
            if group is None:
                self.groups.append([f])
            else:
                group.append(f)
        self.groups = self.groups or [[0]]
        # place and step of each feature in its code; one without cut points reads as 0
        self.group, self.step = np.zeros(len(cuts), np.intp), np.full(len(cuts), cells, np.int32)
        for g, features in enumerate(self.groups):
            self.group[features] = g
            self.step[features] = np.cumprod([1, *self.size[features][:-1]])

    def codes(self, x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
        """Codes by group for rows of features."""
        out = np.zeros((len(self.groups), len(x)), np.uint16)
        for f in np.flatnonzero(self.size > 1):
            out[self.group[f]] += (np.searchsorted(cuts[f], x[:, f]) * self.step[f]).astype(np.uint16)
        return out

    def bins(self, f: int) -> np.ndarray:
        """The feature's bin by cell of its code."""
        return np.arange(self.cells) // self.step[f] % self.size[f]

    def spread(self, tables: Sequence[np.ndarray], out: np.ndarray) -> None:
        """Add tables by group, node and cell to one by feature, node and bin."""
        by_bin = out.reshape(len(out), -1, BINS)
        for g, (features, table) in enumerate(zip(self.groups, tables)):
            cells = table.reshape(by_bin.shape[1], self.cells)
            if not g:
                by_bin[self.size == 1, :, 0] += cells.sum(1)
            for f, found in self.halves(cells[:, :np.prod(self.size[features])], features):
                if self.size[f] > 1:
                    by_bin[f, :, :self.size[f]] += found

    def halves(self, cells: np.ndarray, features: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Each feature's sums by node and bin; half of the features at a time is added up over the other half."""
        if len(features) == 1:
            yield features[0], cells
        else:
            low, high = features[:len(features) // 2], features[len(features) // 2:]
            square = cells.reshape(len(cells), -1, np.prod(self.size[low]))
            yield from self.halves(square.sum(1), low)
            yield from self.halves(square.sum(2), high)

    def rights(self, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """By node and cell of its feature's code, whether a row goes right."""
        return np.array([self.bins(f) > c for f, c in zip(feature, cut)])


class _Rows:
    """Some rows of a task: codes of their bins, and where each row is in the tree that grows."""

    def __init__(self, codes: np.ndarray, y: np.ndarray, key: np.ndarray, late: np.ndarray, pred: np.ndarray, packing: Packing | None = None):
        self.codes, self.y, self.key, self.late, self.pred, self.packing = codes, y, key, late, pred, packing
        self.at = np.arange(len(y))

    def start(self, p: Booster, t: int) -> _Rows:
        self.label = self.y if t == 0 else 2 * (self.y - self.pred)
        self.used = np.flatnonzero((_uniform(self.key, p.seed + 1 + t) < p.row_fraction) & ~self.late)
        self.node = np.zeros(len(self.y), np.intp)
        return self

    def add_to(self, sums: list[np.ndarray], counts: list[np.ndarray], slot: np.ndarray) -> None:
        """Residuals and rows per code, counted node and cell."""
        s = slot[self.node[self.used]]
        rows, base = self.used[s >= 0], s[s >= 0] * self.packing.cells
        label = self.label[rows]
        for g, codes in enumerate(self.codes):
            cell = base + codes[rows]
            sums[g] += np.bincount(cell, label, len(sums[g]))
            counts[g] += np.bincount(cell, minlength=len(counts[g]))

    def descend(self, feature: np.ndarray, cut: np.ndarray) -> None:
        start = self.packing.group[feature] * len(self.y)
        codes = self.codes.ravel()[start[self.node] + self.at]
        self.node = 2 * self.node + self.packing.rights(feature, cut).ravel()[self.node * self.packing.cells + codes]

    def late_error(self) -> tuple[float, int]:
        return float(((self.y - self.pred)[self.late] ** 2).sum()), int(self.late.sum())


def _coded(batches: Iterator[pa.RecordBatch], cuts: Sequence[np.ndarray], packing: Packing) -> Iterator[pa.RecordBatch]:
    """``CODED`` rows: the codes of a row as bytes, a fraction of its features."""
    for b in batches:
        codes = np.ascontiguousarray(packing.codes(as_matrix(b.column("x")), cuts).T)
        ends = (np.arange(b.num_rows + 1) * codes.shape[1] * codes.itemsize).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("y"), b.column("late"), data], names=["key", "y", "late", "codes"])


def _read(batches: Iterator[pa.RecordBatch], packing: Packing) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of ``CODED`` rows: codes by group, target, key, whether the row is kept from the fit, forecast so far."""
    parts, n = [], 0

    def block() -> tuple[np.ndarray, ...]:
        codes, y, key, late = zip(*parts)
        return np.concatenate(codes, 1), np.concatenate(y), np.concatenate(key), np.concatenate(late), np.zeros(n)

    for b in batches:
        if not b.num_rows:
            continue
        codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint16).reshape(b.num_rows, -1)
        parts.append((np.ascontiguousarray(codes.T), b.column("y").to_numpy(), b.column("key").to_numpy().astype(np.uint64),
                      b.column("late").to_numpy(zero_copy_only=False).astype(bool)))
        n += b.num_rows
        if n >= CHUNK:
            yield block()
            parts, n = [], 0
    if parts:
        yield block()


class _Here:
    """The rows of a fit inside one task."""

    def __init__(self, blocks: Iterator[tuple[np.ndarray, ...]], packing: Packing):
        self.rows = [_Rows(*b, packing) for b in blocks]

    def start(self, p: Booster, t: int) -> None:
        for rows in self.rows:
            rows.start(p, t)

    def count(self, slot: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        _add_up(self.rows, slot, sums, counts)

    def descend(self, feature: np.ndarray, cut: np.ndarray) -> None:
        for rows in self.rows:
            rows.descend(feature, cut)

    def finish(self, change: np.ndarray) -> None:
        for rows in self.rows:
            rows.pred = rows.pred + change[rows.node]

    def late_errors(self) -> list[tuple[float, int]]:
        return [rows.late_error() for rows in self.rows]


class _Spread:
    """The rows of a fit in the partitions of a persisted RDD."""

    def __init__(self, blocks: RDD, packing: Packing):
        self.blocks, self.packing, self.before = blocks.persist(StorageLevel.MEMORY_AND_DISK), packing, None

    def start(self, p: Booster, t: int) -> None:
        self.p, self.t, self.levels = p, t, []

    def count(self, slot: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        p, t, levels, shape, packing = self.p, self.t, self.levels, sums.shape, self.packing

        def run(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            s, c = np.zeros(shape), np.zeros(shape, np.int64)
            _add_up((_at(b, p, t, levels, packing) for b in blocks), slot, s, c)
            yield s, c

        for s, c in self.blocks.mapPartitions(run).collect():
            sums += s
            counts += c
        self._drop()

    def descend(self, feature: np.ndarray, cut: np.ndarray) -> None:
        self.levels = [*self.levels, (feature, cut)]

    def finish(self, change: np.ndarray) -> None:
        p, t, levels, packing = self.p, self.t, self.levels, self.packing

        def run(b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
            return *b[:4], b[4] + change[_at(b, p, t, levels, packing).node]

        self._drop()
        self.before, self.blocks = self.blocks, self.blocks.map(run, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CHECKPOINT_EVERY == 0:
            self.blocks.checkpoint()  # else the way back to the first rows grows with the trees

    def late_errors(self) -> list[tuple[float, int]]:
        return self.blocks.map(lambda b: _Rows(*b).late_error()).collect()

    def _drop(self) -> None:
        if self.before is not None:
            self.before.unpersist()
            self.before = None

    def close(self) -> None:
        self._drop()
        self.blocks.unpersist()


def _add_up(rows: Iterable[_Rows], slot: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add residuals and numbers of the rows by feature, counted node and bin."""
    held = None
    for part in rows:
        if held is None:
            packing, n = part.packing, sums.shape[1] // BINS
            held = [[np.zeros(n * packing.cells, kind) for _ in packing.groups] for kind in (float, np.int64)]
        part.add_to(*held, slot)
    if held is not None:
        packing.spread(held[0], sums)
        packing.spread(held[1], counts)


def _at(block: tuple[np.ndarray, ...], p: Booster, t: int, levels: list[tuple[np.ndarray, np.ndarray]], packing: Packing) -> _Rows:
    """Rows that have gone down the levels of the tree so far."""
    rows = _Rows(*block, packing).start(p, t)
    for level in levels:
        rows.descend(*level)
    return rows


class _Growth:
    """Choice of splits from the tables of counts and sums."""

    def __init__(self, rows: _Here | _Spread, cuts: Sequence[np.ndarray], p: Booster):
        self.rows, self.cuts, self.p = rows, cuts, p

    def counted(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and counts by counted node, feature and bin."""
        n = int(slot.max()) + 1
        sums, counts = np.zeros((len(self.cuts), n * BINS)), np.zeros((len(self.cuts), n * BINS), np.int64)
        self.rows.count(slot, sums, counts)
        return tuple(a.reshape(len(self.cuts), n, BINS).swapaxes(0, 1) for a in (sums, counts))

    def tree(self, t: int) -> tuple[np.ndarray, ...]:
        """Feature, bin and threshold of the inner nodes, values of the lowest level, gain per feature."""
        p, n_features = self.p, len(self.cuts)
        drawn = math.ceil(p.feature_fraction * n_features)
        self.rows.start(p, t)
        gain = np.zeros(n_features)
        features, places, value, alive = [], [], np.zeros(1), np.ones(1, bool)
        sums = counts = is_small = None
        for level in range(p.max_depth):
            k = 2**level
            feature, cut, below, growing = np.zeros(k, np.int32), np.full(k, NO_SPLIT, np.int32), np.repeat(value, 2), np.zeros(2 * k, bool)
            if alive.any():
                # the smaller child of a split node is counted, the other one is what remains
                counting = alive if level == 0 else alive & is_small
                slot = np.full(k, -1)
                slot[counting] = np.arange(counting.sum())
                new_sums, new_counts = self.counted(slot)
                if level:
                    s, c = np.zeros((k, n_features, BINS)), np.zeros((k, n_features, BINS), np.int64)
                    s[counting], c[counting] = new_sums, new_counts
                    nodes = np.flatnonzero(counting)
                    s[nodes ^ 1], c[nodes ^ 1] = sums[nodes // 2] - new_sums, counts[nodes // 2] - new_counts
                else:
                    s, c = new_sums, new_counts
                sums, counts = s, c
                left, n_left = s.cumsum(-1), c.cumsum(-1)
                whole, n_whole = left[..., -1:], n_left[..., -1:]
                left, n_left = left[..., :-1], n_left[..., :-1]
                right, n_right = whole - left, n_whole - n_left
                if level == 0:
                    value = whole[:, 0, 0] / np.maximum(n_whole[:, 0, 0], 1)
                    below = np.repeat(value, 2)
                both = (n_left > 0) & (n_right > 0)
                parent = whole**2 / np.maximum(n_whole, 1)
                score = left**2 / np.maximum(n_left, 1) + right**2 / np.maximum(n_right, 1) - parent
                score[~both | (score <= 1e-12 * parent)] = 0
                chance = np.random.default_rng([p.seed, t, level]).random((k, n_features)).argsort(1)
                score[chance >= drawn] = 0
                best = score.reshape(k, -1).argmax(1)
                f, b = np.divmod(best, BINS - 1)
                i = np.flatnonzero(alive & (score[np.arange(k), f, b] > 0))
                f, b = f[i], b[i]
                feature[i], cut[i] = f, b
                np.add.at(gain, f, score[i, f, b])
                nl, nr = n_left[i, f, b], n_right[i, f, b]
                below[2 * i], below[2 * i + 1] = left[i, f, b] / nl, right[i, f, b] / nr
                growing[2 * i] = growing[2 * i + 1] = True
                is_small = np.zeros(2 * k, bool)
                is_small[2 * i], is_small[2 * i + 1] = nl <= nr, nl > nr
            self.rows.descend(feature, cut)
            features.append(feature)
            places.append(cut)
            value, alive = below, growing
        feature, cut = np.concatenate(features), np.concatenate(places)
        threshold = np.array([self.cuts[f][b] if b < NO_SPLIT else np.inf for f, b in zip(feature, cut)])
        return feature, cut, threshold, value, gain

    def late_error(self) -> float:
        """Mean squared error of the rows that are kept from the fit."""
        total, n = zip(*self.rows.late_errors())
        return sum(total) / sum(n)

    def trees(self, validate: bool) -> list[tuple[np.ndarray, ...]]:
        """All trees; with rows kept from the fit, those up to the best, ended when their error no longer falls."""
        grown, best, kept = [], math.inf, 0
        for t in range(self.p.max_iter):
            grown.append(self.tree(t))
            weight = 1.0 if t == 0 else self.p.step_size
            self.rows.finish(weight * grown[-1][3])
            if validate:
                error = self.late_error()
                if t and best - error < VALIDATION_TOLERANCE * max(error, 0.01):
                    break
                if error < best or not t:
                    best, kept = error, t + 1
        return grown[:kept] if validate else grown


def fit(rows: DataFrame, p: Booster, n_rows: int, validate: bool = False, one_task: int = ONE_TASK) -> Ensemble:
    """Trees for ``key, x, y, late``: key (long) of a row, features (array of doubles), target, and with ``validate`` whether the row is kept from the
    fit; ``n_rows`` are not. The rows are read twice, first for the cut points."""
    if not n_rows:
        raise ValueError("no rows to fit trees on")
    share, sample = min(1.0, SAMPLE_ROWS / n_rows), []
    while not sample:  # keys that come very often may all miss a small share
        mixed = F.pmod(F.xxhash64("key", F.lit(p.seed)), F.lit(1 << 32))
        sample = rows.where((mixed < int(share * (1 << 32)) if share < 1 else F.lit(True)) & ~F.col("late")).select("x").collect()
        if not sample and share == 1:
            raise ValueError("no rows to fit trees on")
        share = min(1.0, 4 * share)
    cuts = [cut_points(column) for column in np.array([r["x"] for r in sample], float).T]
    small = n_rows <= min(SMALL_FIT, one_task)
    packing = Packing(cuts, SMALL_CELLS if small else CELLS)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _coded(batches, cuts, packing)

    laid = rows.select("key", "x", "y", "late")
    if not small:  # coded where they lie, so that an exchange moves a fraction of the features' bytes
        laid = laid.mapInArrow(code, CODED)
    if n_rows <= one_task:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t, parts in enumerate(_Growth(_Here(_read(code(batches) if small else batches, packing), packing), cuts, p).trees(validate)):
                yield pa.RecordBatch.from_pylist([{"tree": t, **dict(zip(PARTS, parts))}], schema=ARROW_TREES)

        found = [[r[c] for c in PARTS] for r in sorted(laid.repartition(1).mapInArrow(run, TREES).collect(), key=lambda r: r["tree"])]
    else:
        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _read(batches, packing):
                yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(b, pickle.HIGHEST_PROTOCOL)]})

        ensure_checkpoint_dir(rows.sparkSession)
        tasks = min(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_TASK))
        spread = _Spread(laid.repartition(tasks, "key").mapInArrow(blocks, "block binary").rdd.map(lambda r: pickle.loads(r["block"])), packing)
        try:
            found = _Growth(spread, cuts, p).trees(validate)
        finally:
            spread.close()
    weight = np.array([1.0, *[p.step_size] * (len(found) - 1)])
    return Ensemble(weight, *(np.array([tree[i] for tree in found]) for i in (0, 2, 3, 4)))


ARROW_TREES = pa.schema([("tree", pa.int32()), ("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.int32())),
                         ("threshold", pa.list_(pa.float64())), ("value", pa.list_(pa.float64())), ("gain", pa.list_(pa.float64()))])
