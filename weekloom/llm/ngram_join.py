"""Similarity join of documents on the Jaccard overlap of their word 5-grams, with Bayesian pruning of candidates.

1. Equal texts are one text from the start (a digest stands for it); copies are never compared with each other.
2. Each different text gets MinHash values, cut into bands. Texts that agree in a band share a bucket; buckets that hold the same texts
   are one. A bucket of many or long texts is cut into blocks by hash and every pair of blocks is a unit of its own, so neither a task
   nor the driver holds a whole hot bucket, and no rows of pairs exist anywhere: a unit hands on one row per linked text.
3. In a unit, a pair is looked at in the first band it agrees in. Its MinHash values are compared ``STEP`` at a time; after each step it is
   dropped if the posterior probability (uniform prior) of a similarity of at least the threshold is below ``TOLERANCE``.
4. What is left is verified exactly on the sets of 64-bit 5-gram hashes.
5. Linked texts form classes: connected components by alternating large and small stars.

Words are runs of letters, digits and underscores in lower case; a text of one to four words has its whole word sequence as its only
5-gram. Null and empty texts have no words and link to nothing, but equal ones are copies of each other. ``class_id`` is the smallest
``doc_id`` of the class (null if it has none), ``n_links`` the number of different texts the text is linked with, ``n_copies`` the number
of documents with the same text. Repeated rows are copies. Only ``doc_id`` and ``text`` are read; an empty table gives no rows.

A pair at exactly the threshold shares no band with a probability of about 1.5e-5, and less the more alike it is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_slices, written

THRESHOLD = 0.8
N = 5
BANDS, ROWS = 28, 5
STEP = 20
TOLERANCE = 1e-6
BLOCK_TEXTS = 400
BLOCK_SHINGLES = 500_000
SIEVE_BITS = 1 << 27
HOT_SHARE = 0.001  # a key with a larger share of a join's rows is joined by broadcast
SEEN = 200_000  # texts a task remembers to have handed on
WORD = re.compile(r"\w+")
VALUES = BANDS * ROWS

_draw = np.random.default_rng(97)
_SPREAD = _draw.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _draw.integers(1, 2**63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _draw.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the different 5-grams of a text."""
    from xxhash import xxh3_64_intdigest

    words = WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    h = mixed(np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, len(words)))
    if len(words) < N:
        return mixed(np.array([(h * _PLACE[:len(words)]).sum() + np.uint64(len(words))], np.uint64))
    n = len(words) - N + 1
    grams = np.zeros(n, np.uint64)
    for k in range(N):
        grams += h[k:k + n] * _PLACE[k]
    return np.unique(mixed(grams))


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values: for each multiplier the upper half of the smallest product."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for start in range(0, len(grams), 1024):  # a bound on memory for long texts
        least = np.minimum(least, (grams[start:start + 1024, None] * _SPREAD).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the multipliers differ from band to band, so keys of different bands don't meet."""
    rows = values.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mixed((rows * _BAND).sum(axis=2) + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For STEP, 2 STEP, ... compared values the fewest matches that keep a pair.

    With a uniform prior, m matches of n leave P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def unit_links(band: int, sides: np.ndarray, crossing: bool, grams: list[np.ndarray], threshold: float = THRESHOLD,
               tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(links of each text, root of each text) within a unit. ``crossing``: only pairs with a text on either side count."""
    n = len(grams)
    values = np.array([signature(g) for g in grams])
    keys = band_keys(values)
    sizes = np.array([len(g) for g in grams])
    keep = least_matches(threshold, tolerance)
    share = Fraction(threshold).limit_denominator(1000)
    up, down = share.numerator, share.denominator
    # postings: for each 5-gram that several texts of the unit have, those texts
    _, codes = np.unique(np.concatenate(grams), return_inverse=True)
    owners = np.repeat(np.arange(n), sizes)
    order = np.argsort(codes, kind="stable")
    starts = np.searchsorted(codes[order], np.arange(codes.max() + 2))
    owners, lengths = owners[order], np.diff(starts)
    ends = np.cumsum(sizes)

    links = np.zeros(n, np.int64)
    roots = np.arange(n)

    def root(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return int(i)

    for a in range(n - 1):
        rest = np.arange(a + 1, n)
        if crossing:
            rest = rest[sides[rest] != sides[a]]
        rest = rest[keys[rest, band] == keys[a, band]]
        if band and len(rest):
            rest = rest[~(keys[rest, :band] == keys[a, :band]).any(axis=1)]
        matched = np.zeros(len(rest), np.int64)
        for step, fewest in enumerate(keep):
            if not len(rest):
                break
            part = slice(step * STEP, (step + 1) * STEP)
            matched += (values[rest, part] == values[a, part]).sum(axis=1)
            good = matched >= fewest
            rest, matched = rest[good], matched[good]
        if not len(rest):
            continue
        mine = codes[ends[a] - sizes[a]:ends[a]]
        mine = mine[lengths[mine] > 1]
        met = np.concatenate([owners[starts[c]:starts[c + 1]] for c in mine]) if len(mine) else np.empty(0, np.int64)
        common = np.bincount(met, minlength=n)[rest]
        rest = rest[common * (up + down) >= up * (sizes[rest] + sizes[a])]
        links[a] += len(rest)
        links[rest] += 1
        for b in rest.tolist():
            x, y = root(a), root(b)
            roots[max(x, y)] = min(x, y)
    return links, np.array([root(i) for i in range(n)])


class NgramJoin:
    """The join of one table with itself; steps are written to the shared folder, so later ones never repeat earlier work."""

    def __init__(self, docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block_texts: int = BLOCK_TEXTS):
        self.threshold, self.tolerance, self.block_texts = threshold, tolerance, block_texts
        body = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(body)).alias("fp"), body.alias("body"))

    def members(self) -> DataFrame:
        """``doc_id, fp, n, keys`` of every document: the text's digest, its number of 5-grams and its band keys."""
        def work(ids, fps, texts):
            sets = [shingles(t) for t in texts]
            keys = [band_keys(signature(g))[0].view(np.int64).tolist() if len(g) else [] for g in sets]
            return [ids, fps, [len(g) for g in sets], keys]

        return map_slices(self.texts, "doc_id long, fp binary, n int, keys array<long>", work)

    def units(self, members: DataFrame) -> DataFrame:
        """``fp, key, band, low, high, side``: the texts of each unit. A text is in one unit per block of its bucket."""
        texts = members.dropDuplicates(["fp"])
        bands = texts.select("fp", "n", F.posexplode("keys").alias("band", "key"))
        h = F.xxhash64("fp")
        buckets = bands.groupBy("key", "band").agg(
            F.count("*").alias("size"), F.sum("n").alias("grams"), F.bit_xor(h).alias("one"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("two")).where("size > 1")
        # equal size and both exclusive ors: the same texts; the first band of them stands for all
        different = buckets.groupBy("size", "one", "two").agg(F.min(F.struct("band", "key", "grams")).alias("b")).select("size", "b.key", "b.grams")
        blocks = F.ceil(F.greatest(F.col("size") / self.block_texts, F.col("grams") / BLOCK_SHINGLES)).cast("int")
        placed = bands.select("fp", "band", "key").join(different.select("key", blocks.alias("blocks")), "key")
        placed = placed.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return placed.select("fp", "key", "band", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side")

    def sieve(self, units: DataFrame) -> np.ndarray:
        """A Bloom filter of the texts in units, two bits each, as 64-bit words.

        It has 16 bits per text, at most ``SIEVE_BITS``; a full one lets texts through that the join drops later.
        """
        texts = units.select("fp").distinct()
        bits = min(SIEVE_BITS, max(1 << 16, 1 << (16 * texts.count()).bit_length()))
        h = F.xxhash64("fp")
        places = texts.select(F.explode(F.array(*(h.bitwiseAND(F.lit(bits - 1)), F.shiftright(h, 32).bitwiseAND(F.lit(bits - 1))))).alias("p"))
        found = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
        words = np.zeros(bits >> 6, np.uint64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return words

    def grams(self, units: DataFrame) -> DataFrame:
        """``fp, grams`` of the texts in units (and few others): the hashes of their 5-grams as bytes.

        Texts are sieved where they are read, so only the hashes of texts with candidates travel. A task hands a text on once;
        from several tasks it may come more than once.
        """
        shared = units.sparkSession.sparkContext.broadcast(self.sieve(units))

        def run(batches):
            import pyarrow as pa

            words = shared.value
            last = len(words) * 64 - 1
            seen: set[bytes] = set()
            for batch in batches:
                h = batch.column("h").to_numpy()
                inside = np.ones(len(h), bool)
                for p in (h & last, (h >> 32) & last):
                    inside &= (words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
                fps, out = [], []
                for k in np.flatnonzero(inside).tolist():
                    fp = batch.column("fp")[k].as_py()
                    if fp in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(fp)
                    fps.append(fp)
                    out.append(shingles(batch.column("body")[k].as_py()).tobytes())
                    if len(fps) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), pa.array(out, pa.binary())], names=["fp", "grams"])
                        fps, out = [], []
                if fps:
                    yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), pa.array(out, pa.binary())], names=["fp", "grams"])

        return self.texts.select("fp", "body", F.xxhash64("fp").alias("h")).mapInArrow(run, "fp binary, grams binary")

    def linked(self, units: DataFrame) -> DataFrame:
        """``fp, n, root``: per unit and linked text its number of links there and the unit's smallest text it hangs together with."""
        rows = units.join(self.grams(units), "fp")
        dealt = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")
        threshold, tolerance = self.threshold, self.tolerance

        def run(batches):
            import pyarrow as pa

            def solved(unit: tuple, rows: dict[bytes, tuple[int, bytes]]):
                if len(rows) < 2:
                    return
                fps = list(rows)
                links, roots = unit_links(unit[3], np.array([s for s, _ in rows.values()]), unit[1] != unit[2],
                                          [np.frombuffer(g, np.uint64) for _, g in rows.values()], threshold, tolerance)
                at = np.flatnonzero(links).tolist()
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array([fps[i] for i in at], pa.binary()), pa.array(links[at], pa.int64()),
                                                      pa.array([fps[roots[i]] for i in at], pa.binary())], names=["fp", "n", "root"])

            unit, held = None, {}
            for fp, key, band, low, high, side, grams in streamed(batches):
                if unit is None or unit[:3] != (key, low, high):
                    if unit is not None:
                        yield from solved(unit, held)
                    unit, held = (key, low, high, band), {}
                held[fp] = (side, grams)  # the same text again changes nothing
            if unit is not None:
                yield from solved(unit, held)

        return dealt.mapInArrow(run, "fp binary, n long, root binary")

    def classes(self) -> DataFrame:
        """``fp, root, n_links`` of linked texts; texts without links are missing."""
        self.table = written(self.members(), "join-members")
        units = written(self.units(self.table), "join-units")
        links = written(self.linked(units), "join-links")
        roots = components(links.where("fp != root").select("fp", "root"))
        return links.groupBy("fp").agg(F.sum("n").alias("n_links")).join(roots, "fp").select("fp", "root", "n_links")

    def texts_with_class(self) -> DataFrame:
        """``fp, root, n_links, n_copies, first_id`` of every different text."""
        classes = self.classes()
        texts = self.table.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
        return texts.join(classes, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", "first_id")

    def documents(self) -> DataFrame:
        """One row per document: ``doc_id, class_id, n_links, n_copies``."""
        texts = written(self.texts_with_class(), "join-classes")
        ids = texts.groupBy("root").agg(F.min("first_id").alias("class_id"))
        known = written(texts.join(ids, "root").select("fp", "class_id", "n_links", "n_copies"), "join-known")
        rows = self.table.select("doc_id", "fp")
        return with_hot_keys(rows, known, "fp", "n_copies").select("doc_id", "class_id", "n_links", "n_copies")


def with_hot_keys(rows: DataFrame, known: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with ``known``, which has one row per key and in ``count`` the key's number of rows.

    A key with more than ``HOT_SHARE`` of all rows is hot. There are fewer than ``1 / HOT_SHARE`` of them, so their rows of ``known``
    are broadcast and their rows stay where they are; only the others are dealt by key.
    """
    limit = HOT_SHARE * (known.agg(F.sum(count)).first()[0] or 0)
    hot = F.broadcast(known.where(F.col(count) > limit))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(known.where(F.col(count) <= limit), key))


def streamed(batches) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))


def components(edges: DataFrame) -> DataFrame:
    """``fp, root`` for every node of the edges ``(fp, root)``: the smallest node of its component.

    Large stars hang a node's larger neighbours on its smallest one, small stars do so with the smaller ones; both repeat, each round
    written to the shared folder, until the edges no longer change. The number of rounds grows with the logarithm of the component's size.
    """
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select(F.col("fp").alias("u"), F.col("root").alias("v"))
        if large:
            both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = written(least.select("u", F.least("u", "m").alias("m"), "n"), "join-least")
        hung = with_hot_keys(both, least, "u", "n")
        if large:
            hung = hung.where("v > u").select(F.col("v").alias("fp"), F.col("m").alias("root"))
        else:
            hung = hung.select(F.col("v").alias("fp"), F.col("m").alias("root")).unionByName(least.select(F.col("u").alias("fp"), F.col("m").alias("root")))
        return hung.where("fp != root").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("fp", "root"))).first())

    pairs = written(edges.distinct(), "join-edges")
    before = mark(pairs)
    while True:
        pairs = written(stars(stars(pairs, True), False), "join-edges")
        now = mark(pairs)
        if now == before:
            break
        before = now
    return pairs.unionByName(pairs.select(F.col("root").alias("fp"), "root").distinct())


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, all its columns unchanged: the one with the smallest ``doc_id`` (null last), then text digest.

    Of repeated rows of that document the smallest in all columns stays; columns with maps, which have no order, count as JSON.
    """
    join = NgramJoin(docs, threshold)
    texts = join.texts_with_class().select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    same = join.table.groupBy("doc_id", "fp").agg(F.count("*").alias("times"))
    least = same.groupBy("fp").agg(F.min(F.struct(order.alias("o"), "times")).alias("b"))  # one row per text before the join
    best = least.join(texts, "fp").groupBy("root").agg(F.min("b").alias("b"))
    best = best.select(F.col("b.o.doc_id").alias("best_id"), F.col("b.o.fp").alias("best_fp"), F.col("b.times").alias("times"))
    best = written(best, "join-best")
    names = docs.columns
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("d"))
    digest = F.unhex(F.md5(F.coalesce(F.col("d.text").cast("string"), F.lit(""))))
    kept = whole.withColumn("fp", digest).join(best, (F.col("fp") == F.col("best_fp")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("best_id")))
    size = F.struct(*(F.to_json(F.struct(f"d.`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"d.`{f.name}`") for f in docs.schema))
    once = kept.where("times = 1").select("d.*")
    again = kept.where("times > 1").groupBy("best_fp", "best_id").agg(F.min_by("d", size).alias("d")).select("d.*")
    return once.unionByName(again)
