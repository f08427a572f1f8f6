"""Subword lattice likelihood: the probability of a text summed over all its segmentations into vocabulary pieces.

The pieces are those of an existing vocabulary file. A text is lower-cased (A-Z) and cut into words at ASCII white space; a word stands
with the vocabulary's marker before it and every split of it into pieces counts, characters also as their UTF-8 byte pieces. Word
boundaries are piece boundaries, so the forward recursion in log space runs once per distinct word, and a text's log probability
is the sum over its words plus that of one end piece.

The file gives an order of pieces, not probabilities; a Zipf law over that order starts the scores, and ``ROUNDS`` passes over the
word counts of all training texts re-estimate them (expected piece counts under all segmentations; the pieces stay as they are). What
travels to the driver is one number per piece, bounded by the vocabulary.

Beside it stands the base: add-one word probabilities from the same counts. Words counted often (at most ``HEAD`` of them, a bound on what
is sent to tasks, whatever the corpus) are scored in the scan; all other words are joined with the word table by a shuffle.
Frequent words therefore make no hot key.

Null and empty texts consist of the end alone. A null ``doc_id`` hashes like the empty string and belongs to training. Repeated rows
are scored, and counted, one by one. Without training texts every count is 0. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import written
from weekloom.llm.sentencepiece_codec import BYTE, MARK, MODEL, NORMAL, USER_DEFINED, load, parse

HEAD = 100_000
ROUNDS = 2
PRIOR = 0.1  # pseudo-count of every piece
MAX_PIECES = 1 << 20
FLUSH = 400_000  # distinct words a task gathers before it hands them on
WIDE = 32  # words up to this length are scored together in arrays, longer ones one by one
END, NEVER = "</s>", -np.inf
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Vocabulary:
    """Pieces, and an index of all their prefixes by 64-bit hash.

    The index has tables addressed by some bits of the hash; a prefix lies in the first table whose place was free. So an empty place
    says that there is no such prefix, and only a place taken by another one leads on to the next table.
    """

    def __init__(self, data: bytes):
        model = parse(data)
        plain = [p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED) and MARK not in p[1:]]
        if len(plain) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        order = {p: -s for p, s, _ in model.pieces}
        self.pieces = sorted(plain, key=lambda p: (order[p], p))
        self.place = {p: i for i, p in enumerate(self.pieces)}
        self.none = len(self.pieces)
        self.size = len(self.pieces) + 256 + 1  # then the bytes, then the end
        self.end = self.size - 1
        self.longest = max(map(len, self.pieces))
        prefixes = sorted({p[:k] for p in self.pieces for k in range(1, len(p) + 1)})
        hashes = [self.hash_of(p) for p in prefixes]
        self.hashes = np.array([*hashes, 0], np.uint64)
        self.piece_at = np.array([self.place.get(p, self.none) for p in prefixes] + [self.none], np.int32)
        self.tables: list[np.ndarray] = []
        self.shifts = [np.uint64(n) for n in (44, 24, 4, 34, 14)]
        left = range(len(prefixes))
        for shift in self.shifts:
            table, over = np.full(1 << 20, len(prefixes), np.int32), []
            for i in left:
                slot = hashes[i] >> int(shift) & 0xFFFFF
                if table[slot] == len(prefixes):
                    table[slot] = i
                else:
                    over.append(i)
            self.tables.append(table)
            left = over
            if not left:
                break
        if left:
            raise ValueError("the index of prefixes has too few tables")

    @staticmethod
    def hash_of(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h + ord(c) + 1) * int(_BASE)) & 0xFFFFFFFFFFFFFFFF
            h ^= h >> 29
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of the prefixes with these hashes; one past the last where there is none."""
        none = len(self.hashes) - 1
        out = np.full(len(h), none, np.int32)
        rest = np.arange(len(h))
        for table, shift in zip(self.tables, self.shifts):
            at = table[(h >> shift) & np.uint64(0xFFFFF)]
            same = self.hashes[at] == h
            out[rest[same]] = at[same]
            on = ~same & (at != none)
            if not on.any():
                break
            rest, h = rest[on], h[on]
        out[self.hashes[out] == 0] = none
        return out

    def start(self) -> np.ndarray:
        """Natural-log scores before training: a Zipf law over the file's order, bytes and end at the rare end of it."""
        weight = np.empty(self.size)
        weight[:len(self.pieces)] = 1 / (np.arange(len(self.pieces)) + 10)
        weight[len(self.pieces):] = weight[len(self.pieces) - 1]
        return np.log(weight / weight.sum())

    def spelled(self, c: str) -> list[int]:
        """Places of a character's byte pieces."""
        return [len(self.pieces) + b for b in c.encode()]


@lru_cache(maxsize=2)
def vocabulary_of(data: bytes) -> Vocabulary:
    return Vocabulary(data)


def edges(vocabulary: Vocabulary, letters: np.ndarray):
    """(i, j, words, places): the pieces that stand at i..j in equally long words, given as code points. By i, then j."""
    rows, n = letters.shape
    none = len(vocabulary.hashes) - 1
    for i in range(n):
        alive, h = np.arange(rows), np.zeros(rows, np.uint64)
        for j in range(i + 1, min(i + vocabulary.longest, n) + 1):
            h = (h + letters[alive, j - 1] + np.uint64(1)) * _BASE
            h ^= h >> np.uint64(29)
            at = vocabulary.find(h)
            on = at != none  # only the beginning of some piece can grow into a piece
            alive, h, at = alive[on], h[on], at[on]
            if not len(alive):
                break
            places = vocabulary.piece_at[at]
            whole = places != vocabulary.none
            if whole.any():
                yield i, j, alive[whole], places[whole]


def characters(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different code points, and for each code point its place among them."""
    codes = np.flatnonzero(np.bincount(letters.ravel().astype(np.int64)))
    places = np.zeros(int(codes[-1]) + 1, np.int64)
    places[codes] = np.arange(len(codes))
    return codes, places


def forward(vocabulary: Vocabulary, letters: np.ndarray, scores: np.ndarray, expected: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each word. With ``expected``, the expected piece counts times ``weights`` are added to it."""
    rows, n = letters.shape
    codes, order = characters(letters)
    each = np.array([scores[vocabulary.spelled(chr(c))].sum() for c in codes.tolist()])
    spelled = each[order[letters]].T.copy()  # spelling a character in bytes; a word's marker never is
    spelled[0] = NEVER
    found = list(edges(vocabulary, letters))
    ahead = np.full((n + 1, rows), NEVER)
    ahead[0] = 0
    at = 0
    for i in range(n):
        while at < len(found) and found[at][0] == i:
            _, j, words, places = found[at]
            ahead[j, words] = np.logaddexp(ahead[j, words], ahead[i, words] + scores[places])
            at += 1
        if i:
            ahead[i + 1] = np.logaddexp(ahead[i + 1], ahead[i] + spelled[i])
    if expected is not None:
        behind = np.full((n + 1, rows), NEVER)
        behind[n] = 0
        for i in range(n - 1, -1, -1):
            behind[i] = behind[i + 1] + spelled[i]
            while at and found[at - 1][0] == i:
                at -= 1
                _, j, words, places = found[at]
                behind[i, words] = np.logaddexp(behind[i, words], scores[places] + behind[j, words])
        if found:
            shares = [np.exp(ahead[i, words] + scores[places] + behind[j, words] - ahead[n, words]) * weights[words] for i, j, words, places in found]
            expected += np.bincount(np.concatenate([f[3] for f in found]), np.concatenate(shares), len(expected))
        share = np.exp(ahead[:n] + spelled + behind[1:] - ahead[n]) * weights
        for c, w in zip(codes.tolist(), np.bincount(order[letters.T].ravel(), share.ravel(), len(codes)).tolist()):
            if w:
                for place in vocabulary.spelled(chr(c)):
                    expected[place] += w
    return ahead[n]


def one_word(vocabulary: Vocabulary, word: str, scores: np.ndarray, expected: np.ndarray | None = None, weight: float = 0.0) -> float:
    """The same for a single word of any length, the marker included."""
    n, place = len(word), vocabulary.place

    def arcs(i):
        for j in range(i + 1, min(i + vocabulary.longest, n) + 1):
            p = place.get(word[i:j])
            if p is not None:
                yield j, (p,), scores[p]
        if i:
            spelled = vocabulary.spelled(word[i])
            yield i + 1, spelled, scores[spelled].sum()

    ahead = [NEVER] * (n + 1)
    ahead[0] = 0.0
    for i in range(n):
        for j, _, s in arcs(i):
            ahead[j] = np.logaddexp(ahead[j], ahead[i] + s)
    if expected is not None:
        behind = [NEVER] * n + [0.0]
        for i in range(n - 1, -1, -1):
            for j, _, s in arcs(i):
                behind[i] = np.logaddexp(behind[i], s + behind[j])
            for j, places, s in arcs(i):
                share = math.exp(ahead[i] + s + behind[j] - ahead[n]) * weight
                for p in places:
                    expected[p] += share
    return float(ahead[n])


def word_scores(vocabulary: Vocabulary, words: list[str], scores: np.ndarray, expected: np.ndarray | None = None, weights=None) -> np.ndarray:
    """Natural-log probability of each word."""
    out = np.empty(len(words))
    weights = None if weights is None else np.asarray(weights, float)
    by_size: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(len(w), []).append(k)
    for n, places in by_size.items():
        if n > WIDE:
            for k in places:
                # a literal marker inside a word is never a word's marker
                out[k] = one_word(vocabulary, MARK + words[k], scores, expected, 0.0 if weights is None else weights[k])
        else:
            letters = np.array([MARK + words[k] for k in places], f"<U{n + 1}").view(np.uint32).reshape(len(places), n + 1).astype(np.uint64)
            out[places] = forward(vocabulary, letters, scores, expected, None if weights is None else weights[places])
    return out


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words. Splitting bytes separates at 0x20 and 0x09-0x0D only."""
    return (text or "").encode().translate(_LOWER).split()


def word_table(docs: DataFrame) -> DataFrame:
    """``word, c`` over all documents; c counts occurrences in training documents. An end per training document is the null word."""
    def run(batches):
        import pyarrow as pa

        counts: Counter[bytes | None] = Counter()
        unseen: set[bytes] = set()

        def rows():
            unseen.difference_update(counts)
            words = pa.array([*counts, *unseen], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([*counts.values(), *[0] * len(unseen)], pa.int64())], names=["word", "c"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    if held_out(doc_id):
                        unseen.update(words_of(text))
                    else:
                        counts.update(words_of(text))
                        counts[None] += 1
                if len(counts) + len(unseen) > FLUSH:
                    yield rows()
                    counts.clear()
                    unseen.clear()
        if counts or unseen:
            yield rows()

    parts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "word string, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def gathered(batches, size: int = 50_000):
    """(words, counts) of at least ``size`` rows together: many words of one length make long arrays."""
    words, counts = [], []
    for batch in batches:
        words += batch.column(0).to_pylist()
        counts += batch.column(1).to_pylist()
        if len(words) >= size:
            yield words, counts
            words, counts = [], []
    if words:
        yield words, counts


class LatticeModel:
    """A vocabulary with scores learned from the word counts of a corpus."""

    def __init__(self, data: bytes | None = None, rounds: int = ROUNDS, head: int = HEAD):
        self.data = load(MODEL) if data is None else data
        self.rounds, self.head = rounds, head
        self.vocabulary = vocabulary_of(self.data)
        self.scores = self.vocabulary.start()

    def fit(self, docs: DataFrame) -> LatticeModel:
        counts = written(word_table(docs), "lattice-words")
        totals = counts.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1)).alias("v"),
                            F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends")).first()
        self.tokens, self.distinct, self.ends = totals["n"] or 0, totals["v"] or 0, totals["ends"] or 0
        words = counts.where("word is not null")
        for _ in range(self.rounds):
            self.scores = self.reestimated(words)
        data, scores = self.data, self.scores

        def run(batches):
            import pyarrow as pa

            for w, c in gathered(batches):
                logp = word_scores(vocabulary_of(data), w, scores)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(c, pa.int64()), pa.array(logp)], names=["word", "c", "logp"])

        self.table = written(words.mapInArrow(run, "word string, c long, logp double"), "lattice-scores")
        return self

    def reestimated(self, words: DataFrame) -> np.ndarray:
        """Scores from expected piece counts over all training words; one row per piece comes to the driver."""
        data, scores = self.data, self.scores

        def run(batches):
            import pyarrow as pa

            vocabulary = vocabulary_of(data)
            expected = np.zeros(vocabulary.size)
            for w, c in gathered(batches):
                word_scores(vocabulary, w, scores, expected, c)
            places = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(expected[places])], names=["piece", "n"])

        found = words.where("c > 0").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(self.vocabulary.size, PRIOR)
        for r in found:
            counts[r["piece"]] += r["n"]
        counts[self.vocabulary.end] += self.ends
        return np.log(counts / counts.sum())

    def frequent(self) -> tuple[int, dict[bytes, tuple[float, float]]]:
        """(lowest level of counts, word -> parts of its base and score) of the most frequent words, at most ``head`` of them."""
        level = F.floor(F.log2(F.col("c")) * 8)
        sizes = self.table.where("c > 1").groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # < 512 rows
        total, lowest = 0, None
        for r in sizes:
            total += r["count"]
            if total > self.head:
                break
            lowest = r["level"]
        if lowest is None:
            return 0, {}
        rows = self.table.where("c > 1").where(level >= lowest)
        return lowest, {r["word"].encode(): (math.log10(r["c"] + 1), r["logp"]) for r in rows.toLocalIterator()}

    def score(self, docs: DataFrame) -> DataFrame:
        """One row per document: counts of tokens, the base score and the score of the lattice, both log10."""
        lowest, head = self.frequent()
        shared = docs.sparkSession.sparkContext.broadcast(head)
        rest = self.table if not head else self.table.where((F.col("c") <= 1) | (F.floor(F.log2(F.col("c")) * 8) < lowest))
        unit = math.log10(self.tokens + self.distinct + 1)
        end_c, end_score = self.ends, float(self.scores[self.vocabulary.end])

        def run(batches):
            import pyarrow as pa

            known_words = shared.value
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    rows, ids, texts = (c.to_pylist() for c in batch.slice(start, 256).columns)
                    heads, words, counts, offsets = [], [], [], [0]
                    for row, doc_id, text in zip(rows, ids, texts):
                        tokens, known, base, score = 1, int(end_c > 0), math.log10(end_c + 1), end_score
                        # a key that no word can have; it carries the text's sums and spreads over the join's partitions
                        words.append(b" %d" % row)
                        counts.append(0)
                        for w, n in Counter(words_of(text)).items():
                            tokens += n
                            got = known_words.get(w)
                            if got is None:
                                words.append(w)
                                counts.append(n)
                            else:
                                known += n
                                base += n * got[0]
                                score += n * got[1]
                        offsets.append(len(words))
                        heads.append((row, doc_id, held_out(doc_id), tokens, known, base, score))
                    at = pa.array(offsets, pa.int32())
                    lists = [pa.ListArray.from_arrays(at, pa.array(words, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int32()))]
                    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*heads), types)), *lists], names=names)

        names = ["row", "doc_id", "held_out", "tokens", "known", "base", "score", "words", "counts"]
        scanned = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
            run, "row long, doc_id long, held_out boolean, tokens long, known long, base double, score double, words array<string>, counts array<int>")
        cells = scanned.select(*names[:7], F.posexplode(F.arrays_zip("words", "counts")).alias("k", "w"))
        cells = cells.select("row", *(F.when(F.col("k") == 0, F.col(c)).alias(c) for c in names[1:7]), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
        both = cells.join(rest, "word", "left")
        c, n, zero = F.coalesce("c", F.lit(0)), F.col("n"), F.lit(0)
        sums = both.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("tokens").alias("n_tokens"),
            F.sum(F.coalesce("known", zero) + F.when(c > 0, n).otherwise(0)).alias("n_known"),
            F.sum(F.coalesce("base", zero) + n * F.log10(c + 1)).alias("base"),
            F.sum(F.coalesce("score", zero) + n * F.coalesce("logp", zero)).alias("score"))
        return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(self.tokens).cast("long").alias("train_tokens"),
                           (F.col("base") - F.col("n_tokens") * unit).alias("base_score"), (F.col("score") / math.log(10)).alias("score"))
