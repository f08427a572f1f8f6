"""Benchmark decontamination by pigeonhole edit matching.

Documents and test items are normalised alike (lower case, words joined by single spaces, a space at both ends). An item of ``m``
characters may occur with ``k = floor(m * error_rate)`` edits. It is cut into ``k + 1`` pieces: whatever the edits, one piece stays
whole, so an exact search for all pieces of all items (one Aho-Corasick pass over the whole document) meets every occurrence. The
surroundings of each hit are verified with Myers' bit-parallel edit distance.

The item set is read in blocks of at most ``BLOCK_CHARS`` characters, each block one pass over the documents. A benchmark of one
block gives a plain plan. With more, each block is a job of its own whose rows are written to the shared folder before the next
block is read, so driver, plan and tasks hold two blocks at most, whatever the size of the benchmark.

Null, empty and wordless items match nothing; neither do null and empty documents. Short items (``k`` = 0) must occur exactly, at
word boundaries. Of an item's places in a document the one with the least distance is given, of equally near ones the first. Very
long documents take time in proportion to their length and hits. Repeated documents and items each give their own rows. Only ``doc_id`` and ``text`` (``item_id`` and ``text``) are
read; null ids stay null.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.common import map_slices, shared_folder, written

ERROR_RATE = 0.08
BLOCK_CHARS = 4_000_000
LEAKS = "doc_id long, item_id long, distance int, start long, end long"
WORD = re.compile(r"\w+")

Items = tuple[tuple[int | None, str], ...]


def normal(text: str | None) -> str:
    words = " ".join(WORD.findall((text or "").lower()))
    return f" {words} " if words else ""


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their offsets."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def bit_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def closest(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any part of ``text``, end of the first such part), after Myers."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        across = equal | minus
        down = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(down | plus))
        low = plus & down
        if up & high:
            score += 1
        elif low & high:
            score -= 1
            if score < best:
                best, end = score, j
        up, low = up << 1 & full, low << 1 & full
        plus, minus = low | (full & ~(across | up)), up & across
    return best, end


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: Items, error_rate: float):
        import ahocorasick

        self.items, self.budgets = [], []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normal(text)
            if not item:
                continue
            k = int(len(item) * error_rate)
            for offset, piece in pieces(item, k):
                places.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, item))
            self.budgets.append(k)
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()
        self.masks = lru_cache(maxsize=4096)(lambda n: (bit_masks(self.items[n][1]), bit_masks(self.items[n][1][::-1])))
        self.verify = lru_cache(maxsize=4096)(self._verify)  # shared passages meet the same windows again and again

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item's place, start, end) of the parts of a normalised text to verify; parts of one item that overlap are one."""
        found: dict[int, list[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                found.setdefault(n, []).append(last + 1 - size - offset)
        for n, diagonals in found.items():
            k, m = self.budgets[n], len(self.items[n][1])
            start = end = None
            for d in sorted(diagonals):
                a, b = max(d - k, 0), min(d + m + k, len(text))
                if end is not None and a <= end:
                    end = max(end, b)
                    continue
                if end is not None:
                    yield n, start, end
                start, end = a, b
            yield n, start, end

    def _verify(self, n: int, window: str) -> tuple[int, int, int] | None:
        item = self.items[n][1]
        at = window.find(item)
        if at >= 0:
            return 0, at, at + len(item)
        forward, backward = self.masks(n)
        distance, end = closest(forward, len(item), window)
        if distance > self.budgets[n]:
            return None
        _, size = closest(backward, len(item), window[:end][::-1])
        return distance, end - size, end

    def matches(self, raw: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of the best place of each item in a text; positions in the normalised text."""
        text = normal(raw)
        best: dict[int, tuple[int, int, int]] = {}
        if text and self.items:
            for n, start, end in self.windows(text):
                got = self.verify(n, text[start:end])
                if got:
                    place = (got[0], start + got[1], start + got[2])
                    best[n] = min(best.get(n, place), place)
        return [(self.items[n][0], *place) for n, place in sorted(best.items())]


@lru_cache(maxsize=2)
def matcher_of(items: Items, error_rate: float) -> Matcher:
    return Matcher(items, error_rate)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items in blocks of bounded length, as they are stored; an item longer than a block is its own block."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    block, size = [], 0
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_chars:
            yield tuple(block)
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield tuple(block)


def one_or_more(given: Iterator[Items]) -> tuple[Items | None, Iterator[Items] | None]:
    """(the only block, None), or (None, all blocks) where there are several; (None, None) without any."""
    first = next(given, None)
    second = next(given, None)
    return (first, None) if second is None else (None, chain((first, second), given))


def leaks_of(docs: DataFrame, items: Items, error_rate: float, key: str) -> DataFrame:
    """The leaks of one block; ``key`` names the column of ``docs`` that tells its rows, handed on as ``doc_id``."""
    whole = docs.select(F.col(f"`{key}`").cast("long"), F.col("text").cast("string"))

    def work(ids, texts):
        matcher = matcher_of(items, error_rate)
        rows = [(i, *m) for i, t in zip(ids, texts) for m in matcher.matches(t)]
        return [list(c) for c in zip(*rows)] if rows else [[]] * 5

    return map_slices(whole, LEAKS, work)


def collected(parts: Iterator[DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """The rows of all parts, each part written by a job of its own before the next one is made."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = None
    for part in parts:
        part.write.mode("append").parquet(path)
        schema = part.schema
    return spark.read.schema(schema).parquet(path)


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per (document, item found in it): ``doc_id, item_id, distance, start, end``."""
    only, several = one_or_more(blocks(benchmark, block_chars))
    if several is not None:
        return collected((leaks_of(docs, items, error_rate, "doc_id") for items in several), docs.sparkSession, "leaks")
    return leaks_of(docs, only or (), error_rate, "doc_id")


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without any test item, all columns unchanged.

    With several blocks the documents are written once with a row number, every block adds the numbers of the rows it is found in,
    and those rows are left out in the end.
    """
    only, several = one_or_more(blocks(benchmark, block_chars))
    if several is not None:
        row = "row"
        while row.lower() in (c.lower() for c in docs.columns):
            row += "_"
        numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "clean-rows")
        found = (leaks_of(numbered, items, error_rate, row).select(F.col("doc_id").alias(row)).distinct() for items in several)
        bad = collected(found, docs.sparkSession, "clean-found").distinct()
        return numbered.join(bad, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    if only is None:
        return docs
    items, at = only, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        matcher = matcher_of(items, error_rate)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ok = [not matcher.matches(t) for t in part.column(at).to_pylist()]
                if any(ok):
                    yield part.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)
