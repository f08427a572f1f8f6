"""Quality rules as a short-circuit cascade.

Every rule sees a whole text. A sample of bounded size shows which rules reject a text and what the rules and the figures they
share cost. The order is built step by step: next comes the rule with the most rejections per cost among the texts that the rules
before it leave, figures already at hand being free. Rules run in that order and stop at the first one that rejects. The verdict is
a conjunction, so the order changes the cost only, never the result.

Null and empty texts have no words: all counts are 0, the base rule (fewer than 20 words) rejects them. Repeated rows are judged
one by one and give equal rows. An empty table gives an empty result; the order is then the order of declaration. Only ``doc_id``
and ``text`` are read, so extra columns of any name do no harm; a null ``doc_id`` is kept as null.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_slices

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
SAMPLE_ROWS = 2000  # expected size of the sample that costs and selectivities are measured on

SYMBOLS = re.compile(r"[#*$%&|<>]")
LETTERS = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
SPACES = " \t\n\r\v\f"


@dataclass
class Text:
    """One text with the figures the rules share, each computed at first use."""

    text: str
    known: dict = field(default_factory=dict)

    def once(self, name: str, make: Callable[[], object]):
        if name not in self.known:
            self.known[name] = make()
        return self.known[name]

    @property
    def words(self) -> list[bytes]:
        # splitting bytes separates at 0x20 and 0x09-0x0D only, unlike str.split
        return self.once("words", lambda: self.text.encode().split())

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return self.once("word_chars", lambda: len(self.text) - sum(self.text.count(c) for c in SPACES))

    @property
    def n_symbols(self) -> int:
        return self.once("n_symbols", lambda: sum(self.text.count(c) for c in "#*$%&|<>"))

    @property
    def lines(self) -> list[str]:
        return self.once("lines", lambda: [x for x in self.text.split("\n") if x.strip(SPACES)])

    @property
    def n_dup_lines(self) -> int:
        return self.once("n_dup_lines", lambda: len(self.lines) - len(set(self.lines)))

    @property
    def n_letters(self) -> int:
        return self.once("n_letters", lambda: sum(map(len, LETTERS.findall(self.text))))

    @property
    def n_capitals(self) -> int:
        return self.once("n_capitals", lambda: sum(map(len, CAPITALS.findall(self.text))))

    @property
    def n_repeat_words(self) -> int:
        return self.once("n_repeat_words", lambda: repeated_words(self.words))


@dataclass
class Timed(Text):
    """A text that notes what each shared figure took by itself and which figures were asked for."""

    spent: dict[str, int] = field(default_factory=dict)
    asked: set[str] = field(default_factory=set)
    inner: int = 0  # time of figures made within the current one

    def once(self, name: str, make: Callable[[], object]):
        self.asked.add(name)
        if name not in self.known:
            outer, self.inner = self.inner, 0
            start = time.perf_counter_ns()
            self.known[name] = make()
            took = time.perf_counter_ns() - start
            self.spent[name] = took - self.inner
            self.inner = outer + took
        return self.known[name]


_MIX = np.random.default_rng(20240229).integers(1, 2**63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 8-word windows that occur at least twice, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.uint64, len(words))
    if len(codes) == len(words):
        return 0
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        hashes += ids[k:k + n] * _MIX[k]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that must go."""

    name: str
    rejects: Callable[[Text], bool]


# thresholds leave ordinary prose of any of the languages far inside the kept side
RULES = (
    Rule("symbols", lambda t: 5 * t.n_symbols > t.n_words),
    Rule("shouting", lambda t: t.n_letters >= 40 and 2 * t.n_capitals > t.n_letters),
    Rule("exclamation", lambda t: 4 * t.text.count("!") > t.n_words),
    Rule("few_letters", lambda t: 2 * t.n_letters < t.word_chars),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 25 * t.n_words),
    Rule("repeated_lines", lambda t: len(t.lines) >= 4 and 2 * t.n_dup_lines > len(t.lines)),
)


def base_failed(t: Text) -> bool:
    return t.n_words < MIN_WORDS or 100 * t.n_repeat_words > MAX_REPEAT_PCT * t.n_words


BASE = (Rule("base", base_failed),)


@dataclass(frozen=True)
class Measures:
    """What the sample showed, in sums over its texts.

    ``masks``: texts by the set of rules (as bits) that reject them; ``own``: time of each rule without shared figures;
    ``figures``: time of each shared figure; ``needs``: the figures a rule asks for.
    """

    masks: dict[int, int]
    own: dict[int, int]
    figures: dict[str, int]
    needs: dict[int, set[str]]

    def order(self, rules: list[int]) -> list[int]:
        """The rules by rejections per cost, each given those before it; rules that reject nothing more come last, cheapest first."""
        left, alive, ready, out = list(rules), dict(self.masks), set(), []
        while left:
            def gain(i: int) -> tuple[float, float, int]:
                cost = self.own.get(i, 0) + sum(self.figures.get(f, 0) for f in self.needs.get(i, set()) - ready)
                return (-sum(n for mask, n in alive.items() if mask >> i & 1) / max(cost, 1), cost, i)

            best = min(left, key=gain)
            left.remove(best)
            out.append(best)
            ready |= self.needs.get(best, set())
            alive = {mask: n for mask, n in alive.items() if not mask >> best & 1}
        return out


class QualityCascade:
    """A set of rules with the orders in which they run.

    ``order`` holds the given rules alone, for ``judge``, which needs the base figures of every text anyway; ``turns`` holds the base
    rule (0) and the given ones (from 1), for ``keep``. ``sample_rows`` bounds the expected number of sampled texts; it is a
    documented parameter of the fit and does not influence which documents are kept.
    """

    def __init__(self, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS):
        self.rules, self.sample_rows = rules, sample_rows
        self.order: list[int] = list(range(len(rules)))
        self.turns: list[int] = [i + 1 for i in self.order] + [0]

    def measure(self, docs: DataFrame) -> Measures:
        """Costs and rejections of the base rule (0) and the given rules (from 1) over the sample."""
        rows = docs.count()
        share = min(1.0, self.sample_rows / max(rows, 1))
        sample = docs.select("text").sample(fraction=share, seed=7)
        rules = BASE + self.rules

        def work(texts):
            sums: dict[tuple[str, str], int] = {}

            def add(kind: str, name, n: int) -> None:
                sums[kind, str(name)] = sums.get((kind, str(name)), 0) + n

            for text in texts:
                mask, figures = 0, {}
                for i, rule in enumerate(rules):
                    fresh = Timed(text or "")  # no figure is left over from the rule before
                    start = time.perf_counter_ns()
                    mask |= bool(rule.rejects(fresh)) << i
                    add("own", i, time.perf_counter_ns() - start - fresh.inner)
                    figures |= fresh.spent
                    for name in fresh.asked:
                        add("need", f"{i} {name}", 1)
                for name, took in figures.items():  # once a text, however many rules ask for it
                    add("figure", name, took)
                add("mask", mask, 1)
            return [[k for k, _ in sums], [n for _, n in sums], list(sums.values())]

        parts = map_slices(sample, "kind string, name string, n long", work)
        found = parts.groupBy("kind", "name").agg(F.sum("n").alias("n")).collect()  # bounded by rules, figures and sampled texts
        of = {kind: {r["name"]: r["n"] for r in found if r["kind"] == kind} for kind in ("own", "need", "figure", "mask")}
        needs: dict[int, set[str]] = {}
        for name in of["need"]:
            i, figure = name.split(" ", 1)
            needs.setdefault(int(i), set()).add(figure)
        return Measures({int(k): n for k, n in of["mask"].items()}, {int(k): n for k, n in of["own"].items()}, of["figure"], needs)

    def fit(self, docs: DataFrame) -> QualityCascade:
        """Order the rules by rejections per cost."""
        found = self.measure(docs)
        self.order = [i - 1 for i in found.order(list(range(1, len(self.rules) + 1)))]
        self.turns = found.order(list(range(len(self.rules) + 1)))
        return self

    def first_rejection(self, t: Text) -> str | None:
        for i in self.order:
            if self.rules[i].rejects(t):
                return self.rules[i].name
        return None

    def judge(self, docs: DataFrame) -> DataFrame:
        """One row per document: the figures, ``base_failed`` and ``kept``."""
        cascade = self

        def work(ids, texts):
            out = [[] for _ in range(8)]
            for doc_id, text in zip(ids, texts):
                t = Text(text or "")
                failed = base_failed(t)
                row = (doc_id, t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed,
                       not failed and cascade.first_rejection(t) is None)
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), (
            "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean"), work)

    def keep(self, docs: DataFrame) -> DataFrame:
        """The documents no rule rejects, all their columns unchanged; the base rule has its place among the others."""
        full = QualityCascade(BASE + self.rules, self.sample_rows)
        full.order = self.turns
        names = docs.columns
        at = names.index("text")

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    ok = [full.first_rejection(Text(x or "")) is None for x in part.column(at).to_pylist()]
                    if any(ok):
                        yield part.filter(pa.array(ok))

        return docs.mapInArrow(run, docs.schema)
