"""Quality figures against plain counting; the cascade's order changes nothing but its cost."""

import random
import re
from collections import Counter

from weekloom.llm import quality as q
from weekloom.llm.common import table
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def texts():
    draw = random.Random(4)
    pieces = ["a", "b", " ", " ", "\n", "\u2028x", "é", "#", "a b c d e f g h", "\x1c", "\t", "w" * 9, " same line \n", "!"]
    out = ["".join(draw.choices(pieces, k=draw.randint(0, 120))) for _ in range(300)]
    return out + [None, "", "\n" * 50, "x" * 100_000, "a b c d e f g h " * 3000, " ".join(str(i % 50) for i in range(3000))]


def test_figures(spark):
    given = texts()
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(given)], "doc_id long, text string, kept string")
    got = {r[0]: tuple(r)[1:7] for r in q.QualityCascade().judge(frame).collect()}
    assert got == {i: brute(t) for i, t in enumerate(given)}


def test_every_order_gives_the_same_verdicts(spark):
    docs = table(spark, SF, "documents")
    results = []
    for order in (list(range(len(q.RULES))), list(range(len(q.RULES)))[::-1], q.QualityCascade().fit(docs).order):
        cascade = q.QualityCascade()
        cascade.order = order
        results.append(sorted((r["doc_id"], r["kept"]) for r in cascade.judge(docs).collect()))
    assert results[0] == results[1] == results[2]
    kept = sorted(r["doc_id"] for r in q.QualityCascade().fit(docs).keep(docs).collect())
    assert kept == [i for i, ok in results[0] if ok]


def test_order_is_rejections_per_cost(spark):
    slow = q.Rule("slow", lambda t: sum(range(20_000)) < 0)
    never = q.Rule("never", lambda t: False)
    often = q.Rule("often", lambda t: len(t.text) % 2 == 0)
    frame = spark.createDataFrame([(i, "x" * i) for i in range(200)], "doc_id long, text string")
    assert q.QualityCascade((slow, never, often)).fit(frame).order == [2, 1, 0]


def test_nulls_repeats_and_no_rows(spark):
    frame = spark.createDataFrame([(None, None), (1, "word " * 30), (1, "word " * 30)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"]) for r in q.QualityCascade().fit(frame).judge(frame).collect())
    assert got == [(0, 0, True), (1, 30, True), (1, 30, True)]
    empty = frame.limit(0)
    assert q.QualityCascade().fit(empty).judge(empty).count() == 0 and q.QualityCascade().keep(empty).count() == 0


def test_base_rule_takes_its_place_by_rejections_per_cost(spark):
    slow = q.Rule("slow", lambda t: sum(range(50_000)) >= 0 and t.text.startswith("a"))
    frame = spark.createDataFrame([(i, "a b" if i % 2 else "word " * 30) for i in range(200)], "doc_id long, text string")
    fitted = q.QualityCascade((slow,)).fit(frame)
    assert fitted.turns == [0, 1]  # both reject the same texts, the base rule for less
    long = spark.createDataFrame([(i, " ".join(f"a{k % 90}" for k in range(3000))) for i in range(50)], "doc_id long, text string")
    cheap = q.Rule("cheap", lambda t: t.text.startswith("a"))
    fitted = q.QualityCascade((cheap,)).fit(long)
    assert fitted.turns == [1, 0] and fitted.keep(long).count() == 0


def test_rules_are_judged_on_what_the_ones_before_leave():
    found = q.Measures(masks={0b011: 50, 0b100: 10, 0: 40}, own={0: 100, 1: 110, 2: 200}, figures={"words": 500}, needs={1: {"words"}})
    # rule 1 rejects 50 texts too, but none that rule 0 leaves
    assert found.order([0, 1, 2]) == [0, 2, 1]
    shared = q.Measures(masks={0b01: 30, 0b10: 30, 0b100: 20}, own={0: 10, 1: 10, 2: 300}, figures={"words": 500}, needs={0: {"words"}, 1: {"words"}})
    assert shared.order([0, 1, 2]) == [2, 0, 1]  # the first rule to need the words pays for them


def test_shared_figures_are_timed_by_themselves():
    t = q.Timed("word " * 5000)
    assert t.n_words == 5000 and t.n_repeat_words == 5000
    assert set(t.spent) == {"words", "n_repeat_words"} and t.asked == {"words", "n_repeat_words"}
    assert all(v > 0 for v in t.spent.values()) and t.inner >= sum(t.spent.values())
