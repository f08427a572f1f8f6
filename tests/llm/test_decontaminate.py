"""Pigeonhole matching against dynamic programming over all items and documents."""

import random

from weekloom.llm import decontaminate as d


def best_distance(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        above, row[0] = row[0], 0
        for i, p in enumerate(item, 1):
            above, row[i] = row[i], min(above + (p != c), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def edited(draw, text, n):
    letters = list(text)
    for _ in range(n):
        i = draw.randrange(len(letters))
        draw.choice([lambda: letters.__setitem__(i, "q"), lambda: letters.insert(i, "z"), lambda: letters.pop(i)])()
    return "".join(letters)


def corpus():
    draw = random.Random(12)
    syllables = ["the", "an", "ing", "er", "tion", "ou", "ha"]

    def prose(n):
        return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n))

    items = [(i, prose(draw.choice([2, 8, 25, 40]))) for i in range(12)] + [(90, None), (91, "..."), (None, prose(20)), (92, "ha")]
    docs = []
    for k in range(120):
        body = prose(draw.randint(0, 30))
        if k % 3:
            item = draw.choice([t for _, t in items if t and len(t) > 20])
            body += " " + edited(draw, item, draw.choice([0, 1, 3, 8, 14])) + " " + prose(draw.randint(0, 20))
        docs.append((k, body.upper() if k % 7 == 0 else body))
    return docs + [(None, docs[1][1]), (500, None), (501, ""), (5, docs[5][1])], items


def test_finds_exactly_the_items_within_their_budget(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(*x, "s") for x in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    want = []
    for i, text in docs:
        for j, item in items:
            m, t = d.normal(item), d.normal(text)
            if m and t and (n := best_distance(m, t)) <= int(len(m) * d.ERROR_RATE):
                want.append((i, j, n))
    for block in (d.BLOCK_CHARS, 200):
        got = d.find_leaks(frame, bench, block_chars=block).collect()
        assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, want))
    for r in got:
        text = d.normal(next(t for i, t in docs if i == r["doc_id"]))
        item = d.normal(next(t for j, t in items if j == r["item_id"]))
        assert best_distance(item, text[r["start"]:r["end"]]) == r["distance"]
    bad = {i for i, *_ in want}
    kept = d.clean(frame, bench, block_chars=200)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert d.find_leaks(docs.limit(0), bench).count() == 0 and d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == 1 and d.clean(docs, bench).count() == 0


def test_long_text_with_many_hits():
    matcher = d.Matcher(((1, "the thing that the other thing thought of " * 3),), d.ERROR_RATE)
    assert matcher.matches("the thing that the other " * 4000) == []


def test_only_two_blocks_are_held_at_a_time(spark, monkeypatch):
    alive = []
    made = d.leaks_of

    def watched(docs, items, *rest):
        alive.append((sum(len(t) for _, t in items), len(items)))
        return made(docs, items, *rest)

    monkeypatch.setattr(d, "leaks_of", watched)
    bench = spark.range(50).selectExpr("id item_id", "concat('item ', id, repeat(concat(' w', id), 300)) text")
    docs = spark.createDataFrame([(7, "item 7" + " w7" * 300, {"k": "v"}), (8, "item 8 w8", None), (None, None, None)],
                                 "doc_id long, text string, row map<string,string>")
    got = d.find_leaks(docs, bench, block_chars=1500)
    assert [tuple(r)[:3] for r in got.collect()] == [(7, 7, 0)]
    assert len(alive) >= 25 and max(size for size, _ in alive) <= 1500
    assert "MapInArrow" not in got._jdf.queryExecution().toString()  # written rows, no closures of blocks
    kept = d.clean(docs, bench, block_chars=1500)
    assert kept.schema == docs.schema and sorted(str(r["doc_id"]) for r in kept.collect()) == ["8", "None"]


def test_repeated_rows_go_alike_over_several_blocks(spark):
    bench = spark.createDataFrame([(1, "one two three four"), (2, "five six seven eight")], "item_id long, text string")
    rows = [(1, "one two three four"), (1, "one two three four"), (2, "clean"), (2, "clean"), (None, "five six seven eight")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in d.clean(docs, bench, block_chars=5).collect()) == [(2, "clean"), (2, "clean")]
