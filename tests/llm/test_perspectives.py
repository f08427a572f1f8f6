"""Perspective rotation against plain Python, and its edge cases."""

import random

import pytest

from weekloom.llm import perspectives


def parse(text):
    """(head, body) of each message of a rendered dialogue."""
    out = []
    for piece in text.split("<|end|>\n")[:-1]:
        head, _, body = piece.partition("|>\n")
        out.append((head.removeprefix("<|"), body))
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    data = []
    for conv in range(30):
        roles = draw.sample(["user", "assistant", "Ann B", "bob"], draw.randint(1, 4))
        data += [(conv, 0, "system", "rules")] * draw.randint(0, 1)
        data += [(conv, t, draw.choice(roles), f"say {t} é𝒳" * draw.randint(0, 3)) for t in range(1, draw.choice([2, 9, 200]))]
    return data


def test_every_speaker_sees_the_whole_dialogue(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, slice string, block int")
    got = perspectives.rotated(frame).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["conv_id"], r["speaker"], r["block"])):
        by.setdefault((r["conv_id"], r["speaker"]), []).append(r)
    assert set(by) == {(c, role) for c, _, role, _ in rows if role != "system"}
    for (conv, speaker), mine in by.items():
        said = [(role, text) for c, _, role, text in sorted(rows, key=lambda r: r[1]) if c == conv]
        want = [("system" if role == "system" else "assistant" if role == speaker else f"user name={role.replace(' ', '_')}", text) for role, text in said]
        assert [m for r in mine for m in parse(r["text"])] == want
        trained = [r["text"][int(a):int(b)] for r in mine if r["mask"] for a, b in (s.split(":") for s in r["mask"].split(","))]
        assert trained == [text + "<|end|>" for role, text in said if role == speaker]
        assert sum(r["n_trained"] for r in mine) == len(trained) and sum(r["n_messages"] for r in mine) == len(said)


def test_nulls_repeats_and_marks(spark):
    data = [(None, None, None, None), (1, 0, "a", "x<|end|>y"), (1, 0, "a", "x<|end|>y"), (1, None, "b|>", "late"), (1, 1, "b|>", None), (2, 0, "system", "alone")]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = perspectives.rotated(frame).orderBy("conv_id", "speaker", "block").collect()
    assert {(r["conv_id"], r["speaker"]) for r in got} == {(None, "unknown"), (1, "a"), (1, "b|>")}
    assert parse("".join(r["text"] for r in got if r["speaker"] == "a")) == [("assistant", "x< |end|>y"), ("user name=b__", ""), ("user name=b__", "late")]
    assert sum(r["n_rows"] for r in got if r["speaker"] == "a") == 4
    assert perspectives.rotated(frame.limit(0)).count() == 0


def test_a_heavy_turn_is_cut_and_nothing_is_lost(spark):
    data = [(1, 3, f"r{k % 2}", f"text {k}") for k in range(500)] + [(1, 2, "r0", "before"), (1, 4, "r1", "after")] + [(1, 3, "r0", "text 0")] * 300
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = sorted(perspectives.rotated(frame, limit=20).where("speaker = 'r0'").collect(), key=lambda r: (r["block"], r["turn"], r["slice"]))
    said = [m for r in got for m in parse(r["text"])]
    assert max(r["n_messages"] for r in got) < 60 and len(said) == 502 and said[0][1] == "before" and said[-1][1] == "after"
    assert sorted(said[1:-1]) == sorted(("assistant" if k % 2 == 0 else "user name=r1", f"text {k}") for k in range(500))
    assert sum(r["n_rows"] for r in got) == len(data)


@pytest.mark.parametrize("turns", [range(60, 70), range(1, 71), range(200)])
def test_a_dialogue_is_one_row_per_speaker_whatever_its_turn_numbers(spark, turns):
    data = [(1, t, "ab"[t % 2], f"say {t}") for t in turns]
    got = perspectives.rotated(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["speaker"], r["n_messages"], r["block"], r["turn"], r["slice"]) for r in got) == [(s, len(data), 0, None, 0) for s in "ab"]
    assert [body for _, body in parse(got[0]["text"])] == [f"say {t}" for t in turns]


def test_a_long_conversation_beside_short_ones(spark):
    data = [(c, t, "ab"[t % 2], f"say {t}") for c, n in ((1, 300), (2, 60), (None, 30)) for t in range(n)]
    got = perspectives.rotated(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), limit=64).where("speaker = 'a'").collect()
    parts = {}
    for r in sorted(got, key=lambda r: r["block"]):
        parts.setdefault(r["conv_id"], []).append(r)
    assert [len(parts[c]) for c in (1, 2, None)] == [5, 1, 1]
    assert [body for r in parts[1] for _, body in parse(r["text"])] == [f"say {t}" for t in range(300)]


@pytest.mark.parametrize("kind", ["Python", "Arrow", "Cartesian", "NestedLoop"])
def test_plan_is_native(spark, kind):
    frame = spark.createDataFrame([(1, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert kind not in perspectives.rotated(frame)._jdf.queryExecution().executedPlan().toString()
