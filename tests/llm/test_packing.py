import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.conftest import SF
from weekloom.llm import packing

SCHEMA = "doc_id long, text string, ids string, offset int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def texts():
    rng = random.Random(3)
    words = ["Hello", "don't", "it's", "naïve", "ΟΔΟΣ", "é", "́x", "<|endoftext|>", "a<|startoftext|>b", "東京", "1234", "--", " ", "\t", "\n", "x y",
             "\x1c", "\u0085", "😀", "İstanbul", "ﬁ", "…", "'S", "​", "﻿"]
    out = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(120)]
    return [*out, "", None, " ", "\n\n", "word " * 5000, "z" * 3000, "  two  spaces\r\nand a line ", "x", "x"]


def check_whole(rows, library, given, size):
    """Every id of every document lies once, in order, and sequences have no gap."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, text in enumerate(given):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in mine] == [(k, k * size) for k in range(-(-len(ids) // size))]
        assert [r.length for r in mine] == [len(ids[s:s + size]) for s in range(0, len(ids), size)]
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(np.array(ids[s:s + size], "<u4").tobytes()) for s in range(0, len(ids), size)]
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


@pytest.mark.parametrize("size,per_task", [(2048, 1 << 17), (100, 150)])
def test_ids_and_places(spark, library, size, per_task):
    given = texts()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(given)], SCHEMA).repartition(5)
    packed = packing.pack(df, size=size, pieces_per_task=per_task)
    rows = packed.places.collect()
    n = check_whole(rows, library, given, size)
    total = sum(r.length for r in rows)
    assert n <= 1.03 * total / size + 1
    # the sequences themselves
    whole = {r.doc_id: None for r in rows}
    for s in packed.sequences().collect():
        assert len(s.ids) == s.n_tokens <= size
        at = 0
        for doc, length in zip(s.doc_ids, s.lengths):
            whole[doc] = (whole[doc] or 0) + length
            assert s.ids[at:at + length]
            at += length
    assert sum(whole.values()) == total


def naive(lengths, size, most):
    """The same choice by looking at every open bin."""
    bins, closed = [], []

    def take(least_room):
        rooms = [size - sum(b) for b in bins]
        best = min((room for room in rooms if room >= least_room), default=None)
        if best is None:
            return None
        return bins.pop(max(i for i, room in enumerate(rooms) if room == best))  # the last one put there

    for n in lengths:
        best = take(n)
        if best is None:
            if len(bins) >= most:
                closed.append(take(0))
            best = []
        best = [*best, n]
        (closed if sum(best) == size else bins).append(best)
    return closed, bins


@pytest.mark.parametrize("most", [1, 3, 50])
def test_best_fit_against_scan(most):
    rng = random.Random(most)
    lengths = [rng.randint(1, 40) for _ in range(600)]
    got = list(packing.best_fit([(i, n) for i, n in enumerate(lengths)], 40, most, window=1))
    sizes = lambda bins: sorted(tuple(n for _, n in b) for b in bins)
    closed, open_ = naive(lengths, 40, most)
    assert [tuple(n for _, n in b) for b, left in got if not left] == [tuple(b) for b in closed]
    assert sizes(b for b, left in got if left) == sorted(map(tuple, open_))


def test_few_sequences():
    rng = random.Random(9)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(30_000)]
    bins = sum(1 for _ in packing.best_fit(enumerate(lengths)))
    assert bins <= 1.001 * sum(lengths) / 2048 + 1


def lists(coder, given):
    ids, lengths = coder.encode(pa.array(given, pa.string()), 7)
    return [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]


@pytest.mark.parametrize("word_wise", [True, False])
def test_words_give_the_librarys_ids(library, word_wise):
    given = [t or "" for t in texts()]
    coder = packing.Encoder(packing.tokenizer_path(), word_wise)
    assert lists(coder, given) == [library.encode(t, add_special_tokens=False).ids + [7] for t in given]


def test_real_texts(library):
    given = [t or "" for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()]
    assert lists(packing.Encoder(packing.tokenizer_path()), given) == [library.encode(t, add_special_tokens=False).ids + [7] for t in given]


def test_forgotten_words(monkeypatch, library):
    monkeypatch.setattr(packing, "WORDS_KEPT", 10)
    monkeypatch.setattr(packing, "JOINED", 3)
    coder = packing.Encoder(packing.tokenizer_path())
    for part in (["a b c d e f, g!?", "g h i"], ["a z y x w wörd.", "b q"], ["a b"], ["", "z" * 500 + " ßÿ; x,y 0 a'll"]):
        assert lists(coder, part) == [library.encode(t, add_special_tokens=False).ids + [7] for t in part]
    assert len(coder.slot) <= 20


def test_slices_hold_whole_rows():
    batch = pa.record_batch([pa.array(range(6)), pa.array(["a" * 9, None, "b" * 30, "", "c", "d" * 10])], names=["doc_id", "text"])
    parts = list(packing.slices(batch, 10))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert [p.num_rows for p in parts] == [2, 1, 2, 1]


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, "a", 1), (None, "hi", "a", 1), (3, "hi", "a", 1), (3, "hi", "a", 1)], SCHEMA)
    rows = packing.pack(df).places.collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 2), (False, 2), (True, 1), (True, 2)]
    assert len({r.sequence_id for r in rows}) == 1
    assert packing.pack(df.where("false")).places.collect() == []
