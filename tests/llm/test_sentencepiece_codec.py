"""The rebuilt tokenizer against the SentencePiece library."""

import random

import pytest

from weekloom.llm import sentencepiece_codec as codec

PIECES = ["a", "the", " ", "  ", "\n", "▁", "é", "😀", "\t", "<s>", "<0x0A>", "#", "123", "\r", " ", "中文", "\u0000", "Zürich"]


@pytest.fixture(scope="module")
def built():
    return codec.Codec(codec.load())


def texts():
    draw = random.Random(3)
    return ["".join(draw.choices(PIECES, k=draw.randint(0, 15))) for _ in range(2000)] + ["", " ", "x" * 30_000, "ab " * 30_000]


def test_ids_and_round_trip(built):
    given = texts()
    ids = built.encode(given)
    assert ids == built.original.encode(given)
    assert built.decode(ids) == [t.replace("▁", " ") for t in given]


def test_model_fields(built):
    m, sp = built.model, built.original
    assert len(m.pieces) == sp.get_piece_size() and m.kind == codec.BPE and m.byte_fallback
    assert all(m.pieces[i][0] == sp.id_to_piece(i) for i in range(0, len(m.pieces), 97))
    assert m.pieces[300][1] == sp.get_score(300)


def test_unigram_model_keeps_its_scores():
    """A hand-made Unigram protobuf: the best path wins, unknown characters fall back to bytes."""
    import struct

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def entry(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind=1):
        return entry(1, entry(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind]))

    pieces = piece("<unk>", 0, 2) + b"".join(piece(f"<0x{b:02X}>", -9, 6) for b in range(256))
    pieces += piece("▁", -3) + piece("▁a", -2) + piece("b", -2.5) + piece("▁ab", -4.0) + piece("a", -3)
    data = pieces + entry(2, b"\x18\x01" + varint(35 << 3) + b"\x01") + entry(3, b"\x18\x01\x20\x00\x28\x01")
    built = codec.Codec(data)
    given = ["ab", "aab", "ab ab", "é", "", "b"]
    assert built.encode(given) == built.original.encode(given)
    assert [built.model.pieces[i][0] for i in built.encode(["ab"])[0]] == ["▁ab"]


def test_documents(spark):
    rows = [(1, "one two", 5), (None, None, 6), (3, "", 7), (3, "", 7), (4, "▁x\u0000", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = codec.encode_documents(docs)
    out = sorted((r["doc_id"] or 0, r["n_tokens"], r["parity"], r["round_trip"]) for r in got.collect())
    assert [o[:2] for o in out[:1]] == [(0, 0)] and all(o[2] and o[3] for o in out) and len(out) == 5
    back = {r["doc_id"]: r["text"] for r in codec.decode_documents(got).collect()}
    assert back[1] == "one two" and back[4] == " x\u0000" and back[None] == ""
    assert codec.encode_documents(docs.limit(0)).count() == 0


def test_round_trip_is_decoded():
    """A wrong decoder shows in both checks, on the texts it gets wrong."""
    from tokenizers import decoders

    built = codec.Codec(codec.load())
    given = ["one two", "", "é\u0000 x", "  a"]
    assert [c[1:] for c in built.encode_checked(given)] == [(True, True)] * 4
    built.whole.decoder = decoders.Sequence([decoders.Replace("▁", " "), decoders.ByteFallback(), decoders.Fuse()])
    assert [c[1:] for c in built.encode_checked(given)] == [(False, False), (True, True), (False, False), (False, False)]


def test_round_trip_compares_with_the_given_text():
    """The same model, told to squeeze spaces: the ids agree, but two spaces do not come back."""
    built = codec.Codec(codec.load() + b"\x1a\x02\x20\x01")
    assert built.model.squeeze
    assert [c[1:] for c in built.encode_checked(["a b", "a  b", " a"])] == [(True, True), (True, False), (True, False)]


def test_long_texts_are_cut_between_words(built):
    """The ids of the parts are those of the whole text, whatever stands at the cut; no merge has to hold a whole text."""
    draw = random.Random(5)
    given = ["".join(draw.choices(PIECES, k=3000)) for _ in range(40)] + ["", " ", "▁" * 3000, "x" * 3000, "a" + " " * 3000 + "b", ("b" * 999 + " ") * 4]
    assert [len(p) for p in codec.pieces_of(("b" * 999 + "▁") * 3)] == [1999, 1001]
    assert all("".join(codec.pieces_of(built.normal(t))) == built.whole.normalizer.normalize_str(t) for t in given)
    assert all(p.startswith("▁") for t in given for p in codec.pieces_of(built.normal(t))[1:])
    assert built.encode(given) == [e.ids for e in built.whole.encode_batch_fast(given, add_special_tokens=False)]


def test_a_marker_inside_a_piece_forbids_cuts():
    model = codec.parse(codec.load())
    assert codec.by_word(model)
    model.pieces.append(("a▁b", -1.0, codec.NORMAL))
    assert not codec.by_word(model)


def test_marker_decoding_by_character(built):
    """Any ids decode as with a replacement in each piece, also single bytes of a marker."""
    from tokenizers import decoders

    draw, other = random.Random(7), codec.Codec(codec.load())
    other.whole.decoder = decoders.Sequence([decoders.Replace("▁", " "), decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", 1, 0)])
    marker = [built.model.pieces.index((f"<0x{b:02X}>", 0.0, codec.BYTE)) for b in "▁".encode()]
    given = [[draw.randrange(32000 if k % 2 else 300) for _ in range(30)] for k in range(500)] + [marker, [*marker, 5], []]
    assert built.decode(given) == other.decode(given)
