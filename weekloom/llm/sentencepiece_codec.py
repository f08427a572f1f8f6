"""SentencePiece encoding and decoding on the ``tokenizers`` backend.

The model protobuf is read field by field, and the pieces, scores, normaliser, metaspace marker and byte fallback are rebuilt as a
``tokenizers`` pipeline: a Unigram model keeps its scores, a BPE model gets its merges from the scores of the merged pieces. Where no
piece has a marker after another character, no merge reaches over the start of a word, so a long text is cut there and its parts are merged by
themselves. Batches are encoded and decoded by the library's threads. Parity with the SentencePiece library is verified for every text: it must give the same
ids, and the same text for them. The round trip is verified too: what the rebuilt decoder makes of the ids must be the given text, so it
is false where a model's normaliser (character map, squeezed spaces) loses something.

Null and empty texts have no tokens and count as equal. A literal marker (U+2581) in a text reads as a space after decoding, which is
what the round trip compares with. Repeated rows give equal rows; a null ``doc_id`` stays null. Of the input only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BATCH = 64  # texts encoded together; the ids of both libraries lie in memory as Python lists
MAX_MODEL_BYTES = 64 << 20  # the model travels to every task
PART = 1000  # characters after which a text may be cut at the start of a word
WORD_END = re.compile(f"[^{MARK}](?={MARK})")

# fixed values: piece types and model types of the protobuf
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message; 32- and 64-bit values come as raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at:at + size]
        at += size


def pieces_of(text: str, size: int = PART) -> list[str]:
    """A normalised text cut at the first start of a word after every ``size`` characters."""
    out, start = [], 0
    while end := WORD_END.search(text, start + size):
        out.append(text[start:end.end()])
        start = end.end()
    return [*out, text[start:]]


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True  # remove_extra_whitespaces
    escape: bool = True


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.squeeze = bool(v)
                elif n == 5:
                    model.escape = bool(v)
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs that may merge, the best merged piece first; a pair's rank follows from the score of what it makes."""
    ids = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    ranked = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL or kind == USER_DEFINED:
            cuts = ((piece[:k], piece[k:]) for k in range(1, len(piece)))
            ranked += [(-score, ids[a], ids[b], a, b) for a, b in cuts if a in ids and b in ids]
    return [(a, b) for *_, a, b in sorted(ranked)]


def by_word(model: Model) -> bool:
    """Whether the ids of a text are those of its words in turn: a marker only leads a piece, and no character is unknown."""
    whole_bytes = model.byte_fallback and {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _, kind in model.pieces if kind == BYTE}
    return model.kind == BPE and model.escape and whole_bytes and not any(MARK in p.lstrip(MARK) for p, *_ in model.pieces)


class Codec:
    """Encoder and decoder rebuilt from a SentencePiece model."""

    def __init__(self, data: bytes):
        import sentencepiece
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        self.model = m = parse(data)
        unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), 0)

        def backend() -> Tokenizer:
            if m.kind == UNIGRAM:
                return Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], unknown, m.byte_fallback))
            if m.kind == BPE:
                vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
                return Tokenizer(models.BPE(vocab, merges(m), unk_token=m.pieces[unknown][0], byte_fallback=m.byte_fallback, fuse_unk=True))
            raise ValueError(f"model type {m.kind} is neither Unigram nor BPE")

        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.squeeze:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if m.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if m.escape else " "))
        if m.escape:
            steps.append(normalizers.Replace(" ", MARK))
        self.whole = backend()
        self.whole.normalizer = normalizers.Sequence(steps)
        self.parts = backend() if by_word(m) else None
        back = [decoders.Metaspace(MARK, "never", False)] * m.escape + [decoders.ByteFallback(), decoders.Fuse()]
        self.whole.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * m.dummy_prefix)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of whole texts by the rebuilt pipeline."""
        if self.parts is None:
            return [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        cut = [pieces_of(self.normal(t)) for t in texts]
        found = iter(self.parts.encode_batch_fast([p for parts in cut for p in parts], add_special_tokens=False))
        return [list(chain.from_iterable(next(found).ids for _ in parts)) for parts in cut]

    def normal(self, text: str) -> str:
        """The text as the pipeline's normaliser leaves it; marks for spaces need no normaliser."""
        if self.model.charsmap or self.model.squeeze:
            return self.whole.normalizer.normalize_str(text)
        return MARK * (self.model.dummy_prefix and text != "") + text.replace(" ", MARK)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)

    def encode_checked(self, texts: list[str]) -> list[tuple[list[int], bool, bool]]:
        """Token ids of whole texts; whether the SentencePiece library gives the same ids and text; whether they decode to the given text."""
        mine = self.encode(texts)
        theirs = self.original.encode(texts, num_threads=1)
        back = self.decode(mine)
        their_back = self.original.decode(mine, num_threads=1)
        given = [t.replace(MARK, " ") for t in texts] if self.model.escape else texts
        return [(a, a == b and c == d, c == t) for a, b, c, d, t in zip(mine, theirs, back, their_back, given)]


@lru_cache(maxsize=2)
def codec_of(data: bytes) -> Codec:
    return Codec(data)


def load(path: str = MODEL) -> bytes:
    """The model's bytes, read on the driver and carried to the tasks; the size is checked."""
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return data


def encode_documents(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """One row per document: token ids of the whole text, their number, parity and round trip."""
    data = load() if model is None else model

    def work(ids, texts):
        import pyarrow as pa

        tokens, same, back = zip(*codec_of(data).encode_checked([t or "" for t in texts]))
        sizes = [len(t) for t in tokens]
        flat = array("i", [])
        for t in tokens:
            flat.extend(t)
        lists = pa.ListArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
        return [ids, sizes, lists, list(same), list(back)]

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                      "doc_id long, n_tokens long, ids array<int>, parity boolean, round_trip boolean", work, rows=BATCH)


def decode_documents(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of encoded documents; null ids give an empty text."""
    data = load() if model is None else model
    return map_slices(encoded.select("doc_id", "ids"), "doc_id long, text string",
                      lambda ids, tokens: [ids, codec_of(data).decode([t or [] for t in tokens])])
