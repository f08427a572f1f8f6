"""Packing of token sequences by bounded-space online best-fit.

Documents become token ids, an end id after each; documents longer than a sequence are cut into full pieces and a rest. Each task reads a
bounded number of pieces and keeps a fixed number of open bins in a bitset keyed by free space: a piece goes to the open bin with the
least room that still holds it (one shift and one lowest-bit look-up), and where none does and all bins are open, the fullest closes
first. Pieces come in windows, the longest of a window first, so that short ones are left to fill gaps. What lies in bins still open at
the end of a task is packed again in the next round, by as many fewer tasks as there are fewer pieces, until one task is left.

Ids are those of the ``tokenizers`` library for the whole text. As the tokenizer drops white space and no token crosses it, texts are
put together from the ids of their words, and the library encodes each different word once per task, new ones many at a time
(``word_wise=False`` encodes whole texts, for tokenizers that keep spaces). Null and empty texts are the end id alone. Repeated rows are packed as often as they come, equal
lengths in the order read; a null ``doc_id`` stays null. Very long texts are read whole and cut only into pieces. An empty table gives no
rows. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import written

SIZE = 2048  # tokens of a sequence
END_ID = 0
OPEN_BINS = 4096
WINDOW = 16384  # pieces sorted together
PIECES_PER_TASK = 1 << 17
WORDS_KEPT, IDS_KEPT = 1 << 20, 1 << 24  # a task forgets the ids of words beyond so many words or ids
JOINED = 2000  # new words encoded as one text
SLICE_BYTES = 4 << 20  # text worked on at a time, or one document
# words of one unit, and of two, whatever stands beside them: letters that are one character in any case, and stops behind them
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
STOPPED = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]+$"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, key long, sequence_id long, offset long, open boolean"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, one after the other."""

    def __init__(self, path: str, word_wise: bool = True):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.word_wise = word_wise
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.ends = np.zeros(1 + max(self.library.get_vocab().values()), bool)
        if suffix:
            self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(1 << 16, "<u4"), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and each text's number of ids."""
        each = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each))

    def encode_joined(self, words: list[str], parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Likewise for words that are known to fall into ``parts`` units each: encoded as running text, cut at the units' last tokens."""
        ids, _ = self.encode_each([" ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)])
        cuts = np.flatnonzero(self.ends[ids])[parts - 1::parts] + 1
        if len(cuts) != len(words) or len(cuts) and cuts[-1] != len(ids):
            return self.encode_each(words)
        return ids, np.diff(cuts, prepend=0)

    def learn(self, words) -> None:
        """Keep the ids of new words, an Arrow array."""
        import pyarrow.compute as pc

        joined = bool(self.ends.any())
        plain = pc.and_(pc.match_substring_regex(words, PLAIN), joined)
        stopped = pc.and_(pc.match_substring_regex(words, STOPPED), joined)
        kinds = [words.filter(mask).to_pylist() for mask in (pc.invert(pc.or_(plain, stopped)), plain, stopped)]
        found = [self.encode_each(kinds[0]), self.encode_joined(kinds[1], 1), self.encode_joined(kinds[2], 2)]
        first, count = len(self.slot), len(words)
        self.slot.update(zip(chain.from_iterable(kinds), range(first, first + count)))
        sizes = np.concatenate([s for _, s in found])
        total = int(sizes.sum())
        self.flat = grown(self.flat, self.used, total)
        self.start, self.length = grown(self.start, first, count), grown(self.length, first, count)
        self.flat[self.used:self.used + total] = np.concatenate([i for i, _ in found])
        self.length[first:first + count] = sizes
        self.start[first:first + count] = self.used + np.cumsum(sizes) - sizes
        self.used += total

    def encode(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` (an Arrow array without nulls), an end id after each, and each text's number of ids."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.word_wise:
            ids, lengths = self.encode_each(texts.to_pylist())
            return np.insert(ids, np.cumsum(lengths), end_id), lengths + 1
        # only blanks and line ends are cut at: all tokenizers of this kind take them as white space
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_pylist()
        if len(self.slot) > WORDS_KEPT or self.used > IDS_KEPT:
            self.forget()
        slot = np.fromiter(map(self.slot.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(slot < 0)
        if len(new):
            self.learn(coded.dictionary.take(pa.array(new)))
            slot[new] = np.fromiter((self.slot[different[i]] for i in new.tolist()), np.int64, len(new))
        slots = slot[coded.indices.to_numpy()]
        ends = np.cumsum(words.value_lengths().to_numpy())
        sizes = np.insert(self.length[slots], ends, 1)
        starts = np.insert(self.start[slots], ends, 0)
        after = np.cumsum(sizes)
        ids = self.flat[np.repeat(starts - after + sizes, sizes) + np.arange(after[-1])]
        last = after[ends + np.arange(len(ends))]
        ids[last - 1] = end_id
        return ids, np.diff(last, prepend=0)


def grown(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """``array`` with room for ``more`` entries behind the used ones."""
    if used + more <= len(array):
        return array
    out = np.empty(max(2 * len(array), used + more), array.dtype)
    out[:used] = array[:used]
    return out


@lru_cache(maxsize=2)
def encoder_of(path: str, word_wise: bool) -> Encoder:
    return Encoder(path, word_wise)


def slices(batch, most: int = SLICE_BYTES):
    """Parts of a batch whose texts (column 1) hold some ``most`` bytes, of one row at least."""
    import pyarrow.compute as pc

    after = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(after, (after[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def cut_documents(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, word_wise: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                ids, lengths = encoder_of(path, word_wise).encode(part.column(1).fill_null(""), end_id)
                pieces = -(-lengths // size)
                row = np.repeat(np.arange(len(lengths)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(size, lengths[row] - piece * size)
                after = np.cumsum(length)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * (a - n):4 * a]) for a, n in zip(after.tolist(), length.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], after]).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(piece * size), pa.array(length),
                                                  pa.array(crc, pa.int64()), lists], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"{PIECE}, ids array<int>")


class Bins:
    """A fixed number of open bins, found by their free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free = 0  # bit f is set where a bin with f free places is open
        self.of: list[list[list]] = [[] for _ in range(size + 1)]
        self.open = 0

    def take(self, room: int) -> list:
        items = self.of[room].pop()
        if not self.of[room]:
            self.free ^= 1 << room
        self.open -= 1
        return items

    def put(self, item, length: int) -> Iterator[list]:
        """Place one item; yields the bins that close by it."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            items = self.take(room)
        else:
            if self.open >= self.most:
                yield self.take((self.free & -self.free).bit_length() - 1)
            room, items = self.size, []
        items.append(item)
        room -= length
        if not room:
            yield items
            return
        self.of[room].append(items)
        self.free |= 1 << room
        self.open += 1

    def rest(self) -> Iterator[list]:
        for same in self.of:
            yield from same


def best_fit(items: Iterable[tuple], size: int = SIZE, most: int = OPEN_BINS, window: int = WINDOW) -> Iterator[tuple[list, bool]]:
    """Bins of ``items`` (their last field is the length) as they close; with True those left open at the end."""
    bins, held = Bins(size, most), []

    def feed():
        for item in sorted(held, key=lambda i: -i[-1]):
            for full in bins.put(item, item[-1]):
                yield full, False

    for item in items:
        held.append(item)
        if len(held) == window:
            yield from feed()
            held = []
    yield from feed()
    for left in bins.rest():
        yield left, True


def pack_round(pieces: DataFrame, number: int, tasks: int, size: int, most: int, window: int) -> DataFrame:
    """Pack the pieces in ``tasks`` tasks; bins left open are marked unless this is the last round."""
    last = tasks == 1

    def run(batches):
        import pyarrow as pa

        def items():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 3)))

        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                            ("key", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])
        base = (number << 56) + (TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for n, (bin_items, left) in enumerate(best_fit(items(), size, most, window)):
            at = 0
            for doc, piece, start, crc, key, length in bin_items:
                rows.append((doc, piece, start, length, crc, key, base + n, at, left and not last))
                at += length
            if len(rows) >= 8192:
                yield batch_of()
                rows.clear()
        if rows:
            yield batch_of()

    narrow = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "key")
    return narrow.coalesce(tasks).mapInArrow(run, PLACED)


@dataclass
class Packed:
    """``pieces`` with their ids, and ``places``: the sequence and offset of each piece."""

    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        """``sequence_id, n_tokens, ids, doc_ids, lengths``: the packed sequences themselves, parts in order."""
        parts = self.places.select("key", "sequence_id", "offset", "length").join(self.pieces.select("key", "doc_id", "ids"), "key")
        rows = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "key", "doc_id", "length", "ids"))).alias("p"))
        return rows.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
                           F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID, word_wise: bool = True, most: int = OPEN_BINS,
         window: int = WINDOW, pieces_per_task: int = PIECES_PER_TASK) -> Packed:
    cut = cut_documents(docs, path or tokenizer_path(), size, end_id, word_wise)
    pieces = written(cut.withColumn("key", F.monotonically_increasing_id()), "packing-pieces")
    left, closed, number = pieces, [], 0
    while True:
        count = left.count()
        tasks = max(1, -(-count // pieces_per_task))
        placed = written(pack_round(left, number, tasks, size, most, window), "packing-places")
        closed.append(placed.where(~F.col("open")).drop("open"))
        if tasks == 1:
            break
        left, number = placed.where("open"), number + 1
        if 2 * left.count() > count:  # bins that hold few pieces each: another round would not close them
            closed.append(left.drop("open"))
            break
    places = closed[0]
    for more in closed[1:]:
        places = places.unionAll(more)
    return Packed(pieces, places)
