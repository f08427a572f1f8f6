"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a conversation (every role but ``system``) the dialogue is rendered once with that speaker as assistant, the
others as named users and system turns as such. The mask lists the stretches a model learns from: the assistant's contents with their
end marks, as ``start:end`` in code points of the rendered text, end exclusive, joined by commas.

A conversation is one row per participant. Only where it has more than ``LIMIT`` different messages is it cut, so that no group that is
gathered grows without bound: into blocks of ``BLOCK`` turn numbers, and where a block still holds more, into its turns and slices of these by
the message's hash. ``block, turn, slice`` order the parts of such a conversation; elsewhere they are 0, null and 0.

Messages of one turn follow each other by hash, role and text. Repeated rows are one message; ``n_rows`` counts them. A null role
is the participant ``unknown``, a null text is empty, null turns come last, rows with a null ``conv_id`` are one conversation. A
conversation of system turns only has no participant and no row, an empty table none at all. ``<|`` in texts is written ``< |``, and
characters of role names outside ``A-Za-z0-9_.-`` as ``_``, so that neither can pass for a mark. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS
LIMIT = 256
SHARES = 16
SYSTEM = "system"
END = "<|end|>"


def messages(conversations: DataFrame) -> DataFrame:
    """Different messages with their order and how many rows each has."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(2**63 - 1))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times")).select("*", F.xxhash64("role", "text").alias("h"))


def in_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Add ``block``: the stretch of turns in conversations of more than ``limit`` messages, 0 in all others."""
    long = rows.groupBy("conv_id").count().where(F.col("count") > limit).select(F.col("conv_id").alias("c"))
    # dealt by conversation and share, as one of them may hold many of the rows
    shares = long.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))).withColumn("long", F.lit(True))
    dealt = rows.withColumn("own_share", F.pmod("h", F.lit(SHARES)).cast("int"))
    joined = dealt.join(shares, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("own_share") == F.col("share")), "left")
    return joined.withColumn("block", F.when(F.col("long"), F.shiftright("turn", BLOCK_BITS)).otherwise(F.lit(0).cast("long"))).drop("c", "share", "own_share", "long")


def slices(rows: DataFrame, limit: int) -> DataFrame:
    """``conv_id, turn, slices`` of the turns in blocks of more than ``limit`` messages."""
    heavy = rows.groupBy("conv_id", "block").count().where(F.col("count") > limit).select(F.col("conv_id").alias("c"), F.col("block").alias("b"))
    inside = rows.join(heavy, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left_semi")
    return inside.groupBy("conv_id", "turn").agg(F.ceil(F.count("*") / limit).alias("slices"))


def parts(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per part with its messages in order."""
    cut = slices(rows, limit).select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "slices")
    placed = rows.join(cut, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    # equal shares of the hash's range, in its order
    share = F.floor((F.shiftright("h", 32) + 2**31) * F.col("slices") / 2**32)
    placed = placed.withColumn("slice", F.coalesce(share, F.lit(0)).cast("int")).withColumn("own", F.col("t"))
    return placed.groupBy("conv_id", "block", "own", "slice").agg(
        F.array_sort(F.collect_list(F.struct("turn", "h", "role", "text"))).alias("said"), F.sum("times").alias("n_rows"))


def name_of(role: Column) -> Column:
    return F.regexp_replace(role, "[^A-Za-z0-9_.-]", "_")


def rotated(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per conversation (or part of a long one) and participant: ``conv_id, speaker, block, turn, slice, n_messages, n_trained, n_rows, text, mask``."""
    rows = in_blocks(messages(conversations), limit)
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    seen = parts(rows, limit).join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))

    def turn(m: Column) -> Column:
        mine = (m["role"] == F.col("speaker")) & (m["role"] != SYSTEM)
        head = F.when(m["role"] == SYSTEM, "<|system|>\n").when(mine, "<|assistant|>\n").otherwise(
            F.concat(F.lit("<|user name="), name_of(m["role"]), F.lit("|>\n")))
        body = F.concat(F.replace(m["text"], F.lit("<|"), F.lit("< |")), F.lit(END))
        return F.struct(head.alias("head"), body.alias("body"), mine.alias("mine"))

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        stop = start + F.length(t["body"])
        span = F.concat(F.when(state["mask"] == "", "").otherwise(","), start.cast("string"), F.lit(":"), stop.cast("string"))
        return F.struct((stop + 1).alias("at"), F.when(t["mine"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask"),
                        (state["n"] + F.when(t["mine"], 1).otherwise(0)).alias("n"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"), F.lit(0).alias("n"))
    seen = seen.withColumn("turns", F.transform("said", turn))
    done = seen.withColumn("sums", F.aggregate("turns", start, step))
    return done.select(
        "conv_id", "speaker", F.col("block").alias("block"), F.col("own").alias("turn"), "slice", F.size("turns").cast("long").alias("n_messages"),
        F.col("sums.n").cast("long").alias("n_trained"), "n_rows",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "").alias("text"), F.col("sums.mask").alias("mask"))
