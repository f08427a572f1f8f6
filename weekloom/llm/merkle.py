"""Merkle manifest of a dataset with incremental witnesses.

A leaf is the digest of a row. Leaves of a source, ascending by ``doc_id``, are appended to a tree of run length ``FANOUT``; the trees'
roots, ordered by source, are appended to the tree of the dataset. An appended node gets an empty witness; whenever a run of siblings is
complete, the witnesses of all leaves below them are extended by their siblings' digests, and the parent is appended one level up. So a
witness is valid for the subtree that is open at that time, and grows with it.

The append runs in blocks aligned to the tree: ``FANOUT ** LEVELS`` consecutive nodes of a source are streamed through one task and give
partial witnesses and a block root. The block roots are nodes that are appended in the same way in the next pass, until each source has
one node; a node's witness is then its partial one followed by its block's. Blocks are bounded whatever a source's size, texts never
leave their first task, and the number of passes is logarithmic. A block that is not a source's only one is raised to its full
height, as its root stands beside others.

A witness is text: one entry a level, joined by commas, each the digests before and after the node with ``|`` between; a node alone in its
run has the entry ``|``, a lone leaf in a lone source the empty text. ``folded`` computes the root from a leaf and a witness.

Rows with the same ``doc_id`` follow each other by digest, null ids come first; repeated rows are leaves of their own with equal
digests. A null source is a source, before all others. An empty table has no leaf and no root. Texts of any length are hashed whole. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.ranks import global_row_number
from weekloom.llm.common import written

FANOUT = 3
LEVELS = 6  # levels of a block: 729 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*values: Column) -> Column:
    """Digest of a row's values, each with its length so that they cannot run into each other."""
    texts = [v.cast("string") for v in values]
    return digest_of(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


class Appender:
    """A tree over appended nodes, ``levels`` high; yields ``(tag, witness)`` of its leaves at the end."""

    def __init__(self, levels: int, fanout: int = FANOUT):
        self.levels, self.fanout = levels, fanout
        # per level the open run: (digest, [(tag, witness so far)])
        self.open: list[list[tuple[str, list]]] = [[] for _ in range(levels + 1)]

    def append(self, digest: str, tag) -> None:
        self.add(0, digest, [(tag, [])])

    def add(self, level: int, digest: str, below: list) -> None:
        run = self.open[level]
        run.append((digest, below))
        if len(run) == self.fanout and level < self.levels:
            self.complete(level)

    def complete(self, level: int) -> None:
        """Close the run of a level: its witnesses grow by their siblings, its parent is appended."""
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        for i, (_, below) in enumerate(run):
            step = "".join(digests[:i]) + "|" + "".join(digests[i + 1:])
            for _, witness in below:
                witness.append(step)
        self.add(level + 1, sha256("".join(digests).encode()).hexdigest(), [b for _, below in run for b in below])

    def close(self, sole: bool) -> tuple[str, list]:
        """Root and leaves after the last append; a sole tree ends where one node is left, others at full height."""
        for level in range(self.levels):
            if sole and len(self.open[level]) == 1 and not any(self.open[level + 1:]):
                return self.open[level].pop()
            if self.open[level]:
                self.complete(level)
        return self.open[self.levels].pop()


def fold(nodes: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """Append nodes (``grp, rank, digest`` and other columns) block by block: adds ``partial`` and ``block_root``."""
    size = fanout ** levels
    shape = nodes.select(*(c for c in nodes.columns)).schema.add("partial", "string").add("block_root", "string")
    names = nodes.columns
    grp, rank, digest = (names.index(n) for n in ("grp", "rank", "digest"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, rows, current, tree = to_arrow_schema(shape), [], None, None

        def close() -> None:
            root, leaves = tree.close(sole=current[1] == 0)
            rows.extend((*row, ",".join(witness), root) for row, witness in leaves)

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], names=arrow.names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                block = row[grp], row[rank] // size
                if block != current:
                    if tree:
                        close()
                    current, tree = block, Appender(levels, fanout)
                tree.append(row[digest], row)
            if len(rows) >= 4096:
                yield batch_of()
                rows.clear()
        if tree:
            close()
        if rows:
            yield batch_of()

    block = F.floor(F.col("rank") / size)
    return nodes.repartition(F.col("grp"), block).sortWithinPartitions("grp", "rank").mapInArrow(run, shape)


def ranked(rows: DataFrame) -> DataFrame:
    """Number the rows of each ``grp`` from 0, by ``doc_id`` and digest, whatever a group's size.

    Rows are sorted by ranges, and a group's numbers go on from range to range.
    """
    order = ("grp", "doc_id", "digest")
    laid = written(written(rows, "merkle-leaves").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    laid = laid.withColumn("part", F.shiftright("at", 33))
    # a row per group in each range; ranges are few and each group lies in consecutive ones
    runs = laid.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("part", "grp", (F.col("first") - F.coalesce(before, F.lit(0))).alias("zero"))
    return laid.join(starts, ["part", "grp"]).withColumn("rank", F.col("at") - F.col("zero")).drop("part", "at", "zero")


class Tree:
    """All passes over the nodes of many groups, and the groups' roots."""

    def __init__(self, nodes: DataFrame, levels: int, fanout: int):
        self.size, self.passes = fanout ** levels, []
        while True:
            done = written(fold(nodes, levels, fanout), "merkle-pass")
            self.passes.append(done)
            top = done.agg(F.max("rank")).first()[0]
            nodes = done.where(F.col("rank") % self.size == 0).select("grp", F.floor(F.col("rank") / self.size).alias("rank"), F.col("block_root").alias("digest"))
            if top is None or top < self.size:
                break
        self.roots = nodes.select("grp", F.col("digest").alias("root"))

    def witnessed(self, above: DataFrame) -> DataFrame:
        """First pass's rows with whole witnesses; ``above`` has ``grp, upper`` and columns that all nodes of a group get."""
        more = [c for c in above.columns if c not in ("grp", "upper")]
        for i, rows in reversed(list(enumerate(self.passes))):
            full = F.concat_ws(",", F.when(F.col("partial") != "", F.col("partial")), F.when(F.col("upper") != "", F.col("upper")))
            if i == len(self.passes) - 1:
                joined = rows.join(above, "grp")
            else:
                joined = rows.withColumn("block", F.floor(F.col("rank") / self.size)).join(above.withColumnRenamed("rank", "block"), ["grp", "block"]).drop("block")
            joined = joined.withColumn("witness", full).drop("partial", "block_root", "upper")
            if i == 0:
                return joined
            above = joined.select("grp", "rank", F.col("witness").alias("upper"), *more)


def manifest(docs: DataFrame, *others: Column, fields: tuple[str, ...] = FIELDS, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """One row per document: ``doc_id, leaf, witness, subroot, root`` and the given columns of ``docs``, which must be named."""
    values = [F.col(f) for f in fields]
    # null sorts before the empty text, texts by their bytes
    group = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    leaves = docs.select(group.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(*values).alias("digest"), F.struct(F.lit(0).alias("none"), *others).alias("given"))
    by_source = Tree(ranked(leaves), levels, fanout)
    order = global_row_number(by_source.roots, ["grp"], "n")
    whole = Tree(order.select(F.lit("").alias("grp"), (F.col("n") - 1).alias("rank"), F.col("root").alias("digest"), F.col("grp").alias("src")), levels, fanout)
    top = whole.roots.select("grp", F.lit("").alias("upper"), "root")
    sources = whole.witnessed(top).select(F.col("src").alias("grp"), F.col("witness").alias("upper"), F.col("digest").alias("subroot"), "root")
    return by_source.witnessed(sources).select("doc_id", F.col("digest").alias("leaf"), "witness", "subroot", "root", "given.*").drop("none")


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    steps = F.when(witness == "", F.array().cast("array<string>")).otherwise(F.split(witness, ","))
    return F.aggregate(steps, leaf, lambda at, step: digest_of(F.substring_index(step, "|", 1), at, F.substring_index(step, "|", -1)))


def proof_digest(witness: Column) -> Column:
    """Digest of all siblings on the way to the root, left to right, level by level."""
    return F.sha2(F.translate(witness, "|,", ""), 256)


def audited(docs: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """The manifest held against texts without line ends where 2 divides the crc32 of the id."""
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(touched, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = leaf_of(*(text if f == "text" else F.col(f) for f in FIELDS)).alias("claimed")
    rows = manifest(docs, claimed, levels=levels, fanout=fanout)
    out = rows.withColumn("folded_root", folded(F.col("claimed"), F.col("witness")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
