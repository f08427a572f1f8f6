"""URL allow and block rules as a sort-merge range join.

A host is written with its labels reversed (``com.example.www.``), so a rule's host and all its subdomains are one interval of
sorted keys: everything that starts with the rule's key. Urls and rules are cut into key ranges; a rule goes to every range its
interval meets. Each range is swept once in key order with a stack of the rule hosts whose interval is still open (each nested in
the one below); the rules on the stack whose path starts the url's path fit, and the longest one wins.

A url that is null or has no ``://`` has an empty host and path; no rule fits it. Rules with a null host or verdict are ignored, a
null path is empty. Of rules with the same host and path the smallest verdict counts; of fitting rules of the same length the one
with the longer host. Repeated urls are judged one by one and may fall into different ranges, so a hot host or url is spread over
tasks. Only ``page_id`` and ``url`` are read; tables may be empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.common import lower_ascii

# fixed values: host, path, verdict
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT_VERDICT = "allow"
SAMPLE_PER_RANGE = 20  # keys sampled for each range; the driver holds ranges x this many keys
RANGES_PER_TASK = 4  # evens out how many ranges the hash gives a task
END = "\U0010ffff"


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "host string, path string, verdict string")


def reversed_host(host):
    """``www.example.com`` -> ``com.example.www.``; an empty host stays empty."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def parsed(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(coalesce(cast(url as string), ''), instr(cast(url as string), '://') + 3)")).otherwise("")
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), rest.alias("rest"))
    host = lower_ascii(F.regexp_extract("rest", r"^[^/?#]*", 0))
    path = F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)
    return out.select("page_id", host.alias("host"), path.alias("path"))


def sweep(rows):
    """Rows of one range in key order, rule hosts before the urls of the same key -> verdict rows.

    The stack holds (key, rules of that host by path, their path lengths); its height is at most the number of labels of a host.
    """
    stack: list[tuple[str, dict[str, str], set[int]]] = []
    for key, is_url, page_id, host, path, verdict in rows:
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if not is_url:
            if not stack or stack[-1][0] != key:
                stack.append((key, {}, set()))
            known = stack[-1][1]
            known[path] = min(verdict, known.get(path, verdict))
            stack[-1][2].add(len(path))
            continue
        best = None
        for prefix, known, sizes in stack:  # deeper hosts come later and win ties
            for n in sizes:
                if n <= len(path) and path[:n] in known and (best is None or len(prefix) - 1 + n >= best[0]):
                    best = (len(prefix) - 1 + n, prefix, path[:n], known[path[:n]])
        if best is None:
            yield page_id, host, path, None, None
        else:
            labels = best[1][:-1].split(".")
            yield page_id, host, path, ".".join(reversed(labels)) + best[2], best[3]


class UrlRules:
    """``tasks`` is the number of sweeping tasks, by default the session's number of shuffle partitions; each gets several ranges."""

    def __init__(self, rules: DataFrame, default: str = DEFAULT_VERDICT, tasks: int | None = None):
        self.rules, self.default, self.tasks = rules, default, tasks

    def judge(self, pages: DataFrame) -> DataFrame:
        spark = pages.sparkSession
        tasks = self.tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = RANGES_PER_TASK * tasks
        urls = parsed(pages).withColumn("key", reversed_host(F.col("host")))
        urls = urls.withColumn("spread", F.xxhash64("page_id", "path", F.monotonically_increasing_id()))  # cuts a run of equal keys, equal rows too
        rules = self.rules.where("host is not null and verdict is not null and host != ''").select(
            lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").withColumn(
            "key", reversed_host(F.col("host")))
        rules = rules.withColumn("is_url", F.lit(False)).withColumn("page_id", F.lit(None).cast("long")).withColumn("spread", F.lit(0).cast("long"))

        rows = urls.count()
        share = min(1.0, ranges * SAMPLE_PER_RANGE / max(rows, 1))
        sample = sorted((r[0], r[1]) for r in urls.select("key", "spread").sample(fraction=share, seed=11).collect())
        cuts = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []

        def place(batches):
            import pyarrow as pa

            for batch in batches:
                keys, spreads = batch.column("key").to_pylist(), batch.column("spread").to_pylist()
                flags = batch.column("is_url").to_pylist()
                row, at = [], []
                for i, (key, spread, is_url) in enumerate(zip(keys, spreads, flags)):
                    first = bisect_right(cuts, (key, spread)) if is_url else bisect_left(cuts, (key, -2**63))
                    last = first if is_url else bisect_right(cuts, (key + END, 0))
                    for r in range(first, last + 1):
                        row.append(i)
                        at.append(r)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row, pa.int64())).columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "range"])

        both = urls.withColumn("is_url", F.lit(True)).withColumn("verdict", F.lit(None).cast("string"))
        both = both.select("key", "spread", "is_url", "page_id", "host", "path", "verdict")
        both = both.unionByName(rules.select(*both.columns))
        placed = both.mapInArrow(place, "key string, spread long, is_url boolean, page_id long, host string, path string, verdict string, range int")
        dealt = placed.repartition(tasks, "range").sortWithinPartitions("range", "key", "is_url", "path")

        def run(batches):
            import pyarrow as pa

            def rows():
                for batch in batches:
                    yield from zip(*(batch.column(c).to_pylist() for c in ("key", "is_url", "page_id", "host", "path", "verdict", "range")))

            out = []
            schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

            def batch_of(found):
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

            swept = (x for _, group in groupby(rows(), key=lambda r: r[-1]) for x in sweep(r[:-1] for r in group))
            for found in swept:  # each range starts with an empty stack
                out.append(found)
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

        swept = dealt.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
        return swept.withColumn("verdict", F.coalesce("verdict", F.lit(self.default)))
