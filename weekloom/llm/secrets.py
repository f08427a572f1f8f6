"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong spans (``assign``, ``access``, ``hex``) always count. Weak candidates are parts of a credential that mean little alone:
an identifier (``id``), an unnamed secret (``secret``) and an address (``endpoint``). They are reported only when the complementary
parts begin within ``SCOPE`` code points of them: an identifier needs a secret, a secret an identifier, an endpoint both. Strong
spans serve as parts too: ``access`` as identifier, ``assign`` and ``hex`` as secrets. The interval join of parts runs as a
range-framed window over the parts of a text in order of their start, so no pairs are made.

Positions come from lengths: the pieces between matches and the matches of a pattern alternate, and a running sum over both gives
each start. They count code points, the end is exclusive.

Null and empty texts have no spans, zero counts, an empty ``spans`` and the digest of the empty string. Repeated rows are scanned one
by one. Only ``doc_id`` and ``text`` are read; a null ``doc_id`` stays null. A weak span that begins inside a strong one is the
same finding and is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 200

# fixed values: kind, pattern, least length of the match (for assign of the value, group 2)
STRONG = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]{24,}+", 24),  # runs are maximal, so shorter ones can be left to the pattern
)
# kind, pattern
WEAK = (
    ("id", r"(?<![A-Za-z0-9])(?!AKIA)(?=[A-Z]{0,39}[0-9])(?=[0-9]{0,39}[A-Z])[A-Z0-9]{16,40}(?![A-Za-z0-9])"),
    # a maximal run; a single "=" before it assigns, two are the padding of another run
    ("secret", r"(?<![A-Za-z0-9+/_-])(?<!==)(?=[A-Za-z+/]*+[0-9])(?=[A-Z0-9+/]*+[a-z])(?=[a-z0-9+/]*+[A-Z])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=_-])"),
    ("endpoint", r"(?:https?|jdbc:[a-z]+|postgres|mysql|redis|mongodb|amqp)://[A-Za-z0-9._~:/?#@!&()*+,;=%-]+"),
)
KINDS = tuple(k for k, *_ in STRONG) + tuple(k for k, _ in WEAK)
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "id": "id", "secret": "secret", "endpoint": "endpoint"}


def matches_of(text: Column, order: int, pattern: str, least: int, value_group: int) -> Column:
    """The matches of one kind as (kind's place, match's place, code points before it since the last match, its length, good)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.length)
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), F.length) if value_group else sizes
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), sizes.alias("size"), values.alias("value"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(order).alias("kind"), i.alias("place"), x["gap"].alias("gap"), x["size"].alias("size"), (x["value"] >= least).alias("good")))
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:int,place:int,gap:int,size:int,good:boolean>>"))


def all_parts(docs: DataFrame) -> DataFrame:
    """One row per match of any kind (one without a kind for a text without matches), with ``start`` and ``stop``."""
    text = F.col("body")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    arrays = [matches_of(text, i, pattern, least, 2 if kind == "assign" else 0) for i, (kind, pattern, least) in enumerate(STRONG)]
    arrays += [matches_of(text, len(STRONG) + i, pattern, 1, 0) for i, (_, pattern) in enumerate(WEAK)]
    rows = rows.select("row", "doc_id", F.explode_outer(F.concat(*arrays)).alias("m")).select("row", "doc_id", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("size")).over(before)
    return rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size")).drop("gap", "place")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Good strong parts and the weak ones whose complementary parts begin within ``scope`` code points."""
    good = F.col("good")
    strong = F.col("kind") < len(STRONG)
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    so_far = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    out = parts.withColumn("strong_stop", F.max(F.when(good & strong, F.col("stop"))).over(so_far))
    out = out.withColumn("usable", good & (strong | F.col("strong_stop").isNull() | (F.col("strong_stop") <= F.col("start"))))
    for role in ("id", "secret"):
        kinds = [i for i, k in enumerate(KINDS) if ROLES[k] == role]
        out = out.withColumn(f"near_{role}", F.max(F.col("usable") & F.col("kind").isin(kinds)).over(near))
    needs = (F.when(F.col("kind") == KINDS.index("id"), F.col("near_secret"))
             .when(F.col("kind") == KINDS.index("secret"), F.col("near_id"))
             .otherwise(F.col("near_id") & F.col("near_secret")))
    return out.withColumn("reported", F.coalesce(F.col("usable") & (strong | needs), F.lit(False)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document with the counts of strong spans, their digest and all spans."""
    strong = F.col("reported") & (F.col("kind") < len(STRONG))
    span = F.struct("start", "kind", "stop")
    counts = [F.sum(F.when(strong & (F.col("kind") == i), 1).otherwise(0)).cast("long").alias(f"n_{kind}") for i, (kind, *_) in enumerate(STRONG)]
    found = linked(all_parts(docs), scope).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *counts, F.collect_list(F.when(strong, span)).alias("base"),
        F.collect_list(F.when(F.col("reported"), span)).alias("every"))
    return found.select("doc_id", *(f"n_{kind}" for kind, *_ in STRONG), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("every")).alias("spans"))
