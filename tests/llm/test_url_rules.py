"""URL rules against trying every rule on every url."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weekloom.llm import url_rules as ur


def brute(rows, rules, default="allow"):
    out = []
    for page, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1])
        path = m[2]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: f[:2], default=None)
        out.append((page, host, path, best and best[2], best[3] if best else default))
    return sorted(out, key=str)


def cases(seed):
    draw = random.Random(seed)
    hosts = ["com", "example.com", "www.example.com", "a.b.example.com", "net", "x.net", "WWW.Example.com", "notexample.com", "", "com.", "example.com:80", "é.com"]
    paths = ["", "/", "/en/", "/en/x", "/EN/", "/es/1", "/fr/", "/e", "?q=/en/", "#/en/", "/en/?a://b"]
    rows = [(i, f"{draw.choice(['http', 'https', ''])}://{draw.choice(hosts)}{draw.choice(paths)}") for i in range(600)]
    return rows + [(None, None), (7, "no scheme"), (7, "no scheme"), (8, ""), (9, "http://com/")] * 3


@pytest.mark.parametrize("tasks", [1, 5])
def test_fixed_rules(spark, tasks):
    rows = cases(tasks)
    pages = spark.createDataFrame([(*r, "h", "k") for r in rows], "page_id long, url string, host string, key string")
    got = [tuple(r) for r in ur.UrlRules(ur.default_rules(spark), tasks=tasks).judge(pages).collect()]
    assert sorted(got, key=str) == brute(rows, ur.RULES)


def test_many_nested_rules_across_ranges(spark):
    draw = random.Random(8)
    labels = ["a", "b", "c"]
    hosts = [".".join(draw.choices(labels, k=draw.randint(1, 4))) for _ in range(200)]
    rules = sorted({(h, draw.choice(["", "/", "/x", "/x/y"])): draw.choice(["allow", "block"]) for h in hosts}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    rows = [(i, f"http://{'.'.join(draw.choices(labels, k=draw.randint(1, 5)))}{draw.choice(['', '/', '/x', '/x/y/z'])}") for i in range(2000)]
    frame = spark.createDataFrame([*rules, (None, "/", "allow"), ("a", "/n", None)], "host string, path string, verdict string")
    got = [tuple(r) for r in ur.UrlRules(frame, default="block", tasks=4).judge(spark.createDataFrame(rows, "page_id long, url string")).collect()]
    assert sorted(got, key=str) == brute(rows, rules, "block")


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = ur.default_rules(spark)
    assert ur.UrlRules(rules).judge(pages.limit(0)).count() == 0
    assert tuple(ur.UrlRules(rules.limit(0)).judge(pages).first()) == (1, "a.com", "/", None, "allow")


def test_equal_rows_are_spread_over_ranges(spark):
    pages = spark.range(4000).selectExpr("cast(null as long) page_id", "'http://hot.example.com/en/' url").repartition(4)
    judged = ur.UrlRules(ur.default_rules(spark), tasks=4).judge(pages)
    sizes = [r["n"] for r in judged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) < 3000
    assert judged.where("rule = 'example.com/en/' and verdict = 'block'").count() == 4000
