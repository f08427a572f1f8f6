import random

import numpy as np
from pyspark.sql import functions as F

from weekloom.functions.ranks import FINE_BITS, _code, exact_quantiles, global_row_number, rank_in_group


def test_global_row_number_is_dense_and_ordered(spark):
    rng = random.Random(3)
    values = rng.sample(range(100000), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r["v"]: r["n"] for r in global_row_number(df, ["v"], "n").collect()}
    assert got == {v: k + 1 for k, v in enumerate(sorted(values))}


def test_rank_in_group_handles_one_dominant_group(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 5 == 0, "small").otherwise("hot").alias("g"), (-F.col("id")).alias("v"))
    got = rank_in_group(df, ["g"], ["v"], "r", "n").groupBy("g").agg(
        F.min("r").alias("lo"), F.max("r").alias("hi"), F.count_distinct("r").alias("d"), F.max("n").alias("n"))
    assert {r["g"]: (r["lo"], r["hi"], r["d"], r["n"]) for r in got.collect()} == {
        "small": (1, 800, 800, 800), "hot": (1, 3200, 3200, 3200)}


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(5)
    groups = {"hot": rng.normal(0, 50, 3001), "ties": np.repeat([1.0, 2.0, 7.0], [400, 3, 100]), "one": np.array([4.5]),
              "skewed": np.exp(rng.normal(0, 3, 500))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    probs = {"p05": 0.05, "p50": 0.5, "p80": 0.8, "p995": 0.995}
    for r in exact_quantiles(df, ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert abs(r[name] - np.quantile(groups[r["g"]], p)) < 1e-9, (r["g"], name)
    whole = exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert abs(whole - np.median(np.concatenate(list(groups.values())))) < 1e-9


def test_codes_keep_the_order_of_doubles(spark):
    rng = np.random.default_rng(11)
    near = 1.0 + np.arange(-300, 300) * 2.0**-52
    values = np.unique(np.concatenate([near, -near, rng.normal(0, 1e-12, 500), 10.0 ** rng.uniform(-320, 308, 2000),
                                       -(10.0 ** rng.uniform(-320, 308, 2000)), [0.0, 5e-324, -5e-324, 1.7976931348623157e308, np.inf, -np.inf]]))
    frame = spark.createDataFrame([(float(v),) for v in [*values, np.nan]], "v double")
    codes = [r["c"] for r in frame.orderBy("v").select(_code(F.col("v")).alias("c")).collect()]
    assert codes == sorted(codes)


def test_exact_quantiles_of_millions_of_close_values(spark):
    n = 5_000_000
    rows = spark.range(n, numPartitions=8).select((100.0 + F.col("id") * 2e-9).alias("v"))  # within 0.01 %
    got = exact_quantiles(rows, [], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    values = 100.0 + np.arange(n) * 2e-9
    for name, p in {"p10": 0.1, "p50": 0.5, "p99": 0.99}.items():
        assert abs(got[name] - np.quantile(values, p)) < 1e-12
    coded = rows.select(_code(F.col("v")).alias("c"))
    sizes = coded.groupBy("c").count().agg(F.max("count").alias("most"), F.count("*").alias("parts")).first()
    assert sizes["most"] <= 100 and coded.select(F.shiftright("c", FINE_BITS)).distinct().count() <= 2


def test_exact_quantiles_around_zero_and_of_negative_values(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(0, 1e-15, 700), np.zeros(50), -np.exp(rng.normal(0, 4, 400)), [-1.0] * 30])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = {f"p{k}": k / 100 for k in (0, 1, 25, 37, 50, 66, 90, 100)}
    got = exact_quantiles(frame, [], "v", probs).first()
    for name, p in probs.items():
        assert abs(got[name] - np.quantile(values, p)) <= 1e-9 * max(1.0, abs(got[name]))
    assert exact_quantiles(frame.limit(0), [], "v", probs).count() == 0
