"""Order statistics against brute force, on data with hot values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldspark.functions.hashing import hash_bits
from foldspark.operators.ordered import (
    block_number,
    exact_quantiles,
    grouped_quantiles,
    hash_cuts,
    positions,
    running_totals,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; there are some missing values."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(3000) < 0.34, 42.0, np.round(rng.normal(40, 25, 3000), 2))
    rows = [(i, None if i % 97 == 0 else float(v), i % 4) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, v double, g int").repartition(5).persist()


def test_quantiles_match_numpy(skewed):
    values = [r["v"] for r in skewed.collect() if r["v"] is not None]
    grid = [0.0, 0.05, 0.25, 0.5, 0.731, 0.95, 1.0]
    assert exact_quantiles(skewed, "v", grid)["all"] == pytest.approx(np.quantile(values, grid))


def test_weighted_subsets_in_one_pass(skewed):
    rows = [r for r in skewed.collect() if r["v"] is not None]
    weights = {
        "g0": (F.col("g") == 0).cast("int"),
        "twice": F.when(F.col("g") == 1, 2).otherwise(1),
        "none": F.lit(0),
    }
    found = exact_quantiles(skewed, "v", [0.1, 0.5, 0.9], weights)
    only = [r["v"] for r in rows if r["g"] == 0]
    twice = [r["v"] for r in rows for _ in range(2 if r["g"] == 1 else 1)]
    assert found["g0"] == pytest.approx(np.quantile(only, [0.1, 0.5, 0.9]))
    assert found["twice"] == pytest.approx(np.quantile(twice, [0.1, 0.5, 0.9]))
    assert found["none"] == [None, None, None]


def test_running_totals(skewed):
    counts = skewed.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {(r["g"], r["v"]): r["cum_n"] for r in running_totals(counts, "v", ["n"], ["g"]).collect()}
    rows = [r for r in skewed.collect() if r["v"] is not None]
    for (g, v), cum in got.items():
        assert cum == sum(1 for r in rows if r["g"] == g and r["v"] <= v)


def test_positions_and_blocks(spark):
    df = spark.range(0, 3379 * 3, 3).repartition(7)
    placed = positions(df, "id").withColumn("b", block_number(F.col("position"), F.lit(3379), 10))
    rows = placed.collect()
    assert all(r["position"] == r["id"] // 3 + 1 for r in rows)
    sizes = [sum(1 for r in rows if r["b"] == b) for b in range(1, 11)]
    assert sizes == [338] * 9 + [337]


def test_hash_cuts_hit_exact_ranks(spark):
    df = spark.range(1001)
    cuts = hash_cuts(df, {"a": hash_bits(5, "id")}, lambda n: [F.floor(n * 0.8), F.lit(0), n])["a"]["all"]
    bits = sorted(r[0] for r in df.select(hash_bits(5, "id")).collect())
    assert cuts == [bits[799], -1, bits[-1]]


def test_positions_of_text_and_compound_keys(spark):
    rng = np.random.default_rng(11)
    rows = [(str(rng.choice(["aa", "b", "ä", None])), None if i % 50 == 0 else f"k{i % 7}", i) for i in range(900)]
    df = spark.createDataFrame([(None if a == "None" else a, b, i) for a, b, i in rows], "a string, b string, i long").repartition(9)
    got = {r["i"]: r["position"] for r in positions(df, ["a", "b", "i"]).collect()}
    key = lambda v: (v is not None, (v or "").encode())
    order = sorted(df.collect(), key=lambda r: (key(r["a"]), key(r["b"]), r["i"]))
    assert got == {r["i"]: k for k, r in enumerate(order, 1)}
    assert positions(df.limit(0), ["a", "i"]).count() == 0


def test_quantiles_of_many_and_of_huge_groups(spark):
    # one group holds half of the rows; the others are 20,000 small ones
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 20_000).alias("g"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.col("id") * 7919, F.lit(1013)).cast("double")).alias("v"),
    )
    rows = rows.union(spark.createDataFrame([(-2, None)], "g long, v double"))
    found = {r["g"]: r["quantiles"] for r in grouped_quantiles(rows, ["g"], "v", [0.0, 0.5, 0.9]).collect()}
    values = {}
    for r in rows.collect():
        values.setdefault(r["g"], []).append(r["v"])
    assert set(found) == set(values) and len(found) > 10_000
    for g, own in values.items():
        own = [v for v in own if v is not None]
        assert found[g] == (pytest.approx(np.quantile(own, [0.0, 0.5, 0.9])) if own else [None] * 3)
