"""Distributions, hashing and text."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from foldspark.functions.distributions import (
    f_upper,
    incomplete_beta,
    normal_quantile,
    t_quantile,
    t_quantiles,
    t_two_sided,
)
from foldspark.functions.hashing import hash01, hash_bits
from foldspark.functions.text import paste, strip_prefix


def test_t_tail_known_values():
    # nine degrees of freedom: published two-sided 5 % and 1 % points
    assert t_two_sided(2.2621571627, 9) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(3.2498355416, 9) == pytest.approx(0.01, abs=1e-9)
    # one degree of freedom is the Cauchy distribution
    assert t_two_sided(1.0, 1) == pytest.approx(0.5)


def test_t_tail_of_huge_samples_is_normal():
    for df in (1e5, 2e5, 1e9, 1e11):
        assert float(t_two_sided(1.959963984540054, df)) == pytest.approx(0.05, abs=0.3 / df + 1e-9)


def test_quantiles_invert_the_tail():
    for df in (1, 2, 9, 30, 1e4, 1e8):
        q = t_quantile(0.975, df)
        assert float(t_two_sided(q, df)) == pytest.approx(0.05, abs=1e-9)
    assert t_quantiles(0.975, [4, 9]) == pytest.approx([2.7764451052, 2.2621571629])
    assert t_quantile(0.025, 9) == -t_quantile(0.975, 9)


def test_f_tail():
    # F(1, n) is the square of t(n)
    assert float(f_upper(2.2621571627**2, 1, 9)) == pytest.approx(0.05, abs=1e-9)
    # with endless denominator degrees, F(2, .) has tail exp(-f)
    assert float(f_upper(3.0, 2, 1e11)) == pytest.approx(np.exp(-3.0), rel=1e-4)


@given(st.floats(0.001, 0.999), st.floats(0.5, 50), st.floats(0.5, 50))
@settings(max_examples=60, deadline=None)
def test_incomplete_beta_symmetry(x, a, b):
    assert float(incomplete_beta(x, a, b) + incomplete_beta(1 - x, b, a)) == pytest.approx(1.0, abs=1e-9)


def test_normal_quantile():
    assert normal_quantile(0.975) == pytest.approx(1.959963984540054)


def test_hash_is_a_function_of_the_key(spark):
    df = spark.range(500)
    one = {r["id"]: r["b"] for r in df.repartition(1).select("id", hash_bits(7, "id").alias("b")).collect()}
    many = {r["id"]: r["b"] for r in df.repartition(8).select("id", hash_bits(7, "id").alias("b")).collect()}
    assert one == many
    assert one[3] == int(hashlib.md5(b"7|3").hexdigest()[:13], 16)
    mean = spark.range(20000).select(F.avg(hash01(1, "id"))).first()[0]
    assert mean == pytest.approx(0.5, abs=0.01)


def test_text(spark):
    df = spark.createDataFrame([(1, None)], "pre_a int, pre_b string")
    assert strip_prefix(df, "pre_").columns == ["a", "b"]
    assert df.select(paste(F.col("pre_a"), F.col("pre_b"), sep=",")).first()[0] == "1,NA"


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from foldspark.session import checkpoint_folder

    def session(master, warehouse, folder=None):
        conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": folder}
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *_: conf[name]), sparkContext=context)

    assert checkpoint_folder(session("local[8]", "file:/w")) == "file:/w-checkpoints"
    assert checkpoint_folder(session("yarn", "hdfs://n/w/")) == "hdfs://n/w-checkpoints"
    assert checkpoint_folder(session("yarn", "file:/w", "s3a://b/c/")) == "s3a://b/c"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="share"):
            checkpoint_folder(session("yarn", warehouse))


def test_normal_quantiles_of_a_column(spark):
    from statistics import NormalDist

    from foldspark.functions.distributions import normal_quantile_column

    grid = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.0751, 0.3, 0.5, 0.7, 0.9249, 0.9251, 0.999, 1 - 1e-12]
    rows = spark.createDataFrame([(p,) for p in [*grid, 0.0, 1.0, None]], "p double")
    got = [r[0] for r in rows.coalesce(1).select(normal_quantile_column(F.col("p"))).collect()]
    assert got[: len(grid)] == pytest.approx([NormalDist().inv_cdf(p) for p in grid], rel=1e-12, abs=1e-15)
    assert got[len(grid) :] == [None] * 3
