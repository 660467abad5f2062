import hashlib
import math

import re

import pytest
from pyspark.sql import functions as F

from sqlyard.operators import profile, sampling

import numpy as np
import pandas as pd


def digest(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(5000).select(F.col("id").alias("ex_id"), F.lit("x").alias("body")).repartition(7)


def test_split_is_stable_and_near_its_share(spark, keyed):
    rows = {r["ex_id"]: r["split"] for r in sampling.train_test_split(keyed).collect()}
    again = {r["ex_id"]: r["split"] for r in sampling.train_test_split(keyed.repartition(3)).collect()}
    assert rows == again
    assert {k for k, v in rows.items() if v == "test"} == {
        k for k in range(5000) if int(digest(42, k)[:8], 16) < 0.1 * 2 ** 32
    }
    assert 400 < sum(v == "test" for v in rows.values()) < 600
    assert {r["split"] for r in sampling.train_test_split(keyed, 0.0).collect()} == {"train"}
    assert {r["split"] for r in sampling.train_test_split(keyed, 1.0).collect()} == {"test"}
    other = {r["ex_id"]: r["split"] for r in sampling.train_test_split(keyed, seed=7).collect()}
    assert other != rows


@pytest.mark.parametrize("caps", [{"train": 100, "test": 20}, {"train": 1}, {"train": 0, "test": 10 ** 9}, {"test": 499}, {}])
def test_caps_against_a_sort(keyed, caps):
    split = sampling.train_test_split(keyed)
    got = {}
    for r in sampling.cap_splits(split, caps).collect():
        got.setdefault(r["split"], set()).add(r["ex_id"])
    for name in ("train", "test"):
        keys = [r["ex_id"] for r in split.where(F.col("split") == name).collect()]
        want = sorted(keys, key=lambda k: (digest(42, k), k))[:caps.get(name, len(keys))]
        assert got.get(name, set()) == set(want)


def test_caps_when_one_prefix_holds_many_keys(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_BUCKET_DIGITS", 1)
    rows = spark.range(300).select(F.col("id").alias("ex_id"), F.lit("train").alias("split"))
    order = sorted(range(300), key=lambda k: (digest(42, k), k))
    for size in (1, 17, 18, 150, 299, 300, 301):
        got = {r["ex_id"] for r in sampling.cap_splits(rows, {"train": size}).collect()}
        assert got == set(order[:size])


@pytest.mark.parametrize("test_size", [0.0, 0.1, 0.33333, 1.0])
def test_exact_split(keyed, test_size):
    got = {r["ex_id"] for r in sampling.exact_split(keyed, test_size).collect() if r["split"] == "test"}
    order = sorted(range(5000), key=lambda k: (digest(42, k), k))
    assert got == set(order[:math.ceil(5000 * test_size)])
    assert sampling.exact_split(keyed, test_size).count() == 5000


@pytest.mark.parametrize("fan_in", [1, 2, 1024])
def test_first_rows(keyed, fan_in):
    got = [r["ex_id"] for r in sampling.first_rows(keyed, 25, F.desc("ex_id"), fan_in=fan_in).collect()]
    assert got == list(range(4999, 4974, -1))
    assert sampling.first_rows(keyed, 9999, "ex_id", fan_in=fan_in).count() == 5000


def test_sample_and_row(keyed):
    got = [r["ex_id"] for r in sampling.random_sample(keyed, 5, "ex_id").collect()]
    assert got == sorted(range(5000), key=lambda k: digest(42, k))[:5]
    assert sampling.row_at(keyed, 42).first()["ex_id"] == 42


@pytest.mark.parametrize("values", [[3], [5, 5, 5], [1, 2], list(range(0, 121)), [7, 7, 9, 1000, 13, 12, 400] * 3])
def test_profile_and_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([("x" * v, None if i % 2 else "y") for i, v in enumerate(values)], "a string, b string")
    lengths = profile.text_lengths(df, {"a_len": "a", "b_len": "b"})
    want = pd.Series(values).describe()
    got = {r["metric"]: r for r in profile.length_profile(lengths, places=None).collect()}["a_len"]
    for name, label in (("count", "count"), ("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert got[name] == pytest.approx(want[label])
    assert (got["std"] is None) if len(values) == 1 else got["std"] == pytest.approx(want["std"], abs=1e-9)
    counts, edges = np.histogram(values, bins=60)
    bins = {r["bin"]: r for r in profile.length_histogram(lengths).collect() if r["metric"] == "a_len"}
    assert {b: r["n"] for b, r in bins.items()} == {i: c for i, c in enumerate(counts) if c}
    for b, r in bins.items():
        assert (r["bin_from"], r["bin_to"]) == pytest.approx((edges[b], edges[b + 1]))


def test_profile_rounds_as_shown(spark):
    df = spark.createDataFrame([("x" * v,) for v in (1, 2, 4, 9)], "a string")
    row = profile.length_profile(profile.text_lengths(df, {"a": "a"})).first()
    assert (row["mean"], row["p25"], row["p50"], row["std"]) == (4.0, 2.0, 3.0, 4.0)


@pytest.mark.parametrize("n", [0, 1, 7, 500, 5000, 10**9])
def test_first_by_key(spark, n):
    keys = [(k * 7919) % 6007 - 3000 for k in range(6000)] + [2**62, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(k, f"row {k}") for k in keys] + [(None, "none")], "ex_id long, wide string").repartition(3)
    found = sampling.first_by_key(rows, n)
    assert sorted(r["ex_id"] for r in found.collect()) == sorted(keys)[:n]


def test_first_by_key_with_ties(spark):
    rows = spark.createDataFrame([(k // 4, f"{k}") for k in range(40)], "ex_id int, w string").repartition(3)
    for n in (1, 4, 6, 39, 40, 41):
        found = sampling.first_by_key(rows, n).collect()
        assert sorted(r["ex_id"] for r in found) == sorted(k // 4 for k in range(40))[:n] and len({r["w"] for r in found}) == min(n, 40)


def test_first_by_key_moves_no_wide_row(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("ex_id"), F.lit("x").alias("wide")).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    plans = [sampling.first_by_key(rows, n)._jdf.queryExecution().optimizedPlan().toString() for n in (500, 5000)]
    shape = [re.sub(r"#\d+L?|\d+", "", p) for p in plans]
    assert shape[0] == shape[1] and "Sort" not in plans[0].split("Union")[-1].split("Filter")[0]
