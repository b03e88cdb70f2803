"""Edge cases of cleaning, pair features, argument parsing, scaling and splitting."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from secflow.operators import cleaning, encoding, flow_features, scaling, splitting, tokens
from secflow.operators.ranking import exact_quantiles, hash_ranks

NAMES = ["spkts", "dpkts", "service", "state", "synack", "ct_src_dport_ltm", "ct_dst_sport_ltm",
         "ct_src_ltm", "ct_dst_ltm", "ct_dst_src_ltm", "ct_srv_src", "ct_srv_dst"]


def test_pairs_are_found_by_name():
    assert flow_features.find_pairs(NAMES) == {
        "spkts": "dpkts", "ct_src_dport_ltm": "ct_dst_sport_ltm", "ct_src_ltm": "ct_dst_ltm", "ct_srv_src": "ct_srv_dst",
    }


def test_pair_edge_values(spark):
    rows = [(1, 0.0, 0.0), (2, 0.0, 4.0), (3, 6.0, 3.0), (4, 5.0, 2.0)]
    df = flow_features.engineer_flows(spark.createDataFrame(rows, "row_id long, sload double, dload double"))
    got = {r["row_id"]: r for r in df.collect()}
    assert [got[i]["both_zero_sload_dload"] for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [got[i]["one_zero_sload_dload"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert [got[i]["is_integer_ratio_sload_dload"] for i in (1, 3, 4)] == [1, 1, 0]
    assert got[3]["ratio_sload_dload"] == 6 / (3 + 1e-6)
    assert got[2]["distance_sload_dload"] == pytest.approx(1, abs=1e-6)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1e9), st.floats(0, 1e9)), min_size=1, max_size=20))
def test_pair_identities(spark, values):
    df = flow_features.engineer_flows(spark.createDataFrame(values, "sload double, dload double"))
    for r in df.collect():
        s, d = r["sload"], r["dload"]
        assert math.isclose(r["ratio_sload_dload"] * (d + 1e-6), s, rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["distance_sload_dload"] <= 1
        assert r["both_zero_sload_dload"] + r["one_zero_sload_dload"] <= 1


def test_incomplete_rows_and_gaps(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, float("-inf"), None)]
    df = spark.createDataFrame(rows, "id long, x double, t string")
    assert [r["id"] for r in cleaning.drop_incomplete_rows(df).collect()] == [1]
    assert [(r["x"], r["t"]) for r in cleaning.fill_gaps(df).orderBy("id").collect()] == [(1.0, "a"), (0.0, "b"), (0.0, "c"), (0.0, "")]


def test_unknown_category(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "proto string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "proto string")
    codes = encoding.fit_codes(train, ["proto"])
    assert [r["proto"] for r in encoding.apply_codes(test, codes, ["proto"]).collect()].count(-1) == 2
    hot = encoding.one_hot_columns(test, codes, ["proto"])
    assert sorted(tuple(r) for r in hot.collect()) == [(0, 0), (0, 0), (1, 0)]
    model, outputs = encoding.fit_encoder(train.na.fill("b"), ["proto"])
    sums = [float(r[outputs[0]].toArray().sum()) for r in model.transform(test).collect()]
    assert sorted(sums) == [0.0, 0.0, 1.0]


ARGS = [
    ("[]", []),
    (None, []),
    ("[{'name': 'fd', 'type': 'int', 'value': 3}]", ["fd=3(int)"]),
    ("[{'name': 'fd', 'type': 'int', 'value': 3}, {broken", []),
    ("[{'name': 'p', 'type': 'str', 'value': None}]", ["p=None(str)"]),
    ("[{'name': 'addr', 'type': 'struct sockaddr*', 'value': {'sa_family': 'AF_UNSPEC'}}]",
     ["addr={'sa_family': 'AF_UNSPEC'}(struct sockaddr*)"]),
    ("[{'name': 'l', 'type': 'list', 'value': ['a', 'b']}]", ["l=['a', 'b'](list)"]),
    ('[{"name": "q", "type": "str", "value": "it\'s"}]', ["q=it's(str)"]),
    ("[{'name': 'd', 'type': 'str', 'value': 'a|||b'}]", ["d=a|||b(str)"]),
    ("[{'name': 'f', 'type': 'float', 'value': 1e3}]", ["f=1000.0(float)"]),
    ("[{'name': 'x', 'type': 'int'}]", []),
    ("not a list", []),
    ("{'name': 'x'}", []),
]


def test_arguments_parse_row_by_row(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ARGS)], "row_id long, args string")
    got = tokens.parse_args(df).withColumn("t", tokens.tokens_of(F.col("args"))).orderBy("row_id").collect()
    assert [r["t"] for r in got] == [want for _, want in ARGS]
    arrays = tokens.argument_arrays(tokens.parse_args(df)).orderBy("row_id").collect()
    assert arrays[2]["arg_names"] == ["fd"] and arrays[2]["args_str"] == "fd=3(int)" and arrays[0]["args_str"] == ""


def test_tfidf_rows_have_unit_length(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b"]), (3, ["a", "c"]), (4, ["z"])], "row_id long, tokens array<string>")
    vocabulary = tokens.fit_vocabulary(df, "tokens", min_df=1, max_df=1.0, max_features=3)
    assert [r["term"] for r in vocabulary.orderBy("index").collect()] == ["a", "b", "c"]
    norms = tokens.tfidf(df, "tokens", vocabulary).groupBy("row_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert {r["row_id"]: round(r["n"], 9) for r in norms} == {1: 1.0, 2: 1.0, 3: 1.0}


def test_scaling_skips_flags_and_few_valued(spark):
    rows = [(i, float(i), float(i % 2), 7.0, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, wide double, two double, constant double, x_flag double")
    assert scaling.columns_to_scale(df) == ["wide"]
    constant = scaling.fit_scaler(df, ["constant"]).transform(df)
    assert {r["constant"] for r in constant.collect()} == {0.0}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=3, max_size=60), st.integers(0, 3))
def test_split_sizes_are_exact(spark, labels, seed):
    df = spark.createDataFrame(list(enumerate(labels)), "row_id long, label int")
    out = splitting.stratified_split(df, "label", 0.5, seed=seed).collect()
    assert len(out) == len(labels)
    first = [r["label"] for r in out if r["split"] == "first"]
    assert len(first) in (len(labels) // 2, -(-len(labels) // 2))
    for c in set(labels):
        assert abs(first.count(c) - labels.count(c) / 2) < 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 1)), min_size=1, max_size=80))
def test_quantiles_match_numpy(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", {"a": 0.0, "b": 0.33, "c": 0.5, "d": 1.0}).head()
    want = np.percentile(values, [0, 33, 50, 100])
    assert list(got) == pytest.approx(list(want), abs=1e-6)


@pytest.mark.parametrize("seed", [0, 3])
def test_split_in_place_cuts_where_the_ranks_do(spark, seed):
    rows = [(i // (3 if i % 4 == 0 else 1) if i % 50 else None, "ab"[i % 5 == 0] if i % 31 else None) for i in range(2000)] + [(7_777_777, "a")] * 900 + [(5, "c")] * 6
    df = spark.createDataFrame(rows, "row_id long, label string")
    for size in (0.5, 0.13, 40, 0, 5000):
        want, got = (f(df, "label", size, seed=seed).groupBy("row_id", "label", "split").count().collect() for f in (splitting.stratified_split, splitting.split_in_place))
        assert sorted(map(str, got)) == sorted(map(str, want))
    plain = splitting.split_in_place(spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("label")), "label", 0.5, seed=seed)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plain.filter("split = 'first'").count() == 2500


def test_hash_ranks_cover_every_place(spark):
    df = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("g"))
    ranks = hash_ranks(df, "row_id", ["g"]).groupBy("g").agg(F.collect_set("rank").alias("r")).collect()
    assert all(sorted(r["r"]) == list(range(1, 251)) for r in ranks)
