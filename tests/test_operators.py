"""Distributed statistics, encodings, lag, time split: checked against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandflow.operators import encode as E
from demandflow.operators import lag as L
from demandflow.operators.documented import rolling_previous
from demandflow.operators.split import time_blocks
from demandflow.operators.stats import exact_quantiles, mode_of, ordered_row_number, quantile_frame


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 3000), "v": np.round(rng.exponential(1, 3000), 3)})
    pdf.loc[pdf.index[:1000], "v"] = 0.5  # one value holds a third of the rows
    df = spark.createDataFrame(pdf).repartition(9)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for accuracy in (100_000, 300, 40):  # wide brackets, narrow ones, brackets that the sketch misses by some ranks
        got = exact_quantiles(df, "v", probs, accuracy=accuracy).toPandas().iloc[0].to_numpy()
        assert np.array_equal(got, pdf["v"].quantile(probs).to_numpy())
        grp = exact_quantiles(df, "v", probs, by=["g"], accuracy=accuracy).toPandas().sort_values("g")
        exp = pdf.groupby("g")["v"].quantile(probs).unstack().to_numpy()
        assert np.array_equal(grp.drop(columns="g").to_numpy(), exp)


def test_exact_quantiles_of_small_groups_nulls_and_nothing(spark):
    rng = np.random.default_rng(8)
    sizes = [1, 2, 3, 4, 5, 7, 10, 31]
    pdf = pd.DataFrame({"g": np.repeat(np.arange(len(sizes)), sizes), "v": rng.integers(-5, 6, sum(sizes)).astype(float)})
    probs = [0.0, 0.1, 0.3, 0.5, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), "v", probs, by=["g"], max_groups=8).toPandas().sort_values("g")
    assert np.array_equal(got.drop(columns="g").to_numpy(), pdf.groupby("g")["v"].quantile(probs).unstack().to_numpy())
    nulls = spark.createDataFrame([(1, None), (2, None)], "a int, v double")
    assert [tuple(r) for r in exact_quantiles(nulls, "v", [0.5, 0.9]).collect()] == [(None, None)]
    assert quantile_frame(nulls, {"v": {"m": 0.5}, "a": {"lo": 0.0, "hi": 1.0}}).first() == (None, 1.0, 2.0)


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert mode_of(df, "x").first()[0] == "a"


def test_row_number_in_order(spark):
    pdf = pd.DataFrame({"t": np.repeat(np.arange(10), 50), "i": np.random.default_rng(1).permutation(500)})
    for parts in (None, 1, 37):
        out = ordered_row_number(spark.createDataFrame(pdf), ["t", F.col("i").desc()], partitions=parts).toPandas()
        out = out.sort_values(["t", "i"], ascending=[True, False]).reset_index(drop=True)
        assert (out["row_num"].to_numpy() == np.arange(500)).all()


def test_row_number_cuts_a_hot_key_and_takes_no_window_over_rows(spark):
    df = spark.range(0, 3000, 1, 7).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("t"), "id")
    out = ordered_row_number(df, ["t", "id"], partitions=40)
    got = [r.row_num for r in out.orderBy("t", "id").collect()]
    assert got == list(range(3000))
    at = out.withColumn("p", F.floor(F.col("row_num") / 100)).where("t = 5").select("p").distinct().count()
    assert at >= 20  # two thirds of the rows share t = 5
    assert ordered_row_number(df.limit(0), ["t", "id"]).count() == 0


def test_codes_of_several_columns_follow_first_appearance(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"Index": np.arange(200), "time_order": rng.integers(0, 50, 200), "a": rng.choice(list("pqrs") + [None], 200), "b": rng.choice(list("xyz"), 200)})
    fut = pd.DataFrame({"Index": np.arange(300, 310), "time_order": 0, "a": ["new", "p"] * 5, "b": ["x", "later"] * 5})
    h, f = E.label_encode(spark.createDataFrame(pdf), spark.createDataFrame(fut), ["a", "b"])
    h, f = h.toPandas().set_index("Index"), f.toPandas().set_index("Index")
    order = pdf.sort_values(["time_order", "Index"])
    for c in ("a", "b"):
        seen = {}
        for v in [*order[c].where(order[c].notna(), "nan"), *fut[c]]:
            seen.setdefault(v, len(seen))
        assert h[c].to_dict() == {i: seen["nan" if v is None or v != v else v] for i, v in zip(pdf["Index"], pdf[c])}
        assert f[c].to_dict() == {i: seen[v] for i, v in zip(fut["Index"], fut[c])}


def left_out_value(rows, row, m, g):
    """A row's encoding by definition: targets of the same key in the other folds, with m more of value g."""
    seen = [r["demand"] for r in rows if r["k"] == row["k"] and r["fold"] != row["fold"] and r["demand"] is not None] if row["k"] is not None else []
    return (sum(seen) + m * g) / (len(seen) + m)


def test_oof_closed_form_matches_fold_loop(spark):
    rng = np.random.default_rng(7)
    n = 400
    pdf = pd.DataFrame({"Index": np.arange(n), "k": rng.choice(list("abcdefg") + [None], n),
                        "demand": rng.random(n)})
    pdf.loc[pdf.index[-1], "k"] = "only_here"  # key seen in one fold only
    pdf["fold"] = pdf["Index"] % 5
    g = pdf["demand"].mean()
    hist = spark.createDataFrame(pdf)
    fut = spark.createDataFrame(pd.DataFrame({"Index": [1000, 1001], "k": ["a", "unseen"]}))
    h, f = E.target_encode(hist, fut, ["k"], "te", 10, g)
    got = h.orderBy("Index").toPandas()["te"].to_numpy()
    rows = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
    assert np.allclose(got, [left_out_value(rows, r, 10, g) for r in rows], rtol=0, atol=1e-12)
    fr = {r.Index: r.te for r in f.collect()}
    st = pdf.groupby("k")["demand"].agg(["sum", "count"])
    assert abs(fr[1000] - (st.loc["a", "sum"] + 10 * g) / (st.loc["a", "count"] + 10)) < 1e-12
    assert fr[1001] == g


def test_lag_missing_and_duplicates(spark):
    h = spark.createDataFrame([(1, "g1", 48, "8:0", 0.5), (2, "g1", 49, "8:0", 0.7), (3, "g2", 49, "8:0", 0.1)],
                              "Index long, geohash string, day int, timestamp string, demand double")
    out = {r.Index: r.lag_demand_1d for r in L.with_lag(h, h).collect()}
    assert out == {1: None, 2: 0.5, 3: None}
    dup = h.unionByName(h.where(F.col("Index") == 1))
    assert L.with_lag(h, dup).count() == 4  # a duplicated lookup key multiplies rows


def test_bucketed_lag_reads_without_a_shuffle(spark, tmp_path):
    rng = np.random.default_rng(2)
    cells = [(d, f"g{i}", f"{t}:0") for d in (48, 49) for i in range(20) for t in range(10) if rng.random() < 0.7]
    obs = spark.createDataFrame([(i, *c, float(i)) for i, c in enumerate(cells)], "Index long, day int, geohash string, timestamp string, demand double")
    layout = L.lag_layout(obs, str(tmp_path), 6)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as tables too large to broadcast are joined
        lagged, pairs = L.with_bucketed_lag(*layout), L.bucketed_day_pairs(*layout)
        for out in (lagged, pairs):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, lagged.select("Index", "lag_demand_1d").collect())) == sorted(map(tuple, L.with_lag(obs, obs).select("Index", "lag_demand_1d").collect()))
        assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, L.day_pairs(obs).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_time_split_blocks(spark):
    n = 103  # not divisible by k+1
    pdf = pd.DataFrame({"Index": np.arange(n), "time_order": np.arange(n) // 7})  # ties inside slots
    b = time_blocks(spark.createDataFrame(pdf), 3).toPandas().sort_values(["time_order", "Index"])
    t = n // 4
    expected = [-1] * (n - 3 * t) + [0] * t + [1] * t + [2] * t
    assert b["block"].tolist() == expected


def test_rolling_previous_matches_window(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"Index": np.arange(n), "geohash": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]),
                        "time_order": rng.permutation(n), "demand": np.round(rng.random(n), 4)})
    pdf["day"] = pdf["time_order"] // 96
    got = rolling_previous(spark.createDataFrame(pdf), chunk=7).toPandas().set_index("Index").sort_index()  # locations span chunks
    whole = rolling_previous(spark.createDataFrame(pdf)).toPandas().set_index("Index").sort_index()
    assert got.equals(whole)
    s = pdf.sort_values(["time_order", "Index"])
    prev = s.groupby("geohash")["demand"].transform(lambda x: x.shift(1).rolling(3, min_periods=1).mean())
    exp = prev.reindex(got.index)
    assert np.allclose(got["rolling_mean_3"].to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)
    std = s.groupby("geohash")["demand"].transform(lambda x: x.shift(1).rolling(3, min_periods=2).std()).reindex(got.index)
    assert np.allclose(got["rolling_std_3"].to_numpy(dtype=float), std.to_numpy(dtype=float), equal_nan=True)
    assert "chunk" not in got.columns and len(got) == n


def test_null_keys_and_targets_agree_in_both_encoders(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), None if i % 11 == 0 else float(rng.random()), i % 5) for i in range(200)]
    rows = [(i, None if k is None else str(k), None if j is None else str(j), d, f) for i, k, j, d, f in rows]
    hist = spark.createDataFrame(rows, "Index long, k string, j string, demand double, fold int")
    fut = hist.select("Index", "k", "j")
    spec = [("te_k", ["k"], 10), ("te_kj", ["k", "j"], 5)]
    h, f = E.encode_all(hist, fut, spec)
    all_h, all_f = {r.Index: r for r in h.collect()}, {r.Index: r for r in f.collect()}
    known = [d for *_, d, _ in rows if d is not None]
    g = sum(known) / len(known)
    for name, keys, m in spec:
        one, one_f = E.target_encode(hist, fut, keys, name, m, g)
        one, one_f = {r.Index: r for r in one.collect()}, {r.Index: r for r in one_f.collect()}
        for i, k, j, _, fold in rows:
            key = k if len(keys) == 1 else (k or "nan", j or "nan")
            same = [r for r in rows if (r[1] if len(keys) == 1 else (r[1] or "nan", r[2] or "nan")) == key and key is not None and r[3] is not None]
            for got, others in ((all_h[i], [r[3] for r in same if r[4] != fold]), (one[i], [r[3] for r in same if r[4] != fold]), (all_f[i], [r[3] for r in same]), (one_f[i], [r[3] for r in same])):
                assert abs(got[name] - (sum(others) + m * g) / (len(others) + m)) < 1e-9


def test_hash_folds_spread_ids(spark):
    folds = spark.range(5000).select(E.fold_id("id", 5, "hash").alias("f")).groupBy("f").count().collect()
    assert sorted(r.f for r in folds) == list(range(5)) and all(900 < r["count"] < 1100 for r in folds)


def test_rolling_keeps_full_precision(spark):
    from demandflow.operators.documented import rolling_previous
    values = [1e-9, 2e-9, 3e-9, 0.0]
    df = spark.createDataFrame([(i, "a", 1, i, v) for i, v in enumerate(values)], "Index long, geohash string, day int, time_order int, demand double")
    last = {r.Index: r for r in rolling_previous(df).collect()}[3]
    assert abs(last.rolling_mean_3 - 2e-9) < 1e-20 and abs(last.rolling_std_3 - 1e-9) < 1e-20


def test_lanes_median_may_be_fractional(spark):
    from demandflow.operators import clean as C
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "NumberofLanes int").selectExpr("NumberofLanes", "1.0D as Temperature", "'r' as RoadType", "'w' as Weather")
    st = C.TrainStats(1.0, "r", "w", 2.5, 1, 0.0, 1.0, {})
    assert sorted(r.NumberofLanes for r in C.impute(df, st).collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_search_draws_and_rescaling(spark):
    from demandflow.plans import models as M
    for kind, ranges in M.RANGES.items():
        draws = M.sample_params(kind, 20, 1)
        assert draws == M.sample_params(kind, 20, 1) and ("stepSize" in ranges) == (kind != "random_forest")
        for d in draws:
            assert set(d) == {"trial", *ranges} and all(lo <= d[k] <= hi for k, (lo, hi) in ranges.items())
            M.estimator(kind, 1, d["maxIter"], 32, **{k: v for k, v in d.items() if k not in ("trial", "maxIter")})
    params = spark.createDataFrame([("gbt_categorical", 10, 0.2), ("random_forest", 10, None)], "model string, maxIter int, stepSize double")
    got = {(r.model): (r.maxIter, r.stepSize) for r in M.rescale_params(params, "v2").collect()}
    assert got == {"gbt_categorical": (25, 0.1), "random_forest": (20, None)}


def test_blend_weights_saved_default_or_error(spark):
    from demandflow.operators import score as S
    preds = spark.createDataFrame([(1, "a", 2.0), (1, "b", 4.0)], "Index long, model string, prediction double")
    saved = S.weights_frame(spark, {"a": 0.5})
    assert S.blend(preds, saved, {"a": 0.1, "b": 0.25}).first().demand == 2.0
    with pytest.raises(Exception, match="no weight for model b"):
        S.blend(preds, saved).collect()


def history_rows(n, seed, hot=0.9):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"Index": np.arange(n), "road": np.where(rng.random(n) < hot, "Residential", rng.choice(list("abcd"), n)),
                        "cell": rng.choice([f"c{i}" for i in range(40)], n), "time_order": rng.integers(0, 50, n), "demand": np.round(rng.random(n), 6)})
    pdf["road"] = pdf["road"].astype(object).where(rng.random(n) > 0.05, None)
    pdf.loc[pdf.index[::17], "demand"] = np.nan
    return pdf.astype(object).where(pdf.notna(), None)


SPEC = [("te_road", ["road"], 50), ("te_cell", ["cell"], 10), ("te_both", ["road", "cell"], 5)]
HISTORY_SCHEMA = "Index long, road string, cell string, time_order int, demand double"


def test_encodings_are_the_same_however_they_are_joined(spark):
    pdf = history_rows(900, 2)
    h = E.with_fold(spark.createDataFrame(pdf.values.tolist(), HISTORY_SCHEMA))
    f = spark.createDataFrame([(5000, "Residential", "c1"), (5001, "never", "c2"), (5002, None, "c3")], "Index long, road string, cell string")
    sides = []
    for limit in (E.BROADCAST_MAX_BYTES, 0):
        a, b = E.encode_all(h, f, SPEC, frequency=("freq", 1), limit=limit)
        sides.append((sorted(map(tuple, a.select("Index", "te_road", "te_cell", "te_both", "freq").collect())), sorted(map(tuple, b.select("Index", "te_road", "te_cell", "te_both", "freq").collect()))))
    assert sides[0] == sides[1]
    counts = pdf["cell"].value_counts()
    assert {i: v for i, *_, v in sides[0][0]} == {r.Index: counts[r.cell] / 900 for r in pdf.itertuples()}


def test_a_hot_key_does_not_go_through_the_join_that_shuffles(spark):
    h = E.with_fold(spark.createDataFrame(history_rows(900, 2).values.tolist(), HISTORY_SCHEMA))
    tables, info = E.encoding_tables(h, SPEC)
    lookup = tables.where("enc = 0").select("key", E.from_all(F.lit(50.0), 0.5).alias("value"), F.col("r").alias("rows"))
    plan = E.attach(h, lookup, ["road"], "v", size=10**9, total=900, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "(rows" not in plan
    small = E.attach(h, lookup, ["road"], "v", size=10, total=900)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in small and "hashpartitioning" not in small.split("BroadcastHashJoin")[-1].split("BroadcastExchange")[0]
    hot = lookup.where(F.col("rows") * 8 > 900).collect()
    assert [r.key for r in hot] == [["Residential"]]


def blocked_rows(n=600, seed=6):
    pdf = history_rows(n, seed)
    order = pdf.sort_values(["time_order", "Index"]).index
    t = n // 4
    pdf.loc[order, "block"] = [-1] * (n - 3 * t) + [0] * t + [1] * t + [2] * t
    pdf["fold"] = pdf["Index"].astype(int) % 5
    return pdf


def test_prefix_encodings_by_definition(spark):
    pdf = blocked_rows()
    rows = pdf.to_dict("records")
    df = spark.createDataFrame(pdf[["Index", "road", "cell", "demand", "block", "fold"]].values.tolist(), "Index long, road string, cell string, demand double, block double, fold long") \
        .withColumn("block", F.col("block").cast("int"))
    for limit in (E.BROADCAST_MAX_BYTES, 0):
        got = {(r.Index, r.cv): r for r in E.prefix_encodings(df, SPEC, limit=limit).collect()}
        assert {(r["Index"], c) for r in rows for c in range(3) if r["block"] <= c} == set(got)
        for r in rows[::7]:
            for c in range(3):
                if r["block"] > c:
                    continue
                train = [x for x in rows if x["block"] < c and x["demand"] is not None]
                g = sum(x["demand"] for x in train) / len(train)
                out = got[r["Index"], c]
                assert out.role == ("train" if r["block"] < c else "test")
                others = train if out.role == "test" else [x for x in train if x["fold"] != r["fold"]]
                for name, keys, m in SPEC:
                    part = lambda x, k: x[k] if len(keys) == 1 else (x[k] or "nan")  # noqa: E731, B023
                    key = [part(r, k) for k in keys]
                    same = [x["demand"] for x in others if None not in key and [part(x, k) for k in keys] == key]
                    assert abs(out[name] - (sum(same) + m * g) / (len(same) + m)) < 1e-9


def test_later_targets_change_no_earlier_encoding(spark):
    pdf = blocked_rows()
    changed = pdf.copy()
    changed.loc[pdf["block"] >= 1, "demand"] = 99.0
    out = []
    for frame in (pdf, changed):
        df = spark.createDataFrame(frame[["Index", "road", "cell", "demand", "block", "fold"]].values.tolist(), "Index long, road string, cell string, demand double, block double, fold long") \
            .withColumn("block", F.col("block").cast("int"))
        out.append({(r.Index, r.cv): (r.te_road, r.te_cell, r.te_both) for r in E.prefix_encodings(df, SPEC).collect()})
    assert {k: v for k, v in out[0].items() if k[1] <= 1} == {k: v for k, v in out[1].items() if k[1] <= 1}
    assert {k: v for k, v in out[0].items() if k[1] == 2} != {k: v for k, v in out[1].items() if k[1] == 2}


def test_shuffled_folds_are_even_and_repeatable(spark):
    for n in (0, 1, 4, 5, 103):
        df = spark.range(n).withColumnRenamed("id", "Index")
        sizes = [r["count"] for r in E.with_fold(df, method="shuffled").groupBy("fold").count().collect()]
        assert sum(sizes) == n and (not sizes or max(sizes) - min(sizes) <= 1) and len(sizes) == min(n, 5)
    a = sorted(map(tuple, E.with_fold(df, method="shuffled").collect()))
    assert a == sorted(map(tuple, E.with_fold(df.repartition(7), method="shuffled").collect())) and a != sorted(map(tuple, E.with_fold(df).collect()))


def test_prefix_encodings_look_a_row_up_before_it_is_dealt(spark):
    """A lookup meets each row once, not once a fold: no join lies above the explode of folds."""
    pdf = blocked_rows()
    df = spark.createDataFrame(pdf[["Index", "road", "cell", "demand", "block", "fold"]].values.tolist(), "Index long, road string, cell string, demand double, block double, fold long") \
        .withColumn("block", F.col("block").cast("int"))
    plan = E.prefix_encodings(df, SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join LeftOuter")  # printed from the top
