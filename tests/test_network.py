"""Fits that cannot lose rows or fail silently, the dense network, parameters as chunk
rows, and mergeable moments."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediafeat.operators import network as N
from mediafeat.operators import train as TR

KIND = "id long, x array<double>, y array<double>"


def points(n=240, d=4, k=3, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = np.stack([(x[:, c % d] > 0.2 * c).astype(float) for c in range(k)], 1)
    return x, y


def table(spark, x, y):
    return spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))], KIND)


def flat(model):
    return np.concatenate([r.v for r in model.params.orderBy("chunk").collect()])


DAMAGED = [(1000, [1.0, None, 2.0, 3.0], [1.0, 0.0, 0.0]), (1001, [math.nan] * 4, [1.0, 0.0, 0.0]), (1002, [1.0], [1.0, 0.0, 0.0]),
           (1003, [1.0] * 4, [1.0, None, 0.0]), (1004, None, [1.0, 0.0, 0.0]), (1005, [1.0] * 4, None), (1006, [math.inf] * 4, [0.0] * 3),
           (1007, [], []), (1008, [1.0] * 4, [1.0])]
LEFT = {"null or non-finite element": 4, "other length": 3, "no vector or label": 2}


@pytest.mark.parametrize("first", [True, False])
def test_damaged_rows_are_counted_and_change_nothing(spark, first):
    x, y = points()
    clean = table(spark, x, y)
    bad = spark.createDataFrame(DAMAGED, KIND)
    both = (bad.union(clean) if first else clean.union(bad)).coalesce(1)
    want = TR.fit_multilabel(clean, "x", "y", "id", epochs=2, lr=0.5, n_partitions=2)
    got = TR.fit_multilabel(both, "x", "y", "id", epochs=2, lr=0.5, n_partitions=2)
    assert np.allclose(got.weights, want.weights) and np.abs(got.weights).max() > 0
    assert got.left_out == LEFT and want.left_out == {} and got.history[0]["n"] == len(x)
    net = [N.fit(t, "x", "y", "id", [5], epochs=2, lr=0.5, partitions=2) for t in (clean, both)]
    assert np.allclose(*map(flat, net)) and net[1].left_out == LEFT


def test_damaged_validation_rows_are_left_out(spark):
    x, y = points()
    clean, bad = table(spark, x, y), spark.createDataFrame(DAMAGED, KIND)
    a, b = (TR.fit_multilabel(clean, "x", "y", "id", epochs=2, lr=0.5, n_partitions=2, validation=v).history for v in (clean, clean.union(bad)))
    assert [h["val_loss"] for h in a] == pytest.approx([h["val_loss"] for h in b])


def test_a_fit_without_usable_rows_is_refused(spark):
    for rows in ([], [(1, None, None)], [(1, [None], [1.0])]):
        for fit in (TR.fit_multilabel, N.fit):
            with pytest.raises(ValueError, match="no training rows"):
                fit(spark.createDataFrame(rows, KIND), "x", "y", "id")


def test_a_step_that_is_not_finite_raises(spark):
    df = spark.createDataFrame([(i, [1e300, -1e300], [float(i % 2)]) for i in range(20)], KIND)
    with pytest.raises(FloatingPointError):
        TR.fit_multilabel(df, "x", "y", "id", epochs=3, lr=1e10, batch_size=4, n_partitions=2)
    with pytest.raises(FloatingPointError):
        N.fit(df, "x", "y", "id", [16], epochs=3, lr=1e10, batch_size=4, partitions=2)


def test_the_shape_is_the_most_frequent_one_or_the_one_given(spark):
    rows = [(i, [1.0, float(i)], [1.0]) for i in range(5)] + [(9, [1.0, 2.0, 3.0], [1.0])]
    df = spark.createDataFrame(rows, KIND)
    assert TR.input_shape(df) == (2, 1)
    assert TR.fit_multilabel(df, "x", "y", "id", epochs=1, n_partitions=1, shape=(3, 1)).weights.shape == (1, 4)


def test_gradient_is_the_slope_of_the_loss():
    x, y = points(40)
    layers = [4, 6, 5, 3]
    w = 0.3 * np.random.default_rng(0).normal(size=N.size(layers))
    g, _, _ = N.gradient(w, layers, x, y)
    e = 1e-6
    slope = [(N.gradient(w + e * u, layers, x, y)[1] - N.gradient(w - e * u, layers, x, y)[1]) / (2 * e * len(x)) for u in np.eye(len(w))]
    assert np.allclose(g, slope, atol=1e-5)


@pytest.mark.parametrize("chunk", [7, 4096])
def test_network_equals_plain_descent(spark, chunk):
    x, y = points()
    layers = [4, 6, 3]
    model = N.fit(table(spark, x, y), "x", "y", "id", [6], epochs=3, lr=0.8, batch_size=1 << 20, partitions=3, chunk=chunk)
    w = np.concatenate([r.v for r in N.initial(spark, layers, 7, chunk).orderBy("chunk").collect()])
    for h in model.history:
        g, loss, right = N.gradient(w, layers, x, y)
        assert (h["n"], h["loss"], h["accuracy"]) == (len(x), pytest.approx(loss / y.size), pytest.approx(right / len(x)))
        w = w - 0.8 * g
    assert np.allclose(flat(model), w)
    assert model.history[-1]["loss"] < model.history[0]["loss"]
    rows = model.weights().orderBy("layer", "out", "inp").collect()
    assert [r.w for r in rows] == pytest.approx(w.tolist())
    assert [(r.layer, r.out, r.inp) for r in rows] == [(k, o, i) for k, (a, b) in enumerate(zip(layers, layers[1:])) for o in range(b) for i in range(a + 1)]


def test_network_learns_what_a_linear_model_cannot(spark):
    x = np.random.default_rng(1).uniform(-1, 1, size=(800, 2))
    y = ((x[:, :1] * x[:, 1:]) > 0).astype(float)
    y = np.hstack([y, 1 - y])
    net = N.fit(table(spark, x, y), "x", "y", "id", [16], epochs=12, lr=1.0, batch_size=8, partitions=1)
    assert net.history[-1]["accuracy"] > 0.9


def test_scores_of_both_forms_and_of_odd_rows(spark):
    x, y = points(60)
    model = N.fit(table(spark, x, y), "x", "y", "id", [5], epochs=1, lr=0.5, partitions=2, chunk=9)
    odd = spark.createDataFrame([(900, None, 1), (901, [1.0], 1), (902, [1.0, None, 1.0, 1.0], 1), (903, [math.nan] * 4, 1)], "id long, x array<double>, p int")
    rows = table(spark, x, y).select("id", "x", F.lit(1).alias("p")).union(odd)
    a, b = ({r.id: r.s for r in model.score(rows, "x", "s", inline=f).collect()} for f in (True, False))
    assert a.keys() == b.keys() and len(a) == 64
    want = N.forward(flat(model), model.layers, x)[-1]
    assert all(np.allclose(a[i], want[i]) and np.allclose(b[i], want[i]) for i in range(60))
    assert all(a[i] is None and b[i] is None for i in (900, 901, 902, 903))


def test_one_id_for_half_of_the_rows_is_spread(spark):
    x, y = points(400)
    df = table(spark, x, y).withColumn("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")))
    whole = N.fit(df, "x", "y", "id", epochs=1, lr=0.5, batch_size=1 << 20, partitions=4)
    w, _, _ = N.gradient(np.zeros(15), [4, 3], x, y)
    assert np.allclose(flat(whole), -0.5 * w)


def test_moments_merge_pairwise(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [None if rng.random() < .1 else float(v) for v in rng.normal(1e6, 1, size=rng.integers(0, 9))]) for i in range(500)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(7)
    want = {r.pos: r for r in df.select(F.posexplode("v").alias("pos", "v")).groupBy("pos").agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.count("v").alias("n")).collect()}
    for chunk in (3, 4096):
        got = {r.pos: r for r in TR.feature_stats(df, "v", chunk).collect()}
        assert got.keys() == want.keys()
        for p, r in got.items():
            assert r.n == want[p].n and r["mean"] == pytest.approx(want[p]["mean"]) and r["std"] == pytest.approx(want[p]["std"], rel=1e-6)


def test_moments_of_little(spark):
    kind = "v array<double>"
    assert TR.feature_stats(spark.createDataFrame([], kind), "v").collect() == []
    got = TR.feature_stats(spark.createDataFrame([([1.0, None],)], kind), "v").orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, None, 1), (1, None, None, 0)]


def test_moments_move_a_row_for_each_task(spark):
    df = spark.range(5000, numPartitions=4).select(F.array(*[F.col("id") * k for k in range(50)]).cast("array<double>").alias("v"))
    plan = TR.feature_stats(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")       # exploded only after everything has merged
