from pyspark.sql import functions as F

from mediafeat.operators import metrics as M

# the published scaling table (fixed values from the baseline)
NODES = [1, 2, 4, 8, 15]
BATCH = [89, 36, 33, 30, 27]
EPOCH = [82, 30, 13, 9.3, 3.5]


def test_speedup_reproduces_published(spark):
    rows = [("batch", n, float(t)) for n, t in zip(NODES, BATCH)] + [("epoch", n, float(t)) for n, t in zip(NODES, EPOCH)]
    df = spark.createDataFrame(rows, "mode string, nodes int, minutes double")
    s = M.efficiency(M.speedup(df, "mode", ["nodes"], "minutes"), "speedup", "nodes")
    got = {(r["mode"], r["nodes"]): round(r["speedup"], 2) for r in s.collect()}
    assert got[("batch", 2)] == 2.47 and got[("batch", 15)] == 3.30
    assert got[("epoch", 4)] == 6.31 and got[("epoch", 15)] == 23.43
    eff = {(r["mode"], r["nodes"]): r["efficiency"] for r in s.collect()}
    assert eff[("batch", 1)] == 1.0


def test_early_stopping_literal(spark):
    h = spark.createDataFrame([("r", e, v) for e, v in [(1, 5.0), (2, 4.0), (3, 4.5), (4, 4.2), (5, 4.1), (6, 3.0)]],
                              "run string, epoch int, loss double")
    r = M.early_stopping(h, "run", "epoch", "loss", 3).first()
    assert (r["stop_epoch"], r["best_epoch"], r["best_loss"], r["n_saved"]) == (5, 2, 4.0, 2)


def test_never_stops_runs_to_end(spark):
    h = spark.createDataFrame([("r", e, 10.0 - e) for e in range(1, 8)], "run string, epoch int, loss double")
    r = M.early_stopping(h, "run", "epoch", "loss", 3).first()
    assert (r["stop_epoch"], r["best_epoch"], r["n_saved"]) == (7, 7, 7)


def test_accuracy_first_max_and_zero_target(spark):
    df = spark.createDataFrame([([0.0, 1.0, 0.0], [0.1, 0.9, 0.9]), ([0.0, 0.0, 0.0], [0.5, 0.2, 0.5]),
                                ([1.0, 0.0, 0.0], [0.1, 0.8, 0.1])], "y array<double>, s array<double>")
    r = M.topclass_accuracy(df, "y", "s").first()
    assert (r["n"], r["correct"]) == (3, 2)


def test_crossentropy_uniform(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0, 1.0, 1.0])], "c int, s array<double>")
    r = M.categorical_crossentropy(df, "c", "s").first()
    assert abs(r["loss"] - 1.386294) < 1e-6


def test_early_stopping_hot_run_matches_plain(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("run"),
        F.col("id").alias("t"), ((F.col("id") * 7919) % 1000 / 10.0 - F.col("id") / 600.0).alias("loss"))
    h = rows.withColumn("epoch", F.row_number().over(Window.partitionBy("run").orderBy("t")))
    plain = M.early_stopping(h, "run", "epoch", "loss", 3, hot_rows=10**9)
    split = M.early_stopping(h, "run", "epoch", "loss", 3, hot_rows=500, blocks=8)
    assert plain.count() == 41
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_running_stats_blocked_equal_plain(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from mediafeat.operators import ordering as O
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"),
                                  ((F.col("id") * 31) % 97).alias("v"))
    t, hot = O.with_blocks(df, ["g"], ["o"], hot_rows=100, blocks=6)
    assert hot
    for fn in ("min", "max", "sum", "count"):
        for ex in (True, False):
            a = O.running(t, ["g"], ["o"], "v", fn, "r", exclusive=ex, blocked=True).select("o", "r")
            b = O.running(t, ["g"], ["o"], "v", fn, "r", exclusive=ex, blocked=False).select("o", "r")
            assert a.exceptAll(b).count() == 0, (fn, ex)
