import math

from pyspark.sql import functions as F

from mediafeat.operators import split as P


def _ids(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id"))


def _dev(df):
    return sorted(r["id"] for r in df.where("split = 'dev'").collect())


def test_exact_size_and_repeatable(spark):
    df = _ids(spark, 1000)
    a = P.split_holdout(df, "id", 0.2, 3)
    assert a.where("split = 'dev'").count() == 200
    assert _dev(a) == _dev(P.split_holdout(df, "id", 0.2, 3))
    assert _dev(a) != _dev(P.split_holdout(df, "id", 0.2, 4))


def test_ratio_zero_and_one_row(spark):
    assert P.split_holdout(_ids(spark, 50), "id", 0.0, 1).where("split = 'dev'").count() == 1
    one = P.split_holdout(_ids(spark, 1), "id", 0.2, 1).collect()
    assert [r["split"] for r in one] == ["dev"]


def test_dev_are_largest_keys(spark):
    df = _ids(spark, 300)
    keyed = df.withColumn("k", P.shuffle_key("id", 9)).collect()
    want = sorted(sorted(keyed, key=lambda r: r["k"])[-60:], key=lambda r: r["id"])
    assert _dev(P.split_holdout(df, "id", 0.2, 9)) == sorted(r["id"] for r in want)


def test_kth_largest_multi_level(spark):
    df = _ids(spark, 5000).withColumn("k", P.shuffle_key("id", 1))
    keys = sorted((r["k"] for r in df.collect()), reverse=True)
    for k in (1, 17, 2500, 5000):
        assert P.kth_largest_key(df, "k", k, direct_limit=3) == keys[k - 1]
    assert P.kth_largest_key(df, "k", 5001) is None


def test_split_check_and_union(spark):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 5).alias("g"))
    s = P.split_holdout(df, "id", 0.25, 2)
    tr, dv = s.where("split='train'").drop("split"), s.where("split='dev'").drop("split")
    got = {r["m"]: r["v"] for r in P.split_check(df, tr, dv).collect()}
    assert got == {"n_full": 400, "n_train": 300, "n_dev": 100, "n_both": 0, "n_lost": 0, "n_extra": 0}
    assert P.union_all([tr, dv]).count() == 400


def test_chunks_follow_ceil_rule(spark):
    items = spark.createDataFrame([(f"s{i:02d}",) for i in range(10)], "shard string")
    got = [r["chunk"] for r in P.chunk_assignment(items, "shard", 4).orderBy("shard").collect()]
    step = math.ceil(10 / 4)
    assert got == [i // step for i in range(10)]
    assert max(got) == 3


def test_limit_per_group_plan(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    out = P.limit_per_group(df, "g", ["id"], 5)
    assert out.count() == 15
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_shard_filters_prune_partitions(spark):
    from mediafeat.session import scratch_path
    path = scratch_path(spark, "t_layout")
    spark.range(60).select("id", F.concat(F.lit("s"), (F.col("id") % 6).cast("string")).alias("shard")) \
        .write.partitionBy("shard").parquet(path)
    df = spark.read.parquet(path)
    for out in (P.exclude_values(df, "shard", ["s1", "s2"]), P.limit_values(df, "shard", 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "shard" in filters and "IN" in filters.upper()
    assert sorted({r["shard"] for r in P.limit_values(df, "shard", 2).collect()}) == ["s0", "s1"]
    assert P.exclude_values(df, "shard", ["s1", "s2"]).count() == 40


def test_reuse_checkpoints_only_large_inputs(spark):
    from mediafeat.operators.parallel import reuse
    df = spark.range(1000)
    assert reuse(df) is df                      # small: recompute
    big = reuse(df, threshold=1)                # forced: written once, same rows
    assert big is not df and big.count() == 1000
    assert "ExistingRDD" in big._jdf.queryExecution().optimizedPlan().toString() or \
        "LogicalRDD" in big._jdf.queryExecution().optimizedPlan().toString()


def test_null_ids_are_train_and_many_rows_of_one_id_need_no_top_k(spark):
    df = spark.createDataFrame([(None,)] * 5 + [("a",)] * 300 + [("b",)], "id string")
    got = {(r["id"], r["split"]): r["count"] for r in P.split_holdout(df, "id", 0.2, 3).groupBy("id", "split").count().collect()}
    assert got[(None, "train")] == 5 and sum(got.values()) == 306
    keys = df.where("id = 'a'").withColumn("k", P.shuffle_key("id", 3))
    assert P.kth_largest_key(keys, "k", 150, direct_limit=10) == keys.first()["k"]


def test_limit_per_group_beyond_the_optimizers_threshold(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    out = P.limit_per_group(df, "g", ["o"], 1500)
    assert out.count() == 3000 and out.agg(F.max("o")).first()[0] == 2999


def test_a_null_name_takes_no_place(spark, monkeypatch):
    df = spark.createDataFrame([(i, [None, "s0", "s1", "s2"][i % 4]) for i in range(40)], "id long, shard string")
    for most in (10_000, 1):                    # a literal list, and a semi-join
        monkeypatch.setattr(P, "INLINE_VALUES", most)
        assert sorted({r["shard"] for r in P.limit_values(df, "shard", 2).collect()}) == ["s0", "s1"]
        assert P.limit_values(df, "shard", 2).count() == 20 and P.limit_values(df, "shard", 9).count() == 30
