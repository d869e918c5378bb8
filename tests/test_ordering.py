from pyspark.sql import Window
from pyspark.sql import functions as F

from mediafeat.operators.ordering import number_rows


def test_hot_group_numbering_exact(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") * 7919 % 20000).alias("o"), F.col("id").alias("tie"))
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy("o", "tie")).alias("rn"))
    got = number_rows(df, ["g"], ["o", "tie"], "rn", hot_rows=1000, blocks=8).select("tie", "rn")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_equal_leading_keys_stay_ordered(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), (F.col("id") % 7).alias("o"), F.col("id").alias("tie"))
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy("o", "tie")).alias("rn"))
    got = number_rows(df, ["g"], ["o", "tie"], "rn", hot_rows=100, blocks=16).select("tie", "rn")
    assert got.exceptAll(ref).count() == 0


def test_hot_group_with_one_leading_value_is_split(spark):
    from mediafeat.operators import ordering as O
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 30).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 97).alias("ts"),  # hot group: one ts
        ((F.col("id") * 7919) % 6000).alias("tie"))
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy("ts", "tie")).alias("rn"))
    got = O.number_rows(df, ["g"], ["ts", "tie"], "rn", hot_rows=500, blocks=8).select("tie", "rn")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    t, hot = O.with_blocks(df, ["g"], ["ts", "tie"], hot_rows=500, blocks=8)
    per_block = [r["count"] for r in t.where("g = -1").groupBy("_blk").count().collect()]
    assert hot and len(per_block) >= 6 and max(per_block) < 3000 / 3


def test_null_groups_and_text_keys_on_both_sides_of_the_threshold(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 5).alias("g"),
        F.concat(F.lit("s"), F.lpad((F.col("id") * 7919 % 3000).cast("string"), 5, "0")).alias("o"), F.col("id").alias("tie"))
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy("o", "tie")).alias("rn"))
    for hot_rows in (10_000, 200):
        got = number_rows(df, ["g"], ["o", "tie"], "rn", hot_rows=hot_rows, blocks=8).select("tie", "rn")
        assert got.exceptAll(ref).count() == 0 and got.count() == 3000


def test_null_order_keys_come_first_in_a_hot_group(spark):
    df = spark.range(2000).select(F.lit(1).alias("g"), F.when(F.col("id") % 4 != 0, F.col("id")).alias("o"), F.col("id").alias("tie"))
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy("o", "tie")).alias("rn"))
    got = number_rows(df, ["g"], ["o", "tie"], "rn", hot_rows=100, blocks=8).select("tie", "rn")
    assert got.exceptAll(ref).count() == 0 and got.count() == 2000


def test_blocks_are_cut_until_none_is_hot(spark):
    """Groups far above ``hot_rows`` times the blocks, with one value in half of the rows."""
    from mediafeat.operators import ordering as O
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 != 0, F.lit(1)).otherwise(F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(500)).when(F.col("id") % 5 != 0, F.col("id") % 1000).alias("a"),
        (F.col("id") * 31 % 7).alias("b"), F.col("id").alias("tie"))
    order = ["a", "b", "tie"]
    t, hot = O.with_blocks(df, ["g"], order, hot_rows=40, blocks=4)
    assert hot and max(r["count"] for r in t.groupBy("g", "_blk").count().collect()) <= 40
    ref = df.select("tie", F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("rn"))
    got = number_rows(df, ["g"], order, "rn", hot_rows=40, blocks=4).select("tie", "rn")
    assert got.exceptAll(ref).count() == 0 and got.count() == 20_000


def test_rows_that_share_all_keys_stay_in_one_block(spark):
    from mediafeat.operators import ordering as O
    df = spark.range(300).select(F.lit(1).alias("g"), F.lit(2).alias("o"))
    t, hot = O.with_blocks(df, ["g"], ["o"], hot_rows=10, blocks=4)
    assert hot and t.select("_blk").distinct().count() == 1
