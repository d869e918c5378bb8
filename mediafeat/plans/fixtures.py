"""Fixtures derived from the input tables (see FIXTURES.md).

Each ``fx_*`` function returns a lazy DataFrame over the parquet tables; the
``DUCK`` dict holds the same definitions as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_bags(spark, sf_dir) -> DataFrame:
    """id bigint, labels array<bigint> (sorted, distinct) -- one bag per order."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("id"))
              .agg(F.array_sort(F.collect_set("l_suppkey")).alias("labels")))


def fx_video(spark, sf_dir) -> DataFrame:
    """Video-level rows: id string, labels array<bigint>, mean_rgb(48), mean_audio(16)."""
    e = table(spark, sf_dir, "embeddings")
    lab = F.col("label").cast("bigint")
    return e.select(
        F.col("vec_id").cast("string").alias("id"),
        F.array_sort(F.array_distinct(F.array(lab, (lab * 3 + F.col("vec_id")) % 14))).alias("labels"),
        F.slice("embedding", 1, 48).alias("mean_rgb"),
        F.slice("embedding", 49, 16).alias("mean_audio"))


def steps_source(spark, sf_dir) -> DataFrame:
    """Frame-level steps before numbering: id, ts, event_id, value, props."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("id"), "ts", "event_id", "value", "props")


def fx_steps(spark, sf_dir) -> DataFrame:
    """id bigint, step int (0-based, by ts then event_id), value double, props string.

    Numbered with the skew-safe :func:`number_rows` (range blocks), not a
    whole-video window, so a video with a third of all frames stays balanced."""
    from mediafeat.operators.ordering import number_rows
    s = number_rows(steps_source(spark, sf_dir), ["id"], ["ts", "event_id"], "rn")
    return s.select("id", (F.col("rn") - 1).alias("step"), "value", "props")


def fx_video_side(spark, sf_dir) -> DataFrame:
    """id bigint, name string; every 7th customer left out so some ids have no match."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 7 != 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def fx_sharded(spark, sf_dir) -> DataFrame:
    """id bigint, shard string (12 shards), amount double."""
    o = table(spark, sf_dir, "orders")
    shard = F.concat(F.lit("train"), F.lpad((F.col("o_orderkey") % 12).cast("string"), 4, "0"), F.lit(".rec"))
    return o.select(F.col("o_orderkey").alias("id"), shard.alias("shard"), F.col("o_totalprice").alias("amount"))


def fx_u8(spark, sf_dir) -> DataFrame:
    """id bigint, raw binary: the bytes of each whole text."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.encode("text", "UTF-8").alias("raw"))


def fx_text(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text")


def fx_scores(spark, sf_dir) -> DataFrame:
    """id bigint, cls int 0..9, scores array<double>(10): every tenth dimension of the
    whole vector summed, from each of the first ten."""
    e = table(spark, sf_dir, "embeddings")

    def total(c):
        return F.aggregate(F.sequence(c, F.size("embedding") - 1, F.lit(10)), F.lit(0.0),
                           lambda a, i: a + F.get("embedding", i).cast("double"))
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("cls"),
                    F.transform(F.sequence(F.lit(0), F.lit(9)), total).alias("scores"))


def fx_places(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("id"),
                    (F.lit(37.0) + (k * 37) % 1000 / F.lit(5000.0)).alias("lat"),
                    (F.lit(-122.0) - (k * 91) % 1000 / F.lit(5000.0)).alias("lng"))


def fx_business(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("business_id"),
        F.when(k % 3 == 0, "food").otherwise("other").alias("term"),
        F.when(F.col("p_size") > 25, "hot_and_new").otherwise("none").alias("attribute"),
        (F.lit(37.0) + (k * 53) % 1000 / F.lit(5000.0)).alias("lat"),
        (F.lit(-122.0) - (k * 29) % 1000 / F.lit(5000.0)).alias("lng"), F.col("p_brand").alias("location"))


def fx_reviews(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("business_id"), F.col("l_linenumber").alias("stars"))


def fx_json(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), "props")


# DuckDB twins (same text as FIXTURES.md; DuckDB spelling where it differs)
DUCK = {
    "fx_bags": "SELECT l_orderkey AS id, list_sort(list_distinct(list(l_suppkey))) AS labels "
               "FROM lineitem GROUP BY l_orderkey",
    "fx_video": "SELECT CAST(vec_id AS VARCHAR) AS id, "
                "list_sort(list_distinct([CAST(\"label\" AS BIGINT), (\"label\" * 3 + vec_id) % 14])) AS labels, "
                "embedding[1:48] AS mean_rgb, embedding[49:64] AS mean_audio FROM embeddings",
    "fx_steps": "SELECT user_id AS id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS step, "
                "value, props FROM events",
    "fx_video_side": "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 7 <> 0",
    "fx_sharded": "SELECT o_orderkey AS id, concat('train', lpad(CAST(o_orderkey % 12 AS VARCHAR), 4, '0'), '.rec') AS shard, "
                  "o_totalprice AS amount FROM orders",
    "fx_u8": "SELECT doc_id AS id, hex(encode(text)) AS hex FROM documents",
    "fx_text": "SELECT doc_id, text FROM documents",
    "fx_scores": "SELECT vec_id AS id, \"label\" AS cls, list_transform(range(10), lambda c: list_reduce(list_transform("
                 "range(c, len(embedding), 10), lambda i: CAST(embedding[i + 1] AS DOUBLE)), lambda a, b: a + b)) AS scores FROM embeddings",
    "fx_places": "SELECT c_custkey AS id, 37.0::DOUBLE + (c_custkey * 37) % 1000 / 5000.0::DOUBLE AS lat, "
                 "-122.0::DOUBLE - (c_custkey * 91) % 1000 / 5000.0::DOUBLE AS lng FROM customer",
    "fx_business": "SELECT p_partkey AS business_id, CASE WHEN p_partkey % 3 = 0 THEN 'food' ELSE 'other' END AS term, "
                   "CASE WHEN p_size > 25 THEN 'hot_and_new' ELSE 'none' END AS attribute, "
                   "37.0::DOUBLE + (p_partkey * 53) % 1000 / 5000.0::DOUBLE AS lat, "
                   "-122.0::DOUBLE - (p_partkey * 29) % 1000 / 5000.0::DOUBLE AS lng, p_brand AS location FROM part",
    "fx_reviews": "SELECT l_partkey AS business_id, l_linenumber AS stars FROM lineitem",
    "fx_json": "SELECT event_id AS id, props FROM events",
}
