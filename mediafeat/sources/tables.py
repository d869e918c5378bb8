"""Table scans and sinks.

Parquet is the canonical storage.  Shard identity comes from the file path
(``_metadata.file_path``) or from a ``partitionBy`` directory, so pruning by
shard happens at file listing time, not after reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mediafeat.defaults import CONVERTED_SUFFIX
from mediafeat.functions.text import basename, tokens


def read_many(spark: SparkSession, paths: list[str], fmt: str = "parquet",
              schema: StructType | None = None, source_col: str = "source_file") -> DataFrame:
    """Several paths/globs as one input, each row tagged with its file."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(paths)
    return df.withColumn(source_col, F.col("_metadata.file_path"))


def source_dir(path_col: str = "source_file", level: int = -2):
    """The directory name at ``level`` of a file path (e.g. 'train' / 'validate')."""
    return F.element_at(F.split(F.col(path_col), "/"), level)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite",
                      fmt: str = "parquet") -> None:
    """One output directory per shard, written straight to its destination."""
    df.write.mode(mode).format(fmt).partitionBy(*by).save(path)


def output_names(df: DataFrame, path_col: str, suffix: str = CONVERTED_SUFFIX) -> DataFrame:
    """Per-shard output name: base name of the source path + suffix."""
    return df.withColumn("out_name", F.concat(basename(F.col(path_col)), F.lit(suffix)))


def quarantine(df: DataFrame, rules: list[tuple[str, object]], reason_col: str = "reason"):
    """Split rows into (good, bad) by ordered rules ``(reason, predicate)``.

    The first matching rule names the reason; rows matching none are good.
    Nothing is dropped: bad rows go to their own table with the reason.
    """
    reason = F.lit(None).cast("string")
    for name, pred in reversed(rules):
        p = F.expr(pred) if isinstance(pred, str) else pred
        reason = F.when(F.coalesce(p, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn(reason_col, reason)
    return tagged.where(F.col(reason_col).isNull()).drop(reason_col), tagged.where(F.col(reason_col).isNotNull())


def tag_reason(df: DataFrame, rules: list[tuple[str, object]], reason_col: str = "reason",
               ok: str = "ok") -> DataFrame:
    reason = F.lit(ok)
    for name, pred in reversed(rules):
        p = F.expr(pred) if isinstance(pred, str) else pred
        reason = F.when(F.coalesce(p, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(reason_col, reason)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Text files -> one row per whitespace-separated word."""
    return spark.read.text(path).select(F.explode(tokens("value")).alias("word"))


def words(df: DataFrame, text_col: str) -> DataFrame:
    """Text column -> one row per word (whole texts, no prefix)."""
    from mediafeat.operators.parallel import spread
    return spread(df.select(text_col)).select(F.explode(tokens(text_col)).alias("word"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_json_sample(df: DataFrame, path: str, order: list[str], n: int) -> None:
    """JSON lines of the first n rows by ``order`` (S10); the sample is the feature."""
    df.orderBy(*order).limit(n).write.mode("overwrite").json(path)
