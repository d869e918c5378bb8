"""Column expressions and table helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a word: a run of characters other than the six ASCII blanks
WORD = r"[^\x20\x09-\x0D]+"
PART_BYTES = 8 << 20      # of input for each part that a task takes in whole
ID_BITS = 26              # a table of hashed ids has 2**26 bits at most, 64 a row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, so that extra columns of any
    name cannot clash with what an operator adds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n, F.lit(-1)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable is
    bound to it, whereas a repeated column expression would be evaluated again
    for every element of a higher-order function that mentions it."""
    return F.transform(F.array(value), body)[0]


def scratch(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back:
    cuts the lineage, and the rows survive the loss of executors.

    A table made of little input is written in few files: a task for each
    ``PART_BYTES`` that the plan reads, and for each core two at least.  ``wide`` keeps
    the partitions, for rows that carry the number of theirs."""
    from mediafeat.session import scratch_path
    path = scratch_path(df.sparkSession, f"llm-{name}")
    if not wide:
        df = df.coalesce(min(1 << 30, max(2 * df.sparkSession.sparkContext.defaultParallelism, _read_bytes(df) // PART_BYTES)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read_bytes(df: DataFrame) -> int:
    """The size of the files that a plan reads (without an estimate: very large)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the rows' size (file sizes for a scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def part_count(docs: DataFrame) -> int:
    """Parts for tables that tasks take in whole: they grow with the input."""
    size = input_bytes(docs)
    known = size if size < 1 << 60 else 0          # a table that no file stands behind has no estimate
    return max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), known // PART_BYTES)


def by_part(df: DataFrame, parts: int) -> DataFrame:
    """A task for each ``part``, 0 to ``parts`` - 1: a hash would put several in one."""
    return df.repartitionById(parts, "part")


def parted(rows: DataFrame, key: str, ids: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may be an id (``name``) of ``ids``, and the others: a
    broadcast table of hashed ids spares the others, with their texts, the shuffle of a
    join.  It has as many rows as ids, up to 2**``ID_BITS`` / 64; beyond, more rows than
    needed are taken for possible ones, which the join tells apart."""
    def place(c: str) -> Column:
        return F.xxhash64(F.col(f"`{c}`").cast("long")).bitwiseAND(F.lit((1 << ID_BITS) - 1))

    def word(c: str) -> Column:
        return F.shiftright(place(c), 6)

    def bit(c: str) -> Column:
        return place(c).bitwiseAND(F.lit(63)).cast("int")
    bits = ids.select(word(name).alias("__word"), bit(name).alias("__bit")).groupBy("__word").agg(
        F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    held = rows.join(F.broadcast(bits), word(key) == F.col("__word"), "left")
    may = F.coalesce(F.bit_get("__bits", bit(key)) == 1, F.lit(False))
    return tuple(held.where(x).select(*[f"`{c}`" for c in rows.columns]) for x in (may, ~may))
