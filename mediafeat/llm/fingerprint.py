"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a
text's shingles.  Sketches of parts merge into the sketch of the whole; two of
them estimate resemblance and containment, one estimates the number of distinct
shingles.  Everything is column expressions.

A text of fewer than ``SHINGLE`` words has its whole word sequence as the one
shingle; a text without words has an empty sketch (resemblance 1 to another empty
one, 0 to any other).  A null text counts as empty.  Equal texts have equal
sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.llm.common import WORD, input_bytes, let, text_of

K = 128          # hashes kept: resemblance has a standard error of at most 0.045
SHINGLE = 5      # words of a shingle
MAX_BLOCKS = 10_000   # id ranges that the neighbour search cuts the table into


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """array<bigint>: one hash per shingle, in text order."""
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < shingle, F.array(F.xxhash64(h)))
                .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - shingle),
                                       lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(shingle)]))))
    return let(words, of)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Jaccard similarity of the shingle sets, from their sketches."""
    both = F.size(a) + F.size(b) == 0
    return let(merge(a, b, k), lambda u: F.when(both, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.greatest(F.size(u), F.lit(1))).cast("double"))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else (k-1) over
    the k-th smallest hash as a fraction of the hash range."""
    frac = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / F.greatest(frac, F.lit(2.0 ** -64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has."""
    return let(merge(a, b, k), lambda u: F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(
        F.lit(1.0), resemblance(a, b, k) * distinct_count(u, k) / distinct_count(a, k))))


def encode(a: Column) -> Column:
    """A sketch as text: 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def decode(text: Column) -> Column:
    """The sketch that :func:`encode` has written."""
    def signed(x: Column) -> Column:
        return (F.shiftleft(F.conv(F.substring(x, 1, 8), 16, 10).cast("bigint"), 32)
                .bitwiseOR(F.conv(F.substring(x, 9, 8), 16, 10).cast("bigint")))
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9a-f]{16}"), F.lit(0)), signed)


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded to one literal


def _at_or_below(cuts: list[int], v: Column) -> Column:
    """How many of the sorted ``cuts`` are <= ``v``: a binary search in the plan."""
    if not cuts:
        return F.lit(0)
    arr, steps = _longs(cuts), len(cuts).bit_length()
    pair = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
        lambda s, _: let(((s["lo"] + s["hi"]) / 2).cast("int"), lambda m: F.when(s["lo"] >= s["hi"], s).otherwise(
            F.when(F.get(arr, m) <= v, F.struct((m + 1).alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi"))))))
    return F.when(v.isNull(), F.lit(0)).otherwise(pair["lo"])


def with_next(docs: DataFrame, columns: list[str], order: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Append ``next_<c>`` for each of ``columns``: the values of the next row by
    descending ``order`` (after the last: the first; equal ids in the order of
    their text's checksum; null ids last).

    The table is cut into id ranges at approximate quantiles, each range sorted in
    its own task; the top row of every range is also sent to the range above, where
    it stands last, so that no task sees more than its range and rows move once."""
    spark = docs.sparkSession
    parts = parts or min(MAX_BLOCKS, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs) >> 25))
    row = docs.select(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts).alias("q")).first()
    cuts = sorted(set(row.q or []))
    with_b = docs.withColumn("_b", _at_or_below(cuts, F.col(order)))
    tops = sorted((r["_b"], r["top"]) for r in docs.select(order).withColumn("_b", _at_or_below(cuts, F.col(order)))
                  .groupBy("_b").agg(F.max(order).alias("top")).collect() if r["top"] is not None)   # one row per range
    above, top = [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    filled = [b for b, _ in tops] or [0]
    for i, (b, t) in enumerate(tops):
        above[b], top[b] = filled[(i + 1) % len(filled)], t
    lowest = filled[0]
    is_top = F.coalesce(F.col(order) == F.get(_longs(top), F.col("_b")), F.lit(not tops))
    to = F.when(is_top, F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("m")),
                                F.struct(F.get(_longs(above), F.col("_b")).cast("int").alias("b"), F.lit(1).alias("m")))) \
        .otherwise(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("m"))))
    if tops and lowest != 0:   # null ids stand alone below the lowest filled range: they join it
        to = F.when(F.col(order).isNull(), F.array(F.struct(F.lit(lowest).alias("b"), F.lit(0).alias("m")))).otherwise(to)
    sent = with_b.withColumn("_to", F.explode(to))
    w = Window.partitionBy("_to.b").orderBy("_to.m", F.col(order).desc_nulls_last(), "_tie")
    nexts = [F.lead(c).over(w).alias(f"next_{c}") for c in columns]
    return (sent.select(*docs.columns, "_to", F.crc32("text").alias("_tie")).select(*docs.columns, "_to", *nexts)
            .where("_to.m = 0").drop("_to"))


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text, sketch of every document."""
    return text_of(docs).withColumn("sketch", sketch(F.col("text"), k, shingle))


def edited_report(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edit, whose second half is the start
    of the next document, with the likeness of the two and of the neighbours."""
    both = with_next(fingerprints(docs, k, shingle), ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = both.select("doc_id", "sketch", "next_sketch", n.cast("long").alias("n_chars"),
                       F.concat(F.left("text", n - half), F.left(F.coalesce("next_text", F.lit("")), half)).alias("edited"))
    both = both.withColumn("edited_sketch", sketch(F.col("edited"), k, shingle))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        encode(F.col("sketch")).alias("fingerprint"), encode(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.coalesce("next_sketch", F.array().cast("array<bigint>")), k).alias("near_next"))
