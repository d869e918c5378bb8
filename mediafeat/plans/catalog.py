"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  Vector results are rendered as exact strings (see compare.py)
so the DuckDB oracle can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediafeat import defaults as DF
from mediafeat.functions import vectors as V
from mediafeat.operators import assemble as A
from mediafeat.operators import labels as L
from mediafeat.operators import sequences as S
from mediafeat.plans import fixtures as X
from mediafeat.plans.compare import dec_str, ints_str, nested_dec_str
from mediafeat.plans.training_table import K_LABELS, T_STEPS, frame_sequences, training_table
from mediafeat.functions import text as TX
from mediafeat.operators import geo as G
from mediafeat.operators import metrics as M
from mediafeat.operators import network as N
from mediafeat.operators import sparse_labels as SL
from mediafeat.operators import split as P
from mediafeat.operators import train as TR
from mediafeat.session import scratch_path
from mediafeat.sources import layout as LY
from mediafeat.sources import record_scan as RS
from mediafeat.sources import records as RC
from mediafeat.sources import tables as TB
from mediafeat.streaming.ingest import ingest_once
from pyspark.sql import types as TT
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


K = K_LABELS
T = T_STEPS


# ---------------------------------------------------------------- labels
@query("label_histogram")
def q_label_histogram(spark, d):
    return L.label_histogram(X.fx_bags(spark, d))


@query("vocab_by_id")
def q_vocab_by_id(spark, d):
    return L.fit_label_vocab(X.fx_bags(spark, d), K, order="id")


@query("vocab_by_frequency")
def q_vocab_by_frequency(spark, d):
    return L.fit_label_vocab(X.fx_bags(spark, d), K, order="frequency")


@query("multihot_vocab")
def q_multihot_vocab(spark, d):
    bags = X.fx_bags(spark, d)
    enc = L.encode_labels(bags, L.fit_label_vocab(bags, K), K)
    return enc.select("id", ints_str("labels_hot").alias("hot"))


@query("multihot_positional")
def q_multihot_positional(spark, d):
    enc = L.encode_positional(X.fx_bags(spark, d), K)
    return enc.select("id", ints_str("labels_hot").alias("hot"))


@query("label_coverage")
def q_label_coverage(spark, d):
    bags = X.fx_bags(spark, d)
    enc = L.encode_labels(bags, L.fit_label_vocab(bags, K), K, out_col="hot")
    enc = L.encode_positional(enc, K, out_col="pos")
    return L.label_coverage(enc, "hot", "pos")


@query("label_slot_join")
def q_label_slot_join(spark, d):
    bags = X.fx_bags(spark, d)
    j = L.label_slot_join(bags, L.fit_label_vocab(bags, K))
    return j.select("id", ints_str("slots").alias("slots"), "n_kept")


# ---------------------------------------------------------------- flagship + sequences
def training_table_view(df: DataFrame) -> DataFrame:
    return df.select("id", "name", "n_steps", "true_len",
                     nested_dec_str("frames").alias("frames"),
                     ints_str("labels").alias("labels"),
                     ints_str("labels_hot").alias("hot"))


@query("label_slots_shared_ids")
def q_label_slots_shared_ids(spark, d):
    """Rows that share an id keep their own labels."""
    bags = X.fx_bags(spark, d).withColumn("id", F.col("id") % 100)
    return L.label_slot_join(bags, L.fit_label_vocab(X.fx_bags(spark, d), K)).select("id", ints_str("slots").alias("slots"), "n_kept")


def _line_bags(spark, d):
    """id, labels: the lines of each part; as many labels as there are lines."""
    li = X.table(spark, d, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("id")).agg(F.collect_set(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("labels"))


@query("sparse_vocab")
def q_sparse_vocab(spark, d):
    """All parts as labels, the most frequent first."""
    li = X.table(spark, d, "lineitem")
    return SL.fit_slots(li.select(F.array("l_partkey").alias("labels")), order="frequency")


@query("sparse_encoding")
def q_sparse_encoding(spark, d):
    """A vocabulary of up to 200,000 labels, and bags of which some have none of them."""
    bags = _line_bags(spark, d)
    enc = SL.encode_sparse(bags, SL.fit_slots(bags, 200_001), 200_001)
    return enc.select("id", F.col("labels_sparse.size").alias("width"), ints_str("labels_sparse.slots").alias("slots"),
                      F.aggregate("labels_sparse.values", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_set"))


@query("sparse_label_pairs")
def q_sparse_label_pairs(spark, d):
    """Set slots in long form, for bags that fall to the other slot too."""
    bags = X.fx_bags(spark, d)
    enc = SL.encode_sparse(bags, SL.fit_slots(bags, K), K)
    return SL.sparse_pairs(enc, "labels_sparse", "id").select("id", "slot", F.col("value").cast("bigint").alias("value"))


@query("colocated_join")
def q_colocated_join(spark, d):
    """Frames joined to videos from bucketed tables, users with over 40 frames beside them."""
    frames, video = X.fx_steps(spark, d).select("id", "step", "value"), X.fx_video_side(spark, d)
    lay = LY.write_colocated(frames, video, scratch_path(spark, "colocated"), "id", buckets=16, sort=("step",), hot_rows=40)
    return LY.join_colocated(spark, lay).select("id", "step", "value", "name")


@query("training_table")
def q_training_table(spark, d):
    return training_table_view(training_table(spark, d))


@query("frame_video_join")
def q_frame_video_join(spark, d):
    j = A.frame_video_join(X.fx_steps(spark, d), X.fx_video_side(spark, d))
    return j.select("id", "step", "value", "name")


@query("frames_without_video")
def q_frames_without_video(spark, d):
    lost = A.frames_without_video(X.steps_source(spark, d), X.fx_video_side(spark, d))
    return lost.groupBy("id").agg(F.count(F.lit(1)).alias("n_frames"))


@query("steps_per_video")
def q_steps_per_video(spark, d):
    return S.steps_per_video(X.steps_source(spark, d))


def _value_sequences(spark, d):
    return S.assemble_sequences(X.steps_source(spark, d), "id", ["ts", "event_id"], "value", T, "seq")


@query("sequence_assembly")
def q_sequence_assembly(spark, d):
    """All steps of every sequence, in blocks (32 steps here, so that there are several)."""
    seq = S.assemble_blocks(X.steps_source(spark, d), "id", ["ts", "event_id"], "value", 32)
    return seq.select("id", "block", "n_steps", dec_str("seq").alias("seq"))


@query("truncate_sequence")
def q_truncate_sequence(spark, d):
    fixed = S.fix_length(_value_sequences(spark, d), "seq", T, short="drop")
    return fixed.select("id", dec_str("seq").alias("seq"))


@query("pad_sequence")
def q_pad_sequence(spark, d):
    fixed = S.fix_length(_value_sequences(spark, d), "seq", T, short="pad")
    return fixed.select("id", "true_len", dec_str("seq").alias("seq"))


@query("flatten_sequence")
def q_flatten_sequence(spark, d):
    step = F.array(F.col("value"), F.get_json_object("props", "$.k").cast("double"))
    seq = S.assemble_blocks(X.steps_source(spark, d), "id", ["ts", "event_id"], step, 32, "frames")
    return seq.select("id", "block", dec_str(V.flatten("frames")).alias("flat"))


@query("sequence_pooling")
def q_sequence_pooling(spark, d):
    pooled = S.pool_sequence(frame_sequences(spark, d, T), "frames", 2)
    return pooled.select("id", *[dec_str(f"pool_{s}", 6).alias(s)
                                 for s in ("mean", "max", "first", "last", "fwd", "bwd")])


# ---------------------------------------------------------------- vectors, projections
@query("fuse_features")
def q_fuse_features(spark, d):
    v = X.fx_video(spark, d)
    return v.select("id", V.dims(V.fuse("mean_rgb", "mean_audio")).alias("dims"),
                    dec_str(V.fuse("mean_rgb", "mean_audio"), 6).alias("fused"))


@query("vector_dims")
def q_vector_dims(spark, d):
    v = X.fx_video(spark, d)
    return v.select("id", V.dims("mean_rgb").alias("n_rgb"), V.dims("mean_audio").alias("n_audio"))


@query("vector_preview")
def q_vector_preview(spark, d):
    v = X.fx_video(spark, d)
    return v.select("id", dec_str(V.preview("mean_rgb", 20), 6).alias("preview"))


@query("project_features")
def q_project_features(spark, d):
    v = X.fx_video(spark, d).select("mean_rgb", "labels")
    return v.select(dec_str("mean_rgb", 6).alias("rgb"), ints_str("labels").alias("labels"))


@query("feature_label_pairs")
def q_feature_label_pairs(spark, d):
    v = L.encode_positional(X.fx_video(spark, d), K, out_col="hot")
    p = A.feature_label_pairs(v, "mean_rgb", "hot")
    return p.select(dec_str("features", 6).alias("features"), ints_str("label").alias("label"))


@query("multi_input_pairs")
def q_multi_input_pairs(spark, d):
    v = X.fx_video(spark, d)
    v = L.encode_labels(v, L.fit_label_vocab(v, K), K, out_col="hot")
    m = A.multi_input(v, ["id", "mean_audio", "mean_rgb"], "hot")
    return m.select("id", dec_str("mean_audio", 6).alias("audio"), dec_str("mean_rgb", 6).alias("rgb"),
                    ints_str("label").alias("label"))


@query("integrity_counts")
def q_integrity_counts(spark, d):
    return A.integrity_counts(X.fx_video(spark, d))


@query("row_count")
def q_row_count(spark, d):
    parts = [X.table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "n")
             for t in ("lineitem", "orders", "events", "embeddings", "documents")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("argmax_class")
def q_argmax_class(spark, d):
    s = X.fx_scores(spark, d)
    return s.select("id", "cls", V.argmax("scores").alias("pred"))


# ---------------------------------------------------------------- splits, shards, limits

SEED = 7
EXCLUDED = ["train0003.rec", "train0007.rec", "train0011.rec"]


@query("take_ordered")
def q_take_ordered(spark, d):
    return P.take_ordered(X.fx_video(spark, d), ["id"], 20).select("id", ints_str("labels").alias("labels"))


@query("seeded_shuffle")
def q_seeded_shuffle(spark, d):
    return P.seeded_shuffle(X.fx_video(spark, d), "id", SEED).select("id", "shuffle_key")


@query("holdout_split")
def q_holdout_split(spark, d):
    return P.split_holdout(X.fx_video(spark, d), "id", DF.VALIDATION_RATIO, SEED).select("id", "split")


def _sharded_split(spark, d):
    s = P.split_holdout(X.fx_sharded(spark, d), "id", 0.2, 11)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "dev").drop("split")


def _keyed_rows(spark, d):
    """Events with a nullable group and a text order key."""
    return X.table(spark, d, "events").select(
        F.nullif(F.col("user_id") % 10, F.lit(3).cast("bigint")).alias("g"),
        F.concat(F.lit("s"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("o"), "event_id", "value")


@query("row_numbers_plain")
def q_row_numbers_plain(spark, d):
    """Row numbers below the hot threshold: the plain window."""
    from mediafeat.operators.ordering import number_rows
    return number_rows(_keyed_rows(spark, d), ["g"], ["o", "event_id"], "rn").select("event_id", "g", "rn")


@query("row_numbers_hot")
def q_row_numbers_hot(spark, d):
    """The same with every group above the threshold: blocks."""
    from mediafeat.operators.ordering import number_rows
    return number_rows(_keyed_rows(spark, d), ["g"], ["o", "event_id"], "rn", hot_rows=50, blocks=8).select("event_id", "g", "rn")


@query("split_is_partition")
def q_split_is_partition(spark, d):
    train, dev = _sharded_split(spark, d)
    return P.split_check(X.fx_sharded(spark, d), train, dev)


@query("union_shards")
def q_union_shards(spark, d):
    train, dev = _sharded_split(spark, d)
    return P.union_all([train, dev]).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@query("records_per_shard")
def q_records_per_shard(spark, d):
    return X.fx_sharded(spark, d).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


def sharded_layout(spark, d) -> DataFrame:
    """fx_sharded stored the way shards live on disk: one directory per shard."""
    path = scratch_path(spark, "sharded")
    TB.write_partitioned(X.fx_sharded(spark, d), path, ["shard"])
    return spark.read.parquet(path)


@query("exclude_shards")
def q_exclude_shards(spark, d):
    # the shard filter becomes a PartitionFilter: excluded shards are never listed
    return P.exclude_values(sharded_layout(spark, d), "shard", EXCLUDED).select("id", "shard")


@query("exclude_many")
def q_exclude_many(spark, d):
    """A long exclusion list (every customer with an urgent order) as an anti-join;
    orders without a customer number stay."""
    o = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.nullif(F.col("o_custkey") % 1000, F.lit(7).cast("bigint")).alias("customer"),
                                           "o_orderpriority")
    return P.exclude_values(o, "customer", o.where("o_orderpriority = '1-URGENT'").select("customer")).select("id", "customer")


@query("exclude_with_nulls")
def q_exclude_with_nulls(spark, d):
    s = X.fx_sharded(spark, d).withColumn("shard", F.nullif("shard", F.lit("train0005.rec")))
    return P.exclude_values(s, "shard", EXCLUDED).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@query("holdout_with_nulls")
def q_holdout_with_nulls(spark, d):
    v = X.fx_video(spark, d).withColumn("key", F.when(F.col("id").cast("bigint") % 5 != 0, F.col("id")))
    return P.split_holdout(v, "key", DF.VALIDATION_RATIO, SEED).select("id", "split")


@query("limit_shards")
def q_limit_shards(spark, d):
    return P.limit_values(sharded_layout(spark, d), "shard", 5).select("id", "shard")


@query("limit_shards_with_nulls")
def q_limit_shards_with_nulls(spark, d):
    """A null is no name: it uses up no place.  By the literal list."""
    return P.limit_values(_some_without_shard(spark, d), "shard", 5).select("id", "shard")


def _some_without_shard(spark, d):
    return X.fx_sharded(spark, d).withColumn("shard", F.when(F.col("id") % 7 != 0, F.col("shard")))


@query("limit_per_shard")
def q_limit_per_shard(spark, d):
    return P.limit_per_group(X.fx_sharded(spark, d), "shard", ["id"], 100).select("id", "shard", "rn")


@query("chunk_assignment")
def q_chunk_assignment(spark, d):
    return P.chunk_assignment(X.fx_sharded(spark, d), "shard", 4)


@query("multi_source_scan")
def q_multi_source_scan(spark, d):
    base = scratch_path(spark, "multi_source")
    sh = X.fx_sharded(spark, d)
    sh.where(F.col("shard") < "train0010.rec").write.mode("overwrite").parquet(f"{base}/train")
    sh.where(F.col("shard") >= "train0010.rec").write.mode("overwrite").parquet(f"{base}/validate")
    both = TB.read_many(spark, [f"{base}/train", f"{base}/validate"])
    return (both.withColumn("source", TB.source_dir("source_file"))
                .groupBy("source", "shard").agg(F.count(F.lit(1)).alias("n")))


QUARANTINE_RULES = [
    ("missing_amount", "amount IS NULL"),
    ("non_positive_amount", "amount <= 0"),
    ("bad_shard_name", r"NOT shard RLIKE '^train[0-9]{4}\\.rec$'"),
    ("outlier_amount", "amount > 450000"),
]


@query("quarantine_counts")
def q_quarantine_counts(spark, d):
    tagged = TB.tag_reason(X.fx_sharded(spark, d), QUARANTINE_RULES)
    return tagged.groupBy("shard", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("shard_output_names")
def q_shard_output_names(spark, d):
    sh = X.fx_sharded(spark, d).withColumn("path", F.concat(F.lit("data/frame/"), F.col("shard")))
    named = TB.output_names(sh, "path")
    return named.groupBy("shard", "out_name").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- metrics and scoring

def run_history(spark, d):
    """Per run (id): every step in time order is an epoch, value the watched loss.

    Epoch numbers come from the skew-safe ``number_rows`` (whole runs, no cap)."""
    from mediafeat.operators.ordering import number_rows
    h = number_rows(X.steps_source(spark, d), ["id"], ["ts", "event_id"], "epoch")
    return h.select("id", "event_id", "epoch", F.col("value").alias("loss"))


@query("topclass_accuracy")
def q_topclass_accuracy(spark, d):
    return M.class_accuracy(X.fx_scores(spark, d), "cls", "scores")


@query("categorical_crossentropy")
def q_categorical_crossentropy(spark, d):
    return M.categorical_crossentropy(X.fx_scores(spark, d), "cls", "scores", by=["cls"])


def linear_weights(k: int = 10, dim: int = 64) -> list[list[float]]:
    """Deterministic weights for the scoring check (a rule, not data)."""
    return [[((c * 7 + j * 3) % 11 - 5) / 10.0 for j in range(dim)] for c in range(k)]


@query("score_linear")
def q_score_linear(spark, d):
    v = X.fx_video(spark, d).withColumn("x", V.fuse("mean_rgb", "mean_audio").cast("array<double>"))
    s = v.withColumn("scores", V.matvec(linear_weights(), "x"))
    return s.select("id", V.argmax("scores").alias("pred"), F.round(F.array_max("scores"), 6).alias("top"))


@query("standardise_features")
def q_standardise_features(spark, d):
    from mediafeat.operators.train import feature_stats
    return feature_stats(X.fx_video(spark, d), "mean_rgb").select(
        "pos", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("standardise_apply")
def q_standardise_apply(spark, d):
    z = TR.standardise(X.fx_video(spark, d), "mean_rgb", out_col="z")
    return z.select("id", dec_str(F.transform("z", lambda x: F.round(x, 3)), 3).alias("z"))


@query("speedup")
def q_speedup(spark, d):
    runs = X.steps_source(spark, d)
    s = M.speedup(runs, "id", ["ts", "event_id"], "value")
    # a quotient of IEEE divisions is bit-identical in both engines: no rounding
    # (rounding would differ at decimal ties that are not exact in binary)
    return s.select("id", "event_id", "speedup")


@query("parallel_efficiency")
def q_parallel_efficiency(spark, d):
    h = run_history(spark, d).withColumnRenamed("epoch", "nodes")
    s = M.efficiency(M.speedup(h, "id", ["nodes"], "loss"), "speedup", "nodes")
    return s.select("id", "nodes", "efficiency")


@query("early_stop_epoch")
def q_early_stop_epoch(spark, d):
    return M.early_stopping(run_history(spark, d), "id", "epoch", "loss", DF.EARLY_STOP_PATIENCE).select(
        "id", "stop_epoch")


@query("best_checkpoint")
def q_best_checkpoint(spark, d):
    es = M.early_stopping(run_history(spark, d), "id", "epoch", "loss", DF.EARLY_STOP_PATIENCE)
    return es.select("id", "best_epoch", F.round("best_loss", 6).alias("best_loss"), "n_saved")


@query("run_label")
def q_run_label(spark, d):
    st = X.steps_source(spark, d).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.get_json_object("props", "$.k").cast("bigint")).alias("kmax"),
        F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    return st.select("id", TX.run_label(DF.RUN_LABEL_FORMAT, "n", "kmax", "vmin", "vmax").alias("label"))


@query("epoch_seconds_instant")
def q_epoch_seconds_instant(spark, d):
    """Seconds of instants, 5 hours off the wall clock they were read with."""
    ts = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "America/Bogota").cast("timestamp")
    return X.table(spark, d, "events").select("event_id", TX.epoch_seconds(ts).alias("secs"))


@query("epoch_seconds")
def q_epoch_seconds(spark, d):
    return X.table(spark, d, "events").select("event_id", TX.epoch_seconds("ts").alias("secs"))


# ---------------------------------------------------------------- text, json, bytes
@query("tokenize_words")
def q_tokenize_words(spark, d):
    return TB.words(X.fx_text(spark, d), "text").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("query_term")
def q_query_term(spark, d):
    p = X.table(spark, d, "part")
    return p.select("p_partkey", TX.plus_term("p_name").alias("term"),
                    TX.quote_path(F.concat(F.lit("v3/businesses/"), F.col("p_name"), F.lit("/reviews"))).alias("quoted"))


@query("json_field")
def q_json_field(spark, d):
    return X.fx_json(spark, d).select("id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("struct_field")
def q_struct_field(spark, d):
    """One field projected from an array of structs: the quantities of an order's lines."""
    li = X.table(spark, d, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("lines"))
    return lines.select(F.col("l_orderkey").alias("id"), dec_str(F.transform("lines", lambda x: x["l_quantity"]), 2).alias("quantities"))


@query("decode_u8")
def q_decode_u8(spark, d):
    return X.fx_u8(spark, d).select("id", ints_str(V.decode_u8("raw")).alias("vals"))


# ---------------------------------------------------------------- geo


def _biz(spark, d):
    return G.search(X.fx_business(spark, d), term="food", attribute="hot_and_new")


@query("geo_new_businesses")
def q_geo_new_businesses(spark, d):
    return G.radius_count(X.fx_places(spark, d), _biz(spark, d), DF.SEARCH_RADIUS_M, cap=DF.SEARCH_PAGE_SIZE,
                          full_col="n_within").select("id", "lat", "lng", "new_businesses", "n_within")


@query("business_search")
def q_business_search(spark, d):
    r = G.nearby(X.fx_places(spark, d), _biz(spark, d), DF.SEARCH_RADIUS_M, "id", "business_id",
                 limit=DF.SEARCH_PAGE_SIZE)
    return r.select("id", "business_id", F.round("distance_m", 3).alias("distance_m"), "rank")


@query("location_search")
def q_location_search(spark, d):
    return G.search(X.fx_business(spark, d), term="other", location="Brand#13").select("business_id", "term", "location")


@query("keyed_lookup")
def q_keyed_lookup(spark, d):
    j = G.keyed_lookup(X.fx_business(spark, d).select("business_id"), X.fx_reviews(spark, d), "business_id",
                       [F.count("stars").alias("n_reviews"), F.avg("stars").alias("avg_stars")])
    return j.select("business_id", F.coalesce("n_reviews", F.lit(0)).alias("n_reviews"),
                    F.round("avg_stars", 4).alias("avg_stars"))


GEO_SCHEMA = StructType([StructField("id", LongType()), StructField("lat", DoubleType()),
                         StructField("lng", DoubleType()), StructField("new_businesses", LongType()), StructField("n_within", LongType())])


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "places_csv")
    TB.write_csv(q_geo_new_businesses(spark, d), path)
    return TB.read_csv(spark, path, GEO_SCHEMA)


@query("json_sample")
def q_json_sample(spark, d):
    path = scratch_path(spark, "sample_json")
    TB.write_json_sample(X.fx_sharded(spark, d), path, ["id"], 20)
    schema = "id bigint, shard string, amount double"
    back = spark.read.schema(schema).json(path)
    return back.select("id", "shard", "amount", F.to_json(F.struct("id", "shard")).alias("line"))


@query("training_table_roundtrip")
def q_training_table_roundtrip(spark, d):
    path = scratch_path(spark, "training_table")
    training_table(spark, d).write.mode("overwrite").parquet(path)
    return training_table_view(spark.read.parquet(path))


# ---------------------------------------------------------------- record files

VIDEO_SCHEMA = TT.StructType([
    TT.StructField("id", TT.StringType()), TT.StructField("labels", TT.ArrayType(TT.LongType())),
    TT.StructField("mean_rgb", TT.ArrayType(TT.FloatType())), TT.StructField("mean_audio", TT.ArrayType(TT.FloatType()))])


def _shards(spark) -> int:
    """Output shard count: one per core of the cluster."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # sessions without a SparkContext handle
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _long_form(df: DataFrame) -> DataFrame:
    parts = []
    for name, col in (("rgb", "mean_rgb"), ("audio", "mean_audio"), ("labels", "labels")):
        parts.append(df.select("id", F.lit(name).alias("part"),
                               F.posexplode(col).alias("pos", "val")).withColumn("val", F.col("val").cast("double")))
    return P.union_all(parts)


@query("record_example_roundtrip")
def q_record_example_roundtrip(spark, d):
    path = scratch_path(spark, "video_records")
    RC.write_records(X.fx_video(spark, d), path, "Example", shards=_shards(spark))
    back = RC.read_records(spark, path, VIDEO_SCHEMA, "Example")
    return _long_form(RC.read_good(back))


@query("record_split_scan")
def q_record_split_scan(spark, d):
    """Record shards read in byte ranges -- a quarter of the largest shard here,
    so every range after the first starts mid-shard and re-synchronises on a
    verified header; on a cluster the default 128 MB turns a large shard into
    many tasks."""
    path = scratch_path(spark, "video_records_split")
    RC.write_records(X.fx_video(spark, d), path, "Example", shards=_shards(spark))
    split = max(1024, max(RC.shard_sizes(path)) // 4)
    back = RC.read_records_split(spark, path, VIDEO_SCHEMA, "Example", split_bytes=split)
    return _long_form(RC.read_good(back).drop("_file"))


@query("record_scan_chosen")
def q_record_scan_chosen(spark, d):
    """Good records of two of four fields: one shard by its name, all others by theirs."""
    path = scratch_path(spark, "video_records_scan")
    v = X.fx_video(spark, d).withColumn("shard", F.concat(F.lit("part"), (F.col("id").cast("bigint") % 8).cast("string")))
    RC.write_records(v, path, "Example", partition_by="shard", shards=_shards(spark))
    one, others = (RS.scan(spark, path, VIDEO_SCHEMA, "id", "labels", shards=f"*/shard=part{n}/*", records="good") for n in ("3", "[!3]"))
    return one.withColumn("named", F.lit(1)).union(others.withColumn("named", F.lit(0))).select(
        "id", ints_str("labels").alias("labels"), RC.partition_value("_file", "shard").alias("shard"), "named")


TRAINING_SCHEMA = TT.StructType([
    TT.StructField("id", TT.LongType()), TT.StructField("name", TT.StringType()),
    TT.StructField("n_steps", TT.LongType()), TT.StructField("true_len", TT.IntegerType()),
    TT.StructField("frames", TT.ArrayType(TT.ArrayType(TT.DoubleType()))),
    TT.StructField("labels", TT.ArrayType(TT.LongType())),
    TT.StructField("labels_hot", TT.ArrayType(TT.DoubleType()))])


@query("record_sequence_roundtrip")
def q_record_sequence_roundtrip(spark, d):
    path = scratch_path(spark, "training_records")
    tt = training_table(spark, d).select(*[f.name for f in TRAINING_SCHEMA.fields])
    RC.write_records(tt, path, "SequenceExample", shards=_shards(spark))
    back = RC.read_good(RC.read_records(spark, path, TRAINING_SCHEMA, "SequenceExample"))
    return training_table_view(back)


TYPED_SCHEMA = TT.StructType([
    TT.StructField("order_no", TT.LongType()), TT.StructField("customer", TT.IntegerType()),
    TT.StructField("priority", TT.StringType()), TT.StructField("price", TT.FloatType()),
    TT.StructField("parts", TT.ArrayType(TT.DoubleType())), TT.StructField("price_wide", TT.DoubleType())])


@query("record_overwrite_append")
def q_record_overwrite_append(spark, d):
    """Shards written, overwritten and added to: what the manifests in force name."""
    rows = X.fx_sharded(spark, d).select("id", "shard")
    path = scratch_path(spark, "overwritten")
    RC.write_records(rows, path, shards=2, partition_by="shard")
    RC.write_records(rows.where("id % 2 = 0"), path, shards=2, partition_by="shard")
    RC.write_records(rows.where("id % 6 = 3"), path, mode="append", shards=2, partition_by="shard")
    back = RC.read_good(RC.read_records(spark, path, "id bigint"))
    return back.select("id", RC.partition_value("_file", "shard").alias("shard"))


@query("typed_roundtrip")
def q_typed_roundtrip(spark, d):
    o = X.table(spark, d, "orders")
    typed = o.select(F.col("o_orderkey").alias("order_no"), F.col("o_custkey").cast("int").alias("customer"),
                     F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("float").alias("price"),
                     F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double")).alias("parts"),
                     F.col("o_totalprice").alias("price_wide"))
    path = scratch_path(spark, "typed_records")
    RC.write_records(typed, path, "Example", shards=_shards(spark))
    back = RC.read_good(RC.read_records(spark, path, TYPED_SCHEMA, "Example"))
    return back.select("order_no", "customer", "priority", "price", "price_wide", dec_str("parts", 2).alias("parts"))


@query("quarantine_records")
def q_quarantine_records(spark, d):
    """Record shards (one directory per shard, records in id order) with the
    last record of the first shard cut short and one payload byte of the first
    record of the second shard flipped: good rows are kept, each bad record is
    reported with its shard and reason (S15, Q11)."""
    path = scratch_path(spark, "bad_records")
    v = X.fx_video(spark, d).withColumn(
        "shard", F.concat(F.lit("part"), (F.col("id").cast("bigint") % 8).cast("string")))
    RC.write_records(v, path, "Example", shards=8, partition_by="shard", sort_by=["id"], tasks_per_value=1)
    RC.damage_shards(path)
    back = RC.read_records(spark, path, VIDEO_SCHEMA, "Example")
    return (back.withColumn("shard", RC.partition_value("_file", "shard"))
                .withColumn("reason", F.coalesce(F.regexp_replace("_error", " at byte [0-9]+$", ""), F.lit("ok")))
                .groupBy("shard", "reason").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- incremental ingest


def ingest_transform(video_side: DataFrame):
    def t(stream: DataFrame) -> DataFrame:
        s = stream.select(F.col("event_id"), F.col("user_id").alias("id"),
                          F.get_json_object("props", "$.k").cast("bigint").alias("k"), "value")
        return s.join(video_side, "id", "inner")
    return t


@query("incremental_ingest")
def q_incremental_ingest(spark, d):
    base = scratch_path(spark, "ingest")
    ev = X.table(spark, d, "events")
    side = X.fx_video_side(spark, d)
    tf = ingest_transform(side)
    wave = F.pmod(F.col("event_id"), F.lit(2))
    ev.where(wave == 0).write.parquet(f"{base}/landing/wave0")
    ingest_once(spark, f"{base}/landing/*", ev.schema, tf, f"{base}/sink", f"{base}/ckpt")
    ev.where(wave == 1).write.parquet(f"{base}/landing/wave1")
    ingest_once(spark, f"{base}/landing/*", ev.schema, tf, f"{base}/sink", f"{base}/ckpt")
    ingest_once(spark, f"{base}/landing/*", ev.schema, tf, f"{base}/sink", f"{base}/ckpt")  # no new files
    return spark.read.parquet(f"{base}/sink").select("event_id", "id", "name", "k", "value")


@query("incremental_record_ingest")
def q_incremental_record_ingest(spark, d):
    """Video-level record shards arriving in two waves, each decoded exactly once (G1 on records)."""
    from mediafeat.streaming.ingest import ingest_records_once
    base = scratch_path(spark, "record_ingest")
    v = X.fx_video(spark, d)
    wave = F.col("id").cast("bigint") % 2
    RC.write_records(v.where(wave == 0), f"{base}/landing/wave0", "Example", shards=_shards(spark))
    args = (spark, f"{base}/landing/*", VIDEO_SCHEMA, f"{base}/sink", f"{base}/ckpt")
    ingest_records_once(*args)
    RC.write_records(v.where(wave == 1), f"{base}/landing/wave1", "Example", shards=_shards(spark))
    ingest_records_once(*args)
    ingest_records_once(*args)  # nothing new
    return _long_form(RC.read_good(spark.read.parquet(f"{base}/sink")).drop("_file"))


# ---------------------------------------------------------------- training (rows-only checks)


def _video_xy(spark, d):
    v = X.fx_video(spark, d)
    v = v.withColumn("x", V.fuse("mean_rgb", "mean_audio").cast("array<double>"))
    return L.encode_positional(v, K, out_col="y")


@query("train_linear_avg")
def q_train_linear_avg(spark, d):
    data = P.split_holdout(_video_xy(spark, d), "id", DF.VALIDATION_RATIO, SEED)
    model = TR.fit_multilabel(data.where("split = 'train'"), "x", "y", "id", epochs=DF.EPOCHS,
                              batch_size=DF.BATCH_SIZE, lr=0.5)
    return TR.history_frame(spark, model)


STEP_RATE = 0.5


def _full_batch(spark, d):
    return TR.fit_multilabel(_video_xy(spark, d), "x", "y", "id", epochs=1, batch_size=1 << 30, lr=STEP_RATE)


@query("train_one_step")
def q_train_one_step(spark, d):
    """One full-batch step from zero weights: the weighted mean of the partitions'
    steps is the step over all rows, which SQL can sum."""
    path = scratch_path(spark, "one_step")
    TR.save_weights(spark, _full_batch(spark, d), path, epoch=1)
    w = spark.read.parquet(path).select("cls", F.posexplode("weights").alias("pos", "w"))
    return w.select("cls", "pos", F.round("w", 6).alias("w"))


@query("reloaded_scores")
def q_reloaded_scores(spark, d):
    """Rows scored with weights that were saved and loaded again, by both forms of
    scoring (in the plan, and broadcast)."""
    path = scratch_path(spark, "reloaded")
    TR.save_weights(spark, _full_batch(spark, d), path, epoch=1)
    model = TR.load_weights(spark, path)
    rows = _video_xy(spark, d).select("id", "x")
    return rows.select("id", F.round(F.array_max(model.score_expr("x", spark)), 6).alias("inline"),
                       F.round(F.array_max(model.score_expr("x", spark, inline=False)), 6).alias("broadcast"))


def _damaged_xy(spark, d):
    """The training rows, of which a tenth each has a null element, a NaN, a short
    vector and no label."""
    kind = F.col("id").cast("bigint") % 10
    i = lambda at, v: F.transform("x", lambda e, k: F.when(k == at, v).otherwise(e))
    x = (F.when(kind == 0, i(3, F.lit(None).cast("double"))).when(kind == 1, i(5, F.lit(float("nan"))))
         .when(kind == 2, F.slice("x", 1, 10)).otherwise(F.col("x")))
    return _video_xy(spark, d).select("id", x.alias("x"), F.when(kind != 3, F.col("y")).alias("y"))


@query("fit_input_report")
def q_fit_input_report(spark, d):
    """Rows that a fit takes and leaves out, by reason."""
    return TR.input_report(_damaged_xy(spark, d), "x", "y").select(F.coalesce("reason", F.lit("usable")).alias("reason"), "n")


@query("train_step_damaged")
def q_train_step_damaged(spark, d):
    """One full-batch step over rows of which four tenths are damaged: the step over the
    others."""
    model = TR.fit_multilabel(_damaged_xy(spark, d), "x", "y", "id", epochs=1, batch_size=1 << 30, lr=STEP_RATE)
    path = scratch_path(spark, "damaged_step")
    TR.save_weights(spark, model, path, epoch=1)
    w = spark.read.parquet(path).select("cls", F.posexplode("weights").alias("pos", "w"))
    return w.select("cls", "pos", F.round("w", 6).alias("w"))


@query("train_chunked_step")
def q_train_chunked_step(spark, d):
    """The step of ``train_one_step`` with the parameters held as chunk rows."""
    model = N.fit(_video_xy(spark, d), "x", "y", "id", epochs=1, batch_size=1 << 30, lr=STEP_RATE, chunk=100)
    return model.weights().select(F.col("out").alias("cls"), F.col("inp").alias("pos"), F.round("w", 6).alias("w"))


def _network(spark, d):
    return N.fit(_video_xy(spark, d), "x", "y", "id", [8], epochs=1, batch_size=1 << 30, lr=STEP_RATE)


@query("train_network_step")
def q_train_network_step(spark, d):
    """One full-batch step of a network with a hidden layer on multi-hot targets."""
    return _network(spark, d).weights().withColumn("w", F.round("w", 6))


@query("network_scores")
def q_network_scores(spark, d):
    """Rows scored by that network, with its parameters broadcast and as chunk rows."""
    model = _network(spark, d)
    rows = _video_xy(spark, d).select("id", "x")
    both = model.score(model.score(rows, "x", "a"), "x", "b", inline=False)
    return both.select("id", F.round(F.array_max("a"), 6).alias("broadcast"), F.round(F.array_max("b"), 6).alias("chunked"))


@query("train_mlp")
def q_train_mlp(spark, d):
    """Fitted on the train rows, scored on the held-out ones."""
    rows = P.split_holdout(_video_xy(spark, d), "id", DF.VALIDATION_RATIO, SEED)
    # one L-BFGS iteration is one pass over the data: the epoch budget of the source
    model, _ = TR.train_mlp(rows.where("split = 'train'"), "x", "y", [64, 32, K], max_iter=DF.EPOCHS)
    pred = model.transform(TR.mlp_rows(rows.where("split = 'dev'"), "x", "y"))
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


@query("train_sequence")
def q_train_sequence(spark, d):
    """Pooled sequence features -> fit with per-epoch validation, early stopping
    (patience 3) and the best epoch kept; the per-epoch history is the result."""
    from mediafeat.plans.sequence_training import train_sequence_model
    model = train_sequence_model(training_table(spark, d, short="pad"), epochs=DF.EPOCHS, batch_size=DF.BATCH_SIZE)
    return TR.history_frame(spark, model)


@query("model_roundtrip")
def q_model_roundtrip(spark, d):
    data = _video_xy(spark, d)
    model = TR.fit_multilabel(data, "x", "y", "id", epochs=3, batch_size=32, lr=0.5)
    path = scratch_path(spark, "model")
    TR.save_weights(spark, model, path, epoch=3)
    back = TR.load_weights(spark, path)
    scored = data.withColumn("p", back.score_expr("x"))
    return M.topclass_accuracy(scored, "y", "p")


# ---------------------------------------------------------------- end-to-end plans (entries A and B)
from mediafeat.plans import conversion as CV  # noqa: E402
from mediafeat.plans import evaluation as EV  # noqa: E402

CONVERTED_SCHEMA = TT.StructType([
    TT.StructField("id", TT.StringType()), TT.StructField("split", TT.StringType()),
    TT.StructField("n_steps", TT.LongType()), TT.StructField("true_len", TT.IntegerType()),
    TT.StructField("frame_rgb", TT.ArrayType(TT.ArrayType(TT.DoubleType()))),
    TT.StructField("frame_audio", TT.ArrayType(TT.ArrayType(TT.DoubleType()))),
    TT.StructField("mean_rgb", TT.ArrayType(TT.DoubleType())),
    TT.StructField("mean_audio", TT.ArrayType(TT.DoubleType())),
    TT.StructField("labels", TT.ArrayType(TT.LongType())),
    TT.StructField("labels_hot", TT.ArrayType(TT.DoubleType()))])


@query("shard_conversion")
def q_shard_conversion(spark, d):
    """Video-level records + long-form frames -> converted sequence records per shard."""
    base = scratch_path(spark, "conversion")
    RC.write_records(X.fx_video(spark, d), f"{base}/video", "Example", shards=_shards(spark))
    video = RC.read_good(RC.read_records(spark, f"{base}/video", VIDEO_SCHEMA, "Example"))
    uid = X.steps_source(spark, d).withColumn("_u", F.col("id"))
    frames = uid.select(
        F.col("_u").cast("string").alias("id"), "ts", "event_id", "value", "props",
        F.concat(F.lit("train"), F.lpad((F.col("_u") % 12).cast("string"), 4, "0"), F.lit(".rec")).alias("shard"))
    k = F.get_json_object("props", "$.k").cast("double")
    conv = CV.convert(frames, video, order=["ts", "event_id"], rgb=F.array(F.col("value"), k),
                      audio=F.array(F.col("value") / F.lit(100.0)), label=k, t=T, k=K, ratio=0.2, seed=SEED,
                      exclude=EXCLUDED)
    CV.write_converted(conv, f"{base}/converted", shards=_shards(spark))
    back = RC.read_good(RC.read_records(spark, f"{base}/converted", CONVERTED_SCHEMA, "SequenceExample"))
    back = back.withColumn("shard", RC.partition_value("_file", "shard"))
    return back.select("id", "shard", "split", "n_steps", "true_len",
                       nested_dec_str("frame_rgb").alias("frame_rgb"),
                       nested_dec_str("frame_audio").alias("frame_audio"),
                       dec_str("mean_rgb", 6).alias("mean_rgb"), ints_str("labels_hot").alias("hot"))


FRAME_SCHEMA = TT.StructType([
    TT.StructField("id", TT.LongType()), TT.StructField("rgb", TT.ArrayType(TT.BinaryType())),
    TT.StructField("audio", TT.ArrayType(TT.BinaryType()))])
FRAME_OUT = TT.StructType([
    TT.StructField("id", TT.LongType()), TT.StructField("name", TT.StringType()), TT.StructField("n_steps", TT.LongType()),
    TT.StructField("true_len", TT.IntegerType()), TT.StructField("rgb", TT.ArrayType(TT.ArrayType(TT.FloatType()))),
    TT.StructField("audio", TT.ArrayType(TT.ArrayType(TT.FloatType())))])


@query("frame_record_conversion")
def q_frame_record_conversion(spark, d):
    """Frame-level records end to end: byte steps written and read back, decoded,
    records whose audio lost a step quarantined, the rest joined with the video
    side, written as sequence records under each shard's own output name and read
    from there."""
    base = scratch_path(spark, "frame_records")

    def byte(c):
        return F.unhex(F.lpad(F.hex(c % 256), 2, "0"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    step = F.struct("ts", "event_id", F.concat(byte(F.col("event_id")), byte(F.floor("value")), byte(k)).alias("rgb"),
                    byte(F.col("event_id") + k).alias("audio"))
    seq = X.steps_source(spark, d).groupBy("id").agg(F.array_sort(F.collect_list(step)).alias("s"))   # one record holds a whole video
    lost = F.when(F.col("id") % 11 == 0, 1).otherwise(0)
    frames = seq.select(
        "id", F.transform("s", lambda x: x["rgb"]).alias("rgb"),
        F.slice(F.transform("s", lambda x: x["audio"]), F.lit(1), F.size("s") - lost).alias("audio"),
        F.concat(F.lit("train"), F.lpad((F.col("id") % 4).cast("string"), 4, "0")).alias("shard"))
    RC.write_records(frames, f"{base}/frames", "SequenceExample", ["rgb", "audio"], shards=_shards(spark), partition_by="shard", plain_names=True)
    back = RC.read_good(RC.read_records(spark, f"{base}/frames", FRAME_SCHEMA, "SequenceExample", ["rgb", "audio"]))
    good, bad = CV.convert_frame_records(back, X.fx_video_side(spark, d), t=T)
    CV.write_by_shard(good.select("id", "name", "n_steps", "true_len", "rgb", "audio", "out_name"), f"{base}/converted", shards=_shards(spark))
    out = RC.read_good(RC.read_records(spark, f"{base}/converted", FRAME_OUT, "SequenceExample"))
    out = out.withColumn("out_name", RC.folder_name("_file")).select(
        "id", "out_name", "name", "n_steps", "true_len", F.array_join(F.transform("rgb", ints_str), ";").alias("rgb"),
        F.array_join(F.transform("audio", ints_str), ";").alias("audio"), F.lit(None).cast("string").alias("reason"))
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("name", "string"), ("n_steps", "bigint"), ("true_len", "int"),
                                                              ("rgb", "string"), ("audio", "string"))]
    return out.unionByName(bad.select("id", "out_name", *nothing, "reason"))


@query("video_train_eval")
def q_video_train_eval(spark, d):
    """Train on video-level record shards, evaluate on the held-out shards."""
    base = scratch_path(spark, "video_eval")
    v = P.split_holdout(X.fx_video(spark, d), "id", DF.VALIDATION_RATIO, SEED)
    RC.write_records(v.where("split = 'train'").drop("split"), f"{base}/train", "Example", shards=_shards(spark))
    RC.write_records(v.where("split = 'dev'").drop("split"), f"{base}/validate", "Example", shards=_shards(spark))
    _, metrics = EV.train_and_evaluate(spark, f"{base}/train", f"{base}/validate", k=K, epochs=DF.EPOCHS,
                                       batch_size=DF.BATCH_SIZE)
    return metrics
