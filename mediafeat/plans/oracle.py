"""DuckDB twins of the registered queries (the correctness oracle).

Fixtures referenced as ``fx_*`` are prepended as CTEs automatically, so every
string runs against the bare input tables.
"""

from __future__ import annotations

import re

from mediafeat.defaults import CONVERTED_SUFFIX, RUN_LABEL_FORMAT
from mediafeat.plans.compare import d_dec, d_ints, d_nested_dec
from mediafeat.plans.fixtures import DUCK

K = 10
T = 10

_SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    _SQL[name] = text


def with_fixtures(text: str) -> str:
    used = []
    for m in re.finditer(r"\bfx_[a-z0-9_]+\b", text):
        if m.group(0) in DUCK and m.group(0) not in used:
            used.append(m.group(0))
    if not used:
        return text
    ctes = ",\n".join(f"{u} AS ({DUCK[u]})" for u in used)
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def oracle() -> dict[str, str]:
    return {k: with_fixtures(v) for k, v in _SQL.items()}


# ---------------------------------------------------------------- labels
VOCAB_ID = (f"SELECT label FROM (SELECT DISTINCT unnest(labels) AS label FROM {{src}}) "
            f"ORDER BY label LIMIT {K - 1}")
VOCAB_LIST = "SELECT coalesce(list(label ORDER BY label), []) AS v FROM (" + VOCAB_ID + ")"
HOT = (f"list_concat(list_transform(v, lambda l: CASE WHEN list_contains(labels, l) THEN 1 ELSE 0 END), "
       f"list_transform(range({K - 1} - len(v)), lambda x: 0), "
       f"[CASE WHEN len(list_intersect(labels, v)) > 0 THEN 0 ELSE 1 END])")
POS = f"list_transform(range({K}), lambda i: CASE WHEN list_contains(labels, i) THEN 1 ELSE 0 END)"

sql("label_histogram",
    "SELECT label, count(*) AS cnt FROM (SELECT unnest(labels) AS label FROM fx_bags) GROUP BY label")

sql("vocab_by_id",
    f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx, cnt FROM ("
    f"SELECT label, count(*) AS cnt FROM (SELECT unnest(labels) AS label FROM fx_bags) GROUP BY label "
    f"ORDER BY label LIMIT {K - 1})")

sql("vocab_by_frequency",
    f"SELECT label, CAST(row_number() OVER (ORDER BY cnt DESC, label) - 1 AS INTEGER) AS idx, cnt FROM ("
    f"SELECT label, count(*) AS cnt FROM (SELECT unnest(labels) AS label FROM fx_bags) GROUP BY label "
    f"ORDER BY cnt DESC, label LIMIT {K - 1})")

sql("multihot_vocab",
    f"WITH vocab AS ({VOCAB_LIST.format(src='fx_bags')}) "
    f"SELECT id, {d_ints(HOT)} AS hot FROM fx_bags, vocab")

sql("multihot_positional", f"SELECT id, {d_ints(POS)} AS hot FROM fx_bags")

sql("label_coverage",
    f"WITH vocab AS ({VOCAB_LIST.format(src='fx_bags')}), "
    f"enc AS (SELECT len(list_intersect(labels, v)) AS n_kept, "
    f"len(list_filter(labels, lambda x: x >= 0 AND x < {K})) AS n_pos FROM fx_bags, vocab) "
    f"SELECT count(*) AS n_rows, CAST(count_if(n_kept = 0) AS BIGINT) AS n_other, "
    f"CAST(sum(n_kept + CASE WHEN n_kept = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hot_slots, "
    f"CAST(count_if(n_pos = 0) AS BIGINT) AS n_zero FROM enc")

sql("label_slot_join",
    f"WITH vocab AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx "
    f"FROM ({VOCAB_ID.format(src='fx_bags')})), "
    f"ex AS (SELECT id, unnest(labels) AS label FROM fx_bags) "
    f"SELECT ex.id, coalesce({d_ints('list_sort(list(DISTINCT idx) FILTER (WHERE idx IS NOT NULL))')}, '') AS slots, "
    f"count(DISTINCT idx) AS n_kept FROM ex LEFT JOIN vocab USING (label) GROUP BY ex.id")

# ---------------------------------------------------------------- flagship + sequences
STEPS = ("SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, value, "
         "[value, CAST(json_extract_string(props, '$.k') AS DOUBLE)] AS v, "
         "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
FRAMES = (f"WITH st AS ({STEPS}), "
          f"seq AS (SELECT id, list(v ORDER BY rn) FILTER (WHERE rn <= {T}) AS s, count(*) AS n_steps, "
          f"list_sort(list_distinct(list(k))) AS labels FROM st GROUP BY id)")
VSEQ = (f"WITH st AS ({STEPS}), "
        f"seq AS (SELECT id, list(value ORDER BY rn) FILTER (WHERE rn <= {T}) AS s, count(*) AS n_steps "
        f"FROM st GROUP BY id)")

sql("training_table",
    f"{FRAMES}, "
    f"j AS (SELECT seq.*, fv.name FROM seq JOIN fx_video_side fv ON seq.id = fv.id), "
    f"vocab AS ({VOCAB_LIST.format(src='j')}) "
    f"SELECT id, name, n_steps, CAST(len(s) AS INTEGER) AS true_len, "
    f"{d_nested_dec(f'list_concat(s, list_transform(range({T} - len(s)), lambda x: [0.0::DOUBLE, 0.0::DOUBLE]))')} AS frames, "
    f"{d_ints('labels')} AS labels, {d_ints(HOT)} AS hot FROM j, vocab")

sql("frame_video_join",
    "SELECT s.id, s.step, s.value, v.name FROM fx_steps s JOIN fx_video_side v ON s.id = v.id")

sql("frames_without_video",
    "SELECT id, count(*) AS n_frames FROM fx_steps s "
    "WHERE NOT EXISTS (SELECT 1 FROM fx_video_side v WHERE v.id = s.id) GROUP BY id")

sql("steps_per_video", "SELECT id, count(*) AS n_steps FROM fx_steps GROUP BY id")

_STEP_BLOCKS = ("SELECT user_id AS id, CAST(floor((rn - 1) / 32) AS INTEGER) AS block, max(n) AS n_steps, {} AS s FROM ("
                "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n "
                "FROM events) GROUP BY ALL")
sql("sequence_assembly", f"SELECT id, block, n_steps, {d_dec('s')} AS seq FROM (" + _STEP_BLOCKS.format("list(value ORDER BY rn)") + ")")

sql("truncate_sequence", f"{VSEQ} SELECT id, {d_dec('s')} AS seq FROM seq WHERE len(s) = {T}")

sql("pad_sequence",
    f"{VSEQ} SELECT id, CAST(len(s) AS INTEGER) AS true_len, "
    f"{d_dec(f'list_concat(s, list_transform(range({T} - len(s)), lambda x: 0.0::DOUBLE))')} AS seq FROM seq")

sql("flatten_sequence", f"SELECT id, block, {d_dec('flatten(s)')} AS flat FROM (" + _STEP_BLOCKS.format(
    "list([value, CAST(json_extract_string(props, '$.k') AS DOUBLE)] ORDER BY rn)") + ")")

_MEAN = "list_transform(range(2), lambda j: list_reduce(list_transform(s, lambda v: v[j + 1]), lambda a, b: a + b) / len(s))"
_MAX = "list_transform(range(2), lambda j: list_max(list_transform(s, lambda v: v[j + 1])))"
_FIRST = "list_transform(range(2), lambda j: s[1][j + 1])"
_LAST = "list_transform(range(2), lambda j: s[len(s)][j + 1])"
# DuckDB lambda indexes are 1-based: step t (0-based) = i - 1
_W_FWD = "list_transform(s, lambda v, i: pow(0.5, len(s) - i))"
_W_BWD = "list_transform(s, lambda v, i: pow(0.5, i - 1))"


def _decayed(weights: str) -> str:
    return (f"list_transform(range(2), lambda j: list_reduce(list_transform(s, lambda v, i: v[j + 1] * "
            f"{weights}[i]), lambda a, b: a + b) / list_reduce({weights}, lambda a, b: a + b))")


sql("sequence_pooling",
    f"{FRAMES} SELECT id, {d_dec(_MEAN, 6)} AS mean, {d_dec(_MAX, 6)} AS max, "
    f"{d_dec(_FIRST, 6)} AS first, {d_dec(_LAST, 6)} AS last, "
    f"{d_dec(_decayed(_W_FWD), 6)} AS fwd, {d_dec(_decayed(_W_BWD), 6)} AS bwd FROM seq")

# ---------------------------------------------------------------- vectors, projections
sql("fuse_features",
    f"SELECT id, CAST(len(list_concat(mean_rgb, mean_audio)) AS INTEGER) AS dims, "
    f"{d_dec('list_concat(mean_rgb, mean_audio)', 6)} AS fused FROM fx_video")

sql("vector_dims",
    "SELECT id, CAST(len(mean_rgb) AS INTEGER) AS n_rgb, CAST(len(mean_audio) AS INTEGER) AS n_audio FROM fx_video")

sql("vector_preview", f"SELECT id, {d_dec('mean_rgb[1:20]', 6)} AS preview FROM fx_video")

sql("project_features", f"SELECT {d_dec('mean_rgb', 6)} AS rgb, {d_ints('labels')} AS labels FROM fx_video")

sql("feature_label_pairs", f"SELECT {d_dec('mean_rgb', 6)} AS features, {d_ints(POS)} AS label FROM fx_video")

sql("multi_input_pairs",
    f"WITH vocab AS ({VOCAB_LIST.format(src='fx_video')}) "
    f"SELECT id, {d_dec('mean_audio', 6)} AS audio, {d_dec('mean_rgb', 6)} AS rgb, {d_ints(HOT)} AS label "
    f"FROM fx_video, vocab")

sql("integrity_counts",
    "SELECT count(*) AS n_rows, count(id) AS n_ids, count(labels) AS n_labels FROM fx_video")

sql("row_count",
    " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}"
                       for t in ("lineitem", "orders", "events", "embeddings", "documents")))

sql("argmax_class",
    "SELECT id, cls, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS pred FROM fx_scores")

# ---------------------------------------------------------------- splits, shards, limits
SEED = 7
KEYED = "SELECT *, md5(concat(CAST(id AS VARCHAR), '#', '{seed}')) AS skey FROM {src}"
SPLIT = ("SELECT *, CASE WHEN row_number() OVER (ORDER BY skey DESC) <= "
         "(SELECT greatest(1, CAST(floor(count(*) * {ratio}::DOUBLE) AS BIGINT)) FROM {src}) "
         "THEN 'dev' ELSE 'train' END AS split FROM (" + KEYED + ")")

sql("take_ordered", f"SELECT id, {d_ints('labels')} AS labels FROM fx_video ORDER BY id LIMIT 20")

sql("seeded_shuffle", f"SELECT id, md5(concat(id, '#', '{SEED}')) AS shuffle_key FROM fx_video")

sql("holdout_split", "SELECT id, split FROM (" + SPLIT.format(seed=SEED, ratio=0.2, src="fx_video") + ")")

_SH = SPLIT.format(seed=11, ratio=0.2, src="fx_sharded")
sql("split_is_partition",
    f"WITH s AS ({_SH}) "
    "SELECT 'n_full' AS m, count(*) AS v FROM fx_sharded "
    "UNION ALL SELECT 'n_train', count(*) FROM s WHERE split = 'train' "
    "UNION ALL SELECT 'n_dev', count(*) FROM s WHERE split = 'dev' "
    "UNION ALL SELECT 'n_both', (SELECT count(*) FROM (SELECT id, shard, amount FROM s WHERE split = 'train' "
    "INTERSECT SELECT id, shard, amount FROM s WHERE split = 'dev')) "
    "UNION ALL SELECT 'n_lost', (SELECT count(*) FROM (SELECT id, shard, amount FROM fx_sharded "
    "EXCEPT ALL SELECT id, shard, amount FROM s)) "
    "UNION ALL SELECT 'n_extra', (SELECT count(*) FROM (SELECT id, shard, amount FROM s "
    "EXCEPT ALL SELECT id, shard, amount FROM fx_sharded))")

sql("union_shards", "SELECT shard, count(*) AS n FROM fx_sharded GROUP BY shard")
sql("records_per_shard", "SELECT shard, count(*) AS n FROM fx_sharded GROUP BY shard")
sql("exclude_shards",
    "SELECT id, shard FROM fx_sharded WHERE shard NOT IN ('train0003.rec', 'train0007.rec', 'train0011.rec')")
sql("limit_shards",
    "SELECT id, shard FROM fx_sharded WHERE shard IN (SELECT DISTINCT shard FROM fx_sharded ORDER BY shard LIMIT 5)")
sql("limit_shards_with_nulls",
    "WITH s AS (SELECT id, CASE WHEN id % 7 <> 0 THEN shard END AS shard FROM fx_sharded) "
    "SELECT id, shard FROM s WHERE shard IN (SELECT DISTINCT shard FROM s WHERE shard IS NOT NULL ORDER BY shard LIMIT 5)")
sql("record_overwrite_append", "SELECT id, shard FROM fx_sharded WHERE id % 2 = 0 OR id % 6 = 3")
sql("limit_per_shard",
    "SELECT id, shard, rn FROM (SELECT id, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY id) AS INTEGER) AS rn "
    "FROM fx_sharded) WHERE rn <= 100")
sql("chunk_assignment",
    "SELECT shard, CAST(floor((row_number() OVER (ORDER BY shard) - 1) / ceil(count(*) OVER () / 4.0::DOUBLE)) AS INTEGER) "
    "AS chunk FROM (SELECT DISTINCT shard FROM fx_sharded)")
sql("multi_source_scan",
    "SELECT CASE WHEN shard < 'train0010.rec' THEN 'train' ELSE 'validate' END AS source, shard, count(*) AS n "
    "FROM fx_sharded GROUP BY ALL")
sql("quarantine_counts",
    "SELECT shard, CASE WHEN amount IS NULL THEN 'missing_amount' WHEN amount <= 0 THEN 'non_positive_amount' "
    "WHEN NOT regexp_matches(shard, '^train[0-9]{4}\\.rec$') THEN 'bad_shard_name' "
    "WHEN amount > 450000 THEN 'outlier_amount' ELSE 'ok' END AS reason, count(*) AS n FROM fx_sharded GROUP BY ALL")
sql("shard_output_names",
    "SELECT shard, concat(string_split(concat('data/frame/', shard), '/')[-1], '" + CONVERTED_SUFFIX + "') AS out_name, "
    "count(*) AS n FROM fx_sharded GROUP BY ALL")

# ---------------------------------------------------------------- metrics and scoring
HIST = ("SELECT user_id AS id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) "
        "AS epoch, value AS loss FROM events")
ES = (f"WITH h AS ({HIST}), "
      "b AS (SELECT *, min(loss) OVER (PARTITION BY id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
      "AS best_before FROM h), "
      "i AS (SELECT *, (best_before IS NULL OR loss < best_before) AS improved FROM b), "
      "l AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY id ORDER BY epoch "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM i), "
      "s AS (SELECT id, coalesce(min(CASE WHEN epoch - last_imp >= 3 THEN epoch END), max(epoch)) AS stop_epoch "
      "FROM l GROUP BY id), "
      "k AS (SELECT l.*, s.stop_epoch FROM l JOIN s USING (id) WHERE l.epoch <= s.stop_epoch)")

sql("topclass_accuracy",
    "SELECT count(*) AS n, CAST(sum(CASE WHEN cls = list_position(scores, list_max(scores)) - 1 THEN 1 ELSE 0 END) AS BIGINT) "
    "AS correct, round(avg(CASE WHEN cls = list_position(scores, list_max(scores)) - 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) "
    "AS accuracy FROM fx_scores")

sql("categorical_crossentropy",
    "SELECT cls, count(*) AS n, round(avg(lse - CAST(scores[cls + 1] AS DOUBLE)), 6) AS loss FROM ("
    "SELECT cls, scores, CAST(list_max(scores) AS DOUBLE) + ln(list_reduce(list_transform(scores, "
    "lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(scores) AS DOUBLE))), lambda a, b: a + b)) AS lse "
    "FROM fx_scores) GROUP BY cls")


def _weights_sql() -> str:
    rows = [[((c * 7 + j * 3) % 11 - 5) / 10.0 for j in range(64)] for c in range(10)]
    return "[" + ", ".join("[" + ", ".join(f"{w!r}::DOUBLE" for w in r) + "]" for r in rows) + "]"


_SCORES = ("list_transform(" + _weights_sql() + ", lambda w: list_reduce(list_transform(range(64), "
           "lambda j: w[j + 1] * x[j + 1]), lambda a, b: a + b))")
sql("score_linear",
    f"SELECT id, CAST(list_position(sc, list_max(sc)) - 1 AS INTEGER) AS pred, round(list_max(sc), 6) AS top FROM ("
    f"SELECT id, {_SCORES} AS sc FROM (SELECT id, CAST(list_concat(mean_rgb, mean_audio) AS DOUBLE[]) AS x FROM fx_video))")

sql("standardise_features",
    "SELECT CAST(pos AS INTEGER) AS pos, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std FROM ("
    "SELECT unnest(range(len(mean_rgb))) AS pos, unnest(mean_rgb) AS v FROM fx_video) GROUP BY pos")

sql("speedup",
    "SELECT user_id AS id, event_id, first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) "
    "/ nullif(value, 0.0) AS speedup FROM events")

sql("parallel_efficiency",
    f"WITH h AS ({HIST}) SELECT id, epoch AS nodes, first_value(loss) OVER (PARTITION BY id ORDER BY epoch) "
    "/ nullif(loss, 0.0) / CAST(epoch AS DOUBLE) AS efficiency FROM h")

sql("early_stop_epoch", f"{ES} SELECT id, stop_epoch FROM s")

sql("best_checkpoint",
    f"{ES} SELECT id, min(epoch) FILTER (WHERE loss = best) AS best_epoch, round(min(best), 6) AS best_loss, "
    "CAST(count_if(improved) AS BIGINT) AS n_saved FROM (SELECT *, min(loss) OVER (PARTITION BY id) AS best FROM k) "
    "GROUP BY id")

sql("run_label",
    "SELECT user_id AS id, printf('" + RUN_LABEL_FORMAT + "', count(*), max(CAST(json_extract_string(props, '$.k') AS BIGINT)), "
    "min(value), max(value)) AS label FROM events GROUP BY user_id")

sql("epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs FROM events")

# ---------------------------------------------------------------- text, json, bytes
from mediafeat.functions.text import WHITESPACE_RUN  # noqa: E402

sql("tokenize_words",
    "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '" + WHITESPACE_RUN + "')) AS word "
    "FROM fx_text) WHERE word <> '' GROUP BY word")

sql("query_term", "SELECT p_partkey, replace(p_name, ' ', '+') AS term, "
    "replace(url_encode(concat('v3/businesses/', p_name, '/reviews')), '%2F', '/') AS quoted FROM part")

sql("json_field", "SELECT id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM fx_json")

sql("decode_u8",
    "SELECT id, " + d_ints("list_transform(regexp_extract_all(hex, '..'), lambda x: CAST(('0x' || x) AS INTEGER))")
    + " AS vals FROM fx_u8")

sql("struct_field",
    "SELECT l_orderkey AS id, " + d_dec("list(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity)", 2) + " AS quantities FROM lineitem GROUP BY l_orderkey")

sql("location_search", "SELECT business_id, term, location FROM fx_business WHERE term = 'other' AND location = 'Brand#13'")

_CUST = "SELECT o_orderkey AS id, nullif(o_custkey % 1000, 7) AS customer, o_orderpriority FROM orders"
sql("exclude_many",
    f"WITH o AS ({_CUST}) SELECT id, customer FROM o WHERE NOT EXISTS (SELECT 1 FROM o AS u WHERE u.customer = o.customer "
    "AND u.o_orderpriority = '1-URGENT')")

sql("exclude_with_nulls",
    "SELECT nullif(shard, 'train0005.rec') AS shard, count(*) AS n FROM fx_sharded "
    "WHERE shard NOT IN ('train0003.rec', 'train0007.rec', 'train0011.rec') GROUP BY ALL")

sql("holdout_with_nulls",
    "WITH k AS (SELECT id, md5(concat(id, '#', '7')) AS skey FROM fx_video WHERE CAST(id AS BIGINT) % 5 <> 0), "
    "r AS (SELECT id, row_number() OVER (ORDER BY skey DESC) AS rn FROM k) "
    "SELECT v.id, CASE WHEN rn <= (SELECT greatest(1, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT)) FROM k) THEN 'dev' ELSE 'train' END AS split "
    "FROM fx_video v LEFT JOIN r ON v.id = r.id")

_ROWNUM = ("SELECT event_id, nullif(user_id % 10, 3) AS g, CAST(row_number() OVER (PARTITION BY nullif(user_id % 10, 3) "
           "ORDER BY event_id) AS INTEGER) AS rn FROM events")
sql("row_numbers_plain", _ROWNUM)
sql("row_numbers_hot", _ROWNUM)

sql("standardise_apply",
    "WITH x AS (SELECT id, unnest(range(len(mean_rgb))) AS pos, CAST(unnest(mean_rgb) AS DOUBLE) AS v FROM fx_video), "
    "m AS (SELECT pos, avg(v) AS mu, stddev_samp(v) AS sd FROM x GROUP BY pos) "
    "SELECT id, " + d_dec("list(CASE WHEN sd > 0 THEN round((v - mu) / sd, 3) ELSE 0.0 END ORDER BY pos)", 3) + " AS z "
    "FROM x JOIN m USING (pos) GROUP BY id")

sql("label_slots_shared_ids",
    f"WITH vocab AS ({VOCAB_LIST.format(src='fx_bags')}) "
    "SELECT id % 100 AS id, " + d_ints("list_filter(list_transform(range(len(v)), lambda i: CASE WHEN list_contains(labels, v[i + 1]) THEN i END), "
                                     "lambda i: i IS NOT NULL)") + " AS slots, "
    "CAST(len(list_intersect(labels, v)) AS BIGINT) AS n_kept FROM fx_bags, vocab")

sql("epoch_seconds_instant", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) + 18000 AS secs FROM events")

# ---------------------------------------------------------------- geo
from mediafeat.functions.geo import haversine_sql  # noqa: E402

_HAV = haversine_sql("p.lat", "p.lng", "b.lat", "b.lng")
_BIZ = "b AS (SELECT * FROM fx_business WHERE term = 'food' AND attribute = 'hot_and_new')"
GEO = (f"WITH {_BIZ} SELECT p.id, p.lat, p.lng, CAST(least(count(b.business_id), 50) AS BIGINT) AS new_businesses, "
       f"count(b.business_id) AS n_within FROM fx_places p LEFT JOIN b ON {_HAV} <= 1000.0 GROUP BY p.id, p.lat, p.lng")
sql("geo_new_businesses", GEO)
sql("csv_roundtrip", GEO)

sql("business_search",
    f"WITH {_BIZ}, pr AS (SELECT p.id, b.business_id, {_HAV} AS d FROM fx_places p JOIN b ON {_HAV} <= 1000.0) "
    "SELECT id, business_id, round(d, 3) AS distance_m, CAST(rk AS INTEGER) AS rank FROM ("
    "SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, business_id) AS rk FROM pr) WHERE rk <= 50")

sql("keyed_lookup",
    "SELECT b.business_id, count(r.stars) AS n_reviews, round(avg(r.stars), 4) AS avg_stars "
    "FROM fx_business b LEFT JOIN fx_reviews r USING (business_id) GROUP BY b.business_id")

sql("json_sample",
    "SELECT id, shard, amount, CAST(to_json({'id': id, 'shard': shard}) AS VARCHAR) AS line FROM fx_sharded ORDER BY id LIMIT 20")

sql("training_table_roundtrip", _SQL["training_table"])

# ---------------------------------------------------------------- record files, ingest
sql("record_example_roundtrip",
    " UNION ALL ".join(
        f"SELECT id, '{name}' AS part, CAST(pos AS INTEGER) AS pos, CAST(v AS DOUBLE) AS val FROM ("
        f"SELECT id, unnest(range(len({col}))) AS pos, unnest({col}) AS v FROM fx_video)"
        for name, col in (("rgb", "mean_rgb"), ("audio", "mean_audio"), ("labels", "labels"))))

sql("record_sequence_roundtrip", _SQL["training_table"])

sql("typed_roundtrip",
    "SELECT o_orderkey AS order_no, CAST(o_custkey AS INTEGER) AS customer, o_orderpriority AS priority, "
    "CAST(o_totalprice AS FLOAT) AS price, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price_wide, "
    + d_dec("[CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), CAST(CAST(o_custkey AS FLOAT) AS DOUBLE)]", 2) + " AS parts FROM orders")

sql("incremental_ingest",
    "SELECT e.event_id, e.user_id AS id, v.name, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k, e.value "
    "FROM events e JOIN fx_video_side v ON e.user_id = v.id")

# ---------------------------------------------------------------- end-to-end conversion
_F32 = "CAST(CAST({} AS FLOAT) AS DOUBLE)"
_SHARD = "concat('train', lpad(CAST(user_id % 12 AS VARCHAR), 4, '0'), '.rec')"
sql("shard_conversion",
    "WITH st AS (SELECT CAST(user_id AS VARCHAR) AS id, " + _SHARD + " AS shard, "
    "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, "
    "[" + _F32.format("value") + ", " + _F32.format("CAST(json_extract_string(props, '$.k') AS DOUBLE)") + "] AS rgb, "
    "[" + _F32.format("value / 100.0") + "] AS audio, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events "
    "WHERE " + _SHARD + " NOT IN ('train0003.rec', 'train0007.rec', 'train0011.rec')), "
    f"seq AS (SELECT id, min(shard) AS shard, list(rgb ORDER BY rn) FILTER (WHERE rn <= {T}) AS fr, "
    f"list(audio ORDER BY rn) FILTER (WHERE rn <= {T}) AS fa, count(*) AS n_steps, "
    "list_sort(list_distinct(list(k))) AS labels FROM st GROUP BY id), "
    "j AS (SELECT seq.*, CAST(v.mean_rgb AS DOUBLE[]) AS mean_rgb FROM seq JOIN fx_video v ON seq.id = v.id), "
    "s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat(id, '#', '7')) DESC) <= "
    "(SELECT greatest(1, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT)) FROM j) THEN 'dev' ELSE 'train' END AS split "
    "FROM j), "
    f"vocab AS ({VOCAB_LIST.format(src='(SELECT * FROM s WHERE split = ' + chr(39) + 'train' + chr(39) + ')')}) "
    "SELECT id, shard, split, n_steps, CAST(len(fr) AS INTEGER) AS true_len, "
    + d_nested_dec(f"list_concat(fr, list_transform(range({T} - len(fr)), lambda x: [0.0::DOUBLE, 0.0::DOUBLE]))")
    + " AS frame_rgb, "
    + d_nested_dec(f"list_concat(fa, list_transform(range({T} - len(fa)), lambda x: [0.0::DOUBLE]))")
    + " AS frame_audio, " + d_dec("mean_rgb", 6) + " AS mean_rgb, " + d_ints(HOT) + " AS hot FROM s, vocab")

_XY = ("xy AS (SELECT id, list_concat(list_transform(list_concat(mean_rgb, mean_audio), lambda v: CAST(v AS DOUBLE)), [1.0::DOUBLE]) AS x, "
       f"{POS} AS y FROM fx_video)")
_W = ("w AS (SELECT c, j, -0.5::DOUBLE * avg((0.5::DOUBLE - y[c + 1]) * x[j + 1]) AS w FROM xy, "
      f"(SELECT unnest(range({K})) AS c) a, (SELECT unnest(range(65)) AS j) b GROUP BY c, j)")
sql("train_one_step", f"WITH {_XY}, {_W} SELECT CAST(c AS INTEGER) AS cls, CAST(j AS INTEGER) AS pos, round(w, 6) AS w FROM w")

_KIND = "CAST(id AS BIGINT) % 10"
sql("fit_input_report",
    f"SELECT CASE WHEN {_KIND} IN (0, 1) THEN 'null or non-finite element' WHEN {_KIND} = 2 THEN 'other length' "
    f"WHEN {_KIND} = 3 THEN 'no vector or label' ELSE 'usable' END AS reason, count(*) AS n FROM fx_video GROUP BY ALL")
sql("train_step_damaged", f"WITH {_XY} , {_W.replace('FROM xy,', f'FROM (SELECT * FROM xy WHERE {_KIND} > 3) xy,')} "
    "SELECT CAST(c AS INTEGER) AS cls, CAST(j AS INTEGER) AS pos, round(w, 6) AS w FROM w")
sql("train_chunked_step", _SQL["train_one_step"])


def _first_weights(at: str, n_in: int, n_out: int) -> str:
    return (f"(2.0::DOUBLE * CAST('0x' || substr(md5('7:' || CAST({at} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE - 1.0::DOUBLE) "
            f"* sqrt(6.0::DOUBLE / {n_in + n_out})")


_NET = (f"{_XY}, w0 AS (SELECT u, j, CASE WHEN j = 64 THEN 0.0::DOUBLE ELSE {_first_weights('u * 65 + j', 64, 8)} END AS w "
        "FROM (SELECT unnest(range(8)) AS u) a, (SELECT unnest(range(65)) AS j) b), "
        f"w1 AS (SELECT c, u, CASE WHEN u = 8 THEN 0.0::DOUBLE ELSE {_first_weights('520 + c * 9 + u', 8, K)} END AS w "
        f"FROM (SELECT unnest(range({K})) AS c) a, (SELECT unnest(range(9)) AS u) b), "
        "h AS (SELECT id, u, greatest(sum(w * x[j + 1]), 0.0::DOUBLE) AS h FROM xy, w0 GROUP BY id, u "
        "UNION ALL SELECT id, 8, 1.0::DOUBLE FROM xy), "
        "dl AS (SELECT id, c, 1.0::DOUBLE / (1.0::DOUBLE + exp(-sum(w * h))) - any_value(y[c + 1]) AS d "
        "FROM h JOIN w1 USING (u) JOIN xy USING (id) GROUP BY id, c), "
        "g1 AS (SELECT c, u, avg(d * h) AS g FROM dl JOIN h USING (id) GROUP BY c, u), "
        "b AS (SELECT id, u, CASE WHEN any_value(h) > 0 THEN sum(d * w) ELSE 0.0::DOUBLE END AS b FROM dl JOIN w1 USING (c) JOIN h USING (id, u) "
        "WHERE u < 8 GROUP BY id, u), "
        "g0 AS (SELECT u, j, avg(b * x[j + 1]) AS g FROM b JOIN xy USING (id), (SELECT unnest(range(65)) AS j) k GROUP BY u, j), "
        "n0 AS (SELECT u, j, w - 0.5::DOUBLE * g AS w FROM w0 JOIN g0 USING (u, j)), "
        "n1 AS (SELECT c, u, w - 0.5::DOUBLE * g AS w FROM w1 JOIN g1 USING (c, u))")
sql("train_network_step",
    f"WITH {_NET} SELECT CAST(0 AS INTEGER) AS layer, CAST(u AS INTEGER) AS out, CAST(j AS INTEGER) AS inp, round(w, 6) AS w FROM n0 "
    "UNION ALL SELECT 1, CAST(c AS INTEGER), CAST(u AS INTEGER), round(w, 6) FROM n1")
sql("network_scores",
    f"WITH {_NET}, h2 AS (SELECT id, u, greatest(sum(w * x[j + 1]), 0.0::DOUBLE) AS h FROM xy, n0 GROUP BY id, u "
    "UNION ALL SELECT id, 8, 1.0::DOUBLE FROM xy), "
    "p AS (SELECT id, c, 1.0::DOUBLE / (1.0::DOUBLE + exp(-sum(w * h))) AS p FROM h2 JOIN n1 USING (u) GROUP BY id, c) "
    "SELECT id, round(max(p), 6) AS broadcast, round(max(p), 6) AS chunked FROM p GROUP BY id")

_TOP = ("round(max(1.0::DOUBLE / (1.0::DOUBLE + exp(-s))), 6)")
sql("reloaded_scores",
    f"WITH {_XY}, {_W}, s AS (SELECT id, c, sum(w * x[j + 1]) AS s FROM xy, w GROUP BY id, c) "
    f"SELECT id, {_TOP} AS inline, {_TOP} AS broadcast FROM s GROUP BY id")

_FST = ("st AS (SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, "
        "concat(event_id % 256, ',', CAST(floor(value) AS BIGINT) % 256, ',', CAST(json_extract_string(props, '$.k') AS BIGINT) % 256) AS rgb, "
        "CAST((event_id + CAST(json_extract_string(props, '$.k') AS BIGINT)) % 256 AS VARCHAR) AS audio FROM events), "
        f"sq AS (SELECT id, count(*) AS n, list(rgb ORDER BY rn) FILTER (WHERE rn <= {T}) AS rgb, "
        f"list(audio ORDER BY rn) FILTER (WHERE rn <= {T}) AS audio, "
        "concat('train', lpad(CAST(id % 4 AS VARCHAR), 4, '0'), '" + CONVERTED_SUFFIX + "') AS out_name FROM st GROUP BY id)")
sql("frame_record_conversion",
    f"WITH {_FST} SELECT sq.id, out_name, v.name, n AS n_steps, CAST(len(rgb) AS INTEGER) AS true_len, "
    f"array_to_string(list_concat(rgb, list_transform(range({T} - len(rgb)), lambda x: '0,0,0')), ';') AS rgb, "
    f"array_to_string(list_concat(audio, list_transform(range({T} - len(audio)), lambda x: '0')), ';') AS audio, "
    "CAST(NULL AS VARCHAR) AS reason FROM sq JOIN fx_video_side v ON v.id = sq.id WHERE sq.id % 11 <> 0 "
    "UNION ALL SELECT id, out_name, NULL, NULL, NULL, NULL, NULL, 'step count mismatch' FROM sq WHERE id % 11 = 0")

sql("quarantine_records",
    "WITH v AS (SELECT id, 'part' || CAST(CAST(id AS BIGINT) % 8 AS VARCHAR) AS shard FROM fx_video), "
    "bad AS (SELECT 'part0' AS shard, max(id) AS id, 'truncated record' AS reason FROM v WHERE shard = 'part0' "
    "UNION ALL SELECT 'part1', min(id), 'payload checksum mismatch' FROM v WHERE shard = 'part1') "
    "SELECT shard, 'ok' AS reason, count(*) AS n FROM v WHERE id NOT IN (SELECT id FROM bad) GROUP BY shard "
    "UNION ALL SELECT shard, reason, CAST(1 AS BIGINT) AS n FROM bad")

sql("incremental_record_ingest", _SQL["record_example_roundtrip"])

sql("record_split_scan", _SQL["record_example_roundtrip"])

# ---------------------------------------------------------------- sparse labels, layout, scan
sql("sparse_vocab",
    "SELECT label, CAST(row_number() OVER (ORDER BY cnt DESC, label) - 1 AS BIGINT) AS idx, cnt FROM ("
    "SELECT l_partkey AS label, count(*) AS cnt FROM lineitem GROUP BY l_partkey)")

_LINES = "lines AS (SELECT DISTINCT l_partkey AS id, l_orderkey * 8 + l_linenumber AS label FROM lineitem)"
sql("sparse_encoding",
    f"WITH {_LINES}, vocab AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM lines) "
    "QUALIFY idx < 200000), "
    "found AS (SELECT id, coalesce(list(idx ORDER BY idx) FILTER (WHERE idx IS NOT NULL), [200000]) AS s "
    "FROM lines LEFT JOIN vocab USING (label) GROUP BY id) "
    f"SELECT id, CAST(200001 AS BIGINT) AS width, {d_ints('s')} AS slots, CAST(len(s) AS BIGINT) AS n_set FROM found")

sql("sparse_label_pairs",
    f"WITH vocab AS ({VOCAB_LIST.format(src='fx_bags')}), hot AS (SELECT id, {HOT} AS h FROM fx_bags, vocab), "
    "pairs AS (SELECT id, unnest(range(len(h))) AS slot, unnest(h) AS v FROM hot) "
    "SELECT id, slot, CAST(v AS BIGINT) AS value FROM pairs WHERE v = 1")

sql("colocated_join", _SQL["frame_video_join"])

sql("record_scan_chosen",
    f"SELECT id, {d_ints('labels')} AS labels, 'part' || CAST(CAST(id AS BIGINT) % 8 AS VARCHAR) AS shard, "
    "CAST(CAST(id AS BIGINT) % 8 = 3 AS INTEGER) AS named FROM fx_video")
