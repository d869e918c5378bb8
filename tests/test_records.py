import os
import struct

import pytest

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.session import local_path, scratch_path
from mediafeat.sources import records as RC
from mediafeat.sources.crc32c import crc32c_many, crc32c_py, mask


def test_crc_known_and_random():
    assert crc32c_py(b"123456789") == 0xE3069283
    rng = np.random.default_rng(1)
    msgs = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 3, 4, 31, 32, 33, 999, 65537)]
    assert list(map(int, crc32c_many(msgs))) == [crc32c_py(m) for m in msgs]


def test_frame_unframe_and_corruption():
    payloads = [b"a" * 10, b"", b"xyz" * 100]
    buf = RC.frame(payloads)
    got, errors = RC.unframe(buf)
    assert got == payloads and errors == []
    bad = bytearray(buf)
    bad[12] ^= 1
    got, errors = RC.unframe(bytes(bad))
    assert got == payloads[1:] and errors == [(0, "payload checksum mismatch")]
    got, errors = RC.unframe(buf[:-3])
    assert len(got) == 2 and errors == [(len(RC.frame(payloads[:2])), "truncated record")]
    got, errors = RC.unframe(struct.pack("<Q", 5) + b"\0\0\0\0" + b"hello" + b"\0\0\0\0")
    assert errors[0][1] == "length checksum mismatch"


TYPED = T.StructType([
    T.StructField("key", T.IntegerType()), T.StructField("views", T.LongType()),
    T.StructField("tag", T.StringType()), T.StructField("gain", T.FloatType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("length", T.DoubleType())])


def test_typed_example_roundtrip(spark):
    rows = [(-3, 1 << 40, "clip", 0.5, [0.25, -8.0, 3.5], 1024.0), (0, 0, "", -0.125, [], 7.75)]
    df = spark.createDataFrame(rows, TYPED)
    path = scratch_path(spark, "t_typed")
    RC.write_records(df, path)
    back = RC.read_records(spark, path, TYPED)
    got = sorted(tuple(r)[:-2] for r in back.collect())
    assert got == rows
    assert os.path.exists(os.path.join(local_path(path), "_SUCCESS"))


def test_sequence_with_bytes_per_step(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("labels", T.ArrayType(T.LongType())),
                           T.StructField("rgb", T.ArrayType(T.BinaryType()))])
    frames = [bytes([i, 255 - i, 7]) for i in range(4)]
    df = spark.createDataFrame([("v1", [3, 5], frames), ("v2", [], frames[:1])], schema)
    path = scratch_path(spark, "t_seq")
    RC.write_records(df, path, "SequenceExample", sequence_cols=["rgb"])
    back = RC.read_good(RC.read_records(spark, path, schema, "SequenceExample", sequence_cols=["rgb"]))
    from mediafeat.functions.vectors import decode_u8
    dec = back.select("id", "labels", F.transform("rgb", lambda b: F.lit(0)).alias("n"),
                      decode_u8(F.element_at("rgb", 1)).alias("first")).orderBy("id").collect()
    assert dec[0]["labels"] == [3, 5] and len(dec[0]["n"]) == 4
    assert list(dec[0]["first"]) == [0.0, 255.0, 7.0]
    assert dec[1]["labels"] == []


def test_truncated_file_keeps_good_records(spark):
    schema = T.StructType([T.StructField("id", T.LongType())])
    df = spark.range(10).coalesce(1)
    path = scratch_path(spark, "t_trunc")
    RC.write_records(df, path)
    f = [p for p in os.listdir(local_path(path)) if p.endswith(".tfrecord")][0]
    full = os.path.join(local_path(path), f)
    with open(full, "r+b") as fh:
        fh.truncate(os.path.getsize(full) - 2)
    back = RC.read_records(spark, path, schema).collect()
    good = [r for r in back if r["_error"] is None]
    bad = [r for r in back if r["_error"] is not None]
    assert sorted(r["id"] for r in good) == list(range(9))
    assert len(bad) == 1 and bad[0]["_error"].startswith("truncated record")


def test_mask_matches_definition():
    c = 0x12345678
    rot = ((c >> 15) | (c << 17)) & 0xFFFFFFFF
    assert int(mask(c)) == (rot + 0xA282EAD8) & 0xFFFFFFFF


def test_partitioned_write_names_shards(spark):
    schema = T.StructType([T.StructField("id", T.LongType())])
    df = spark.range(100).select("id", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("shard"))
    path = scratch_path(spark, "t_part")
    RC.write_records(df, path, shards=4, partition_by="shard")
    back = RC.read_records(spark, path, schema).withColumn("shard", RC.partition_value("_file", "shard"))
    got = {(r["id"], r["shard"]) for r in back.collect()}
    assert got == {(i, f"s{i % 3}") for i in range(100)}
    dirs = sorted(d for d in os.listdir(local_path(path)) if not d.startswith("_"))
    assert dirs == ["shard=s0", "shard=s1", "shard=s2"]


# ---- format compatibility: bytes built from the public wire format by hand
def _varint(n):
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _field(num, wire, payload):
    tag = _varint((num << 3) | wire)
    return tag + (_varint(len(payload)) + payload if wire == 2 else payload)


def _feature(kind, values):
    if kind == "bytes":
        inner = b"".join(_field(1, 2, v) for v in values)
        return _field(1, 2, inner)
    if kind == "float":
        inner = _field(1, 2, struct.pack(f"<{len(values)}f", *values))
        return _field(2, 2, inner)
    inner = _field(1, 2, b"".join(_varint(v) for v in values))
    return _field(3, 2, inner)


def _example(features):
    entries = b"".join(_field(1, 2, _field(1, 2, k.encode()) + _field(2, 2, _feature(kind, vals)))
                       for k, (kind, vals) in features.items())
    return _field(1, 2, entries)


def _masked(c):
    return ((((c >> 15) | (c << 17)) & 0xFFFFFFFF) + 0xA282EAD8) & 0xFFFFFFFF


def test_hand_built_records_decode(spark):
    from mediafeat.sources.crc32c import crc32c_py
    recs = [_example({"id": ("bytes", [b"v1"]), "labels": ("int", [3, 5]), "mean_rgb": ("float", [0.5, 1.5])}),
            _example({"id": ("bytes", [b"v2"]), "labels": ("int", []), "mean_rgb": ("float", [2.0])})]
    framed = b""
    for r in recs:
        ln = struct.pack("<Q", len(r))
        framed += ln + struct.pack("<I", _masked(crc32c_py(ln))) + r + struct.pack("<I", _masked(crc32c_py(r)))
    assert RC.frame(recs) == framed  # the writer's framing is byte-identical
    path = scratch_path(spark, "t_hand")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "hand.tfrecord"), "wb") as fh:
        fh.write(framed)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("labels", T.ArrayType(T.LongType())),
                           T.StructField("mean_rgb", T.ArrayType(T.FloatType()))])
    rows = sorted((r["id"], r["labels"], list(r["mean_rgb"]), r["_error"])
                  for r in RC.read_records(spark, path, schema).collect())
    assert rows == [("v1", [3, 5], [0.5, 1.5], None), ("v2", [], [2.0], None)]


def test_hand_built_sequence_example_decodes(spark):
    ctx = b"".join(_field(1, 2, _field(1, 2, k.encode()) + _field(2, 2, _feature(kind, vals)))
                   for k, (kind, vals) in {"id": ("bytes", [b"vid"]), "labels": ("int", [7])}.items())
    steps = [bytes([1, 2, 3]), bytes([250, 0, 9])]
    flist = b"".join(_field(1, 2, _feature("bytes", [s])) for s in steps)          # FeatureList.feature
    lists = _field(1, 2, _field(1, 2, b"rgb") + _field(2, 2, flist))               # map entry
    rec = _field(1, 2, ctx) + _field(2, 2, lists)
    path = scratch_path(spark, "t_hand_seq")
    os.makedirs(local_path(path))
    with open(os.path.join(local_path(path), "s.tfrecord"), "wb") as fh:
        fh.write(RC.frame([rec]))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("labels", T.ArrayType(T.LongType())),
                           T.StructField("rgb", T.ArrayType(T.BinaryType()))])
    from mediafeat.functions.vectors import decode_u8
    back = RC.read_good(RC.read_records(spark, path, schema, "SequenceExample", sequence_cols=["rgb"]))
    r = back.select("id", "labels", decode_u8(F.element_at("rgb", 2)).alias("second")).first()
    assert (r["id"], r["labels"], list(r["second"])) == ("vid", [7], [250.0, 0.0, 9.0])


def test_decode_u8_steps(spark):
    from mediafeat.functions.vectors import decode_u8_steps
    df = spark.createDataFrame([(1, [bytes([0, 255]), bytes([7, 8])]), (2, [])], "id long, rgb array<binary>")
    got = {r["id"]: [list(v) for v in r["f"]] for r in df.select("id", decode_u8_steps("rgb").alias("f")).collect()}
    assert got == {1: [[0.0, 255.0], [7.0, 8.0]], 2: []}


def test_decode_u8_sql_matches_arrow_kernel(spark):
    from mediafeat.functions.vectors import decode_u8, decode_u8_sql
    df = spark.createDataFrame([(1, bytes(range(256))), (2, b""), (3, None)], "id long, b binary")
    got = {r["id"]: (None if r["a"] is None else list(r["a"]), None if r["s"] is None else list(r["s"]))
           for r in df.select("id", decode_u8("b").alias("a"), decode_u8_sql("b").alias("s")).collect()}
    assert got[1][0] == got[1][1] == [float(i) for i in range(256)]
    assert got[2] == ([], [])
    assert got[3] == (None, None)


def test_split_reader_matches_whole_file_reader(spark):
    import random
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.FloatType())),
                           T.StructField("s", T.StringType())])
    rnd = random.Random(4)
    rows = [(i, [rnd.random() for _ in range(rnd.randint(0, 40))], "x" * rnd.randint(0, 300)) for i in range(3000)]
    df = spark.createDataFrame(rows, schema)
    path = scratch_path(spark, "t_split")
    RC.write_records(df, path, shards=3)
    whole = sorted(tuple(r)[:3] for r in RC.read_good(RC.read_records(spark, path, schema)).collect())
    for split in (997, 4096, 1 << 20):
        back = RC.read_records_split(spark, path, schema, split_bytes=split)
        got = back.collect()
        assert all(r["_error"] is None for r in got)
        assert sorted((r["id"], r["v"], r["s"]) for r in got) == whole
    assert RC.read_records_split(spark, path, schema, split_bytes=997).rdd.getNumPartitions() > 30


def test_split_reader_reports_damage(spark):
    schema = T.StructType([T.StructField("id", T.LongType())])
    path = scratch_path(spark, "t_split_bad")
    RC.write_records(spark.range(200).coalesce(1), path)
    f = [p for p in os.listdir(local_path(path)) if p.endswith(".tfrecord")][0]
    full = os.path.join(local_path(path), f)
    with open(full, "r+b") as fh:
        fh.truncate(os.path.getsize(full) - 3)
    back = RC.read_records_split(spark, path, schema, split_bytes=500).collect()
    good = sorted(r["id"] for r in back if r["_error"] is None)
    bad = [r["_error"] for r in back if r["_error"] is not None]
    assert good == list(range(199)) and len(bad) == 1 and bad[0].startswith("truncated record")


def test_crc_rows_matches_reference():
    import numpy as np

    from mediafeat.sources.crc32c import crc32c_py, crc32c_rows
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 256, (50, 8), dtype=np.uint8)
    assert list(map(int, crc32c_rows(rows))) == [crc32c_py(bytes(r)) for r in rows]


def test_split_reader_records_larger_than_the_scan_window(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.BinaryType())])
    rows = [(i, bytes([i % 251]) * (300_000 + i)) for i in range(12)]  # each record > the 256 KB window
    path = scratch_path(spark, "t_split_big")
    RC.write_records(spark.createDataFrame(rows, schema), path, shards=2)
    back = RC.read_records_split(spark, path, schema, split_bytes=100_000).collect()
    assert all(r["_error"] is None for r in back)
    assert sorted((r["id"], len(r["b"])) for r in back) == [(i, 300_000 + i) for i in range(12)]


def _one_shard(spark, name, n=60):
    path = scratch_path(spark, name)
    RC.write_records(spark.range(n).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("s")).coalesce(1), path)
    f = [p for p in os.listdir(local_path(path)) if p.endswith(".tfrecord")][0]
    return path, os.path.join(local_path(path), f)


def _starts(buf):
    out, pos = [], 0
    while pos < len(buf):
        out.append(pos)
        pos += 16 + struct.unpack_from("<Q", buf, pos)[0]
    return out


@pytest.mark.parametrize("damage", ["length", "huge length", "payload", "payload and next length", "first length", "truncated", "tail"])
def test_rows_do_not_depend_on_how_a_damaged_shard_is_cut(spark, damage):
    path, full = _one_shard(spark, "t_cut")
    with open(full, "rb") as f:
        buf = bytearray(f.read())
    at = _starts(buf)
    if damage == "length":
        buf[at[20] + 1] ^= 0x01
    elif damage == "huge length":
        buf[at[20] + 6] ^= 0x7F
    elif damage == "payload":
        buf[at[20] + 13] ^= 0xFF
    elif damage == "payload and next length":
        buf[at[20] + 13] ^= 0xFF
        buf[at[21]] ^= 0xFF
    elif damage == "first length":
        buf[0] ^= 0xFF
    elif damage == "truncated":
        del buf[-3:]
    else:
        buf += b"\0" * 5
    with open(full, "wb") as f:
        f.write(buf)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
    # cuts everywhere, on and next to record starts
    seen = [sorted(((r["id"], r["s"], r["_error"]) for r in RC.read_records(spark, path, schema, split_bytes=n).collect()), key=str)
            for n in (1 << 20, at[20], at[20] + 1, at[21], 97)]
    assert all(x == seen[0] for x in seen)
    lost = {"length": {20}, "huge length": {20}, "payload": {20}, "payload and next length": {20, 21}, "first length": {0},
            "truncated": {59}, "tail": set()}[damage]
    assert {i for i, _, e in seen[0] if e is None} == set(range(60)) - lost
    assert len([e for *_, e in seen[0] if e]) == 1


def test_append_keeps_what_was_there(spark):
    path = scratch_path(spark, "t_append")
    schema = T.StructType([T.StructField("id", T.LongType())])
    RC.write_records(spark.range(10).coalesce(1), path)
    RC.write_records(spark.range(10, 20).coalesce(1), path, mode="append")
    assert sorted(r["id"] for r in RC.read_records(spark, path, schema).collect()) == list(range(20))
    RC.write_records(spark.range(3), path)
    assert sorted(r["id"] for r in RC.read_records(spark, path, schema).collect()) == [0, 1, 2]


def test_failed_overwrite_keeps_the_old_rows(spark):
    path = scratch_path(spark, "t_failed")
    schema = T.StructType([T.StructField("id", T.LongType())])
    RC.write_records(spark.range(10).coalesce(1), path)
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        RC.write_records(bad, path)
    assert sorted(r["id"] for r in RC.read_records(spark, path, schema).collect()) == list(range(10))


def test_partition_values_of_any_text(spark):
    values = ["a/b", "x=y", "50%", "a b+c", None, "é"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, shard string")
    path = scratch_path(spark, "t_names")
    RC.write_records(df, path, partition_by="shard")
    back = RC.read_records(spark, path, "id long").withColumn("shard", RC.partition_value("_file", "shard"))
    assert sorted((r["id"], r["shard"]) for r in back.collect()) == list(enumerate(values))


def test_files_are_cut_by_size(spark):
    path = scratch_path(spark, "t_sized")
    RC.write_records(spark.range(5000).coalesce(1), path, max_file_bytes=20_000)
    files = [p for p in os.listdir(local_path(path)) if p.endswith(".tfrecord")]
    assert len(files) > 3
    assert RC.read_records(spark, f"{path}/part-*", "id long").count() == 5000
    assert RC.read_records(spark, [f"{path}/{files[0]}", f"{path}/{files[1]}"], "id long").count() < 5000


def test_a_hot_partition_value_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "t_hot_value")
    df = spark.range(2000).select("id", F.when(F.col("id") < 1900, "hot").otherwise("cold").alias("shard"))
    RC.write_records(df, path, shards=4, partition_by="shard")
    assert len(os.listdir(local_path(f"{path}/shard=hot"))) > 1


def test_few_shards_are_encoded_by_the_tasks_of_the_input(spark, tmp_path):
    """The writers of few shards get framed records, in order, of any types and nulls."""
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", [float(i), 0.5] if i % 5 else None, bytearray(b"x" * (i % 4))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, shard string, v array<double>, raw binary").repartition(6)
    seen = []
    real = RC._encoded
    RC._encoded = lambda d, *a: seen.append(d.rdd.getNumPartitions()) or real(d, *a)
    try:
        RC.write_records(df, str(tmp_path / "r"), shards=2, partition_by="shard", sort_by=["id"], tasks_per_value=1)
        RC.write_records(df.drop("shard"), str(tmp_path / "flat"), shards=1)
    finally:
        RC._encoded = real
    assert seen == [6, 6]
    back = RC.read_good(RC.read_records(spark, str(tmp_path / "r"), "id long, v array<double>, raw binary"))
    got = sorted((r.id, r.s, r.v, r.raw) for r in back.select("id", RC.partition_value("_file", "shard").alias("s"), "v", "raw").collect())
    assert got == sorted(rows)
    files = {}
    for r in back.collect():
        files.setdefault(r["_file"], []).append(r.id)
    assert len(files) == 4 and all(v == sorted(v) for v in files.values())
    flat = RC.read_good(RC.read_records(spark, str(tmp_path / "flat"), "id long, raw binary"))
    assert sorted((r.id, r.raw) for r in flat.collect()) == sorted((i, b) for i, _, _, b in rows)


def test_decode_u8_works_on_slices_of_a_batch(spark, monkeypatch):
    """A worker holds the floats of some values of a batch at a time, or of one large value."""
    import pyarrow as pa

    from mediafeat.functions import vectors as V
    values = [b"\x00\xff", None, b"", b"a" * 50, b"b" * 5, b"c" * 4, None]
    monkeypatch.setattr(V, "SLICE", 10)
    got = list(V.decode_u8.func(iter([pa.array([b"?"] + values)[1:]])))
    assert [len(x) for x in got] == [3, 1, 3]
    assert [x for g in got for x in g.to_pylist()] == [None if v is None else [float(c) for c in v] for v in values]
    steps = [[b"ab", None, b""], None, [], [b"z" * 20], [None], [b"q"]]
    got = list(V.decode_u8_steps.func(iter([pa.array([[b"?"]] + steps, pa.list_(pa.binary()))[1:]])))
    assert len(got) == 3
    assert [x for g in got for x in g.to_pylist()] == [None if s is None else [None if v is None else [float(c) for c in v] for v in s] for s in steps]
