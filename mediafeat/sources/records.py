"""Record files of ``Example`` / ``SequenceExample`` messages.

Reading: Spark lists the shards (folders, globs, lists of them) and a
``mapInPandas`` kernel reads them in byte ranges, checks both framing checksums and
decodes the wanted fields only.  A broken record, a damaged length or a truncated
tail becomes one row with ``_error`` set, so bad input is quarantined, not
silently skipped (Q11), and all verified records of the shard are kept; the rows do
not depend on how the shards are cut.

Writing: a Python data source (``format('mediafeat_records')``).  Each task
encodes its partition and writes part files of at most ``maxFileBytes`` under their
final names, ``part-<partition>-<n>-<attempt>-w<write id>d<depth>.tfrecord``.  The
commit publishes one manifest, ``_manifest/<number>-<write id>.json``, that names the
files of the successful attempts (and, in overwrite mode, ends all that was there
before).  Readers take such files only if a manifest in force names them, so a write or
an overwrite is one atomic switch: whatever fails before it changes nothing, whatever
fails after it leaves files that no reader sees and :func:`vacuum` deletes.  Files
that other programs wrote need no manifest.  Files go through ``pyarrow.fs`` (local,
HDFS, S3 URIs).

Column mapping (explicit schema, by name):
  context / Example features:
    int, bigint -> int64_list[0];  float, double -> float_list[0]
    string -> bytes_list[0] (UTF-8);  binary -> bytes_list[0]
    array<int|bigint> -> int64_list;  array<float|double> -> float_list
    array<string|binary> -> bytes_list
  SequenceExample feature lists:
    array<array<float|double|int|bigint|string|binary>> -> one feature per step
    array<binary> listed in ``sequence_cols`` -> one bytes value per step
"""

from __future__ import annotations

import json
import re
import struct
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediafeat.sources.crc32c import crc32c_many, crc32c_rows, mask

FORMAT = "mediafeat_records"

# ---------------------------------------------------------------- message classes
_CLASSES = None


def message_classes():
    """Example / SequenceExample classes built from a runtime descriptor
    (the public feature/example message layout; no generated code needed)."""
    global _CLASSES
    if _CLASSES is not None:
        return _CLASSES
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    fdp = descriptor_pb2.FileDescriptorProto(name="mediafeat_example.proto", package="mediafeat.rec",
                                             syntax="proto3")
    L = descriptor_pb2.FieldDescriptorProto

    def msg(name, fields, nested=()):
        m = fdp.message_type.add(name=name)
        for nm in nested:
            m.nested_type.add().CopyFrom(nm)
        for fname, num, ftype, label, tname, oneof in fields:
            f = m.field.add(name=fname, number=num, type=ftype, label=label)
            if tname:
                f.type_name = tname
            if oneof is not None:
                f.oneof_index = oneof
        return m

    R, O = L.LABEL_REPEATED, L.LABEL_OPTIONAL
    msg("BytesList", [("value", 1, L.TYPE_BYTES, R, None, None)])
    msg("FloatList", [("value", 1, L.TYPE_FLOAT, R, None, None)])
    msg("Int64List", [("value", 1, L.TYPE_INT64, R, None, None)])
    feat = msg("Feature", [("bytes_list", 1, L.TYPE_MESSAGE, O, ".mediafeat.rec.BytesList", 0),
                           ("float_list", 2, L.TYPE_MESSAGE, O, ".mediafeat.rec.FloatList", 0),
                           ("int64_list", 3, L.TYPE_MESSAGE, O, ".mediafeat.rec.Int64List", 0)])
    feat.oneof_decl.add(name="kind")

    def map_entry(name, value_type):
        e = descriptor_pb2.DescriptorProto(name=name)
        e.options.map_entry = True
        e.field.add(name="key", number=1, type=L.TYPE_STRING, label=O)
        e.field.add(name="value", number=2, type=L.TYPE_MESSAGE, label=O, type_name=value_type)
        return e

    msg("Features", [("feature", 1, L.TYPE_MESSAGE, R, ".mediafeat.rec.Features.FeatureEntry", None)],
        [map_entry("FeatureEntry", ".mediafeat.rec.Feature")])
    msg("FeatureList", [("feature", 1, L.TYPE_MESSAGE, R, ".mediafeat.rec.Feature", None)])
    msg("FeatureLists", [("feature_list", 1, L.TYPE_MESSAGE, R,
                          ".mediafeat.rec.FeatureLists.FeatureListEntry", None)],
        [map_entry("FeatureListEntry", ".mediafeat.rec.FeatureList")])
    msg("Example", [("features", 1, L.TYPE_MESSAGE, O, ".mediafeat.rec.Features", None)])
    msg("SequenceExample", [("context", 1, L.TYPE_MESSAGE, O, ".mediafeat.rec.Features", None),
                            ("feature_lists", 2, L.TYPE_MESSAGE, O, ".mediafeat.rec.FeatureLists", None)])
    pool = descriptor_pool.DescriptorPool()
    pool.Add(fdp)
    get = message_factory.GetMessageClass
    _CLASSES = (get(pool.FindMessageTypeByName("mediafeat.rec.Example")),
                get(pool.FindMessageTypeByName("mediafeat.rec.SequenceExample")))
    return _CLASSES


# ---------------------------------------------------------------- framing
def frame(payloads: list[bytes]) -> bytes:
    """length | masked crc(length) | payload | masked crc(payload), per record."""
    return b"".join(framed(payloads))


def framed(payloads: list[bytes]) -> list[bytes]:
    """The records of :func:`frame`, each by itself."""
    if not payloads:
        return []
    head = np.zeros((len(payloads), 12), np.uint8)
    head[:, :8] = np.array([len(p) for p in payloads], "<u8")[:, None].view(np.uint8)
    head[:, 8:] = mask(crc32c_rows(head[:, :8])).astype("<u4")[:, None].view(np.uint8)
    heads, tails = head.tobytes(), mask(crc32c_many(payloads)).astype("<u4").tobytes()
    return [heads[12 * i:12 * i + 12] + p + tails[4 * i:4 * i + 4] for i, p in enumerate(payloads)]


def unframe(buf: bytes, verify_payload: bool = True):
    """Split a shard into payloads; returns (payloads, errors) where errors are
    (offset, reason): one per damaged payload and one per gap (see :func:`iter_split`)."""
    payloads, errors = [], []
    for off, payload, why in iter_split(_Bytes(buf), len(buf), 0, len(buf), verify_payload=verify_payload):
        if why is None:
            payloads.append(payload)
        else:
            errors.append((off, why))
    return payloads, errors


class _Bytes:
    """A byte string with the two calls of an open file that the scanner uses."""

    def __init__(self, buf: bytes):
        self.buf, self.pos = memoryview(buf), 0

    def seek(self, pos: int) -> None:
        self.pos = pos

    def read(self, n: int) -> bytes:
        out = bytes(self.buf[self.pos:self.pos + n])
        self.pos += len(out)
        return out


# ---------------------------------------------------------------- value mapping
def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
        return "int64_list"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "float_list"
    return "bytes_list"


def _from_feature(f, dt: T.DataType):
    is_arr = isinstance(dt, T.ArrayType)
    et = dt.elementType if is_arr else dt
    kind = _kind(et)
    if f.WhichOneof("kind") != kind:
        return None if not is_arr else ([] if f.WhichOneof("kind") is None else None)
    vals = getattr(f, kind).value
    if isinstance(et, T.StringType):
        vals = [v.decode("utf-8") for v in vals]
    elif isinstance(et, T.BinaryType):
        vals = [bytes(v) for v in vals]
    elif isinstance(et, (T.FloatType, T.DoubleType)):
        vals = np.asarray(vals, dtype=np.float32).astype(np.float64 if isinstance(et, T.DoubleType) else np.float32)
    else:
        vals = list(vals)
    if is_arr:
        return vals
    return vals[0] if len(vals) else None


def _to_feature(f, value, dt: T.DataType):
    if value is None:
        return False
    is_arr = isinstance(dt, T.ArrayType)
    et = dt.elementType if is_arr else dt
    if is_arr:
        vals = value.tolist() if hasattr(value, "tolist") else list(value)  # numpy -> Python floats in C
    else:
        vals = [value]
    kind = _kind(et)
    if isinstance(et, T.StringType):
        vals = [v.encode("utf-8") for v in vals]
    elif isinstance(et, T.BinaryType):
        vals = [bytes(v) for v in vals]
    elif isinstance(et, T.BooleanType):
        vals = [int(v) for v in vals]
    getattr(f, kind).value.extend(vals)
    return True


def _is_sequence(field: T.StructField, sequence_cols: set[str]) -> bool:
    dt = field.dataType
    return (isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.ArrayType)) or field.name in sequence_cols


def encode(rows, schema: T.StructType, record_type: str, sequence_cols: set[str]) -> list[bytes]:
    """Serialise rows (a pandas frame or an iterable of tuples in schema order)."""
    Example, SequenceExample = message_classes()
    out = []
    fields = list(schema.fields)
    if isinstance(rows, pd.DataFrame):
        rows = rows.itertuples(index=False, name=None)
    for rec in rows:
        if record_type == "Example":
            m = Example()
            for fld, v in zip(fields, rec):
                f = m.features.feature[fld.name]
                if not _to_feature(f, v, fld.dataType):
                    del m.features.feature[fld.name]
        else:
            m = SequenceExample()
            for fld, v in zip(fields, rec):
                if _is_sequence(fld, sequence_cols):
                    if v is None:
                        continue
                    fl = m.feature_lists.feature_list[fld.name]
                    et = fld.dataType.elementType
                    step_t = et if isinstance(et, T.ArrayType) else T.ArrayType(et)
                    for step in v:
                        _to_feature(fl.feature.add(), step if isinstance(et, T.ArrayType) else [step], step_t)
                else:
                    f = m.context.feature[fld.name]
                    if not _to_feature(f, v, fld.dataType):
                        del m.context.feature[fld.name]
        out.append(m.SerializeToString())
    return out


def decode(payload: bytes, schema: T.StructType, record_type: str, sequence_cols: set[str]) -> list:
    Example, SequenceExample = message_classes()
    if record_type == "Example":
        m = Example.FromString(payload)
        feats = m.features.feature
        return [(_from_feature(feats[f.name], f.dataType) if f.name in feats else None) for f in schema.fields]
    m = SequenceExample.FromString(payload)
    ctx, lists = m.context.feature, m.feature_lists.feature_list
    row = []
    for f in schema.fields:
        if _is_sequence(f, sequence_cols):
            if f.name not in lists:
                row.append(None)
                continue
            et = f.dataType.elementType
            if isinstance(et, T.ArrayType):
                row.append([_from_feature(s, et) for s in lists[f.name].feature])
            else:
                row.append([_from_feature(s, et) for s in lists[f.name].feature])
        else:
            row.append(_from_feature(ctx[f.name], f.dataType) if f.name in ctx else None)
    return row


def as_schema(schema) -> T.StructType:
    """A StructType, or a DDL string such as ``"id string, labels array<bigint>"``, with
    every field and element nullable: a bad record has none, and any can be missing."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in schema.fields])


def _nullable(dt: T.DataType) -> T.DataType:
    return T.ArrayType(_nullable(dt.elementType), True) if isinstance(dt, T.ArrayType) else dt


# ---------------------------------------------------------------- reading
def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType, record_type: str = "Example",
                 sequence_cols: list[str] | None = None, verify_payload: bool = True,
                 glob: str | None = "*.tfrecord", batch_rows: int = 1024, split_bytes: int = 128 << 20) -> DataFrame:
    """Decode record shards into ``schema`` + ``_file`` + ``_error``.

    ``path``: a file, folder or glob, or a list of them, listed by Spark.  Shards
    are read in byte ranges of ``split_bytes`` (see :func:`iter_split`): a large
    shard is many tasks, small ones share a task."""
    from mediafeat.session import ship_package
    ship_package(spark)
    schema = as_schema(schema)
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = _visible(r.load(path if isinstance(path, list) else [path]).select("path", "length"))      # names only: no content is read
    ranges = _ranges(files, split_bytes)
    total = files.agg(F.coalesce(F.sum(F.ceil(F.col("length") / split_bytes)), F.lit(1)).alias("n"),
                      F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    # as many tasks as ranges, but no more than the cores for little data
    tasks = max(1, min(int(total.n), max(spark.sparkContext.defaultParallelism, int(total.b) // split_bytes + 1)))
    return _decode_ranges(ranges.repartition(tasks), schema, record_type, sequence_cols, verify_payload, batch_rows, split_bytes)


def _decode_ranges(ranges: DataFrame, schema: T.StructType, record_type: str, sequence_cols: list[str] | None,
                   verify_payload: bool, batch_rows: int, split_bytes: int) -> DataFrame:
    seq = set(sequence_cols or [])
    names = [f.name for f in schema.fields] + ["_file", "_error"]
    out_schema = T.StructType(list(schema.fields) + [T.StructField("_file", T.StringType()), T.StructField("_error", T.StringType())])
    blank = [None] * len(schema.fields)

    def kernel(it):
        rows = []
        for pdf in it:
            for p, length, start in zip(pdf["path"], pdf["length"], pdf["start"]):
                fs, name = _fs(p)
                with fs.open_input_file(name) as f:
                    for off, payload, why in iter_split(f, int(length), int(start), min(int(start) + split_bytes, int(length)), verify_payload):
                        if why is None:
                            try:
                                rows.append(decode(payload, schema, record_type, seq) + [p, None])
                            except Exception as e:  # undecodable payload -> quarantine row
                                rows.append(blank + [p, f"decode error: {type(e).__name__}"])
                        else:
                            rows.append(blank + [p, f"{why} at byte {off}"])
                        if len(rows) >= batch_rows:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)
    return ranges.select("path", "length", "start").mapInPandas(kernel, out_schema)


def _ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    at = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    return files.where("length > 0").select("path", "length", F.explode(at).alias("start"))


def read_records_stream(spark: SparkSession, path: str, schema: T.StructType, record_type: str = "Example",
                        sequence_cols: list[str] | None = None, verify_payload: bool = True,
                        glob: str | None = "*.tfrecord", max_files_per_trigger: int | None = None,
                        split_bytes: int = 128 << 20, batch_rows: int = 1024) -> DataFrame:
    """Streaming form of :func:`read_records`: each new shard in ``path`` (a folder, or a
    glob of folders) is decoded once.

    Spark's file source lists names and remembers what it has committed in the
    checkpoint; no content passes through it.  Shards are read in byte ranges, each its
    own row of work, so a large one is many tasks and has no size limit.  Shards of
    this library arrive by the manifests that name them: a write all at once, after its
    commit; those of other programs when they are listed."""
    from mediafeat.session import ship_package
    ship_package(spark)
    schema = as_schema(schema)

    def listed(where: str, pattern: str | None) -> DataFrame:
        r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        if pattern:
            r = r.option("pathGlobFilter", pattern)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(where)
    foreign = listed(path, glob).select("path", "length").where(~F.col("path").rlike(OWN))
    # a glob, as the folder may not be there
    named = _manifests(listed(f"{path.rstrip('/')}/{MANIFEST[:-1]}[{MANIFEST[-1]}]", "*.json"))
    named = named.select("root", F.explode("m.files").alias("f")).select(
        F.concat("root", F.lit("/"), "f.path").alias("path"), F.col("f.bytes").alias("length"))
    # a given number: by the size of their rows, ranges would be gathered in one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = _ranges(foreign.union(named), split_bytes).repartition(tasks, "path", "start")
    return _decode_ranges(ranges, schema, record_type, sequence_cols, verify_payload, batch_rows, split_bytes)


MANIFEST = "_manifest"
OWN = r"-w[0-9a-f]{12}d[01]\.tfrecord$"       # files that count only if a manifest names them
MANIFEST_SCHEMA = "number long, replace boolean, files array<struct<path string, bytes long>>, foreign array<string>"


def _manifests(files: DataFrame) -> DataFrame:
    """root, m: the manifests among binary files, by the folder that they speak of.  One
    that cannot be read does not count."""
    root = F.regexp_replace("path", f"/{MANIFEST}/[^/]+$", "")
    return (files.select(root.alias("root"), F.from_json(F.col("content").cast("string"), MANIFEST_SCHEMA).alias("m"))
            .where("m.number is not null and m.files is not null"))


def _visible(files: DataFrame) -> DataFrame:
    """Of listed files (path, length) those that are in force: named by a manifest that
    no later overwrite ended, or written by another program and not overwritten."""
    spark = files.sparkSession
    own = F.col("path").rlike(OWN)
    parent = F.regexp_replace("path", "/[^/]+$", "")
    root = F.when(F.col("path").rlike(r"d1\.tfrecord$"), F.regexp_replace(parent, "/[^/]+$", "")).otherwise(parent)
    roots = [r.root for r in files.where(own).select(root.alias("root")).distinct().collect()]       # one for each written folder
    if not roots:
        return files
    found = _manifests(spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load([f"{r}/{MANIFEST}" for r in roots]))
    last = found.groupBy("root").agg(F.max(F.when(F.col("m.replace"), F.col("m.number"))).alias("last"))
    valid = found.join(last, "root").where("last is null or m.number >= last")
    named = valid.select("root", F.explode("m.files").alias("f")).select(F.concat("root", F.lit("/"), "f.path").alias("path"))
    gone = valid.select("root", F.explode("m.foreign").alias("f")).select(F.concat("root", F.lit("/"), "f").alias("path"))
    return files.where(own).join(named, "path", "left_semi").union(files.where(~own).join(gone, "path", "left_anti"))


def decode_files(files: DataFrame, schema: T.StructType, record_type: str = "Example",
                 sequence_cols: list[str] | None = None, verify_payload: bool = True,
                 batch_rows: int = 1024) -> DataFrame:
    """(path, content) rows -> decoded records + ``_file`` + ``_error``."""
    seq = set(sequence_cols or [])
    out_schema = T.StructType(list(schema.fields) + [T.StructField("_file", T.StringType()),
                                                     T.StructField("_error", T.StringType())])
    names = [f.name for f in schema.fields]

    def kernel(it):
        for pdf in it:
            for p, content in zip(pdf["path"], pdf["content"]):
                payloads, errors = unframe(bytes(content), verify_payload)
                rows = []
                for pl in payloads:
                    try:
                        rows.append(decode(pl, schema, record_type, seq) + [p, None])
                    except Exception as e:  # undecodable payload -> quarantine row
                        rows.append([None] * len(names) + [p, f"decode error: {type(e).__name__}"])
                    if len(rows) >= batch_rows:
                        yield pd.DataFrame(rows, columns=names + ["_file", "_error"])
                        rows = []
                for off, why in errors:
                    rows.append([None] * len(names) + [p, f"{why} at byte {off}"])
                if rows:
                    yield pd.DataFrame(rows, columns=names + ["_file", "_error"])

    return files.mapInPandas(kernel, out_schema)


def read_good(df: DataFrame) -> DataFrame:
    return df.where(F.col("_error").isNull()).drop("_error")


# ---------------------------------------------------------------- writing (Python data source)
def _register(spark: SparkSession) -> None:
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    class Commit(WriterCommitMessage):
        def __init__(self, path: str, n: int):
            self.path, self.n = path, n

    class RecordWriter(DataSourceArrowWriter):
        def __init__(self, options, schema, overwrite):
            self.path = options["path"].rstrip("/")
            self.record_type = options.get("recordType", "Example")
            self.seq = set(filter(None, options.get("sequenceCols", "").split(",")))
            self.part_col = options.get("partitionCol") or None
            self.plain = options.get("plainNames") == "true"
            self.encoded = options.get("encoded") == "true"      # the last column holds framed records
            self.schema = schema
            # the partition column names a directory and is not stored in the records
            self.rec_schema = T.StructType([f for f in schema.fields if f.name != self.part_col])
            self.overwrite = overwrite
            self.max_bytes = int(options.get("maxFileBytes", str(512 << 20)))
            self.write_id = uuid.uuid4().hex[:12]    # in every file name: appends never meet, commits know their files

        def write(self, iterator):
            import pyarrow as pa
            from pyspark import TaskContext
            ctx = TaskContext.get()
            part = ctx.partitionId() if ctx else uuid.uuid4().int % 100000
            attempt = ctx.attemptNumber() if ctx else 0
            fs, root = _fs(self.path)
            fs.create_dir(f"{root}/{MANIFEST}", recursive=True)
            names = [f.name for f in self.rec_schema.fields]
            depth = 0 if self.part_col is None else 1
            written, n = [], 0
            cur_key, out, rel, size = object(), None, None, 0

            def close():
                if out is not None:
                    out.close()
                    written.append((rel, size))

            for batch in iterator:  # Arrow record batches, sorted by the partition column
                if batch.num_rows == 0:
                    continue
                cols = {} if self.encoded else batch.to_pydict()  # Python objects, None for nulls
                if self.encoded:
                    records = batch.column(batch.num_columns - 1).cast(pa.binary())
                    at = np.frombuffer(records.buffers()[1], np.int32)[records.offset:]
                    raw = memoryview(records.buffers()[2] or b"")
                keys = batch.column(self.part_col).to_pylist() if self.part_col else [None] * batch.num_rows
                start = 0
                while start < batch.num_rows:
                    key = keys[start]
                    end = start
                    while end < batch.num_rows and keys[end] == key and end - start < 512:
                        end += 1
                    if key != cur_key or size >= self.max_bytes:
                        close()
                        d = "" if not depth else f"{'' if self.plain else self.part_col + '='}{partition_name(key)}/"
                        fs.create_dir(f"{root}/{d}", recursive=True)
                        rel = f"{d}part-{part:05d}-{len(written):03d}-{attempt}{uuid.uuid4().hex[:8]}-w{self.write_id}d{depth}.tfrecord"
                        out, cur_key, size = fs.open_output_stream(f"{root}/{rel}"), key, 0
                    if self.encoded:
                        data = raw[at[start]:at[end]]
                    else:
                        rows = zip(*[cols[c][start:end] for c in names])
                        data = frame(encode(rows, self.rec_schema, self.record_type, self.seq))
                    out.write(data)
                    size += len(data)
                    n += end - start
                    start = end
            close()
            return Commit(written, n)

        def commit(self, messages):
            fs, root = _fs(self.path)
            publish(fs, root, self.write_id, [f for m in messages if m is not None for f in m.path], self.overwrite)
            if self.overwrite:
                _vacuum(fs, root)
            with fs.open_output_stream(f"{root}/_SUCCESS"):
                pass

        def abort(self, messages):
            from pyarrow import fs as pafs
            fs, root = _fs(self.path)
            if fs.get_file_info(root).type == pafs.FileType.Directory:
                for info in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
                    if f"-w{self.write_id}d" in info.base_name:
                        fs.delete_file(info.path)

    class RecordSource(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def writer(self, schema, overwrite):
            return RecordWriter(self.options, schema, overwrite)

    spark.dataSource.register(RecordSource)


def _in_force(fs, root: str) -> list[dict]:
    """The readable manifests of a folder, by number, with their own names."""
    from pyarrow import fs as pafs
    out = []
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/{MANIFEST}", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                try:
                    out.append(json.loads(f.read()) | {"at": info.path})
                except ValueError:      # cut short
                    continue
    return sorted(out, key=lambda m: (m["number"], m["at"]))


def publish(fs, root: str, write_id: str, files: list[tuple[str, int]], replace: bool) -> None:
    """The switch: one manifest appears under its name, whole."""
    from pyarrow import fs as pafs
    fs.create_dir(f"{root}/{MANIFEST}", recursive=True)
    number = max([m["number"] for m in _in_force(fs, root)], default=0) + 1
    foreign = []
    if replace:
        foreign = [i.path[len(root) + 1:] for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                   if i.type == pafs.FileType.File and not re.search(OWN, i.base_name) and not i.base_name.startswith("_")
                   and f"/{MANIFEST}/" not in i.path]
    body = {"number": number, "replace": replace, "files": [{"path": p, "bytes": n} for p, n in files], "foreign": foreign}
    tmp = f"{root}/{MANIFEST}/.{write_id}"
    with fs.open_output_stream(tmp) as f:
        f.write(json.dumps(body).encode())
    fs.move(tmp, f"{root}/{MANIFEST}/{number:08d}-{write_id}.json")


def _vacuum(fs, root: str) -> int:
    """Delete what no manifest in force names: files of failed attempts and writes, what an
    overwrite replaced, and manifests that it ended."""
    from pyarrow import fs as pafs
    found = _in_force(fs, root)
    last = max([m["number"] for m in found if m["replace"]], default=0)
    named = {f["path"] for m in found if m["number"] >= last for f in m["files"]}
    gone = {p for m in found if m["number"] >= last for p in m["foreign"]}
    n = 0
    for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        rel = i.path[len(root) + 1:]
        if i.type == pafs.FileType.File and (rel in gone or re.search(OWN, rel) and rel not in named):
            fs.delete_file(i.path)
            n += 1
    for m in found:
        if m["number"] < last:      # after the files that it named
            fs.delete_file(m["at"])
    return n


def vacuum(path: str) -> int:
    """Delete the files under ``path`` that readers don't see; how many.  Not while a write
    to it is under way: its files have no manifest yet."""
    fs, root = _fs(path.rstrip("/"))
    return _vacuum(fs, root)


RECORD, TASK = "_framed_record", "_record_task"      # columns of encoded rows
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_name(value) -> str:
    """A value as a directory name: percent-encoded, null under its usual name."""
    from urllib.parse import quote
    return NULL_PARTITION if value is None else quote(str(value), safe="")


def _fs(path: str):
    """(file system, path in it); ``path`` is taken literally, not percent-decoded."""
    from pyarrow import fs as pafs

    from mediafeat.session import local_path
    plain = local_path(path)
    if plain.startswith("/"):
        return pafs.LocalFileSystem(), plain
    return pafs.FileSystem.from_uri(path.replace("%", "%25"))


def _encoded(df: DataFrame, record_type: str, seq: set[str], partition_by: str | None, keep: list[str],
             dealt: list) -> DataFrame:
    """``keep`` and ``dealt`` columns and the framed record of each row, encoded where the rows lie: few
    large shards then cost their writers no more than copying bytes."""
    fields = T.StructType([f for f in df.schema.fields if f.name != partition_by])
    names, df = [f.name for f in fields], df.select("*", *dealt)
    keep = [*keep, *df.columns[len(df.columns) - len(dealt):]] if dealt else keep
    at = [df.columns.index(c) for c in keep]

    def kernel(batches):
        import pyarrow as pa
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                cols = part.to_pydict()
                rows = zip(*[cols[c] for c in names]) if names else [()] * part.num_rows
                records = pa.array(framed(encode(rows, fields, record_type, seq)), pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in at], records], [*keep, RECORD])
    return df.mapInArrow(kernel, T.StructType([*[df.schema[c] for c in keep], T.StructField(RECORD, T.BinaryType())]))


def write_records(df: DataFrame, path: str, record_type: str = "Example", sequence_cols: list[str] | None = None,
                  mode: str = "overwrite", shards: int | None = None, partition_by: str | None = None,
                  sort_by: list[str] | None = None, max_file_bytes: int = 512 << 20, tasks_per_value: int = 4,
                  plain_names: bool = False) -> None:
    """Encode and write ``df`` as record shards.

    One file per partition; ``shards`` fixes the count with an explicit
    repartition (never coalesced by AQE) of the rows' records, which the input's
    tasks have encoded; otherwise the input partitioning is kept.  ``partition_by`` writes one directory per value of that column
    (``<col>=<value>/part-*.tfrecord``), so a shard named in the data keeps its
    name on disk whatever task writes it; rows are sorted by it inside each
    task so only one file is open at a time; ``sort_by`` fixes the record order
    inside each file.  With both ``shards`` and ``partition_by`` a value's rows go
    to up to ``tasks_per_value`` tasks (a file each), so that one value with a
    large share of the rows is not one task's work; 1 gives one file per value.
    Files are closed at ``max_file_bytes``.  ``plain_names``: a value's folder is
    named by the value alone (output per shard under its own name, S16)."""
    from mediafeat.session import ship_package
    ship_package(df.sparkSession)
    _register(df.sparkSession)
    keys = list(dict.fromkeys([*([partition_by] if partition_by else []), *(sort_by or [])]))
    if shards:
        spread = bool(partition_by) and tasks_per_value > 1
        row = F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]) if spread else None
        dealt = [F.pmod(row, F.lit(tasks_per_value)).alias(TASK)] if spread else []
        df = _encoded(df, record_type, set(sequence_cols or []), partition_by, keys, dealt)
        by = [*([partition_by] if partition_by else []), *([TASK] if spread else [])]
        df = df.repartition(shards, *by).drop(TASK)
    if keys:
        df = df.sortWithinPartitions(*keys)
    (df.write.format(FORMAT).mode(mode).option("recordType", record_type)
       .option("sequenceCols", ",".join(sequence_cols or []))
       .option("partitionCol", partition_by or "").option("maxFileBytes", str(max_file_bytes))
       .option("plainNames", str(plain_names).lower()).option("encoded", str(bool(shards)).lower()).save(path))


def partition_value(path_col: str, name: str):
    """The ``<name>=<value>`` directory value of a record file path (null for the
    null directory)."""
    raw = F.regexp_extract(F.col(path_col), f"/{name}=([^/]+)/", 1)
    return F.when(raw != NULL_PARTITION, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))


def folder_name(path_col: str):
    """The last folder of a record file path, as written with ``plain_names``."""
    return F.url_decode(F.replace(F.regexp_extract(F.col(path_col), "/([^/]+)/[^/]+$", 1), F.lit("+"), F.lit("%2B")))


def damage_shards(path: str) -> list[str]:
    """Test helper: cut the last record of the first shard short and flip a
    payload byte of the first record of the second (through ``pyarrow.fs``,
    so it works on any file system the writer supports)."""
    from pyarrow import fs as pafs
    fs, root = _fs(path.rstrip("/"))
    files = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                   if i.base_name.startswith("part-"))
    if len(files) < 2:
        raise ValueError("need at least two shards")
    with fs.open_input_stream(files[0]) as f:
        a = f.read()
    with fs.open_output_stream(files[0]) as f:
        f.write(a[:-5])
    with fs.open_input_stream(files[1]) as f:
        b = bytearray(f.read())
    b[20] ^= 0xFF
    with fs.open_output_stream(files[1]) as f:
        f.write(bytes(b))
    return files[:2]


def read_examples(spark: SparkSession, path, schema: T.StructType, **kw) -> DataFrame:
    return read_records(spark, path, schema, "Example", **kw)


def read_sequence_examples(spark: SparkSession, path, schema: T.StructType, sequence_cols=None, **kw) -> DataFrame:
    return read_records(spark, path, schema, "SequenceExample", sequence_cols=sequence_cols, **kw)


def write_examples(df: DataFrame, path: str, **kw) -> None:
    write_records(df, path, "Example", **kw)


def write_sequence_examples(df: DataFrame, path: str, sequence_cols=None, **kw) -> None:
    write_records(df, path, "SequenceExample", sequence_cols=sequence_cols, **kw)


# ---------------------------------------------------------------- splittable reading
BUFFER = 4 << 20     # bytes read and checksummed at a time
WINDOW = 1 << 18     # bytes searched at a time when re-synchronising


def _at(f, pos: int, n: int) -> bytes:
    f.seek(pos)
    return f.read(n)


def _head_ok(head: bytes) -> bool:
    return len(head) == 12 and int(mask(crc32c_many([head[:8]]))[0]) == struct.unpack_from("<I", head, 8)[0]


def _verified(f, size: int, pos: int) -> bool:
    """A record starts at ``pos``: its length verifies, it lies inside the file, and
    its payload verifies, or it is followed by a verified length or the end."""
    head = _at(f, pos, 12)
    if not _head_ok(head):
        return False
    ln = struct.unpack_from("<Q", head)[0]
    end = pos + 16 + ln
    if end > size:
        return False
    if end == size or _head_ok(_at(f, end, 12)):
        return True
    body = _at(f, pos + 12, ln + 4)
    return int(mask(crc32c_many([body[:ln]]))[0]) == struct.unpack_from("<I", body, ln)[0]


def _resync(f, size: int, pos: int, limit: int) -> int | None:
    """The first verified record start in [pos, limit).  All offsets of a window
    are tested at once: its 8-byte windows (a zero-copy view) are checksummed in 8
    vectorised steps."""
    from numpy.lib.stride_tricks import sliding_window_view

    from mediafeat.sources.crc32c import crc32c_rows
    while pos < limit and size - pos >= 12:
        buf = _at(f, pos, min(WINDOW, size - pos))
        arr = np.frombuffer(buf, dtype=np.uint8)
        n = len(arr) - 11
        heads = sliding_window_view(arr, 8)[:n]
        tail = sliding_window_view(arr[8:], 4)[:n].astype(np.uint32)
        stored = tail[:, 0] | (tail[:, 1] << 8) | (tail[:, 2] << 16) | (tail[:, 3] << 24)
        for o in np.nonzero(mask(crc32c_rows(heads)) == stored)[0]:
            if pos + int(o) >= limit:
                return None
            if _verified(f, size, pos + int(o)):
                return pos + int(o)
        pos += n
    return None


def _why(f, size: int, pos: int) -> str:
    head = _at(f, pos, 12)
    if len(head) < 12:
        return "truncated header"
    if not _head_ok(head):
        return "length checksum mismatch"
    return "truncated record" if pos + 16 + struct.unpack_from("<Q", head)[0] > size else "payload checksum mismatch"


def iter_split(f, size: int, start: int, end: int, verify_payload: bool = True):
    """Yield (offset, payload | None, error | None) for a byte range of an open
    random-access file of ``size`` bytes; the rows of all ranges of a file are the
    same however it is cut.

    A range owns the verified records that start in it.  Bytes between the end of
    a record and the next verified one are a gap and give one error row, owned by
    the range of the record before it (the first range, where there is none), so
    a range that starts inside a record or a gap skips to the first verified
    record without losing anything.  Records are read in buffers and their
    checksums computed per buffer."""
    pos = start
    if start > 0:
        pos = _resync(f, size, start, end)
        if pos is None:
            return
    while pos < end and pos < size:
        buf = _at(f, pos, min(BUFFER, size - pos))
        heads, spans, p = [], [], 0
        while pos + p < end and p + 12 <= len(buf):
            ln = struct.unpack_from("<Q", buf, p)[0]
            if pos + p + 16 + ln > size:
                break
            if p + 16 + ln > len(buf):
                if not spans and _head_ok(buf[p:p + 12]):       # longer than the buffer
                    buf = _at(f, pos, 16 + ln)
                else:
                    break
            heads.append(buf[p:p + 12])
            spans.append((p + 12, p + 12 + ln))
            p += 16 + ln
        if heads:
            good = mask(crc32c_many([h[:8] for h in heads])) == np.array([struct.unpack_from("<I", h, 8)[0] for h in heads], np.uint32)
            n = len(heads) if good.all() else int(np.argmin(good))
            payloads = [buf[a:b] for a, b in spans[:n]]
            if verify_payload and payloads:
                intact = [int(c) == struct.unpack_from("<I", buf, b)[0] for c, (_, b) in zip(mask(crc32c_many(payloads)), spans[:n])]
            else:
                intact = [True] * n
            if n and not intact[-1] and not _verified(f, size, pos + spans[n - 1][0] - 12):
                n -= 1                                              # part of a gap
            for i in range(n):
                off = pos + spans[i][0] - 12
                yield (off, payloads[i], None) if intact[i] else (off, None, "payload checksum mismatch")
            if n:
                pos += spans[n - 1][1] + 4
                if pos < size and (pos >= end or n < len(heads)) and not _verified(f, size, pos):
                    pass
                elif pos < size and n == len(heads) and pos < end:
                    continue
                else:
                    return
        # no verified record at pos: a gap
        yield pos, None, _why(f, size, pos)
        pos = _resync(f, size, pos + 1, end)
        if pos is None:
            return


def read_records_split(spark: SparkSession, path: str | list[str], schema: T.StructType, record_type: str = "Example",
                       sequence_cols: list[str] | None = None, split_bytes: int = 128 << 20,
                       glob: str = "*.tfrecord") -> DataFrame:
    """:func:`read_records` with the range size first in mind."""
    return read_records(spark, path, schema, record_type, sequence_cols, glob=glob, split_bytes=split_bytes)


def shard_sizes(path: str, glob: str = "*.tfrecord") -> list[int]:
    """Byte sizes of the record shards under ``path`` (file listing only)."""
    import fnmatch

    from pyarrow import fs as pafs
    fs, root = _fs(path.rstrip("/"))
    return [i.size for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
            if i.type == pafs.FileType.File and fnmatch.fnmatch(i.base_name, glob)]
