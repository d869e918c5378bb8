"""Record shards as a Spark data source.

``spark.read.format("mediafeat_record_scan").schema(...).load(path)`` (or :func:`scan`)
reads what ``records.read_records`` reads, in byte ranges, one input partition for about
``splitBytes`` of them.

What a scan leaves out is said when it is made: ``shards`` (patterns on the whole path)
leaves shards out before any is opened, ``records`` takes good or bad records alone, and
the fields decoded are those of the schema, which :func:`narrow` derives from the columns
wanted.  Spark tells Python data sources no columns.  It does push filters, but Spark
4.1 keeps them in one place for all uses of a loaded table: a union of two differently
filtered uses of one scan gave wrong rows, so this source takes none that way and every
``where`` stays with Spark.

A schema without ``_error`` has no place for a bad record: the scan then fails on the
first one, with its file and reason, rather than leave it out.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mediafeat.sources import records as RC

FORMAT = "mediafeat_record_scan"
TAGS = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_error", T.StringType())])
BATCH_ROWS = 1024


class Ranges(InputPartition):
    """(path, length, start) of the byte ranges that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
        super().__init__(ranges)


def _in_force(fs, root: str) -> tuple[set[str], set[str]]:
    """Files that a folder's manifests name since its last overwrite, and files of other
    programs that an overwrite ended."""
    found = RC._in_force(fs, root)
    last = max((m["number"] for m in found if m["replace"]), default=None)
    valid = [m for m in found if last is None or m["number"] >= last]
    return ({f"{root}/{f['path']}" for m in valid for f in m["files"]}, {f"{root}/{f}" for m in valid for f in m.get("foreign") or []})


def list_shards(path: str, glob: str) -> list[tuple[str, int]]:
    """(path, bytes) of the shards in force under a file or folder, by name."""
    from pyarrow import fs as pafs
    fs, inside = RC._fs(path)
    inside = inside.rstrip("/")
    scheme = "file:" if isinstance(fs, pafs.LocalFileSystem) else path.rstrip("/")[:-len(inside)]
    info = fs.get_file_info(inside)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inside, recursive=True))
    files = [f for f in files if f.type == pafs.FileType.File and fnmatch.fnmatch(f.base_name, glob)
             and not any(part[:1] in ("_", ".") and "=" not in part for part in f.path[len(inside):].split("/"))]
    home = {}
    for f in files:
        if re.search(RC.OWN, f.path):
            up = posixpath.dirname(f.path)
            home[f.path] = posixpath.dirname(up) if f.path.endswith("d1.tfrecord") else up
    known = {root: _in_force(fs, root) for root in set(home.values())}
    gone = set().union(*(g for _, g in known.values())) if known else set()
    kept = [f for f in files if (f.path in known[home[f.path]][0] if f.path in home else f.path not in gone)]
    return sorted((scheme + f.path, f.size) for f in kept)


class RecordScanReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType) -> None:
        self.path = options["path"]
        self.glob = options.get("glob", "*.tfrecord")
        self.record_type = options.get("recordType", "Example")
        self.seq = set(filter(None, options.get("sequenceCols", "").split(",")))
        self.verify = options.get("verifyPayload", "true").lower() == "true"
        self.split = int(options.get("splitBytes", str(128 << 20)))
        self.tasks = int(options.get("minTasks", "1"))
        self.out = schema
        self.fields = RC.as_schema(T.StructType([f for f in schema.fields if f.name not in TAGS.fieldNames()]))
        self.shards = options.get("shards", "").splitlines()
        take = options.get("records", "all")
        if take not in ("all", "good", "bad"):
            raise ValueError("records must be 'all', 'good' or 'bad'")
        self.good, self.bad = take != "bad", take != "good"

    def partitions(self) -> list[Ranges]:
        shards = [(p, n) for p, n in list_shards(self.path, self.glob) if not self.shards or any(fnmatch.fnmatchcase(p, g) for g in self.shards)]
        room = min(self.split, max(1, -(-sum(n for _, n in shards) // self.tasks)))
        out, held, size = [], [], 0
        for p, n in shards:
            for start in range(0, n, self.split):
                own = min(self.split, n - start)
                if held and size + own > room:
                    out.append(Ranges(held))
                    held, size = [], 0
                held.append((p, n, start))
                size += own
        return out + [Ranges(held)]      # with no shard one empty partition

    def read(self, partition: Ranges) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in self.out.fields])
        at = {f.name: i for i, f in enumerate(self.fields.fields)} | {"_file": -2, "_error": -1}
        rows: list[list] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[at[f.name]] for r in rows], f.type) for f in kinds], schema=kinds)
        for row in self._rows(partition.value):
            rows.append(row)
            if len(rows) == BATCH_ROWS:
                yield batch()
                rows = []
        if rows:
            yield batch()

    def _rows(self, ranges) -> Iterator[list]:
        blank = [None] * len(self.fields)
        tagged = "_error" in self.out.fieldNames()
        for path, length, start in ranges:
            fs, name = RC._fs(path)
            with fs.open_input_file(name) as f:
                for off, payload, why in RC.iter_split(f, length, start, min(start + self.split, length), self.verify):
                    values = blank
                    if why is None:
                        try:
                            values = RC.decode(payload, self.fields, self.record_type, self.seq)
                        except Exception as e:  # undecodable payload
                            why = f"decode error: {type(e).__name__}"
                    else:
                        why = f"{why} at byte {off}"
                    if why is not None and self.bad and not tagged:
                        raise ValueError(f"{path}: {why} (name _error in the schema to keep such records apart)")
                    if self.good if why is None else self.bad:
                        yield [*values, path, why]


class RecordScan(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> RecordScanReader:
        return RecordScanReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    from mediafeat.session import ship_package
    ship_package(spark)
    spark.dataSource.register(RecordScan)


def narrow(schema: T.StructType | str, *columns: str) -> T.StructType:
    """The schema of ``columns`` alone (with ``_file`` and ``_error``): only they are decoded."""
    schema = RC.as_schema(schema)
    missing = set(columns) - set(schema.fieldNames())
    if missing:
        raise ValueError(f"no such fields: {sorted(missing)}")
    return T.StructType([f for f in schema.fields if not columns or f.name in columns] + TAGS.fields)


def scan(spark: SparkSession, path: str, schema: T.StructType | str, *columns: str, shards: str | list[str] = (),
         records: str = "all", record_type: str = "Example", sequence_cols: list[str] | None = None,
         glob: str = "*.tfrecord", split_bytes: int = 128 << 20) -> DataFrame:
    """``columns`` (default: all of ``schema``), ``_file`` and ``_error`` of the records.

    ``shards``: patterns (``*``, ``?``, ``[...]``) on whole paths, of which one must match;
    ``records``: 'all', 'good' (decoded) or 'bad'."""
    register(spark)
    patterns = [shards] if isinstance(shards, str) else list(shards)
    return (spark.read.format(FORMAT).schema(narrow(schema, *columns)).option("recordType", record_type)
            .option("shards", "\n".join(patterns)).option("records", records)
            .option("sequenceCols", ",".join(sequence_cols or [])).option("glob", glob).option("splitBytes", str(split_bytes))
            .option("minTasks", str(spark.sparkContext.defaultParallelism)).load(path))
