"""Dense network with sigmoid outputs on multi-hot targets, its parameters held as a
table of chunk rows (M1, M2, A10).

Parameters are one flat vector: per layer the matrix (outputs x inputs) with the bias as
last column, row by row.  A table (chunk, v) holds it in pieces of ``CHUNK`` values under
the session's checkpoint folder.  In every epoch

* each partition of training rows meets a copy of the chunk rows (a cogroup on the
  partition number), runs mini-batch gradient descent from them and emits its
  ``n``-weighted change, chunk by chunk, with one row of metrics;
* the changes are summed per chunk in two levels, joined with the parameter table on
  the chunk and written as the next table.

The driver receives one row of metrics an epoch, never parameters or rows.  A task holds
the parameters and one partition (about ``PARTITION_BYTES``) of rows.

Rows that don't fit the layers, or have a null or non-finite element, are left out and
counted by reason; a step or loss that is not finite raises.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediafeat.operators.train import CHUNK, input_report, input_shape, require_finite, unfit_reason
from mediafeat.session import scratch_path

PARTITION_BYTES = 64 << 20     # of training rows in one task
SMALL_MODEL = 8 << 20          # bytes of parameters up to which scoring broadcasts them
CLIP = 1e-7


def layer_slices(layers: list[int]) -> list[tuple[int, int, int, int]]:
    """(begin, end, outputs, inputs + 1) of each layer in the flat vector."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((at, at + b * (a + 1), b, a + 1))
        at += b * (a + 1)
    return out


def size(layers: list[int]) -> int:
    return layer_slices(layers)[-1][1]


def initial(spark: SparkSession, layers: list[int], seed: int = 7, chunk: int = CHUNK, zero: bool = False) -> DataFrame:
    """(chunk, v): weights uniform within sqrt(6 / (inputs + outputs)), from the hash of
    the seed and the place; biases, and with ``zero`` all, 0."""
    i = F.col("i")
    value = F.lit(0.0)
    for begin, end, rows, cols in layer_slices(layers):
        place = F.concat(F.lit(f"{seed}:"), i.cast("string"))
        u = F.conv(F.substring(F.md5(place), 1, 8), 16, 10).cast("double") / float(1 << 32)
        drawn = (u * 2 - 1) * math.sqrt(6.0 / (rows + cols - 1))
        value = F.when((i >= begin) & (i < end) & ((i - begin) % cols != cols - 1), drawn).otherwise(value)
    n = size(layers)
    rows = spark.range(-(-n // chunk)).select(F.col("id").cast("int").alias("chunk"), F.explode(
        F.sequence(F.col("id") * chunk, F.least(F.col("id") * chunk + chunk, F.lit(n)) - 1)).alias("i"))
    rows = rows.select("chunk", "i", (F.lit(0.0) if zero else value).alias("w"))
    return rows.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda s: s["w"]).alias("v"))


def forward(w: np.ndarray, layers: list[int], x: np.ndarray) -> list[np.ndarray]:
    """The input and every layer's output: rectified, at last sigmoid."""
    out = [x]
    for begin, end, rows, cols in layer_slices(layers):
        m = w[begin:end].reshape(rows, cols)
        z = out[-1] @ m[:, :-1].T + m[:, -1]
        out.append(1.0 / (1.0 + np.exp(-z)) if end == len(w) else np.maximum(z, 0.0))
    return out


def gradient(w: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, int]:
    """(mean gradient of the summed cross-entropy, its sum, rows whose arg-max is right)."""
    acts = forward(w, layers, x)
    p = acts[-1]
    q = np.clip(p, CLIP, 1 - CLIP)
    loss = float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).sum())
    grad, delta = np.empty_like(w), (p - y) / len(x)
    for (begin, end, rows, cols), a in zip(reversed(layer_slices(layers)), reversed(acts[:-1])):
        g = grad[begin:end].reshape(rows, cols)
        g[:, :-1], g[:, -1] = delta.T @ a, delta.sum(0)
        if begin:
            delta = (delta @ w[begin:end].reshape(rows, cols)[:, :-1]) * (a > 0)
    return grad, loss, int((p.argmax(1) == y.argmax(1)).sum())


def _matrix(column, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _parameters(table) -> np.ndarray:
    rows = sorted(zip(table.column("chunk").to_pylist(), table.column("v").to_pylist()))
    return np.concatenate([np.asarray(v, np.float64) for _, v in rows])


def _epoch(layers: list[int], rate: float, batch: int, chunk: int):
    """The change that one partition of rows makes to the parameters."""
    def run(group, data, model):
        import pyarrow as pa
        start = _parameters(model)
        w, n, loss, right = start.copy(), data.num_rows, 0.0, 0
        data = data.sort_by([("o", "ascending")])
        x, y = _matrix(data.column("x"), layers[0]), _matrix(data.column("y"), layers[-1])
        for s in range(0, n, batch):
            g, part, ok = gradient(w, layers, x[s:s + batch], y[s:s + batch])
            w -= rate * g
            loss, right = loss + part, right + ok
        change = (w - start) * n
        at = range(0, len(w), chunk)
        return pa.table({"chunk": pa.array([-1] + [s // chunk for s in at], pa.int32()), "n": pa.array([n] * (1 + len(at)), pa.int64()),
                         "v": pa.array([[loss, float(right)]] + [change[s:s + chunk].tolist() for s in at], pa.list_(pa.float64()))})
    return run


def _sum(rows: DataFrame, *keys: str) -> DataFrame:
    """Element-wise sums of the arrays ``v``, in the order of their partitions."""
    return (rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("p", "v"))).alias("s"))
            .select(*keys, "n", F.aggregate(F.col("s.v"), F.array_repeat(F.lit(0.0), F.size(F.col("s")[0]["v"])),
                                            lambda acc, x: F.zip_with(acc, x, lambda a, b: a + F.coalesce(b, F.lit(math.nan)))).alias("v")))


def _copies(params: DataFrame, partitions: int) -> DataFrame:
    return params.select("chunk", "v", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("p"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Network:
    layers: list[int]
    params: DataFrame                                   # chunk, v
    history: list[dict] = field(default_factory=list)
    left_out: dict[str, int] = field(default_factory=dict)

    def weights(self) -> DataFrame:
        """layer, out, inp, w; the input numbered as their count is the bias."""
        flat = self.params.select("chunk", F.posexplode("v").alias("i", "w"))
        first = self.params.where("chunk = 0").select(F.size("v").alias("step"))         # one row
        flat = flat.join(F.broadcast(first)).select((F.col("chunk") * F.col("step") + F.col("i")).alias("at"), "w")
        layer, begin, cols = (F.lit(0) for _ in range(3))
        for k, (b, _, _, c) in enumerate(layer_slices(self.layers)):
            here = F.col("at") >= b
            layer, begin, cols = F.when(here, k).otherwise(layer), F.when(here, b).otherwise(begin), F.when(here, c).otherwise(cols)
        at = F.col("at") - begin
        return flat.select(layer.cast("int").alias("layer"), F.floor(at / cols).cast("int").alias("out"), (at % cols).cast("int").alias("inp"), "w")

    def score(self, df: DataFrame, features_col: str, out: str = "scores", inline: bool | None = None) -> DataFrame:
        """``df`` with its array of output probabilities (null where the vector is null, of
        another length or holds a null or non-finite element).  Parameters of up to
        ``SMALL_MODEL`` bytes are broadcast; larger ones meet partitions of rows as
        in training."""
        x = F.col(features_col).cast("array<double>")
        bad = x.isNull() | (F.size(x) != self.layers[0]) | F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        if 8 * size(self.layers) <= SMALL_MODEL if inline is None else inline:
            return df.withColumn(out, _broadcast_score(self, F.when(~bad, x)))
        partitions = _partitions(df.sparkSession, df.count(), self.layers[0])
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.when(~bad, x).alias("x"))
        rows = rows.withColumn("p", F.pmod(F.xxhash64("x", F.monotonically_increasing_id()), F.lit(partitions)).cast("int"))
        layers = self.layers

        def run(group, data, model):
            import pyarrow as pa
            keep = data.column("x").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            scores: list = [None] * data.num_rows
            if keep.any():
                p = forward(_parameters(model), layers, _matrix(data.filter(pa.array(keep)).column("x"), layers[0]))[-1]
                for i, r in zip(np.flatnonzero(keep).tolist(), p.tolist()):
                    scores[i] = r
            return pa.table({"row": data.column("row"), "s": pa.array(scores, pa.list_(pa.float64()))})
        kind = f"row {rows.schema['row'].dataType.simpleString()}, s array<double>"
        done = rows.groupBy("p").cogroup(_copies(self.params, partitions).groupBy("p")).applyInArrow(run, kind)
        return done.where("row is not null").select("row.*", F.col("s").alias(out))


def _broadcast_score(model: Network, x: Column) -> Column:
    rows = model.params.orderBy("chunk").collect()      # at most SMALL_MODEL bytes
    shared = model.params.sparkSession.sparkContext.broadcast(np.concatenate([np.asarray(r.v) for r in rows]))
    layers = model.layers

    @F.pandas_udf("array<double>")
    def score(column: pd.Series) -> pd.Series:
        good = column.notna().to_numpy()
        out = [None] * len(column)
        if good.any():
            p = forward(shared.value, layers, np.stack(column[good].to_numpy()).astype(np.float64))[-1]
            for i, row in zip(np.flatnonzero(good), p):
                out[i] = row
        return pd.Series(out, dtype=object)
    return score(x)


def _partitions(spark: SparkSession, rows: int, width: int) -> int:
    return max(spark.sparkContext.defaultParallelism, 8 * rows * width // PARTITION_BYTES + 1)


def fit(df: DataFrame, features_col: str, label_col: str, id_col: str, hidden: list[int] | None = None, epochs: int = 10,
        batch_size: int = 32, lr: float = 0.1, partitions: int | None = None, chunk: int = CHUNK, seed: int = 7,
        start: DataFrame | None = None, shape: tuple[int, int] | None = None) -> Network:
    """A network with ``hidden`` rectified layers, by synchronous data-parallel gradient
    descent.  ``partitions`` is part of the result.  Without hidden layers it starts from
    zeros, else from :func:`initial`, or from ``start`` (chunk, v of the same ``chunk``)."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(features_col).cast("array<double>").alias("x"), F.col(label_col).cast("array<double>").alias("y"))
    shape = shape or input_shape(rows)
    if shape is None:
        raise ValueError("no training rows")
    left_out = {r.reason: r.n for r in input_report(rows, "x", "y", shape).collect()}        # a few reasons
    used = left_out.pop(None, 0)
    if not used:
        raise ValueError("no training rows")
    layers = [shape[0], *(hidden or []), shape[1]]
    partitions = partitions or _partitions(spark, used, sum(shape))
    # written once for all epochs, so that a lost executor costs a read; repeated ids are
    # spread by their vectors
    mix = F.xxhash64("id", "x", "y")
    data = _written(rows.where(unfit_reason(*shape).isNull())
                    .select("x", "y", mix.alias("o"), F.pmod(mix, F.lit(partitions)).cast("int").alias("p")), "network-rows")
    params = _written(start if start is not None else initial(spark, layers, seed, chunk, zero=not hidden), "network-parameters")
    model = Network(layers, params, left_out=left_out)
    chunks, fan = -(-size(layers) // chunk), max(1, math.isqrt(partitions))
    for epoch in range(1, epochs + 1):
        changes = (data.groupBy("p").cogroup(_copies(params, partitions).join(data.select("p").distinct(), "p", "left_semi").groupBy("p"))
                   .applyInArrow(_epoch(layers, lr, batch_size, chunk), "chunk int, n long, v array<double>"))
        first = changes.withColumn("p", F.xxhash64("v")).withColumn("fan", F.pmod(F.spark_partition_id(), F.lit(fan)))
        summed = _written(_sum(_sum(first, "chunk", "fan").withColumnRenamed("fan", "p"), "chunk"), "network-changes")
        step = F.zip_with("v", "dv", lambda a, b: a + b)
        moved = summed.where("chunk >= 0").select("chunk", F.transform("v", lambda x: x / F.col("n")).alias("dv"))
        params = _written(params.join(moved, "chunk").select("chunk", step.alias("v")), "network-parameters")
        sound = params.select(F.aggregate("v", F.lit(0.0), lambda a, b: a + F.abs(b)).alias("s")).agg(F.sum("s").alias("s"), F.count("s").alias("n")).first()
        told = summed.where("chunk < 0").select("n", "v").first()
        if sound.n != chunks:
            raise RuntimeError("incomplete epoch aggregate")
        require_finite(epoch, told.v, [sound.s])
        model.params = params
        model.history.append({"epoch": epoch, "n": told.n, "loss": told.v[0] / (told.n * layers[-1]), "accuracy": told.v[1] / told.n})
    return model
