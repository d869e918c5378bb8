"""Language identification by sparse multinomial logistic regression.

Features are character 1- to 3-grams of the lower-cased text (all that is not a
letter counts as one blank), hashed into ``DIMS`` columns and weighted by term
frequency times inverse document frequency.  Document frequencies come from every
training document.  The model is trained with follow-the-regularised-leader
(per-coordinate rates, elastic net: ``L1`` keeps it sparse, ``L2`` keeps it small)
over a bounded sample: at most about ``PER_LANGUAGE`` training documents of each
language, chosen by a hash of the id.  A fifth of the sample is kept out to
calibrate the probabilities by one temperature.

Scoring reads every whole text once: hashes and sums of weights in numpy.

Nulls: a text that is null or has no letter is ``und`` with score 0; a null lang is
not learned from; a null id is never learned from.  With no training rows all is
``und``.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import fold

BITS = 17
DIMS = 1 << BITS
GRAMS = 3
PER_LANGUAGE = 800    # training documents sampled of each language (expected number, at most)
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 0.05, 0.01, 0.001
SCALE = 30.0          # of a document's relative term frequencies
SLICES = 8


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(texts: list[str]):
    """(hashed n-gram at every position, document bounds, letters per document)."""
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes * GRAMS)])
    c = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum(sizes)])
    letter = _letters()[c]
    c = np.where(letter, c, np.uint32(32)).astype(np.uint32)
    letters = np.add.reduceat(letter.astype(np.int64), at[:-1]) if len(texts) else np.zeros(0, np.int64)
    out = np.empty((len(c), GRAMS), np.int32)
    acc = np.zeros(len(c), np.uint32)
    padded = np.concatenate([c, np.full(GRAMS, 32, np.uint32)])
    for n in range(GRAMS):
        acc = (acc ^ padded[n:n + len(c)]) * np.uint32(0x9E3779B1)
        acc ^= acc >> np.uint32(15)
        out[:, n] = ((acc * np.uint32(0x85EBCA77) + np.uint32(n * 0x27D4EB2F)) >> np.uint32(32 - BITS)).astype(np.int32)
    return out.reshape(-1), bounds, letters


def _runs(texts: list[str], limit: int = 1 << 18):
    i, held = 0, 0
    for j, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield i, j
            i, held = j, 0
        held += len(t)
    if i < len(texts):
        yield i, len(texts)


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each column occurs, and how many there are."""
    def count(batches):
        import pyarrow as pa
        df, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            texts = b.column(0).to_pylist()
            for i, j in _runs(texts):
                g, at, _ = _grams(texts[i:j])
                for k in range(j - i):
                    seen = np.zeros(DIMS, bool)
                    seen[g[at[k]:at[k + 1]]] = True
                    df += seen
            n += len(texts)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([K.pack(x) for x in np.split(df, SLICES)], pa.binary()),
                                              pa.array([n] + [0] * (SLICES - 1), pa.int64())], ["slice", "df", "n"])

    def total(batches):
        import pyarrow as pa
        sums: dict[int, list] = {}
        for b in batches:
            for s, blob, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = sums.setdefault(s, [np.zeros(DIMS // SLICES, np.uint64), 0])
                x[0] = x[0] + K.unpack(blob)
                x[1] += n
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([K.pack(x[0]) for x in sums.values()], pa.binary()),
                                              pa.array([x[1] for x in sums.values()], pa.int64())], ["slice", "df", "n"])
    schema = "slice int, df binary, n long"
    rows = training.select("text").mapInArrow(K.lean(count), schema).repartition(SLICES, "slice").mapInArrow(K.lean(total), schema).collect()
    df = np.zeros(DIMS, np.int64)
    for r in rows:
        df[r["slice"] * (DIMS // SLICES):(r["slice"] + 1) * (DIMS // SLICES)] = K.unpack(r["df"])
    return df, sum(r["n"] for r in rows)


def _weights(z, n):
    w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    return w


def _softmax(s):
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """(DIMS + 1, classes) weights by follow-the-regularised-leader over (columns,
    values, class) rows; the last row is the bias."""
    z, n = np.zeros((DIMS + 1, classes)), np.zeros((DIMS + 1, classes))
    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for r in order:
            col, x, y = rows[r]
            zi, ni = z[col], n[col]
            w = _weights(zi, ni)
            g = _softmax(x @ w)
            g[y] -= 1
            g = x[:, None] * g
            more = ni + g * g
            z[col] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
            n[col] = more
    return _weights(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least held-out log loss."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(math.log(0.05), math.log(20), 121))
    loss = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """Weights with idf and scale folded in, one column per language."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, heat: float) -> None:
        self.languages, self.weights, self.bias, self.heat = languages, weights, bias, heat

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text."""
        lang, prob = [], []
        for i, j in _runs(texts):
            g, at, letters = _grams(texts[i:j])
            s = np.stack([np.add.reduceat(self.weights[c][g], at[:-1]) for c in range(len(self.languages))], 1) / np.diff(at)[:, None]
            p = _softmax((s + self.bias) / self.heat)
            best = p.argmax(1)
            for k in range(j - i):
                lang.append(self.languages[best[k]] if letters[k] else "und")
                prob.append(float(p[k, best[k]]) if letters[k] else 0.0)
        return lang, np.array(prob)


def fit(training: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """``training``: doc_id, text, lang (none null)."""
    counts = {r.lang: r["count"] for r in training.groupBy("lang").count().collect()}     # one row per language
    if not counts:
        return None
    languages = sorted(counts)
    df, n = document_frequencies(training)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / counts[k]))) for k in languages])
    sample = training.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))

    def vectors(batches):
        import pyarrow as pa
        for b in batches:
            texts, out = b.column(1).to_pylist(), []
            for i, j in _runs(texts):
                g, at, letters = _grams(texts[i:j])
                for k in range(j - i):
                    col, c = np.unique(g[at[k]:at[k + 1]], return_counts=True)
                    out.append((col.astype(np.int32).tobytes(), (c / c.sum()).astype(np.float32).tobytes(), int(letters[k])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *[pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.int64()))]]
                                             if out else [b.column(0), b.column(2), pa.array([], pa.binary()), pa.array([], pa.binary()), pa.array([], pa.int64())],
                                             ["doc_id", "lang", "col", "tf", "letters"])

    def learn(batches):
        import pyarrow as pa
        rows = []
        for b in batches:
            for doc, lang, col, tf, letters in zip(*(b.column(i).to_pylist() for i in range(5))):
                if letters:
                    c = np.frombuffer(col, np.int32)
                    rows.append((doc, (np.append(c, DIMS), np.append(np.frombuffer(tf, np.float32) * idf[c] * SCALE, 1.0), languages.index(lang))))
        rows = [r for _, r in sorted(rows, key=lambda r: r[0])]
        kept, held = [r for i, r in enumerate(rows) if i % 5], rows[::5]
        w = train(kept or held, len(languages))
        scores = np.array([x @ w[c] for c, x, _ in held]).reshape(len(held), len(languages))
        heat = temperature(scores, np.array([y for *_, y in held], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary()), pa.array([heat])], ["w", "heat"])
    row = (sample.select("doc_id", "text", "lang").mapInArrow(K.lean(vectors), "doc_id long, lang string, col binary, tf binary, letters long")
           .repartition(1).mapInArrow(K.lean(learn), "w binary, heat double").first())     # the bounded sample
    w = np.frombuffer(row.w, np.float32).reshape(DIMS + 1, len(languages))
    folded = np.ascontiguousarray((w[:DIMS] * (idf * SCALE)[:, None]).T.astype(np.float32))
    return Model(languages, folded, w[DIMS].astype(float), row.heat)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from text and
    lang of the documents outside fold ``held_out``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"),
                       (fold("doc_id", folds) == held_out).alias("held_out"))
    training = base.where("not held_out and doc_id is not null and lang is not null and text is not null")
    model = fit(training.select("doc_id", "text", "lang"))
    if model is None:
        return base.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)      # DIMS floats per language

    def run(batches):
        import pyarrow as pa
        for b in batches:
            lang, p = shared.value.predict([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(p, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return base.select("doc_id", "held_out", "text").mapInArrow(K.lean(run), "doc_id long, held_out boolean, lang_pred string, score double")
