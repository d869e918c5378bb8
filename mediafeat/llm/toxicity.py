"""Toxicity scores by gradient-boosted trees over dense features, calibrated by
isotonic regression.

The lexicon is learned: stems (the first 4 to 7 letters of a word, case folded and
common look-alike characters undone) that are far more frequent in toxic training
documents than in others; their document counts come from every labelled training
row.  Features of a whole text: counts and densities of lexicon words, how many
stand within three words of a second-person pronoun, shares of capitals and
shouted words, punctuation and exclamation rates, and rates of obfuscated words
(symbols or digits inside a word, letters set apart).

The trees are fitted on a bounded sample of labelled rows (about ``MAX_ROWS``,
chosen by a hash of the id), the isotonic map on a part of it that the trees have not
seen.

Nulls: a null text counts as empty, and an empty text is scored like any other; a
null label or id teaches nothing.  With labels of fewer than two kinds every score is
the share of toxic labels (0 with none).
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediafeat.llm.common import fold, let, scratch, text_of

MAX_ROWS = 20_000         # labelled rows the trees are fitted on
NARROW = 1 << 20          # labelled rows up to which their ids are broadcast; above, texts are joined by shuffle
LEXICON = 400             # stems at most
STEMS = (4, 5, 6, 7)
MIN_ODDS, STRONG = 1.5, 4.0   # log odds of a mild and of a strong stem
MIN_EVIDENCE = 18.0       # its log-likelihood ratio, so that chance words stay out
THRESHOLD = 0.3
LOOK_ALIKE = ("01345$@", "oieassa")
#: second-person pronouns (fixed values)
YOU = ["you", "your", "yours", "yourself", "ur", "du", "dich", "dir", "dein", "deine", "tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "ti", "tus", "usted"]
FEATURES = ["lex_count", "lex_share", "mild_count", "mild_share", "near_you", "you_share", "upper_share", "shout_share", "exclaim_rate",
            "mark_rate", "symbol_words", "spaced_words", "log_words"]


def tokens(text: Column) -> Column:
    """Words of letters, case folded, after undoing look-alikes inside words."""
    plain = F.translate(F.lower(text), *LOOK_ALIKE)
    return F.regexp_extract_all(plain, F.lit(r"\p{L}+"), F.lit(0))


def learn_lexicon(labelled: DataFrame, limit: int = LEXICON) -> dict[str, bool]:
    """Stems and whether they are strong, by their log odds between toxic and other documents (``toxic``)."""
    stems = F.array_distinct(F.flatten(F.array(*[F.transform(F.filter(F.col("w"), lambda w: F.length(w) >= n), lambda w: F.left(w, F.lit(n)))
                                                 for n in STEMS])))
    # distinct words first: stems are taken of a document's vocabulary, not of its length
    docs = labelled.select("toxic", F.array_distinct(tokens(F.col("text"))).alias("w"))
    counts = (docs.select("toxic", F.explode(stems).alias("stem")).groupBy("stem")
              .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")))
    sums = labelled.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    if not sums.t or not sums.c:
        return {}
    odds = F.log((F.col("t") + 0.5) / F.lit(sums.t + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(sums.c + 1.0))
    rate, k = sums.t / (sums.t + sums.c), F.col("t") + F.col("c")
    evidence = 2 * (F.col("t") * F.log(F.col("t") / (k * rate)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (k * (1 - rate)))).otherwise(0.0))
    rows = (counts.where("t > 0").withColumns({"odds": odds, "evidence": evidence})
            .where((F.col("odds") >= MIN_ODDS) & (F.col("evidence") >= MIN_EVIDENCE))
            .orderBy(F.desc("evidence"), "stem").limit(limit).collect())
    return {r.stem: r.odds >= STRONG for r in rows}


def features(docs: DataFrame, lexicon: dict[str, bool], text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``FEATURES`` as one array ``tox_x``."""
    t = F.col(text)

    def toxic(w: Column) -> Column:      # 2: a strong stem, 1: a mild one
        out = F.lit(0)
        for value in (False, True):
            hit = F.lit(False)
            for n in STEMS:
                own = [s for s, strong in lexicon.items() if len(s) == n and strong == value]
                if own:
                    hit = hit | F.left(w, F.lit(n)).isin(own)
            out = F.when(hit, F.lit(2 if value else 1)).otherwise(out)
        return out

    def counts(w: Column) -> Column:
        hit = F.transform(w, toxic)
        return let(hit, lambda h: F.struct(
            F.size(w).alias("n"), F.size(F.filter(h, lambda x: x == 2)).alias("lex"), F.size(F.filter(h, lambda x: x == 1)).alias("mild"),
            F.size(F.filter(w, lambda x: x.isin(YOU))).alias("you"),
            F.when(F.exists(h, lambda x: x > 0), F.size(F.filter(
                F.transform(w, lambda x, i: (F.get(h, i) > 0) & F.exists(F.slice(w, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3)) + 4), lambda y: y.isin(YOU))),
                lambda x: x))).otherwise(0).alias("near")))
    raw = docs.withColumn("_tox", F.struct(
        let(tokens(t), counts).alias("w"), F.length(t).alias("chars"), F.regexp_count(t, F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count(t, F.lit(r"\b\p{Lu}{3,}\b")).alias("shout"), F.regexp_count(t, F.lit("!")).alias("exclaim"),
        F.regexp_count(t, F.lit(r"\p{Punct}")).alias("marks"), F.regexp_count(t, F.lit(r"\p{L}[0-9@$*!]+\p{L}")).alias("odd"),
        F.regexp_count(t, F.lit(r"\b\p{L}(?:[ .\-_]\p{L}){3,}\b")).alias("spaced")))
    n, chars = F.greatest(F.col("_tox.w.n"), F.lit(1)), F.greatest(F.col("_tox.chars"), F.lit(1))
    lex = F.col("_tox.w.lex")
    values = [F.least(lex, F.lit(50)), lex / n, F.least(F.col("_tox.w.mild"), F.lit(50)), F.col("_tox.w.mild") / n, F.least(F.col("_tox.w.near"), F.lit(50)), F.col("_tox.w.you") / n,
              F.col("_tox.upper") / chars, F.col("_tox.shout") / n, F.col("_tox.exclaim") / n, F.col("_tox.marks") / n,
              F.col("_tox.odd") / n, F.col("_tox.spaced") / n, F.log1p(F.col("_tox.w.n"))]
    return raw.withColumn("tox_x", F.array(*[v.cast("double") for v in values])).drop("_tox")


class Scorer:
    """A lexicon, trees and a calibration; ``score`` adds a column."""

    def __init__(self, lexicon: dict[str, bool], trees=None, steps: tuple[list[float], list[float]] = ([], []), prior: float = 0.0) -> None:
        self.lexicon, self.trees, self.steps, self.prior = lexicon, trees, steps, prior

    def margin(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``tox_x``) and the trees' probability ``tox_p``."""
        out = rows.select("*", *[F.col("tox_x")[i].alias(f"_x_{n}") for i, n in enumerate(FEATURES)])
        out = VectorAssembler(inputCols=[f"_x_{n}" for n in FEATURES], outputCol="_vector").transform(out)
        out = self.trees.transform(out).withColumn("tox_p", vector_to_array("probability")[1])
        return out.drop("_vector", "rawPrediction", "probability", "prediction", *[f"_x_{n}" for n in FEATURES])

    def calibrated(self, p: Column) -> Column:
        """The isotonic map: linear between its corners."""
        xs, ys = self.steps
        if not xs:
            return p
        out = F.when(p <= xs[0], F.lit(float(ys[0])))
        for x0, x1, y0, y1 in zip(xs, xs[1:], ys, ys[1:]):
            out = out.when(p <= x1, F.lit(float(y0)) + (p - float(x0)) * float((y1 - y0) / (x1 - x0) if x1 > x0 else 0.0))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), out.otherwise(F.lit(float(ys[-1])))))

    def score(self, rows: DataFrame, out: str = "score") -> DataFrame:
        if self.trees is None:
            return rows.withColumn(out, F.lit(float(self.prior)))
        return self.margin(rows).withColumn(out, self.calibrated(F.col("tox_p"))).drop("tox_p")


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, max_rows: int = MAX_ROWS) -> Scorer:
    """``docs``: doc_id, text.  Learns from labelled rows outside fold ``held_out``."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("toxic in (0, 1) and doc_id is not null").where(fold("doc_id", folds) != held_out)
    n = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    if not n.n or not n.t or n.t == n.n:
        return Scorer({}, prior=(n.t or 0) / max(n.n, 1))
    lexicon = learn_lexicon(docs.join(F.broadcast(marked) if n.n <= NARROW else marked, "doc_id"))
    slot = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 20))
    chosen = marked.where(slot < int(min(1.0, max_rows / n.n) * (1 << 20)))
    sample = scratch(docs.join(F.broadcast(chosen), "doc_id"), "tox-texts")      # about max_rows ids and labels
    rows = features(sample.select("doc_id", "text", "toxic"), lexicon).select("toxic", "tox_x", (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) == 0).alias("late"))
    rows = scratch(rows, "tox-sample").coalesce(4)
    seen = rows.groupBy("late").agg(F.min("toxic").alias("a"), F.max("toxic").alias("b")).collect()
    if not any(r.a != r.b for r in seen if not r.late):
        return Scorer(lexicon, prior=n.t / n.n)
    x = VectorAssembler(inputCols=[f"_x_{k}" for k in FEATURES], outputCol="_vector").transform(
        rows.where("not late").select("toxic", *[F.col("tox_x")[i].alias(f"_x_{k}") for i, k in enumerate(FEATURES)]))
    trees = GBTClassifier(featuresCol="_vector", labelCol="toxic", maxIter=12, maxDepth=3, maxBins=32, stepSize=0.3, seed=7).fit(x)
    scorer = Scorer(lexicon, trees, prior=n.t / n.n)
    if any(r.a != r.b for r in seen if r.late):
        late = scorer.margin(rows.where("late")).select(F.col("toxic").cast("double").alias("toxic"), "tox_p")
        steps = IsotonicRegression(featuresCol="tox_p", labelCol="toxic").fit(late)
        xs, ys = [float(v) for v in steps.boundaries], [float(v) for v in steps.predictions]
        scorer.steps = _thin(xs, ys)
    return scorer


def _thin(xs: list[float], ys: list[float], limit: int = 60) -> tuple[list[float], list[float]]:
    """At most ``limit`` corners of the map, evenly chosen, both ends kept."""
    if len(xs) <= limit:
        return xs, ys
    at = sorted({math.floor(i * (len(xs) - 1) / (limit - 1)) for i in range(limit)})
    return [xs[i] for i in at], [ys[i] for i in at]


def scored(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    base = text_of(docs)
    scorer = fit(base, labels, folds, held_out)
    rows = features(base, scorer.lexicon).select("doc_id", "tox_x")
    return scorer.score(rows).select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below ``threshold``."""
    scorer = fit(text_of(docs), labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = features(rows, scorer.lexicon, "_text").drop("_text")
    return scorer.score(rows, "_score").where(F.col("_score") < threshold).select("_row.*")
