"""Quality rules: a learned decision list over text statistics.

Sequential covering: each rule is a conjunction of thresholds grown one
condition at a time by FOIL gain on the growing rows, pruned to the prefix that
does best on the pruning rows, and kept while it is precise enough there; the
rows it covers are then set aside.  The list is emitted as one ordered
``CASE WHEN`` column: the first rule that fires rejects, the default keeps.

Each growing step is one aggregate over a narrow table of bin numbers: the driver
sees a count per (statistic, bin, label), never rows.

Nulls and texts without words have all statistics 0; a null label teaches nothing;
with no labelled rows the list is empty and only the base rules apply.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediafeat.llm.common import WORD, fold, let, scratch, text_of

BINS = 24           # candidate thresholds of a statistic (quantiles of the labelled rows)
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9     # of a rule on the pruning rows
MIN_COVER = 0.002       # share of the labelled rejects that a rule must cover
SYMBOLS = "[#*$%&|<>]"

#: statistics the rules may test, from the base counts
FEATURES = ["mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "exclaim_per_word",
            "digit_share", "distinct_share", "words", "marks_per_word"]


def repeat_words(hashes: Column, n: int = 5) -> Column:
    """Words inside ``n``-word windows whose words occur twice or more in the text
    (the first occurrence included), from the hashes of the words."""
    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - n),
                          lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(n)]))

    def cover(p: Column) -> Column:     # sorted starts of repeated windows
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(s: Column) -> Column:    # sorted (hash, start): equal to a neighbour
        same = F.transform(s, lambda x, i: F.when(
            F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["i"]))
        return F.sort_array(F.filter(same, lambda x: x.isNotNull()))

    def repeated(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            let(let(pairs, starts), cover))
    return F.when(F.size(hashes) < n, F.lit(0).cast("long")).otherwise(let(windows, repeated))


def statistics(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and the counts of every whole text; one read of the text."""
    text = F.col("text")
    base = text_of(docs, *more).select(
        "doc_id", *more,
        let(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)), lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"), F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
            repeat_words(h).alias("n_repeat_words"))).alias("w"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), lambda x: F.struct(
            F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))).alias("l"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count(text, F.lit(r"[\p{Punct}]")).cast("long").alias("n_marks"))
    return base.select("doc_id", *more, "w.n_words", "word_chars", "n_symbols", (F.col("l.n") - F.col("l.d")).alias("n_dup_lines"),
                       "w.n_repeat_words", "w.n_distinct", F.col("l.n").alias("n_lines"), "n_upper", "n_digits", "n_exclaim", "n_marks")


def features(stats: DataFrame) -> DataFrame:
    """The tested statistics, from the counts."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return stats.withColumns({
        "mean_word": F.col("word_chars") / words, "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars, "exclaim_per_word": F.col("n_exclaim") / words,
        "digit_share": F.col("n_digits") / chars, "distinct_share": F.col("n_distinct") / words,
        "words": F.col("n_words").cast("double"), "marks_per_word": F.col("n_marks") / words})


@dataclass
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold) that rejects."""
    conditions: list[tuple[str, str, float]]
    covered: int = 0
    rejects: int = 0

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, t in self.conditions:
            out = out & (F.col(name) <= t if op == "<=" else F.col(name) > t)
        return out


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """Ordered conditional expression: True keeps."""
        out = None
        for r in self.rules:
            out = (F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False)))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(f"{n} {o} {t:.6g}" for n, o, t in r.conditions) + f"  [{r.rejects}/{r.covered}]"
                         for r in self.rules) or "keep all"


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 and p0 else 0.0


def learn(labelled: DataFrame, label: str = "label", names: list[str] = FEATURES, bins: int = BINS) -> DecisionList:
    """``labelled``: the statistics, ``label`` (1 good, 0 reject) and ``prune``
    (the row is for pruning).  All rows count."""
    cuts_row = labelled.select(*[F.percentile_approx(n, [i / bins for i in range(1, bins)], 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(cuts_row[n] or [])) for n in names}
    names = [n for n in names if cuts[n]]
    if not names:
        return DecisionList()

    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts[name]]), lambda c: c < F.col(name)))

    rows = scratch(labelled.where(F.col(label).isNotNull()).select(F.array(*[bin_of(n) for n in names]).alias("b"), (F.col(label) == 0).alias("bad"), "prune"),
                   "rule-bins").coalesce(64)
    total_bad = rows.where("bad").count()
    out = DecisionList()

    def holds(conditions) -> Column:        # a condition on bins: (statistic number, op, cut number)
        c = F.lit(True)
        for i, op, k in conditions:
            c = c & (F.get("b", F.lit(i)) <= k if op == "<=" else F.get("b", F.lit(i)) > k)
        return c

    left = rows
    while len(out.rules) < MAX_RULES:
        chosen: list[tuple[int, str, int]] = []
        while len(chosen) < MAX_CONDITIONS:
            hist = (left.where(~F.col("prune") & holds(chosen)).select("bad", F.posexplode("b").alias("f", "bin"))
                    .groupBy("f", "bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect())
            by: dict[int, dict[int, tuple[int, int]]] = {}
            for r in hist:
                by.setdefault(r.f, {})[r.bin] = (r.p, r.n)
            if not by:
                break
            p0, n0 = (sum(x[i] for x in by[0].values()) for i in (0, 1))
            best = (0.0, None)
            for f in sorted(by):
                p = n = 0
                for k in range(len(cuts[names[f]])):
                    a = by[f].get(k, (0, 0))
                    p, n = p + a[0], n + a[1]
                    for op, p1, n1 in (("<=", p, n), (">", p0 - p, n0 - n)):
                        if p1 + n1 < p0 + n0 and (g := _gain(p0, n0, p1, n1)) > best[0] + 1e-9:
                            best = (g, (f, op, k))
            if best[1] is None:
                break
            chosen.append(best[1])
            if n0 == 0:
                break
        if not chosen:
            break
        # how many leading conditions each pruning row meets: counts for every prefix
        met, ok = F.lit(0), F.lit(True)
        for c in chosen:
            ok = ok & holds([c])
            met = met + ok.cast("int")
        counts = left.where("prune").groupBy(met.alias("m")).agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        at = [(sum(r.p for r in counts if r.m >= k), sum(r.n for r in counts if r.m >= k)) for k in range(1, len(chosen) + 1)]
        worth = [((p - n) / (p + n) if p + n else -1.0) for p, n in at]
        keep = max(range(len(at)), key=lambda k: (round(worth[k], 6), -k)) + 1
        p, n = at[keep - 1]
        if p < max(2, MIN_COVER * total_bad / 3) or p / (p + n) < MIN_PRECISION:
            break
        chosen = chosen[:keep]
        out.rules.append(Rule([(names[f], op, float(cuts[names[f]][k])) for f, op, k in chosen], p + n, p))
        left = left.where(~holds(chosen))
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[DataFrame, DecisionList]:
    """Every document with its counts and verdict, and the list that gave it."""
    stats = scratch(statistics(docs), "rule-stats")
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    data = features(stats).join(marked, "doc_id").where(~base_failed()).withColumn("prune", fold("doc_id", 3) == 0)
    rules = learn(data)
    out = features(stats).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.verdict())
    return out, rules
