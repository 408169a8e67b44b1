"""Quality classifier by Bradley-Terry ranking of preference pairs.

Labelled training documents of either kind are paired: within small hash buckets each better
document meets worse ones in turn, so the pairs grow with the documents and not with their product.
The score is linear in a few shape features of the text. Its weights minimise the logistic loss on
feature differences plus a ridge term, by Newton steps of one grouped sum each over all pairs.

The threshold is a quantile of the training scores: of a thousand quantiles the one that splits the
two labels best, moved half way to the quantile below. Scores are squashed so that it stands at 0.7.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import SPACE, cut, is_fold, words

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Documents that share a bucket when pairs are made, on average.
BUCKET = 32
RIDGE = 0.01
STEPS = 25
QUANTILES = 1000
SYMBOLS = "#*$%&|<>"
FEATURES = ("symbols", "exclaims", "uppers", "digits", "words", "repeats", "stutters", "width", "lines")


def features(docs: DataFrame) -> DataFrame:
    """`docs` with `x`, the features of the whole text; a null text counts as empty.

    Shares of symbols, exclamation marks, capitals and digits among the characters; log of the
    number of words, of words per distinct word and of characters per word; the shares of words
    equal to the one before, and of lines equal to an earlier one. Shares enter by their root.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    length = F.greatest(F.length(text), F.lit(1))
    gone = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))) / length
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACE)) != "")
    base = docs.withColumns({"_w": words(F.col("text")), "_lines": lines})
    n, n_lines = F.size("_w"), F.size("_lines")
    stutters = F.size(F.filter("_w", lambda w, i: w == F.get(F.col("_w"), i - 1)))
    x = [
        F.sqrt(gone(SYMBOLS)), F.sqrt(gone("!")),
        F.sqrt(F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) / length),
        F.sqrt(gone("0123456789")), F.log1p(n),
        F.log(F.greatest(n, F.lit(1)) / F.greatest(F.size(F.array_distinct("_w")), F.lit(1))),
        F.sqrt(stutters / F.greatest(n, F.lit(1))), F.log(length / F.greatest(n, F.lit(1))),
        F.sqrt(1 - F.size(F.array_distinct("_lines")) / F.greatest(n_lines, F.lit(1))),
    ]
    x[-1] = F.when(n_lines == 0, 0.0).otherwise(x[-1])
    return base.withColumn("x", F.array(*[c.cast("double") for c in x])).drop("_w", "_lines")


@dataclass(frozen=True)
class Ranker:
    """Weights on raw features, and the utility that stands at the threshold."""

    weights: tuple[float, ...]
    cut_at: float
    scale: float

    def utility(self, x: Column) -> Column:
        return sum((F.get(x, F.lit(i)) * F.lit(w) for i, w in enumerate(self.weights)), F.lit(0.0))

    def score(self, x: Column) -> Column:
        shift = math.log(THRESHOLD / (1 - THRESHOLD))
        z = (self.utility(x) - F.lit(self.cut_at)) * F.lit(self.scale) + F.lit(shift)
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def training(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and label of the labelled documents outside the held-out fold.

    Repeated labels of a document are averaged, half counting as good; null labels and null ids
    teach nothing.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(
        F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).alias("good"))
    rows = scored.where(~is_fold(F.col("doc_id"), MODULUS, HELD_OUT)).select("doc_id", "x")
    return rows.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "x", "good")


def pairs(rows: DataFrame, buckets: int) -> DataFrame:
    """Differences `d` of features, better minus worse, over pairs within hash buckets."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets))
    side = lambda good: F.array_sort(F.collect_list(F.when(F.col("good") == good, F.col("x"))))
    met = rows.groupBy(bucket.alias("bucket")).agg(side(True).alias("up"), side(False).alias("down"))
    met = met.where((F.size("up") > 0) & (F.size("down") > 0))
    turn = F.explode(F.sequence(F.lit(0), F.greatest(F.size("up"), F.size("down")) - 1))
    one = met.select("up", "down", turn.alias("i"))
    better = F.get("up", F.pmod("i", F.size("up")))
    worse = F.get("down", F.pmod("i", F.size("down")))
    return one.select(F.zip_with(better, worse, lambda a, b: a - b).alias("d"))


def newton(diffs: DataFrame, spread: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights on standardised features that minimise mean logistic loss plus ridge."""
    k = len(spread)
    z = [F.get("d", F.lit(i)) / F.lit(float(s)) for i, s in enumerate(spread)]
    w = np.zeros(k)
    for _ in range(STEPS):
        u = sum((c * F.lit(float(v)) for c, v in zip(z, w)), F.lit(0.0))
        table = diffs.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], (1 / (1 + F.exp(u))).alias("p"))
        sums = [F.count(F.lit(1)), *[F.sum(F.col(f"z{i}") * F.col("p")) for i in range(k)]]
        curve = F.col("p") * (1 - F.col("p"))
        sums += [F.sum(F.col(f"z{i}") * F.col(f"z{j}") * curve) for i in range(k) for j in range(i + 1)]
        row = table.agg(*sums).first()
        n = max(row[0], 1)
        slope = np.array([v or 0.0 for v in row[1:k + 1]]) / n - ridge * w
        bend = np.zeros((k, k))
        bend[np.tril_indices(k)] = [v or 0.0 for v in row[k + 1:]]
        bend = (bend + np.tril(bend, -1).T) / n + ridge * np.eye(k)
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(scored: DataFrame, labels: DataFrame) -> Ranker:
    """Learn from all labelled training rows. Without both labels every document scores 0.7."""
    rows = cut(training(scored, labels), "ranking-rows")
    k = len(FEATURES)
    row = rows.agg(F.count(F.lit(1)), *[F.stddev_pop(F.get("x", F.lit(i))) for i in range(k)]).first()
    if not row[0]:
        return Ranker((0.0,) * k, 0.0, 1.0)
    spread = np.array([v if v and v > 1e-9 else 1.0 for v in row[1:]])
    diffs = cut(pairs(rows, max(1, row[0] // BUCKET)), "ranking-pairs")
    weights = tuple(float(v) for v in newton(diffs, spread) / spread)
    blank = Ranker(weights, 0.0, 1.0)
    seen = rows.select(blank.utility(F.col("x")).alias("u"), "good")
    grid = seen.agg(F.percentile_approx("u", [i / QUANTILES for i in range(1, QUANTILES)], 100_000)).first()[0]
    steps = sorted(set(grid))
    level = F.size(F.filter(F.array(*map(F.lit, steps)), lambda g: g <= F.col("u")))
    counts = {(r[0], r[1]): r[2] for r in seen.groupBy(level, "good").count().collect()}
    good, bad = (np.array([counts.get((i, g), 0) for i in range(len(steps) + 1)], float) for g in (True, False))
    if not good.sum() or not bad.sum():
        return Ranker((0.0,) * k, 0.0, 1.0)
    kept, dropped = good[::-1].cumsum()[::-1] / good.sum(), bad.cumsum() / bad.sum()
    at = int(np.argmax([kept[i] + dropped[i - 1] for i in range(1, len(steps) + 1)])) + 1
    lower = steps[at - 2] if at >= 2 else steps[at - 1] - 1.0
    return Ranker(weights, (steps[at - 1] + lower) / 2, 1.0)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every row of `docs`: doc_id, held_out, score in 0 to 1, and predicted (score >= 0.7).

    Labels, language, source and ids are no inputs of the score. A null or empty text is scored by
    its features, which are all zero; a null doc_id is scored and not held out; repeated rows are
    scored alike; no rows give no rows; other columns are not looked at.
    """
    scored = cut(features(docs.select("doc_id", "text")).select("doc_id", "x"), "ranking-features")
    score = fit(scored, labels).score(F.col("x"))
    return scored.select("doc_id", is_fold(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out"), score.alias("score")).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that score at least 0.7."""
    ranker = fit(features(docs.select("doc_id", "text")).select("doc_id", "x"), labels)
    marked = features(docs.select(F.struct("*").alias("_row"), "text"))
    # A filter is not moved below a row number, where it would compute the words once per feature.
    marked = marked.withColumn("_place", F.monotonically_increasing_id())
    good = (ranker.score(F.col("x")) >= THRESHOLD) & (F.col("_place") >= 0)
    return marked.where(good).select("_row.*")
