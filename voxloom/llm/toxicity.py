"""Toxic passages by maximum-scoring segments.

A word's score is the log odds of toxic against other texts under an informative Dirichlet prior: the counts of each class
are joined by pseudo-words shared out as the whole vocabulary is, as many as the toxic texts have words but at most ``PRIOR``, so
few labels are not drowned. A word's score is its log odds less one standard error. It is listed if that exceeds ``LEAST``
and if among all words as frequent as it fewer than ``CHANCE`` would lean so far to class 1 by luck (binomial tail): the cut
follows the size of the vocabulary and holds for ten labels as for thousands. All other words have one small negative score,
so long harmless stretches cost something. One linear
scan of a text finds all disjoint maximal segments. A segment's score becomes an expected number of segments as good in a
harmless text of that length, K n exp(-lambda S): lambda solves the score equation for the background, K is fitted to
the harmless training texts. Several segments are put together with the sum statistic, and the negative log of its
probability is mapped to a score from 0 to 1 by a logistic curve fitted on the training rows.

The lexicon is learnt from at most ``SAMPLE`` labelled rows outside of the held-out fold, the smallest by hash of the id; the
bound belongs to the classifier. No listed word is left out. Equal texts count once. The sample is written to the
shared folder and read for each step of the fit. Then every text is scanned whole, in one pass and without a shuffle.

Defined results: null and empty texts have no segment and the lowest score. Repeated rows score alike. Without labels of
both classes, or where no word leans to class 1, the lexicon is empty and every text has the score 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import own_names, remainder, words_of
from voxloom.session import materialize

SAMPLE = 32_768
#: Most pseudo-words of the prior, least log odds of a listed word (fourfold), and words expected by luck.
PRIOR, LEAST, CHANCE = 10_000, math.log(4), 0.5
#: Width and number of the bins of the calibration.
BIN, BINS = 0.25, 200
#: Bytes of words: lower-case ASCII letters, digits and all bytes of other characters; the rest is blank.
WORD_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def segments(places: Sequence[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, words, score) of a text whose listed words have a positive score and all
    others ``other`` < 0. Linear: each step looks back along candidates it then merges.

    Between listed words only the number of others matters, so the scan goes from listed word to listed word.
    """
    found: list[list[float]] = []  # first, last, sum before, sum after
    total, at = 0.0, 0
    for place, score in places:
        total += other * (place - at)
        left, right, first = total, total + score, place
        total, at = right, place + 1
        while True:
            # the nearest earlier candidate with a smaller sum before it
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= right:
                found.append([first, place, left, right, j])
                break
            first, left = int(found[j][0]), found[j][2]
            del found[j:]
    return [(int(a), int(b - a + 1), after - before) for a, b, before, after, _ in found]


class Lexicon:
    """Scores of the listed words, the score of all others, the two constants of the extreme values, and the intercept and
    slope of the logistic curve (none where there was nothing to fit)."""

    def __init__(self, scores: dict[bytes, float], other: float, rate: float):
        self.scores, self.other, self.rate, self.size = scores, other, rate, 1.0
        self.curve: tuple[float, float] | None = None

    def score(self, significance: float) -> float:
        if self.curve is None:
            return 0.0
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.curve[0] + self.curve[1] * min(significance, BIN * BINS)))))

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        split, scores = words(text), self.scores
        places = [(i, scores[w]) for i, w in enumerate(split) if w in scores]
        return len(split), segments(places, self.other) if places else []

    def significance(self, n: int, found: Sequence[tuple[int, int, float]]) -> float:
        """-ln of the probability of segments this good in a harmless text of ``n`` words."""
        if not found:
            return 0.0
        normal = sorted((self.rate * s - math.log(self.size * max(n, 1)) for _, _, s in found), reverse=True)
        best, total = 0.0, 0.0
        for r, value in enumerate(normal, 1):
            total += value
            if total <= 0:
                break
            if r == 1:
                # the tail of the extreme-value law; far out it is the score itself
                tail = total if total > 30 else -math.log(-math.expm1(-math.exp(-total)))
            else:
                tail = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
            best = max(best, tail)
        return best


def decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1; the mean score must be negative."""
    value = lambda rate: float((shares * np.exp(rate * scores)).sum()) - 1
    high = 1e-3
    while value(high) < 0 and high < 1e3:
        high *= 2
    low = high / 2 if value(high / 2) < 0 else 0.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def upper_tail(hits: int, n: int, share: float) -> float:
    """Probability of so many hits or more among ``n``."""
    if hits <= 0:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(hits + 1) - math.lgamma(n - hits + 1) + hits * math.log(share) + (n - hits) * math.log1p(-share)
    )
    total, k = term, hits
    while k < n and (term > 1e-12 * total or k < share * n):
        term *= (n - k) / (k + 1) * share / (1 - share)
        total += term
        k += 1
    return min(1.0, total)


def learn(train: DataFrame, text: str, label: str) -> Lexicon:
    """The lexicon of labelled texts: document counts per word, kept where they clearly lean to class 1."""
    distinct = train.groupBy(F.xxhash64(text).alias("h")).agg(
        F.first(text).alias("t"), (F.avg(label) >= 0.5).cast("long").alias("y")
    )
    counted = (
        distinct.select("y", F.explode(F.array_distinct(words_of(F.col("t")))).alias("w"))
        .groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    )
    counted = materialize(counted, "toxicity-words")
    totals = counted.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    n_a, n_b = totals["a"] or 0, totals["b"] or 0
    if not n_a or not n_b:
        return Lexicon({}, -1.0, 1.0)
    pseudo, share = min(PRIOR, n_a), n_a / (n_a + n_b)
    prior = pseudo * (F.col("a") + F.col("b")) / (n_a + n_b)
    a, b = F.col("a") + prior, F.col("b") + prior
    odds = F.log(a / (n_a + pseudo - a)) - F.log(b / (n_b + pseudo - b))
    error = F.sqrt(1 / a + 1 / b)

    def by_luck(hits: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([upper_tail(int(k), int(m), share) for k, m in zip(hits, n)], dtype="float64")

    luck = F.pandas_udf(by_luck, "double")(F.col("a"), F.col("n"))
    with_n = counted.withColumn("n", F.col("a") + F.col("b"))
    # one row per frequency, and a frequency is at most the number of labelled texts
    alike = with_n.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    leaning = with_n.select("w", "a", "b", "n", odds.alias("odds"), error.alias("error")).where(
        (F.col("odds") - F.col("error") > LEAST) & (F.col("a") > share * F.col("n"))
    )
    rows = leaning.join(F.broadcast(alike), "n").where(luck * F.col("words") <= CHANCE).orderBy("w").collect()
    if not rows:
        # too few texts to tell any word from luck: the words that lean most, as many as can be told apart from the rest
        top = leaning.agg(F.max("odds")).first()[0]
        rows = leaning.where(F.col("odds") >= top).orderBy("w").collect() if top is not None else []
    if not rows:
        return Lexicon({}, -1.0, 1.0)
    scores = {row["w"].encode(): row["odds"] - row["error"] for row in rows}
    listed_a, listed_b = sum(r["a"] for r in rows) / n_a, sum(r["b"] for r in rows) / n_b
    other = min(math.log((1 - listed_a) / (1 - listed_b)), -1e-3)
    values = np.array([other, *scores.values()])
    shares = np.array([1 - listed_b, *[(r["b"] + 0.5) / n_b for r in rows]])
    shares /= shares.sum()
    # the background must lose on average, or segments would grow without end
    if (values * shares).sum() >= 0:
        other = -2 * float((values[1:] * shares[1:]).sum()) / shares[0]
        values[0] = other
    return Lexicon(scores, other, decay(values, shares))


def logistic(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through counts per value of ``x``, by Newton's method with a weak prior."""
    beta, design = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    n = ones + zeros
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (ones - n * p) - 0.01 * beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


NEW_COLUMNS = ("n_words", "passages", "significance", "score")


@own_names("text")
def find_passages(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The table with ``n_words``, ``passages`` (all maximal segments as first word, words and score, in order),
    ``significance`` and ``score``."""
    kept = [c for c in df.columns if c not in NEW_COLUMNS]
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    element = pa.struct([("first", pa.int64()), ("words", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = [model.scan(x or "") for x in batch.column(batch.num_columns - 1).to_pylist()]
            passages = [[{"first": a, "words": b, "score": s} for a, b, s in found] for _, found in rows]
            tails = [model.significance(n, found) for n, found in rows]
            arrays = [
                *batch.columns[:-1], pa.array([n for n, _ in rows], type=pa.int64()),
                pa.array(passages, type=pa.list_(element)), pa.array(tails, type=pa.float64()),
                pa.array([model.score(t) for t in tails], type=pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *NEW_COLUMNS])

    rows = df.select(*kept, F.col(text).cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema][:-1]
    new = "n_words bigint, passages array<struct<first:bigint,words:bigint,score:double>>, significance double, score double"
    return rows.mapInArrow(run, ", ".join([*fields, new]))


def toxic_score(spark: SparkSession, text: Column, lexicon: Lexicon) -> Column:
    """The score alone, for rows that should not travel: only the text goes to the worker."""
    shared = spark.sparkContext.broadcast(lexicon)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in texts:
            yield pd.Series([model.score(model.significance(*model.scan(x or ""))) for x in batch], dtype="float64")

    return F.pandas_udf(run, "double")(text.cast("string"))


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", parts: int = 5,
    held_out: int = 0, sample: int = SAMPLE,
) -> Lexicon:
    """The lexicon and its calibration from labelled rows outside of the held-out fold."""
    known = labels.select(F.col(key).alias("_id"), F.col(label).alias("_label")).where(
        F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & (remainder(F.col("_id"), parts) != held_out)
    )
    # at most ``sample`` ids and labels, so the broadcast is bounded whatever the tables hold
    chosen = known.dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_words"))
    train = texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).select("_words", "_label")
    train = materialize(train, "toxicity-train")
    lexicon = learn(train, "_words", "_label")
    if not lexicon.scores:
        return lexicon
    least = min(lexicon.scores.values())
    best = F.coalesce(F.array_max(F.transform("passages", lambda p: p["score"])), F.lit(0.0))
    scanned = find_passages(train, lexicon, "_words").where(F.col("_label") == 0)
    tail = scanned.agg(F.sum("n_words").alias("n"), F.count_if(best >= least).alias("k")).first()
    lexicon.size = max(tail["k"], 1) / (max(tail["n"] or 0, 1) * math.exp(-lexicon.rate * least))
    binned = (
        find_passages(train, lexicon, "_words")
        .groupBy(F.least(F.floor(F.col("significance") / BIN), F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum("_label").alias("ones"), F.sum(1 - F.col("_label")).alias("zeros")).collect()
    )
    columns = [np.array([float(row[c]) for row in binned]) for c in ("bin", "ones", "zeros")]
    lexicon.curve = logistic(columns[0] * BIN, columns[1], columns[2])
    return lexicon


def score_toxicity(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", parts: int = 5,
    held_out: int = 0, sample: int = SAMPLE,
) -> DataFrame:
    """The table with ``held_out`` and what ``find_passages`` adds, for every row."""
    lexicon = fit(df, labels, key, text, label, parts, held_out, sample)
    folds = F.coalesce(remainder(F.col(key), parts) == held_out, F.lit(False))
    return find_passages(df.withColumn("held_out", folds), lexicon, text)


# --- the query -------------------------------------------------------------------------------------------------------


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score_toxicity(docs.select("doc_id", "text"), labels)
    return rows.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("bigint").alias("n_passages"),
    )
