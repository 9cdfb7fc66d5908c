"""Quality classifier: a regularised quadratic discriminant over transformed statistics of a text.

Each text gives a dozen statistics (lengths, shares of characters, repetition), brought near a bell shape by logarithms
and odds. Each class has a mean and a covariance, shrunk first towards the pooled covariance and then towards its
diagonal, which keeps it well conditioned with few labels. The score is the posterior of class 1: the difference of the
Gaussian log densities, whose Mahalanobis terms come from Cholesky factors that are made once and sent to the tasks.

Counts, sums and sums of products per class are all the fit needs. Spark adds them up over every labelled row outside of
the held-out fold, so nothing is sampled and two rows reach the driver. The statistics are computed once per text and
written to the shared folder: the join with the labels and the scoring read that narrow table, not the texts.

Defined results: null, empty and blank texts have all-zero statistics and a score like any other text. Repeated rows score
alike. A label of a document that is missing twice over is used once per row. With no labels, or one class only, every
score is the share of class 1 (one half without any label).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import remainder
from voxloom.session import materialize

STATISTICS = (
    "words", "mean_word", "distinct", "adjacent", "top_word", "symbols", "bars", "shouts", "upper", "digits", "stops",
    "line_words", "dup_lines", "blanks",
)
#: Weight of the pooled covariance and of the diagonal, and the least variance of a statistic.
POOLED, DIAGONAL, FLOOR = 0.1, 0.05, 1e-3
SYMBOLS = "#*$%&<>{}[]^~=+_@\\"


def _share(part: float, whole: float) -> float:
    """Square root of a share, which spreads the small ones."""
    return math.sqrt(part / whole) if whole else 0.0


def statistics(text: str) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    chars = sum(map(len, words))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    upper = sum(map(str.isupper, words))
    return (
        math.log1p(n),
        math.log(chars / n),
        # the share of distinct words falls with length; its logarithm by that of the length does so less
        math.log1p(len(counts)) / math.log1p(n),
        _share(sum(map(str.__eq__, words, words[1:])), n),
        _share(max(counts.values()), n) if n > 1 else 0.0,
        _share(sum(map(text.count, SYMBOLS)), chars),
        _share(text.count("|"), n),
        _share(text.count("!"), n),
        _share(upper, n),
        _share(sum(map(text.count, "0123456789")), chars),
        _share(text.count(".") + text.count(",") + text.count("?"), n),
        math.log1p(n / len(lines)),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(len(text) - chars, len(text)),
    )


def with_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, one double per statistic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x or "") for x in batch.column(1).to_pylist()]
            values = np.array(rows, dtype=np.float64).reshape(len(rows), len(STATISTICS))
            arrays = [batch.column(0), *[pa.array(values[:, k]) for k in range(len(STATISTICS))]]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *STATISTICS])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return df.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


class Discriminant:
    """Means, Cholesky factors of the shrunk covariances (inverted once) and log odds of the classes."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        """``moments`` has (count, sums, sums of products) per class."""
        total = sum(n for n, _, _ in moments.values())
        self.share = moments[1][0] / total if total and 1 in moments else 0.5 if not total else 0.0
        self.fitted = all(c in moments and moments[c][0] >= 2 for c in (0, 1))
        if not self.fitted:
            return
        means = {c: s / n for c, (n, s, _) in moments.items()}
        spread = {c: q / n - np.outer(means[c], means[c]) for c, (n, _, q) in moments.items()}
        pooled = sum(moments[c][0] * spread[c] for c in (0, 1)) / total
        self.means, self.inverse, self.constant = {}, {}, {}
        for c in (0, 1):
            cov = (1 - POOLED) * spread[c] + POOLED * pooled
            cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + FLOOR * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            self.means[c] = means[c]
            self.inverse[c] = np.linalg.inv(factor)
            self.constant[c] = math.log(moments[c][0] / total) - np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        density = {}
        for c in (0, 1):
            z = (x - self.means[c]) @ self.inverse[c].T
            density[c] = self.constant[c] - 0.5 * (z * z).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -700, 700)))


def fit(rows: DataFrame, label: str) -> Discriminant:
    """The discriminant of rows with the statistics and a 0/1 label; other labels are left out. One row per class."""
    pairs = [(i, j) for i in range(len(STATISTICS)) for j in range(i, len(STATISTICS))]
    found = (
        rows.where(F.col(label).isin(0, 1))
        .groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(s) for s in STATISTICS]).alias("s"),
            F.array(*[F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i, j in pairs]).alias("q"),
        )
        .collect()
    )
    moments = {}
    for row in found:
        q = np.zeros((len(STATISTICS), len(STATISTICS)))
        for (i, j), value in zip(pairs, row["q"]):
            q[i, j] = q[j, i] = value
        moments[int(row[label])] = (float(row["n"]), np.array(row["s"]), q)
    return Discriminant(moments)


def score_quality(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", parts: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """(key, held_out, score, statistics): the posterior of class 1 for every row, learnt outside of the held-out fold."""
    table = materialize(with_statistics(df, key, text), "quality")
    # a null id is in no fold; nothing is learnt from it
    fold = F.coalesce(remainder(F.col(key), parts) == held_out, F.lit(False))
    known = labels.select(key, label).where(F.col(label).isNotNull())
    model = fit(table.where(~fold).join(known, key), label)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(1 + k).to_numpy() for k in range(len(STATISTICS))])
            score = shared.value.score(x.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", score double"
    return table.mapInArrow(run, schema).select(key, fold.alias("held_out"), "score", *STATISTICS)


# --- the query -------------------------------------------------------------------------------------------------------


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score_quality(docs.select("doc_id", "text"), labels)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
