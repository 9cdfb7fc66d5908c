"""Centroid clustering of integer vectors in column expressions.

A vector's components become integers, floor(``scale`` x), so every distance, sum and mean is exact and no order of rows or
partitions changes a result. The centroids travel in the plan as literal arrays: ``zip_with`` and ``aggregate`` give the
scalar product of a vector with each of them, |v|^2 - 2 v.c + |c|^2 its squared distance, and ``array_min`` over
(distance, cluster) structs chooses the nearest, the smaller number on ties. A round is one pass with one generated sum per
component, grouped by cluster and combined before its shuffle, so ``k`` rows come back to the driver whatever the
table holds, and a vector that a third of the rows repeat is no hot key. The last assignment is written once, narrow, and
its sums are joined on as ``k`` broadcast rows.

Defined results: a vector of another length, with a null component, a NaN or an infinity, or that is null, is left out.
Components beyond +-2^27 after scaling count as +-2^27, so that every distance fits a long; a sum that does not is null. Rows
with the same key and equal vectors are rows of their own; a null key is kept but never starts a centroid before keys that
are not null. With fewer than ``k`` vectors there are fewer centroids, without vectors no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.session import materialize

#: Largest component after scaling: 64 squared differences of twice this still fit a long.
LARGEST = 1 << 27


def is_whole(vector: Column, size: int) -> Column:
    """Exactly ``size`` components, none null or non-finite; by array functions that need no lambda."""
    endless = F.lit(float("inf"))
    wide = vector.cast("array<double>")
    # a search that finds nothing is false only where no component is null
    none_null = F.coalesce(~F.array_contains(wide, endless), F.lit(False))
    # NaN counts as greater than infinity
    return (F.size(vector) == size) & none_null & (F.array_max(wide) < endless) & (F.array_min(wide) > -endless)


def quantised(vector: Column, scale: int) -> Column:
    bounded = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    return F.transform(vector, lambda x: F.floor(bounded(x)))


def _long_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _literals(centroids: Sequence[Sequence[int]]) -> Column:
    """The centroids as one literal array of (c, norm, cluster); as SQL text, because thousands of literal columns are slow to
    make."""
    rows = []
    for number, centroid in enumerate(centroids):
        values = ", ".join(f"{c}L" for c in centroid)
        rows.append(f"named_struct('c', array({values}), 'norm', {sum(c * c for c in centroid)}L, 'cluster', {number})")
    return F.expr(f"array({', '.join(rows)})")


def nearest(vector: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; ``vector`` should be a column, it is read once per centroid."""
    own = _long_sum(F.transform(vector, lambda x: x * x))

    def option(centroid: Column) -> Column:
        product = _long_sum(F.zip_with(vector, centroid["c"], lambda x, c: x * c))
        # |v|^2 is the same for all, so it is added to the winner only
        return F.struct((centroid["norm"] - product * 2).alias("rest"), centroid["cluster"].alias("cluster"))

    best = F.array_min(F.transform(_literals(centroids), option))
    return F.struct((own + best["rest"]).alias("distance"), best["cluster"].alias("cluster"))


def starting(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the ``k`` smallest SHA-256 digests of ``seed:key``; at most ``k`` rows come back."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    chosen = rows.select(digest.alias("digest"), "v").orderBy(F.asc_nulls_last("digest"), "v").limit(k).collect()
    return [list(row["v"]) for row in chosen]


def fit(rows: DataFrame, size: int, k: int, rounds: int, seed: int) -> list[list[int]]:
    """Centroids of a table (key, v) of integer vectors after so many rounds."""
    centroids = starting(rows, k, seed)
    if not centroids:
        return []
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(size)]
    for _ in range(rounds):
        found = rows.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
        for row in found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            centroids[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    return centroids


def _fitting(value: int | None) -> int | None:
    return value if value is not None and value < 1 << 63 else None


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, k: int = 16, rounds: int = 3,
    scale: int = 64, seed: int = 1,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid): one row per vector that is whole."""
    spark: SparkSession = df.sparkSession
    narrow = df.select(F.col(key).alias("key"), F.col(vector).alias("x")).where(is_whole(F.col("x"), size))
    rows = narrow.select("key", quantised(F.col("x"), scale).alias("v"))
    centroids = fit(rows, size, k, rounds, seed)
    summary = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not centroids:
        assigned = rows.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        known = spark.createDataFrame([], summary)
    else:
        found = rows.select("key", nearest(F.col("v"), centroids).alias("n"))
        assigned = materialize(found.select("key", "n.cluster", "n.distance"), "clusters")
        # one row per cluster
        sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
        own = {row["cluster"]: int(row["s"]) for row in sums}
        total = _fitting(sum(own.values()))
        known = spark.createDataFrame([(c, _fitting(own.get(c, 0)), total, v) for c, v in enumerate(centroids)], summary)
    return assigned.join(F.broadcast(known), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


# --- the query and its SQL ------------------------------------------------------------------------------------------


def query(embeddings: DataFrame) -> DataFrame:
    rows = cluster(embeddings)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _assigned_sql(number: int) -> str:
    return f"""a{number} AS (
  SELECT r, vec_id, q, min({{'d': d, 'k': k}}) AS m FROM (
    SELECT v.*, c.k, CAST(list_sum(list_transform(list_zip(q, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, c{number} c) GROUP BY ALL)"""


def sql(k: int = 16, rounds: int = 3) -> str:
    parts = [
        """v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS INT) AS k, q AS c FROM v
  ORDER BY sha256('1:' || vec_id), q LIMIT {k})""",
    ]
    for i in range(rounds):
        parts.append(_assigned_sql(i))
        parts.append(f"""m{i} AS (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT k, i, sum(x) AS s, count(*) AS n
    FROM (SELECT m.k AS k, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{i}) GROUP BY k, i) GROUP BY k),
c{i + 1} AS (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} m USING (k))""")
    parts.append(_assigned_sql(rounds))
    return f"""WITH {', '.join(parts)}
SELECT vec_id, m.k AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.m.k"""
