"""Benchmark decontamination by spaced seeds.

Texts and benchmark items become word lists (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased). At every place
of a list each mask picks six of eight neighbouring words and hashes them; the words it skips may differ. Equal hashes of
a text and an item are a hit, and a hit is verified in the words around it: some stretch of 13 words of the item (the whole
item, if it has fewer), laid over the text at the distance the hit gives, must agree but for two words (one below 12
words, none below 9). The three masks leave no gap: every stretch with that many substitutions holds a hit of one of them,
so the result is the same as comparing all stretches (tests/llm proves it by listing all cases).

The texts are read once per block of the benchmark and nothing of them is shuffled. What is broadcast is at most ``block``
seeds, each with the hashes of the 18 words around it that a stretch can reach, some 200 bytes a seed however long its
item is (40 MB for the default); a larger benchmark makes more blocks. Items with equal words count as one, the
smallest id. Words are compared by 64-bit hashes. A hit is verified inside the join, so nothing else comes out of it.

Items below eight words have no seed of that kind. They are found word for word: one seed over all words of the item, and
in the texts one seed a place for every such length in use (``short_leaks``). A run of letters outside of ASCII is one word,
so an item in such a script is found where the whole run is the same, not inside of a longer one.

Defined results: null and empty texts have no words and no finding, and so have items without a word; an empty benchmark
finds nothing. Repeated rows get the same finding each; rows that share an id but not the text are told apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import words_of

#: Care positions; every one looks at eight words.
MASKS = ((0, 1, 2, 3, 5, 7), (0, 1, 2, 5, 6, 7), (0, 2, 3, 5, 6, 7))
SPAN = 8
STRETCH = 13
BLOCK_ROWS = 200_000


def tolerated(stretch: Column) -> Column:
    """Substitutions allowed in a stretch of so many words."""
    return F.when(stretch < 9, F.lit(0)).otherwise(F.floor(stretch / 6)).cast("int")


def with_seeds(rows: DataFrame, words: str, at: str) -> DataFrame:
    """One row per place and mask: the columns of ``rows`` but for the words, their hashes ``{at}_h``, the place ``at`` and
    ``seed``. The hashes are made once per row; places and seeds are plain expressions over them, which Spark compiles
    together with the join that follows, so the hashes are not copied for every place."""
    kept = [c for c in rows.columns if c != words]
    hashes = rows.where(F.size(words) >= SPAN).select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias(f"{at}_h"))
    placed = hashes.select("*", F.explode(F.sequence(F.lit(0), F.size(f"{at}_h") - SPAN)).alias(at))
    picked = [F.xxhash64(F.lit(m), *[F.get(f"{at}_h", F.col(at) + c) for c in mask]) for m, mask in enumerate(MASKS)]
    return placed.select("*", F.explode(F.array(*picked)).alias("seed"))


def benchmark_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, words, n): one row per distinct word list of ``SPAN`` words or more."""
    return _distinct_items(benchmark, item, text).where(F.col("n") >= SPAN)


def _distinct_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    rows = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words"))
    return (
        rows.where(F.size("words") > 0).groupBy("words").agg(F.min("item").alias("item"))
        .select("item", "words", F.size("words").alias("n"))
    )


#: Places around a hit that a stretch of ``STRETCH`` words can reach, from the first word of the seed.
REACH = range(SPAN - STRETCH, STRETCH)


def _near(at: str, distance: int) -> Column:
    """The hash of the word so far from the place of a seed; null where there is none."""
    return F.when(F.col(at) + distance >= 0, F.get(F.col(f"{at}_h"), F.col(at) + distance))


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, n, near): one row per place and mask of the items, with the hashes of the words in ``REACH``."""
    near = F.array(*[_near("item_at", d) for d in REACH])
    return with_seeds(items, "words", "item_at").select("seed", "item", "n", near.alias("near"))


def _verified() -> Column:
    """Some stretch that holds the hit agrees, the words of the item laid over those of the text.

    All places that such a stretch can reach are written out. Beyond the end of a list there is no word, which agrees with
    nothing.
    """
    agree = {
        d: F.coalesce((F.get("near", F.lit(k)) == _near("at", d)).cast("int"), F.lit(0)) for k, d in enumerate(REACH)
    }
    total = lambda places: reduce(lambda x, y: x + y, [agree[d] for d in places])
    full = F.greatest(*[total(range(s, s + STRETCH)) for s in range(SPAN - STRETCH, 1)])
    size = F.least(F.lit(STRETCH), F.col("n"))
    return F.when(F.col("n") < STRETCH, total(REACH)).otherwise(full) >= size - tolerated(size)


def leaks(
    df: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str, block: int = BLOCK_ROWS
) -> DataFrame:
    """(key, tie, item): the benchmark items of ``SPAN`` words or more found in each text; ``tie`` is a hash of the text."""
    items = benchmark_items(benchmark, item, item_text)
    # one number: how many seeds the benchmark has, which decides how many blocks keep a broadcast within its bound
    total = items.agg(F.coalesce(F.sum((F.col("n") - (SPAN - 1)) * len(MASKS)), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block))
    texts = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), words_of(F.col(text)).alias("words"))
    found = []
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        index = benchmark_seeds(mine)
        hits = with_seeds(texts, "words", "at").join(F.broadcast(index), "seed")
        # verified as an aggregate: as a filter it would move into the compiled join and make it too large to be fast
        hits = hits.groupBy("key", "tie", "item").agg(F.max(_verified()).alias("ok")).where("ok")
        found.append(hits.select("key", "tie", "item"))
    return reduce(DataFrame.unionAll, found).distinct()


def short_leaks(
    df: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str, block: int = BLOCK_ROWS
) -> DataFrame | None:
    """(key, tie, item): the benchmark items below ``SPAN`` words that a text holds word for word; None without such items."""
    items = _distinct_items(benchmark, item, item_text).where(F.col("n") < SPAN)
    # at most seven rows: how many items there are of each length
    lengths = {r["n"]: r["count"] for r in items.groupBy("n").count().collect()}
    if not lengths:
        return None
    blocks = max(1, -(-sum(lengths.values()) // block))
    hashes = F.transform("words", lambda w: F.xxhash64(w)).alias("h")
    texts = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), words_of(F.col(text)).alias("words"))
    placed = texts.select("key", "tie", hashes).where(F.size("h") > 0).select(
        "*", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at")
    )
    seed = lambda n, at: F.xxhash64(F.lit(-n), *[F.get("h", at + k) for k in range(n)])
    picked = [F.when(F.col("at") + n <= F.size("h"), seed(n, F.col("at"))) for n in sorted(lengths)]
    seeded = placed.select("*", F.explode(F.array(*picked)).alias("seed")).where(F.col("seed").isNotNull())
    first = F.coalesce(*[F.when(F.col("n") == n, seed(n, F.lit(0))) for n in sorted(lengths)])
    index = items.select("item", "n", "words", hashes).select("item", "n", "words", F.col("h").alias("item_h"), first.alias("seed"))
    found = []
    for b in range(blocks):
        mine = index.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).drop("words")
        hits = seeded.join(F.broadcast(mine), "seed")
        ok = reduce(
            lambda x, y: x & y,
            [(F.col("n") <= k) | F.coalesce(F.get("h", F.col("at") + k) == F.get("item_h", F.lit(k)), F.lit(False)) for k in range(SPAN - 1)],
        )
        hits = hits.groupBy("key", "tie", "item").agg(F.max(ok).alias("ok")).where("ok")
        found.append(hits.select("key", "tie", "item"))
    return reduce(DataFrame.unionAll, found)


def all_leaks(
    df: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str, block: int = BLOCK_ROWS
) -> DataFrame:
    """(key, tie, item): the benchmark items of any length found in each text."""
    found = leaks(df, key, text, benchmark, item, item_text, block)
    short = short_leaks(df, key, text, benchmark, item, item_text, block)
    # an item is either short or long, so nothing is found by both
    return found if short is None else found.unionAll(short)


def find_leaks(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", block: int = BLOCK_ROWS,
) -> DataFrame:
    """The key column with ``contaminated``, ``n_items`` and ``items`` (sorted ids of the items found), one row per row."""
    found = all_leaks(df, key, text, benchmark, item, item_text, block).groupBy("key", "tie").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    rows = df.select(F.col(key), F.xxhash64(text).alias("_tie"))
    joined = rows.join(found, rows[key].eqNullSafe(found["key"]) & (rows["_tie"] == found["tie"]), "left")
    n = F.coalesce(F.size("items"), F.lit(0)).cast("bigint")
    return joined.select(rows[key], (n > 0).alias("contaminated"), n.alias("n_items"), "items")


def drop_leaks(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", block: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows whose text holds no benchmark item, all columns as they are."""
    found = all_leaks(df, key, text, benchmark, item, item_text, block).select("key", "tie").distinct()
    same = df[key].eqNullSafe(found["key"]) & (F.xxhash64(df[text]) == found["tie"])
    return df.join(found, same, "left_anti")


# --- the query and its SQL ------------------------------------------------------------------------------------------


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = find_leaks(docs, benchmark)
    return rows.select(
        "doc_id", "contaminated", "n_items", F.coalesce(F.array_join("items", ","), F.lit("")).alias("items")
    )


def leaks_sql(source: str) -> str:
    """CTEs that end in ``leaks`` (doc_id, item). Seeds are care words put together; stretches are compared word by word."""
    cares = "\n  UNION ALL ".join(
        f"SELECT r, i, {m} AS m, " + " || ' ' || ".join(f"w{c}" for c in mask) + " AS seed FROM {0} WHERE w7 IS NOT NULL"
        for m, mask in enumerate(MASKS)
    )
    leads = ", ".join(f"lead(w, {c}) OVER v AS w{c}" for c in range(SPAN))
    return f"""dk AS (
  SELECT doc_id AS r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {source})),
items AS (
  SELECT min(item_id) AS item, ws, len(ws) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark)
  WHERE len(ws) >= {SPAN} GROUP BY ws),
ik AS (SELECT item AS r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM items),
de AS (SELECT r, i, {leads} FROM dk WINDOW v AS (PARTITION BY r ORDER BY i)),
ie AS (SELECT r, i, {leads} FROM ik WINDOW v AS (PARTITION BY r ORDER BY i)),
ds AS ({cares.replace('{0}', 'de')}),
iss AS ({cares.replace('{0}', 'ie')}),
hits AS (SELECT DISTINCT ds.r AS doc_id, iss.r AS item, ds.i - iss.i AS shift FROM ds JOIN iss USING (m, seed)),
laid AS (
  SELECT h.doc_id, h.item, h.shift, ik.i, n, (coalesce(dk.w = ik.w, false))::INT AS same
  FROM hits h JOIN items USING (item) JOIN ik ON ik.r = h.item LEFT JOIN dk ON dk.r = h.doc_id AND dk.i = ik.i + h.shift),
stretches AS (
  SELECT doc_id, item, least({STRETCH}, n) AS size, i, n,
         sum(same) OVER (PARTITION BY doc_id, item, shift ORDER BY i ROWS BETWEEN {STRETCH - 1} PRECEDING AND CURRENT ROW) AS agreed
  FROM laid),
leaks AS (
  SELECT DISTINCT doc_id, item FROM stretches
  WHERE i >= size AND agreed >= size - CASE WHEN size < 9 THEN 0 ELSE size // 6 END)"""


def sql() -> str:
    return f"""
WITH {leaks_sql('documents')}
SELECT d.doc_id, count(item) > 0 AS contaminated, count(item) AS n_items, coalesce(string_agg(item, ',' ORDER BY item), '') AS items
FROM documents d LEFT JOIN leaks USING (doc_id) GROUP BY d.doc_id"""
