"""Joins: code maps, supported lists, sample <-> chunk, listings, detector grids, dictionary splits.

Only tables of a fixed size (code maps, language lists) are broadcast by hint. Everything that grows with the data is
left to AQE, which broadcasts by measured size and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.constants import CORPUS_CODES, NO_LANGUAGE, RECOGNITION_LANGUAGES, WHITESPACE_CLASS
from voxloom.functions.text import clean_token
from voxloom.operators.tries import Trie, prefix_lengths


def code_table(spark: SparkSession, codes: Mapping[str, str], code: str = "code", name: str = "language") -> DataFrame:
    """A literal table of a code map, held in the plan itself."""
    rows = F.array(*[F.struct(F.lit(k).alias(code), F.lit(v).alias(name)) for k, v in codes.items()])
    return spark.range(1).select(F.inline(rows))


def name_table(spark: SparkSession, names: Sequence[str], name: str = "language") -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(name))


def map_language_code(
    df: DataFrame, code: str, name: str = "language", codes: Mapping[str, str] = CORPUS_CODES
) -> DataFrame:
    """Code to language name; an unknown code gives the no-language name. The map has a handful of rows."""
    table = F.broadcast(code_table(df.sparkSession, codes, "_code", "_name"))
    return (
        df.join(table, F.col(code) == F.col("_code"), "left")
        .withColumn(name, F.coalesce("_name", F.lit(NO_LANGUAGE)))
        .drop("_code", "_name")
    )


def unsupported_languages(
    df: DataFrame, name: str, supported: Sequence[str] = RECOGNITION_LANGUAGES, strict: bool = False
) -> DataFrame:
    """Rows whose language is not in the list; in strict mode the first such row fails the job."""
    table = F.broadcast(name_table(df.sparkSession, supported, "_name"))
    bad = df.join(table, F.col(name) == F.col("_name"), "left_anti")
    if strict:
        bad = bad.withColumn(name, F.raise_error(F.concat(F.lit("unsupported language: "), F.col(name))))
    return bad


def scatter_to_chunks(chunks: DataFrame, samples: DataFrame, sample: str) -> DataFrame:
    """Per-sample arguments onto every chunk of the sample."""
    return chunks.join(samples, sample)


def gather_results(chunks: DataFrame, results: DataFrame, sample: str, chunk: str) -> DataFrame:
    """Results back to the chunks; chunks that were skipped keep nulls."""
    return chunks.join(results, [sample, chunk], "left")


def broadcast_argument(df: DataFrame, args: DataFrame, value: str, position: str) -> DataFrame:
    """A batch argument for each row: one value applies to all rows, otherwise each row must have its own.

    ``args`` has (position, value), or the value alone, which must then be one row and is joined to nothing. A row without
    an argument or an argument without a row fails the job; nothing is counted before it runs.
    """
    if position not in args.columns:
        return df.withColumn(value, args.select(value).scalar())
    single = args.agg(F.count(F.lit(1)) == 1).scalar()
    only = args.agg(F.first(value)).scalar()
    given = args.select(F.col(position).alias("_position"), F.col(value).alias("_given_value"), F.lit(True).alias("_given"))
    both = df.withColumn("_row", F.lit(True)).join(given, F.col(position).eqNullSafe(F.col("_position")), "full")
    problem = F.raise_error(
        F.when(F.col("_row").isNull(), F.lit(f"batch size mismatch: {value} without a row")).otherwise(
            F.lit(f"batch size mismatch: row without {value}")
        )
    ).cast("boolean")
    whole = F.when(F.col("_row") & (F.col("_given") | single), True).when(F.col("_row").isNull() & single, False)
    checked = both.where(whole.otherwise(problem))
    return checked.withColumn(value, F.when(single, only).otherwise(F.col("_given_value"))).select(*df.columns, value)


def missing_from_listing(df: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    return df.join(listing, key, "left_anti")


def missing_in_sample(sample: DataFrame, listing: DataFrame, key: str, order: str, examples: int = 5) -> DataFrame:
    """Check a bounded sample against a large listing: sampled, missing, and the first few missing keys in order.

    The sample has a fixed row limit, so it is the side that is broadcast; the listing is only streamed past it.
    """
    found = listing.select(key).join(F.broadcast(sample.select(key)), key, "left_semi").distinct()
    checked = sample.join(found.withColumn("_found", F.lit(True)), key, "left")
    gone = F.array_sort(F.collect_list(F.when(F.col("_found").isNull(), F.struct(order, key))))
    shown = F.transform(F.slice(gone, 1, examples), lambda s: s[key].cast("string"))
    return checked.agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(F.col("_found").isNull()).alias("missing"),
        F.array_join(shown, ",").alias("examples"),
    )


def detector_grid(df: DataFrame, detectors: Mapping[str, Column], expected: DataFrame, language: str) -> DataFrame:
    """One row per text and detector with the predicted and the expected code.

    ``detectors`` maps a name to its prediction column, so a row is unfolded in place and nothing is multiplied by a
    join. ``expected`` (detector, language, expected_code) is fixed in size; a pair it lacks is not supported and is
    skipped, not counted as wrong.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("detector"), c.alias("predicted")) for n, c in detectors.items()])
    unfolded = df.withColumn("_cell", F.explode(cells)).select("*", "_cell.*").drop("_cell")
    return unfolded.join(F.broadcast(expected), ["detector", language]).where(F.col("expected_code").isNotNull())


#: A dictionary of at most so many bytes is shipped to the workers.
SHIPPED_BYTES = 64 << 20


def dictionary_left_split(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, word: str = "word", shipped_bytes: int = SHIPPED_BYTES
) -> DataFrame:
    """(key, at, left, right) per word: the longest dictionary prefix and the rest, both cleaned.

    The dictionary's bytes are measured first. Up to ``shipped_bytes`` it becomes a trie that goes to the workers, and no word
    row is shuffled; a larger one is joined with the distinct words of the table. A word without a known prefix stays whole.
    """
    entries = dictionary.select(F.col(word).alias("_prefix")).where(F.col(word).isNotNull()).distinct()
    if (entries.agg(F.sum(F.octet_length("_prefix"))).first()[0] or 0) <= shipped_bytes:
        trie = Trie(row[0] for row in entries.collect())
        return _shipped_left_split(df, key, text, trie)
    return _joined_left_split(df, key, text, entries)


def _shipped_left_split(df: DataFrame, key: str, text: str, trie: Trie) -> DataFrame:
    find = prefix_lengths(df.sparkSession, trie)
    words = F.split(F.col(text), f"[{WHITESPACE_CLASS}]+")
    found = df.select(key, words.alias("_words")).withColumn("_sizes", find("_words"))
    each = found.select(key, F.posexplode(F.arrays_zip("_words", "_sizes")).alias("at", "_w"))
    whole, size = F.col("_w._words"), F.col("_w._sizes")
    return each.where(whole != "").select(
        key, "at",
        clean_token(F.when(size > 0, F.substr(whole, F.lit(1), size)).otherwise(whole)).alias("left"),
        F.when(size > 0, clean_token(F.substr(whole, size + 1))).otherwise(F.lit("")).alias("right"),
    )


def _joined_left_split(df: DataFrame, key: str, text: str, entries: DataFrame) -> DataFrame:
    """Words are split and cleaned once per distinct word, with prefixes never longer than the longest entry, so neither a
    frequent word nor a very long one multiplies the work."""
    words = df.select(
        key, F.posexplode(F.split(F.col(text), f"[{WHITESPACE_CLASS}]+")).alias("at", "_word")
    ).where(F.col("_word") != "")
    vocabulary = words.select("_word").distinct()
    longest = entries.agg(F.coalesce(F.max(F.length("_prefix")), F.lit(0)).alias("n")).scalar()
    ends = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length("_word"), longest)))
    prefixes = vocabulary.select("_word", F.explode(ends).alias("_n")).withColumn(
        "_prefix", F.substr("_word", F.lit(1), F.col("_n"))
    )
    best = prefixes.join(entries, "_prefix", "left_semi").groupBy("_word").agg(F.max("_n").alias("_n"))
    splits = best.select(
        "_word",
        clean_token(F.substr("_word", F.lit(1), F.col("_n"))).alias("left"),
        clean_token(F.substr("_word", F.col("_n") + 1)).alias("right"),
    )
    return words.join(splits, "_word", "left").select(
        key, "at",
        F.coalesce("left", clean_token(F.col("_word"))).alias("left"),
        F.coalesce("right", F.lit("")).alias("right"),
    )


def slice_span_rows(
    samples: DataFrame, spans: DataFrame, key: str, pos: str, value: str, span: str, start: Column, end: Column, sr: int,
    block: int = 65536, name: str = "wav",
) -> DataFrame:
    """(key, span, n, ``name``): the samples ``[int(start * sr), int(end * sr))`` of each span, for signals stored as one row per
    sample. Spans without times, reversed ones and those that meet no sample give no row.

    An interval join by equality: a span is cut at the borders of blocks of positions, so its parts meet the samples of their
    own block only. A long signal and a long span are spread over their blocks; the parts of a span come together in
    block order at the end.
    """
    first, last = F.greatest(F.lit(0), (start * sr).cast("int")), (end * sr).cast("int")
    whole = spans.where(start.isNotNull() & end.isNotNull() & (end > start)).select(key, span, first.alias("_a"), last.alias("_b"))
    cut = whole.where(F.col("_b") > F.col("_a")).select(
        key, span, "_a", "_b", F.explode(F.sequence(F.floor(F.col("_a") / block), F.floor((F.col("_b") - 1) / block))).alias("_block")
    )
    placed = samples.select(F.col(key), F.col(pos).alias("_pos"), F.col(value).alias("_x"), F.floor(F.col(pos) / block).alias("_block"))
    met = cut.join(placed, [key, "_block"]).where((F.col("_pos") >= F.col("_a")) & (F.col("_pos") < F.col("_b")))
    parts = met.groupBy(key, span, "_block").agg(F.array_sort(F.collect_list(F.struct("_pos", "_x"))).alias("_part"))
    joined = parts.groupBy(key, span).agg(F.array_sort(F.collect_list(F.struct("_block", "_part"))).alias("_parts"))
    flat = F.flatten(F.transform("_parts", lambda p: F.transform(p["_part"], lambda x: x["_x"])))
    return joined.select(key, span, flat.alias(name)).select(key, span, F.size(name).alias("n"), name)
