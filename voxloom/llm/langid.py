"""Language identification with interpolated Kneser-Ney character models.

Texts become lower-case letters with one blank between words. For every language the four-character counts of all its
training texts are added up; the shorter orders follow from them, as Kneser-Ney counts how many different characters
stand before a sequence and not how often it occurs. Each order is interpolated with the next shorter one, down to the
uniform distribution. A model is a sorted array of sequence hashes with one log probability per language beside
it, and a context array with the back-off weights. A text gets the language with the lowest cross-entropy per character.

Counting: every task counts its own partition in sorted arrays, Spark adds the partial counts per language and sequence,
and derives the shorter orders from the result. Four characters of 16 bits are a 64-bit key, and the hash is a permutation
of these keys, so no two sequences share a slot. No row is left out of the counts, and what is gathered grows with the
input.

Scoring: a model of at most ``cells`` values (distinct sequences times languages) is sent to the tasks, and scoring is one
pass without a shuffle, one search in a sorted array per character. A larger model stays a Spark table: the sequences of
each text are added up in the pass, their probabilities are made by joins, order by order, and the products are summed
per text. Both give the same numbers.

Rejection: a prediction is ``accepted`` if its cross-entropy is at most ``WIDTH`` standard deviations above the mean of its
language. Both come from an eighth of the training texts (by a hash of the key) that the counts leave out; the deviation is
that of the language or, if larger, that of all languages about their own means. A language that only that eighth holds
is learnt from it, and a language without such texts rejects nothing. The prediction itself stays.

Defined results: a null text and one without a letter give ``und``, score 0 and no cross-entropy. Ties go to the first
language by name. Without training rows every text is ``und``. Texts of more than ``PIECE`` characters are read in pieces
that hand on the characters before them, which changes no result. Repeated rows are counted and scored each. Letters
outside of the first plane are told apart by their low 16 bits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import remainder
from voxloom.session import materialize

ORDER = 4
#: Most values of a model that is sent to the tasks: distinct sequences times languages.
SHARED_CELLS = 8_000_000
#: One of so many training texts is left out of the counts, for the calibration.
CALIBRATION = 8
#: Characters handled at once, and the longest piece of a text.
CHUNK = 1_000_000
PIECE = 4_000_000
WIDTH = 4.0
#: Least and largest discount of a count.
DISCOUNTS = (0.1, 0.9)
UNKNOWN = "und"
BLANK = 32
#: Odd multiplier of a multiplicative hash (2^64 divided by the golden ratio).
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _alphabet() -> np.ndarray:
    """Lower-case form of every character of the first plane, blank for what is no letter."""
    out = np.full(1 << 16, BLANK, dtype=np.uint64)
    for code in range(1 << 16):
        low = chr(code).lower()
        if chr(code).isalpha():
            out[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    return out


class Letters:
    """Sequences of letters of many texts at once."""

    def __init__(self):
        self._table = _alphabet()

    def _codes(self, raw: np.ndarray) -> np.ndarray:
        codes = self._table[np.minimum(raw, 0xFFFF)]
        above = np.flatnonzero(raw > 0xFFFF)
        for k in above:
            # other planes: letters keep their low 16 bits, the rest is blank
            codes[k] = int(raw[k]) & 0xFFFF if unicodedata.category(chr(raw[k]))[0] == "L" else BLANK
        return codes

    def sequences(self, texts: list[str], before: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The four characters up to each character, packed in 64 bits, and how many of them each text has. ``before`` is
        what stands before each text and counts as context only."""
        if before and any(before):
            keys, sizes = self.sequences([b + t for b, t in zip(before, texts)])
            skipped = self.sequences(before)[1]
            place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            return keys[place >= np.repeat(skipped, sizes)], sizes - skipped
        raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        codes = self._codes(raw)
        blank = codes == BLANK
        first = np.ones(len(codes), dtype=bool)
        first[1:] = owner[1:] != owner[:-1]
        keep = ~blank
        keep[1:] |= ~blank[:-1] & ~first[1:]
        codes, owner = codes[keep], owner[keep]
        sizes = np.bincount(owner, minlength=len(texts))
        place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = codes.copy()
        for k in range(1, ORDER):
            earlier = np.full(len(codes), BLANK, dtype=np.uint64)
            if k < len(codes):
                earlier[k:] = np.where(place[k:] >= k, codes[:-k], np.uint64(BLANK))
            keys |= earlier << np.uint64(16 * k)
        return keys, sizes


def _context(text: str, at: int) -> str:
    """What stands before a place, back to the third letter: all that the sequences after it depend on."""
    start, letters = at, 0
    while start and letters < ORDER - 1:
        start -= 1
        letters += text[start].isalpha()
    return text[start:at]


def _pieces(rows: Iterable[tuple[int, str]]) -> Iterator[tuple[list[int], list[str], list[str]]]:
    """Texts in groups of about ``CHUNK`` characters, with their numbers and what stands before them."""
    numbers: list[int] = []
    texts: list[str] = []
    before: list[str] = []
    size = 0
    for number, text in rows:
        for at in range(0, max(len(text), 1), PIECE):
            numbers.append(number)
            texts.append(text[at : at + PIECE])
            before.append(_context(text, at))
            size += len(texts[-1])
            if size >= CHUNK:
                yield numbers, texts, before
                numbers, texts, before, size = [], [], [], 0
    if numbers:
        yield numbers, texts, before


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted array of keys with the sums of their counts."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[starts], np.add.reduceat(n, starts)


def count_sequences(df: DataFrame, text: str, lang: str, aside: Column) -> DataFrame:
    """(lang, aside, seq, n): how often each sequence of four characters occurs in the texts of a language, those set
    ``aside`` and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        held: dict[tuple[str, bool], tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def rows(name: tuple[str, bool]) -> pa.RecordBatch:
            keys, counts = _added(*held.pop(name))
            columns = [
                pa.array([name[0]] * len(keys)), pa.array([name[1]] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)
            ]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "aside", "seq", "n"])

        for batch in batches:
            by_name: dict[tuple[str, bool], list[tuple[int, str]]] = {}
            for name, apart, value in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                by_name.setdefault((name, apart), []).append((0, value))
            for name, values in by_name.items():
                for _, texts, before in _pieces(values):
                    keys = np.sort(letters.sequences(texts, before)[0])
                    if not len(keys):
                        continue
                    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                    both = held.setdefault(name, ([], []))
                    both[0].append(keys[starts])
                    both[1].append(np.diff(np.append(starts, len(keys))))
                    if sum(map(len, both[0])) > 2_000_000:
                        added = _added(*both)
                        held[name] = ([added[0]], [added[1]])
                        if len(added[0]) > 1_000_000:
                            yield rows(name)
        for name in list(held):
            yield rows(name)

    partial = df.select(F.col(lang).alias("lang"), aside.alias("aside"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counted = partial.mapInArrow(run, "lang string, aside boolean, seq bigint, n bigint")
    return counted.groupBy("lang", "aside", "seq").agg(F.sum("n").alias("n"))


def hashed(keys: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers: keys that differ have hashes that differ."""
    with np.errstate(over="ignore"):
        return (keys ^ (keys >> np.uint64(29))) * MULTIPLIER


class Table:
    """A sorted array of hashes with one row of values per language beside it."""

    def __init__(self, keys: np.ndarray, languages: np.ndarray, values: np.ndarray, n_languages: int):
        self.slots, firsts, rows = np.unique(hashed(keys), return_index=True, return_inverse=True)
        self.keys = keys[firsts]
        self.values = np.zeros((n_languages, len(self.slots)))
        self.values[languages, rows] = values

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys and whether they are held."""
        if not len(self.slots):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        wanted = hashed(keys)
        at = np.minimum(np.searchsorted(self.slots, wanted), len(self.slots) - 1)
        return at, self.slots[at] == wanted


class Model:
    """Log probabilities of all sequences of one to four characters, per language, with back-off weights."""

    def __init__(self, languages: list[str], counts: list[tuple], contexts: list[tuple]):
        """``counts[k]`` has (keys, languages, counts) of order k + 1; ``contexts[k]`` has the (keys, languages, totals,
        kinds) of the contexts of order k + 1."""
        n = len(languages)
        self.languages, self.orders, self.weights = languages, [], []
        if not languages:
            return
        for k, (keys, langs, values) in enumerate(counts):
            table = Table(keys, langs, values, n)
            context_keys, context_langs, totals, kinds = contexts[k]
            total = Table(context_keys, context_langs, totals, n)
            kind = Table(context_keys, context_langs, kinds, n)
            once = (np.round(table.values) == 1).sum(axis=1)
            twice = (np.round(table.values) == 2).sum(axis=1)
            discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)[:, None]
            discount = np.clip(discount, *DISCOUNTS)
            at, held = total.find(table.keys >> np.uint64(16))
            known = total.values[:, at] * held
            weight = discount * kind.values[:, at] * held
            below = self._below(table.keys, k, n)
            probability = np.where(
                known > 0, (np.maximum(table.values - discount, 0) + weight * below) / np.maximum(known, 1), below
            )
            backoff = np.where(total.values > 0, discount * kind.values / np.maximum(total.values, 1), 1.0)
            table.values = np.log(probability).astype(np.float32)
            total.values = np.log(np.maximum(backoff, 1e-12)).astype(np.float32)
            # keys are hashes from here on
            table.keys = total.keys = None
            self.orders.append(table)
            self.weights.append(total)

    def _below(self, keys: np.ndarray, k: int, n: int) -> np.ndarray:
        """Probabilities of the order below for the last characters of sequences."""
        if k == 0:
            return np.full((n, len(keys)), 1.0 / (1 << 16))
        short = keys & np.uint64((1 << 16 * k) - 1)
        return np.exp(np.vstack([self.log_probability(short, language, k) for language in range(n)]).astype(np.float64))

    def log_probability(self, keys: np.ndarray, language: int, order: int = ORDER, found=None) -> np.ndarray:
        """Log probability of the last character of each sequence after the others."""
        table = self.orders[order - 1]
        at, held = found if found is not None else table.find(keys)
        out = table.values[language, at] if len(table.slots) else np.zeros(len(keys), dtype=np.float32)
        lost = np.flatnonzero(~held)
        if len(lost):
            rest = keys[lost]
            weights = self.weights[order - 1]
            where, known = weights.find(rest >> np.uint64(16))
            weight = np.where(known, weights.values[language, where] if len(weights.slots) else 0.0, 0.0)
            if order == 1:
                below = np.full(len(lost), -16 * np.log(2.0))
            else:
                below = self.log_probability(rest & np.uint64((1 << 16 * (order - 1)) - 1), language, order - 1)
            out = out.copy()
            out[lost] = weight + below
        return out

    def entropies(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Summed negative log probability per text and language."""
        out = np.zeros((len(sizes), len(self.languages)))
        full = np.flatnonzero(sizes)
        if len(full) and self.languages:
            starts = (np.cumsum(sizes) - sizes)[full]
            found = self.orders[-1].find(keys)
            for language in range(len(self.languages)):
                values = self.log_probability(keys, language, ORDER, found)
                out[full, language] = -np.add.reduceat(values.astype(np.float64), starts)
        return out


class Counts:
    """The counts of all orders as Spark tables, and the languages in them."""

    def __init__(self, df: DataFrame, text: str, lang: str, aside: Column):
        counted = materialize(count_sequences(df, text, lang, aside), "langid")
        # one row per language
        found = counted.groupBy("lang").agg(F.bool_and("aside").alias("only_aside")).collect()
        #: languages that no text but those set aside holds
        self.only_aside = sorted(r["lang"] for r in found if r["only_aside"])
        self.languages = sorted(r["lang"] for r in found)
        rows = counted.where(~F.col("aside") | F.col("lang").isin(self.only_aside)) if self.only_aside else counted.where(~F.col("aside"))
        self.orders = [rows.select("lang", "seq", "n")]
        for order in range(ORDER - 1, 0, -1):
            short = F.col("seq").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("seq")
            # how many different characters stand before the sequence
            self.orders.insert(0, self.orders[0].groupBy("lang", short).agg(F.count(F.lit(1)).alias("n")))
        self.contexts = [
            rows.groupBy("lang", F.shiftrightunsigned("seq", 16).alias("seq")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
            )
            for rows in self.orders
        ]

    def cells(self) -> int:
        """Values of the largest array of the model."""
        return self.orders[-1].select("seq").distinct().count() * len(self.languages)

    def model(self) -> Model:
        """The model in sorted arrays; ``cells`` bounds its size."""
        number = {name: k for k, name in enumerate(self.languages)}

        def gathered(frame: DataFrame, *values: str) -> tuple[np.ndarray, ...]:
            rows = frame.select("lang", "seq", *values).toArrow()
            coded = rows.column("lang").combine_chunks().dictionary_encode()
            names = np.array([number[x] for x in coded.dictionary.to_pylist()], dtype=np.int64)
            keys = rows.column("seq").to_numpy().astype(np.int64).view(np.uint64)
            langs = names[coded.indices.to_numpy()] if len(keys) else np.zeros(0, dtype=np.int64)
            return keys, langs, *[rows.column(v).to_numpy().astype(np.float64) for v in values]

        return Model(
            self.languages, [gathered(f, "n") for f in self.orders], [gathered(f, "total", "kinds") for f in self.contexts]
        )

    def probabilities(self, wanted: DataFrame, order: int = ORDER) -> DataFrame:
        """(lang, seq, p) for every wanted (lang, seq): the probability of the last character after the others."""
        counts, contexts = self.orders[order - 1], self.contexts[order - 1]
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        share = F.when(once > 0, once / (once + 2 * twice)).otherwise(0.5)
        # one row per language
        discounts = counts.groupBy("lang").agg(F.greatest(F.lit(DISCOUNTS[0]), F.least(F.lit(DISCOUNTS[1]), share)).alias("discount"))
        rows = wanted.select(
            "lang", "seq", F.shiftrightunsigned("seq", 16).alias("before"),
            F.col("seq").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)).alias("short"),
        )
        rows = rows.join(counts, ["lang", "seq"], "left").join(contexts.withColumnRenamed("seq", "before"), ["lang", "before"], "left")
        rows = rows.join(discounts, "lang", "left")
        if order == 1:
            rows = rows.withColumn("below", F.lit(1.0 / (1 << 16)))
        else:
            shorter = rows.select("lang", F.col("short").alias("seq")).distinct()
            below = self.probabilities(shorter, order - 1).select("lang", F.col("seq").alias("short"), F.col("p").alias("below"))
            rows = rows.join(below, ["lang", "short"])
        own = F.greatest(F.coalesce("n", F.lit(0)) - F.col("discount"), F.lit(0.0))
        mixed = (own + F.col("discount") * F.col("kinds") * F.col("below")) / F.col("total")
        return rows.select("lang", "seq", F.when(F.col("total").isNotNull(), mixed).otherwise(F.col("below")).alias("p"))


def train(df: DataFrame, text: str, lang: str) -> Model:
    """The models of all languages of the rows with a text and a language, in sorted arrays."""
    return Counts(df, text, lang, F.lit(False)).model()


def _scored_by_arrays(rows: DataFrame, counts: Counts, schema: str) -> DataFrame:
    """The rows with ``totals`` (summed negative log probability per language) and ``size`` in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(counts.model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, model = Letters(), shared.value
        for batch in batches:
            height = batch.num_rows
            totals, sizes = np.zeros((height, len(model.languages))), np.zeros(height, dtype=np.int64)
            values = enumerate(x or "" for x in batch.column(batch.num_columns - 1).to_pylist())
            for numbers, texts, before in _pieces(values):
                keys, found = letters.sequences(texts, before)
                np.add.at(totals, numbers, model.entropies(keys, found))
                np.add.at(sizes, numbers, found)
            each = pa.ListArray.from_arrays(
                np.arange(height + 1, dtype=np.int32) * len(model.languages), pa.array(totals.ravel())
            )
            arrays = [*batch.columns[:-1], each, pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "totals", "size"])

    return rows.mapInArrow(run, schema)


def _scored_by_joins(rows: DataFrame, counts: Counts, kind: str) -> DataFrame:
    """The same for models of any size. Rows of the same key and text share their sums, so they are added up once for
    all and divided by the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for at, text in enumerate(texts):
                for _, pieces, before in _pieces([(0, text or "")]):
                    keys, n = np.unique(letters.sequences(pieces, before)[0], return_counts=True)
                    if len(keys):
                        same = pa.array(np.full(len(keys), at))
                        columns = [batch.column(0).take(same), batch.column(1).take(same), pa.array(keys.view(np.int64)), pa.array(n)]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "tie", "seq", "n"])

    tied = rows.select("*", F.xxhash64("_text").alias("_tie"))
    found = tied.select("_key", "_tie", "_text").mapInArrow(run, f"key {kind}, tie bigint, seq bigint, n bigint")
    found = materialize(found, "langid-sequences")
    languages = F.array(*[F.lit(x) for x in counts.languages])
    wanted = found.select("seq").distinct().select("seq", F.explode(languages).alias("lang"))
    values = counts.probabilities(wanted).groupBy("seq").agg(
        F.array_sort(F.collect_list(F.struct("lang", (-F.log("p")).alias("v")))).alias("values")
    )
    values = materialize(values, "langid-probabilities")
    sums = [F.sum(F.col("n") * F.get("values", F.lit(k))["v"]) for k in range(len(counts.languages))]
    added = found.join(values, "seq").groupBy("key", "tie").agg(F.array(*sums).alias("sums"), F.sum("n").alias("all"))
    copies = tied.groupBy(F.col("_key").alias("key2"), F.col("_tie").alias("tie2")).agg(F.count(F.lit(1)).alias("copies"))
    added = added.join(copies, F.col("key").eqNullSafe(F.col("key2")) & (F.col("tie") == F.col("tie2"))).select(
        "key", "tie", F.transform("sums", lambda x: x / F.col("copies")).alias("totals"),
        (F.col("all") / F.col("copies")).cast("bigint").alias("size"),
    )
    joined = tied.join(added, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_tie") == F.col("tie")), "left")
    return joined.select("_key", "held_out", "_aside", "_lang", "totals", F.coalesce("size", F.lit(0)).alias("size"))


def identify(
    df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 5, held_out: int = 0,
    cells: int = SHARED_CELLS,
) -> DataFrame:
    """(key, held_out, lang_pred, score, entropy, accepted) for every row, learnt outside of the held-out fold."""
    fold = F.coalesce(remainder(F.col(key), parts) == held_out, F.lit(False))
    learnt = ~fold & F.col(key).isNotNull()
    aside = learnt & (F.pmod(F.xxhash64(F.col(key)), F.lit(CALIBRATION)) == 0)
    counts = Counts(df.where(learnt), text, lang, aside)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(
        F.col(key).alias("_key"), fold.alias("held_out"), aside.alias("_aside"), F.col(lang).alias("_lang"),
        F.col(text).cast("string").alias("_text"),
    )
    # without a language the model is empty
    if not counts.languages or counts.cells() <= cells:
        schema = f"_key {kind}, held_out boolean, _aside boolean, _lang string, totals array<double>, size bigint"
        totals = _scored_by_arrays(rows, counts, schema)
    else:
        totals = _scored_by_joins(rows, counts, kind)
    n = F.greatest("size", F.lit(1))
    means = totals.select("*", F.transform("totals", lambda x: x / n).alias("means"), F.array_min(F.transform("totals", lambda x: x / n)).alias("lowest"))
    known = (F.col("size") > 0) & F.col("lowest").isNotNull()
    summed = F.aggregate("means", F.lit(0.0), lambda s, x: s + F.exp((F.col("lowest") - x) * F.sqrt(n)))
    names = F.array(*[F.lit(x) for x in counts.languages]).cast("array<string>")
    best = F.get(names, (F.array_position("means", F.col("lowest")) - 1).cast("int"))
    scored = means.select(
        "_key", "held_out", "_aside", "_lang",
        F.when(known, best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1 / summed).otherwise(0.0).alias("score"),
        F.when(known, F.col("lowest")).alias("entropy"),
    )
    scored = materialize(scored, "langid-scores")
    # one row per language: how well texts that its model has not seen are predicted
    unseen = scored.where(F.col("_aside") & (F.col("_lang") == F.col("lang_pred")) & ~F.col("_lang").isin(counts.only_aside))
    usual = unseen.groupBy("lang_pred").agg(
        F.avg("entropy").alias("mean"), F.var_pop("entropy").alias("var"), F.count(F.lit(1)).alias("n")
    )
    spread = usual.agg((F.sum(F.col("var") * F.col("n")) / F.sum("n")).alias("var")).first()["var"] or 0.0
    limits = usual.select("lang_pred", (F.col("mean") + WIDTH * F.sqrt(F.greatest("var", F.lit(float(spread))))).alias("_limit"))
    joined = scored.join(F.broadcast(limits), "lang_pred", "left")
    fine = F.coalesce(F.col("entropy") <= F.col("_limit"), F.col("entropy").isNotNull())
    return joined.select(F.col("_key").alias(key), "held_out", "lang_pred", "score", "entropy", fine.alias("accepted"))


# --- the query -------------------------------------------------------------------------------------------------------


def query(docs: DataFrame) -> DataFrame:
    return identify(docs.select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score", "accepted")
