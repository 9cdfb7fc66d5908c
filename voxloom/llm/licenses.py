"""Licence scan with a positional index of rare words.

Templates are names, notices and paragraphs of licences. Each is indexed under its rarest words (three places, or an eighth
of a long template's, by document frequency in the table that is scanned), so a word put in or left out of a paragraph
moves some of its rare words and leaves others together. A text looks up those words, every pair of a place in the text and a place in the template
gives the start the template would have, and a start on which enough rare words agree is a candidate: the postings
intersect by relative position. A candidate counts if all mandatory phrases of the template stand where it puts them,
give or take its slack; its score is the share of the template's words that agree, weighted by their rarity.

Two passes over the texts. The first counts documents per template word, at most one row per word of the templates, which
is the only thing that reaches the driver. The second is a map over rows: nothing is shuffled, the index is part of the
plan, and the work inside a row is linear in its words and sorts only the looked-up places.

Defined results: null and empty texts have no words, no labels and score 0. A phrase of three words or fewer is found at
every place, since all its words are indexed and must agree. Repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.binding import bind
from voxloom.llm.common import words_of

#: Least rare places under which a template is indexed, and how many of them must agree.
RARE, AGREE = 3, 2


@dataclass(frozen=True)
class Template:
    """``phrases`` are the mandatory key phrases, as (first word in the template, words)."""

    label: str
    text: str
    phrases: tuple[tuple[int, int], ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def agree(self) -> int:
        return len(self.words) if len(self.words) <= RARE else AGREE

    @property
    def rare(self) -> int:
        return max(RARE, len(self.words) // 8)

    @property
    def slack(self) -> int:
        return 0 if len(self.words) <= RARE else max(2, len(self.words) // 8)


def _whole(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, ((0, len(text.split())),), base)


def notice(label: str, text: str, *phrases: str) -> Template:
    """A paragraph and the phrases of it that must stand."""
    words = text.split()
    wanted = [phrase.split() for phrase in phrases]
    places = [next(i for i in range(len(words)) if words[i : i + len(w)] == w) for w in wanted]
    return Template(label, text, tuple((i, len(w)) for i, w in zip(places, wanted)))


#: Phrases and labels of the contract, then sentences of public licences in lower case without marks.
TEMPLATES = (
    _whole("cc-by", "cc by", base=True),
    _whole("gpl", "general public license", base=True),
    _whole("reserved", "all rights reserved", base=True),
    _whole("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ((0, 4), (8, 4))),
    Template("apache-2.0", "licensed under the apache license version 2 0", ((3, 2), (5, 2))),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ((0, 3), (4, 4))),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ((3, 4), (7, 2))),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ((3, 4), (7, 2))),
    _whole("lgpl", "lesser general public license"),
    _whole("agpl", "affero general public license"),
    _whole("mpl", "mozilla public license"),
    _whole("epl", "eclipse public license"),
    _whole("cc-by-nc", "cc by nc"),
    _whole("cc-by-sa", "cc by sa"),
    _whole("cc-by-nd", "cc by nd"),
    _whole("cc-by", "creative commons attribution"),
    _whole("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ((2, 3), (6, 5))),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", ((0, 4), (9, 4))),
    notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
        "permission is hereby granted", "without restriction", "subject to the following conditions",
    ),
    notice(
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
        "names of its contributors", "endorse or promote products", "specific prior written permission",
    ),
    notice(
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
        "required by applicable law", "warranties or conditions of any kind",
    ),
    notice(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "you can redistribute it", "gnu general public license",
    ),
    notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "with or without fee", "this permission notice appear in all copies",
    ),
    notice(
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
        "as a compiled binary for any purpose commercial or non commercial and by any means",
        "copy modify publish use compile sell or distribute", "by any means",
    ),
)


def vocabulary(templates: Sequence[Template] = TEMPLATES) -> list[str]:
    return sorted({word for template in templates for word in template.words})


def rarity(documents: int, holding: int) -> int:
    """Whole bits of (documents + 1) / (documents that hold the word + 1), and one."""
    return ((documents + 1) // (holding + 1)).bit_length()


def document_frequencies(
    df: DataFrame, text: str, templates: Sequence[Template] = TEMPLATES
) -> tuple[int, dict[str, int]]:
    """Number of documents, and per word of the templates the documents that hold it. One bounded row per word."""
    words = vocabulary(templates)
    known = F.array(*[F.lit(word) for word in words])
    held = F.array_intersect(words_of(F.col(text)), known)
    # the blank stands for the document itself
    rows = df.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").count().collect()
    counts = {row["word"]: row["count"] for row in rows}
    return counts.get("", 0), {word: counts.get(word, 0) for word in words}


def rare_places(template: Template, holding: dict[str, int]) -> list[int]:
    words = template.words
    return sorted(range(len(words)), key=lambda p: (holding[words[p]], words[p], p))[: template.rare]


def _index(templates: Sequence[Template], holding: dict[str, int]) -> tuple[list[str], Column]:
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        for p in rare_places(template, holding):
            postings.setdefault(template.words[p], []).append((t, p))
    pairs: list[Column] = []
    for word, places in postings.items():
        pairs.append(F.lit(word))
        pairs.append(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in places]))
    return list(postings), F.create_map(*pairs)


def _candidates(words: Column, keys: Sequence[str], index: Column, templates: Sequence[Template]) -> Column:
    """(t, s): template and start of every alignment on which enough rare words agree; starts count from 0."""
    held = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*keys))
    start = lambda x, p: F.struct(p["t"].alias("t"), (x["i"] - p["p"]).alias("s"))
    starts = F.flatten(F.transform(held, lambda x: F.transform(F.element_at(index, x["w"]), lambda p: start(x, p))))
    agree = F.array(*[F.lit(template.agree) for template in templates])

    def runs(e: Column) -> Column:
        first = lambda x, k: ~F.coalesce(F.get(e, k - 1) == x, F.lit(False))
        enough = lambda x, k: F.coalesce(F.get(e, k + F.get(agree, x["t"]) - 1) == x, F.lit(False))
        return F.filter(e, lambda x, k: first(x, k) & enough(x, k))

    none = F.array().cast("array<struct<t:int,s:int>>")
    some = F.arrays_overlap(words, F.array(*[F.lit(k) for k in keys]))
    return F.when(some, bind(F.array_sort(starts), runs)).otherwise(none)


def _verified(words: Column, found: Column, templates: Sequence[Template], weights: dict[str, int]) -> Column:
    """Candidates that hold all mandatory phrases, with the weighted share of agreeing words."""
    phrase = lambda t, o, n: F.struct(F.lit(o).alias("o"), F.array(*[F.lit(w) for w in t.words[o : o + n]]).alias("w"))
    phrases = F.array(*[F.array(*[phrase(t, o, n) for o, n in t.phrases]) for t in templates])
    slacks = F.array(*[F.lit(t.slack) for t in templates])
    bodies = F.array(*[F.array(*[F.struct(F.lit(w).alias("w"), F.lit(weights[w]).alias("b")) for w in t.words]) for t in templates])

    def stands(at: Column, p: Column) -> Column:
        return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(p)) == p)

    def whole(c: Column) -> Column:
        slack = F.get(slacks, c["t"])
        near = lambda q: F.exists(F.sequence(-slack, slack), lambda d: stands(c["s"] + q["o"] + d, q["w"]))
        return F.forall(F.get(phrases, c["t"]), near)

    def share(c: Column) -> Column:
        body = F.get(bodies, c["t"])
        total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
        agreed = F.transform(body, lambda x, j: F.when(F.get(words, c["s"] + j) == x["w"], x["b"]).otherwise(0))
        return total(agreed) / total(F.transform(body, lambda x: x["b"]))

    return F.transform(
        F.filter(found, whole), lambda c: F.struct(c["t"].alias("t"), c["s"].alias("s"), share(c).alias("score"))
    )


def scan(df: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """The table with ``words`` (of the text) and ``found``: an array of (t, s, score), the template's number, the word
    at which it starts, and how much of it agrees. Templates are any lower-case words with blanks between."""
    n, holding = document_frequencies(df, text, templates)
    keys, index = _index(templates, holding)
    weights = {word: rarity(n, count) for word, count in holding.items()}
    rows = df.withColumn("words", words_of(F.col(text)))
    rows = rows.withColumn("found", _candidates(F.col("words"), keys, index, templates))
    return rows.withColumn("found", _verified(F.col("words"), F.col("found"), templates, weights))


# --- the query and its SQL ------------------------------------------------------------------------------------------


def query(docs: DataFrame) -> DataFrame:
    rows = scan(docs.select("doc_id", "text"))
    base = F.array(*[F.lit(t.base) for t in TEMPLATES])
    names = F.array(*[F.lit(t.label) for t in TEMPLATES])
    places = F.transform(F.filter("found", lambda c: F.get(base, c["t"])), lambda c: c["s"])
    label = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda c: F.get(names, c["t"])))), ",")
    return rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
        label(F.filter("found", lambda c: F.get(base, c["t"]))).alias("base_labels"), label(F.col("found")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda c: c["score"])), F.lit(0.0)), 6).alias("score"),
    )


def sql() -> str:
    """The same rule by brute force: every place of every template word is joined, not only the rare ones."""
    words = ", ".join(
        f"({t}, '{x.label}', {str(x.base).lower()}, {x.agree}, {x.rare}, {x.slack}, {p}, '{w}')"
        for t, x in enumerate(TEMPLATES) for p, w in enumerate(x.words)
    )
    phrases = ", ".join(
        f"({t}, {k}, {o}, {j}, '{x.words[o + j]}', {n}, {x.slack})"
        for t, x in enumerate(TEMPLATES) for k, (o, n) in enumerate(x.phrases) for j in range(n)
    )
    return f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
template(t, label, base, agree, rare, slack, p, w) AS (VALUES {words}),
phrase(t, k, o, j, w, n, slack) AS (VALUES {phrases}),
word AS (
  SELECT doc_id, w, i FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM split)
  WHERE w IN (SELECT w FROM template)),
bits AS (
  SELECT w, length(bin((SELECT count(*) + 1 FROM documents) // (count(DISTINCT doc_id) + 1))) AS b, count(DISTINCT doc_id) AS df
  FROM (SELECT DISTINCT w FROM template) LEFT JOIN word USING (w) GROUP BY w),
rare AS (
  SELECT t, p, w, agree FROM (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY df, w, p) AS k FROM template JOIN bits USING (w)) WHERE k <= rare),
candidate AS (
  SELECT doc_id, t, i - p AS s FROM word JOIN rare USING (w) GROUP BY ALL HAVING count(*) >= any_value(agree)),
stands AS (
  SELECT DISTINCT doc_id, t, s, k FROM (
    SELECT c.doc_id, c.t, c.s, f.k, word.i - c.s - f.o - f.j AS d, any_value(f.n) AS n, count(*) AS got
    FROM candidate c JOIN phrase f USING (t)
    JOIN word ON word.doc_id = c.doc_id AND word.w = f.w AND abs(word.i - c.s - f.o - f.j) <= f.slack
    GROUP BY ALL) WHERE got = n),
verified AS (
  SELECT doc_id, t, s FROM stands GROUP BY doc_id, t, s
  HAVING count(*) = (SELECT count(DISTINCT k) FROM phrase WHERE phrase.t = stands.t)),
scored AS (
  SELECT v.doc_id, v.t, v.s, any_value(label) AS label, any_value(base) AS base,
         sum(CASE WHEN word.w IS NOT NULL THEN b ELSE 0 END)::DOUBLE / sum(b) AS score
  FROM verified v JOIN template USING (t) JOIN bits USING (w)
  LEFT JOIN word ON word.doc_id = v.doc_id AND word.i = v.s + template.p AND word.w = template.w
  GROUP BY v.doc_id, v.t, v.s)
SELECT split.doc_id, any_value(len(ws))::BIGINT AS n_words, count(s) FILTER (WHERE base) AS n_base,
       min(s) FILTER (WHERE base)::BIGINT AS first_word, max(s) FILTER (WHERE base)::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE label IS NOT NULL))), ','), '') AS labels,
       round(coalesce(max(score), 0), 6) AS score
FROM split LEFT JOIN scored USING (doc_id) GROUP BY split.doc_id"""
