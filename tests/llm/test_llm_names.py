"""Tables whose columns bear the names that operators use inside, or those of their results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voxloom.llm import linededup, rules, sharding, toxicity

TEXTS = ["one\ntwo\nthree\nfour", "one\ntwo\nthree\nfive", None, "", "bad words here and there " * 8]
INSIDE = [
    "starts", "_key", "_tie", "_whole", "_words", "_size", "_part", "_row", "_before", "_base", "_at", "_from", "_total",
    "_text", "_id", "_label", "a", "key", "given__0", "dotted.name",
]
RESULTS = ["n_lines", "n_removed", "n_words", "failed", "size", "Shard", "slot", "score", "passages", "held_out"]


def operators(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)], "doc_id long, toxic int")
    return {
        "dedup_lines": linededup.dedup_lines, "ledger": rules.ledger, "shard_by_bytes": lambda d: sharding.shard_by_bytes(d, 2),
        "score_toxicity": lambda d: toxicity.score_toxicity(d, labels),
    }


@pytest.mark.parametrize("name", ["dedup_lines", "ledger", "shard_by_bytes", "score_toxicity"])
def test_names_of_the_table_do_not_matter(spark, name):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    operator = operators(spark)[name]
    plain = operator(rows)
    new = [c for c in plain.columns if c not in rows.columns]
    extra = rows.select("*", *[F.lit(f"kept {c}").alias(c) for c in INSIDE + RESULTS])
    found = operator(extra)
    lower = [c.lower() for c in found.columns]
    assert len(set(lower)) == len(lower) and set(rows.columns + new + INSIDE) <= set(found.columns)
    shared = rows.columns + new
    assert sorted(map(str, found.select(*shared).collect())) == sorted(map(str, plain.select(*shared).collect()))
    given = [c for c in INSIDE + RESULTS if c in found.columns and c not in new]
    assert all(r[c] == f"kept {c}" for r in found.collect() for c in given)


def test_ids_may_be_texts(spark):
    rows = spark.createDataFrame(
        [("b", TEXTS[0]), ("a", TEXTS[1]), (None, "x"), ("c", None), ("d", TEXTS[0])], "doc_id string, text string"
    )
    found = {r["doc_id"]: r for r in linededup.dedup_lines(rows).collect()}
    assert {k: r["text"] for k, r in found.items()} == {"a": TEXTS[1], "b": "four", "c": None, "d": "", None: "x"}
    assert {k: r["n_removed"] for k, r in found.items()} == {"a": 0, "b": 3, "c": 0, "d": 4, None: 0}
