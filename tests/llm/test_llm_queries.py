"""Registered queries of the operators against their SQL or a plain version, on the whole small tables."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from check import compare, database
from conftest import SMALL
from voxloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    good, note = compare(spark, database(SMALL), SMALL, name, QUERIES[name], ORACLES[name])
    assert good, note


@pytest.mark.parametrize(
    ("name", "label", "parts", "held", "cut"), [("op1_quality", "quality", 4, 2, 0.7), ("op5_toxicity", "toxic", 5, 0, 0.5)]
)
def test_classifiers(spark, docs, labels, name, label, parts, held, cut):
    rows = QUERIES[name](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut) for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], parts) == held) for r in rows)
    seen = [r for r in rows if r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]][label] for r in seen)
    assert right >= 0.9 * len(seen)


def test_languages(spark, docs):
    rows = QUERIES["op3_language_id"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    held = [r for r in rows if r["held_out"]]
    assert held and all(fold(r["doc_id"], 5) == 0 for r in held)
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)


def test_shards_follow_one_running_sum(spark, docs):
    rows = sorted(QUERIES["op7_sharding"](spark, SMALL).collect(), key=lambda r: r["doc_id"])
    sizes = [len((docs[r["doc_id"]]["text"] or "").encode()) + 1 for r in rows]
    total, before, slots = sum(sizes), 0, collections.Counter()
    assert [r["doc_id"] for r in rows] == sorted(docs)
    for r, size in zip(rows, sizes):
        shard = (2 * before + size) * 8 // (2 * total)
        assert (r["size"], r["shard"], r["slot"]) == (size, shard, slots[shard])
        assert r["text_crc32"] == zlib.crc32((docs[r["doc_id"]]["text"] or "").encode())
        slots[shard] += 1
        before += size


def test_packing_keeps_every_id(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op8_packing"](spark, SMALL).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    total = 0
    for doc_id, found in pieces.items():
        ids = np.array(tokenizer.encode(docs[doc_id]["text"] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
    assert total >= 0.95 * 4096 * len(sequences)


def test_jaccard_components(spark, docs):
    sets = {}
    for doc_id, row in docs.items():
        words = (row["text"] or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 10 * min(len(x), len(y)) >= 9 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 90 * (len(x) + len(y) - both):
                    i, j = find(a), find(b)
                    root[max(i, j)] = min(i, j)
    rows = {r["doc_id"]: r for r in QUERIES["op10_jaccard_join"](spark, SMALL).collect()}
    assert {d: (len(s), find(d)) for d, s in sets.items()} == {d: (r["n_shingles"], r["component_id"]) for d, r in rows.items()}


def test_each_limit_of_packing_closes_sequences(spark):
    rows = QUERIES["op8_packing"](spark, SMALL).collect()
    sequences = collections.defaultdict(lambda: [0, 0, 0])
    for r in rows:
        for k, n in enumerate((r["length"], 1, r["loss_tokens"])):
            sequences[r["sequence_id"]][k] += n
    limits = (4096, 16, 4000)
    assert all(n <= limit for sums in sequences.values() for n, limit in zip(sums, limits))
    for k, limit in enumerate(limits):
        assert any(sums[k] == limit and all(sums[j] < limits[j] for j in range(3) if j != k) for sums in sequences.values())
