"""Centroids and conversation repair against plain versions, and their odd rows."""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import random
import zlib

import pytest

from conftest import SMALL
from voxloom.llm import centroids, turns
from voxloom.llm.queries import QUERIES


# --- 12: centroids ----------------------------------------------------------------------------------------------------


def plain_clusters(rows, k=16, rounds=3, size=64):
    whole = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(max(-(2.0**27), min(2.0**27, 64 * x))) for x in v]) for i, v in whole]
    order = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centers = [list(v) for _, v in sorted(kept, key=order)[:k]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((distance(v, c), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        for n in range(len(centers)):
            mine = [v for (_, v), f in zip(kept, found) if f == n]
            if mine:
                centers[n] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [(i, *near(v)) for i, v in kept]
    own = {n: sum(d for _, d, c in final if c == n) for n in range(len(centers))}
    fits = lambda x: x if x < 1 << 63 else None
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, n, d, fits(own[n]), fits(sum(own.values())), shas[n]) for i, d, n in final]


def as_rows(df):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in df.collect()), key=repr)


def test_clusters_equal_plain_ones(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert as_rows(QUERIES["op12_centroid_clustering"](spark, SMALL)) == sorted(plain_clusters(rows), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, v string"


def odd_vectors():
    chance = random.Random(3)
    vector = lambda: [chance.uniform(-1, 1) for _ in range(64)]
    rows = [(i, vector()) for i in range(20)]
    rows += [(20, rows[0][1]), (20, rows[0][1]), (None, vector()), (21, [0.0] * 64), (22, [3e38] * 64), (23, [-3e38] * 64)]
    rows += [(24, [0.0] * 63), (25, [0.0] * 65), (26, []), (27, None), (28, [None] + [0.0] * 63), (29, [float("nan")] * 64)]
    rows += [(30, [float("inf")] + [0.0] * 63), (31, [0.0] * 63 + [float("-inf")])]
    return [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]


def test_odd_vectors(spark):
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, 1, 9, "x") for i, v in rows], VECTORS)
    held = [(r["vec_id"], r["embedding"]) for r in df.collect()]  # as floats, like the query sees them
    got = as_rows(centroids.query(df))
    assert got == sorted(plain_clusters(held), key=repr)
    assert {r[0] for r in got} == {*range(24), None} and len(got) == 26


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(1, [1.0] * 64, 1, 1, "x"), (2, [1.0] * 64, 1, 1, "x")], VECTORS)
    assert [r[1:5] for r in as_rows(centroids.query(few))] == [(0, 0, 0, 0)] * 2
    assert centroids.query(few.limit(0)).collect() == []
    assert centroids.query(few.selectExpr("vec_id", "cast(null as array<float>) as embedding")).collect() == []


# --- 13: turns --------------------------------------------------------------------------------------------------------


def plain_repair(pattern):
    """(cost, audit) by trying every edit in every state of the grammar, the audit part of what is compared."""
    n = len(pattern)

    @functools.lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "")] if i == n and state in "0a" else []
        if inserts < 2:
            for role in "ua":
                if role in {"0": "u", "s": "u", "u": "a", "a": "u"}[state]:
                    cost, audit = best(i, role, inserts + 1)
                    options.append((cost + 3, "I" + audit))
        if i < n:
            cost, audit = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit))
            letter, tail = pattern[i].lower(), 3 * pattern[i].isupper()
            if letter != "x":
                role = "a" if state == "u" else "u"
                cost, audit = best(i + 1, role, 0)
                options.append((cost + tail, "K" + audit) if letter == role else (cost + tail + 3, "R" + audit))
                if letter == "s" and state == "0":
                    cost, audit = best(i + 1, "s", 0)
                    options.append((cost + tail, "K" + audit))
        return min(options, default=(10**9, "~"))

    return best(0, "0", 0)


def test_every_short_pattern():
    for n in range(5):
        for pattern in itertools.product("xuasoUAS", repeat=n):
            found = turns.repair("".join(pattern))
            assert (found.cost, found.audit) == plain_repair("".join(pattern)), pattern


@pytest.mark.parametrize("stride", [3, 256])
def test_long_patterns(monkeypatch, stride):
    monkeypatch.setattr(turns, "STRIDE", stride)
    chance = random.Random(7)
    for k in range(60):
        pattern = "".join(chance.choices("xuasoUAS", [2, 8, 8, 1, 1, 1, 1, 1], k=chance.randint(5, 60)))
        found = turns.repair(pattern)
        assert (found.cost, found.audit) == plain_repair(pattern), pattern


def test_a_very_long_conversation():
    chance = random.Random(1)
    pattern = "s" + "".join(chance.choices("xuaUA", [1, 9, 9, 1, 1], k=3000))
    found = turns.repair(pattern)
    roles = "".join((role or {"u": "user", "a": "assistant", "s": "system"}[pattern[at].lower()])[0] for at, role in found.turns)
    assert roles in ("ua" * (len(roles) // 2), "s" + "ua" * (len(roles) // 2))
    price = {"K": 0, "R": 3, "D": 4, "I": 3}
    assert found.cost == sum(price[x] for x in found.audit) + sum(3 for at, _ in found.turns if at >= 0 and pattern[at].isupper())


def plain_conversations(rows):
    """Contract, row by row, of (conv_id, turn, role, text)."""
    out, groups = [], {}
    for conv, turn, role, text in rows:
        kept = groups.setdefault(conv, [])
        shown = " " if conv is None else str(conv), " " if turn is None else str(turn)
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, letters, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            bare, letter = text.rstrip(" \t\n\x0b\x0c\r"), role[:1] if role[:1] in tuple("sua") else "o"
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts |= {fault: counts[fault] + 1} if fault else {}
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        numbers = [r[0] for r in kept if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        first = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = plain_repair(letters)
        size, lines, at = len(audit) - audit.count("D"), [], 0
        for letter in audit:
            role = "assistant" if (len(lines) + size) % 2 else "user"
            if letter in "KR":
                lines.append(f"{kept[at][1] if letter == 'K' else role}:{kept[at][2]}")
            elif letter == "I":
                lines.append(f"{role}:")
            at += letter != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


CONVERSATIONS = "conv_id long, turn long, role string, text string, key string, present string, items string, letter string"


def odd_turns():
    chance = random.Random(11)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "USER", "unit"], ["Hi.", "Yes!", "cut", "", " \n", None, "é?", "a "]
    rows = [(c, t, chance.choice(roles[:3] if c % 2 else roles), chance.choice(texts)) for c in range(60) for t in range(chance.randint(1, 9))]
    rows += [(None, None, None, None), (None, 0, "user", "Hi."), (70, None, "user", "One."), (70, None, "assistant", "Two.")]
    rows += [(71, 5, "user", "Same."), (71, 5, "user", "Same."), (71, 5, "assistant", "Same."), (72, -(1 << 62), "user", "A."), (72, 7, "user", "B.")]
    return rows + [(73, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}." if t % 7 else f"Turn {t}") for t in range(300)]


def test_conversations_equal_the_contract(spark):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in odd_turns()], CONVERSATIONS)
    got = sorted((tuple(r) for r in turns.query(df).collect()), key=repr)
    assert got == plain_conversations(odd_turns())
    assert turns.query(df.limit(0)).collect() == []


def test_small_table_of_conversations(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()), key=repr)
    assert got == plain_conversations(rows)


def test_a_conversation_that_loses_every_turn(spark):
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hello.", "x", "y", "z", "w")], CONVERSATIONS)
    assert tuple(turns.query(df).first()) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
