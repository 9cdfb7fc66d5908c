"""Repair of the turn structure of conversations by alignment with a grammar.

A conversation is sound if its role initials read ``(s?(ua)+)?``. The grammar has one string per length: (ua)^k for an even
length, s(ua)^k for an odd one. The turns are aligned with each feasible length in the manner of Wagner and Fischer: a turn is
kept, gets another role or is deleted, and a missing turn is inserted. The tails of all those strings coincide, so one
table of costs to go, G[turn][target characters left], holds every length; a leading ``s`` is a kept system turn. A first
repair by one greedy walk gives an incumbent cost, and only the diagonals that it leaves possible are filled (Ukkonen's
band). Each length that reaches the least cost is traced from its front, the letter that is least in ASCII first, and the
least of these audits wins. The rows of the table are vectors; every ``STRIDE``-th is kept and the others are filled again
for the trace, so a conversation of n turns needs about n times the root of n numbers, not their square.

Audit letters: K keep, R another role, D delete, I insert. Spark sees to all texts: which turns repeat an earlier one, which
are blank or cut off, the order, and the digest. Only a letter per turn goes to the Python workers, and what was decided for
one pattern of letters is kept for the next conversation of that pattern (a bounded cache).

One conversation is one row of the result, its audit and its digest cover all of it, so its turns meet in one task; the
sort that finds repeated turns spills. Nothing else is grouped.

Defined results: null roles and texts are one space. A null id is a conversation like any other. Turns are ordered by turn
(nulls first), then role, then text, so tied and repeated rows have an order. A conversation without turns, or an empty
one, has the empty audit. Gaps that no long can hold are null. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.binding import bind
from voxloom.llm.common import BLANKS

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Rows of the table that are kept between two that are filled again.
STRIDE = 256
#: Patterns whose repair a worker remembers.
REMEMBERED = 100_000
FAR = np.int64(1 << 40)


@dataclass(frozen=True)
class Repair:
    """``turns`` lists the repaired conversation: the place of the turn (-1: inserted) and its new role (None: as it was)."""

    cost: int
    audit: str
    turns: list[tuple[int, str | None]]


def greedy_cost(pattern: str) -> int:
    """The cost of one valid repair: turns that may stay take the next role of the grammar in turn."""
    cost, placed, system = 0, 0, False
    for letter in pattern:
        if letter == "x":
            cost += DELETE
            continue
        cost += CUT_OFF * letter.isupper()
        if letter in "sS" and not placed and not system:
            system = True
            continue
        cost += REROLE * (letter.lower() != "ua"[placed % 2])
        placed += 1
    if system and not placed:
        return cost + 2 * INSERT
    return cost + INSERT * (placed % 2)


class Table:
    """Costs to go of a pattern, banded by an incumbent: row i covers the remaining lengths ``low(i)`` to ``high(i)``."""

    def __init__(self, pattern: str, bound: int):
        self.pattern, self.n = pattern, len(pattern)
        self.less, self.more = bound // DELETE, bound // INSERT
        left = np.arange(self.n + self.more + 1)
        #: role that the target wants with so many characters left
        self.wanted = np.where(left % 2 == 1, "a", "u")
        self.kept: dict[int, np.ndarray] = {}

    def low(self, i: int) -> int:
        return max(0, self.n - i - self.less)

    def high(self, i: int) -> int:
        return self.n - i + self.more

    def last(self) -> np.ndarray:
        return INSERT * np.arange(self.low(self.n), self.high(self.n) + 1, dtype=np.int64)

    def place_costs(self, i: int, low: int, high: int) -> np.ndarray:
        """Cost of turn i as the target character with r left, for r from low to high."""
        letter = self.pattern[i]
        if letter == "x":
            return np.full(high - low + 1, FAR)
        cost = np.where(self.wanted[low : high + 1] == letter.lower(), KEEP, REROLE).astype(np.int64)
        cost += CUT_OFF * letter.isupper()
        if low == 0:
            cost[0] = FAR
        return cost

    def row(self, i: int, below: np.ndarray) -> np.ndarray:
        """Row i from row i + 1."""
        low, high, first = self.low(i), self.high(i), self.low(i + 1)
        wide = np.full(high - low + 2, FAR)  # below at low - 1 .. high
        at = first - (low - 1)
        wide[at : at + len(below)] = below[: len(wide) - at]
        best = np.minimum(wide[1:] + DELETE, wide[:-1] + self.place_costs(i, low, high))
        # inserting is a step to the right, so a running minimum of the costs without the steps
        steps = INSERT * np.arange(len(best), dtype=np.int64)
        return np.minimum.accumulate(best - steps) + steps

    def fill(self) -> dict[int, int]:
        """Least cost per length; keeps the rows a trace starts from and the best turn for a leading ``s``."""
        costs: dict[int, int] = {}
        self.heads: dict[int, int] = {}
        row = self.last()
        self.kept[self.n] = row
        for i in range(self.n - 1, -1, -1):
            if self.pattern[i] in "sS":
                low = self.low(i + 1)
                head = DELETE * i + CUT_OFF * (self.pattern[i] == "S")
                for r in range(max(2, low + low % 2), self.high(i + 1) + 1, 2):
                    # walked from the back: of equal ones the later turn wins, which has more deletions in front
                    if head + row[r - low] < costs.get(r + 1, FAR):
                        costs[r + 1], self.heads[r + 1] = int(head + row[r - low]), i
            row = self.row(i, row)
            if i % STRIDE == 0:
                self.kept[i] = row
        low = self.low(0)
        for r in range(low + low % 2, self.high(0) + 1, 2):
            costs[r] = int(row[r - low])
        return costs

    def rows_from(self, start: int, end: int) -> list[np.ndarray]:
        rows = [self.kept[end]]
        for i in range(end - 1, start - 1, -1):
            rows.append(self.row(i, rows[-1]))
        return rows[::-1]

    def traces(self, lengths: Sequence[int]) -> list[str]:
        """The least audit of each length, all traced side by side through the refilled rows."""
        audits = []
        for length in lengths:
            head = self.heads.get(length) if length % 2 else None
            audits.append([0, length, []] if head is None else [head + 1, length - 1, ["D" * head, "K"]])
        for start in range(0, self.n + 1, STRIDE):
            end = min(start + STRIDE, self.n)
            rows = self.rows_from(start, end) if end > start else [self.kept[self.n]]
            for audit in audits:
                i, r, letters = audit
                while start <= i < end:
                    here, low = rows[i - start], self.low(i)
                    below, first = rows[i - start + 1], self.low(i + 1)
                    cost = here[r - low]
                    at = r - first
                    if 0 <= at < len(below) and below[at] + DELETE == cost:
                        letters.append("D")
                        i += 1
                    elif r > low and here[r - low - 1] + INSERT == cost:
                        letters.append("I")
                        r -= 1
                    else:
                        letters.append("K" if self.pattern[i].lower() == self.wanted[r] else "R")
                        i, r = i + 1, r - 1
                audit[0], audit[1] = i, r
        return ["".join(letters) + "I" * r for _, r, letters in audits]


def repair(pattern: str) -> Repair:
    """The cheapest repair of a pattern: a letter per turn, its role initial s, u, a or o for any other, as a capital where
    the turn is cut off, and x where it must go."""
    if not pattern:
        return Repair(0, "", [])
    table = Table(pattern, greedy_cost(pattern))
    costs = table.fill()
    least = min(costs.values())
    audit = min(table.traces([length for length, cost in costs.items() if cost == least]))
    size = len(audit) - audit.count("D")
    roles = ["assistant", "user"] if size % 2 else ["user", "assistant"]
    turns: list[tuple[int, str | None]] = []
    place = 0
    for letter in audit:
        if letter == "I":
            turns.append((-1, roles[len(turns) % 2]))
            continue
        if letter != "D":
            turns.append((place, None if letter == "K" else roles[len(turns) % 2]))
        place += 1
    return Repair(least, audit, turns)


_known: dict[str, Repair] = {}


def _repair_all(patterns: pd.Series) -> pd.DataFrame:
    rows = []
    for pattern in patterns:
        found = _known.get(pattern)
        if found is None:
            if len(_known) >= REMEMBERED:
                _known.clear()
            found = _known[pattern] = repair(pattern)
        rows.append((found.cost, found.audit, [{"at": at, "role": role} for at, role in found.turns]))
    return pd.DataFrame(rows, columns=["cost", "audit", "turns"])


def repaired(pattern: Column) -> Column:
    """Struct (cost, audit, turns) of a pattern."""
    return F.pandas_udf(_repair_all, "cost bigint, audit string, turns array<struct<at:int,role:string>>")(pattern)


def damaged(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, present, turn, role, text): the rows after the damage that crc32 of ``key:turn`` deals out; a row that is dropped
    stays with ``present`` false, so that its conversation is not lost."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain(key), F.lit(":"), plain(turn)).cast("binary")) % 20
    rows = df.select(
        F.col(key).alias("key"), F.col(turn).cast("bigint").alias("turn"), kind.alias("kind"), plain(role).alias("role"),
        plain(text).alias("text"),
    )
    harmed = (
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select(
        "key", (F.col("kind") != 0).alias("present"), "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        harmed.alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _faults(df: DataFrame) -> DataFrame:
    """Adds ``fault`` (blank, duplicate, truncated or null) and ``letter``; dropped rows have neither."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    before = Window.partitionBy("key", "role", "text").orderBy(F.desc("present"), F.asc_nulls_first("turn"))
    # rows that are dropped come behind all others, so they are never the first of a text
    seen = F.row_number().over(before) > 1
    fault = (
        F.when(~F.col("present"), F.lit(None).cast("string"))
        .when(bare == "", "blank").when(F.col("seen"), "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    )
    rows = df.withColumn("seen", seen).withColumn("fault", fault)
    return rows.withColumn("initial", initial).withColumn("letter", letter)


def repair_conversations(rows: DataFrame, key: str = "key") -> DataFrame:
    """One row per conversation of a table (key, present, turn, role, text): ``gaps``, the counts of ``blank``, ``duplicate``,
    ``truncated`` and ``illegal``, ``cost``, ``audit``, and ``turns``, the repaired conversation as array of (role, text)."""
    # one shuffle: the window and the groups both find their rows by conversation
    judged = _faults(rows.repartition("key"))
    item = F.struct("turn", "role", "text", F.coalesce(F.col("fault") == "duplicate", F.lit(False)).alias("again"), "initial", "letter")
    count = lambda name: F.count_if(F.col("fault") == name).cast("bigint").alias(name)
    whole = judged.groupBy("key").agg(
        F.sort_array(F.collect_list(F.when(F.col("present"), item))).alias("items"), count("blank"), count("duplicate"), count("truncated"),
        F.min(F.when(F.col("present"), F.col("turn"))).alias("low"), F.max(F.when(F.col("present"), F.col("turn"))).alias("high"),
    )
    own = F.array_distinct(F.filter(F.transform("items", lambda x: x["turn"]), lambda t: t.isNotNull()))
    wide = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.size(own)
    gaps = F.when(F.col("low").isNull(), F.lit(0).cast("bigint")).otherwise(wide.try_cast("bigint"))

    def wrong(x: Column) -> Column:
        pair = lambda i: F.concat(F.get(x, i), F.get(x, i + 1))
        places = F.sequence(F.lit(0), F.size(x) - 2)
        return F.when(F.size(x) < 2, 0).otherwise(F.size(F.filter(places, lambda i: ~pair(i).isin("su", "ua", "au"))))

    illegal = bind(F.transform("items", lambda x: x["initial"]), wrong)
    letters = F.array_join(F.transform("items", lambda x: x["letter"]), "")
    counted = whole.select(
        "key", "items", gaps.alias("gaps"), "blank", "duplicate", "truncated", illegal.cast("bigint").alias("illegal"),
        repaired(letters).alias("r"),
    )

    def placed(x: Column) -> Column:
        item_of = lambda t: F.get(x["items"], t["at"])
        return F.transform(
            x["turns"],
            lambda t: F.struct(
                F.coalesce(t["role"], item_of(t)["role"]).alias("role"),
                F.when(t["at"] < 0, "").otherwise(item_of(t)["text"]).alias("text"),
            ),
        )

    turns = bind(F.struct("items", F.col("r.turns").alias("turns")), placed)
    return counted.select(
        F.col("key").alias(key), "gaps", "blank", "duplicate", "truncated", "illegal", F.col("r.cost").alias("cost"),
        F.col("r.audit").alias("audit"), turns.alias("turns"),
    )


# --- the query and its SQL ------------------------------------------------------------------------------------------


def query(conversations: DataFrame) -> DataFrame:
    rows = repair_conversations(damaged(conversations, "conv_id", "turn", "role", "text"), "conv_id")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return rows.select(*rows.columns[:-1], F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


def sql() -> str:
    """Another method: costs to go of the grammar's four states (nothing yet, s, u, a), from the last turn to the first, with
    the audit as part of what is minimised."""
    put = lambda cost, letter, f: f"{{'c': {cost} + {f}.c, 'a': {letter} || {f}.a}}"
    user, assistant = "CASE WHEN letter = 'u' THEN 0 ELSE 3 END + tail", "CASE WHEN letter = 'a' THEN 0 ELSE 3 END + tail"
    kr = lambda wanted: f"CASE WHEN letter = '{wanted}' THEN 'K' ELSE 'R' END"
    may = lambda choice: f"CASE WHEN must THEN NULL ELSE {choice} END"
    best = lambda *options: f"list_min([{', '.join(options)}])"
    as_user, as_assistant = may(put(user, kr("u"), "f2")), may(put(assistant, kr("a"), "f3"))
    kept_system = f"CASE WHEN must OR letter <> 's' THEN NULL ELSE {put('tail', repr('K'), 'f1')} END"
    gone = lambda f: put(4, "'D'", f)
    inserted = lambda f: put(3, "'I'", f)
    return f"""WITH RECURSIVE bits AS (
  SELECT b, b::UBIGINT AS c, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, xor(c >> 1, (c & 1) * 3988292384::UBIGINT), k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT) AS bytes
  FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 20 AS kind
  FROM keyed, crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM harmed),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS letter FROM placed),
paired AS (SELECT *, letter || lead(letter) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM judged),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM paired GROUP BY conv_id),
turned AS (
  SELECT conv_id, i, role, text, letter, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS tail FROM judged),
walk AS (
  SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': ''}} AS f0, {{'c': 6::BIGINT, 'a': 'II'}} AS f1, {{'c': 3::BIGINT, 'a': 'I'}} AS f2,
         {{'c': 0::BIGINT, 'a': ''}} AS f3 FROM counted
  UNION ALL
  SELECT conv_id, i, {best('e0', inserted('f2'))}, {best('e1', inserted('f2'))}, f2, {best('e3', inserted('e2'))}
  FROM (SELECT *, {best('e2', inserted('e3'))} AS f2 FROM (
    SELECT w.conv_id, t.i, {best(gone('f0'), kept_system, as_user)} AS e0, {best(gone('f1'), as_user)} AS e1,
           {best(gone('f2'), as_assistant)} AS e2, {best(gone('f3'), as_user)} AS e3
    FROM walk w JOIN turned t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i - 1))),
audits AS (SELECT conv_id, f0.c AS cost, f0.a AS audit FROM walk WHERE i = 1),
letters AS (SELECT conv_id, audit, unnest(string_split(audit, '')) AS op, unnest(range(1, length(audit) + 1)) AS p FROM audits WHERE audit <> ''),
steps AS (
  SELECT conv_id, op, p, count_if(op <> 'I') OVER w AS i, count_if(op <> 'D') OVER w AS o, length(replace(audit, 'D', '')) % 2 AS odd
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
lines AS (
  SELECT s.conv_id, s.p, CASE WHEN op = 'K' THEN t.role WHEN (s.o + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN op = 'I' THEN '' ELSE t.text END AS line
  FROM steps s LEFT JOIN turned t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i WHERE op <> 'D'),
joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS repaired FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(k.gaps, 0)::BIGINT AS gaps, coalesce(k.blank, 0)::BIGINT AS blank, coalesce(k.duplicate, 0)::BIGINT AS duplicate,
       coalesce(k.truncated, 0)::BIGINT AS truncated, coalesce(k.illegal, 0)::BIGINT AS illegal, coalesce(a.cost, 0)::BIGINT AS cost,
       coalesce(a.audit, '') AS audit, sha256(coalesce(j.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM c.conv_id"""
