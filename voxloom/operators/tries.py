"""Longest dictionary prefixes from a compact trie, for dictionaries whose size has been measured.

The trie is three sorted arrays: the characters of its nodes, level by level and in order among brothers, where the children
of each node begin, and which nodes end an entry. A word is walked by bisection among the children, so a lookup costs its
length. The arrays go to the workers once; words then stay in the task that holds their text.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.session import bound_batches

#: Words whose answer a worker remembers.
REMEMBERED = 500_000


class Trie:
    """``first[k]`` to ``first[k + 1]`` are the children of node k; the roots come before node 0's children."""

    def __init__(self, entries: Iterable[str]):
        words = sorted({e for e in entries if e})
        longest = max(map(len, words), default=0)
        # code points, shorter words padded with -1, so rows are sorted as the words are
        codes = np.full((len(words), longest), -1, dtype=np.int32)
        for k, word in enumerate(words):
            codes[k, : len(word)] = [ord(c) for c in word]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        labels, first, ends = array("i"), array("q"), bytearray()
        opens = np.zeros(len(words), dtype=bool)
        if len(words):
            opens[0] = True
        parents = np.zeros(0, dtype=np.int64)
        self.roots = 0
        for depth in range(longest):
            rows = np.flatnonzero(lengths > depth)
            opens[1:] |= codes[1:, depth] != codes[:-1, depth]
            # a node begins where a row differs from the row before it in this character or an earlier one
            starts = rows[opens[rows]]
            nodes = np.cumsum(opens[rows]) - 1
            if depth:
                counts = np.bincount(parents[starts], minlength=previous)
                base = len(labels)
                first.extend((base + np.concatenate([[0], np.cumsum(counts)[:-1]])).tolist())
            else:
                self.roots = len(starts)
            labels.extend(codes[starts, depth].tolist())
            terminal = np.zeros(len(starts), dtype=np.uint8)
            done = lengths[rows] == depth + 1
            terminal[nodes[done]] = 1
            ends += terminal.tobytes()
            parents = np.zeros(len(words), dtype=np.int64)
            parents[rows] = nodes
            previous = len(starts)
        # the last level has no children
        first.extend([len(labels)] * (len(labels) - len(first) + 1))
        self.labels, self.first, self.ends = labels, first, bytes(ends)

    def longest_prefix(self, word: str) -> int:
        """Characters of the longest entry that the word begins with; 0 without one."""
        labels, first, ends = self.labels, self.first, self.ends
        low, high, best = 0, self.roots, 0
        for k, character in enumerate(word, 1):
            code = ord(character)
            at = bisect_left(labels, code, low, high)
            if at == high or labels[at] != code:
                break
            if ends[at]:
                best = k
            low, high = first[at], first[at + 1]
        return best


def prefix_lengths(spark: SparkSession, trie: Trie) -> "Column":
    """A function of an array of words: the length of each one's longest entry. Batches of words are bounded in rows and bytes."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(trie)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find, known = shared.value.longest_prefix, {}
        for batch in batches:
            out = []
            for words in batch:
                if words is None:
                    out.append(None)
                    continue
                if len(known) > REMEMBERED:
                    known.clear()
                lengths = []
                for word in words:
                    length = known.get(word)
                    if length is None:
                        length = known[word] = find(word)
                    lengths.append(length)
                out.append(lengths)
            yield pd.Series(out)

    return F.pandas_udf(run, "array<int>")


def register_prefix_split(spark: SparkSession, dictionary: DataFrame, word: str = "word", name: str = "dictionary_prefixes") -> None:
    """A table function for SQL: ``dictionary_prefixes(text)`` gives (at, word, prefix) for the words between blanks of a text,
    ``prefix`` being the length of the longest entry that the word begins with."""
    shared = spark.sparkContext.broadcast(Trie(row[0] for row in dictionary.select(word).where(F.col(word).isNotNull()).distinct().collect()))

    class Prefixes:
        def eval(self, text: str):
            if text is not None:
                find = shared.value.longest_prefix
                for at, part in enumerate(text.split(" ")):
                    if part:
                        yield at, part, find(part)

    spark.udtf.register(name, F.udtf(Prefixes, returnType="at int, word string, prefix int"))
