"""Timestamps of aligned words: repair of non-monotonic predictions and pairing with the words."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType

from voxloom.functions.binding import bind


def longest_monotone(values) -> np.ndarray:
    """Mask of a longest non-decreasing subsequence in O(n log n).

    Ties: of all subsequences of full length the one with the earliest end wins, and each element takes its earliest
    possible parent. Elements of one length class have strictly falling values from left to right, so the earliest
    parent of a value is found by bisection in the class below. Values at the head that none behind is below, and at the end
    that none before is above, are in every longest subsequence, so only what lies between is searched.
    """
    mask = np.ones(len(values), dtype=bool)
    if len(values) == 0:
        return mask
    whole = np.asarray(values)
    head = _leading(whole == np.minimum.accumulate(whole[::-1])[::-1])
    end = len(mask) - _leading((whole == np.maximum.accumulate(whole))[::-1])
    if head < end:
        mask[head:end] = _searched(values[head:end])
    return mask


def _leading(true: np.ndarray) -> int:
    """How many values are true before the first that is not."""
    return len(true) if true.all() else int(true.argmin())


def _searched(values) -> np.ndarray:
    """The mask by patience sorting; at least one value."""
    mask = np.zeros(len(values), dtype=bool)
    tails: list = []
    classes: list[tuple[list, list]] = []
    parent = np.empty(len(values), dtype=np.int64)
    for i, v in enumerate(values):
        rank = bisect_right(tails, v)
        if rank == len(tails):
            tails.append(v)
            classes.append(([], []))
        else:
            tails[rank] = v
        if rank:
            below, where = classes[rank - 1]
            parent[i] = where[bisect_left(below, -v)]
        else:
            parent[i] = -1
        falling, index = classes[rank]
        falling.append(-v)
        index.append(i)
    at = classes[-1][1][0]
    while at >= 0:
        mask[at] = True
        at = parent[at]
    return mask


def repair_values(values) -> np.ndarray:
    """Replace the values off the longest monotone subsequence, then truncate to integers.

    A gap of one or two takes the nearer good neighbour, the left one on ties; a longer gap is interpolated; a gap at
    an edge copies its only neighbour.
    """
    v = np.asarray(values, dtype=np.float64)
    good = longest_monotone(v.tolist())
    if good.all():
        return v.astype(np.int64)
    at = np.arange(len(v))
    anchors = np.flatnonzero(good)
    slot = np.searchsorted(anchors, at)
    left = np.where(slot > 0, anchors[np.maximum(slot - 1, 0)], -1)
    right = np.where(slot < len(anchors), anchors[np.minimum(slot, len(anchors) - 1)], -1)
    lv, rv = v[left], v[right]
    gap = right - left - 1
    near = np.where(at - left <= right - at, lv, rv)
    line = lv + (rv - lv) / (gap + 1) * (at - left)
    filled = np.where(left < 0, rv, np.where(right < 0, lv, np.where(gap <= 2, near, line)))
    return np.where(good, v, filled).astype(np.int64)


def repaired_lists(slots: pa.ListArray, segment_ms: float) -> pa.ListArray:
    """Slot numbers as milliseconds, cut to integers, then ``repair_timestamps`` for lists that a worker holds already."""
    ms = pc.cast(pc.multiply(pc.cast(slots.values, pa.float64(), safe=False), float(segment_ms)), pa.int64(), safe=False)
    ends, none = slots.offsets.to_numpy(), slots.is_null()
    if ms.null_count:
        rows = [None if n else ms[a:b].to_pylist() for a, b, n in zip(ends, ends[1:], none.to_pylist())]
        # as in the JVM, an empty value goes before all others
        in_order = [r is None or r == sorted(r, key=lambda x: (x is not None, x or 0)) for r in rows]
        return pa.array([r if good else repair_values(r) for r, good in zip(rows, in_order)], type=slots.type)
    flat = ms.to_numpy().copy()
    dips = np.flatnonzero(flat[1:] < flat[:-1]) + 1
    # a fall from one list to the next is none
    for k in np.unique(np.searchsorted(ends, dips[~np.isin(dips, ends)], side="right") - 1).tolist():
        flat[ends[k] : ends[k + 1]] = repair_values(flat[ends[k] : ends[k + 1]])
    return pa.ListArray.from_arrays(slots.offsets, pa.array(flat), mask=none if slots.null_count else None)


@F.pandas_udf(ArrayType(BooleanType()))
def monotone_keep_mask(values: pd.Series) -> pd.Series:
    return values.map(lambda v: longest_monotone(list(v)))


@F.pandas_udf(ArrayType(LongType()))
def _repaired(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else repair_values(v))


def repair_timestamps(values: Column | str) -> Column:
    """``repair_values`` of integer lists. A list that is in order is its own repair: that is told in the JVM, by sorting what
    is sorted already, and only lists with a dip travel to Python."""
    column = F.col(values) if isinstance(values, str) else values

    def repaired_or_null(v: Column) -> Column:
        return F.when(F.sort_array(v) != v, v)

    return F.coalesce(_repaired(bind(column, repaired_or_null)), column)


def pair_timestamps(words: Column, millis: Column, offset: Column | None = None) -> Column:
    """Word i spans the values 2i and 2i+1: seconds rounded to 3 places, then shifted by the chunk offset."""

    def spans(ms: Column) -> Column:
        def seconds(index: Column) -> Column:
            s = F.bround(F.get(ms, index) / F.lit(1000.0), 3)
            return s if offset is None else F.bround(s + offset, 3)

        return F.transform(
            words,
            lambda w, i: F.struct(
                w.alias("text"), seconds(i * 2).alias("start_time"), seconds(i * 2 + 1).alias("end_time")
            ),
        )

    return bind(millis, spans)
