"""N-gram Jaccard join with count vectors in R-trees, and its components.

A document's set holds its distinct word shingles. Shingles are hashed into groups; the counts per group are a point,
and the sum of the coordinate minima of two points bounds the overlap of two sets from above. The points are packed
into R-trees, whose nodes keep the largest count per group and the smallest size, so a search drops every node that
can't hold enough overlap. What survives is verified on the sets themselves.

How it is spread out: one tree over the whole table would be one task's work, so there is a tree per cell. Cells come
from an exact filter: linked sets share one of their first (1 - t) n + 1 shingles in any common order. The order is
rare first, by two hashed counts over the whole table: shingles that are far more frequent than usual come last, the rest
goes by the frequency of its words. A cell is one such shingle and a band of sizes, so wide that linked sets lie in one or in
two adjacent bands; a set enters the cell of its band and of the next. Cells are found and emptied of lone sets with narrow
rows; points go only where two sets of like size share a shingle. A point has more groups the larger its set, so long
documents are told apart as short ones are, and a finer point is folded onto a coarser one by adding neighbours. Equal sets are one class and take part once, whatever their number. The trees leave
pairs that may be linked; their components are small clusters, and the texts of their members, one per class, go
to their cluster to be verified. In cells and clusters alike, pairs that are already connected are not compared
again, and only links that join two components come out, fewer than there are members. A cell or cluster above a fixed
size is cut into blocks, and each pair of blocks is a task of its own, so no task holds an unbounded group, and every
pair still meets.

With ``links`` no pair is passed by: the same clusters are verified pair by pair, every pair in one task only, and what comes
out is the number of links of each class (its links weighted by the number of documents in the other class), so the output
does not grow with the square of a group. The work of verifying does, where a group really has that many links.

Sets are compared by 64-bit shingle hashes; classes by 128 bits over the set.

Defined results: a text with fewer words than a shingle is one shingle; without words, or null, the set is empty and linked
with nothing. Rows without an id take part in nothing and have no component. Rows that share an id are one document
with several texts, which the id connects. Equal rows fall into one class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.components import components
from voxloom.session import materialize, release_since, written

COUNTERS = 1 << 16
SHINGLE_COUNTERS = 1 << 20
#: Counters that travel as one row.
COUNTER_BLOCK = 1 << 12
#: Groups of a small set's point, shingles a group of larger sets, and most groups.
GROUPS, PER_GROUP, MOST_GROUPS = 64, 8, 4096
FANOUT = 8
POINT_CELLS = 1 << 24
#: Points of a block of a cell, and shingles of a block of a cluster (8 bytes each, and the texts they come from).
CELL_POINTS = 20_000
CLUSTER_SHINGLES = 4_000_000
#: Rows, of 64 bits each, of the table that tells which texts may be in a cluster.
MARK_ROWS = 1 << 18
CACHE_WORDS = 1_000_000
#: Odd multipliers of 64-bit mixing (the constants of a published finaliser), fixed values.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[0]
        x = (x ^ (x >> np.uint64(27))) * MIX[1]
        return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of the words of texts, kept for the words seen."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        known = self._known
        try:
            found = [known[w] for w in words]
        except KeyError:
            if len(known) > CACHE_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            found = [known[w] for w in words]
        return np.array(found, dtype=np.uint64)


def shingles(words: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Hashes of all shingles in order, and how many words each spans."""
    span = min(width, len(words))
    if not span:
        return np.zeros(0, dtype=np.uint64), 0
    total = np.full(len(words) - span + 1, span, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(span):
            total = mixed(total + words[k : len(words) - span + 1 + k] + MIX[2])
    return total, span


def _slots(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - counters.bit_length() + 1)).astype(np.int64)


def _blocks_of(kind: int, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for at in range(0, len(counts), COUNTER_BLOCK):
        part = counts[at : at + COUNTER_BLOCK]
        if part.any():
            yield kind << 32 | at, part.tobytes()


def frequencies(df: DataFrame, text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole logarithms of the counts of all words of the table, and by how many powers of two above four times the mean
    the counts of its shingles are, both in hashed counters of a fixed number. Counters travel in blocks, and blocks are
    added up as they come in."""

    def packed(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], type=pa.int64()), pa.array([r[1] for r in rows], type=pa.binary())],
            names=["block", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        of_words, of_shingles = np.zeros(COUNTERS, dtype=np.int64), np.zeros(SHINGLE_COUNTERS, dtype=np.int64)
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        waiting = 0

        def added() -> None:
            for parts, counts in zip(held, (of_words, of_shingles)):
                if parts:
                    counts += np.bincount(np.concatenate(parts), minlength=len(counts))
                    parts.clear()

        for batch in batches:
            for value in batch.column(0).to_pylist():
                hashes = words.hashes(value or "")
                held[0].append(_slots(hashes, COUNTERS))
                held[1].append(_slots(shingles(hashes, width)[0], SHINGLE_COUNTERS))
                waiting += len(hashes)
                # as many at once as there are counters to go over
                if waiting >= SHINGLE_COUNTERS:
                    added()
                    waiting = 0
        added()
        yield packed([*_blocks_of(0, of_words), *_blocks_of(1, of_shingles)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, dtype=np.int64)
                sums[block] = sums[block] + part if block in sums else part
        yield packed([(block, part.tobytes()) for block, part in sums.items()])

    schema = "block bigint, counts binary"
    counted = df.select(F.col(text).cast("string")).mapInArrow(count, schema)
    found = counted.repartition("block").mapInArrow(add, schema).toArrow()
    totals = [np.zeros(COUNTERS, dtype=np.int64), np.zeros(SHINGLE_COUNTERS, dtype=np.int64)]
    for block, counts in zip(found.column("block").to_pylist(), found.column("counts").to_pylist()):
        at = block & 0xFFFFFFFF
        totals[block >> 32][at : at + COUNTER_BLOCK] = np.frombuffer(counts, dtype=np.int64)
    usual = max(1.0, 4 * float(totals[1].mean()))
    above = np.log2(np.maximum(totals[1] / usual, 1)).astype(np.int64)
    return np.log2(np.maximum(totals[0], 1)).astype(np.int64), above


def signatures(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(key, n, hi, lo, keys, band, point): size and 128-bit hash of a document's set, the shingles it is looked up by, its band
    of sizes, and its counts per group."""
    shared = df.sparkSession.sparkContext.broadcast(frequencies(df, text, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (levels, above) = Words(), shared.value
        none = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            sizes, highs, lows, keys, bands, points = [], [], [], [], [], []
            for value in batch.column(1).to_pylist():
                hashes = words.hashes(value or "")
                found, span = shingles(hashes, width)
                distinct, first = np.unique(found, return_index=True)
                n = len(distinct)
                sizes.append(n)
                bands.append(band_of(n, percent))
                points.append(packed_point(distinct, bands[-1], percent) if n else b"")
                if n:
                    with np.errstate(over="ignore"):
                        lows.append(np.add.reduce(mixed(distinct ^ MIX[0])).view(np.int64))
                        highs.append(np.add.reduce(mixed(distinct ^ MIX[1])).view(np.int64))
                    level = levels[_slots(hashes, COUNTERS)]
                    rank = np.zeros(len(found), dtype=np.int64)
                    for k in range(span):
                        rank += level[k : k + len(found)]
                    wanted = n + 1 - -(-percent * n // 100)
                    order = np.lexsort((distinct, rank[first], above[_slots(distinct, SHINGLE_COUNTERS)]))
                    keys.append(distinct[order[:wanted]].view(np.int64))
                else:
                    lows.append(np.int64(0))
                    highs.append(np.int64(0))
                    keys.append(none.view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
            flat = np.concatenate(keys) if keys else none.view(np.int64)
            arrays = [
                batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(highs, type=pa.int64()),
                pa.array(lows, type=pa.int64()), pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(flat)),
                pa.array(bands, type=pa.int32()), pa.array(points, type=pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "hi", "lo", "keys", "band", "point"])

    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "key bigint, n bigint, hi bigint, lo bigint, keys array<bigint>, band int, point binary")


def point_of(distinct: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount(_slots(distinct, groups), minlength=groups).astype(np.int32)


def band_of(n: int, percent: int) -> int:
    """Bands a little wider than the ratio that linked sizes may have, so rounding never puts them further apart than one."""
    return int(np.log(n) / (1.0001 * np.log(100 / percent))) if n and percent < 100 else n


def packed_point(distinct: np.ndarray, band: int, percent: int) -> bytes:
    """Counts per group as single bytes behind the unit they are counted in; rounded up, so that sums stay upper bounds. All
    sets of a band have the same number of groups, and a higher band has no fewer."""
    low = np.exp(band * 1.0001 * np.log(100 / percent)) if percent < 100 else band
    wanted = int(low) // PER_GROUP
    counts = point_of(distinct, 1 << min(max(wanted.bit_length(), GROUPS.bit_length()) - 1, MOST_GROUPS.bit_length() - 1))
    unit = -(-int(counts.max()) // 255) or 1
    return np.uint32(unit).tobytes() + (-(-counts // unit)).astype(np.uint8).tobytes()


def unpacked_points(packed: Sequence[bytes]) -> np.ndarray:
    """Points of one cell, folded onto the fewest groups that one of them has."""
    groups = min(map(len, packed)) - 4
    points = np.empty((len(packed), groups), dtype=np.int32)
    for k, data in enumerate(packed):
        counts = np.frombuffer(data, dtype=np.uint8, offset=4).astype(np.int32) * int(np.frombuffer(data, dtype=np.uint32, count=1)[0])
        points[k] = counts.reshape(groups, -1).sum(axis=1)
    return points


def groups_for(sizes: np.ndarray) -> int:
    """Groups that tell the largest of some sets apart (a few shingles each), within ``POINT_CELLS`` counts in all."""
    wanted = min(int(sizes.max()) // 4, POINT_CELLS // len(sizes))
    return 1 << min(max(wanted.bit_length(), GROUPS.bit_length()) - 1, 12)


class CountTree:
    """R-tree over points of group counts, packed from the points sorted by size and by their most varied group."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        order = np.argsort(sizes, kind="stable")
        slab = FANOUT * FANOUT
        for at in range(0, len(order), slab):
            part = order[at : at + slab]
            group = int(points[part].var(axis=0).argmax())
            order[at : at + slab] = part[np.argsort(points[part, group], kind="stable")]
        self.order = order
        #: per level: largest count per group, smallest and largest size of each node; leaves hold places in ``order``
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        top, least, most = points[order], sizes[order], sizes[order]
        while len(top) > FANOUT:
            starts = np.arange(0, len(top), FANOUT)
            top = np.maximum.reduceat(top, starts)
            least, most = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
            self.levels.append((top, least, most))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points whose overlap bound reaches what a link with this one needs."""
        nodes = None
        for top, least, most in reversed(self.levels):
            nodes = np.arange(len(top)) if nodes is None else nodes[nodes < len(top)]
            # sizes first: neither set can be below the share of the other
            nodes = nodes[(100 * most[nodes] >= percent * size) & (percent * least[nodes] <= 100 * size)]
            bound = np.minimum(top[nodes], point).sum(axis=1)
            nodes = nodes[bound * (100 + percent) >= percent * (size + least[nodes])]
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        members = self.order if nodes is None else self.order[nodes[nodes < len(self.order)]]
        own = self.sizes[members]
        members = members[(100 * own >= percent * size) & (percent * own <= 100 * size)]
        bound = np.minimum(self.points[members], point).sum(axis=1)
        return members[bound * (100 + percent) >= percent * (size + self.sizes[members])]


def connected(points: np.ndarray, sizes: np.ndarray, percent: int, verified: Callable[[int, int], bool]) -> np.ndarray:
    """Component number of every point. Pairs that the tree leaves are verified; those inside a component are passed by."""
    tree = CountTree(points, sizes)
    of = np.arange(len(sizes))
    for k in range(len(sizes)):
        near = tree.search(points[k], int(sizes[k]), percent)
        # pairs are looked at from their larger number
        near = near[(near < k) & (of[near] != of[k])]
        for j in near.tolist():
            if of[j] != of[k] and verified(k, j):
                of[of == of[j]] = of[k]
    return of


def joined_components(sets: Sequence[np.ndarray], percent: int) -> np.ndarray:
    """Component number of every set: linked sets share one."""

    def linked(k: int, j: int) -> bool:
        both = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
        return 100 * both >= percent * (len(sets[k]) + len(sets[j]) - both)

    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    groups = groups_for(sizes)
    return connected(np.vstack([point_of(s, groups) for s in sets]), sizes, percent, linked)


def all_links(
    sets: Sequence[np.ndarray], weights: np.ndarray, sides: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Component number of every set, and the summed weights of all sets it is linked with. Every pair that the tree leaves
    is verified, but for those of one side, unless the side is -1."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    points = np.vstack([point_of(s, groups_for(sizes)) for s in sets])
    tree = CountTree(points, sizes)
    distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(places.astype(np.int32), np.cumsum(sizes)[:-1])
    held = np.zeros(len(distinct), dtype=bool)
    of, total = np.arange(len(sets)), np.zeros(len(sets), dtype=np.int64)
    for k in range(len(sets)):
        near = tree.search(points[k], int(sizes[k]), percent)
        near = near[(near < k) & ((sides[near] != sides[k]) | (sides[k] == -1))]
        if not len(near):
            continue
        held[own[k]] = True
        starts = np.cumsum(sizes[near]) - sizes[near]
        both = np.add.reduceat(held[np.concatenate([own[j] for j in near.tolist()])], starts, dtype=np.int64)
        held[own[k]] = False
        linked = near[100 * both >= percent * (sizes[k] + sizes[near] - both)]
        total[k] += weights[linked].sum()
        total[linked] += weights[k]
        for c in np.unique(of[linked]).tolist():
            of[of == c] = of[k]
    return of, total


def _stars(ids: list[int], of: np.ndarray) -> list[tuple[int, int]]:
    """Each member of a component with its first one."""
    first: dict[int, int] = {}
    pairs = [(i, first.setdefault(c, i)) for i, c in zip(ids, of.tolist())]
    return [(u, v) for u, v in pairs if u != v]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], type=pa.int64()) for k in (0, 1)], names=["u", "v"])


def merged(df: DataFrame) -> DataFrame:
    """To be joined by sorting both sides. What is joined here grows with the table; the planner, who goes by the size of compressed
    files and takes a list for one value, thinks it small and would send it through the driver."""
    return df.hint("merge")


def in_groups(
    rows: DataFrame, group: str, weight: str, most: int, salt: str, own: Column | None = None,
    wide: DataFrame | None = None, on: str | None = None,
) -> DataFrame:
    """Rows sorted by (group, i, j). A group whose summed weight is above ``most`` is cut into blocks by a hash, and each pair
    of its blocks is a group of its own; rows whose group has no other row, or none that is its ``own``, are left out.
    ``side`` is the block of a row, or -1 where a block meets itself. ``wide`` is joined by ``on`` to the rows that are left, so only they carry it."""
    owned = F.lit(True) if own is None else own
    sizes = (
        rows.groupBy(group).agg(F.sum(weight).alias("_w"), F.count(F.lit(1)).alias("_m"), F.count_if(owned).alias("_o"))
        .where((F.col("_m") > 1) & (F.col("_o") > 0))
    )
    blocks = sizes.select(group, F.ceil(F.col("_w") / most).cast("int").alias("_blocks"))
    mine = F.pmod(F.xxhash64(salt), F.col("_blocks")).cast("int")
    met = rows.join(merged(blocks), group).withColumn("_mine", mine).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    side = F.when(F.col("_mine") == F.col("_other"), F.lit(-1)).otherwise(F.col("_mine"))
    pair = met.select(
        *rows.columns, side.alias("side"), F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j")
    )
    if wide is not None:
        pair = pair.join(merged(wide), on)
    return pair.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def by_group(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[list[tuple]]:
    """The rows of each (group, i, j) in turn, without these columns; rows of a group lie together."""
    current, held = None, []
    for batch in batches:
        marks = zip(*[batch.column(c).to_pylist() for c in (group, "i", "j")])
        others = [c for c in batch.schema.names if c not in (group, "i", "j")]
        for mark, row in zip(marks, zip(*[batch.column(c).to_pylist() for c in others])):
            if mark != current:
                if held:
                    yield held
                current, held = mark, []
            held.append(row)
    if held:
        yield held


def maybe_in(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among those of ``members``: all that are and, by chance, some others, so a join by the key has to
    follow. It is told by marks in a table of bounded size that is broadcast, and only rows that are left are shuffled."""
    block = F.pmod(F.xxhash64(key), F.lit(MARK_ROWS)).alias("_block")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(64)).cast("int"))
    marks = members.select(block, bit.alias("_bit")).groupBy("_block").agg(F.bit_or("_bit").alias("_bits"))
    marked = rows.withColumn("_block", block).join(F.broadcast(marks), "_block")
    return marked.where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)


def clusters(signed: DataFrame, percent: int) -> DataFrame:
    """(lo, cluster) for the classes with a pair that shares a key and has enough room for a link by its counts."""
    place = written()
    usable = signed.where(F.col("key").isNotNull() & (F.col("n") > 0))
    rows = usable.select(F.explode("keys").alias("k"), "lo", "band")
    shared = rows.groupBy("k").agg(F.min("lo").alias("a"), F.max("lo").alias("b")).where(F.col("a") < F.col("b")).select("k")
    # read twice, to size the cells and to fill them
    cells = materialize(rows.join(merged(shared), "k").distinct(), "jaccard-cells")
    # two cells that share a hash are one cell with more to compare
    both = cells.select("lo", "k", "band", F.explode(F.array("band", F.col("band") + 1)).alias("at"))
    placed = both.select(F.xxhash64("k", "at").alias("cell"), "lo", (F.col("band") == F.col("at")).alias("own"), F.lit(1).alias("one"))
    points = usable.groupBy("lo").agg(F.first("n").alias("n"), F.first("point").alias("point"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for members in by_group(batches, "cell"):
            # (lo, side, n, point)
            sizes = np.array([m[2] for m in members], dtype=np.int64)
            out += _stars([m[0] for m in members], connected(unpacked_points([m[3] for m in members]), sizes, percent, lambda k, j: True))
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    met = in_groups(placed, "cell", "one", CELL_POINTS, "lo", F.col("own"), points, "lo").select("cell", "i", "j", "lo", "side", "n", "point")
    edges = met.mapInArrow(run, "u bigint, v bigint")
    found = components(edges, "jaccard-clusters").select(F.col("node").alias("lo"), F.col("root").alias("cluster"))
    release_since(signed.sparkSession, place, found)
    return found


def class_rows(signed: DataFrame) -> DataFrame:
    """(hi, lo, key, n, docs): the smallest id, the size of the set and the number of ids of each class."""
    ids = signed.where(F.col("key").isNotNull() & (F.col("n") > 0)).groupBy("hi", "lo", "key").agg(F.max("n").alias("n"))
    return ids.groupBy("hi", "lo").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.count(F.lit(1)).alias("docs"))


def links(
    df: DataFrame, key: str, text: str, signed: DataFrame, width: int, percent: int, counted: bool = False
) -> DataFrame:
    """(u, v): ids of class representatives, enough verified links to connect what is linked.

    ``counted`` verifies all pairs and adds (hi, lo, linked): parts of the number of documents in classes linked with a class.
    """
    member = class_rows(signed).join(merged(clusters(signed, percent)), "lo").select("cluster", "key", "hi", "lo", "n", "docs")
    member = materialize(member, "jaccard-members")
    texts = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    kinds = "u bigint, v bigint" + ", hi bigint, lo bigint, linked bigint" * counted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for members in by_group(batches, "cluster"):
            ids, sets, classes, weights, sides = [], [], {}, [], []
            for k, hi, lo, docs, value, side in members:
                # repeated rows of an id
                if (hi, lo) in classes:
                    continue
                found = np.unique(shingles(words.hashes(value or ""), width)[0])
                with np.errstate(over="ignore"):
                    same = (
                        np.add.reduce(mixed(found ^ MIX[0])).view(np.int64) == lo
                        and np.add.reduce(mixed(found ^ MIX[1])).view(np.int64) == hi
                    )
                # another text under the same id belongs to another class
                if same:
                    ids.append(k)
                    sets.append(found)
                    classes[hi, lo] = None
                    weights.append(docs)
                    sides.append(side)
            if len(ids) > 1 and not counted:
                yield _edges(_stars(ids, joined_components(sets, percent)))
            elif len(ids) > 1:
                of, total = all_links(sets, np.array(weights, dtype=np.int64), np.array(sides), percent)
                first: dict[int, int] = {}
                roots = [first.setdefault(c, k) for k, c in zip(ids, of.tolist())]
                columns = [ids, roots, [c[0] for c in classes], [c[1] for c in classes], total]
                arrays = [pa.array(c, type=pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["u", "v", "hi", "lo", "linked"])

    sent = in_groups(member, "cluster", "n", CLUSTER_SHINGLES, "hi", wide=maybe_in(texts, member, "key"), on="key")
    return sent.select("cluster", "i", "j", "key", "hi", "lo", "docs", "text", "side").mapInArrow(run, kinds)


def jaccard_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, counted: bool = False
) -> DataFrame:
    """(key, n_shingles, component_id), one row per row: documents link when ``100 * both >= percent * either``.

    ``counted`` adds ``n_links``, how many other documents the row's text is linked with; an id with several texts counts
    once for each of them that differs as a set.
    """
    signed = materialize(signatures(df, key, text, width, percent), "jaccard-sets")
    classes = class_rows(signed).select("hi", "lo", F.col("key").alias("rep"), "docs")
    # a text and its class are connected by the id, so ids with several texts connect their classes
    copies = signed.where(F.col("n") > 0).join(merged(classes), ["hi", "lo"]).select(F.col("key").alias("u"), F.col("rep").alias("v"))
    found = links(df, key, text, signed, width, percent, counted)
    if counted:
        found = materialize(found, "jaccard-links")
    whole = components(found.select("u", "v").unionAll(copies), "jaccard-components")
    rows = signed.select("key", "n")
    if counted:
        others = found.groupBy("hi", "lo").agg(F.sum("linked").alias("linked"))
        numbers = classes.join(merged(others), ["hi", "lo"], "left").select(
            "hi", "lo", (F.col("docs") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
        )
        # a row without an id or a word is in no class
        numbered = signed.where(F.col("key").isNotNull() & (F.col("n") > 0)).join(merged(numbers), ["hi", "lo"])
        rest = signed.where(F.col("key").isNull() | (F.col("n") == 0)).select("key", "n", F.lit(0).cast("bigint").alias("n_links"))
        rows = numbered.select("key", "n", "n_links").unionAll(rest)
    return rows.join(merged(whole), rows["key"] == whole["node"], "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "key").alias("component_id"),
        *(["n_links"] if counted else []),
    )


# --- the query -------------------------------------------------------------------------------------------------------


def query(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs.select("doc_id", "text"), counted=True)
