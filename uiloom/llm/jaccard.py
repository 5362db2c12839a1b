"""Exact Jaccard join of documents as sets of word shingles, in the metric space of Jaccard distances.

1. Cover. Random documents are at distance 1 from each other, where pivots separate nothing. The space is
   therefore first covered by one region for each shingle that several sets have among their |x| - ceil(t |x|) + 1
   first ones. Two sets with similarity t or more share one of these under any common order of shingles, so no link
   is lost. The order puts shingles first that are rare in a sample, then goes by hash; it decides the
   cost, never the result. Of regions with the same members the first in that order is kept.
2. Voronoi cells. A region of more than LEAF sets is split: PIVOTS members are chosen by hash, the Jaccard distances of all members
   to them are measured, and a member becomes a native of the cell of its nearest pivot, or of
   the region's outer cell if that is farther than RADIUS. With T = 1 - t, a link between natives of two cells i < j means, by the triangle
   inequality, that the first one is at most 2 T nearer to its own pivot than to the other and within RADIUS + T of that,
   or for the outer cell farther than RADIUS - T from its own. Members in such a window are replicated into
   the other cell. Cells that are still too large are split again, with other pivots.
   A cell that holds more than PROGRESS of the one it came from is not split further. Beyond HARD sets it is dealt into pairs of blocks:
   that is exact as well, but its rows grow with the square of the number of blocks.
3. Join in the leaves. A task holds a leaf and rules pairs out by their sizes, by the place of the region's shingle in both sets, by
   their distances to the cell's pivot, and by projections onto hash classes, whose summed differences bound the number of
   shingles in one set only. Of what is left, a forest of the nearest pairs goes to an exact measurement and gives the first links.
   Where sets of one leaf then still have different labels and are not ruled out, the
   sets themselves are taken into the leaf and compared there. So rows grow with the members of the leaves, not with their pairs.

Documents with equal sets are one node, numbered by 64 bits of a digest of the set; shingles are 64-bit hashes.

Edge cases: a null text has no words; documents without words have an empty set, link with nothing and are their own component. Very long texts
are sets like others (a leaf is bounded by its shingles too). Repeated rows and repeated ids are allowed, each row gets its own result; a null id takes no part in the
smallest id of a component, which is null if all its ids are. Further columns are kept; those named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uiloom.llm.common import draw, likely, outer, scratch, stage, whole_groups, without
from uiloom.llm.components import components

#: Sampled documents (about), sampled documents that make a shingle common, and most common shingles kept.
SAMPLE, COMMON, MOST_COMMON = 20_000, 2, 300_000
#: Sets in a leaf before it is split, sets and shingles that a leaf may hold, pivots of a split, its radius, and levels of splits.
LEAF, HARD, HARD_SHINGLES, PIVOTS, RADIUS, LEVELS, PROGRESS = 512, 4096, 4_000_000, 4, 0.5, 4, 0.8
KEEP_WORDS = 500_000
SLACK = 1e-9
P1, P2, P3, P4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class WordHashes(dict):
    """64-bit hashes of words, as far as the table is not full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * P3
        h = (h ^ (h >> np.uint64(27))) * P4
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the words are those of bytes.split(), A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.array([], "u8")
    h = np.fromiter(map(_hashes.__getitem__, words), "u8", len(words))
    n = max(1, len(h) - size + 1)
    length = min(size, len(h))
    with np.errstate(over="ignore"):
        out = np.full(n, length, "u8")
        for k in range(length):
            out = (out ^ (out >> np.uint64(29))) * P1 + h[k : n + k] * P2
    return np.unique(mix(out))


def node_id(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix(own: np.ndarray, percent: int, common: np.ndarray, level: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """The first |x| - ceil(t |x|) + 1 shingles in the common order."""
    n = len(own)
    if not n:
        return own
    length = n - -(-percent * n // 100) + 1
    hits = np.flatnonzero(maybe[(own & np.uint64(len(maybe) - 1)).astype("i8")])
    if not len(hits) or not len(common):
        return own[:length]  # sorted by hash
    at = np.minimum(np.searchsorted(common, own[hits]), len(common) - 1)
    rank = np.zeros(n, "i8")
    rank[hits] = np.where(common[at] == own[hits], level[at], 0)
    return own[np.argsort(rank, kind="stable")[:length]]


def common_shingles(df: DataFrame, id_col: str, text_col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles of a bounded sample, sorted, and how common they are as a power of two."""
    share = min(1.0, SAMPLE / max(1, df.count()))
    drawn = df.where(draw(id_col, text_col) <= share).select(F.col(text_col).alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py(), size).view("i8"))], names=["shingle"])

    counted = drawn.mapInArrow(sets, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = counted.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()
    found, n = rows.column("shingle").to_numpy().view("u8"), rows.column("n").to_numpy()
    order = np.argsort(found)
    return found[order], np.floor(np.log2(np.maximum(n, 1))).astype("i8")[order] + 1


def projection(own: np.ndarray) -> np.ndarray:
    """How many shingles are in each hash class; more classes for larger sets, at most 65,535 counted in each."""
    bits = 7 if len(own) <= 1 << 10 else 9 if len(own) <= 1 << 12 else 11 if len(own) <= 1 << 14 else 13
    return np.minimum(np.bincount((own >> np.uint64(64 - bits)).astype("i8"), minlength=1 << bits), 65_535).astype("<u2")


def summaries(df: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """row (all columns of df), key (a number of the row), n_shingles, node, first (its prefix) and classes (its projection)."""
    common, level = common_shingles(df, id_col, text_col, size)
    maybe = np.zeros(1 << 22, bool)
    maybe[(common & np.uint64(len(maybe) - 1)).astype("i8")] = True
    shared = df.sparkSession.sparkContext.broadcast((common, level, maybe))  # MOST_COMMON entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            sizes, nodes, firsts, classes = [], [], [], []
            for text in batch.column(0).field(place):
                own = shingles(text.as_py(), size)
                sizes.append(len(own))
                nodes.append(node_id(own))
                firsts.append(prefix(own, percent, *order).view("i8"))
                classes.append(projection(own).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(classes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "n_shingles", "node", "first", "classes"])

    place = df.columns.index(text_col)
    source = df.select(F.struct(*(df[c] for c in df.columns)).alias("row"), F.monotonically_increasing_id().alias("key"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, key long, n_shingles long, node long, first array<long>, classes binary")


def projections(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and classes for the wanted nodes (node, key)."""
    return stage(likely(base.select("key", "classes"), wanted, "key").join(wanted, "key").select("node", "classes"), "projections")


def sets_of(base: DataFrame, keys: DataFrame, text_col: str, size: int) -> DataFrame:
    """node and own, the hashes of its set, for nodes (node, key); each is read from one of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(text.as_py(), size).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "own"])

    texts = likely(base.select("key", F.col("row").getField(text_col).alias("text")), keys, "key").join(keys, "key")
    return stage(texts.select("node", "text").mapInArrow(run, "node long, own binary"), "sets")


def distinct_sets(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node, n_shingles and first of each set that isn't empty, and keys: node and key of the document that stands for it.
    Prefixes are long, so only those of documents that likely are copies are shuffled."""
    some = base.where("n_shingles > 0")
    keys = stage(some.groupBy("node").agg(F.min("key").alias("key"), F.count("*").alias("copies")), "keys")
    several = keys.where("copies > 1").select("node", F.col("key").alias("lead"))
    copies = stage(some.select("node", "key").join(several, "node").where("key <> lead").select("key"), "copies")
    return without(some.select("key", "node", "n_shingles", "first"), copies, "key").drop("key"), keys.select("node", "key")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with the sizes of their intersection and union."""
    of_b = sets.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    of_a = sets.select(F.col("node").alias("a"), F.col("own").alias("own_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, union = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
                common.append(overlap(x, y))
                union.append(len(x) + len(y) - common[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "common", "all"])

    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "own_a", "own_b")
    return stage(both.mapInArrow(run, "a long, b long, common long, all long"), "measured")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def covering(nodes: DataFrame) -> DataFrame:
    """cell, node, n_shingles, pos (place of the cell's shingle) for the regions that are kept; far and native are for cells of a split."""
    members = nodes.select("node", "n_shingles", F.posexplode("first").alias("pos", "cell"))
    region = Window.partitionBy("cell")
    ends = members.withColumns({"low": F.min("node").over(region), "high": F.max("node").over(region)})
    shared = stage(ends.where("low <> high").drop("low", "high"), "shared")
    of_region = shared.groupBy("cell").agg(
        F.count("*").alias("members"), F.min("node").alias("low"), F.min_by("pos", "node").alias("at"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    # equal members: the place in one of them tells which region comes first in the order of shingles
    kept = stage(of_region.groupBy("members", "low", "x", "y").agg(F.min_by("cell", "at").alias("cell")).select("cell"), "regions")
    rows = shared.join(kept, "cell")
    return stage(rows.withColumns({"native": F.lit(True), "far": F.lit(None).cast("double")}), "members")


def split(cells: DataFrame, measure, percent: int, leaf: int) -> DataFrame:
    """cells with those of more than `leaf` members split by pivots, as far as that makes them smaller."""
    window, done = 1 - percent / 100 + SLACK, []
    cells = cells.withColumn("parent", F.lit(None).cast("long"))
    for level in range(LEVELS):
        sizes = cells.groupBy("cell").agg(F.count("*").alias("members"), F.first("parent").alias("parent"))
        big = stage(sizes.where((F.col("members") > leaf) & F.coalesce(F.col("members") <= PROGRESS * F.col("parent"), F.lit(True))).select("cell", "members"), "large")
        if big.isEmpty():
            break
        done.append(cells.join(big, "cell", "left_anti"))
        inside = cells.drop("parent", "native", "far").join(big, "cell")
        best = [F.min(F.struct(F.xxhash64("node", F.lit(PIVOTS * level + i)), "node")).getField("node") for i in range(PIVOTS)]
        pivots = inside.groupBy("cell").agg(F.array_distinct(F.array(*best)).alias("pivots"))
        placed = stage(inside.join(stage(pivots, "pivots"), "cell").select("*", F.posexplode("pivots").alias("i", "pivot")).drop("pivots"), "placed")
        pairs = placed.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        known = measure(stage(pairs, "pairs"))
        far = known.select(F.col("a").alias("pivot"), F.col("b").alias("node"), (1 - F.col("common") / F.col("all")).alias("d"))
        met = placed.join(far, ["pivot", "node"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
        # PIVOTS entries for each member
        each = met.groupBy("cell", "node").agg(F.first("n_shingles").alias("n_shingles"), F.first("pos").alias("pos"), F.first("members").alias("members"), F.min(F.struct("d", "i")).alias("near"), F.collect_list(F.struct("d", "i")).alias("all"))
        inner, near, last = F.col("near.d") <= RADIUS, F.col("near"), F.lit(PIVOTS)
        place = lambda i, native, d: F.struct(i.alias("i"), F.lit(native).alias("native"), d.alias("far"))
        none = F.lit(None).cast("double")
        own = F.when(inner, place(near["i"], True, near["d"])).otherwise(place(last, True, none))
        visits = F.filter("all", lambda x: inner & (x["i"] > near["i"]) & (x["d"] - near["d"] <= 2 * window) & (x["d"] <= RADIUS + window))
        visits = F.transform(visits, lambda x: place(x["i"], False, x["d"]))
        outside = F.when(inner & (near["d"] > RADIUS - window), F.array(place(last, False, none))).otherwise(F.slice(F.array(place(last, False, none)), 1, 0))
        rows = each.select("cell", "node", "n_shingles", "pos", F.col("members").alias("parent"), F.inline(F.concat(F.array(own), visits, outside)))
        cells = rows.select(F.xxhash64("cell", "i", F.lit(level)).alias("cell"), "node", "n_shingles", "pos", "native", "far", "parent")
        cells = stage(cells.select("node", "n_shingles", "pos", "cell", "native", "far", "parent"), "cells")
    for part in done:
        cells = cells.unionByName(part)
    return cells.drop("parent")


def blocks(cells: DataFrame, hard: int) -> DataFrame:
    """cells with those of more than `hard` members or HARD_SHINGLES shingles dealt into pairs of blocks."""
    sizes = cells.groupBy("cell").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight"))
    need = F.ceil(F.greatest(2 * F.col("members") / hard, 2 * F.col("weight") / HARD_SHINGLES)).cast("int")
    large = stage(sizes.where((F.col("members") > hard) | (F.col("weight") > HARD_SHINGLES)).where("members > 2").select("cell", F.greatest(need, F.lit(3)).alias("blocks")), "large")
    if large.isEmpty():
        return cells
    dealt = cells.join(large, "cell").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
    dealt = dealt.withColumn("cell", F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"), F.lit("blocks")))
    return cells.join(large, "cell", "left_anti").unionByName(dealt.select(*cells.columns))


def possible(tab: pa.Table, percent: int, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one leaf that are not ruled out, and the summed differences of their projections.
    Columns of tab: cell, node, n_shingles, pos, native, far; without a column classes no projections are compared."""
    cell, node, n, pos, native = (tab.column(c).to_numpy() for c in ("cell", "node", "n_shingles", "pos", "native"))
    far = tab.column("far").to_numpy(zero_copy_only=False).astype(float)
    raw = [np.frombuffer(x.as_buffer(), "<u2") for x in tab.column("classes")] if "classes" in tab.column_names else []
    width = np.fromiter(map(len, raw), "i8", len(raw))
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in np.unique(width).tolist():  # rows of this width, and those of the next one, summed to it
        at = np.flatnonzero((width == w) | (width == 4 * w))
        place = np.full(len(raw), -1)
        place[at] = np.arange(len(at))
        tables[w] = place, np.stack([raw[i] if width[i] == w else raw[i].reshape(w, 4).sum(1) for i in at]).astype("i4")
    edges = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
    stop = np.repeat(edges[1:], np.diff(edges))
    window, found = 1 - percent / 100 + SLACK, []
    alive = np.arange(len(cell))
    for lag in count(1):
        alive = alive[alive + lag < stop[alive]]
        if not len(alive):
            break
        i, j = alive, alive + lag
        both = n[i] + n[j]
        with np.errstate(invalid="ignore"):
            ok = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (native[i] | native[j]) & (node[i] != node[j]) & ~(np.abs(far[i] - far[j]) > window)
        # all shingles that both have stand at pos or behind it, unless the pair meets in an earlier region as well
        ok &= np.minimum(n[i] - pos[i], n[j] - pos[j]) * (100 + percent) >= percent * both
        if labels is not None:
            ok &= labels[i] != labels[j]
        i, j, both = i[ok], j[ok], both[ok]
        if not raw:
            found.append((i, j, i[:0]))
            continue
        least = np.minimum(width[i], width[j])
        for w, (place, own) in tables.items():
            for at in np.array_split(np.flatnonzero(least == w), max(1, len(i) * w >> 22)):
                x, y = place[i[at]], place[j[at]]
                sound = (x >= 0) & (y >= 0)  # otherwise their sizes are too far apart for this bound
                apart = np.where(sound, np.abs(own[x] - own[y]).sum(1), 0)
                near = apart * (100 + percent) <= (100 - percent) * both[at]
                found.append((i[at][near], j[at][near], apart[near]))
    if not found:
        return np.array([], "i8"), np.array([], "i8"), np.array([], "i8")
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Forest(dict):
    """Union-find."""

    def root(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = self.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)
        return x != y


LEAF_COLUMNS = ["cell", "node", "n_shingles", "pos", "native", "far"]


def in_leaves(rows: DataFrame) -> DataFrame:
    """Rows of a leaf together and in one task; a leaf is bounded."""
    return rows.repartition("cell").sortWithinPartitions("cell", "node")


def nearest_pairs(leaves: DataFrame, percent: int) -> DataFrame:
    """A forest of the nearest pairs (a, b) that are not ruled out, in each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in whole_groups(batches):
            i, j, apart = possible(tab, percent)
            order = np.lexsort((j, i, apart))
            node = tab.column("node").to_numpy()
            forest = Forest()
            pairs = [(min(a, b), max(a, b)) for a, b in zip(node[i[order]].tolist(), node[j[order]].tolist(), strict=True) if forest.join(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return leaves.mapInArrow(run, "a long, b long").distinct()


def open_members(leaves: DataFrame, percent: int) -> DataFrame:
    """The rows of leaves that have a pair that is not ruled out; if the rows have a label, a pair of two labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in whole_groups(batches):
            i, j, _ = possible(tab, percent, tab.column("label").to_numpy() if "label" in tab.column_names else None)
            yield from tab.take(pa.array(np.unique(np.concatenate((i, j))))).to_batches()

    return leaves.mapInArrow(run, leaves.schema)


def compared(leaves: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels, measured from the sets in each leaf; those that join what is already joined there are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in whole_groups(batches, 2000):
            label, node = tab.column("label").to_numpy(), tab.column("node").to_numpy()
            own = [np.frombuffer(x.as_buffer(), "u8") for x in tab.column("own")]
            i, j, apart = possible(tab, percent, label)
            order = np.lexsort((j, i, apart))
            forest, links = Forest(), []
            for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
                a, b = int(label[x]), int(label[y])
                if forest.root(a) == forest.root(b):
                    continue
                common = overlap(own[x], own[y])
                if 100 * common >= percent * (len(own[x]) + len(own[y]) - common):
                    forest.join(a, b)
                    links.append((int(node[x]), int(node[y])))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return leaves.mapInArrow(run, "a long, b long").distinct()


def node_labels(base: DataFrame, text_col: str, size: int, percent: int, leaf: int, hard: int) -> DataFrame:
    """node and label of the nodes that have links; the label is equal for nodes that links connect."""
    nodes, keys = distinct_sets(base)
    ends = lambda pairs: stage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct().join(keys, "node"), "ends")
    measure = lambda pairs: measured(pairs, sets_of(base, ends(pairs), text_col, size))
    cells = blocks(split(covering(nodes), measure, percent, leaf), hard)
    cells = stage(open_members(in_leaves(cells.select(*LEAF_COLUMNS)), percent), "leaves")
    seen = projections(base, stage(cells.select("node").distinct().join(keys, "node"), "live"))
    pairs = stage(nearest_pairs(in_leaves(cells.join(seen, "node").select(*LEAF_COLUMNS, "classes")), percent), "pairs")
    sets = sets_of(base, ends(pairs), text_col, size)
    labels = components(measured(pairs, sets).where(100 * F.col("common") >= percent * F.col("all")).select("a", "b"))

    # what no pair of the forests holds has no pair at all; of the rest, leaves with several labels go on
    left = cells.join(sets.select("node"), "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    left = stage(left, "labelled")
    mixed = left.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("cell")
    wide = left.join(mixed, "cell").join(seen, "node").select(*LEAF_COLUMNS, "label", "classes")
    still = stage(open_members(in_leaves(wide), percent), "open")
    more = compared(in_leaves(still.join(likely(sets, still, "node"), "node").select(*still.columns, "own")), percent)
    return components(stage(more, "links"), labels)


def linked(base: DataFrame, id_col: str, text_col: str, size: int, percent: int, leaf: int = LEAF, hard: int = HARD) -> DataFrame:
    """key, id, n_shingles, node, component_id (the smallest id that links reach) and leads (whether it is the component's first row) of each row of base."""
    with scratch(base.sparkSession):
        labels = node_labels(base, text_col, size, percent, leaf, hard)
        ends = base.select("key", F.col("row").getField(id_col).alias("id"), "n_shingles", "node").join(labels, "node", "left")
        ends = stage(ends.withColumn("label", F.coalesce("label", "node")), "labelled")
        first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "key"))
        roots = stage(ends.where("n_shingles > 0").groupBy("label").agg(F.min("id").alias("root"), first.getField("key").alias("first")), "roots")
        some = F.col("n_shingles") > 0
        rows = ends.join(roots, "label", "left").select(
            "key", "id", "n_shingles", "node",
            F.when(some, F.col("root")).otherwise(F.col("id")).alias("component_id"), F.when(some, F.col("first") == F.col("key")).otherwise(True).alias("leads"),
        )
        return stage(rows, "linked", owner=outer())


def link(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """doc_id, n_shingles, node and component_id of each row. how: size, percent."""
    with scratch(df.sparkSession):
        base = stage(summaries(df.select(id_col, text_col), id_col, text_col, how["size"], how["percent"]), "prefixes")
        rows = linked(base, id_col, text_col, **how)
        return stage(rows.select(F.col("id").alias("doc_id"), "n_shingles", "node", "component_id"), "links", owner=outer())


def every_link(leaves: DataFrame, percent: int) -> DataFrame:
    """All links (a, b, common, all) between nodes, a < b, measured from the sets in each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in whole_groups(batches, 2000):
            node = tab.column("node").to_numpy()
            own = [np.frombuffer(x.as_buffer(), "u8") for x in tab.column("own")]
            found = []
            for x, y in zip(*(p.tolist() for p in possible(tab, percent)[:2]), strict=True):
                common = overlap(own[x], own[y])
                union = len(own[x]) + len(own[y]) - common
                if 100 * common >= percent * union:
                    found.append((*sorted((int(node[x]), int(node[y]))), common, union))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], names=["a", "b", "common", "all"])

    return leaves.mapInArrow(run, "a long, b long, common long, all long").distinct()


def pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int, percent: int, leaf: int = LEAF, hard: int = HARD) -> tuple[DataFrame, DataFrame]:
    """The join itself: links between different sets, and members.

    Links: left and right (the smallest ids of the documents of each set), common and all (sizes of intersection and union); each once, so rows grow with the links.
    Members: doc_id, n_shingles, class_id (the smallest id with the same set; null without a set) and n_links (how many other documents it links with, copies of the same set and of
    linked sets counted each). Ids are those of the column, null ones are the smallest of no set."""
    with scratch(df.sparkSession):
        base = stage(summaries(df.select(id_col, text_col), id_col, text_col, size, percent), "prefixes")
        nodes, keys = distinct_sets(base)
        ends = lambda links: stage(links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct().join(keys, "node"), "ends")
        cells = blocks(split(covering(nodes), lambda links: measured(links, sets_of(base, ends(links), text_col, size)), percent, leaf), hard)
        cells = stage(open_members(in_leaves(cells.select(*LEAF_COLUMNS)), percent), "leaves")
        seen = projections(base, stage(cells.select("node").distinct().join(keys, "node"), "live"))
        still = stage(open_members(in_leaves(cells.join(seen, "node").select(*LEAF_COLUMNS, "classes")), percent), "open")
        sets = sets_of(base, stage(still.select("node").distinct().join(keys, "node"), "met"), text_col, size)
        links = stage(every_link(in_leaves(still.join(sets.select("node", "own"), "node").select(*still.columns, "own")), percent), "links")
        ids = base.select(F.col("row").getField(id_col).alias("id"), "n_shingles", "node")
        classes = stage(ids.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
        both = links.select("a", "b").union(links.select("b", "a"))
        met = both.join(classes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("met"))
        joined = ids.join(classes.where("copies > 0"), "node", "left").join(met, "node", "left")
        some = F.col("n_shingles") > 0
        n_links = F.when(some, F.col("copies") - 1 + F.coalesce("met", F.lit(0))).otherwise(0)
        members = joined.select(F.col("id").alias("doc_id"), "n_shingles", F.when(some, F.col("class_id")).alias("class_id"), n_links.cast("long").alias("n_links"))
        named = lambda end, name: classes.select(F.col("node").alias(end), F.col("class_id").alias(name))
        found = links.join(named("a", "x"), "a").join(named("b", "y"), "b").select(F.least("x", "y").alias("left"), F.greatest("x", "y").alias("right"), "common", "all")
        return stage(found, "links", owner=outer()), stage(members, "members", owner=outer())


def first_of_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, and of several with this id any one. Rows with null ids come last."""
    base = stage(summaries(df, id_col, text_col, how["size"], how["percent"]), "prefixes")
    gone = stage(linked(base, id_col, text_col, **how).where(~F.col("leads")).select("key"), "copies")
    return without(base.select("row", "key"), gone, "key").select("row.*")
