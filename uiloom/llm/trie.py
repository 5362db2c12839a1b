"""Prefix tree of conversations: which openings recur, and what sharing them would save.

A node is a distinct sequence of first turns; its members are the conversations that start with it.

1. Turns become numbers: a dictionary of the distinct turns (role and text, compared by SHA-256) is joined back, by a join whose
   side of the turns AQE splits where one turn is very common.
2. Conversations of equal turns become one row: they are sorted by turns and id over ranges, so copies of one conversation lie in many
   ranges; each range passes on pieces of CHUNK ids at most, with their text, and one reader for each different conversation hashes
   the pieces in order, so what it holds is bounded.
3. MSD radix partitioning: all rows with equal first d turns are a bucket. A bucket of at most LOCAL different conversations is local; the others
   are nodes, and their rows are dealt into buckets of d + 1 turns, and so on. A round counts, then joins the few large buckets back.
4. Local buckets are dealt to tasks, several to a task, and finished by multikey quicksort: rows that are equal in the first d turns are split
   in three by the next turn of a middle row, and each set of equals is a node. Sums over subtrees are made on the way back.
5. Sums of local buckets and of large nodes are added up for all large nodes above them, aggregated before they are shuffled.

Large buckets are at most rows / LOCAL for each depth. The number of rounds is the depth to which more than LOCAL different conversations agree.

Order of turns: by `turn`, null first; of equal turns by role, then by the SHA-256 of role and text. Null role or text is empty. Edge cases:
rows without conv_id belong to no conversation and are left out; repeated rows are turns of their own; a conversation is one row of numbers (12
bytes a turn), so a conversation must fit into a task, its texts need not; very long texts are hashed where they are read. Further columns are never read. An empty table gives no
node, otherwise the root is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import outer, scratch, stage, whole_groups

LOCAL, CHUNK, HEADS, FAMILY, TAKEN = 2000, 4096, 5, 100, 6
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def encoded(conversations: DataFrame) -> DataFrame:
    """conv_id, ids and chars: the numbers and code points of a conversation's turns, in order."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    print_ = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), print_.alias("print"), F.length(text).alias("chars")
    )
    turns = stage(turns, "turns")
    # after a sort over ranges the numbers rise as the prints do
    known = stage(turns.select("print").distinct().sort("print").select("print", F.monotonically_increasing_id().alias("id")), "dictionary")
    named = stage(turns.join(known, "print").select("conv_id", F.struct("turn", "role", "id", "chars").alias("t")), "numbered")
    rows = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation with the first h turns of its family's first in place of its own first h."""
    whole = lambda c: F.coalesce(c, F.array().cast("array<long>"))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("ids", 1, HEADS).alias("head_ids"), F.slice("chars", 1, HEADS).alias("head_chars")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN
    # a first conversation serves FAMILY others (twice as many around 0)
    joined = own.withColumn("h", h.cast("int")).withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "first", "left")
    put = lambda head, rest: F.concat(F.slice(whole(F.col(head)), 1, F.col("h")), F.slice(F.col(rest).cast("array<long>"), F.col("h") + 1, F.greatest(F.size(rest), F.lit(1))))
    return joined.select("conv_id", put("head_ids", "ids").alias("ids"), put("head_chars", "chars").alias("chars"))


def runs(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Pieces of equal conversations: ids, chars, smallest conv_id, how many, their numbers as text."""
    held: list[int] = []
    now: tuple[list[int], list[int]] | None = None
    out: list[tuple] = []

    def close() -> None:
        if held:
            out.append((*now, held[0], len(held), ",".join(map(str, held))))
            held.clear()

    for batch in batches:
        for ids, chars, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or ids != now[0] or len(held) >= chunk:
                close()
                now = (ids, chars)
            held.append(conv)
        if len(out) >= 1000:
            yield pieces(out)
            out = []
    close()
    if out:
        yield pieces(out)


def pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["ids", "chars", "conv_id", "n", "ends"])


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each different conversation, from its pieces in order; ends becomes a hash."""
    now: list | None = None
    state = hashlib.sha256()
    out: list[tuple] = []
    for batch in batches:
        for ids, chars, conv, n, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is not None and ids == now[0]:
                now[3] += n
                state.update(b"," + ends.encode())
                continue
            if now is not None:
                out.append((*now, state.hexdigest()))
            now, state = [ids, chars, conv, n], hashlib.sha256(ends.encode())
        if len(out) >= 1000:
            yield pieces(out)
            out = []
    if now is not None:
        out.append((*now, state.hexdigest()))
    if out:
        yield pieces(out)


def different(convs: DataFrame) -> DataFrame:
    """ids, chars, conv_id (the smallest), n and ends (the hash) of each different conversation."""
    kind = "ids array<long>, chars array<long>, conv_id long, n long, ends string"
    by_range = convs.select("ids", "chars", "conv_id").repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    chunk = CHUNK
    found = by_range.mapInArrow(lambda batches: runs(batches, chunk), kind)
    return found.repartition("ids").sortWithinPartitions("ids", "conv_id").mapInArrow(hashed, kind)


def finish(bucket: list[tuple], depth: int, parent: int | None) -> list[tuple]:
    """The nodes of one local bucket, whose rows (ids, chars, conv_id, n, ends) agree in their first `depth` turns, by multikey quicksort.
    Its top is the first node returned."""
    nodes: list[list] = []
    # (rows, depth, number of the parent node): sets of rows that agree in so many turns, or that are still to be split by the next one
    todo: list[tuple[list[tuple], int, int, bool]] = [(bucket, depth, -1, True)]
    while todo:
        rows, d, above, equal = todo.pop()
        if equal:  # a node
            n = sum(r[3] for r in rows)
            conv = min(r[2] for r in rows)
            ended = next((r for r in rows if len(r[0]) == d), None)
            up = parent if above < 0 else nodes[above][0]
            saved = (n - 1) * rows[0][1][d - 1] if d else 0
            nodes.append([conv, d, up, n, 0, 0, saved, ended[4] if ended else NO_ENDS, above])
            if above >= 0:
                nodes[above][4] += 1
            above = len(nodes) - 1
            rows = [r for r in rows if len(r[0]) > d]
            if not rows:
                continue
        middle = rows[len(rows) // 2][0][d]
        parts = ([r for r in rows if r[0][d] < middle], [r for r in rows if r[0][d] == middle], [r for r in rows if r[0][d] > middle])
        todo.append((parts[1], d + 1, above, True))
        todo.extend((part, d, above, False) for part in (parts[0], parts[2]) if part)
    for node in reversed(nodes):  # a node comes after its parent
        if not node[4]:
            node[5] = 1
        if node[8] >= 0:
            nodes[node[8]][5] += node[5]
            nodes[node[8]][6] += node[6]
    return [tuple(node[:8]) for node in nodes]


def finish_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of whole buckets; the top of each also tells its prefix, and how deep that is."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "prefix"]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.int64())]
    for rows in whole_groups(batches, 4 * LOCAL):
        buckets: dict[str, list[tuple]] = {}
        for key, depth, parent, *row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            buckets.setdefault((key, depth, parent), []).append(tuple(row))
        out: list[tuple] = []
        for (_, depth, parent), bucket in buckets.items():
            nodes = finish(bucket, depth, parent)
            out.append((*nodes[0], bucket[0][0][:depth]))
            out.extend((*node, None) for node in nodes[1:])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def prefix(of: str | Column, depth: int) -> Column:
    return F.slice(of, 1, depth) if depth else F.array().cast("array<long>")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Radix rounds: rows of local buckets with bucket, depth and the parent's conv_id; and the large nodes (prefix, depth, conv_id,
    parent_conv_id, n_convs, n_children, saved, ends)."""
    active = rows.withColumn("up", F.lit(None).cast("long"))
    local: list[DataFrame] = []
    large: list[DataFrame] = []
    depth = 0
    while True:
        own = prefix("ids", depth)
        last = F.max(F.element_at("chars", depth)) if depth else F.lit(0).cast("long")
        ends = F.max(F.when(F.size("ids") == depth, F.col("ends")))
        counts = active.groupBy(own.alias("prefix")).agg(
            F.count("*").alias("rows"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("up").alias("parent_conv_id"), last.alias("last"), ends.alias("ends")
        )
        counts = stage(counts, "counts")
        if large:  # how many children the large buckets of the round before have
            children = counts.groupBy(prefix("prefix", depth - 1).alias("prefix")).agg(F.count("*").alias("n_children"))
            large[-1] = large[-1].join(children, "prefix", "left")
        bigger = counts.where(F.col("rows") > LOCAL)
        place = lambda df: df.select(F.concat_ws(",", prefix("ids", depth).cast("array<string>")).alias("bucket"), F.lit(depth).cast("long").alias("depth"), "up", "ids", "chars", "conv_id", "n", "ends")
        if bigger.isEmpty():
            local.append(place(active))
            break
        saved = (F.col("n_convs") - 1) * F.col("last")
        large.append(bigger.select("prefix", F.lit(depth).cast("long").alias("depth"), "conv_id", "parent_conv_id", "n_convs", saved.alias("saved"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends")))
        tops = bigger.select(F.col("prefix").alias("top"), F.col("conv_id").alias("above"))
        joined = stage(active.join(tops, own == F.col("top"), "left"), "active")
        local.append(place(joined.where("top IS NULL")))
        active = joined.where((F.col("top").isNotNull()) & (F.size("ids") > depth)).withColumn("up", F.col("above")).drop("top", "above")
        depth += 1
    union = lambda parts: None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(local), union(large)


def build(conversations: DataFrame) -> DataFrame:
    """One row for each node of the tree over the rebuilt conversations."""
    spark = conversations.sparkSession
    with scratch(spark):
        rows = stage(different(rebuilt(encoded(conversations))), "different")
        local, large = split(rows)
        dealt = local.repartition("bucket").sortWithinPartitions("bucket", "depth")
        made = stage(dealt.mapInArrow(finish_local, f"{NODE}, prefix array<long>"), "nodes", owner=outer())
        nodes = made.drop("prefix")
        if large is None:
            return nodes
        large = stage(large, "large", owner=outer())
    # what local buckets and large nodes hold counts for all large nodes above
    parts = made.where("prefix IS NOT NULL").select("prefix", (F.col("depth") - 1).alias("upto"), "n_leaves", F.col("saved_tokens").alias("saved"))
    parts = parts.unionByName(large.select("prefix", F.col("depth").alias("upto"), F.lit(0).cast("long").alias("n_leaves"), "saved"))
    above = parts.where("upto >= 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), "upto")))
    sums = above.groupBy(F.slice("prefix", F.lit(1), F.col("k").cast("int")).alias("prefix")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    upper = large.drop("saved").join(sums, "prefix").select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
    return nodes.unionByName(upper)
