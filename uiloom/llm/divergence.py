"""How far the sources of one group (here: a language) differ in the terms they use.

Terms are maximal runs of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased. A group keeps the terms
that at least `least` of its documents hold. A source with `count` occurrences of a term and N of all kept terms, V of them,
gives it p = 1 + floor(10^9 * (count + 5) / (N + 5 V)); the group as a whole does so too. The report has two parts:

* `pair`: for each two sources, the sum over all kept terms of |p - q|, for all ranks;
* `term`: for each source, the kept terms it uses more than the group does, by p - q, ranks to `top`.

Heavy-light split. A term in more than LIGHT sources is heavy: tiles of about TILE heavy terms by two blocks of about BLOCK
sources are dense integer matrices, and a tile gives the sum of |p - q| for each pair of its sources. All other terms are
light: a source without the term has the same p for all of them, its `base`, so the sum over the light terms is
(number of light terms) * |base - base'|, plus what a source's own counts change against all other bases (one number for each
different p), plus corrections for the sources that share a posting, LIGHT * (LIGHT - 1) / 2 for each term at most.
All are whole numbers and are added exactly; p is found in decimals of 38 digits, so counts up to 10^18 are exact.

Counting: a task counts terms and documents for each group and source it meets, and passes counts on at FLUSH entries, so memory is
bounded and a source that holds a third of all rows is summed where it is read. Of the rare terms only the number of documents is shuffled.

Edge cases: null texts, groups and sources count as empty. A text without terms, and a group none of whose terms is kept (value 0 for
each pair), still make their source known. Repeated rows count each time. Very long texts are read whole, one at a time. Ties rank by the item's UTF-8
bytes. A lone source has no pairs. An empty table gives an empty result; further columns are never read, so their names can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uiloom.llm.common import outer, scratch, stage

LEAST, TOP, SCALE, SMOOTH = 30, 50, 1_000_000_000, 5
LIGHT, TILE, BLOCK = 8, 512, 256
FLUSH, ROWS = 120_000, 10_000

#: Bytes that are no part of a term become spaces, A-Z become a-z.
TERM_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def count_terms(df: DataFrame, group_col: str, source_col: str, text_col: str) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents), summed for each task only; a null term tells that the source occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (occurrences, documents) in seen.items():
                rows = chain([(None, 0, 0)], ((t.decode(), n, documents[t]) for t, n in occurrences.items()))
                while some := [*islice(rows, ROWS)]:
                    found, n, docs = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(found, pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                        names=["lang", "source", "term", "n", "docs"],
                    )
            seen.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
                occurrences, documents = seen.setdefault((lang, source), (Counter(), Counter()))
                found = terms(text.as_py())
                occurrences.update(found)
                documents.update(set(found))
            if sum(len(o) for o, _ in seen.values()) > FLUSH:
                yield from flushed()
        yield from flushed()

    text = F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")
    inputs = df.select(*(F.coalesce(df[c].cast("string"), F.lit("")) for c in (group_col, source_col)), text)
    return inputs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def weight(count: Column, total: Column, kept: Column) -> Column:
    """p, exact: the product has 31 digits at most."""
    over = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, (total + SMOOTH * kept).cast("decimal(20,0)")) + 1


def tile_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """The sum of |p - q| over the terms of a tile for each two sources of its blocks, the smaller name first."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    sources, at = np.unique(np.array(rows.column("source").to_pylist(), object), return_inverse=True)
    block, base = np.zeros(len(sources), "i8"), np.zeros(len(sources), "i8")
    block[at], base[at] = rows.column("block").to_numpy(), rows.column("base").to_numpy()
    named = rows.column("term").is_valid().to_numpy()
    columns, place = np.unique(np.array(rows.column("term").to_pylist(), object)[named], return_inverse=True)
    dense = np.repeat(base[:, None], len(columns), 1)
    dense[at[named], place] = rows.column("p").to_numpy(zero_copy_only=False)[named]
    absent = pc.max(rows.column("terms")).as_py() - len(columns)  # terms of the tile that only other blocks hold
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    firsts, seconds, values = [], [], []
    for i in left.tolist():
        others = right[right > i] if low == high else right
        sums = (np.abs(dense[others] - dense[i]).sum(1) + absent * np.abs(base[others] - base[i])).tolist()
        for j, value in zip(others.tolist(), sums, strict=True):
            firsts.append(sources[min(i, j)])
            seconds.append(sources[max(i, j)])
            values.append(value)
    return pa.table({"lang": pa.array([lang] * len(values), pa.string()), "a": pa.array(firsts, pa.string()), "b": pa.array(seconds, pa.string()), "value": pa.array(values, pa.int64())})


def heavy_pairs(posted: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (a < b) and partial sums over the heavy terms."""
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.ceil(F.max("heavy") / TILE).cast("long").alias("tiles")).where("tiles > 0")
    own = F.pmod(F.xxhash64("source"), F.col("blocks"))
    named = posted.where("is_heavy").select("lang", "source", "term", "p", "base").join(sizes, "lang")
    named = named.withColumn("tile", F.pmod(F.xxhash64("term"), F.col("tiles")))
    # each tile knows all sources of its group, those without any of its terms as well, and how many terms it has
    held = named.groupBy("lang", "tile").agg(F.count_distinct("term").alias("terms"))
    marks = groups.join(sizes, "lang").join(held, "lang")
    marks = marks.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "base", "blocks", "tiles", "tile", "terms")
    rows = named.withColumn("terms", F.lit(None).cast("long")).unionByName(marks)
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("lang", "tile", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "source", "block", "base", "term", "p", "terms")
    return rows.groupBy("lang", "tile", "low", "high").applyInArrow(tile_sums, "lang string, a string, b string, value long")


def light_pairs(posted: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b and partial sums over the light terms, of which a source need not hold any."""
    g = groups.select("lang", F.col("source").alias("a"), F.col("base").alias("a_base"), "light")
    h = groups.select("lang", F.col("source").alias("b"), F.col("base").alias("b_base"))
    bases = g.join(h, "lang").where("a < b").select("lang", "a", "b", (F.col("light") * F.abs(F.col("a_base") - F.col("b_base"))).alias("value"))
    light = posted.where("NOT is_heavy")
    own = light.groupBy("lang", F.col("source").alias("s"), "p", "base").agg(F.count("*").alias("times")).join(h.withColumnRenamed("b", "t"), "lang").where("s <> t")
    changed = own.select("lang", F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"), (F.col("times") * (F.abs(F.col("p") - F.col("b_base")) - F.abs(F.col("base") - F.col("b_base")))).alias("value"))
    x = light.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("base").alias("ba"))
    y = light.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("base").alias("bb"))
    gap = lambda u, v: F.abs(F.col(u) - F.col(v))
    shared = x.join(y, ["lang", "term"]).where("a < b").select("lang", "a", "b", (gap("pa", "pb") - gap("pa", "bb") - gap("ba", "pb") + gap("ba", "bb")).alias("value"))
    return bases.unionByName(changed).unionByName(shared)


def audit(df: DataFrame, group_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank, as the module says."""
    spark = df.sparkSession
    with scratch(spark):
        partial = stage(count_terms(df, group_col, source_col, text_col), "terms")
        # one shuffle: the sums by source and those of the term over its sources need the same dealing
        merged = partial.where("term IS NOT NULL").repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        own = Window.partitionBy("lang", "term")
        merged = merged.select("lang", "source", "term", "n", F.sum("docs").over(own).alias("docs"), F.sum("n").over(own).alias("term_n"), (F.count("*").over(own) > LIGHT).alias("is_heavy"))
        counts = stage(merged.where(F.col("docs") >= least).drop("docs"), "counts")
        by_term = counts.select("lang", "term", "term_n", "is_heavy").distinct()
        by_lang = by_term.groupBy("lang").agg(F.sum("term_n").alias("lang_n"), F.count("*").alias("kept"), F.count_if("is_heavy").alias("heavy"))
        totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
        groups = partial.where("term IS NULL").select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left")
        groups = groups.na.fill(0, ["source_n", "lang_n", "kept", "heavy"]).withColumn("light", F.col("kept") - F.col("heavy"))
        base = F.when(F.col("kept") > 0, weight(F.lit(0).cast("long"), F.col("source_n"), F.col("kept"))).otherwise(0)
        groups = stage(groups.withColumn("base", base), "groups", owner=outer())
        posted = counts.join(groups.drop("heavy", "light"), ["lang", "source"])
        p, q = weight(F.col("n"), F.col("source_n"), F.col("kept")), weight(F.col("term_n"), F.col("lang_n"), F.col("kept"))
        posted = stage(posted.select("lang", "source", "term", "is_heavy", "base", p.alias("p"), q.alias("q")), "posted", owner=outer())
    pairs = heavy_pairs(posted, groups).unionByName(light_pairs(posted, groups)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.withColumn("way", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_part = both.select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value").withColumn("rank", F.row_number().over(order))
    over = posted.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term_part = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair_part.unionByName(term_part)
