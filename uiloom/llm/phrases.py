"""Removal of passages that recur anywhere in a table of documents, by windows of words.

A word goes if some window of `window` words that covers it starts more than once in the table.

1. Every window has an anchor: the leftmost of its ANCHOR-word phrases with the smallest hash. Equal
   windows have equal anchors, so a window can recur only if its anchor does. Neighbouring windows
   share an anchor; such an occurrence is one narrow row, with a hash of all words that its windows
   cover (its extent). There are about 7 rows for 100 words.
2. Anchors are counted, which proposes phrases. Where all extents of a recurring anchor are equal, the extent is one phrase. Where
   they differ, an extent that recurs is a phrase as it is, and the windows of one occurrence of each extent are counted by hash, and those that seem to recur are phrases, neighbours that recur in the same places together. The words of a phrase are read
   from one document that holds it, so there is one row for a phrase however often it occurs.
3. Phrases are dealt over shards of about SHARD_WORDS words by the first document that holds their anchor, so those of one
   passage stay together. Each shard becomes an Aho-Corasick automaton over words. Documents are streamed through the shards to which their anchors
   point (other shards can't hold a phrase of theirs), in portions of DOC_CHARS, each with its own copy of the automaton. Every hit is an occurrence, word for word.
4. A phrase that the automata find only once in all documents was proposed by a collision of hashes: it is taken out, and the documents are
   streamed again. What the hits cover is removed; nothing else is.

Counts are aggregated before they are shuffled, no group is gathered, and a shard that many documents need is copied
to several tasks, so a passage that a third of the documents share is no special case.

Edge cases: a null text has no words and keeps an empty text. Documents with fewer words than a window keep all of them. Very long texts go through whole.
Rows with equal id and text get equal results and count as occurrences of each other; ids may be null. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import SPACE, outer, scratch, stage
from uiloom.llm.jaccard import P1, P2, P3, _hashes, mix

ANCHOR, SHARD_WORDS, DOC_CHARS = 8, 400_000, 16_000_000
TOGETHER = 1 << 17  # words of several texts that are hashed at once
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of BASE and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, "u8")

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, "u8"), np.full(size, b, "u8")))) for b in (BASE, INVERSE))
        return self.up[:n], self.down[: n + 1]


_powers = Powers()


class Words:
    """Hashes of the runs of words of a text, or of several texts after each other."""

    def __init__(self, words: list[bytes]) -> None:
        self.h = mix(np.fromiter(map(_hashes.__getitem__, words), "u8", len(words)))
        power, self.back = _powers(len(words))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate((np.zeros(1, "u8"), np.cumsum(self.h * power)))

    def runs(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash of the words start to stop (exclusive), wherever they stand."""
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype("u8") * P2)


def together(texts: Iterator[tuple[int, bytes]], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """Texts of at least `least` words in portions of about TOGETHER words: their numbers, where each one starts (and the end), and their words."""
    rows: list[int] = []
    ends, words = [0], []
    for row, text in texts:
        own = text.split()
        if len(own) < least:
            continue
        rows.append(row)
        words += own
        ends.append(len(words))
        if len(words) >= TOGETHER:
            yield np.array(rows), np.array(ends), Words(words)
            rows, ends, words = [], [0], []
    if rows:
        yield np.array(rows), np.array(ends), Words(words)


def occurrences(own: Words, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor, extent, first and last window of each run of windows that share an anchor, for texts after each other; none has less than `window` words."""
    n = len(own.h)
    at = np.arange(n - ANCHOR + 1)
    phrase = own.runs(at, at + ANCHOR)
    key = (phrase & np.uint64(0xFFFFFFFF00000000)) | at.astype("u8")  # ties: leftmost
    span, width = window - ANCHOR + 1, 1
    while 2 * width <= span:
        key, width = np.minimum(key[:-width], key[width:]), 2 * width
    if width < span:
        key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    start = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])  # windows within one text; their anchors are as well
    place = (key[start] & np.uint64(0xFFFFFFFF)).astype("i8")
    head = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    first, last = start[head], start[np.concatenate((head[1:], [len(place)])) - 1]
    place = place[head]
    with np.errstate(over="ignore"):
        extent = mix(own.runs(first, last + window) ^ ((place - first).astype("u8") * P1 + P3))
    base = ends[text[first]]
    return text[first], phrase[place], extent, first - base, last - base


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """key, anchor, extent, first and last window of each run of windows that share an anchor; docs: key, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((i, text.as_py()) for i, text in enumerate(batch.column(1)))
            for rows, ends, own in together(texts, window):
                text, anchor, extent, first, last = occurrences(own, ends, window)
                keys = batch.column(0).take(pa.array(rows[text]))
                yield pa.RecordBatch.from_arrays([keys, pa.array(anchor.view("i8")), pa.array(extent.view("i8")), pa.array(first.astype("i4")), pa.array(last.astype("i4"))], names=["key", "anchor", "extent", "first", "last"])

    return docs.select("key", F.col("text").cast("binary")).mapInArrow(run, "key long, anchor long, extent long, first int, last int")


def window_rows(held: DataFrame, window: int) -> DataFrame:
    """window (a hash), key, first, of (the span's first window) and owner for the windows of spans whose anchor has different extents; held: key, text, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            flat = spans.flatten()
            mixed = np.flatnonzero(flat.field("mixed").to_numpy(zero_copy_only=False))
            of_row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy(zero_copy_only=False))[mixed]
            first, last, owner = (flat.field(c).to_numpy(zero_copy_only=False)[mixed].astype("i8") for c in ("first", "last", "owner"))
            texts = ((i, batch.column(1)[i].as_py()) for i in np.unique(of_row).tolist())
            for rows, ends, own in together(texts, window):
                low, high = np.searchsorted(of_row, (rows[0], rows[-1] + 1))
                n = last[low:high] + 1 - first[low:high]
                of = np.repeat(first[low:high], n)
                at = of + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(of_row[low:high], n)
                start = at + ends[np.searchsorted(rows, row)]
                columns = [pa.array(own.runs(start, start + window).view("i8")), batch.column(0).take(pa.array(row)), pa.array(at.astype("i4")), pa.array(of.astype("i4")), pa.array(np.repeat(owner[low:high], n))]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "key", "first", "of", "owner"])

    return held.select("key", F.col("text").cast("binary"), "spans").where(F.exists("spans", lambda s: s["mixed"])).mapInArrow(run, "window long, key long, first int, of int, owner long")


def one_of(*parts: str) -> list[Column]:
    """For an aggregation: the smallest key, and two ints of a row that has it (in one number, as structs would be sorted)."""
    first, second = (F.col(p).cast("long") for p in parts)
    return [F.min("key").alias("key"), F.min_by(first * (1 << 32) + second, "key").alias("pack")]


def unpacked(*parts: str) -> list[Column]:
    return [F.shiftright("pack", 32).cast("int").alias(parts[0]), F.col("pack").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias(parts[1])]


def window_phrases(windows: DataFrame, window: int) -> DataFrame:
    """key, first, stop and owner of phrases for the windows that recur. Windows of one span that recur in the same spans
    (as two sums over these tell) are one phrase: wherever one of them stands, so do the others and the words between."""
    span = F.xxhash64("key", "of")
    part = lambda bits: F.sum(F.pmod(F.shiftright(span, bits), F.lit(1 << 31)))
    counted = windows.groupBy("window").agg(F.count("*").alias("n"), part(0).alias("x"), part(31).alias("y"), F.min("owner").alias("owner"), *one_of("first", "of"))
    counted = counted.where("n > 1").select("key", "owner", "n", "x", "y", *unpacked("first", "of"))
    runs = counted.groupBy("key", "of", "owner", "n", "x", "y").agg(F.min("first").alias("first"), F.max("first").alias("last"))
    return runs.select("key", "first", (F.col("last") + window).alias("stop"), "owner")


def phrase_texts(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """owner and words of each phrase; wanted: key of a document that holds it, first word, stop, owner."""
    by_doc = wanted.groupBy("key").agg(F.collect_list(F.struct("first", "stop", "owner")).alias("phrases"))  # of one document, so bounded by its words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, phrases in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = text.as_py().split(" ")
                own = [(p["owner"], " ".join(words[p["first"] : p["stop"]]), p["stop"] - p["first"]) for p in phrases]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*own, strict=True), (pa.int64(), pa.string(), pa.int32()), strict=True)], names=["owner", "words", "n"])

    texts = held.select("key", "text").join(stage(by_doc, "wanted"), "key").select("text", "phrases")
    found = texts.mapInArrow(run, "owner long, words string, n int")
    return found.groupBy("words").agg(F.min("owner").alias("owner"), F.first("n").alias("n"))


def locate(sent: DataFrame) -> DataFrame:
    """Streams documents through automata. sent: task, kind (0: phrases, 1: documents), id, text, rows of a task together and its phrases first.
    Gives kind 1, id and the spans [first, stop, ..] of the document's words in hits, and kind 0, id and the number of hits of each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, phrases, automaton = None, [], None
        numbers: dict[str, int] = {}
        hits: list[int] = []

        def rows(kind: int, ids: list[int], values: list[list[int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int32()))], names=["kind", "id", "spans"])

        def ended() -> pa.RecordBatch:
            return rows(0, [p for p, _ in phrases], [[n] for n in hits])

        for batch in batches:
            ids, spans = [], []
            for of, kind, own, value in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if of != task:
                    if hits:
                        yield ended()
                    task, phrases, automaton, numbers, hits = of, [], None, {}, []
                words = value.as_py().split(" ")
                if kind == 0:
                    phrases.append((own, tuple(numbers.setdefault(w, len(numbers) + 1) for w in words)))
                    continue
                if not phrases:
                    ids.append(own)
                    spans.append([])
                    continue
                if automaton is None:
                    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
                    for i, (_, numbered) in enumerate(phrases):
                        automaton.add_word(numbered, (i, len(numbered)))
                    automaton.make_automaton()
                    phrases, hits = [(p, ()) for p, _ in phrases], [0] * len(phrases)
                found: list[int] = []
                low = high = -1
                for end, (i, length) in automaton.iter(tuple([numbers.get(w, 0) for w in words])):
                    hits[i] += 1
                    start = end - length + 1
                    if start <= high and low <= start:
                        high = end + 1
                    else:  # also for a longer phrase that starts before the last one; spans are merged at the end
                        if high > 0:
                            found += [low, high]
                        low, high = start, end + 1
                if high > 0:
                    found += [low, high]
                ids.append(own)
                spans.append(found)
            yield rows(1, ids, spans)
        if hits:
            yield ended()

    return sent.mapInArrow(run, "kind int, id long, spans array<int>")


def removed(flat: list[int], n: int) -> np.ndarray:
    """Which of n words the spans [first, stop, ..] cover."""
    at = np.array(flat, "i8").reshape(-1, 2)
    change = np.zeros(n + 1, "i8")
    np.add.at(change, at[:, 0], 1)
    np.add.at(change, at[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def remove_recurring(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int, shard_words: int = SHARD_WORDS, doc_chars: int = DOC_CHARS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of each row."""
    id_kind = df.select(df[id_col].alias("doc_id")).schema["doc_id"].dataType.simpleString()
    docs = df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    joined = F.trim(F.regexp_replace("text", rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+", " "))
    with scratch(df.sparkSession):
        with scratch(df.sparkSession):
            occurring = stage(anchor_rows(docs, window), "anchors")
            counted = occurring.groupBy("anchor").agg(
                F.count("*").alias("n"), F.min("extent").alias("low"), F.max("extent").alias("high"), *one_of("first", "last"),
            ).where("n > 1")
            recurring = stage(counted.select("anchor", (F.col("low") != F.col("high")).alias("mixed"), "key", *unpacked("first", "last")), "recurring", owner=outer())
            marks = recurring.select("anchor", "mixed", F.col("key").alias("owner"))
            placed = stage(occurring.join(marks, "anchor"), "placed")
            # of an anchor's different runs, one of each extent tells its windows: a run that recurs as it is, is a phrase as it is
            kinds = placed.where("mixed").groupBy("anchor", "extent").agg(F.count("*").alias("n"), F.min("owner").alias("owner"), *one_of("first", "last"))
            kinds = stage(kinds.select("anchor", "extent", "n", "owner", "key", *unpacked("first", "last")), "kinds", owner=outer())
            told = kinds.select("anchor", "extent", F.col("n").alias("_n"), F.col("key").alias("_key"), F.col("first").alias("_first"))
            tells = (F.col("_n") == 1) | ((F.col("key") == F.col("_key")) & (F.col("first") == F.col("_first")))
            differing = placed.where("mixed").join(told, ["anchor", "extent"]).select("key", "first", "last", tells.alias("mixed"), "owner")
            spans = placed.where("NOT mixed").select("key", "first", "last", "mixed", "owner").unionByName(differing)
            spans = spans.groupBy("key").agg(F.collect_set(F.struct("first", "last", "mixed", "owner")).alias("spans"))
            # each row once, with the spans of those that may lose words; the others are done. From here on a text is its words, joined by one space
            held = stage(docs.join(spans, "key", "left").withColumn("text", joined), "held", owner=outer())
        some = held.where("spans IS NOT NULL")
        whole = recurring.where("NOT mixed").select("key", "first", (F.col("last") + window).alias("stop"), F.col("key").alias("owner"))
        whole = whole.unionByName(kinds.where("n > 1").select("key", "first", (F.col("last") + window).alias("stop"), "owner"))
        parts = window_phrases(window_rows(some, window), window)
        phrases = stage(phrase_texts(some, whole.unionByName(parts)).withColumn("id", F.monotonically_increasing_id()), "phrases")
        # an owner's phrases are together, if they aren't too many for one shard
        sizes = stage(phrases.groupBy("owner").agg(F.sum("n").alias("n")), "sizes")
        shards = max(1, int(2 * (sizes.agg(F.sum("n")).first()[0] or 0) / shard_words))
        wide = stage(sizes.where(F.col("n") > shard_words).select("owner", F.ceil(F.col("n") / shard_words).cast("int").alias("parts")), "wide")
        number = F.pmod(F.xxhash64("owner", "part"), F.lit(shards)).cast("int").alias("shard")
        parted = phrases.join(wide, "owner", "left").withColumn("part", F.pmod(F.xxhash64("words"), F.coalesce("parts", F.lit(1))).cast("int"))
        owners = some.select("key", "text", F.explode(F.array_distinct(F.transform("spans", lambda s: s["owner"]))).alias("owner")).select("key", "owner").distinct()
        routed = owners.join(wide, "owner", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        routed = routed.select("key", number).groupBy("key").agg(F.collect_set("shard").alias("shards"))
        sent = stage(some.select("key", "text").join(routed, "key").select("key", "text", F.explode("shards").alias("shard")), "routed")
        loads = stage(sent.groupBy("shard").agg(F.ceil(F.sum(F.length("text")) / doc_chars).cast("int").alias("copies")), "loads")

        def task(rows: DataFrame, kind: int, copy) -> DataFrame:
            return rows.join(loads, "shard").withColumn("copy", copy).select(F.xxhash64("shard", "copy").alias("task"), F.lit(kind).alias("kind"), "id", "text")

        asked = task(sent.withColumnRenamed("key", "id"), 1, F.pmod(F.xxhash64("id"), F.col("copies")).cast("int"))
        while True:
            given = task(parted.select(number, "id", F.col("words").alias("text")), 0, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            found = stage(locate(given.unionByName(asked).repartition("task").sortWithinPartitions("task", "kind")), "found")
            single = found.where("kind = 0").groupBy("id").agg(F.sum(F.col("spans")[0].cast("long")).alias("n")).where("n < 2").select("id")
            single = stage(single, "single")
            if single.isEmpty():
                break
            parted = parted.join(single, "id", "left_anti")
        hits = found.where("kind = 1 AND size(spans) > 0").groupBy(F.col("id").alias("key")).agg(F.flatten(F.collect_set("spans")).alias("hits"))
        rows = some.select("key", "doc_id", "text").join(hits, "key", "left").select("doc_id", "text", "hits")
        rows = rows.unionByName(held.where("spans IS NULL").select("doc_id", "text", F.lit(None).cast("array<int>").alias("hits")))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts, lost, kept = [], [], []
                for value, flat in zip(batch.column(1), batch.column(2), strict=True):
                    text = value.as_py()
                    counts.append(text.count(" ") + 1 if text else 0)
                    if flat.is_valid:
                        gone = removed(flat.as_py(), counts[-1])
                        lost.append(int(gone.sum()))
                        kept.append(" ".join(w for w, g in zip(text.split(" "), gone.tolist(), strict=True) if not g))
                    else:
                        lost.append(0)
                        kept.append(text)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

        return stage(rows.mapInArrow(keep, f"doc_id {id_kind}, n_words long, n_removed long, kept string"), "kept", owner=outer())


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
