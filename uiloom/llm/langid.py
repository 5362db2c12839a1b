"""Language identification by n-gram filters that answer with a bitmask of languages.

A Bloom filter for each language, all of one size and with the same hash functions, is stored
bit-sliced: slot s holds one bit for each language, so one look-up gives the languages that may
contain an n-gram. Training enters the n-grams that at least MIN_SHARE of a language's documents
contain. A document's n-grams are looked up, the bits are counted for each language, and a count c
of n is corrected for the filter's rate f of false positives to (c - n f) / (1 - f). The largest
corrected count decides; ties go to the language with more training documents, then by name.
The score is that count's share of the n-grams.

Training uses a bounded sample: about SAMPLE documents of each language, drawn by a hash of key and text, so copies of
a text are drawn each by itself. Statistics of the table itself (documents of each language) cover all rows.
Of more than MAX_LANGUAGES languages those with most documents are learned, by name among equals.

Edge cases: texts that are null or have no letter are `und` with score 0; so is every text where
nothing could be learned (an empty table). Rows with null language or text teach nothing. Very long texts are
scanned in slices whose counts add up. Repeated rows get equal results. Further columns are kept; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uiloom.llm.common import draw, in_scratch, stage

SAMPLE, MIN_SHARE, MIN_DOCS, MAX_LANGUAGES = 2000, 0.02, 2, 512
SIZES = (3, 4)
SLOTS, HASHES = 1 << 20, 2
SLICE = 1 << 20
UNKNOWN = "und"
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], "u8")
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype("i8")

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text with one 0 in place of each run of other characters, and at the ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "u4")
    kept = letters()[points]
    points = np.concatenate(([0], np.where(kept, points, 0), [0])).astype("u8")
    return points[np.concatenate(([True], (points[1:] | points[:-1]) != 0))]


def grams(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams that hold a letter, in slices."""
    for start in range(0, max(len(text), 1), SLICE):
        points = codes(text[start : start + SLICE + max(SIZES) - 1])
        for size in SIZES:
            n = len(points) - size + 1
            if n <= 0:
                continue
            with np.errstate(over="ignore"):
                h = points[:n] * FACTORS[0]
                for k in range(1, size):
                    h = (h ^ (h >> np.uint64(29))) * FACTORS[1] + points[k : n + k] * FACTORS[k]
                h ^= h >> np.uint64(32)
            yield h


def slots(h: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield ((h * FACTORS[k + 1]) >> np.uint64(44)).astype("i8") & (SLOTS - 1)


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # SLOTS x bytes, bit l of a slot stands for languages[l]

    def false_rates(self) -> np.ndarray:
        filled = sum(BITS[np.bitwise_and(self.table, 255)[i : i + SLICE]].sum(0) for i in range(0, SLOTS, SLICE))
        return (filled.reshape(-1)[: len(self.languages)] / SLOTS) ** HASHES

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams, and how many of them each language may contain."""
        n, width = 0, self.table.shape[1]
        found = np.zeros((width, 256), "i8")
        for h in grams(text):
            masks = None
            for at in slots(h):
                masks = self.table[at] if masks is None else masks & self.table[at]
            n += len(h)
            for b in range(width):
                found[b] += np.bincount(masks[:, b], minlength=256)
        return n, (found @ BITS).reshape(-1)[: len(self.languages)]


@in_scratch
def fit(df: DataFrame, lang: str, text: str, key: str, *, sample: int = SAMPLE, languages: int = MAX_LANGUAGES) -> Filters:
    """Learn from the rows of df, `key` being what a hash draws the sample by, with the text. What reaches the driver is
    bounded: `languages` counts, and SLOTS cells of one byte for each eight languages."""
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key")).where("lang IS NOT NULL AND text IS NOT NULL")
    found = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    names = [r["lang"] for r in found]
    own = Filters(names, np.zeros((SLOTS, max(1, -(-len(names) // 8))), "u1"))
    if not names:
        return own
    shares = df.sparkSession.createDataFrame([(r["lang"], i, min(1.0, sample / r["count"])) for i, r in enumerate(found)], "lang string, place int, share double")
    # one row for each language
    drawn = rows.join(F.broadcast(shares), "lang").where(draw("key", "text") < F.col("share")).select(F.col("place").alias("lang"), "text")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = [*grams(value.as_py())]
                own = np.unique(np.concatenate(h)) if h else np.array([], "u8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i), pa.int32()), pa.array(own.view("i8"))], names=["lang", "gram"])
                yield pa.RecordBatch.from_arrays([pa.array([-1 - i], pa.int32()), pa.array([0], pa.int64())], names=["lang", "gram"])

    counted = stage(drawn.mapInArrow(distinct, "lang int, gram long").groupBy("lang", "gram").agg(F.count("*").alias("docs")), "grams")
    # how many documents were drawn for a language stands in the row -1 - place
    totals = counted.where("lang < 0").select((-1 - F.col("lang")).alias("lang"), F.col("docs").alias("drawn"))
    least = F.greatest(F.when(F.col("drawn") > 20, MIN_DOCS).otherwise(1), F.floor(MIN_SHARE * F.col("drawn")))
    kept = counted.where("lang >= 0").join(F.broadcast(totals), "lang").where(F.col("docs") >= least).select("lang", "gram")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view("u8")
            for at in slots(h):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(lang >> 3), pa.array(1 << (lang & 7))], names=["slot", "byte", "bits"])

    filled = kept.mapInArrow(cells, "slot int, byte int, bits int").groupBy("slot", "byte").agg(F.bit_or("bits").alias("bits")).toArrow()
    own.table[filled.column("slot").to_numpy(), filled.column("byte").to_numpy()] = filled.column("bits").to_numpy().astype("u1")
    return own


def identify(df: DataFrame, filters: Filters, text_col: str = "text", *, prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the columns prediction and score; columns of these names are replaced."""
    base = df.drop(prediction, score)
    place = base.columns.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast((filters, filters.false_rates()))  # SLOTS x languages / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rates = shared.value
        known = letters()
        for batch in batches:
            names, scores = [], []
            for value in batch.column(place):
                text = value.as_py()
                name, best = UNKNOWN, 0.0
                if text and own.languages and known[np.frombuffer(text.encode("utf-32-le"), "u4")].any():
                    n, counts = own.counts(text)
                    shares = np.maximum(0, (counts - n * rates) / (1 - rates)) / max(n, 1)
                    name, best = own.languages[int(shares.argmax())], float(min(1.0, shares.max()))
                names.append(name)
                scores.append(best)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, prediction, score])

    added = [T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())]
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *added]))
