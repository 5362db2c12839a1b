"""From documents to token ids, in stages that each call one operator of uiloom.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a table that is
written as Parquet and read again as the next one's docs. All but the last return the columns of
documents, further columns included.

Edge cases: null and letterless texts are rejected by the first stage. Documents without words are never
near duplicates. Of a group of near duplicates the row with the smallest id stays (null ids come last), and of several rows with
this id any one: rows are chosen, not ids, so rows that share an id or have none are judged by their own texts. Very long texts are
processed whole. Further columns are kept whatever their names. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uiloom.llm import bpe, jaccard, langid, mixing, pii
from uiloom.llm.common import Scratch, crc_mod, outer, scratch, stage, table
from uiloom.llm.queries import TARGETS, labelled_domains

#: Share of its n-grams that the predicted language must hold for a document to stay.
MIN_LANGUAGE = 0.2


def packed(docs: DataFrame) -> DataFrame:
    """row (all columns) and text: whatever the columns are named, an operator's own can't clash with them."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "text")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents whose language can't be told go."""
    filters = langid.fit(docs.where(crc_mod(F.col("doc_id"), 3) != 1), "lang", "text", "doc_id")
    found = langid.identify(packed(docs), filters)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: five-word shingles, similarity of 0.8 or more; one document of each group stays."""
    return jaccard.first_of_components(docs, size=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span gives way to the name of its kind; n_chars follows the text."""
    return pii.mask_column(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents are drawn by the fitted rates, none, once or several times."""
    mixed = mixing.mix(packed(docs), labelled_domains(spark, sf_dir), TARGETS, carry=["row"])
    return mixing.draw_copies(mixed, F.col("row.doc_id"), F.col("row.text")).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of each text; the ids must decode to the text's bytes."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", keep_identified),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_domains),
    ("byte-level BPE", tokenize),
]

#: SQL can't express these stages; tests compare each with brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    *steps, (_, last) = STAGES
    for i, (_, step) in enumerate(steps):
        after = Scratch(spark)
        with scratch(spark):  # what a stage writes for itself goes when its output is written
            # the last stage is read by the caller: its input belongs to the caller's scratch, or to the process
            docs = stage(step(spark, docs, sf_dir), "stage", owner=outer() if i == len(steps) - 1 else after)
        if before:
            before.drop()
        before = after
    return last(spark, docs, sf_dir)
