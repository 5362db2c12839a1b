"""Locale documents: JSON catalogs as rows of JSON pointer and text, one document a row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import canonical_locale, norm_text, pointer_segment, strict_json

# Deepest nesting and most entries of a document.
DEPTH, ENTRIES = 16, 10_000


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def _members(value: Column) -> Column:
    """The members of an object; of anything else, none."""
    return F.when(_is(value, "OBJECT"), F.try_variant_get(value, "$", "map<string,variant>"))


def _children(node: Column) -> Column:
    """An object gives way to its members, pointers extended; an empty one and any other node stay as they are."""
    below = F.transform(F.map_entries(_members(node.v)), lambda m: F.struct(F.concat(node.p, F.lit("/"), pointer_segment(m.key)).alias("p"), m.value.alias("v")))
    return F.when(F.size(_members(node.v)) > 0, below).otherwise(F.array(F.struct(node.p.alias("p"), node.v.alias("v"))))


def flatten(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (id, locale, pointer, text) and rejected documents (id, code) of documents (id, locale, content string).

    The root must be an object without repeated or empty keys; a list anywhere, deeper nesting than DEPTH or more than
    ENTRIES entries reject the whole document, as does a locale that is no tag. Values that are no text, and blank
    texts, are skipped. Null content is malformed; empty objects are accepted and give no entry."""
    # names of resources may write a locale with low lines
    locale = canonical_locale(F.replace(F.col("locale"), F.lit("_"), F.lit("-")))
    root = documents.select("id", locale.alias("locale"), strict_json(F.col("content")).alias("root"))
    nodes = root.withColumn("nodes", F.when(_is(F.col("root"), "OBJECT"), F.array(F.struct(F.lit("").alias("p"), F.col("root").alias("v")))))
    for _ in range(DEPTH):
        nodes = nodes.withColumn("nodes", F.flatten(F.transform("nodes", _children)))
    # a member with an empty key leaves an empty segment
    bad = lambda n: _is(n.v, "ARRAY") | n.p.rlike("/(?:/|$)")
    texts = F.transform(F.filter("nodes", lambda n: _is(n.v, "STRING")), lambda n: F.struct(n.p.alias("pointer"), F.variant_get(n.v, "$", "string").alias("text")))
    code = (
        F.when(F.col("locale").isNull(), "locale-invalid")
        .when(F.col("nodes").isNull() | F.exists("nodes", bad), "content-invalid")
        .when(F.exists("nodes", lambda n: F.size(_members(n.v)) > 0), "too-deep")
        .when(F.size(F.filter(texts, lambda t: t.text.rlike(r"\S"))) > ENTRIES, "too-many-entries")
    )
    judged = nodes.select("id", "locale", texts.alias("texts"), code.alias("code"))
    found = judged.where("code IS NULL").select("id", "locale", F.explode("texts").alias("t")).select("id", "locale", "t.pointer", norm_text("t.text").alias("text"))
    return found.where("text <> ''"), judged.where("code IS NOT NULL").select("id", "code")


def agreement(entries: DataFrame, reference: DataFrame) -> DataFrame:
    """Share of the entries (id, pointer, text) whose text equals that of the reference (pointer, text) under the same pointer."""
    same = F.coalesce(F.col("text") == F.col("_reference"), F.lit(False))
    joined = entries.join(reference.select("pointer", F.col("text").alias("_reference")), "pointer", "left")
    return joined.groupBy("id").agg((F.count_if(same) / F.count("*")).alias("agreement"))
