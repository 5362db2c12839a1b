"""Which strings a release already translates: states that merge over carriers in any order, and the identity of the resources behind them.

A carrier is a way in which translations are shipped (locale files, catalogs inside a bundle). For each string it says nothing (no row), gives a target, or has
rejected the string; a rejection holds for all carriers. Nothing is gathered but the resources of one owner, locale and carrier, which are as many as a
release has files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import placeholder_signature

# The locale that strings are written in, the carrier whose entries count for runtime text only, and the resource without a name.
SOURCE_LOCALE, FILES, DEFAULT = "en", "explicit", "default"


def judged(pairs: DataFrame, group: list[str]) -> DataFrame:
    """States (group.., rejected, target, resource_key) of pairs (group.., resource_key, source, target). A group is rejected once
    a pair repeats its source, changes the placeholders or has no target, or two targets differ. resource_key may be a struct; the smallest stays."""
    bad = (F.col("source") == F.col("target")) | (placeholder_signature(F.col("source")) != placeholder_signature(F.col("target")))
    found = pairs.groupBy(*group).agg(F.bool_or(F.coalesce(bad, F.lit(True))).alias("bad"), F.min("target").alias("low"), F.max("target").alias("high"), F.min("resource_key").alias("resource_key"))
    return _states(found, group)


def _states(found: DataFrame, group: list[str]) -> DataFrame:
    rejected = F.col("bad") | ~F.col("low").eqNullSafe(F.col("high"))
    return found.select(*group, rejected.alias("rejected"), F.when(~rejected, F.col("low")).alias("target"), F.when(~rejected, F.col("resource_key")).alias("resource_key"))


def merged(states: Sequence[DataFrame] | DataFrame, group: list[str]) -> DataFrame:
    """The states of several carriers as one: rejected where any is or two targets differ; of equal targets the smallest resource_key stays.
    Merging is associative, and the order of carriers and rows plays no part."""
    rows = states if isinstance(states, DataFrame) else reduce(DataFrame.unionByName, [s.select(*group, "rejected", "target", "resource_key") for s in states])
    found = rows.groupBy(*group).agg(F.bool_or("rejected").alias("bad"), F.min("target").alias("low"), F.max("target").alias("high"), F.min("resource_key").alias("resource_key"))
    return _states(found, group)


def held(states: DataFrame) -> DataFrame:
    """The translations that stand."""
    return states.where("NOT rejected").drop("rejected")


def matched(resources: DataFrame, at: list[str], source: str = SOURCE_LOCALE) -> DataFrame:
    """Resources (at.., locale, name, digest) of other locales that the same owner (and carrier) also has in the source locale, with source_name and source_digest."""
    own = resources.where(F.col("locale") == source).select(*at, F.col("name").alias("source_name"), F.col("digest").alias("source_digest"))
    return resources.where(F.col("locale") != source).join(own, at)


def _canonical(name: str, parts: Column) -> Column:
    """{"name":[..]} without white space; the structs' fields are in the order of canonical JSON already."""
    return F.to_json(F.struct(parts.alias(name)))


def set_identity(resources: DataFrame, by: list[str], name: str = "name", digest: str = "digest") -> DataFrame:
    """by.., name and digest of the set of resources (by.., resource_id, name, digest): a single resource keeps its own, more are named by their number and
    digested as canonical JSON, sorted by resource_id. Names must not hold control characters."""
    part = F.struct("resource_id", F.col(name).alias("name"), F.col(digest).alias("digest"))
    sets = resources.groupBy(*by).agg(F.sort_array(F.collect_list(part)).alias("_set"))
    listed = F.transform("_set", lambda r: F.struct(r["digest"].alias("digest"), r["name"].alias("name"), r["resource_id"].alias("resource_id")))
    one, first = F.size("_set") == 1, F.get("_set", F.lit(0))
    return sets.select(
        *by,
        F.when(one, first["name"]).otherwise(F.concat(F.lit("locale-component-set:"), F.size("_set").cast("string"))).alias(name),
        F.when(one, first["digest"]).otherwise(F.sha2(_canonical("components", listed), 256)).alias(digest),
    )


def _over_carriers(states: Column, kind: str, name: str, digest: str) -> tuple[Column, Column]:
    first = F.get(states, F.lit(0))
    listed = F.transform(states, lambda s: F.struct(s["carrier"].alias("carrier"), s[digest].alias("digest"), s[name].alias("name")))
    joined = F.array_join(F.transform(states, lambda s: s["carrier"]), "+")
    one = F.size(states) == 1
    return (
        F.when(one, first[name]).otherwise(F.concat(F.lit(f"native-locale-{kind}-set:"), joined)),
        F.when(one, first[digest]).otherwise(F.sha2(_canonical("resources", listed), 256)),
    )


def native_coverage(resources: DataFrame, entries: DataFrame, found: DataFrame, source: str = SOURCE_LOCALE) -> tuple[DataFrame, DataFrame]:
    """Locales (owner, locale, covered, resource_name, resource_digest, source_resource_name, source_resource_digest) and their entries
    (owner, locale, string_key, resource_key, placeholder_signature, target).

    resources: owner, carrier, resource_id, locale, name, digest, of documents that could be read; at most one for each resource and locale.
    entries: owner, carrier, resource_id, locale, resource_key, text. found: owner, source, key, semantic_role, at most one row for each text.
    A target counts if the owner's resource of this carrier has the key in the source locale too, with the text of a found string; entries of files count for runtime
    text only. The identity of a locale covers all carriers that match resources, those that add no entry as well; locales without entries go."""
    at = ["owner", "carrier", "resource_id"]
    sound = matched(resources, at, source)
    by = ["owner", "locale", "carrier"]
    own = set_identity(sound, by).join(set_identity(sound.drop("name", "digest"), by, "source_name", "source_digest"), by)
    texts = entries.where(F.col("locale") == source).select(*at, "resource_key", F.col("text").alias("source"))
    pairs = entries.where(F.col("locale") != source).select(*at, "resource_key", "locale", F.col("text").alias("target")).join(texts, [*at, "resource_key"])
    pairs = pairs.join(sound.select(*at, "locale"), [*at, "locale"], "left_semi")
    strings = found.select("owner", "source", F.col("key").alias("string_key"), "semantic_role")
    pairs = pairs.join(strings, ["owner", "source"]).where((F.col("carrier") != FILES) | (F.col("semantic_role") == "runtime-ui"))
    states = judged(pairs.withColumn("resource_key", F.struct("resource_id", "resource_key")), [*by, "string_key"])
    key = F.when(F.col("carrier").eqNullSafe(FILES) & (F.col("resource_key.resource_id") != DEFAULT), F.concat_ws(":", "resource_key.resource_id", "resource_key.resource_key"))
    states = states.withColumn("resource_key", F.coalesce(key, F.col("resource_key.resource_key")))
    covered = held(merged(states, ["owner", "locale", "string_key"]))
    counts = covered.groupBy("owner", "locale").agg(F.count("*").alias("covered"))
    carriers = own.groupBy("owner", "locale").agg(F.sort_array(F.collect_list(F.struct("carrier", "name", "digest", "source_name", "source_digest"))).alias("states"))
    name, digest = _over_carriers(F.col("states"), "target", "name", "digest")
    source_name, source_digest = _over_carriers(F.col("states"), "source", "source_name", "source_digest")
    locales = carriers.join(counts, ["owner", "locale"]).select(
        "owner", "locale", "covered", name.alias("resource_name"), digest.alias("resource_digest"), source_name.alias("source_resource_name"), source_digest.alias("source_resource_digest")
    )
    signed = strings.select("owner", "string_key", placeholder_signature(F.col("source")).alias("placeholder_signature"))
    return locales, covered.join(signed, ["owner", "string_key"])
