"""Snapshots of releases as tables: the strings of all carriers of text, and the source catalog made of them, in its fixed order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uiloom.operators import catalog
from uiloom.operators.matching import positions
from uiloom.operators.rules import SOURCES

# What is read of manifests and of the registry, and the signature of plain text.
NAMED, PLAIN = ("name", "description"), "plain-text-v1"


def metadata_candidates(named: DataFrame, carrier: str) -> DataFrame:
    """Candidates of manifests or registry entries (plugin_id, name, description): one for each text that is there; carrier: `manifest` or `registry`."""
    each = F.explode(F.array(*(F.struct(F.lit(f"{carrier}.{n}").alias("origin"), F.lit(n).alias("symbol"), F.col(n).alias("value")) for n in NAMED)))
    rows = named.select("plugin_id", each.alias("c")).select("plugin_id", "c.origin", "c.symbol", "c.value").where("value IS NOT NULL")
    return rows.select("plugin_id", "origin", "symbol", "value", F.lit(None).cast("int").alias("offset"), F.lit("structured").alias("strategy"))


def candidates(*parts: DataFrame) -> DataFrame:
    """The union of candidates (plugin_id, origin, symbol, value, offset, strategy), whatever else their carriers tell."""
    columns = ("plugin_id", "origin", "symbol", "value", "offset", "strategy")
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def source_units(strings: DataFrame, covered: DataFrame) -> DataFrame:
    """Units (plugin_id, position, key, source_key, text, placeholder_signature, format_signature, content_scopes, upstream_locale_coverage) of strings as `catalog.strings` gives them: by code points of the
    text and gapless in each plugin. What only the registry says is no unit. covered: plugin_id, key, locale."""
    canonical = strings.where("source_key IS NOT NULL")
    located = catalog.units(canonical, covered, ["plugin_id", "key"])
    rows = located.select("plugin_id", F.col("source").alias("text"), "key", "source_key", "placeholder_signature", F.lit(PLAIN).alias("format_signature"), "content_scopes", F.col("locales").alias("upstream_locale_coverage"))
    return positions(rows, ["plugin_id", "text"], ["plugin_id"])


def source_list(units: DataFrame) -> DataFrame:
    """Sources (plugin_id, position, key, logical_path, format_family) that units are assigned to, in the fixed order of SOURCES."""
    used = units.groupBy("plugin_id").agg(F.collect_set("source_key").alias("used"))  # a few values at most
    known = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(path).alias("logical_path"), F.lit(family).alias("format_family")) for k, (path, family) in SOURCES.items()))
    return used.select("plugin_id", F.posexplode(F.filter(known, lambda s: F.array_contains(F.col("used"), s["key"]))).alias("position", "s")).select("plugin_id", "position", "s.*")
