"""Release components: verified against their evidence; what fails goes to a quarantine table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import norm_text
from uiloom.functions.variants import members, strict_value

# Largest size of a component by role, in bytes.
LIMITS = {"main": 63 << 20, "manifest": 1 << 20, "readme": 1 << 20, "registry-metadata": 1 << 20, "locale": 4 << 20}


def verified(components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of (plugin_id, role, content, size, sha256); rejected ones have a `code`."""
    limit = F.create_map(*(x for k, v in LIMITS.items() for x in (F.lit(k), F.lit(v))))
    size = F.octet_length("content")
    code = (
        F.when(size != F.col("size"), "size-mismatch")
        .when(F.sha2("content", 256) != F.col("sha256"), "digest-mismatch")
        .when(size > F.coalesce(limit[F.split("role", ":")[0]], F.lit(0)), "too-large")
    )
    checked = components.withColumn("code", code)
    return checked.where("code IS NULL").drop("code"), checked.where("code IS NOT NULL")


def manifests(components: DataFrame) -> DataFrame:
    """plugin_id, name, version, description of the manifests that are strict JSON and carry the id of their row; texts are normalised, and name and version are not blank."""
    parsed = components.where("role = 'manifest'").select("plugin_id", members(strict_value(F.decode("content", "UTF-8"))).alias("m"))
    field = lambda name: F.try_variant_get(F.element_at("m", F.lit(name)), "$", "string")
    named = parsed.select("plugin_id", field("id").alias("id"), *(norm_text(field(n)).alias(n) for n in ("name", "version", "description")))
    return named.where("id = plugin_id AND name <> '' AND version <> ''").drop("id")
