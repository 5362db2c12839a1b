"""Whole checks of source catalogs and source plans: rule sets over columns, one row for each rule that is broken."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.operators.checks import CATALOG_UNITS, DIGEST, FILE_NAME, RESULT_BYTES, SHA1, UNIT_BYTES, is_bounded, is_bounded_text, is_identifier, is_positive, is_reference, violations

# Names, limits and grammars of catalogs and plans.
CATALOG_BYTES = 16 << 20
SOURCES = {"runtime": ("main.js", "javascript"), "metadata": ("manifest.json", "json"), "documentation": ("README.md", "markdown")}
SCOPE, LANGUAGE = r"\A[a-z][a-z0-9]*(?:[-.:][a-z0-9]+)*\z", r"\A[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*\z"
RESOURCE = ("content_digest", "name", "object_kind_key", "resource_key", "version", "version_scheme")
ROLES = {"manifest.json": 1 << 20, "main.js": 63 << 20}
PLAN_IDS = ("ownerId", "repositoryId", "releaseId", "projectionGeneration")
PLAN_DIGESTS = ("authorityBindingDigest", "sourcePlanDigest", "adapterBuildDigest", "adapterProfileDigest", "materializationTargetDigest")
WEB_ASSET, WEB_BYTES = r"\A[a-z0-9][a-z0-9-]{0,63}[.]canonical-source-catalog[.]json\z", 16 << 20
WEB_TAG = r"\A[A-Za-z0-9][A-Za-z0-9._+/-]{0,254}\z"
PLAN_FIELDS = {
    **dict.fromkeys((*PLAN_IDS, "primaryAssetId", "resultMaxBytes"), "integer"),
    **dict.fromkeys((*PLAN_DIGESTS, "provider", "ownerLogin", "repositoryName", "commitSha", "tag", "resultSchema", "resultMediaType"), "string"),
    "assets": "array",
}
ASSET_FIELDS = {"assetId": "integer", "name": "string", "size": "integer", "sha256": "string"}


def _json_bytes(value: Column) -> Column:
    return F.octet_length(F.to_json(value)).cast("long")


def is_context(scopes: Column, locales: Column) -> Column:
    """1 to 64 scopes and at most 256 locales, all of their grammar, sorted and distinct."""
    tidy = lambda c: c == F.array_sort(F.array_distinct(c))
    fine = F.size(scopes).between(1, 64) & F.forall(scopes, lambda s: F.coalesce(s.rlike(SCOPE) & (F.length(s) <= 64), F.lit(False))) & tidy(scopes)
    fine = fine & (F.size(locales) <= 256) & F.forall(locales, lambda s: F.coalesce(s.rlike(LANGUAGE) & (F.length(s) <= 64), F.lit(False))) & tidy(locales) & locales.isNotNull()
    return F.coalesce(fine, F.lit(False))


def _clean(*texts: Column) -> Column:
    return reduce(lambda a, b: a & b, (~F.contains(F.coalesce(t, F.lit("")), F.lit("\x00")) for t in texts))


def catalog_breaches(catalogs: DataFrame, sources: DataFrame, units: DataFrame, protocol: str) -> DataFrame:
    """Rows (catalog, code, n): a rule that a catalog breaks and how often; a catalog without rows is valid.

    catalogs: catalog, protocol, revision, resource struct<RESOURCE..>, stream struct<locale, stream_key>. sources: catalog, key, logical_path, format_family.
    units: catalog, key, text, source_key, placeholder_signature, format_signature, content_scopes, upstream_locale_coverage. The size is that of the canonical JSON
    document: the lengths of its parts are summed, the document isn't made. Sources and units of a catalog that isn't in `catalogs` break `catalog-missing`."""
    r, t = (lambda n: F.col(f"resource.{n}")), (lambda n: F.col(f"stream.{n}"))
    one = violations(
        catalogs, ["catalog"],
        {
            "protocol": F.col("protocol") == protocol, "revision": F.col("revision") == 2,
            "resource-key": is_bounded_text(r("resource_key"), 200), "resource-name": is_bounded_text(r("name"), 240), "resource-version": is_bounded_text(r("version"), 240),
            "version-scheme": r("version_scheme") == "semver", "object-kind": r("object_kind_key") == "plugin", "content-digest": r("content_digest").rlike(DIGEST),
            "stream-key": t("stream_key") == F.concat(F.lit("community-resource:"), r("resource_key")), "stream-locale": t("locale") == "en",
            "catalog-nul": _clean(*(r(n) for n in RESOURCE), t("stream_key"), t("locale")),
        },
    )
    known = F.create_map(*(x for k, (path, family) in SOURCES.items() for x in (F.lit(k), F.struct(F.lit(path).alias("p"), F.lit(family).alias("f")))))
    defined = (F.col("logical_path") == known[F.col("key")]["p"]) & (F.col("format_family") == known[F.col("key")]["f"])
    source_rules = violations(sources, ["catalog"], {"source-undefined": defined})
    unit_rules = violations(
        units, ["catalog"],
        {
            "unit-key": is_bounded_text(F.col("key"), 240), "unit-text": F.col("text").rlike(r"(?U)\S"), "unit-text-size": F.octet_length(F.coalesce("text", F.lit(""))) <= UNIT_BYTES,
            "unit-placeholders": F.length("placeholder_signature") <= 4096, "unit-format": F.col("format_signature") == "plain-text-v1",
            "unit-context": is_context(F.col("content_scopes"), F.col("upstream_locale_coverage")), "unit-nul": _clean(F.col("key"), F.col("text"), F.col("placeholder_signature")),
        },
    )
    by_source = sources.groupBy("catalog", "key").agg(F.count("*").alias("n"))
    by_key = units.groupBy("catalog", "key").agg(F.count("*").alias("n"))
    assigned = units.groupBy("catalog", F.col("source_key").alias("key")).agg(F.count("*").alias("n"))
    pairs = by_source.select("catalog", "key", F.lit(1).alias("has")).join(assigned.withColumn("used", F.lit(1)), ["catalog", "key"], "full")
    sets = pairs.select("catalog", F.when(F.col("has").isNull(), "unit-source-unknown").when(F.col("used").isNull(), "source-unused").alias("code")).where("code IS NOT NULL")
    repeated = by_key.where("n > 1").select("catalog", F.lit("unit-key-repeated").alias("code")).unionByName(by_source.where("n > 1").select("catalog", F.lit("source-repeated").alias("code")))
    # a null member is no member of canonical JSON, but breaks a rule of its own
    context = F.struct(F.struct("content_scopes", "upstream_locale_coverage").alias("context"), "format_signature", "key", "placeholder_signature", "source_key", "text")
    unit_size = units.groupBy("catalog").agg(F.count("*").alias("units"), F.sum(_json_bytes(context)).alias("unit_bytes"))
    source_size = sources.groupBy("catalog").agg(F.count("*").alias("sources"), F.sum(_json_bytes(F.struct("format_family", "key", "logical_path"))).alias("source_bytes"))
    shell = F.struct("protocol", F.struct(*(r(n).alias(n) for n in RESOURCE)).alias("resource"), "revision", F.array().cast("array<string>").alias("sources"), F.struct(t("locale").alias("locale"), t("stream_key").alias("stream_key")).alias("stream"), F.array().cast("array<string>").alias("units"))
    sized = catalogs.select("catalog", _json_bytes(F.struct(shell.alias("source_catalog"))).alias("shell_bytes")).join(source_size, "catalog", "left").join(unit_size, "catalog", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    total = F.col("shell_bytes") + n("source_bytes") + n("unit_bytes") + F.greatest(n("sources") - 1, F.lit(0)) + F.greatest(n("units") - 1, F.lit(0))
    whole = violations(sized, ["catalog"], {"size": total <= CATALOG_BYTES, "source-count": is_bounded(n("sources"), 1, len(SOURCES)), "unit-count": is_bounded(n("units"), 1, CATALOG_UNITS)})
    owned = sources.select("catalog").union(units.select("catalog")).distinct()
    orphans = owned.join(catalogs.select("catalog"), "catalog", "left_anti").withColumn("code", F.lit("catalog-missing"))
    parts = [one, source_rules, unit_rules, sets, repeated, whole, orphans]
    return reduce(DataFrame.unionByName, parts).groupBy("catalog", "code").agg(F.count("*").alias("n"))


def _shared(media_type: str, build: str) -> dict[str, Column]:
    distinct = lambda name: F.size(F.array_distinct(F.transform("assets", lambda a: a[name]))) == F.size("assets")
    return {
        "provider": F.col("provider") == "github_release",
        **{f"id:{n}": is_positive(F.col(n)) for n in PLAN_IDS}, **{f"digest:{n}": F.col(n).rlike(DIGEST) for n in PLAN_DIGESTS},
        "commit": F.col("commitSha").rlike(SHA1), "tag": is_reference(F.col("tag")), "media-type": F.col("resultMediaType") == media_type,
        "result-size": is_bounded(F.col("resultMaxBytes"), 1, RESULT_BYTES), "binding": F.col("adapterBuildDigest") == F.col(build),
        "asset-id": F.forall("assets", lambda a: is_positive(a["assetId"])), "asset-digest": F.forall("assets", lambda a: F.coalesce(a["sha256"].rlike(DIGEST), F.lit(False))),
        "asset-id-repeated": distinct("assetId"), "asset-name-repeated": distinct("name"),
    }


def release_plan_breaches(plans: DataFrame, key: str, media_type: str, build: str = "claimedBuildDigest") -> DataFrame:
    """Rows (key, code) for each rule that a plan of a release breaks: PLAN_FIELDS as columns, assets array<struct<assetId, name, size, sha256>>, and the build digest of the claim."""
    named = lambda name: F.filter("assets", lambda a: a["name"] == name)
    component = lambda name: (F.size(named(name)) == 1) & is_bounded(F.get(named(name), F.lit(0))["size"], 1, ROLES[name])
    rules = _shared(media_type, build) | {
        "asset-count": is_bounded(F.size("assets"), 1, 64), "asset-name": F.forall("assets", lambda a: F.coalesce(a["name"].rlike(FILE_NAME), F.lit(False))),
        "asset-size": F.forall("assets", lambda a: is_bounded(a["size"], 0, (1 << 53) - 1)), "manifest": component("manifest.json"), "main": component("main.js"),
        "primary-asset": F.get(named("main.js"), F.lit(0))["assetId"] == F.col("primaryAssetId"),
        "owner": is_identifier(F.col("ownerLogin"), 39), "repository": is_identifier(F.col("repositoryName"), 100, "._-"), "schema": is_identifier(F.col("resultSchema"), 128, "._/-"),
    }
    return violations(plans, [key], rules)


def web_plan_breaches(plans: DataFrame, key: str, media_type: str, schema: str, build: str = "claimedBuildDigest") -> DataFrame:
    """The same for a plan of a frozen web catalog: a single asset, which is the primary one, and no part of the tag is a dot or two dots."""
    only = F.get("assets", F.lit(0))
    rules = _shared(media_type, build) | {
        "asset-count": F.size("assets") == 1, "asset-name": only["name"].rlike(WEB_ASSET), "asset-size": is_bounded(only["size"], 1, WEB_BYTES), "primary-asset": only["assetId"] == F.col("primaryAssetId"),
        "owner": F.col("ownerLogin").rlike(r"\A[A-Za-z0-9][A-Za-z0-9-]{0,38}\z"), "repository": F.col("repositoryName").rlike(r"\A[A-Za-z0-9._-]{1,100}\z"), "schema": F.col("resultSchema") == schema,
        "tag-part": F.col("tag").rlike(WEB_TAG) & ~F.exists(F.split("tag", "/"), lambda p: p.isin(".", "..")),
    }
    return violations(plans, [key], rules)
