"""Constraint checks and evidence digests: a table is valid when its violations have no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import canonical_json

# Grammars and limits of plans and catalogs.
PLUGIN = r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z"
FILE_NAME = r"\A[A-Za-z0-9][A-Za-z0-9._+@() -]{0,254}\z"
REFERENCE = r"\A[A-Za-z0-9][A-Za-z0-9._@+=:/-]{0,511}\z"
DIGEST = r"\A[0-9a-f]{64}\z"
SHA1 = r"\A[0-9a-f]{40}\z"
RESULT_BYTES = 64 << 20
CATALOG_UNITS, UNIT_BYTES = 50_000, 1 << 20
FAILURE_FIELDS = (
    "jobId", "registryKey", "externalObjectId", "registryAuthorityDigest", "validatorProfileDigest",
    "expectedRegistryHeadGeneration", "leaseFence", "failureCode", "diagnosticCode",
)
PRESENT_FIELDS = (
    "entryDigest", "repositoryId", "repositoryOwnerId", "repositoryOwnerLogin", "repositoryName", "releaseId", "releaseTag", "releaseCommitSha",
)


SAFE_INTEGER, CONTENT_BYTES = (1 << 53) - 1, 64 << 20


def is_identifier(value: Column, most: int, extra: str = "-") -> Column:
    """Basic Latin letters, digits and the characters of `extra`; neither a dot nor two dots, and no double slash."""
    inside = "".join("\\" + c for c in extra)
    return F.coalesce(value.rlike(rf"\A[A-Za-z0-9{inside}]{{1,{most}}}\z") & ~value.isin(".", "..") & ~F.contains(value, F.lit("//")), F.lit(False))


def is_positive(value: Column) -> Column:
    return F.coalesce(value.between(1, SAFE_INTEGER), F.lit(False))


def is_bounded(value: Column, low: int, high: int | Column) -> Column:
    return F.coalesce(value.between(low, high), F.lit(False))


def is_content_size(value: Column) -> Column:
    return is_bounded(value, 0, CONTENT_BYTES)


def is_bounded_text(value: Column, most: int) -> Column:
    """Not blank, and of `most` characters at most."""
    return F.coalesce(value.rlike(r"(?U)\S") & (F.length(value) <= most), F.lit(False))


def is_reference(value: Column) -> Column:
    """A name of a tag or branch, without an empty part."""
    return F.coalesce(value.rlike(REFERENCE) & ~F.contains(value, F.lit("//")), F.lit(False))


def is_https_base(value: Column) -> Column:
    """An https address without query whose path is empty, / or /api."""
    return is_https_url(value, query=False) & value.rlike(r"(?i)\Ahttps://[^/?#]+(?:/|/api)?\??#?\z")


def commit_revision(date: Column, sha: Column) -> Column:
    """A number that rises with the commit's time: its second times a million, and the first five digits of its SHA-1; null for a time without zone or before 1970."""
    second = F.when(date.rlike(r"(?:Z|[+-]\d\d:?\d\d)\z"), F.unix_timestamp(F.try_to_timestamp(date)))
    return F.when(second >= 1, second * 1_000_000 + F.conv(F.substring(sha, 1, 5), 16, 10).cast("long"))


def is_uuid(value: Column) -> Column:
    """In lower case, with its dashes."""
    return F.coalesce(value.rlike(r"\A[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"), F.lit(False))


def is_https_url(value: Column, *, query: bool) -> Column:
    """An https address with a host, without user, password or fragment, and without a query unless that is allowed."""
    rest = r"(\?[^#]*)?#?" if query else r"\??#?"
    return F.coalesce(value.rlike(rf"(?i)\Ahttps://[^/?#@:]+(:[0-9]*)?(/[^?#]*)?{rest}\z"), F.lit(False))


def repository_reference(repo: Column) -> Column:
    """owner and name of `owner/name`; null for what is none."""
    parts = F.split(repo, "/", -1)
    sound = (F.size(parts) == 2) & is_identifier(parts[0], 39) & is_identifier(F.get(parts, F.lit(1)), 100, "._-")
    return F.when(sound, F.struct(parts[0].alias("owner"), F.get(parts, F.lit(1)).alias("name")))


def diagnostic_code(code: Column) -> Column:
    return F.when(code.rlike(r"\A[a-z0-9_]{1,128}\z"), code).otherwise("unknown")


def failure_code(code: Column, retryable: Column) -> Column:
    """The public code that stands for an inner one of a command."""
    has = lambda *parts: code.rlike("|".join(parts))
    return (
        F.when(retryable, "executor_workflow_failed")
        .when(has("source", "component", "license"), "source_validation_rejected")
        .when(has("profile", "binding"), "registry_projection_changed")
        .when(has("adapter", "result_"), "adapter_validation_rejected")
        .otherwise("executor_workflow_failed")
    )


def resolution_failure_code(code: Column, retryable: Column, http_status: Column) -> Column:
    """The public code that stands for an inner one of a registry resolution."""
    again = retryable | F.coalesce(http_status == 409, F.lit(False))
    return F.when(again, "registry_resolution_retryable").when(code.rlike("profile|binding"), "registry_profile_changed").otherwise("registry_validation_rejected")


def violations(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """Rows (key.., code), one for each rule that a row breaks; a rule that is null counts as broken. No shuffle."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(code)) for code, rule in rules.items())))
    return rows.select(*keys, F.explode(broken).alias("code"))


def plan_violations(plans: DataFrame, key: str) -> DataFrame:
    """Of source plans with assets array<struct<assetId, name, size, sha256>>, primaryAssetId, commitSha, sourcePlanDigest and resultMaxBytes."""
    ids, names = F.transform("assets", lambda a: a.assetId), F.transform("assets", lambda a: a["name"])
    main = F.filter("assets", lambda a: a.assetId == F.col("primaryAssetId"))
    rules = {
        "assets-empty": F.size("assets") > 0,
        "asset-id-repeated": F.size(F.array_distinct(ids)) == F.size(ids),
        "asset-name-repeated": F.size(F.array_distinct(names)) == F.size(names),
        "asset-size": F.forall("assets", lambda a: F.coalesce(a.size > 0, F.lit(False))),
        "asset-digest": F.forall("assets", lambda a: F.coalesce(a.sha256.rlike(DIGEST), F.lit(False))),
        "primary-asset": (F.size(main) == 1) & (F.get(main, F.lit(0)).getField("name") == "main.js"),
        "commit": F.col("commitSha").rlike(SHA1),
        "plan-digest": F.col("sourcePlanDigest").rlike(DIGEST),
        "result-size": F.col("resultMaxBytes").between(1, RESULT_BYTES),
    }
    return violations(plans, [key], rules)


def catalog_violations(units: DataFrame, catalog: str) -> DataFrame:
    """Rows (catalog, code) of units (catalog, key, text): too many units, repeated keys, over-long or empty texts, texts with NUL."""
    counted = units.groupBy(catalog, "key").agg(
        F.count("*").alias("n"), F.max(F.octet_length("text")).alias("longest"), F.bool_or(F.coalesce(F.contains("text", F.lit("\x00")) | (F.col("text") == ""), F.lit(True))).alias("bad")
    )
    whole = counted.groupBy(catalog).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max("longest").alias("longest"), F.bool_or("bad").alias("bad"))
    rules = {"too-many-units": F.col("n") <= CATALOG_UNITS, "key-repeated": F.col("most") == 1, "text-too-long": F.coalesce("longest", F.lit(0)) <= UNIT_BYTES, "text-invalid": ~F.col("bad")}
    return violations(whole, [catalog], rules)


def _digest(fields: Column) -> Column:
    return F.sha2(canonical_json(F.to_json(fields, {"ignoreNullFields": "false"})), 256)


def failure_evidence(failures: DataFrame) -> DataFrame:
    """The failures with `evidenceDigest` over their nine fixed fields; null fields count as null."""
    return failures.withColumn("evidenceDigest", _digest(F.struct(*FAILURE_FIELDS)))


def resolution_results(results: DataFrame, common: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sealed results and refused rows. A present result has all PRESENT_FIELDS and digests of all assets, an absent one none
    of them; both are digested over their own fields only."""
    status = F.col("resolutionStatus")
    have = [F.col(n).isNotNull() for n in PRESENT_FIELDS]
    every, some = have[0], have[0]
    for h in have[1:]:
        every, some = every & h, some | h
    sealed = F.coalesce(F.forall("assets", lambda a: a.sha256.isNotNull()), F.lit(True))
    none = F.coalesce(F.size("assets") == 0, F.lit(True))
    fine = F.coalesce(((status == "present") & every & sealed) | ((status == "absent") & ~some & none), F.lit(False))
    present = F.struct(*common, "resolutionStatus", *PRESENT_FIELDS, F.coalesce("assets", F.array().cast(results.schema["assets"].dataType)).alias("assets"))
    digest = F.when(status == "present", _digest(present)).otherwise(_digest(F.struct(*common, "resolutionStatus")))
    return results.where(fine).withColumn("evidenceDigest", digest), results.where(~fine)
