"""Requests as files: each holds the components of one release; one bad part refuses the request, not the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uiloom.functions import variants
from uiloom.operators.checks import DIGEST, SAFE_INTEGER, UNIT_BYTES, is_bounded, is_bounded_text

# The file and the largest size of each component, and the members of a request.
COMPONENTS = {"manifest": ("manifest.json", 1 << 20), "main": ("main.js", 63 << 20)}
REQUEST = {"authority_resource_version": "string", "components": "array", "materialization_target_digest": "string", "policy_revision": "integer", "protocol": "string"}
COMPONENT = {"content_base64": "string", "name": "string", "role": "string"}
BASE64 = r"\A(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z"


def read_requests(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """request (the file's path) and content of each file, with the columns of folders named column=value: filters on these leave out whole folders.
    Any store that Spark reads will do. The path parts of the columns aren't checked against the content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(path).withColumnRenamed("path", "request").drop("modificationTime", "length")


def _once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """A select whose columns are computed once: they come out of a generator, through which filters and later columns aren't rewritten in terms of their inputs."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def decode_requests(raw: DataFrame, protocol: str) -> tuple[DataFrame, DataFrame]:
    """Accepted requests (request, authority_resource_version, materialization_target_digest, policy_revision, name, version, description, manifest, main) and refused
    ones (request, code), of rows (request, content). A request is refused by the first rule that it breaks; null content is no request. No shuffle: a request is one row."""
    sound = lambda content: F.when(F.is_valid_utf8(content.cast("string")), variants.strict_value(F.decode(content, "UTF-8")))
    rows = _once(raw, "request", variants.members(sound(F.col("content"))).alias("own"))
    member = lambda name, kind: F.try_variant_get(F.element_at("own", F.lit(name)), "$", kind)
    rows = _once(
        rows, "request", (F.size(variants.shape(F.col("own"), REQUEST)) == 0).alias("shaped"), member("protocol", "string").alias("protocol"), member("materialization_target_digest", "string").alias("target"),
        member("authority_resource_version", "string").alias("version"), member("policy_revision", "bigint").alias("revision"), F.transform(member("components", "array<variant>"), variants.members).alias("parts"),
    )
    text = lambda p, name: F.try_variant_get(F.element_at(p, F.lit(name)), "$", "string")
    part = lambda p: F.struct(text(p, "role").alias("role"), text(p, "name").alias("name"), text(p, "content_base64").alias("text"), (F.size(variants.shape(p, COMPONENT)) == 0).alias("shaped"))
    rows = _once(rows, "request", "shaped", "protocol", "target", "version", "revision", F.transform("parts", part).alias("parts"))
    only = lambda role: F.filter("parts", lambda p: (p["role"] == role) & (p["name"] == COMPONENTS[role][0]))
    closed = (F.size("parts") == 2) & F.forall("parts", lambda p: p["shaped"]) & (F.size(only("manifest")) == 1) & (F.size(only("main")) == 1)
    body = lambda role: F.when(F.get(only(role), F.lit(0))["text"].rlike(BASE64), F.try_to_binary(F.get(only(role), F.lit(0))["text"], F.lit("base64")))
    kept = ["request", "shaped", "protocol", "target", "version", "revision"]
    rows = _once(rows, *kept, F.coalesce(closed, F.lit(False)).alias("closed"), body("manifest").alias("manifest"), body("main").alias("main"))
    sized = is_bounded(F.octet_length("manifest"), 1, COMPONENTS["manifest"][1]) & is_bounded(F.octet_length("main"), 1, COMPONENTS["main"][1])
    kept += ["closed", "manifest", "main"]
    rows = _once(rows, *kept, variants.members(sound(F.col("manifest"))).alias("m"))
    string = lambda name: F.try_variant_get(F.element_at("m", F.lit(name)), "$", "string")
    named = ("name", "version", "description")
    texts = (F.size(variants.shape(F.col("m"), dict.fromkeys(named, "string"), exact=False)) == 0).alias("texts")
    rows = _once(rows, *kept, texts, *(string(n).alias(f"m_{n}") for n in named))
    fine = F.col("texts") & is_bounded_text(F.col("m_name"), 240) & is_bounded_text(F.col("m_version"), 240) & F.col("m_description").rlike(r"(?U)\S") & (F.octet_length(F.regexp_replace("m_description", r"(?U)\A\s+|\s+\z", "")) <= UNIT_BYTES)
    code = (
        F.when(~F.coalesce(F.col("shaped"), F.lit(False)), "request-invalid").when(F.col("protocol") != protocol, "protocol-invalid")
        .when(~F.col("version").rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z"), "request-invalid").when(~F.col("target").rlike(DIGEST), "target-invalid")
        .when(~is_bounded(F.col("revision"), 1, SAFE_INTEGER), "request-invalid").when(~F.col("closed"), "closure-invalid").when(F.col("manifest").isNull() | F.col("main").isNull(), "base64-invalid")
        .when(~sized, "size-invalid").when(~F.coalesce(fine, F.lit(False)), "manifest-invalid")
    )
    judged = _once(rows, "request", "version", "target", "revision", "manifest", "main", *(f"m_{n}" for n in named), code.alias("code"))
    accepted = judged.where("code IS NULL").select(
        "request", F.col("version").alias("authority_resource_version"), F.col("target").alias("materialization_target_digest"), F.col("revision").alias("policy_revision"),
        *(F.col(f"m_{n}").alias(n) for n in named), "manifest", "main",
    )
    return accepted, judged.where("code IS NOT NULL").select("request", "code")
