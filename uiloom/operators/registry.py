"""Registry resolution: directory lookup, release choice and licence evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# History searched, and the grammar of a stable version.
HISTORY = 300
STABLE = r"\Av?\d+\.\d+\.\d+(\+[0-9A-Za-z.-]+)?\z"


def choose_release(releases: DataFrame, keys: list[str], latest: DataFrame | None = None) -> DataFrame:
    """One release of each repository, from rows (keys.., position, tag, draft, prerelease), newest first.
    The latest one if it is stable (rows keys.., tag, draft, prerelease; at most one for each repository), else the first stable one within HISTORY; else,
    if the history ends there, a preview: the latest or the first that is no draft; else none; `search-limit` if there is more history than that (`tag` is null for both)."""
    is_stable = ~F.col("draft") & ~F.col("prerelease") & F.col("tag").rlike(STABLE)
    seen = F.col("position") < HISTORY
    first = lambda which: F.min_by("tag", F.when(which & seen, F.col("position")))
    picked = releases.groupBy(*keys).agg(first(is_stable).alias("stable"), first(~F.col("draft")).alias("preview"), F.count("*").alias("n"))
    if latest is not None:
        own = latest.select(*keys, F.when(is_stable, F.col("tag")).alias("_stable"), F.when(~F.col("draft"), F.col("tag")).alias("_preview"))
        picked = picked.join(own, keys, "full").withColumns({"stable": F.coalesce("_stable", "stable"), "preview": F.coalesce("_preview", "preview"), "n": F.coalesce("n", F.lit(0))})
    tag = F.coalesce("stable", F.when(F.col("n") < HISTORY, F.col("preview")))
    kind = F.when(F.col("stable").isNotNull(), "stable").when(tag.isNotNull(), "preview").when(F.col("n") < HISTORY, "none").otherwise("search-limit")
    return picked.select(*keys, tag.alias("tag"), kind.alias("kind"))


def look_up(claims: DataFrame, directory: DataFrame, key: str) -> DataFrame:
    """Claims with `state`: present, absent, or ambiguous where the directory repeats an id."""
    entries = directory.groupBy(key).agg(F.count("*").alias("_n"))
    state = F.when(F.col("_n").isNull(), "absent").when(F.col("_n") == 1, "present").otherwise("ambiguous")
    return claims.join(entries, key, "left").withColumn("state", state).drop("_n")


def licence_evidence(documents: DataFrame) -> DataFrame:
    """documents (id, spdx, content base64) with the digest of the licence text and its identifier; null content is refused."""
    body = F.try_to_binary(F.regexp_replace("content", "[\r\n]", ""), F.lit("base64"))
    digest = F.sha2(body, 256)
    name = F.when(F.col("spdx") == "NOASSERTION", F.concat(F.lit("LicenseRef-SHA256-"), digest)).otherwise(F.col("spdx"))
    return documents.select("id", digest.alias("sha256"), F.when(digest.isNotNull(), name).alias("licence"))
