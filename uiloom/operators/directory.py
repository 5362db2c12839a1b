"""Registry directories as a whole, releases and trees by exact count, and repositories under changed names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.operators.checks import DIGEST, PLUGIN, SHA1, is_bounded, is_identifier, is_positive, is_reference, repository_reference
from uiloom.operators.matching import exactly_one

# Most entries of a directory, and most assets of a release.
ENTRIES, ASSETS = 100_000, 1_000


def gate(entries: DataFrame, directory: list[str], most: int = ENTRIES) -> DataFrame:
    """One row (directory.., n, code) for each directory of entries (directory.., id, repo): code is null only if every entry has a plugin's id and a
    repository and no id recurs. Entries of one id are counted before they meet, so a directory is never gathered."""
    sound = F.coalesce(F.col("id").rlike(PLUGIN), F.lit(False)) & repository_reference(F.col("repo")).isNotNull()
    by_id = entries.groupBy(*directory, "id").agg(F.count("*").alias("n"), F.bool_and(sound).alias("sound"))
    whole = by_id.groupBy(*directory).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.bool_and("sound").alias("sound"))
    code = F.when(F.col("n") > most, "too-many-entries").when(~F.col("sound"), "entry-invalid").when(F.col("most") > 1, "id-repeated")
    return whole.select(*directory, "n", code.alias("code"))


def resolve(claims: DataFrame, entries: DataFrame, directory: list[str], most: int = ENTRIES) -> DataFrame:
    """Claims (directory.., id, ..) with state and repo: `refused` for every claim on a directory that its gate refuses, and where there is none; else present or absent."""
    passed = gate(entries, directory, most).select(*directory, F.col("code").isNull().alias("_open"))
    # of a directory that is open each id has one entry; of another any one, which isn't looked at
    known = entries.groupBy(*directory, "id").agg(F.min("repo").alias("_repo"))
    joined = claims.join(passed, directory, "left").join(known, [*directory, "id"], "left")
    state = F.when(~F.coalesce("_open", F.lit(False)), "refused").when(F.col("_repo").isNotNull(), "present").otherwise("absent")
    return joined.withColumn("state", state).withColumn("repo", F.when(F.col("state") == "present", F.col("_repo"))).drop("_open", "_repo")


def tree_blobs(required: DataFrame, trees: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """For each (tree_sha, path) that is required, the revision and size of the one plain file there, and violations. trees: tree_sha, truncated, path, type, mode, sha, size."""
    matches, violations = exactly_one(required, trees.select("tree_sha", "path", "truncated", "type", "mode", "sha", "size"), ["tree_sha", "path"])
    o = lambda n: F.col(f"offer.{n}")
    code = (
        F.when(F.coalesce(o("truncated"), F.lit(True)), "tree-truncated").when(~F.coalesce((o("type") == "blob") & (o("mode") == "100644"), F.lit(False)), "no-plain-file")
        .when(~F.coalesce(o("sha").rlike(SHA1), F.lit(False)), "revision-invalid").when(~is_bounded(o("size"), 1, most), "size-invalid")
    )
    judged = matches.withColumn("code", code)
    fine = judged.where("code IS NULL").select(*required.columns, o("sha").alias("revision"), o("size").alias("size"))
    return fine, violations.unionByName(judged.where("code IS NOT NULL").drop("offer"))


def release_assets(releases: DataFrame, assets: DataFrame, limits: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """The assets (release_id, name, asset_id, size, sha256) of releases that have each of the names in `limits` exactly once and sound, and violations (release_id, name, code).

    releases: release_id, tag, draft, prerelease. assets: release_id, asset_id, name, state, size, digest (`sha256:..`, or null where none is known). A release with any
    violation gives no asset; one that is a draft, or whose tag is no reference, violates under a null name."""
    sound = F.coalesce(~F.col("draft") & F.col("prerelease").isNotNull(), F.lit(False)) & is_positive(F.col("release_id")) & is_reference(F.col("tag"))
    bad = releases.where(~sound).select("release_id", F.lit(None).cast("string").alias("name"), F.lit("release-invalid").alias("code"))
    names = F.explode(F.array(*map(F.lit, sorted(limits))))
    required = releases.where(sound).select("release_id", names.alias("name")).join(F.broadcast(_table(releases, limits)), "name")  # a row for each required name
    crowded = assets.groupBy("release_id").agg(F.count("*").alias("n")).where(F.col("n") > ASSETS).select("release_id")
    matches, missing = exactly_one(required, assets.select("release_id", "name", "asset_id", "state", "size", "digest"), ["release_id", "name"])
    o = lambda n: F.col(f"offer.{n}")
    digest = F.regexp_replace(o("digest"), r"\Asha256:", "")
    code = (
        F.when(~F.coalesce(o("state") == "uploaded", F.lit(False)), "not-uploaded").when(~is_positive(o("asset_id")), "asset-id-invalid").when(~is_bounded(o("size"), 1, F.col("most")), "size-invalid")
        .when(o("digest").isNotNull() & ~(F.startswith(o("digest"), F.lit("sha256:")) & digest.rlike(DIGEST)), "digest-invalid")
    )
    judged = matches.select("release_id", "name", o("asset_id").alias("asset_id"), o("size").alias("size"), digest.alias("sha256"), code.alias("code"))
    twice = judged.groupBy("release_id", "asset_id").agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n > 1").select("release_id", "name", F.lit("asset-id-repeated").alias("code"))
    over = releases.join(crowded, "release_id", "left_semi").select("release_id", F.lit(None).cast("string").alias("name"), F.lit("too-many-assets").alias("code"))
    violations = bad.unionByName(missing.select("release_id", "name", "code")).unionByName(judged.where("code IS NOT NULL").select("release_id", "name", "code")).unionByName(twice).unionByName(over)
    return judged.drop("code").join(violations.select("release_id").distinct(), "release_id", "left_anti"), violations


def _table(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.sparkSession.createDataFrame(sorted(limits.items()), "name string, most long")


def _named(found: Column, owner: Column, name: Column) -> Column:
    """Whether public metadata has this owner and name, letters' case apart."""
    same = lambda a, b: F.lower(a) == F.lower(b)
    return F.coalesce(same(found["owner_login"], owner) & same(found["name"], name) & same(found["full_name"], F.concat(owner, F.lit("/"), name)) & ~found["private"], F.lit(False))


def _sound(found: Column) -> Column:
    return is_positive(found["id"]) & is_positive(found["owner_id"]) & is_identifier(found["owner_login"], 39) & is_identifier(found["name"], 100, "._-")


def repository_identity(claims: DataFrame, by_id: DataFrame) -> DataFrame:
    """Claims (.., owner, repo, found) with `state` and `identity` (id, owner_id, owner_login, name). found is what the old path led to: a struct of id, owner_id, owner_login, name, full_name and
    private. by_id: rows of these fields as they are known under the immutable id.

    `same`: the names agree. `renamed`: they don't, but the id confirms the new ones. `mismatch`: the id tells otherwise or isn't known once. `invalid`: no sound metadata. Only claims whose
    names differ are looked up a second time."""
    fields = F.struct(*(F.col(f"found.{n}").alias(n) for n in ("id", "owner_id", "owner_login", "name")))
    own = _named(F.col("found"), F.col("owner"), F.col("repo"))
    canonical = _named(F.col("found"), F.col("found.owner_login"), F.col("found.name"))
    first = F.when(F.col("found").isNull() | F.col("found.owner_login").isNull(), "invalid").when(own, F.when(_sound(F.col("found")), "same").otherwise("invalid"))
    first = first.when(~(F.coalesce(canonical, F.lit(False)) & _sound(F.col("found"))), F.when(_sound(F.col("found")), "mismatch").otherwise("invalid"))
    judged = claims.withColumn("state", first)
    moved = judged.where("state IS NULL").withColumn("_id", F.col("found.id"))
    known = by_id.select(F.col("id").alias("_id"), "owner_id", "owner_login", "name", "full_name", "private", "id")
    answered, silent = exactly_one(moved, known, ["_id"])
    agrees = _named(F.col("offer"), F.col("found.owner_login"), F.col("found.name")) & _sound(F.col("offer"))
    exact = F.coalesce((F.col("offer.owner_id") == F.col("found.owner_id")) & (F.col("offer.owner_login") == F.col("found.owner_login")) & (F.col("offer.name") == F.col("found.name")), F.lit(False))
    second = answered.withColumn("state", F.when(agrees & exact, "renamed").otherwise("mismatch")).drop("offer", "_id")
    rest = silent.withColumn("state", F.lit("mismatch")).drop("code", "_id")
    whole = judged.where("state IS NOT NULL").unionByName(second).unionByName(rest)
    return whole.withColumn("identity", F.when(F.col("state").isin("same", "renamed"), fields))
