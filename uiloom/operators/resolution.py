"""What a claim on a registry of catalogs resolves to, locale resources in normal form, and the language of settings descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import canonical_json, canonical_locale, git_blob_id
from uiloom.operators.checks import DIGEST, SHA1, commit_revision, is_bounded, is_positive
from uiloom.operators.coverage import DEFAULT
from uiloom.operators.directory import gate, tree_blobs

# The grammar of a site's key, and the name of its catalog behind the key.
SITE, CATALOG = r"\A[a-z0-9][a-z0-9-]{0,63}\z", ".canonical-source-catalog.json"

# Words that English descriptions have, the shortest description that counts, how many are needed for a verdict, and the share that must have such a word.
ENGLISH_WORDS = (
    "the|of|to|and|for|with|from|is|are|show|select|choose|display|when|how|if|not|all|new|default|file|folder|note|list|view|setting|"
    "option|enable|disable|sort|group|title|name|value|item|this|that|you|your|will|can|also|only|size|color|icon|date|time|field|property|"
    "text|page|row|column|pane|panel|window|open|close|add|remove|edit|save|apply|back|next|previous|first|last|other|same|each|between|"
    "during|after|before|above|below|left|right|top|bottom|into|out|more|less|most|least|few|many|much|such|both|every|own|another|use|hide"
)
DESCRIPTION, DESCRIPTIONS, ENGLISH_SHARE = 6, 5, 0.8

CLAIM = ["registry_key", "authority_digest", "profile_digest"]


def _digest(**fields: Column) -> Column:
    """SHA-256 of canonical JSON; the fields must be given in its order and hold nothing that JSON escapes."""
    return F.sha2(F.to_json(F.struct(*(value.alias(name) for name, value in fields.items()))), 256)


def _is_commit(sha: Column, tree: Column) -> Column:
    return F.coalesce(sha.rlike(SHA1) & tree.rlike(SHA1), F.lit(False))


def web_resolutions(claims: DataFrame, profiles: DataFrame, repositories: DataFrame, assets: DataFrame) -> DataFrame:
    """Claims with state, revision, commit_sha, content_digest, and for present ones asset_id, size, sha256, release_id, release_tag, release_commit_sha and entry_digest.

    claims: registry_key, site, authority_digest, profile_digest and more. profiles: registry_key, authority_digest, profile_digest, repository_id, owner_id, default_branch, max_bytes; one row for
    each registry. repositories: repository_id, owner_id, default_branch, archived, disabled, commit_date, commit_sha, tree_sha, release_id, release_tag, release_commit_sha, release_tree_sha; as they are now, a
    repository with its chosen release a row. assets: release_id, name, asset_id, state, size, sha256.

    state, the first that applies: `profile-changed` (another profile, or a key that is none), `repository-invalid` (unknown, known twice, moved, archived or disabled), `commit-invalid`, `absent` (the
    release has no asset of the site's name, or several), `asset-invalid`, `release-invalid`, `release-commit-invalid`, `present`. A null in what a check reads fails the check. Claims are never gathered;
    profiles are joined by key, and assets are counted before they meet claims."""
    bound = claims.join(profiles.select(*CLAIM, "repository_id", F.col("owner_id").alias("_owner"), F.col("default_branch").alias("_branch"), "max_bytes"), CLAIM, "left")
    known = repositories.groupBy("repository_id").agg(F.count("*").alias("_n"), F.min(F.struct(*(c for c in repositories.columns if c != "repository_id"))).alias("_now"))
    now = lambda n: F.col(f"_now.{n}")
    joined = bound.join(known, "repository_id", "left").withColumn("release_id", now("release_id")).withColumn("name", F.concat("site", F.lit(CATALOG)))
    offers = assets.groupBy("release_id", "name").agg(F.count("*").alias("_offers"), F.min(F.struct("asset_id", "state", "size", "sha256")).alias("_asset"))
    joined = joined.join(offers, ["release_id", "name"], "left")
    asset = lambda n: F.col(f"_asset.{n}")
    sound = lambda check: F.coalesce(check, F.lit(False))
    revision = commit_revision(now("commit_date"), now("commit_sha"))
    state = (
        F.when(F.col("repository_id").isNull() | ~sound(F.col("site").rlike(SITE)), "profile-changed")
        .when(~sound((F.col("_n") == 1) & (now("owner_id") == F.col("_owner")) & (now("default_branch") == F.col("_branch")) & ~now("archived") & ~now("disabled")), "repository-invalid")
        .when(~_is_commit(now("commit_sha"), now("tree_sha")) | revision.isNull(), "commit-invalid")
        .when(~sound(F.col("_offers") == 1), "absent")
        .when(~sound(is_bounded(asset("size"), 1, F.col("max_bytes")) & (asset("state") == "uploaded") & asset("sha256").rlike(DIGEST)) | asset("asset_id").isNull(), "asset-invalid")
        .when(now("release_tag").isNull() | ~is_positive(now("release_id")), "release-invalid")
        .when(~_is_commit(now("release_commit_sha"), now("release_tree_sha")), "release-commit-invalid")
        .otherwise("present")
    )
    judged = joined.withColumn("state", state)
    there, seen = F.col("state") == "present", F.col("state").isin("present", "absent")
    entry = _digest(assetDigest=asset("sha256"), releaseId=now("release_id"), siteKey=F.col("site"))
    return judged.select(
        *(F.col(c) for c in claims.columns), "state",
        F.when(seen, revision).alias("revision"), F.when(seen, now("commit_sha")).alias("commit_sha"),
        F.when(seen, _digest(commitSha=now("commit_sha"), repositoryId=F.col("repository_id"))).alias("content_digest"),
        *(F.when(there, asset(n)).alias(n) for n in ("asset_id", "size", "sha256")),
        *(F.when(there, now(n)).alias(n) for n in ("release_id", "release_tag", "release_commit_sha")),
        F.when(there, entry).alias("entry_digest"),
    )


def _text(value: Column, name: str) -> Column:
    """A member of an object, if it is text; numbers are none."""
    member = F.try_variant_get(value, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string"))


def directory_snapshots(commits: DataFrame, trees: DataFrame, bodies: DataFrame, path: str, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What directories hold at a commit: snapshots (directory, registry_revision, commit_sha, content_digest), their entries (directory, id, repo, entry as JSON) and refused directories (directory, code).

    commits: directory, commit_date, commit_sha, tree_sha; one row for each directory. trees: tree_sha, truncated, path, type, mode, sha, size. bodies: directory, body string, the file at `path`, at most one for each.
    A directory is taken only if its commit is sound (else `commit-invalid`), the tree has `path` exactly once as a plain file of at most `most` bytes (else the codes of tree_blobs), the body has the size and the
    blob's name that the tree tells (`size-mismatch`, `revision-mismatch`), is a JSON list without repeated keys (`content-invalid`) and passes the gate of directories (its codes); an empty list passes.
    A body is one row, which suits its limit; its entries are rows from then on, and they are counted by id, so no directory is gathered again."""
    revision = commit_revision(F.col("commit_date"), F.col("commit_sha"))
    dated = commits.withColumn("registry_revision", F.when(_is_commit(F.col("commit_sha"), F.col("tree_sha")), revision))
    required = dated.where("registry_revision IS NOT NULL").select("directory", "registry_revision", "commit_sha", "tree_sha", F.lit(path).alias("path"))
    blobs, missing = tree_blobs(required, trees, most)
    read = blobs.join(bodies.select("directory", "body"), "directory", "left").withColumn("list", F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>"))
    code = (
        F.when(~F.coalesce(F.octet_length("body") == F.col("size"), F.lit(False)), "size-mismatch").when(git_blob_id(F.col("body")) != F.col("revision"), "revision-mismatch")
        .when(F.col("list").isNull(), "content-invalid")
    )
    judged = read.withColumn("code", code)
    listed = judged.where("code IS NULL").select("directory", F.explode("list").alias("v"))
    entries = listed.select("directory", _text(F.col("v"), "id").alias("id"), _text(F.col("v"), "repo").alias("repo"), F.to_json("v").alias("entry"))
    closed = gate(entries, ["directory"]).where("code IS NOT NULL").select("directory", "code")
    refused = dated.where("registry_revision IS NULL").select("directory", F.lit("commit-invalid").alias("code")).unionByName(missing.select("directory", "code"))
    refused = refused.unionByName(judged.where("code IS NOT NULL").select("directory", "code")).unionByName(closed)
    snapshots = judged.where("code IS NULL").select("directory", "registry_revision", "commit_sha", F.sha2(F.col("body").cast("binary"), 256).alias("content_digest"))
    return snapshots.join(closed, "directory", "left_anti"), entries.join(closed, "directory", "left_anti"), refused


def directory_claims(claims: DataFrame, snapshots: DataFrame, entries: DataFrame) -> DataFrame:
    """Claims (directory, id, ..) with state, registry_revision, commit_sha, content_digest, repo and entry_digest, by directory_snapshots: `refused` where there is no snapshot, `present` where it has the id, else `absent`.
    The digest is that of the entry's canonical JSON; an entry without one (a fraction, say) makes its claims `refused`."""
    wanted = entries.join(claims.select("directory", "id").distinct(), ["directory", "id"], "left_semi")
    known = wanted.select("directory", "id", F.col("repo").alias("_repo"), F.sha2(canonical_json(F.col("entry")), 256).alias("_entry"))
    joined = claims.join(snapshots, "directory", "left").join(known, ["directory", "id"], "left")
    refused = F.col("content_digest").isNull() | (F.col("_repo").isNotNull() & F.col("_entry").isNull())
    state = F.when(refused, "refused").when(F.col("_repo").isNotNull(), "present").otherwise("absent")
    there = F.col("state") == "present"
    judged = joined.withColumn("state", state).withColumns({n: F.when(F.col("state") != "refused", F.col(n)) for n in ("registry_revision", "commit_sha", "content_digest")})
    return judged.withColumns({"repo": F.when(there, F.col("_repo")), "entry_digest": F.when(there, F.col("_entry"))}).drop("_repo", "_entry")


def normal_resources(resources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resources (owner, resource_id, locale, ..) with canonical locale and, where resource_id is null, the default one; and the refused owners (owner, code).

    One locale that is no tag (`locale-invalid`), or a resource that an owner has twice for a locale once both are in normal form (`resource-repeated`), refuses all that the owner has."""
    normal = resources.withColumns({"locale": canonical_locale(F.col("locale")), "resource_id": F.coalesce("resource_id", F.lit(DEFAULT))})
    counted = normal.groupBy("owner", "locale", "resource_id").agg(F.count("*").alias("n"))
    whole = counted.groupBy("owner").agg(F.bool_or(F.col("locale").isNull()).alias("bad"), F.max("n").alias("most"))
    refused = whole.select("owner", F.when(F.col("bad"), "locale-invalid").when(F.col("most") > 1, "resource-repeated").alias("code")).where("code IS NOT NULL")
    return normal.join(refused.select(F.col("owner").alias("_owner")), F.col("owner").eqNullSafe(F.col("_owner")), "left_anti"), refused


def english_schemas(descriptions: DataFrame, schema: list[str]) -> DataFrame:
    """schema.., n, hits and english for descriptions (schema.., text): n descriptions are long enough, hits of them have an English word, and the schema is English
    if there are too few to tell or if the share of hits is large enough. Counts are added before they are shuffled, so the number of a schema's descriptions doesn't matter."""
    counts = F.coalesce(F.length("text") >= DESCRIPTION, F.lit(False))
    hit = F.col("text").rlike(rf"(?iU)\b(?:{ENGLISH_WORDS})\b")
    found = descriptions.groupBy(*schema).agg(F.count_if(counts).alias("n"), F.count_if(counts & hit).alias("hits"))
    return found.withColumn("english", F.when(F.col("n") < DESCRIPTIONS, True).otherwise(F.col("hits") / F.col("n") >= ENGLISH_SHARE))
