"""Queries over resolutions, locale resources and descriptions, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uiloom.functions import text as T
from uiloom.operators import resolution


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def web_catalog_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as claims on sites; suppliers are registries with a repository each, orders are the assets of its release."""
    number = F.col("s_suppkey")
    suppliers = _t(spark, sf_dir, "supplier")
    named = [F.concat(F.lit("registry-"), number).alias("registry_key"), F.sha2("s_name", 256).alias("authority_digest"), F.sha2(number.cast("string"), 256).alias("profile_digest")]
    profiles = suppliers.select(*named, number.alias("repository_id"), F.col("s_nationkey").alias("owner_id"), F.lit("main").alias("default_branch"), F.lit(300_000).alias("max_bytes"))
    sha = F.sha1(number.cast("string"))
    repositories = suppliers.select(
        number.alias("repository_id"), F.col("s_nationkey").alias("owner_id"), F.when(number % 13 == 0, "old").otherwise("main").alias("default_branch"), (number % 11 == 0).alias("archived"), F.lit(False).alias("disabled"),
        F.when(number % 7 > 0, "2024-05-06T07:08:09Z").alias("commit_date"), sha.alias("commit_sha"), sha.alias("tree_sha"), number.alias("release_id"),
        F.when(number % 17 > 0, F.concat(F.lit("v"), number)).alias("release_tag"), sha.alias("release_commit_sha"), F.when(number % 19 > 0, sha).alias("release_tree_sha"),
    )
    customers = F.col("o_custkey")
    assets = _t(spark, sf_dir, "orders").select(
        (customers % 100).alias("release_id"), F.concat(F.lit("site-"), F.col("o_orderkey") % 50, F.lit(".canonical-source-catalog.json")).alias("name"), F.col("o_orderkey").alias("asset_id"),
        F.when(F.col("o_orderstatus") == "P", "starter").otherwise("uploaded").alias("state"), F.floor("o_totalprice").alias("size"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"),
    ).where("asset_id % 3 = 0")
    claims = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("registry-"), "l_suppkey").alias("registry_key"),
        F.concat(F.when(F.col("l_linenumber") == 4, "Site-").otherwise("site-"), F.col("l_partkey") % 60).alias("site"),
        F.sha2(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")), 256).alias("authority_digest"), F.sha2((F.col("l_suppkey") + (F.col("l_quantity") == 1).cast("int")).cast("string"), 256).alias("profile_digest"),
    )
    # equal claims are resolved once
    found = resolution.web_resolutions(claims.drop("l_orderkey", "l_linenumber").distinct(), profiles, repositories, assets)
    return found.select("registry_key", "site", "profile_digest", "state", "revision", "content_digest", "asset_id", "size", "release_tag", "entry_digest")


def directory_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a nation as directories, hundreds of them, each a JSON file at a commit; orders are claims. Files of some directories are another size or text than their tree tells, or have a bad entry."""
    number = F.col("c_custkey")
    place = (F.col("c_nationkey") * 1000 + number % 40).alias("directory")
    entry = F.concat(F.lit('{"id":"c'), number, F.lit('","repo":"owner/'), F.when(F.col("c_acctbal") < -990, "a b").otherwise(F.concat(F.lit("r"), number)), F.lit('","segment":"'), F.col("c_mktsegment"), F.lit('"}'))
    made = _t(spark, sf_dir, "customer").select(place, entry.alias("entry")).groupBy("directory").agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("entry")), ","), F.lit("]")).alias("body"))
    d = F.col("directory")
    bodies = made.select("directory", F.when(d % 11 == 0, F.concat("body", F.lit(" "))).when(d % 13 == 0, F.translate("body", "H", "h")).otherwise(F.col("body")).alias("body"))
    sha = F.sha1(d.cast("string"))
    commits = made.select("directory", F.when(d % 17 > 0, "2024-05-06T07:08:09Z").alias("commit_date"), sha.alias("commit_sha"), sha.alias("tree_sha"))
    trees = made.select(
        sha.alias("tree_sha"), F.lit(False).alias("truncated"), F.lit("plugins.json").alias("path"), F.lit("blob").alias("type"), F.when(d % 19 > 0, "100644").otherwise("120000").alias("mode"),
        T.git_blob_id(F.col("body")).alias("sha"), F.octet_length("body").cast("long").alias("size"),
    )
    snapshots, entries, _ = resolution.directory_snapshots(commits, trees, bodies, "plugins.json", 8 << 20)
    orders = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == number)
    claims = orders.select("o_orderkey", (F.col("c_nationkey") * 1000 + F.col("o_custkey") % F.when(F.col("o_orderkey") % 5 == 0, 41).otherwise(40)).alias("directory"), F.concat(F.lit("c"), "o_custkey").alias("id"))
    return resolution.directory_claims(claims, snapshots, entries).select("o_orderkey", "state", "registry_revision", "content_digest", "repo", "entry_digest")


def locale_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as locale resources of owners of four; owners that write a tag badly or have a resource twice go as a whole."""
    number = F.col("doc_id")
    tag = F.when(number % 37 == 0, F.concat("lang", F.lit("_x"))).when(number % 4 == 0, F.upper("lang")).when(number % 4 == 1, F.concat("lang", F.lit("-"), F.upper("lang"))).otherwise(F.concat("lang", F.lit("-latn")))
    rows = _t(spark, sf_dir, "documents").where("lang IS NOT NULL").select(
        F.floor(number / 4).alias("owner"), F.when(number % 4 > 1, F.concat(F.lit("r"), F.length("source"))).alias("resource_id"), tag.alias("locale"), F.sha2("text", 256).alias("digest")
    )
    return resolution.normal_resources(rows)[0].select("owner", "resource_id", "locale", "digest")


def english_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as settings schemas, each line a description."""
    lines = _t(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("text"))
    return resolution.english_schemas(lines, ["doc_id"])


QUERIES = {f.__name__: f for f in (web_catalog_claims, directory_claims, locale_resources, english_documents)}

ORACLE_SQL = {
    "web_catalog_claims": """WITH c AS (SELECT DISTINCT l_suppkey AS s, 'registry-' || l_suppkey AS registry_key, CASE WHEN l_linenumber = 4 THEN 'Site-' ELSE 'site-' END || (l_partkey % 60) AS site, l_quantity = 1 AS other FROM lineitem),
 a AS (SELECT o_custkey % 100 AS release_id, 'site-' || (o_orderkey % 50) AS site, count(*) AS n, min(o_orderkey) AS asset_id, min(CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END) AS up, min(CAST(floor(o_totalprice) AS BIGINT)) AS size FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2),
 j AS (SELECT c.*, p.s_suppkey AS k, a.n, a.asset_id, a.up, a.size FROM c LEFT JOIN supplier p ON p.s_suppkey = c.s AND NOT c.other AND p.s_name = 'Supplier#' || lpad(CAST(c.s AS VARCHAR), 9, '0') LEFT JOIN a ON a.release_id = p.s_suppkey AND a.site = c.site),
 t AS (SELECT *, CASE WHEN k IS NULL OR site LIKE 'S%' THEN 'profile-changed' WHEN k % 13 = 0 OR k % 11 = 0 THEN 'repository-invalid' WHEN k % 7 = 0 THEN 'commit-invalid' WHEN n IS NULL OR n > 1 THEN 'absent'
 WHEN up = 0 OR size NOT BETWEEN 1 AND 300000 THEN 'asset-invalid' WHEN k % 17 = 0 THEN 'release-invalid' WHEN k % 19 = 0 THEN 'release-commit-invalid' ELSE 'present' END AS state FROM j)
 SELECT registry_key, site, sha256(CAST(s + CAST(other AS INT) AS VARCHAR)) AS profile_digest, state, CASE WHEN state IN ('present', 'absent') THEN 1714979289000000 + CAST('0x' || sha1(CAST(k AS VARCHAR))[1:5] AS BIGINT) END AS revision,
 CASE WHEN state IN ('present', 'absent') THEN sha256('{"commitSha":"' || sha1(CAST(k AS VARCHAR)) || '","repositoryId":' || k || '}') END AS content_digest,
 CASE WHEN state = 'present' THEN asset_id END AS asset_id, CASE WHEN state = 'present' THEN size END AS size, CASE WHEN state = 'present' THEN 'v' || k END AS release_tag,
 CASE WHEN state = 'present' THEN sha256('{"assetDigest":"' || sha256(CAST(asset_id AS VARCHAR)) || '","releaseId":' || k || ',"siteKey":"' || site || '"}') END AS entry_digest FROM t""",
    "directory_claims": """WITH e AS (SELECT c_nationkey * 1000 + c_custkey % 40 AS directory, 'c' || c_custkey AS id, CASE WHEN c_acctbal < -990 THEN 'owner/a b' ELSE 'owner/r' || c_custkey END AS repo, c_mktsegment AS segment, c_acctbal < -990 AS bad FROM customer),
 x AS (SELECT *, '{"id":"' || id || '","repo":"' || repo || '","segment":"' || segment || '"}' AS entry FROM e), b AS (SELECT directory, '[' || string_agg(entry, ',' ORDER BY entry) || ']' AS body, bool_or(bad) AS bad FROM x GROUP BY 1),
 s AS (SELECT directory, sha256(body) AS content_digest, 1714979289000000 + CAST('0x' || sha1(CAST(directory AS VARCHAR))[1:5] AS BIGINT) AS registry_revision FROM b
 WHERE NOT bad AND directory % 11 > 0 AND directory % 17 > 0 AND directory % 19 > 0 AND (directory % 13 > 0 OR NOT contains(body, 'H')))
 SELECT o_orderkey, CASE WHEN s.directory IS NULL THEN 'refused' WHEN x.id IS NULL THEN 'absent' ELSE 'present' END AS state, registry_revision, content_digest, x.repo, sha256(x.entry) AS entry_digest
 FROM (SELECT o_orderkey, c_nationkey * 1000 + o_custkey % CASE WHEN o_orderkey % 5 = 0 THEN 41 ELSE 40 END AS directory, 'c' || o_custkey AS id FROM orders JOIN customer ON o_custkey = c_custkey) o LEFT JOIN s ON s.directory = o.directory LEFT JOIN x ON x.directory = s.directory AND x.id = o.id""",
    "locale_resources": """WITH r AS (SELECT doc_id // 4 AS owner, CASE WHEN doc_id % 4 > 1 THEN 'r' || length(source) ELSE 'default' END AS resource_id, CASE WHEN doc_id % 37 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN lang
 WHEN doc_id % 4 = 1 THEN lang || '-' || upper(lang) ELSE lang || '-Latn' END AS locale, sha256(text) AS digest FROM documents WHERE lang IS NOT NULL),
 b AS (SELECT owner FROM r GROUP BY owner, locale, resource_id HAVING count(*) > 1 OR locale IS NULL) SELECT * FROM r WHERE owner NOT IN (SELECT owner FROM b)""",
    "english_documents": rf"""SELECT doc_id, count(*) FILTER (WHERE length(t) >= 6) AS n, count(*) FILTER (WHERE length(t) >= 6 AND h) AS hits, count(*) FILTER (WHERE length(t) >= 6) < 5 OR 10 * count(*) FILTER (WHERE length(t) >= 6 AND h) >= 8 * count(*) FILTER (WHERE length(t) >= 6) AS english
 FROM (SELECT doc_id, t, regexp_matches(t, '(?i)(^|[^\p{{L}}\p{{M}}\p{{N}}_])({resolution.ENGLISH_WORDS})($|[^\p{{L}}\p{{M}}\p{{N}}_])') AS h FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents WHERE text IS NOT NULL)) GROUP BY doc_id""",
}
