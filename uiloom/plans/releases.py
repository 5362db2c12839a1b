"""Queries over coverage states, directories, releases, plans, requests, JSON and HTML, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uiloom.functions import html, variants
from uiloom.operators import catalog, checks, coverage, directory, matching, rules, snapshots
from uiloom.sinks import results
from uiloom.sources import requests
from uiloom.streaming import tasks

MEDIA = "application/json"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents as shipped translations: words of a text are keys and their lengths texts, so texts recur, repeat their source and differ between carriers."""
    docs = _t(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.concat(F.lit("o"), F.col("doc_id") % 5).alias("owner"), F.when(F.col("doc_id") % 3 == 0, "embedded").otherwise("explicit").alias("carrier"),
        F.element_at(F.array(*map(F.lit, ("default", "extra", "menu"))), (F.col("doc_id") % 7 % 3 + 1).cast("int")).alias("resource_id"), F.col("lang").alias("locale"), "doc_id", "text",
    )
    at = ["owner", "carrier", "resource_id", "locale"]
    files = docs.groupBy(*at).agg(F.min("doc_id").alias("d")).select(*at, F.concat("locale", F.lit("/"), "d", F.lit(".json")).alias("name"), F.sha2(F.col("d").cast("string"), 256).alias("digest"))
    word = lambda n: F.coalesce(F.get(F.split("text", " "), F.lit(n)), F.lit(""))
    entries = docs.groupBy(*at, F.concat(F.lit("/"), F.length(word(0))).alias("resource_key")).agg(F.min(F.concat(F.substring(word(1), 1, 1), F.length(word(1)) % 3)).alias("text"))
    found = entries.where("locale = 'en'").select("owner", F.col("text").alias("source")).distinct()
    found = found.select("owner", "source", F.sha2(F.concat("owner", "source"), 256).alias("key"), F.when(F.length("source") % 7 == 1, "readme").otherwise("runtime-ui").alias("semantic_role"))
    return files, entries, found


def native_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.native_coverage(*_shipped(spark, sf_dir))[0]


def native_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.native_coverage(*_shipped(spark, sf_dir))[1].select("owner", "locale", "string_key", "resource_key", "placeholder_signature", "target")


def exact_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that need one returned line: the line, or that it is missing or repeated."""
    need = _t(spark, sf_dir, "orders").select("o_orderkey")
    lines = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")
    matches, violations = matching.exactly_one(need, lines, ["o_orderkey"])
    return matches.select("o_orderkey", F.lit("ok").alias("code"), "offer.l_partkey").unionByName(violations.withColumn("l_partkey", F.lit(None).cast("long")))


def release_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as releases, their lines as assets named by return flag: what keeps a release from having A and R once each, and small enough."""
    flag = F.col("o_orderstatus")
    releases = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("release_id"), F.concat(F.lit("v"), "o_custkey", F.when(F.col("o_custkey") % 9 == 0, "//x").otherwise("")).alias("tag"), (flag == "P").alias("draft"), (flag == "O").alias("prerelease"))
    lines = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("release_id"), (F.col("l_partkey") + 1).alias("asset_id"), F.col("l_returnflag").alias("name"), F.when(F.col("l_linestatus") == "O", "uploaded").otherwise("open").alias("state"),
        F.col("l_quantity").cast("long").alias("size"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("sha256:"), F.sha2(F.col("l_partkey").cast("string"), 256))).alias("digest"),
    )
    assets, violations = directory.release_assets(releases, lines, {"A": 40, "R": 50})
    return assets.select("release_id", "name", F.lit("ok").alias("code"), "asset_id").unionByName(violations.withColumn("asset_id", F.lit(None).cast("long")))


def directory_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as directories of suppliers; a supplier in debt has a repository that is none, so whole regions refuse."""
    suppliers, nations = _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "nation")
    place = F.col("n_regionkey") * 20 + F.col("s_suppkey") % 20
    entries = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        place.alias("dir"), F.regexp_replace("s_name", "#", ".").alias("id"), F.when(F.col("s_acctbal") < 0, F.lit("none")).otherwise(F.concat(F.lit("owner/r"), "s_suppkey")).alias("repo")
    )
    asked = _t(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 107).alias("dir"), F.concat(F.lit("Supplier."), F.lpad((F.col("p_partkey") % 150).cast("string"), 9, "0")).alias("id"))
    return directory.resolve(asked, entries, ["dir"]).select("p_partkey", "state", "repo")


def repository_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as claims on repositories, of which some have been renamed, moved, taken or made private since."""
    number, case = F.col("c_custkey"), F.col("c_custkey") % 6
    claims = _t(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Own"), F.col("c_nationkey")).alias("owner"), F.regexp_replace("c_name", "#", "-").alias("repo"),
        F.struct(
            (number + 1).alias("id"), (F.col("c_nationkey") + 1).cast("long").alias("owner_id"), F.concat(F.lit("own"), "c_nationkey").alias("owner_login"),
            F.concat(F.regexp_replace("c_name", "#", "-"), F.when(case.isin(1, 2, 3), ".new").otherwise("")).alias("name"),
            F.concat(F.lit("own"), "c_nationkey", F.lit("/"), F.regexp_replace("c_name", "#", "-"), F.when(case.isin(1, 2, 3), ".new").otherwise("")).alias("full_name"), (case == 4).alias("private"),
        ).alias("found"),
    )
    known = claims.where(number % 6 != 3).select("found.*").withColumn("owner_id", F.when(F.col("id") % 6 == 3, F.col("owner_id") + 1000).otherwise(F.col("owner_id")))
    return directory.repository_identity(claims, known).select("c_custkey", "state", F.col("identity.name").alias("name"))


def catalog_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the units of catalogs of 10, which break one rule or another."""
    docs = _t(spark, sf_dir, "documents")
    name = F.floor(F.col("doc_id") / 10)
    units = docs.select(
        name.alias("catalog"), F.concat(F.lit("k"), F.when(F.col("doc_id") % 91 == 0, F.col("doc_id") - F.col("doc_id") % 10).otherwise(F.col("doc_id"))).alias("key"), "text",
        F.element_at(F.array(*map(F.lit, ("runtime", "metadata", "runtime", "other"))), (F.col("doc_id") % 31 % 4 + 1).cast("int")).alias("source_key"), F.lit("").alias("placeholder_signature"),
        F.when(F.col("n_chars") % 50 == 0, "rich").otherwise("plain-text-v1").alias("format_signature"), F.array("source", F.lit("x")).alias("content_scopes"), F.array("lang").alias("upstream_locale_coverage"),
    )
    catalogs = docs.groupBy(name.alias("catalog")).agg(F.min("source").alias("s"), F.max("doc_id").alias("m")).select(
        "catalog", F.lit("demo.catalog").alias("protocol"), F.lit(2).alias("revision"),
        F.struct(F.sha2("s", 256).alias("content_digest"), F.col("s").alias("name"), F.lit("plugin").alias("object_kind_key"), F.col("s").alias("resource_key"), F.concat(F.lit("1."), "m").alias("version"), F.lit("semver").alias("version_scheme")).alias("resource"),
        F.struct(F.when(F.col("m") % 8 == 1, "de").otherwise("en").alias("locale"), F.concat(F.lit("community-resource:"), "s").alias("stream_key")).alias("stream"),
    )
    sources = catalogs.select("catalog", F.explode(F.array(F.struct(F.lit("runtime").alias("key"), F.lit("main.js").alias("logical_path"), F.lit("javascript").alias("format_family")), F.struct(F.lit("metadata").alias("key"), F.lit("manifest.json").alias("logical_path"), F.lit("json").alias("format_family")))).alias("s")).select("catalog", "s.*")
    return rules.catalog_breaches(catalogs, sources, units, "demo.catalog")


def plan_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as source plans with their lines as assets."""
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct((F.col("l_partkey") + 1).alias("assetId"), F.when(F.col("l_linenumber") == 1, "main.js").when(F.col("l_linenumber") == 2, "manifest.json").otherwise(F.concat("l_returnflag", F.lit(".md"))).alias("name"), (F.col("l_quantity").cast("long") - 3).alias("size"), F.sha2("l_linestatus", 256).alias("sha256")))).alias("assets")
    )
    digest = F.sha2("o_orderstatus", 256)
    plans = _t(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "assets", F.lit("github_release").alias("provider"), (F.col("o_custkey") % 50).alias("ownerId"), F.col("o_orderkey").alias("repositoryId"), F.lit(1).alias("releaseId"), F.lit(1).alias("projectionGeneration"),
        F.concat(F.lit("c"), "o_custkey").alias("ownerLogin"), F.lower("o_orderpriority").alias("repositoryName"), F.sha1(F.col("o_orderstatus")).alias("commitSha"), F.concat(F.lit("v"), "o_orderpriority").alias("tag"),
        *(digest.alias(n) for n in rules.PLAN_DIGESTS), F.when(F.col("o_custkey") % 13 == 0, "x").otherwise(digest).alias("claimedBuildDigest"), F.lit("result/v1").alias("resultSchema"), F.lit(MEDIA).alias("resultMediaType"),
        F.col("o_totalprice").cast("long").alias("resultMaxBytes"), F.get("assets", F.lit(0))["assetId"].alias("primaryAssetId"),
    )
    return rules.release_plan_breaches(plans, "o_orderkey", MEDIA)


def ordered_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of each source in the order of their code points, with gapless positions."""
    docs = _t(spark, sf_dir, "documents").select("source", F.sha2("text", 256).alias("digest"), "text").distinct()
    return matching.positions(docs, ["source", "text"], ["source"]).select("source", "digest", "position")


def fair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _t(spark, sf_dir, "orders").select(F.when(F.col("o_orderpriority") < "3", "registry").otherwise("source").alias("queue"), "o_orderkey")
    return tasks.fair_order(claims, "queue", ["o_orderkey"])


def html_text_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.text_nodes(F.regexp_replace("html", "^<!DOCTYPE[^>]*>", ""))
    return _t(spark, sf_dir, "pages").select("page_id", F.posexplode(nodes).alias("nth", "text")).select("page_id", "nth", F.sha2("text", 256).alias("digest"))


def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.walk(_t(spark, sf_dir, "events"), "event_id", "props").withColumnRenamed("id", "event_id").select("event_id", "pointer", "kind", "depth", "value")


def _request(text: Column) -> Column:
    """A request around a document: its parts follow the text's own length, first letter and id."""
    part = lambda role, name, body: F.struct(F.regexp_replace(F.base64(body.cast("binary")), "[\r\n]", "").alias("content_base64"), F.lit(name).alias("name"), F.lit(role).alias("role"))
    manifest = F.to_json(F.struct(F.substring(text, 1, 300).alias("name"), F.col("lang").alias("version"), text.alias("description")))
    return F.to_json(F.struct(
        F.when(F.col("doc_id") % 17 == 0, F.lit(".x")).otherwise(F.col("source")).alias("authority_resource_version"),
        F.array(part("main", "main.js", text), F.when(F.col("doc_id") % 19 == 0, part("main", "main.js", text)).otherwise(part("manifest", "manifest.json", manifest))).alias("components"),
        F.sha2("source", 256).alias("materialization_target_digest"), (F.col("n_chars") % 40).alias("policy_revision"), F.lit("demo.v2").alias("protocol"),
    ))


def request_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("request"), _request(F.col("text")).cast("binary").alias("content"))
    accepted, refused = requests.decode_requests(docs, "demo.v2")
    return accepted.select("request", F.lit("accepted").alias("code"), F.sha2("main", 256).alias("main")).unionByName(refused.withColumn("main", F.lit(None).cast("string")))


def sealed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select(F.col("event_id").alias("task_id"), F.sha2("event_type", 256).alias("materialization_target_digest"), F.concat(F.lit('{"z": 1, "props": '), "props", F.lit("}")).alias("catalog"))
    return results.sealed(rows, "demo")[0].select("task_id", "digest", "size")


def field_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validators of references, addresses, texts and times over document texts and order dates."""
    word = F.get(F.split("text", " "), F.lit(0))
    docs = _t(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select(
        "doc_id", checks.is_reference(F.concat_ws("/", word, "source")).alias("reference"), checks.is_identifier(word, 6, "._-").alias("identifier"), checks.is_bounded_text(F.col("text"), 400).alias("bounded"),
        checks.is_uuid(F.concat(F.substring("text", 1, 2), F.lit("000000-0000-0000-0000-00000000000"), F.col("doc_id") % 12)).alias("uuid"), checks.is_https_base(F.concat(F.lit("https://h/"), F.substring("text", 1, F.col("doc_id").cast("int") % 2))).alias("base"),
    )


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source as the texts of a plugin; some stand in the registry only, some in several places."""
    docs = _t(spark, sf_dir, "documents").where("text IS NOT NULL").withColumn("plugin_id", F.col("source"))
    named = docs.where("doc_id % 3 = 0").select("plugin_id", F.col("text").alias("name"), F.when(F.col("doc_id") % 2 == 0, F.substring("text", 1, 40)).alias("description"))
    listed = docs.where("doc_id % 4 = 1").select("plugin_id", F.substring("text", 1, 20).alias("name"), F.col("text").alias("description"))
    shown = docs.where("doc_id % 5 = 2").select("plugin_id", F.when(F.col("n_chars") % 2 == 0, "readme").otherwise("ui-call").alias("origin"), F.lit("").alias("symbol"), F.col("text").alias("value"), F.col("n_chars").cast("int").alias("offset"), F.lit("structured").alias("strategy"))
    strings = catalog.strings(snapshots.candidates(snapshots.metadata_candidates(named, "manifest"), snapshots.metadata_candidates(listed, "registry"), shown))
    covered = strings.select("plugin_id", "key", F.explode(F.when(F.length("source") % 3 == 0, F.array(F.lit("fr"), F.lit("de"), F.lit("de")))).alias("locale"))
    return snapshots.source_units(strings, covered)


def snapshot_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _units(spark, sf_dir)
    return rows.select("plugin_id", "position", "key", "source_key", F.concat_ws(",", "content_scopes").alias("scopes"), F.concat_ws(",", "upstream_locale_coverage").alias("locales"), F.sha2("text", 256).alias("digest"))


def snapshot_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.source_list(_units(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    native_locales, native_entries, exact_offers, release_components, directory_gate, repository_names, catalog_rules, plan_rules, ordered_strings, fair_turns, html_text_nodes, json_values,
    request_states, sealed_results, field_formats, snapshot_units, snapshot_sources,
)}

SHIPPED = """d AS (SELECT 'o' || (doc_id % 5) AS owner, CASE WHEN doc_id % 3 = 0 THEN 'embedded' ELSE 'explicit' END AS carrier, (['default', 'extra', 'menu'])[doc_id % 7 % 3 + 1] AS resource_id, lang AS locale, doc_id, text,
  string_split(text, ' ')[1] AS w, coalesce(string_split(text, ' ')[2], '') AS x FROM documents WHERE text IS NOT NULL),
 f AS (SELECT owner, carrier, resource_id, locale, locale || '/' || min(doc_id) || '.json' AS name, sha256(min(doc_id)::VARCHAR) AS digest FROM d GROUP BY 1, 2, 3, 4),
 e AS (SELECT owner, carrier, resource_id, locale, '/' || length(w) AS resource_key, min(substr(x, 1, 1) || (length(x) % 3)) AS text FROM d GROUP BY ALL),
 s AS (SELECT DISTINCT owner, text AS source, sha256(owner || text) AS string_key, length(text) % 7 <> 1 AS runtime FROM e WHERE locale = 'en'),
 p AS (SELECT o.owner, o.carrier, o.locale, s.string_key, s.source, o.text AS target, CASE WHEN o.carrier = 'embedded' OR o.resource_id = 'default' THEN o.resource_key ELSE o.resource_id || ':' || o.resource_key END AS k,
  o.resource_id, o.resource_key FROM e o JOIN e n USING (owner, carrier, resource_id, resource_key) JOIN s ON s.owner = o.owner AND s.source = n.text WHERE o.locale <> 'en' AND n.locale = 'en' AND (o.carrier = 'embedded' OR s.runtime)),
 c AS (SELECT owner, carrier, locale, string_key, min(target) AS target, arg_min(k, {'a': resource_id, 'b': resource_key}) AS k, bool_or(source = target) OR count(DISTINCT target) > 1 AS bad FROM p GROUP BY 1, 2, 3, 4),
 m AS (SELECT owner, locale, string_key, min(target) AS target, min(k) AS resource_key FROM c GROUP BY 1, 2, 3 HAVING NOT bool_or(bad) AND count(DISTINCT target) = 1)"""

UNITS = """d AS (SELECT source AS plugin_id, text, doc_id, n_chars FROM documents WHERE text IS NOT NULL),
 c AS (SELECT plugin_id, 'manifest' AS o, text AS v FROM d WHERE doc_id % 3 = 0 UNION ALL SELECT plugin_id, 'manifest', substr(text, 1, 40) FROM d WHERE doc_id % 6 = 0 UNION ALL SELECT plugin_id, 'registry', text FROM d WHERE doc_id % 4 = 1
  UNION ALL SELECT plugin_id, 'registry', substr(text, 1, 20) FROM d WHERE doc_id % 4 = 1 UNION ALL SELECT plugin_id, CASE WHEN n_chars % 2 = 0 THEN 'readme' ELSE 'ui' END, text FROM d WHERE doc_id % 5 = 2),
 s AS (SELECT plugin_id, v, bool_or(o = 'ui') AS ui, bool_or(o = 'manifest') AS m, bool_or(o = 'registry') AS r, bool_or(o = 'readme') AS doc FROM c GROUP BY 1, 2 HAVING bool_or(o <> 'registry')),
 u AS (SELECT *, CASE WHEN ui THEN 'runtime' WHEN m THEN 'metadata' ELSE 'documentation' END AS source_key FROM s)"""

ORACLE_SQL = {
    "snapshot_units": f"""WITH {UNITS} SELECT plugin_id, row_number() OVER (PARTITION BY plugin_id ORDER BY v) - 1 AS position, substr(sha256(plugin_id || chr(0) || v), 1, 32) AS key, source_key,
 concat_ws(',', CASE WHEN m OR r THEN 'metadata' END, CASE WHEN doc THEN 'readme' END, CASE WHEN ui THEN 'runtime-ui' END) AS scopes, CASE WHEN length(v) % 3 = 0 THEN 'de,fr' ELSE '' END AS locales, sha256(v) AS digest FROM u""",
    "snapshot_sources": f"""WITH {UNITS}, k AS (SELECT DISTINCT plugin_id, source_key AS key FROM u), n AS (SELECT * FROM (VALUES ('runtime', 1, 'main.js', 'javascript'), ('metadata', 2, 'manifest.json', 'json'), ('documentation', 3, 'README.md', 'markdown')) t(key, i, logical_path, format_family))
 SELECT plugin_id, CAST(row_number() OVER (PARTITION BY plugin_id ORDER BY i) - 1 AS INTEGER) AS position, key, logical_path, format_family FROM k JOIN n USING (key)""",
    "native_entries": f"WITH {SHIPPED} SELECT owner, locale, string_key, resource_key, '' AS placeholder_signature, target FROM m",
    "native_locales": f"""WITH {SHIPPED}, r AS (SELECT t.owner, t.carrier, t.locale, t.resource_id, t.name, t.digest, n.name AS sn, n.digest AS sd FROM f t JOIN f n USING (owner, carrier, resource_id) WHERE t.locale <> 'en' AND n.locale = 'en'),
 i AS (SELECT owner, locale, carrier, CASE count(*) WHEN 1 THEN min(name) ELSE 'locale-component-set:' || count(*) END AS name, CASE count(*) WHEN 1 THEN min(sn) ELSE 'locale-component-set:' || count(*) END AS sn,
  CASE count(*) WHEN 1 THEN min(digest) ELSE sha256('{{"components":[' || string_agg('{{"digest":"' || digest || '","name":"' || name || '","resource_id":"' || resource_id || '"}}', ',' ORDER BY resource_id) || ']}}') END AS digest,
  CASE count(*) WHEN 1 THEN min(sd) ELSE sha256('{{"components":[' || string_agg('{{"digest":"' || sd || '","name":"' || sn || '","resource_id":"' || resource_id || '"}}', ',' ORDER BY resource_id) || ']}}') END AS sd FROM r GROUP BY 1, 2, 3),
 j AS (SELECT owner, locale, CASE count(*) WHEN 1 THEN min(name) ELSE 'native-locale-target-set:' || string_agg(carrier, '+' ORDER BY carrier) END AS resource_name, CASE count(*) WHEN 1 THEN min(sn) ELSE 'native-locale-source-set:' || string_agg(carrier, '+' ORDER BY carrier) END AS source_resource_name,
  CASE count(*) WHEN 1 THEN min(digest) ELSE sha256('{{"resources":[' || string_agg('{{"carrier":"' || carrier || '","digest":"' || digest || '","name":"' || name || '"}}', ',' ORDER BY carrier) || ']}}') END AS resource_digest,
  CASE count(*) WHEN 1 THEN min(sd) ELSE sha256('{{"resources":[' || string_agg('{{"carrier":"' || carrier || '","digest":"' || sd || '","name":"' || sn || '"}}', ',' ORDER BY carrier) || ']}}') END AS source_resource_digest FROM i GROUP BY 1, 2)
 SELECT owner, locale, covered, resource_name, resource_digest, source_resource_name, source_resource_digest FROM j JOIN (SELECT owner, locale, count(*) AS covered FROM m GROUP BY 1, 2) USING (owner, locale)""",
    "exact_offers": """SELECT o_orderkey, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' ELSE 'ok' END AS code, CASE WHEN n = 1 THEN p END AS l_partkey
 FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_partkey) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey""",
    "release_components": """WITH r AS (SELECT o_orderkey AS id, o_orderstatus <> 'P' AND o_orderkey > 0 AND o_custkey % 9 <> 0 AS fine FROM orders),
 l AS (SELECT l_orderkey AS id, l_returnflag AS name, count(*) AS n, min(l_partkey) + 1 AS asset, min(l_linestatus) AS s, min(CAST(l_quantity AS BIGINT)) AS size FROM lineitem GROUP BY 1, 2),
 q AS (SELECT r.id, x.name, l.n, l.asset, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' WHEN l.s <> 'O' THEN 'not-uploaded' WHEN l.size NOT BETWEEN 1 AND x.most THEN 'size-invalid' END AS code
  FROM r CROSS JOIN (VALUES ('A', 40), ('R', 50)) x(name, most) LEFT JOIN l ON l.id = r.id AND l.name = x.name WHERE fine),
 w AS (SELECT id, min(name) AS name FROM q WHERE n = 1 GROUP BY id, asset HAVING count(*) > 1),
 v AS (SELECT id, name, code FROM q WHERE code IS NOT NULL UNION ALL SELECT id, NULL, 'release-invalid' FROM r WHERE NOT fine UNION ALL SELECT id, name, 'asset-id-repeated' FROM w)
 SELECT id AS release_id, name, code, CAST(NULL AS BIGINT) AS asset_id FROM v UNION ALL SELECT id, name, 'ok', asset FROM q WHERE id NOT IN (SELECT id FROM v)""",
    "directory_gate": """WITH e AS (SELECT n_regionkey * 20 + s_suppkey % 20 AS dir, replace(s_name, '#', '.') AS id, CASE WHEN s_acctbal >= 0 THEN 'owner/r' || s_suppkey END AS repo FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 g AS (SELECT dir, bool_and(repo IS NOT NULL) AS fine FROM e GROUP BY 1), a AS (SELECT p_partkey, p_partkey % 107 AS dir, 'Supplier.' || lpad((p_partkey % 150)::VARCHAR, 9, '0') AS id FROM part)
 SELECT p_partkey, CASE WHEN NOT coalesce(fine, false) THEN 'refused' WHEN e.id IS NULL THEN 'absent' ELSE 'present' END AS state, CASE WHEN fine THEN repo END AS repo FROM a LEFT JOIN g USING (dir) LEFT JOIN e ON e.dir = a.dir AND e.id = a.id""",
    "repository_names": """SELECT c_custkey, CASE WHEN c % 6 = 4 OR c % 6 IN (2, 3) THEN 'mismatch' WHEN c % 6 = 1 THEN 'renamed' ELSE 'same' END AS state,
 CASE WHEN c % 6 = 1 THEN replace(c_name, '#', '-') || '.new' WHEN c % 6 IN (0, 5) THEN replace(c_name, '#', '-') END AS name FROM (SELECT *, c_custkey AS c FROM customer)""",
    "catalog_rules": """WITH u AS (SELECT doc_id // 10 AS catalog, 'k' || CASE WHEN doc_id % 91 = 0 THEN doc_id - doc_id % 10 ELSE doc_id END AS key, text, (['runtime', 'metadata', 'runtime', 'other'])[doc_id % 31 % 4 + 1] AS s, n_chars, source, doc_id FROM documents),
 k AS (SELECT DISTINCT catalog FROM u), x AS (SELECT catalog, s FROM k, (VALUES ('runtime'), ('metadata')) t(s)),
 b AS (SELECT catalog, 'unit-text' AS code FROM u WHERE text IS NULL OR trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' UNION ALL SELECT catalog, 'unit-format' FROM u WHERE n_chars % 50 = 0
  UNION ALL SELECT catalog, 'unit-context' FROM u WHERE source >= 'x' OR source IS NULL UNION ALL SELECT catalog, 'unit-key-repeated' FROM u GROUP BY catalog, key HAVING count(*) > 1
  UNION ALL SELECT DISTINCT catalog, 'unit-source-unknown' FROM u WHERE s = 'other' UNION ALL SELECT catalog, 'source-unused' FROM x WHERE (catalog, s) NOT IN (SELECT catalog, s FROM u)
  UNION ALL SELECT catalog, 'stream-locale' FROM u GROUP BY catalog HAVING max(doc_id) % 8 = 1)
 SELECT catalog, code, count(*) AS n FROM b GROUP BY 1, 2""",
    "plan_rules": """WITH a AS (SELECT l_orderkey AS k, l_partkey + 1 AS id, CASE l_linenumber WHEN 1 THEN 'main.js' WHEN 2 THEN 'manifest.json' ELSE l_returnflag || '.md' END AS name, CAST(l_quantity AS BIGINT) - 3 AS size FROM lineitem),
 g AS (SELECT k, count(*) AS n, count(DISTINCT id) AS ids, count(DISTINCT name) AS names, min(size) AS least, count(*) FILTER (name = 'main.js') AS mains, count(*) FILTER (name = 'manifest.json') AS manis, min(size) FILTER (name = 'main.js') AS ms,
  min(size) FILTER (name = 'manifest.json') AS fs, min(id) AS first, arg_min(id, {'a': id, 'b': size}) FILTER (name = 'main.js') AS main_id FROM a GROUP BY 1),
 p AS (SELECT * FROM orders JOIN g ON k = o_orderkey)
 SELECT o_orderkey, code FROM (SELECT o_orderkey, unnest([CASE WHEN o_custkey % 50 = 0 THEN 'id:ownerId' END, CASE WHEN o_orderkey < 1 THEN 'id:repositoryId' END, CASE WHEN contains(o_orderpriority, ' ') THEN 'tag' END, CASE WHEN contains(o_orderpriority, ' ') THEN 'repository' END,
  CASE WHEN o_totalprice::BIGINT > 67108864 OR trunc(o_totalprice) < 1 THEN 'result-size' END, CASE WHEN o_custkey % 13 = 0 THEN 'binding' END, CASE WHEN ids < n THEN 'asset-id-repeated' END, CASE WHEN names < n THEN 'asset-name-repeated' END, CASE WHEN n > 64 THEN 'asset-count' END,
  CASE WHEN least < 0 THEN 'asset-size' END, CASE WHEN manis <> 1 OR fs < 1 THEN 'manifest' END, CASE WHEN mains <> 1 OR ms < 1 THEN 'main' END, CASE WHEN main_id IS NULL OR main_id <> first THEN 'primary-asset' END]) AS code FROM p) WHERE code IS NOT NULL""",
    "ordered_strings": "SELECT source, sha256(text) AS digest, row_number() OVER (PARTITION BY source ORDER BY text) - 1 AS position FROM (SELECT DISTINCT source, text FROM documents)",
    "fair_turns": """SELECT queue, o_orderkey, row_number() OVER (ORDER BY nth, queue) - 1 AS turn FROM (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY o_orderkey) AS nth
 FROM (SELECT CASE WHEN o_orderpriority < '3' THEN 'registry' ELSE 'source' END AS queue, o_orderkey FROM orders))""",
    "html_text_nodes": r"""WITH t AS (SELECT page_id, list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(html, '^<!DOCTYPE[^>]*>', ''), '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '<x>', 'g'), '<[^>]*>'),
  lambda p: trim(regexp_replace(p, '\s+', ' ', 'g'))), lambda p: p <> '' AND NOT regexp_matches(regexp_replace(p, '&(amp|lt|gt|quot|apos|nbsp);', '', 'g'), '&[A-Za-z][A-Za-z0-9]+;')) AS n FROM pages WHERE length(html) - length(regexp_extract(html, '^<!DOCTYPE[^>]*>')) <= 100000)
 SELECT page_id, CAST(i - 1 AS INTEGER) AS nth, sha256(replace(replace(replace(replace(n[i], '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS digest FROM (SELECT page_id, n, unnest(range(1, len(n) + 1)) AS i FROM t)""",
    "json_values": r"""SELECT event_id, CASE WHEN t.parent IS NULL THEN '' ELSE '/' || t.key END AS pointer, CASE t.type WHEN 'OBJECT' THEN 'object' ELSE 'integer' END AS kind, CASE WHEN t.parent IS NULL THEN 0 ELSE 1 END AS depth, t.atom::VARCHAR AS value FROM events, json_tree(props) t""",
    "request_states": r"""WITH d AS (SELECT *, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM documents)
 SELECT doc_id AS request, code, CASE WHEN code = 'accepted' THEN sha256(text) END AS main FROM (SELECT *, CASE WHEN doc_id % 17 = 0 OR n_chars % 40 < 1 THEN 'request-invalid' WHEN doc_id % 19 = 0 THEN 'closure-invalid' WHEN text = '' THEN 'size-invalid'
 WHEN length(text) > 240 OR bare = '' THEN 'manifest-invalid' ELSE 'accepted' END AS code FROM d)""",
    "sealed_results": """SELECT event_id AS task_id, sha256(b) AS digest, strlen(b) AS size FROM (SELECT event_id, '{"result":{"materialization_target_digest":"' || sha256(event_type) || '","protocol":"demo","revision":1},"source_catalog":{"props":' || CAST(json(props) AS VARCHAR) || ',"z":1}}' AS b FROM events)""",
    "field_formats": r"""SELECT doc_id, regexp_full_match(w || '/' || source, '[A-Za-z0-9][A-Za-z0-9._@+=:/-]{0,511}') AND NOT contains(w || '/' || source, '//') AS reference, regexp_full_match(w, '[A-Za-z0-9._-]{1,6}') AND w NOT IN ('.', '..') AS identifier,
 length(text) <= 400 AND regexp_matches(text, '\S') AS bounded, regexp_full_match(substr(text, 1, 2), '[0-9a-f]{2}') AND doc_id % 12 < 10 AS uuid, doc_id % 2 = 0 AS base FROM (SELECT *, string_split(text, ' ')[1] AS w FROM documents WHERE text IS NOT NULL)""",
}
