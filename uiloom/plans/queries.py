"""Queries over the supplied tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uiloom.functions import text as T
from uiloom.operators import catalog, registry
from uiloom.plans import coverage, documents, releases, resolution


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


GATE_SQL = " AND ".join(["length(v) BETWEEN 2 AND {most}", r"regexp_matches(v, '\p{{L}}')", *(f"NOT regexp_matches(v, '{p.replace('{', '{{').replace('}', '}}')}')" for p in T.NOT_UI_TEXT)])


#: Bundles that the parts of a brand are dealt over; more for larger tables.
BUNDLES = 256


def gate_sql(most: int) -> str:
    return GATE_SQL.format(most=most)


def ui_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, nation, customer = (_t(spark, sf_dir, n) for n in ("part", "nation", "customer"))
    values = parts.select(F.col("p_name").alias("v")).union(parts.select("p_type")).union(nation.select("n_name")).union(customer.select("c_name"))
    return values.where(T.is_ui_text(F.col("v"))).select(F.col("v").alias("value"))


def bundle_of(parts: DataFrame, statement: Column) -> DataFrame:
    """Bundles for each brand, made of one statement for each part; a brand's parts are dealt over BUNDLES of them, so no bundle holds a share of the whole table."""
    dealt = parts.groupBy(F.col("p_brand").alias("plugin_id"), F.pmod(F.xxhash64("p_partkey"), F.lit(BUNDLES)))
    return dealt.agg(F.concat_ws("\n", F.sort_array(F.collect_list(statement))).alias("bundle")).select("plugin_id", "bundle")


def extract_ui_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _t(spark, sf_dir, "part")
    bundles = bundle_of(parts, F.concat(F.lit('s.setName("'), F.col("p_name"), F.lit('"); // shown')))
    found = catalog.strings(catalog.gated(catalog.extract_ui(bundles)))
    return found.select("plugin_id", "source", "key", "semantic_role", "source_key", "placeholder_signature")


def extract_add_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _t(spark, sf_dir, "part")
    bundles = bundle_of(parts, F.concat(F.lit("d.addOption('Choice "), F.col("p_partkey"), F.lit("', '"), F.col("p_name"), F.lit("');")))
    return catalog.gated(catalog.extract_ui(bundles)).select("plugin_id", F.col("value").alias("label")).distinct()


def placeholder_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("Order ${"), F.col("l_orderkey"), F.lit("}"), F.when(F.col("l_linenumber") % 2 == 0, " of {0} %s").otherwise(""))
    lines = _t(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") % 3 == 0, "plain").otherwise(made).alias("value"))
    return lines.select("value", T.placeholder_signature(F.col("value")).alias("signature")).distinct()


def origins_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidates; where a text comes from follows its id."""
    origin = F.element_at(F.array(*map(F.lit, ("ui-call", "readme", "manifest.name", "registry.description", "ui-property"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return _t(spark, sf_dir, "documents").select(F.col("text").alias("value"), origin.alias("origin"))


def dedup_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.with_provenance(origins_of(spark, sf_dir), ["value"])
    return rows.select(F.sha2(F.col("value").cast("binary"), 256).alias("digest"), F.concat_ws(",", "origins").alias("origins"), "n")


def string_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.string_key(F.col("source"), F.col("text")).alias("key"))


def role_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.with_provenance(origins_of(spark, sf_dir), ["value"])
    roles = rows.select(catalog.semantic_role(F.col("origins")).alias("role"), F.coalesce(catalog.source_key(F.col("origins")), F.lit("none")).alias("source_key"))
    return roles.groupBy("role", "source_key").agg(F.count("*").alias("n"))


def translation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English texts joined to those of other languages by a made-up resource key."""
    docs = _t(spark, sf_dir, "documents").withColumn("resource_key", F.col("doc_id") % 97)
    english = docs.where("lang = 'en'").groupBy("resource_key").agg(F.min("text").alias("source"))
    return docs.where("lang <> 'en'").select(F.col("lang").alias("locale"), "resource_key", F.col("text").alias("target")).join(english, "resource_key")


def locale_join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = translation_pairs(spark, sf_dir)
    return pairs.groupBy("locale").agg(F.countDistinct("resource_key").alias("keys"), F.count("*").alias("entries"))


def sticky_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = catalog.coverage(translation_pairs(spark, sf_dir), ["locale", "source"])
    return kept.select("locale", "resource_key", F.sha2(F.col("target").cast("binary"), 256).alias("target"))


def release_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    tag = F.concat(F.lit("1."), F.col("o_orderkey") % 7, F.lit("."), F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, "-beta").otherwise(""))
    rows = orders.select("o_custkey", F.col("o_orderkey").alias("position"), tag.alias("tag"), (F.col("o_orderstatus") == "P").alias("draft"), (F.col("o_orderstatus") == "O").alias("prerelease"))
    ranked = rows.withColumn("position", F.row_number().over(Window.partitionBy("o_custkey").orderBy("position")) - 1)
    return registry.choose_release(ranked, ["o_custkey"])


def strict_json_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _t(spark, sf_dir, "events").select("event_id", T.strict_json(F.col("props")).alias("v"))
    return parsed.select("event_id", F.col("v").isNotNull().alias("valid"))


def json_pointer_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")))
    return events.select("event_id", F.concat(F.lit("/"), T.pointer_segment(F.col("key"))).alias("pointer"), "value")


def html_inner_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").select("page_id", T.inner_html_text(F.col("html")).alias("t"))
    return pages.where("t IS NOT NULL").select("page_id", F.sha2(F.col("t").cast("binary"), 256).alias("digest"))


def licence_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    spdx = F.when(F.contains("text", F.lit("Apache License")), "Apache-2.0").otherwise("NOASSERTION")
    wrapped = F.regexp_replace(F.base64(F.col("text").cast("binary")), "(.{60})", "$1\n")
    return registry.licence_evidence(docs.select(F.col("doc_id").alias("id"), spdx.alias("spdx"), wrapped.alias("content")))


def catalog_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _t(spark, sf_dir, "documents").select((F.col("doc_id") % 1009).alias("source_key"))
    sources = _t(spark, sf_dir, "labels").select((F.col("doc_id") % 1009).alias("source_key"))
    return catalog.validate(units, sources, ["source_key"])


def directory_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
    claims = _t(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") * 2).alias("id"))
    return registry.look_up(claims, directory, "id").select("s_suppkey", "id", "state")


def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, parts = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "part")
    values = parts.select(F.col("p_name").alias("value")).union(parts.select(F.initcap("p_name"))).union(orders.select("o_orderpriority")).distinct()
    return values.where(T.is_title_case(F.col("value")))


def repository_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths made from part names; some go up a folder, are absolute or use back slashes."""
    lead = F.element_at(F.array(*map(F.lit, ("src/", "/", "../", "a\\", ""))), (F.col("p_partkey") % 5 + 1).cast("int"))
    made = _t(spark, sf_dir, "part").select("p_partkey", F.concat(lead, "p_name", F.lit(".md")).alias("path"))
    return made.select("p_partkey", T.is_repository_path(F.col("path")).alias("safe"))


def locale_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", T.is_single_line(F.col("text")).alias("single"), T.fits_locale(F.col("text"), F.lit("en")).alias("fits"))


def blob_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", T.git_blob_id(F.col("text").cast("binary")).alias("blob"))


def document_blob_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every page with its address, whatever the characters; a null page has a null id."""
    return _t(spark, sf_dir, "pages").select("page_id", T.git_blob_id(F.concat_ws("\n", "url", "html").cast("binary")).alias("blob"))


def canonical_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", F.sha2(T.canonical_json("props"), 256).alias("digest"))


ORIGIN_SQL = "list_extract(['ui-call', 'readme', 'manifest.name', 'registry.description', 'ui-property'], CAST(doc_id % 5 + 1 AS INT))"
PAIRS_SQL = """pairs AS (SELECT d.lang AS locale, d.doc_id % 97 AS resource_key, d.text AS target, e.source FROM documents d JOIN
 (SELECT doc_id % 97 AS k, min(text) AS source FROM documents WHERE lang = 'en' GROUP BY 1) e ON d.doc_id % 97 = e.k WHERE d.lang <> 'en')"""
#: The placeholder grammar as far as the supplied texts need it.
SIGNATURE_SQL = r"regexp_extract_all({0}, '\$\{{[^}}]+\}}|\{{\d+\}}|%[sdif]|</?[A-Za-z][A-Za-z0-9-]*\s*/?>')"

QUERIES = {
    f.__name__: f
    for f in (
        ui_text_filter, extract_ui_calls, extract_add_option, placeholder_signatures, dedup_provenance, string_keys, role_precedence,
        locale_join_coverage, sticky_conflict, release_choice, strict_json_gate, json_pointer_flatten, html_inner_text,
        licence_evidence, catalog_validation, directory_lookup, title_case_names, repository_paths, locale_texts, blob_ids, document_blob_ids, canonical_props,
    )
}

ORACLE_SQL = {
    "ui_text_filter": f"SELECT v AS value FROM (SELECT p_name AS v FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT n_name FROM nation UNION ALL SELECT c_name FROM customer) WHERE {gate_sql(300)}",
    "extract_ui_calls": f"""SELECT DISTINCT p_brand AS plugin_id, v AS source, substr(sha256(p_brand || chr(0) || v), 1, 32) AS key, 'runtime-ui' AS semantic_role,
 'runtime' AS source_key, '' AS placeholder_signature FROM (SELECT p_brand, p_name AS v FROM part) WHERE {gate_sql(512)}""",
    "extract_add_option": f"SELECT DISTINCT p_brand AS plugin_id, v AS label FROM (SELECT p_brand, p_name AS v FROM part) WHERE {gate_sql(512)}",
    "placeholder_signatures": """SELECT DISTINCT value, CASE len(f) WHEN 0 THEN '' WHEN 1 THEN f[1] ELSE '["' || array_to_string(f, '","') || '"]' END AS signature FROM
 (SELECT value, """ + SIGNATURE_SQL.format("value") + """ AS f FROM (SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'plain' ELSE
 'Order ${' || l_orderkey || '}' || CASE WHEN l_linenumber % 2 = 0 THEN ' of {0} %s' ELSE '' END END AS value FROM lineitem))""",
    "dedup_provenance": f"SELECT sha256(text) AS digest, string_agg(DISTINCT o, ',' ORDER BY o) AS origins, count(*) AS n FROM (SELECT text, {ORIGIN_SQL} AS o FROM documents) GROUP BY text",
    "string_keys": "SELECT doc_id, substr(sha256(source || chr(0) || text), 1, 32) AS key FROM documents",
    "role_precedence": f"""SELECT role, source_key, count(*) AS n FROM (SELECT
 CASE WHEN bool_or(o = 'manifest.name') THEN 'official-name' WHEN bool_or(o = 'registry.description') THEN 'description' WHEN bool_or(o = 'readme') THEN 'readme' ELSE 'runtime-ui' END AS role,
 CASE WHEN bool_or(o IN ('ui-call', 'ui-property')) THEN 'runtime' WHEN bool_or(o = 'manifest.name') THEN 'metadata' WHEN bool_or(o = 'readme') THEN 'documentation' ELSE 'none' END AS source_key
 FROM (SELECT text, {ORIGIN_SQL} AS o FROM documents) GROUP BY text) GROUP BY role, source_key""",
    "locale_join_coverage": f"WITH {PAIRS_SQL} SELECT locale, count(DISTINCT resource_key) AS keys, count(*) AS entries FROM pairs GROUP BY locale",
    "sticky_conflict": f"""WITH {PAIRS_SQL} SELECT locale, min(resource_key) AS resource_key, sha256(min(target)) AS target FROM pairs GROUP BY locale, source
 HAVING count(DISTINCT target) = 1 AND NOT bool_or(source = target) AND NOT bool_or({SIGNATURE_SQL.format("source")} <> {SIGNATURE_SQL.format("target")})""",
    "release_choice": r"""WITH r AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS p, '1.' || (o_orderkey % 7) || '.' || o_orderkey ||
 CASE WHEN o_orderkey % 3 = 0 THEN '-beta' ELSE '' END AS tag, o_orderstatus AS s FROM orders),
 c AS (SELECT o_custkey, min_by(tag, p) FILTER (WHERE p < 300 AND s NOT IN ('P', 'O') AND NOT tag LIKE '%-beta') AS st, min_by(tag, p) FILTER (WHERE p < 300 AND s <> 'P') AS pr, count(*) AS n FROM r GROUP BY 1)
 SELECT o_custkey, coalesce(st, CASE WHEN n < 300 THEN pr END) AS tag, CASE WHEN st IS NOT NULL THEN 'stable' WHEN n < 300 AND pr IS NOT NULL THEN 'preview' WHEN n < 300 THEN 'none' ELSE 'search-limit' END AS kind FROM c""",
    "strict_json_gate": "SELECT event_id, coalesce(json_valid(props), false) AS valid FROM events",
    "json_pointer_flatten": "SELECT event_id, '/' || k AS pointer, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)",
    "html_inner_text": r"SELECT page_id, sha256(t) AS digest FROM (SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS t FROM pages WHERE NOT contains(html, '{{th:expr:')) WHERE regexp_matches(t, '\p{L}')",
    "licence_evidence": "SELECT doc_id AS id, sha256(text) AS sha256, CASE WHEN contains(text, 'Apache License') THEN 'Apache-2.0' ELSE 'LicenseRef-SHA256-' || sha256(text) END AS licence FROM documents",
    "catalog_validation": """SELECT DISTINCT doc_id % 1009 AS source_key, 'unit-without-source' AS code FROM documents WHERE doc_id % 1009 NOT IN (SELECT doc_id % 1009 FROM labels)
 UNION ALL SELECT DISTINCT doc_id % 1009, 'source-without-unit' FROM labels WHERE doc_id % 1009 NOT IN (SELECT doc_id % 1009 FROM documents)""",
    "directory_lookup": "SELECT s_suppkey, s_nationkey * 2 AS id, CASE WHEN n_nationkey IS NULL THEN 'absent' ELSE 'present' END AS state FROM supplier LEFT JOIN nation ON s_nationkey * 2 = n_nationkey",
    "title_case_names": r"""SELECT value FROM (SELECT p_name AS value FROM part UNION SELECT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM part UNION
 SELECT o_orderpriority FROM orders) WHERE length(value) BETWEEN 2 AND 200 AND regexp_matches(value, '^[A-Za-z]') AND regexp_matches(value, '[A-Z]') AND NOT regexp_matches(value, '[:/.\[\]{}<>]')""",
    "repository_paths": "SELECT p_partkey, p_partkey % 5 IN (0, 4) AS safe FROM part",
    "locale_texts": r"""SELECT doc_id, NOT regexp_matches(text, '[\r\n]') AS single, 2 * length(regexp_replace(text, '[^\p{Latin}]', '', 'g')) >= length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS fits FROM documents""",
    "blob_ids": "SELECT doc_id, sha1('blob ' || strlen(text) || chr(0) || text) AS blob FROM documents",
    "document_blob_ids": "SELECT page_id, sha1('blob ' || strlen(t) || chr(0) || t) AS blob FROM (SELECT page_id, concat_ws(chr(10), url, html) AS t FROM pages)",
    "canonical_props": "SELECT event_id, sha256(CAST(json(props) AS VARCHAR)) AS digest FROM events",
}

QUERIES |= documents.QUERIES | coverage.QUERIES | releases.QUERIES | resolution.QUERIES
ORACLE_SQL |= documents.ORACLE_SQL | coverage.ORACLE_SQL | releases.ORACLE_SQL | resolution.ORACLE_SQL
