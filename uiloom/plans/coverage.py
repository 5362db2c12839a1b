"""Queries over scripts, locales, coverage and codes, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uiloom.functions import text as T
from uiloom.operators import catalog, checks, coverage, registry


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_of(number: Column, *values: Column | str) -> Column:
    return F.element_at(F.array(*(F.lit(v) if isinstance(v, str) else v for v in values)), (number % len(values) + 1).cast("int"))


def ui_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sinks, attributes and options: static texts of plain receivers count, those behind calls, of several lines or in other scripts don't."""
    name = F.col("p_name")
    statement = case_of(
        F.col("p_partkey"),
        F.concat(F.lit('x.innerText="'), name, F.lit('\\nMore";')),
        F.concat(F.lit('f().textContent="'), name, F.lit('";')),
        F.concat(F.lit('this.el.textContent = "'), name, F.lit('";')),
        F.concat(F.lit('x.setAttribute("title","\\u4e2d '), name, F.lit('");')),
        F.concat(F.lit('x.setAttribute("aria-label","'), name, F.lit('",1);')),
        F.concat(F.lit('d.addOptions({a:"'), name, F.lit('", b:"Two words", c:d});')),
        F.concat(F.lit('x.innerHTML="<b>'), name, F.lit('</b> now";')),
        F.concat(F.lit('x.innerText="'), name, F.lit('";')),
    )
    parts = _t(spark, sf_dir, "part").select(F.concat_ws("/", F.col("p_brand"), (F.col("p_partkey") % 64).cast("string")).alias("plugin_id"), statement.alias("s"))
    bundles = parts.groupBy("plugin_id").agg(F.concat_ws("\n", F.sort_array(F.collect_list("s"))).alias("bundle"))
    return catalog.gated(catalog.extract_ui(bundles)).select("plugin_id", "symbol", "value").distinct()


def locale_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags made of a document's language and the first letters of its text: regions, scripts, variants and what is no tag."""
    tag = F.concat_ws("-", F.upper("lang"), F.substring(F.regexp_replace("text", "[^A-Za-z]", ""), F.lit(1), (F.col("doc_id") % 6).cast("int")))
    return _t(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", T.canonical_locale(tag).alias("locale"))


def source_locale_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names with Latin or Cyrillic words before them, from runtime and README."""
    number = F.col("c_custkey")
    value = F.concat(case_of(number, "Open ", "Привет мир и люди ", "Да ", ""), F.col("c_name"), F.repeat(F.lit(" and more words"), (number % 40).cast("int")))
    rows = _t(spark, sf_dir, "customer").select("c_custkey", value.alias("value"), value.alias("probe"), F.when(number % 2 == 0, "ui-call").otherwise("readme").alias("origin"))
    return catalog.gated(rows).select("c_custkey", "origin", F.length("value").alias("n"))


def release_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases with leading zeros in their tags; the newest is the latest one of every second repository."""
    key = F.col("o_orderkey")
    tag = F.concat(F.lit("v1.0"), key % 7, F.lit("."), key, F.when(key % 3 == 0, "-beta").otherwise("+b.1"))
    rows = _t(spark, sf_dir, "orders").select("o_custkey", key.alias("k"), tag.alias("tag"), (F.col("o_orderstatus") == "P").alias("draft"), (F.col("o_orderstatus") == "O").alias("prerelease"))
    newest = rows.groupBy("o_custkey").agg(F.max_by(F.struct("tag", "draft", "prerelease"), "k").alias("r")).where("o_custkey % 2 = 0").select("o_custkey", "r.*")
    ranked = rows.withColumn("position", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("k"))) - 1)
    return registry.choose_release(ranked, ["o_custkey"], newest)


def normal_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = "//# sourceMappingURL="
    made = case_of(
        F.col("p_partkey"),
        F.concat(F.col("p_name"), F.lit("; \n\t\n")),
        F.concat(F.col("p_name"), F.lit(f"\n{mark}a\nmore\n{mark}b")),
        F.concat(F.col("p_name"), F.lit(f"\n{mark}a\n/* nosourcemap */")),
        F.concat(F.lit(mark), F.col("p_name")),
    )
    return _t(spark, sf_dir, "part").select("p_partkey", F.sha2(T.normal_bundle(made), 256).alias("digest"))


def failure_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes made of the words of part names, some of which a public code stands for, and some of which are no codes."""
    number = F.col("p_partkey")
    noun = F.replace(F.get(F.split("p_name", " "), F.lit(1)), F.lit("widget"), F.lit("source"))
    code = F.concat(F.replace("p_name", F.lit(" "), F.when(number % 3 == 0, " ").otherwise("_")), F.lit("_"), F.replace(F.replace(noun, F.lit("ring"), F.lit("profile")), F.lit("bolt"), F.lit("adapter")))
    again, status = F.col("p_size") % 11 == 0, F.when(F.col("p_size") % 5 == 0, 409)
    return _t(spark, sf_dir, "part").select(
        "p_partkey", checks.failure_code(code, again).alias("command"), checks.resolution_failure_code(code, again, status).alias("resolution"), checks.diagnostic_code(code).alias("diagnostic"),
    )


def field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories and addresses made of the words of documents."""
    word = lambda n: F.coalesce(F.get(F.split("text", " "), F.lit(n)), F.lit(""))
    found = checks.repository_reference(F.concat_ws("/", word(0), word(1)))
    url = F.concat(F.when(F.col("doc_id") % 7 == 0, "http").otherwise("https"), F.lit("://"), word(0), F.element_at(F.array(*map(F.lit, ("/", "?", "#", "@", ":8/"))), (F.col("n_chars") % 5 + 1).cast("int")), word(1))
    return _t(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        "doc_id", found["owner"].alias("owner"), found["name"].alias("name"), checks.is_https_url(url, query=False).alias("plain"), checks.is_https_url(url, query=True).alias("with_query"),
        checks.is_positive(F.col("n_chars") - 100).alias("positive"), checks.is_content_size(F.col("n_chars") * 9_000).alias("size"),
    )


def evidence_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _t(spark, sf_dir, "part").select(
        F.col("p_brand").alias("value"), F.when(F.col("p_size") % 3 > 0, F.col("p_size")).alias("offset"), case_of(F.col("p_partkey"), "ui-call", "readme").alias("origin"),
        F.lit("structured").alias("strategy"), case_of(F.col("p_partkey"), "setName", F.lit(None).cast("string"), "setDesc").alias("symbol"),
    )
    places = F.transform("evidence", lambda e: F.concat_ws(":", e["offset"].cast("string"), e["origin"], e["strategy"], e["symbol"]))
    return catalog.evidence(parts, ["value"]).select("value", F.array_join(places, ",").alias("places"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as locale entries: owner is the source, resource and key follow the id."""
    return _t(spark, sf_dir, "documents").select(
        F.col("source").alias("owner"), (F.col("doc_id") % 3).alias("resource_id"), (F.col("doc_id") % 7).alias("resource_key"), F.col("lang").alias("locale"), "text",
    ).where("resource_id < 2 OR locale <> 'en'")


def resource_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources that an owner has in another locale and in English."""
    files = _entries(spark, sf_dir).select("owner", "resource_id", "locale", F.lit("n").alias("name"), F.lit("d").alias("digest")).distinct()
    return coverage.matched(files, ["owner", "resource_id"]).select("owner", "resource_id", "locale")


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("source").alias("owner"), F.col("text").alias("source"))
    found = docs.withColumn("key", T.string_key(F.col("owner"), F.col("source")))
    return catalog.translated(_entries(spark, sf_dir).where("text IS NOT NULL"), found)


def translated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _covered(spark, sf_dir).select("owner", "locale", "string_key", F.col("target_sha256").alias("target"))


def unit_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("source").alias("owner"), T.string_key(F.col("source"), F.col("text")).alias("string_key")).distinct()
    rows = catalog.units(docs, _covered(spark, sf_dir), ["owner", "string_key"])
    return rows.select("owner", "string_key", F.concat_ws(",", "locales").alias("locales"))


def carriers_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as translations that two carriers report; one may reject what the other translates, or translate it otherwise."""
    rows = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_linestatus").alias("source"), F.col("l_returnflag").alias("target"), F.col("l_partkey").alias("resource_key")
    )
    other = rows.where("line % 2 = 0").withColumn("target", F.when(F.col("k") % 5 == 0, F.col("source")).when(F.col("k") % 3 == 0, "Z").otherwise(F.col("target")))
    group = ["k", "line"]
    return coverage.held(coverage.merged([coverage.judged(rows, group), coverage.judged(other, group)], group))


def coverage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity of sets of resources: customers of a segment, 40 neighbours at a time."""
    rows = _t(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / 40).alias("owner"), F.col("c_mktsegment").alias("locale"), F.concat(F.lit("r"), "c_custkey").alias("resource_id"), F.col("c_name").alias("name"), F.sha2("c_name", 256).alias("digest")
    )
    return coverage.set_identity(rows, ["owner", "locale"])


QUERIES = {f.__name__: f for f in (
    ui_sinks, locale_tags, source_locale_gate, release_latest, normal_bundles, failure_codes, field_checks, evidence_places,
    resource_locales, translated_strings, unit_locales, carriers_merged, coverage_states,
)}

GATE = " AND ".join(["length(v) BETWEEN 2 AND {most}", r"regexp_matches(v, '\p{{L}}')", *(f"NOT regexp_matches(v, '{p.replace('{', '{{').replace('}', '}}')}')" for p in T.NOT_UI_TEXT)])
ENTRIES = """e AS (SELECT source AS owner, doc_id % 3 AS resource_id, doc_id % 7 AS resource_key, lang AS locale, text FROM documents WHERE doc_id % 3 < 2 OR lang <> 'en')"""


def signs(column: str) -> str:
    """The list of placeholders, which differs where the signature does."""
    return f"regexp_extract_all({column}, '" + T.PLACEHOLDER.replace("'", "''") + "')"


COVERED = ENTRIES + f""", f AS (SELECT DISTINCT source AS owner, text AS source, substr(sha256(source || chr(0) || text), 1, 32) AS string_key FROM documents WHERE lang = 'en'),
 p AS (SELECT o.owner, o.locale, f.string_key, f.source, o.text AS target FROM e o JOIN e s USING (owner, resource_id, resource_key) JOIN f ON f.owner = o.owner AND f.source = s.text WHERE o.locale <> 'en' AND s.locale = 'en'),
 c AS (SELECT owner, locale, string_key, min(target) AS target FROM p GROUP BY 1, 2, 3 HAVING count(DISTINCT target) = 1 AND NOT bool_or(source = target) AND NOT bool_or({signs("source")} <> {signs("target")}))"""

ORACLE_SQL = {
    "ui_sinks": f"""SELECT DISTINCT plugin_id, symbol, v AS value FROM (SELECT plugin_id, u.s AS symbol, u.t AS v FROM (SELECT p_brand || '/' || (p_partkey % 64) AS plugin_id,
 unnest(CASE p_partkey % 8 WHEN 2 THEN [{{'s': 'textContent', 't': p_name}}] WHEN 4 THEN [{{'s': 'setAttribute', 't': p_name}}] WHEN 5 THEN [{{'s': 'addOptions', 't': p_name}}, {{'s': 'addOptions', 't': 'Two words'}}]
 WHEN 6 THEN [{{'s': 'innerHTML', 't': p_name || ' now'}}] WHEN 7 THEN [{{'s': 'innerText', 't': p_name}}] ELSE [] END) AS u FROM part)) WHERE {GATE.format(most=512)}""",
    "locale_tags": r"""SELECT doc_id, CASE WHEN len(x) = 0 AND doc_id % 6 = 0 OR len(x) IN (0, 1) THEN NULL WHEN len(x) = 2 THEN lang || '-' || upper(x) WHEN len(x) = 4 THEN lang || '-' || upper(x[1]) || lower(x[2:]) ELSE lang || '-' || lower(x) END AS locale
 FROM (SELECT doc_id, lang, substr(regexp_replace(text, '[^A-Za-z]', '', 'g'), 1, doc_id % 6) AS x FROM documents WHERE text IS NOT NULL)""",
    "source_locale_gate": f"""SELECT c_custkey, origin, length(v) AS n FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'ui-call' ELSE 'readme' END AS origin,
 trim((['Open ', 'Привет мир и люди ', 'Да ', ''])[c_custkey % 4 + 1] || c_name || repeat(' and more words', c_custkey % 40)) AS v FROM customer)
 WHERE {GATE.format(most=512)} AND (origin = 'ui-call' OR length(v) <= 300) AND 2 * length(regexp_replace(v, '[^\\p{{Latin}}]', '', 'g')) >= length(regexp_replace(v, '[^\\p{{L}}]', '', 'g'))""",
    "release_latest": r"""WITH r AS (SELECT o_custkey, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) - 1 AS p, 'v1.0' || (o_orderkey % 7) || '.' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '-beta' ELSE '+b.1' END AS tag,
 o_orderstatus AS s FROM orders), q AS (SELECT *, s NOT IN ('P', 'O') AND NOT tag LIKE '%-beta' AS ok FROM r),
 l AS (SELECT o_custkey, max_by(CASE WHEN ok THEN tag ELSE '' END, k) AS st, max_by(CASE WHEN s <> 'P' THEN tag ELSE '' END, k) AS pr FROM q WHERE o_custkey % 2 = 0 GROUP BY 1),
 c AS (SELECT o_custkey, min_by(tag, p) FILTER (WHERE p < 300 AND ok) AS st, min_by(tag, p) FILTER (WHERE p < 300 AND s <> 'P') AS pr, count(*) AS n FROM q GROUP BY 1),
 j AS (SELECT c.o_custkey, coalesce(nullif(l.st, ''), c.st) AS st, coalesce(nullif(l.pr, ''), c.pr) AS pr, n FROM c LEFT JOIN l USING (o_custkey))
 SELECT o_custkey, coalesce(st, CASE WHEN n < 300 THEN pr END) AS tag, CASE WHEN st IS NOT NULL THEN 'stable' WHEN n < 300 AND pr IS NOT NULL THEN 'preview' WHEN n < 300 THEN 'none' ELSE 'search-limit' END AS kind FROM j""",
    "normal_bundles": r"""SELECT p_partkey, sha256(CASE p_partkey % 4 WHEN 0 THEN p_name || ';' WHEN 1 THEN p_name || chr(10) || '//# sourceMappingURL=a' || chr(10) || 'more' WHEN 2 THEN p_name ELSE '' END) AS digest FROM part""",
    "failure_codes": r"""SELECT p_partkey, CASE WHEN a THEN 'executor_workflow_failed' WHEN regexp_matches(c, 'source|component|license') THEN 'source_validation_rejected' WHEN regexp_matches(c, 'profile|binding') THEN 'registry_projection_changed'
 WHEN regexp_matches(c, 'adapter|result_') THEN 'adapter_validation_rejected' ELSE 'executor_workflow_failed' END AS command, CASE WHEN a OR p_size % 5 = 0 THEN 'registry_resolution_retryable' WHEN regexp_matches(c, 'profile|binding') THEN 'registry_profile_changed' ELSE 'registry_validation_rejected' END AS resolution,
 CASE WHEN regexp_full_match(c, '[a-z0-9_]{1,128}') THEN c ELSE 'unknown' END AS diagnostic FROM (SELECT *, p_size % 11 = 0 AS a, replace(p_name, ' ', CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '_' END) || '_' ||
 replace(replace(replace(string_split(p_name, ' ')[2], 'widget', 'source'), 'ring', 'profile'), 'bolt', 'adapter') AS c FROM part)""",
    "field_checks": r"""WITH d AS (SELECT *, string_split(text, ' ')[1] AS x, coalesce(string_split(text, ' ')[2], '') AS y FROM documents WHERE text IS NOT NULL), e AS (SELECT *, regexp_full_match(x, '[A-Za-z0-9-]{1,39}') AND regexp_full_match(y, '[A-Za-z0-9._-]{1,100}') AND y NOT IN ('.', '..') AS ok,
 CASE WHEN doc_id % 7 = 0 THEN 'http' ELSE 'https' END || '://' || x || (['/', '?', '#', '@', ':8/'])[n_chars % 5 + 1] || y AS u FROM d)
 SELECT doc_id, CASE WHEN ok THEN x END AS owner, CASE WHEN ok THEN y END AS name, regexp_full_match(u, '(?is)https://[^/?#@:]+(:[0-9]*)?(/[^?#]*)?\??#?') AS plain, regexp_full_match(u, '(?is)https://[^/?#@:]+(:[0-9]*)?(/[^?#]*)?(\?[^#]*)?#?') AS with_query,
 n_chars > 100 AS positive, n_chars * 9000 <= 67108864 AS size FROM e""",
    "evidence_places": """SELECT value, array_to_string(list_transform(list_sort(list_distinct(list({'o': o, 'g': g, 's': s}))), lambda e: e.o || ':' || e.g || ':structured:' || e.s), ',') AS places
 FROM (SELECT p_brand AS value, CASE WHEN p_size % 3 > 0 THEN p_size ELSE -1 END AS o, CASE WHEN p_partkey % 2 = 0 THEN 'ui-call' ELSE 'readme' END AS g, (['setName', '', 'setDesc'])[p_partkey % 3 + 1] AS s FROM part) GROUP BY value""",
    "resource_locales": f"WITH {ENTRIES} SELECT DISTINCT owner, resource_id, locale FROM e WHERE locale <> 'en' AND (owner, resource_id) IN (SELECT owner, resource_id FROM e WHERE locale = 'en')",
    "translated_strings": f"WITH {COVERED} SELECT owner, locale, string_key, sha256(target) AS target FROM c",
    "unit_locales": f"WITH {COVERED} SELECT f.owner, f.string_key, coalesce(string_agg(DISTINCT c.locale, ',' ORDER BY c.locale), '') AS locales FROM f LEFT JOIN c USING (owner, string_key) GROUP BY 1, 2",
    "carriers_merged": """WITH r AS (SELECT l_orderkey AS k, l_linenumber AS line, l_linestatus AS source, l_returnflag AS target, l_partkey AS p FROM lineitem UNION ALL
 SELECT l_orderkey, l_linenumber, l_linestatus, CASE WHEN l_orderkey % 5 = 0 THEN l_linestatus WHEN l_orderkey % 3 = 0 THEN 'Z' ELSE l_returnflag END, l_partkey FROM lineitem WHERE l_linenumber % 2 = 0)
 SELECT k, line, min(target) AS target, min(p) AS resource_key FROM r GROUP BY 1, 2 HAVING count(DISTINCT target) = 1 AND NOT bool_or(source = target)""",
    "coverage_states": """WITH r AS (SELECT c_custkey // 40 AS owner, c_mktsegment AS locale, 'r' || c_custkey AS i, c_name AS n, sha256(c_name) AS d FROM customer)
 SELECT owner, locale, CASE count(*) WHEN 1 THEN min(n) ELSE 'locale-component-set:' || count(*) END AS name, CASE count(*) WHEN 1 THEN min(d) ELSE
 sha256('{"components":[' || string_agg('{"digest":"' || d || '","name":"' || n || '","resource_id":"' || i || '"}', ',' ORDER BY i) || ']}') END AS digest FROM r GROUP BY 1, 2""",
}
