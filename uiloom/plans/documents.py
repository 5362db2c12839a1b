"""Queries for documents, checks and the queue; their inputs are made from the columns of the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uiloom.operators import checks, locales, readme
from uiloom.streaming import queue


def readme_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown document for each part: front matter, heading, a paragraph with a link, a list, fenced code and a table."""
    name, kind = F.col("p_name"), F.col("p_type")
    content = F.concat(
        F.lit("---\nkey: Hidden\n---\n# "), name, F.lit(" #\nSee [the "), kind, F.lit("](u)\nof **"), name, F.lit("**.\n- Size `"), F.col("p_size").cast("string"),
        F.lit("` of "), kind, F.lit("\n<!-- "), name, F.lit("\n-->\n```\n# "), kind, F.lit("\n```\n| a | b |\n"),
    )
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), content.alias("content"))
    return readme.strings(parts)


def locale_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested catalog for each customer; every fifth holds a list and is rejected."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    menu = F.struct(F.struct(F.col("c_name").alias("a/b"), F.col("c_nationkey").alias("n")).alias("menu"), F.col("c_mktsegment").alias("seg~ment"))
    listed = F.to_json(F.struct(F.array("c_name").alias("names")))
    content = F.when(F.col("c_custkey") % 5 == 0, listed).otherwise(F.to_json(menu))
    entries, _ = locales.flatten(customer.select(F.col("c_custkey").alias("id"), F.lit("PT_br").alias("locale"), content.alias("content")))
    return entries


def locale_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the type of a part, by brand and size, is that of the first brand."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    texts = part.groupBy(F.col("p_brand").alias("id"), F.col("p_size").cast("string").alias("pointer")).agg(F.min("p_type").alias("text"))
    first = part.groupBy(F.col("p_size").cast("string").alias("pointer")).agg(F.min("p_type").alias("text"))
    return locales.agreement(texts, first)


def source_plan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a plan, its lines as assets."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    asset = F.struct(
        F.col("l_partkey").alias("assetId"), F.when(F.col("l_linenumber") == 1, "main.js").otherwise(F.concat(F.lit("f"), F.col("l_suppkey") % 5)).alias("name"),
        (F.col("l_quantity").cast("bigint") - 1).alias("size"), F.sha2(F.col("l_returnflag"), 256).alias("sha256"),
    )
    plans = lines.groupBy("l_orderkey").agg(F.collect_list(asset).alias("assets"), F.min("l_partkey").alias("primaryAssetId"))
    key = F.col("l_orderkey").cast("string")
    digest = F.when(F.col("l_orderkey") % 3 > 0, F.sha2(key, 256))
    made = plans.withColumns({"commitSha": F.sha1(key), "sourcePlanDigest": digest, "resultMaxBytes": F.col("l_orderkey") * 100_000})
    return checks.plan_violations(made, "l_orderkey")


def catalog_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return checks.catalog_violations(docs.select("source", F.md5("text").alias("key"), "text"), "source")


def failure_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = {"jobId": "o_orderkey", "registryKey": "o_orderpriority", "externalObjectId": "o_custkey", "failureCode": "o_orderstatus"}
    fields = {k: F.col(v).cast("string") for k, v in text.items()} | {k: F.lit("d") for k in ("registryAuthorityDigest", "validatorProfileDigest")}
    fields |= {"expectedRegistryHeadGeneration": F.col("o_custkey"), "leaseFence": F.col("o_orderkey") % 9, "diagnosticCode": F.lit(None).cast("string")}
    return checks.failure_evidence(orders.select(*(v.alias(k) for k, v in fields.items()))).select("jobId", "evidenceDigest")


def queue_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as commands on their orders; a fence holds while it is the order's last digit."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem"))
    code = F.when(F.col("l_returnflag") == "N", "http-503").when(F.col("l_returnflag") == "R", "refused")
    fence = F.when(F.col("l_linestatus") == "O", F.col("l_orderkey") % 10).otherwise(F.lit(3).cast("bigint"))
    commands = lines.select(F.col("l_orderkey").alias("task_id"), (F.col("l_suppkey") % 2).cast("string").alias("command_id"), fence.alias("fence"), F.col("l_linenumber").alias("attempt"), code.alias("code"))
    return queue.settle(commands, orders.select(F.col("o_orderkey").alias("task_id"), (F.col("o_orderkey") % 10).alias("fence")))


QUERIES = {f.__name__: f for f in (readme_strings, locale_entries, locale_agreement, source_plan_checks, catalog_checks, failure_digests, queue_states)}

ORACLE_SQL = {
    "readme_strings": """SELECT DISTINCT p_partkey AS id, unnest([p_name, 'the ' || p_type, 'See {{th:expr:0}} of ' || p_name || '.', 'Size {{th:expr:0}} of ' || p_type]) AS text FROM part""",
    "locale_entries": """SELECT c_custkey AS id, 'pt-BR' AS locale, '/menu/a~1b' AS pointer, c_name AS text FROM customer WHERE c_custkey % 5 <> 0
 UNION ALL SELECT c_custkey, 'pt-BR', '/seg~0ment', c_mktsegment FROM customer WHERE c_custkey % 5 <> 0""",
    "locale_agreement": """SELECT a.id, avg(CASE WHEN a.t = b.t THEN 1.0 ELSE 0.0 END) AS agreement FROM (SELECT p_brand AS id, p_size AS s, min(p_type) AS t FROM part GROUP BY 1, 2) a
 JOIN (SELECT p_size AS s, min(p_type) AS t FROM part GROUP BY 1) b USING (s) GROUP BY a.id""",
    "source_plan_checks": """WITH l AS (SELECT l_orderkey, l_partkey AS id, CASE WHEN l_linenumber = 1 THEN 'main.js' ELSE 'f' || (l_suppkey % 5) END AS name, l_quantity, l_linenumber FROM lineitem),
 p AS (SELECT l_orderkey, min(id) AS main, count(*) AS n, count(DISTINCT id) AS ids, count(DISTINCT name) AS names, min(l_quantity) AS q FROM l GROUP BY 1),
 m AS (SELECT l.l_orderkey, count(*) AS c, min(name) AS lo, max(name) AS hi FROM l JOIN p ON l.l_orderkey = p.l_orderkey AND l.id = p.main GROUP BY 1)
 SELECT l_orderkey, 'asset-id-repeated' AS code FROM p WHERE ids < n UNION ALL SELECT l_orderkey, 'asset-name-repeated' FROM p WHERE names < n
 UNION ALL SELECT l_orderkey, 'asset-size' FROM p WHERE q <= 1 UNION ALL SELECT l_orderkey, 'primary-asset' FROM m WHERE NOT (c = 1 AND lo = 'main.js')
 UNION ALL SELECT l_orderkey, 'plan-digest' FROM p WHERE l_orderkey % 3 = 0 UNION ALL SELECT l_orderkey, 'result-size' FROM p WHERE l_orderkey * 100000 NOT BETWEEN 1 AND 67108864""",
    "catalog_checks": """WITH k AS (SELECT source, md5(text) AS k, count(*) AS n, max(strlen(text)) AS b, bool_or(coalesce(text = '' OR contains(text, chr(0)), true)) AS bad FROM documents GROUP BY 1, 2),
 c AS (SELECT source, sum(n) AS n, max(n) AS m, max(b) AS b, bool_or(bad) AS bad FROM k GROUP BY 1)
 SELECT source, 'too-many-units' AS code FROM c WHERE n > 50000 UNION ALL SELECT source, 'key-repeated' FROM c WHERE m > 1
 UNION ALL SELECT source, 'text-too-long' FROM c WHERE b > 1048576 UNION ALL SELECT source, 'text-invalid' FROM c WHERE bad""",
    "failure_digests": """SELECT CAST(o_orderkey AS VARCHAR) AS "jobId", sha256('{"diagnosticCode":null,"expectedRegistryHeadGeneration":' || o_custkey || ',"externalObjectId":"' || o_custkey || '","failureCode":"' || o_orderstatus
 || '","jobId":"' || o_orderkey || '","leaseFence":' || (o_orderkey % 9) || ',"registryAuthorityDigest":"d","registryKey":"' || o_orderpriority || '","validatorProfileDigest":"d"}') AS "evidenceDigest" FROM orders""",
    "queue_states": """WITH c AS (SELECT l_orderkey AS t, CAST(l_suppkey % 2 AS VARCHAR) AS c, CASE WHEN l_linestatus = 'O' THEN l_orderkey % 10 ELSE 3 END AS fence, l_linenumber AS a, l_returnflag AS f,
 CASE l_returnflag WHEN 'N' THEN 'http-503' WHEN 'R' THEN 'refused' END AS code FROM lineitem),
 r AS (SELECT *, row_number() OVER (PARTITION BY t, c ORDER BY a DESC, code IS NULL DESC, code DESC, fence DESC) AS k FROM c)
 SELECT t AS task_id, c AS command_id, CASE WHEN o_orderkey IS NULL OR fence <> o_orderkey % 10 THEN 'stale' WHEN code IS NULL THEN 'done' WHEN code = 'http-503' AND a < 3 THEN 'requeued' ELSE 'failed' END AS state
 FROM r LEFT JOIN orders ON t = o_orderkey WHERE k = 1""",
}
