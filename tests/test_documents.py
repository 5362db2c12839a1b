import hashlib
import json

from pyspark.sql import functions as F

from uiloom.operators import checks, locales, readme
from uiloom.streaming import queue


def test_locale_documents(spark):
    deep = lambda n: json.loads('{"k":' * n + '"Text"' + "}" * n)
    docs = [
        ("a", "en_us", json.dumps({"a": {"b/c": " One ", "~": "Two"}, "n": 1, "e": {}, "blank": " ", "é": "e\u0301"})),
        ("list", "en", '{"a":["x"]}'), ("root", "en", '"x"'), ("null", "en", None), ("bad", "en", "{"), ("empty", "en", "{}"), ("key", "en", '{"a":{"":"x"}}'),
        ("d16", "de", json.dumps(deep(16))), ("d17", "de", json.dumps(deep(17))), ("tag", "!", "{}"), ("many", "en", json.dumps({f"k{i}": "t" for i in range(10_001)})),
        ("json", "en", json.dumps({"a": '{"b":"c"}'})),
    ]
    entries, rejected = locales.flatten(spark.createDataFrame(docs, "id string, locale string, content string"))
    found = {(r.id, r.locale, r.pointer): r.text for r in entries.collect()}
    assert found == {
        ("a", "en-US", "/a/b~1c"): "One", ("a", "en-US", "/a/~0"): "Two", ("a", "en-US", "/é"): "é", ("d16", "de", "/k" * 16): "Text", ("json", "en", "/a"): '{"b":"c"}',
    }
    codes = {r.id: r.code for r in rejected.collect()}
    invalid = dict.fromkeys(("list", "root", "null", "bad", "key"), "content-invalid")
    assert codes == {**invalid, "d17": "too-deep", "tag": "locale-invalid", "many": "too-many-entries"}


def shown(spark, text):
    return {r.text for r in readme.strings(spark.createDataFrame([(1, text)], "id long, content string")).collect()}


def test_readme(spark):
    text = """\ufeff---
title: Hidden
---
# Main title ##
First line with `code`
and **bold** text.
- item one
  more of it
* [Label](http://x) here ![pic](y)
<!-- gone
still gone --> tail
```js
# not a heading
``
````
After fence
~~~
```
~~~
> quoted
> - part

| a | b |
|---|---|

---

A &amp; B <b>x</b> <https://a.b> [r][q]
[![i](a)](b) 12
"""
    assert shown(spark, text) == {
        "Main title", "First line with {{th:expr:0}} and bold text.", "item one", "more of it", "Label", "{{th:expr:0}} here", "After fence",
        "quoted - part", "A & B x {{th:expr:0}} {{th:expr:1}} 12", "r",
    }


def test_readme_edges(spark):
    assert shown(spark, None) == set() == shown(spark, "") == shown(spark, "\n \n") == shown(spark, "123\n\n`code`") == shown(spark, "```\nnever closed\n\n# Title")
    assert shown(spark, "line\n" * 20_000) == {" ".join(["line"] * 20_000)}
    assert shown(spark, "- a|b\n- c\n\nd") == {"d"}


def test_checks(spark):
    plan = "k int, assets array<struct<assetId:bigint,name:string,size:bigint,sha256:string>>, primaryAssetId bigint, commitSha string, sourcePlanDigest string, resultMaxBytes bigint"
    good = (1, "main.js", 5, "a" * 64)
    rows = [(1, [good], 1, "b" * 40, "c" * 64, 9), (2, [good, good], 1, "x", None, 0), (3, None, None, "b" * 40, "c" * 64, 9), (4, [(1, "a.js", 0, None)], 1, "b" * 40, "c" * 64, 9)]
    found = checks.plan_violations(spark.createDataFrame(rows, plan), "k").groupBy("k").agg(F.collect_set("code").alias("c")).collect()
    by = {r.k: set(r.c) for r in found}
    assert 1 not in by and by[4] == {"asset-size", "asset-digest", "primary-asset"}
    assert by[2] == {"asset-id-repeated", "asset-name-repeated", "primary-asset", "commit", "plan-digest", "result-size"}
    assert {"assets-empty", "primary-asset"} <= by[3]
    units = spark.createDataFrame([("a", "x", "T"), ("b", "x", "T"), ("b", "x", "U"), ("c", "y", None)], "catalog string, key string, text string")
    assert {tuple(r) for r in checks.catalog_violations(units, "catalog").collect()} == {("b", "key-repeated"), ("c", "text-invalid")}


def test_results(spark):
    names = checks.PRESENT_FIELDS
    schema = "jobId string, resolutionStatus string, " + ", ".join(f"{n} string" for n in names) + ", assets array<struct<assetId:bigint,sha256:string>>"
    full, void = ("v",) * len(names), (None,) * len(names)
    rows = [("p", "present", *full, [(1, "d")]), ("q", "present", *full, [(1, None)]), ("r", "present", *void, None), ("s", "absent", *void, []), ("t", "absent", *full, None), ("u", None, *void, None)]
    sealed, refused = checks.resolution_results(spark.createDataFrame(rows, schema), ["jobId"])
    digests = {r.jobId: r.evidenceDigest for r in sealed.collect()}
    assert set(digests) == {"p", "s"} and {r.jobId for r in refused.collect()} == {"q", "r", "t", "u"}
    assert digests["s"] == hashlib.sha256(b'{"jobId":"s","resolutionStatus":"absent"}').hexdigest()


def test_queue(spark, tmp_path):
    folders = [str(tmp_path / n) for n in ("commands", "leases", "settled", "checkpoint")]
    spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 7)], "task_id bigint, fence bigint").write.parquet(folders[1])
    put = lambda rows: spark.createDataFrame(rows, queue.COMMAND).write.mode("append").parquet(folders[0])
    settled = lambda: {(r.batch, r.task_id, r.state) for r in spark.read.parquet(folders[2]).collect()}
    put([(1, "a", 7, 1, None), (1, "a", 7, 1, None), (2, "b", 7, 1, "http-503"), (3, "c", 7, 1, None), (4, "d", 7, 3, "http-503"), (None, "e", 7, 1, None)])
    queue.run_available(spark, *folders).awaitTermination()
    first = {(0, 1, "done"), (0, 2, "requeued"), (0, 3, "stale"), (0, 4, "failed"), (0, None, "stale")}
    assert settled() == first
    put([(1, "a", 7, 1, None), (2, "b", 7, 2, None)])
    queue.run_available(spark, *folders).awaitTermination()
    assert settled() == first | {(1, 2, "done")}
