import hashlib
import os
import random
import subprocess
import sys
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from uiloom.functions import script
from uiloom.functions import text as T
from uiloom.operators import catalog, registry
from uiloom.plans.queries import ORACLE_SQL, QUERIES
from uiloom.sources import components

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()


def texts(source):
    found = script.visible_text(source)
    return None if found is None else {f.text for f in found}


@pytest.mark.parametrize(
    ("source", "there", "absent"),
    [
        ('new Notice("Ready now");', {"Ready now"}, set()),
        ("d.addOption('value one','Label one')", {"Label one"}, {"value one"}),
        ('x.setAttribute("title","Show note")', {"Show note"}, set()),
        ('x.setAttribute("data-x","Show note")', set(), {"Show note"}),
        ('x.setAttribute("title",name)', set(), {"name"}),
        ('c.createEl("h4",{text:"Heading here",cls:"Other text"})', {"Heading here"}, {"Other text"}),
        ("a.textContent='Shown text';", {"Shown text"}, set()),
        ("a.textContent=='Not shown'", set(), {"Not shown"}),
        ('setName("a" + n + `b ${x} c`)', {"a{{th:expr:1}}b {{th:expr:2}} c"}, set()),
        ('// setName("No")\n/* setName("Never") */ var r=/setName("x")/;', set(), {"No", "Never", "x"}),
        (r'setName("\u{1F680} go \x41")', {"\U0001f680 go A"}, set()),
        (r'setName("\ud83d alone")', set(), {"\ud83d alone"}),
        ('setName(t ? "Yes" : "No")', set(), {"Yes", "No"}),
    ],
)
def test_rules(source, there, absent):
    found = texts(source)
    assert there <= found and not absent & found


def test_broken_bundles_give_nothing():
    assert texts("/* open") is None and texts("'open") is None and texts("`open ${a}") is None and texts("f(]") is None


def test_gate_and_signature(spark):
    values = ["Open file", "ECONOMY", "https://x.y", "a.b.c", "kebab-case", "x", "12", '{"type":"abc"}', '{"title":"Any words"}', None, "é à"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    kept = {r.v for r in rows.where(T.is_ui_text(F.col("v"))).collect()}
    assert kept == {"Open file", '{"title":"Any words"}', "é à"}
    signs = {r.v: r.s for r in spark.createDataFrame([("a",), ("${n}",), ("{0} of <b>%s",)], "v string").withColumn("s", T.placeholder_signature(F.col("v"))).collect()}
    assert signs == {"a": "", "${n}": "${n}", "{0} of <b>%s": '["{0}","<b>","%s"]'}


def test_locales_and_strict_json(spark):
    rows = spark.createDataFrame([("zh",), ("EN-us",), ("sr-latn-RS",), ("!",), ("zh-yue",), ("EN_us",)], "v string")
    assert [r[0] for r in rows.select(T.canonical_locale(F.col("v"))).collect()] == ["zh-CN", "en-US", "sr-Latn-RS", None, "zh-yue", None]
    rows = spark.createDataFrame([('{"a":1}',), ('{"a":1,"a":2}',), ('{"a":NaN}',), ("{",)], "v string")
    assert [r[0] for r in rows.select(T.strict_json(F.col("v")).isNotNull()).collect()] == [True, False, False, False]


def test_coverage_is_sticky_in_any_order(spark):
    pairs = [("de", 2, "a", "x"), ("de", 1, "a", "x"), ("de", 1, "b", "x"), ("de", 2, "b", "y"), ("de", 1, "c", "c"), ("de", 2, "c", "z"), ("de", 1, "{0}", "x")]
    for rows in (pairs, pairs[::-1]):
        kept = catalog.coverage(spark.createDataFrame(rows, "locale string, resource_key long, source string, target string"), ["locale", "source"])
        assert [tuple(r) for r in kept.select("source", "resource_key", "target").collect()] == [("a", 1, "x")]


def rows_of(found, columns):
    return sorted(tuple(str(r[columns.index(c)]) for c in sorted(columns)) for r in found)


def query_and_sql(spark, name, path):
    """Sorted rows of the query and of its SQL over documents."""
    got = QUERIES[name](spark, str(path))
    found = duckdb.connect().execute(f"WITH documents AS (SELECT * FROM '{path}/documents.parquet') {ORACLE_SQL[name].replace('WITH ', ', ', 1)}")
    return rows_of(got.collect(), got.columns), rows_of(found.fetchall(), [c[0] for c in found.description])


@pytest.fixture(scope="module")
def odd_documents(tmp_path_factory):
    """Few texts and keys, so that strings recur, have several targets, repeat their source or differ in placeholders; nulls everywhere."""
    rng, path = random.Random(7), tmp_path_factory.mktemp("odd")
    some = ["Open", "open", "", "Save %s", "Sichern %s", "Sichern %d", "%s %d", "%d %s", "<b>x</b>", "<i>x</i>", "\u00d6ffnen", None]
    rows = [(None if i % 50 == 0 else i, rng.choice(some[: 2 + i % 11]) if i % 9 else None, rng.choice(["en", "en", "de", "fr", None]), rng.choice([*map(str, range(40)), None])) for i in range(2000)]
    duckdb.connect().execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)").executemany("INSERT INTO d VALUES (?, ?, ?, ?)", rows).execute(f"COPY d TO '{path}/documents.parquet'")
    return path


@pytest.fixture(scope="module")
def large_keys(tmp_path_factory):
    """One key with 300 English and 300 German texts of 1 kB each, another with 300 English texts and a single German one."""
    rng, path = random.Random(8), tmp_path_factory.mktemp("large")
    rows = [(21 * i, "en" if i % 2 else "de") for i in range(600)] + [(21 * i + 1, "en" if i else "de") for i in range(301)]
    rows = [(i, f"{rng.getrandbits(4096):x}", lang, "o") for i, lang in rows]
    duckdb.connect().execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)").executemany("INSERT INTO d VALUES (?, ?, ?, ?)", rows).execute(f"COPY d TO '{path}/documents.parquet'")
    return path


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    return context.statusStore().executorSummary("driver").totalShuffleWrite()


@pytest.mark.parametrize("name", ["translated_strings", "unit_locales"])
def test_translations_of_odd_documents(spark, odd_documents, name):
    got, want = query_and_sql(spark, name, odd_documents)
    assert got == want and len(got) > 20


@pytest.mark.parametrize(("name", "n"), [("translated_strings", 300), ("unit_locales", 600)])
def test_translations_make_no_pairs(spark, large_keys, name, n):
    """With tables too large to be broadcast, as at size: what is shuffled grows with the texts, not with the pairs of a key (90,300, of 180 MB)."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled(spark)
        got = QUERIES[name](spark, str(large_keys)).collect()
        assert shuffled(spark) - before < 600_000  # the texts have 0.9 MB
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(got) == n


def test_translated(spark):
    """One text a locale for a string, over all its keys; the smallest key stays. A text that is null is no target, so its string is rejected."""
    rows = [
        ("o", 1, "a", "en", "Open"), ("o", 1, "a", "en", "Open"), ("o", 1, "a", "de", "Auf"), ("o", 1, "a", "de", "Auf"), ("o", 1, "a", "fr", "Ouvrir"), ("o", 1, "a", "fr", "Ouvert"), ("o", 0, "b", "en", "Open"), ("o", 0, "b", "de", "Auf"),
        ("o", 1, "c", "en", "Close"), ("o", 1, "c", "de", "Zu"), ("o", 2, "c", "en", "Close"), ("o", 2, "c", "de", "Schliessen"), ("o", 1, "d", "en", "OK"), ("o", 1, "d", "de", "OK"), ("o", 1, "e", "en", "No %s"), ("o", 1, "e", "de", "Kein %d"),
        ("o", 1, "f", "en", "Null"), ("o", 1, "f", "de", None), ("o", 1, "f", "fr", "Nul"), ("o", 2, "f", "en", "Null"), ("o", 2, "f", "de", "Null!"), ("o", 1, "g", "en", "Lost"), ("o", 1, "g", "de", "Fort"), ("p", 1, "a", "en", "Open"), ("p", 1, "x", "de", "Auf"),
    ]
    found = spark.createDataFrame([(o, t, t.lower()) for o in "op" for t in ("Open", "Close", "OK", "No %s", "Null", "Null")], "owner string, source string, key string")
    got = catalog.translated(spark.createDataFrame(rows, "owner string, resource_id int, resource_key string, locale string, text string"), found)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {tuple(r) for r in got.select("owner", "locale", "string_key", "target_sha256", "resource_key").collect()} == {("o", "de", "open", sha("Auf"), "a"), ("o", "fr", "null", sha("Nul"), "f")}


def test_release_choice(spark):
    rows = [("a", 0, "v1.0.0-beta", False, True), ("a", 1, "1.0.0", False, False), ("b", 0, "2.0.0", False, True), ("c", 0, "3.0.0", True, False)]
    rows += [("d", i, "x", False, True) for i in range(300)]
    got = registry.choose_release(spark.createDataFrame(rows, "r string, position int, tag string, draft boolean, prerelease boolean"), ["r"])
    assert {r.r: (r.tag, r.kind) for r in got.collect()} == {"a": ("1.0.0", "stable"), "b": ("2.0.0", "preview"), "c": (None, "none"), "d": (None, "search-limit")}


def test_components(spark):
    good, body = b'{"id":"p","name":"P","version":"1"}', b"x"
    rows = [("p", "manifest", good, len(good), hashlib.sha256(good).hexdigest()), ("p", "main", body, 2, ""), ("q", "main", body, 1, "0")]
    ok, bad = components.verified(spark.createDataFrame(rows, "plugin_id string, role string, content binary, size long, sha256 string"))
    assert {r.code for r in bad.collect()} == {"size-mismatch", "digest-mismatch"}
    assert [tuple(r) for r in components.manifests(ok).collect()] == [("p", "P", "1", None)]


def test_predicates(spark):
    def judged(column, *texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column(F.col("t")))
        return [r[1] for r in sorted(rows.collect())]

    assert judged(T.is_title_case, "Open file", "open", "A", "Open: x", "9Open", None) == [True, False, False, False, False, False]
    assert judged(T.is_repository_path, "a/b c.md", "../a", "a//b", "/a", "a\\b", "a\n", "", None) == [True] + 7 * [False]
    assert judged(lambda t: T.fits_locale(t, F.lit("en")), "abc", "\u0430\u0431\u0432 ab", "\u0430b\u00e9", "", None) == [True, False, True, True, None]
    assert judged(lambda t: T.git_blob_id(t.cast("binary")), "", "hello\n") == ["e69de29bb2d1d6434b8b29ae775ad8c2e48c5391", "ce013625030ba8dba906f756967f9e9ca394464a"]


def test_every_document_has_a_blob_id(spark, tmp_path):
    texts = ["", "hello\n", "\u00e9 \u0431", "\U0001F600", "\x00 a", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.blob for r in QUERIES["blob_ids"](spark, str(tmp_path)).collect()}
    blob = lambda b: hashlib.sha1(b"blob %d\0" % len(b) + b).hexdigest()
    assert got == {i: None if t is None else blob(t.encode()) for i, t in enumerate(texts)}


def test_canonical_json(spark):
    assert T.canonical('{ "b": [1, null, true], "a": "\u00e9\u0001" }') is None  # a raw control character
    assert T.canonical('{ "b": [1, null, true], "a": "\u00e9\\u001F" }') == '{"a":"\u00e9\\u001f","b":[1,null,true]}'
    assert T.canonical('{"\U0001F600": 1, "\uff5e": 2}') == '{"\U0001F600":1,"\uff5e":2}'  # by UTF-16 units
    for bad in ("", "{", '{"a":1,"a":2}', "1.5", "NaN", "9007199254740992", '"\\ud800"', "[" * 100_000):
        assert T.canonical(bad) is None, bad
    rows = spark.createDataFrame([(None,), ("[1, 2]",)], "t string").select(T.canonical_json("t"))
    assert {r[0] for r in rows.collect()} == {None, "[1,2]"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_match_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    found = db.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(tuple(map(str, r)) for r in got.select(*columns).collect()) == want


def test_a_missing_library_of_the_subpackage_leaves_the_other_queries(tmp_path):
    """The entry is imported by a fresh interpreter in which a library that only uiloom.llm needs can't be imported."""
    code = "import sys; sys.modules['ahocorasick'] = None\nimport __spark_entry__ as e\nn = e.queries()\nassert 'extract_ui_calls' in n and not any(q.startswith('op') or q == 'pipeline' for q in n) and set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=True, timeout=120)


def test_normal_text(spark):
    values = [" a\t\n", "\x1ca\x1f", "\u00a0e\u0301 ", "", " ", None, "plain", "\u200ba"]
    got = [r.n for r in spark.createDataFrame([(v,) for v in values], "v string").select(T.norm_text("v").alias("n")).collect()]
    assert got == [v if v is None else unicodedata.normalize("NFC", v).strip() for v in values]
