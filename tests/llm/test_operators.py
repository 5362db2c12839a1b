"""The operators against brute force, on small tables with nulls, empty texts, repeated rows and further columns."""

import base64
import collections
import hashlib
import random
import re
import warnings

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from uiloom.llm import bpe, common, components, jaccard, langid, mixing, neighbours, outliers, phrases, pii, sharding, toxicity

VOCABULARY = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [" ".join(rng.choices(VOCABULARY, k=rng.randint(1, 120))) for _ in range(60)]
    passage = " ".join(rng.choices(VOCABULARY, k=50))
    out = [None, "", " \t\n", "one", "one", "A b\x0bc"]
    for t in base:
        words = t.split()
        words[rng.randrange(len(words))] = "edit"
        out += [t, " ".join(words), t.upper() if rng.random() < 0.3 else t + " " + passage]
    return out + [base[0]] * 5 + [passage * 1 + " x", "z " + passage, " ".join(["la"] * 90), "same line\n" * 30]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "src", len(t or ""), "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, node int")


def test_phrases(spark, docs, texts):
    words = [(t or "").encode().split() for t in texts]
    count = collections.Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    got = {r.doc_id: r for r in phrases.digest(phrases.remove_recurring(docs, window=35)).collect()}
    for i, w in enumerate(words):
        gone = {k for s in range(len(w) - 34) if count[tuple(w[s : s + 35])] > 1 for k in range(s, s + 35)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())


def test_jaccard(spark, docs, texts):
    def own(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()

    sets, root = [own(t) for t in texts], list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 85 * len(a | b) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(docs, size=4, percent=85).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("limits", [{}, {"leaf": 4, "hard": 6}])
def test_jaccard_pairs(spark, docs, texts, limits):
    def own(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()

    sets = [own(t) for t in texts]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    near = lambda a, b: a and b and 100 * len(a & b) >= 70 * len(a | b)
    links = {(min(first[a], first[b]), max(first[a], first[b]), len(a & b), len(a | b)) for a in first for b in first if a != b and near(a, b)}
    found, members = jaccard.pairs(docs, size=4, percent=70, **limits)
    assert sorted(tuple(r) for r in found.collect()) == sorted(links) and links
    got = {r.doc_id: (r.n_shingles, r.class_id, r.n_links) for r in members.collect()}
    assert got == {i: (len(s), first[s] if s else None, sum(bool(near(s, o)) for k, o in enumerate(sets) if k != i)) for i, s in enumerate(sets)}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(hash((i, 1)), hash((i + 1, 1))) for i in range(60)], "a long, b long")
    assert len({r.label for r in components.components(links).collect()}) == 1


def test_bpe(spark, docs, texts):
    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bpe.digests(docs, path, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    for t in ("a" * 9000, "ab" * 5000, "é\U0001f680 x\n\n  1"):
        assert np.frombuffer(bpe.Encoder(ranks, P.PATTERN).encode(t), "<u4").tolist() == enc.encode_ordinary(t)


def test_bpe_batches_are_bounded(spark, docs, texts, monkeypatch):
    """A batch of any number of rows leaves in parts of at most GROUP_CHARS characters, longer texts alone."""
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    monkeypatch.setattr(bpe, "GROUP_CHARS", 1000)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = bpe.encode_decode(docs, path, P.PATTERN)
    rows = [*texts, "é\U0001f680 long " * 300, None, *texts, "ab " * 900]
    batches = [pa.RecordBatch.from_pydict({"id": pa.array(range(a, b), pa.int64()), "text": pa.array(rows[a:b], pa.string())}) for a, b in ((0, 0), (0, 150), (150, len(rows)))]
    out = [b.to_pylist() for b in run(iter(batches))]
    assert [r["id"] for part in out for r in part] == [*range(len(rows))]
    assert all(len(part) == 1 or sum(len(rows[r["id"]] or "") for r in part) <= 1000 for part in out) and len(out) > 20
    for r in (r for part in out for r in part):
        text = rows[r["id"]] or ""
        assert r["ids"] == enc.encode_ordinary(text) and r["decoded"] == text.encode()


def test_pii(spark):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("1 -.+@a(5.9@-c") for _ in range(rng.randint(0, 60)))
        want = []
        for order, (kind, pattern) in enumerate(patterns.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                ok = kind == "email" or kind == "ip" and max(map(int, m.group().split("."))) < 256 or kind == "card" and 12 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15
                want += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}")] * ok
        assert pii.joined([s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]) == ",".join(w for *_, w in sorted(want))
    rows = spark.createDataFrame([(1, "bank GB82 WEST 1234 5698 7654 32, mail a@b.co", 7), (2, None, 7), (3, "", 7)], "doc_id long, text string, id int")
    masked = {r.doc_id: r.text for r in pii.mask_column(rows).collect()}
    assert masked == {1: "bank <IBAN>, mail <EMAIL>", 2: None, 3: ""}


def test_statistics(spark, docs, texts):
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        count = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        repeated = {j for k in range(len(w) - 7) if count[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w)) and (not r.kept or not r.base_failed)


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(60, 200))), "en", "s") for i in range(200)]
    rows += [(1000, " ".join("w1$$$###" + str(i) for i in range(100)), "en", "s")]
    kept = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[1000] and sum(kept.values()) >= 196


def test_copies_of_an_outlier_hide_no_outliers(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(60, 200))), "en", "s") for i in range(200)]
    junk = [" ".join(mark + str(i) for i in range(n)) for mark, n in (("w1$$$###", 100), ("##|", 90), ("$%<>w", 140), ("<|&*>x", 70))]
    rows += [(1000 + i, t, "en", "s") for i, t in enumerate(junk)]
    # copies of one are a third of the group
    rows += [(2000 + i, junk[0], "en", "s") for i in range(100)]
    kept = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i in kept if i >= 1000) and sum(kept.values()) >= 196


def test_small_groups_get_a_verdict(spark):
    rng = random.Random(7)
    text = lambda: " ".join(rng.choices(VOCABULARY, k=rng.randint(60, 200)))
    junk = " ".join("w1$$$###" + str(i) for i in range(100))
    # a large group, a small one of the same language, a small language, and groups without language or source
    groups = [("en", "s", 120), ("en", "rare", 12), ("xx", "s", 8), (None, "s", 5), ("en", None, 1), (None, None, 1)]
    rows = [(100 * g + i, text(), lang, source) for g, (lang, source, n) in enumerate(groups) for i in range(n)]
    rows += [(10_000 + g, junk, lang, source) for g, (lang, source, _) in enumerate(groups)]
    schema = "doc_id long, text string, lang string, source string"
    for some in (rows, [r for r in rows if r[2] == "xx"]):
        judged = outliers.judge(spark.createDataFrame(some, schema)).collect()
        assert len(judged) == len(some) and all(r.far is not None and r.kept == (r.doc_id < 10_000) for r in judged)


def test_language(spark):
    rng = random.Random(2)
    roots = {"aa": ["tha", "ing", "ent"], "bb": ["ücht", "schö", "eit"]}
    rows = [(i, " ".join("".join(rng.choices(roots[k], k=2)) for _ in range(20)), k) for i, k in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 !", "aa"), (902, "thaing", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, langid.fit(df.where("doc_id % 3 <> 1"), "lang", "text", "doc_id")).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows) and got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "aa"
    assert langid.identify(df, langid.fit(df.limit(0), "lang", "text", "doc_id")).where("lang_pred <> 'und'").isEmpty()


def test_toxicity(spark):
    rng = random.Random(4)
    rows = [(i, " ".join([*rng.choices(VOCABULARY, k=30), *(["vilest", "vilely"] if i % 3 == 0 else [])]), int(i % 3 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    own = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame([(1, "w1 w2 vilest w3 vilely"), (2, "w1 w2 w3"), (3, None)], "doc_id long, text string"), own).collect()}
    assert got[1].score > 0.9 and got[2].score < 0.1 and got[3].score < 0.1 and [(s.start, s.stop) for s in got[1].spans] == [(6, 12), (16, 22)]
    # sparse forward-backward equals the plain recursion
    crf = toxicity.Field({}, bias=-1.0, stay=(0.5, 0.7))
    e = np.array([0, 0, 1.6, 0, 2.4, 0, 0])
    u = np.exp(np.stack((np.zeros(7), crf.bias + e), 1))
    m = np.exp(np.array([[0.5, 0], [0, 0.7]]))
    f, b = [u[0]], [np.ones(2)]
    for t in range(1, 7):
        f.append(f[-1] @ m * u[t])
    for t in range(6, 0, -1):
        b.insert(0, m @ (u[t] * b[0]))
    p = [f[t] * b[t] / (f[t] @ b[t]) for t in range(7)]
    assert np.allclose(crf.marginals(7, np.array([2, 4]), np.array([1.6, 2.4])), [p[2][1], p[4][1]])


def test_sharding(spark, docs):
    rows = docs.select("doc_id", "text").union(docs.select(F.lit(3), F.lit("one")).limit(40))
    got = sharding.number_slots(sharding.shard_records(rows, "doc_id", [1.0] * 5, grown_weight=1.0), ["doc_id", "text"]).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(got) == rows.count()
    many = sharding.shard_records(spark.range(4000).withColumnRenamed("id", "doc_id"), "doc_id", [3.0, 1.0]).groupBy("shard").count().collect()
    assert 2800 < {r.shard: r["count"] for r in many}[0] < 3200


def test_mixing(spark):
    rng = random.Random(6)
    kinds = {"a": VOCABULARY[:40], "b": VOCABULARY[200:240]}
    rows = [(i, k, " ".join(rng.choices(kinds[k], k=50))) for i in range(120) for k in ("a" if i % 4 else "b",)]
    df = spark.createDataFrame([(i, t) for i, _, t in rows] + [(900, None), (901, "")], "doc_id long, text string")
    numbered = [(n, k, t) for n, (_, k, t) in enumerate(rows)]
    taught = mixing.labelled_words(spark.createDataFrame(numbered, "doc_id long, domain string, text string"), spark.createDataFrame([r[:2] for r in numbered], "doc_id long, domain string"))
    mixed = mixing.mix(df, taught, {"a": 0.5, "b": 0.5}).collect()
    total = sum(r.n_tokens for r in mixed)
    assert len(mixed) == 122 and all(r.rate >= 0 for r in mixed)
    for k in kinds:
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in mixed) / total - 0.5) < 1e-3


def shares_of(cells, rate, k):
    row = cells.select("n", *(f"q{i}" for i in range(k)), rate.alias("r")).agg(*(F.sum(F.col("r") * F.col("n") * F.col(f"q{i}")).alias(f"s{i}") for i in range(k)), F.sum("n").alias("t"), F.min("r").alias("least")).first()
    assert row.least >= 0
    return [row[f"s{i}"] / row.t for i in range(k)]


@pytest.mark.parametrize("targets", [(0.6, 0.35, 0.05), (0.05, 0.05, 0.9), (0.9, 0.05, 0.05), (0.3, 0.3, 0.2)])
def test_mixing_reaches_its_targets(spark, targets):
    """Three domains, 82, 9 and 9 % of the tokens, with posteriors that are mostly mixed."""
    rng = np.random.default_rng(1)
    sharp = rng.dirichlet((8.2, 0.9, 0.9), 3000) ** 1.5
    pure = [(50.0, 0.97, 0.02, 0.01), (5.0, 0.02, 0.96, 0.02), (5.0, 0.02, 0.02, 0.96)]
    rows = [(float(n), *map(float, q / q.sum())) for n, q in zip(rng.integers(1, 400, 3000), sharp, strict=True)] + pure
    cells = spark.createDataFrame(rows, "n double, q0 double, q1 double, q2 double").coalesce(2)
    with warnings.catch_warnings():
        warnings.simplefilter("error", mixing.Unreachable)
        warnings.simplefilter("error", mixing.Unfinished)
        rate = mixing.fit(cells, ["a", "b", "c"], list(targets))
    assert np.allclose(shares_of(cells, rate, 3), targets, atol=1e-6)


def test_mixing_tells_unreachable_targets(spark):
    cells = spark.createDataFrame([(10.0, 0.8, 0.2), (5.0, 0.6, 0.4)], "n double, q0 double, q1 double")
    with pytest.warns(mixing.Unreachable):
        rate = mixing.fit(cells, ["a", "b"], [0.1, 0.9])
    # the least squares: along the second cell alone, nearest to (0.1, 0.9)
    assert np.allclose(shares_of(cells, rate, 2), np.array([0.6, 0.4]) * (0.6 * 0.1 + 0.4 * 0.9) / (0.6**2 + 0.4**2), atol=1e-4)


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype("f4")
    x[100:140] = x[0]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + [(9000, None, 0), (9100, [0.0] * 8, 0), (9200, [float("nan")] * 8, 0), (9300, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    got = neighbours.search(df, F.col("vec_id") % 100 == 0, "vec_id", "embedding", 10).collect()
    own = collections.defaultdict(dict)
    for r in got:
        own[r.query_id][r.rank] = r.vec_id
    hits = 0
    for q in range(0, 600, 100):
        d = np.sqrt(((x.astype("f8") - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        hits += len(set(want) & set(own[q].values()))
        assert sorted(own[q]) == list(range(1, 11))
    assert len(own) == 6 and hits >= 54
    assert neighbours.search(df.where("vec_id < 0"), F.col("vec_id") % 100 == 0, "vec_id", "embedding", 10).isEmpty()


def test_empty_tables(spark, docs):
    none = docs.where("doc_id < 0")
    assert jaccard.link(none, size=4, percent=85).isEmpty()
    assert phrases.remove_recurring(none, window=35).isEmpty()
    assert outliers.judge(none).isEmpty()
    assert toxicity.score(none, toxicity.fit(none, none.select("doc_id", F.lit(1).alias("toxic")))).isEmpty()
    assert mixing.mix(none, mixing.labelled_words(none, none.select("doc_id", F.lit("a").alias("domain"))), {"a": 1.0}).isEmpty()
    assert langid.identify(none, langid.fit(none, "lang", "text", "doc_id")).isEmpty()
    assert bpe.digests(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).isEmpty() and pii.summarise(none).isEmpty()
    assert sharding.shard_records(none, "doc_id", [1.0] * 3).isEmpty()


def test_jaccard_splits_and_blocks(spark):
    """Near copies that link and that don't, with leaves so small that regions are split by pivots and dealt into blocks; null and repeated ids."""
    rng = random.Random(8)
    out, passage = [None, "", "one"], rng.choices(VOCABULARY, k=40)
    for size, copies in ((12, 5), (60, 40), (150, 30)):
        base = rng.choices(VOCABULARY, k=size)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(w + passage if rng.random() < 0.3 else w))
    out += [" ".join(rng.choices(VOCABULARY, k=20) + passage) for _ in range(30)]
    sets = [{tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if (w := (t or "").split()) else set() for t in out]
    root = list(range(len(out)))
    for _ in range(8):
        for i, a in enumerate(sets):
            for j in range(i):
                if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    df = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link(df, size=4, percent=85, leaf=6, hard=20).collect()}
    assert got == dict(enumerate(root))
    some = spark.createDataFrame([(None, out[60]), (7, out[60]), (None, "x y"), (None, "x y"), (7, "a b c d e f")], "doc_id long, text string")
    rows = [(r.doc_id, r.component_id) for r in jaccard.link(some, size=4, percent=85).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, [(None, 7), (7, 7), (None, None), (None, None), (7, 7)]))
    left = jaccard.first_of_components(some.withColumn("node", F.lit("mine")), size=4, percent=85)
    assert left.columns == ["doc_id", "text", "node"] and left.count() == 3


@pytest.mark.parametrize("blocks", [1, 1 << 14])
def test_likely_and_without_are_whole(spark, monkeypatch, blocks):
    """Also if the filter is far too small for its values: then it tells less, and rows stay right."""
    monkeypatch.setattr(common, "MOST_BLOCKS", blocks)
    df, some = spark.range(20000).withColumn("name", F.lit("x")), spark.range(0, 20000, 7)
    found = {r.id for r in common.likely(df, some, "id").collect()}
    assert found >= set(range(0, 20000, 7)) and (blocks == 1 or len(found) < 4000)
    assert sorted(r.id for r in common.without(df, some, "id").collect()) == [i for i in range(20000) if i % 7]
    assert common.likely(df, some.limit(0), "id").isEmpty() and common.without(df, some.limit(0), "id").count() == 20000
    assert common.without(df, df, "id").isEmpty() and common.without(df, df, "id").columns == df.columns


def test_jaccard_shuffles_the_texts_it_needs(spark):
    """With tables too large to be broadcast, as at size: a few copies among many texts take only their own texts, sets and prefixes through a shuffle."""

    def shuffled():
        context = spark.sparkContext._jsc.sc()
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorSummary("driver").totalShuffleWrite()

    rng = random.Random(5)
    out = [" ".join(f"{rng.getrandbits(48):x}" for _ in range(400)) for _ in range(300)]
    out += [out[3], out[4], out[5] + " more"]
    df = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with common.scratch(spark):
            base = common.stage(jaccard.summaries(df, "doc_id", "text", 5, 80), "prefixes")
            before = shuffled()
            nodes, keys = jaccard.distinct_sets(base)
            rows = nodes.collect()
            assert {r.node for r in rows} == {r.node for r in keys.collect()} and len(rows) == 301 and all(len(r.first) == 80 for r in rows)
            assert shuffled() - before < 60_000  # the prefixes have 0.2 MB
            before = shuffled()
            wanted = common.stage(base.where(F.col("row.doc_id").isin(7, 8)).select("node", "key"), "ends")
            assert {len(r.own) // 8 for r in jaccard.sets_of(base, wanted, "text", 5).collect()} == {396}
            assert shuffled() - before < 200_000
            left = jaccard.first_of_components(df, size=5, percent=80)
            before = shuffled()
            kept = sorted(r.doc_id for r in left.collect())
            assert kept == list(range(300)) and shuffled() - before < 200_000  # the texts have 1.5 MB, most of it random
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_phrases_over_several_shards(spark, docs, texts):
    """Small shards and portions give the same rows; without the automata nothing is removed."""
    want = phrases.digest(phrases.remove_recurring(docs, window=35)).collect()
    assert sorted(want) == sorted(phrases.digest(phrases.remove_recurring(docs, window=35, shard_words=60, doc_chars=900)).collect())
    assert any(r.n_removed for r in want)
    found, phrases.locate = phrases.locate, lambda sent: found(sent).where("kind = 0")
    try:
        assert phrases.remove_recurring(docs, window=35).where("n_removed > 0").isEmpty()
    finally:
        phrases.locate = found


def test_one_class_of_labels(spark):
    df = spark.createDataFrame([(i, f"w{i} x", 1) for i in range(9)], "doc_id long, text string, toxic int")
    for value in (0, 1):
        own = toxicity.fit(df, df.select("doc_id", F.lit(value).alias("toxic")))
        assert {r.score >= 0.5 for r in toxicity.score(df, own).collect()} == {value == 1}


def test_many_domains_and_languages(spark):
    rng = random.Random(9)
    rows = [(i, f"d{i % 16}", " ".join(rng.choices(VOCABULARY[25 * (i % 16) : 25 * (i % 16) + 25], k=30))) for i in range(320)]
    df = spark.createDataFrame(rows, "doc_id long, domain string, text string")
    targets = {f"d{k}": 1 + k / 16 for k in range(16)}
    mixed = mixing.mix(df.select("doc_id", "text"), mixing.labelled_words(df, df), targets).collect()
    total = sum(r.n_tokens for r in mixed)
    for k, weight in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in mixed) / total - weight / sum(targets.values())) < 1e-2
    many = spark.createDataFrame([(i, f"l{i:04}", "".join(rng.choices("abcdefghij", k=30))) for i in range(600)], "doc_id long, lang string, text string")
    assert langid.identify(many, langid.fit(many, "lang", "text", "doc_id")).where("lang_pred = lang").count() >= 500
    same = spark.createDataFrame([(i, "aa", "the same words") for i in range(9000)] + [(9999, "bb", "quite other things")], "doc_id long, lang string, text string")
    assert langid.identify(same, langid.fit(same, "lang", "text", "doc_id")).where("lang_pred <> lang OR score < 0.9").isEmpty()


def test_smallest_determinant(spark):
    """Against all halves of a small group."""
    import itertools

    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(size=(8, 5)), 9 + rng.normal(size=(5, 5))))
    rows = spark.createDataFrame([(i, "en", "s", *map(float, r)) for i, r in enumerate(x)], f"doc_id long, lang string, source string, {', '.join(f'{c} double' for c in outliers.FEATURES)}")
    own = outliers.robust(rows).where("level = 2").first()
    floors = np.diag(outliers.FLOORS)
    det = lambda i: np.linalg.det(outliers.CONSISTENCY * np.cov(x[list(i)].T, bias=True) + floors)
    best = min(itertools.combinations(range(13), 7), key=det)
    assert np.allclose([own[f"m{i}"] for i in range(5)], x[list(best)].mean(0)) and np.isclose(own.spread, np.log(det(best)))


def test_written_shards(spark, tmp_path):
    rows = sharding.shard_records(spark.range(200).withColumnRenamed("id", "doc_id"), "doc_id", [1.0, 3.0])
    sharding.write_shards(rows, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()} and back.where("shard = 1").count() > back.where("shard = 0").count() > 0
