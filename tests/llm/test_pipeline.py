"""The stages of the pipeline against brute force, on a table with null and repeated ids, null texts and columns named like the operators' own."""

import collections
import hashlib
import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
from uiloom.llm import pii  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    roots = {"en": ["tha", "ing", "ent", "wor"], "de": ["ück", "sch", "eit", "ung"]}
    text = lambda k: " ".join("".join(rng.choices(roots[k], k=3)) for _ in range(60))
    rows = [(i, text(k), k) for i, k in enumerate(["en", "de"] * 30)]
    rows += [(100, rows[0][1], "en"), (101, rows[1][1] + " more", "de"), (None, rows[2][1], "en"), (None, text("en"), "en")]
    rows += [(7, text("de"), "de"), (200, None, "en"), (201, "12 34 !", "en"), (202, text("en") + " mail a.b@cd.ef now", "en")]
    at = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(i, t, k, "s", len(t or ""), 7.5, "mine") for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long, rate double, row string")
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, docs


def test_stages(spark, folder):
    at, docs = folder
    kept = pipeline.keep_identified(spark, docs, at)
    rows = kept.collect()
    assert kept.columns == docs.columns and len(rows) == 66 and not [r for r in rows if r.doc_id in (200, 201)]
    left = pipeline.drop_near_duplicates(spark, kept, at)
    own = lambda t: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(max(1, len(w) - 4))}
    order = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = [r for i, r in enumerate(order) if not any(len(own(r.text) & own(q.text)) >= 0.8 * len(own(r.text) | own(q.text)) for q in order[:i])]
    assert left.columns == docs.columns and collections.Counter(left.collect()) == collections.Counter(want) and len(want) == 63
    masked = pipeline.mask_personal_data(spark, left, at).collect()
    by = {(r.doc_id, r.rate): r.text for r in masked if r.doc_id == 202}
    assert len(masked) == 63 and all("<EMAIL>" in t and "a.b@" not in t for t in by.values()) and all(r.n_chars == len(r.text) for r in masked)
    assert sum(r.text == q.text for r, q in zip(sorted(masked, key=str), sorted(want, key=str), strict=True)) >= 62 - sum(bool(pii.find_spans(r.text)) for r in want)
    mixed = pipeline.mix_domains(spark, left, at)
    assert mixed.columns == docs.columns and {r.rate for r in mixed.collect()} <= {7.5} and set(mixed.collect()) <= set(want)
    coded = pipeline.tokenize(spark, left, at).collect()
    assert collections.Counter(r.decoded_sha256 for r in coded) == collections.Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in want)


def test_run(spark, folder):
    at, docs = folder
    out = pipeline.run(spark, at)
    assert set(out.columns) == {"doc_id", "ids", "n_tokens", "decoded_sha256"} and out.count() > 0
    empty = docs.limit(0)
    assert pipeline.drop_near_duplicates(spark, pipeline.keep_identified(spark, empty, at), at).isEmpty()
