"""Every registered query on a small folder: names, types, rows, and what their contracts derive from ids; predictions, mixing and bids against brute force."""

import collections
import math
import random
import warnings
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from uiloom.llm import langid, mixing, sharding
from uiloom.llm.common import Scratch, scratch
from uiloom.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_nearest_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_mixing": "doc_id bigint, n_tokens bigint, p_good double, p_plain double, p_toxic double, rate double",
    "op7_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op9_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op11_divergence_audit": "lang string, source string, part string, item string, value bigint, rank int",
    "op12_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op13_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, at = random.Random(8), str(tmp_path_factory.mktemp("tables"))
    words = {"en": "the of and house river stone walk light green paper".split(), "de": "der und straße über mädchen haus licht grün weg stein".split()}
    rows = []
    for i in range(120):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randint(5, 90))) + (" vile horrid" if i % 10 == 1 else ""), lang, f"src{i % 3}", 1))
    rows += [(None, "no id here at all", "en", None, 1), (200, None, None, "src1", 0), (201, "", "en", "src1", 0), (5, rows[5][1], "en", "src2", 1), (5, rows[5][1], "en", "src2", 1), (202, "paper " * 60_000 + "end", "en", "src0", 1), (203, "x" * 200_000, "en", "src0", 1)]
    spark.createDataFrame([(*r, "extra", 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, shard int").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), int(i % 10 == 1)) for i in range(0, 120)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)] + [(500, None), (501, [0.0] * 8), (None, [1.0] * 8)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    talk = [(c, t, "user", rng.choice(["hi", "yes", f"t{c}"])) for c in range(100, 130) for t in range(c % 4 + 1)]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at, rows


def crc(key):
    return zlib.crc32(("" if key is None else str(key)).encode())


def exists(store, path):
    at = store.jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(store.hadoop).exists(at)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(spark, folder, name):
    at, rows = folder
    with warnings.catch_warnings(), scratch(spark) as held:
        warnings.simplefilter("ignore", mixing.Unreachable)
        result = QUERIES[name](spark, at)
        kinds = dict(result.dtypes)
        wanted = [tuple(c.split()) for c in COLUMNS[name].split(", ")]
        assert [(n, kinds.get(n)) for n, _ in wanted] == wanted and (name not in ORACLE_SQL or len(kinds) == len(wanted))
        got = result.collect()
        left = [*held.paths]
    # around a query and its reading, nothing that it staged is left
    assert not [p for p in left if exists(Scratch(spark), p)]
    if name not in ("op3_nearest_neighbours", "op11_divergence_audit", "op12_packing", "op13_prefix_trie"):
        assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    if "held_out" in kinds:
        modulus, rest = (5, 0) if name == "op2_toxicity" else (3, 1)
        assert all(r.held_out == (crc(r.doc_id) % modulus == rest) and 0 <= r.score <= 1 for r in got)
    if name == "op2_toxicity":
        assert all(r.predicted == (r.score >= 0.5) for r in got)
    if name == "op5_language_id":
        assert all((r.lang_pred == "und") == (r.doc_id in (200, 201)) for r in got)
        assert np.mean([r.lang_pred == dict((x[0], x[2]) for x in rows)[r.doc_id] for r in got if r.held_out and r.doc_id is not None and r.doc_id < 120]) > 0.95
    if name == "op12_packing":
        assert sorted(r.sequence_id for r in got) == list(range(len(got))) and all(r.length & (r.length - 1) == 0 and r.length <= 1024 for r in got)
    if name == "op3_nearest_neighbours":
        assert collections.Counter(r.query_id for r in got) == {i: 10 for i in (0, 100, 200, 300)}


def test_language_by_hand(spark):
    """Corrected counts of n-grams in whole sets, where the filters have false positives only."""
    rng = random.Random(3)
    words = {"aa": ["bala", "koma", "tiru", "sela"], "bb": ["bala", "xyzz", "qwer", "mnop"], "cc": ["жук", "дом", "река", "лес"]}
    rows = [(i, " ".join(rng.choices(words[k], k=12)), k) for i in range(90) for k in [sorted(words)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.fit(df.where("doc_id < 60"), "lang", "text", "doc_id")
    taught = {k: set() for k in words}
    docs = collections.defaultdict(collections.Counter)
    cut = lambda t: [g for h in langid.grams(t) for g in h.tolist()]
    for _, t, k in rows[:60]:
        docs[k].update(set(cut(t)))
    for k in words:
        taught[k] = {g for g, n in docs[k].items() if n >= 1}
    for r in langid.identify(df.where("doc_id >= 60"), filters).collect():
        own = cut(r.text)
        shares = {k: sum(g in taught[k] for g in own) / len(own) for k in words}
        assert r.lang_pred == max(sorted(shares), key=shares.get) == r.lang and abs(r.score - shares[r.lang]) < 0.02


def test_mixing_by_hand(spark):
    """Posteriors of the words' counts, and rates that are the projection of one number for each domain."""
    rng = random.Random(5)
    kinds = {"a": [f"a{i}" for i in range(20)], "b": [f"b{i}" for i in range(20)], "c": [f"c{i}" for i in range(20)]}
    rows = [(i, k, " ".join(rng.choices(kinds[k] + kinds["abc"[(i + 1) % 3]][:3], k=rng.randint(10, 60)))) for i in range(240) for k in ("a" if i % 8 else "b" if i % 16 else "c",)]
    df = spark.createDataFrame(rows, "doc_id long, domain string, text string")
    mixed = mixing.mix(df.select("doc_id", "text"), mixing.labelled_words(df, df), {"a": 2.0, "b": 1.0, "c": 1.0}).collect()
    total = sum(r.n_tokens for r in mixed)
    for k, share in (("a", 0.5), ("b", 0.25), ("c", 0.25)):
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in mixed) / total - share) < 1e-4
    assert all(r.rate >= 0 and abs(r.p_a + r.p_b + r.p_c - 1) < 1e-9 for r in mixed)
    by_id = {r.doc_id: r for r in mixed}
    assert np.mean([max("abc", key=lambda k: by_id[i][f"p_{k}"]) == d for i, d, _ in rows]) > 0.95


def test_bids_by_hand(spark):
    """xxHash64 of the key and, seeded by it, of the shard; the highest bid wins."""
    weights = [1.0, 2.0, 0.5, 1.0]
    df = spark.createDataFrame([(i,) for i in [*range(300), -5, 10**15]] + [(None,)], "doc_id long")
    hashed = lambda value, seed, size: xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), seed)

    def winner(key, own):
        seed = 42 if key is None else hashed(key, 42, 8)
        bids = []
        for shard, w in enumerate(own):
            u = ((hashed(shard, seed, 4) >> 11) + 0.5) / 2**53
            bids.append((-w / math.log(u), -shard))
        return -max(bids)[1]

    got = sharding.shard_records(df, "doc_id", weights, grown_weight=1.5).collect()
    assert all((r.shard, r.grown_shard) == (winner(r.doc_id, weights), winner(r.doc_id, [*weights, 1.5])) for r in got)
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    assert sharding.number_slots(sharding.shard_records(df, "doc_id", weights), ["doc_id"]).groupBy("shard").agg(F.max("slot") - F.count("*") + 1).agg(F.max("((max(slot) - count(1)) + 1)")).first()[0] == 0
