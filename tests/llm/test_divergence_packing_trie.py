"""Operators 11 to 13 against brute force, with small limits so that every path is taken, and the SQL against the queries' own rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from uiloom.llm import divergence, packing, trie
from uiloom.llm.common import Scratch, scratch

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audit_by_hand(rows, least, top):
    docs = [(a or "", b or "", TERM.findall(lower(t or ""))) for t, a, b in rows]
    held, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, source, terms in docs:
        counts[lang, source].update(terms)
        held.update((lang, t) for t in set(terms))
    out = set()
    for lang in {d[0] for d in docs}:
        kept = sorted((t for (a, t), n in held.items() if a == lang and n >= least), key=str.encode)
        own = {s: [counts[a, s][t] for t in kept] for a, s in counts if a == lang}
        whole = [sum(c) for c in zip(*own.values(), strict=True)]
        weigh = lambda c: [1 + 10**9 * (n + 5) // (sum(c) + 5 * len(kept)) for n in c]
        p, q = {s: weigh(c) for s, c in own.items()}, weigh(whole)
        for s in own:
            pairs = [(sum(abs(x - y) for x, y in zip(p[s], p[o], strict=True)), o) for o in own if o != s]
            terms = [(x - y, t) for x, y, t, n in zip(p[s], q, kept, own[s], strict=True) if n and x > y]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("light", [0, 2, 5, 100])
def test_divergence(spark, monkeypatch, light):
    monkeypatch.setattr(divergence, "LIGHT", light)
    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "FLUSH", 50)
    rng = random.Random(3)
    words = ["Ärger", "ärger", "été", "x", "X", "don't", "a1b", "naïve", "ΩZ"] + [f"{a}{b}" for a in "abcd" for b in "wxyz"]
    rows = [(" ".join(rng.choices(words[i % 5 :: 2] if i % 3 else words, k=rng.randint(0, 12))), f"l{i % 2}", f"s{i % 7}") for i in range(160)]
    rows += [("rare1 rare2", "l1", "s1")] * 4 + [("rare1", "l1", "s2"), ("", "l0", "empty"), (None, "l1", None), ("a b", None, "s1"), (None, None, None), ("123 \n", "l2", "s1"), ("", "l2", "s2")]
    rows += [("hot " * 3000 + "é" * 5000, "l0", "s3")] * 5
    df = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "text string, lang string, source string, term int, value string, n int")
    got = {tuple(r) for r in divergence.audit(df, least=4, top=5).collect()}
    assert got == audit_by_hand(rows, 4, 5)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(df).columns == ["lang", "source", "part", "item", "value", "rank"] and divergence.audit(df).count() == 0


def test_divergence_is_exact_for_huge_counts(spark):
    row = spark.sql("SELECT 999999999999999999L AS n, 1000000000000000007L AS total, 3L AS kept").select(divergence.weight(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()
    assert row.p == 1 + 10**9 * (999999999999999999 + 5) // (1000000000000000007 + 15)


PACK_TEXTS = [None, "", " \t\n", "one", "one", "A b\x0bc", "x" * 3000, "<|endoftext|> and <|endoftext", "日本語 текст été 🙂́", "12345 " * 700, "la " * 5000, "don't  stop\n\n\n now  "]


@pytest.mark.parametrize("longest", [1024, 8, 1])
def test_packing(spark, longest):
    rng = random.Random(2)
    texts = PACK_TEXTS + [" ".join(rng.choices(["alpha", "Beta", "γάμμα", "9", "..."], k=rng.randint(1, 300))) for _ in range(20)]
    df = spark.createDataFrame([(None if i == 3 else i // 2, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, length int, part string").repartition(3)
    rows = packing.pack(df, P.path("byte_bpe_50k.json"), P.PATTERN, longest).collect()
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in enumerate(texts):
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        start = 0
        while start < len(ids):
            length = min(longest, 1 << ((len(ids) - start).bit_length() - 1))
            packed = np.array(ids[start : start + length], "<u4").tobytes()
            want[None if i == 3 else i // 2, start, length, packed, zlib.crc32(packed), len(ids)] += 1
            start += length
    assert collections.Counter((r.id, r.start, r.length, bytes(r.ids), r.ids_crc32, r.doc_tokens) for r in rows) == want
    by_id = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in by_id] == list(range(len(rows)))
    assert [r.length for r in by_id] == sorted(r.length for r in rows)


def test_packing_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(df, P.path("byte_bpe_50k.json"), P.PATTERN, 1000)


def trie_by_hand(rows):
    """Nodes by all prefixes of all rebuilt conversations."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(t[1], t[3]) for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, own_members in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own_members) - 1) * (len(p[-1][1]) if p else 0)
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks():
    rng = random.Random(4)
    turns = [("user", "hi"), ("assistant", "hello 🙂"), ("user", "hi "), ("system", ""), (None, "hi"), ("", None), ("user", "long " * 500), ("1:", "a"), ("1", ":a")]
    rows = []
    for c in [*range(0, 140), 200, 205, 299, -3, -100, 10**15 + 7]:
        if c == 100:
            continue  # no first conversation for its family
        n = rng.choice([1, 1, 2, 3, 5, 8])
        rows += [(c, t, *(turns[0] if rng.random() < 0.5 else rng.choice(turns))) for t in range(n)]
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1100) for t in range(8)]  # copies
    rows += [(7, None, "user", "null turn"), (7, None, "user", "null turn"), (8, 0, "a", "tie"), (8, 0, "b", "tie"), (8, 0, "a", "tied"), (None, 0, "user", "nobody"), (205, 3, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("local", "chunk"), [(2000, 4096), (1, 3), (6, 1), (40, 7)])
def test_trie(spark, monkeypatch, local, chunk):
    monkeypatch.setattr(trie, "LOCAL", local)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = talks()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, ids int")
    got = [tuple(r) for r in trie.build(df).collect()]
    assert len(got) == len(set(got)) and set(got) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert trie.build(spark.createDataFrame([], kind)).count() == 0
    taken = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6]  # no conversation 100: their only turn goes
    got = trie.build(spark.createDataFrame([(c, 0, "user", "x") for c in taken], kind)).collect()
    ends = hashlib.sha256(",".join(map(str, taken)).encode()).hexdigest()
    assert [tuple(r) for r in got] == [(taken[0], 0, None, len(taken), 0, 1, 0, ends)]


def test_nothing_staged_is_left(spark):
    df = spark.createDataFrame([(1, "a b", "l", "s")], "doc_id long, text string, lang string, source string")
    own = Scratch(spark)
    with scratch(spark) as held:
        divergence.audit(df).collect()
        packing.pack(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
        paths = list(held.paths)
    exists = lambda path: (at := own.jvm.org.apache.hadoop.fs.Path(path)).getFileSystem(own.hadoop).exists(at)
    assert paths and not any(map(exists, paths))
