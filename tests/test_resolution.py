import hashlib
import json
import re

from pyspark.sql import functions as F

from uiloom.operators import resolution

SHA = "a" * 40
CLAIMS = "registry_key string, site string, authority_digest string, profile_digest string, extra int"
PROFILES = "registry_key string, authority_digest string, profile_digest string, repository_id long, owner_id long, default_branch string, max_bytes long"
REPOSITORIES = """repository_id long, owner_id long, default_branch string, archived boolean, disabled boolean, commit_date string, commit_sha string, tree_sha string,
 release_id long, release_tag string, release_commit_sha string, release_tree_sha string"""
ASSETS = "release_id long, name string, asset_id long, state string, size long, sha256 string"


def test_web_resolutions(spark):
    name = ".canonical-source-catalog.json"
    profiles = spark.createDataFrame([(f"r{i}", "A", "P", i, 7, "main", 100) for i in range(12)] + [("r99", "A", "P", None, 7, "main", 100)], PROFILES)
    sound = [7, "main", False, False, "2024-05-06T07:08:09Z", SHA, SHA, 5, "v1", SHA, SHA]
    change = {2: (0, 8), 3: (2, None), 4: (4, "2024-05-06T07:08:09"), 5: (6, "b"), 6: (8, None), 7: (10, "X"), 8: (1, "dev")}
    rows = [(i, *(change[i][1] if i in change and change[i][0] == k else v for k, v in enumerate(sound))) for i in range(10)] + [(9, *sound)]
    repositories = spark.createDataFrame(rows, REPOSITORIES)
    digest = hashlib.sha256(b"x").hexdigest()
    assets = spark.createDataFrame(
        [(5, "one" + name, 11, "uploaded", 100, digest), (5, "two" + name, 12, "uploaded", 5, digest), (5, "two" + name, 13, "uploaded", 5, digest), (5, "big" + name, 14, "uploaded", 101, digest),
         (5, "half" + name, 15, "starter", 5, digest), (5, "bare" + name, 16, "uploaded", 5, None), (6, "other" + name, 17, "uploaded", 5, digest), (None, "none" + name, 18, "uploaded", 5, digest)], ASSETS
    )
    want = {
        (0, "one"): "present", (0, "two"): "absent", (0, "gone"): "absent", (0, "other"): "absent", (0, "none"): "absent", (0, "big"): "asset-invalid", (0, "half"): "asset-invalid", (0, "bare"): "asset-invalid",
        (0, "One"): "profile-changed", (0, None): "profile-changed", (0, "a" * 65): "profile-changed", (0, "a\n"): "profile-changed", (1, "one"): "present", (2, "one"): "repository-invalid", (3, "one"): "repository-invalid",
        (4, "one"): "commit-invalid", (5, "one"): "commit-invalid", (6, "one"): "release-invalid", (7, "one"): "release-commit-invalid", (8, "one"): "repository-invalid", (9, "one"): "repository-invalid",
        (10, "one"): "repository-invalid", (50, "one"): "profile-changed", (99, "one"): "profile-changed",
    }
    claims = spark.createDataFrame([(f"r{r}", s, "A", "P", 1) for r, s in want] + [("r0", "one", "A", "old", 2), ("r0", "one", None, "P", 3), ("r0", "one", "A", "P", 1)], CLAIMS)
    got = resolution.web_resolutions(claims, profiles, repositories, assets).collect()
    assert len(got) == len(want) + 3
    assert {(int(r.registry_key[1:]), r.site): r.state for r in got if r.extra == 1} == want
    assert {r.state for r in got if r.extra > 1} == {"profile-changed"}
    canonical = lambda v: hashlib.sha256(json.dumps(v, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    one = next(r for r in got if r.registry_key == "r1" and r.state == "present")
    assert one.content_digest == canonical({"repositoryId": 1, "commitSha": SHA})
    assert one.entry_digest == canonical({"siteKey": "one", "assetDigest": digest, "releaseId": 5})
    assert (one.asset_id, one["size"], one.release_tag, one.revision) == (11, 100, "v1", 1714979289 * 1_000_000 + 0xAAAAA)
    assert all(r.entry_digest is None and r.asset_id is None for r in got if r.state != "present")
    assert all((r.content_digest is None) == (r.state not in ("present", "absent")) for r in got)
    assert resolution.web_resolutions(claims.limit(0), profiles, repositories, assets).isEmpty()


def test_normal_resources(spark):
    rows = [("a", None, "EN", 1), ("a", "default", "fr", 2), ("a", "x", "en", 3), ("b", None, "en", 4), ("b", "default", "EN", 5), ("c", "x", "no tag", 6), ("c", "y", "en", 7),
            ("d", "x", "zh", 8), ("d", "x", "zh-cn", 9), ("e", "x", None, 1), (None, "x", "en", 2), ("f", "x", "pt-br", 3)]
    kept, refused = resolution.normal_resources(spark.createDataFrame(rows, "owner string, resource_id string, locale string, n int"))
    assert {(r.owner, r.resource_id, r.locale, r.n) for r in kept.collect()} == {("a", "default", "en", 1), ("a", "default", "fr", 2), ("a", "x", "en", 3), (None, "x", "en", 2), ("f", "x", "pt-BR", 3)}
    assert {tuple(r) for r in refused.collect()} == {("b", "resource-repeated"), ("c", "locale-invalid"), ("d", "resource-repeated"), ("e", "locale-invalid")}


def test_english_schemas(spark):
    texts = {
        "few": ["ein Text hier"] * 4, "edge": ["Open a pane"] * 4 + ["kein Wort"], "below": ["Open a pane"] * 7 + ["kein Wort"] * 2, "short": ["the", "of it", None, "kein Wort", ""] * 3,
        "parts": ["reopening", "éto vu", "to_do list2", "TO BE", "übers.the"] * 2, "other": ["Alle Wörter"] * 9,
    }
    got = resolution.english_schemas(spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "id string, text string"), ["id"])
    word = re.compile(rf"\b(?:{resolution.ENGLISH_WORDS})\b", re.IGNORECASE)
    for r in got.collect():
        samples = [t for t in texts[r.id] if t and len(t) > 5]
        hits = sum(1 for t in samples if word.search(t))
        assert (r.n, r.hits, r.english) == (len(samples), hits, len(samples) < 5 or hits / len(samples) >= 0.8), r
    assert got.where(F.col("english")).select("id").distinct().count() == 3


def test_directories(spark):
    def blob(text):
        return hashlib.sha1(b"blob %d\0" % len(text.encode()) + text.encode()).hexdigest()

    good = json.dumps([{"id": "b", "repo": "o/b", "z": {"k": [1, "é"]}, "a": True}, {"repo": "o/a", "id": "a"}, {"id": "half", "repo": "o/half", "n": 0.5}], ensure_ascii=False)
    bodies = {name: good for name in ("good", "dated", "link", "long", "short", "other", "gone", "cut", "twice")} | {
        "empty": "[]", "map": "{}", "broken": "[{]", "repeated": '[{"id":"a","id":"a","repo":"o/a"}]', "number": '[{"id":5,"repo":"o/a"}]', "text": '["a"]', "again": '[{"id":"a","repo":"o/a"},{"id":"a","repo":"o/b"}]',
    }
    tree = {d: hashlib.sha1(d.encode()).hexdigest() for d in bodies}
    commits = [(d, "2024-05-06T07:08:09" if d == "dated" else "2024-05-06T07:08:09Z", SHA, tree[d]) for d in bodies]
    trees = [
        (tree[d], d == "cut", "p.json", "blob", "120000" if d == "link" else "100644", blob(b + "x" if d == "other" else b), len(b.encode()) + (d == "short") + (d == "long") * 1000) for d, b in bodies.items() if d != "gone"
    ] + [(tree["twice"], False, "p.json", "blob", "100644", SHA, 5), (tree["good"], False, "q.json", "blob", "100644", SHA, 5)]
    snapshots, entries, refused = resolution.directory_snapshots(
        spark.createDataFrame(commits, "directory string, commit_date string, commit_sha string, tree_sha string"),
        spark.createDataFrame(trees, "tree_sha string, truncated boolean, path string, type string, mode string, sha string, size long"),
        spark.createDataFrame([*bodies.items()], "directory string, body string"), "p.json", 900,
    )
    assert {r.directory for r in snapshots.collect()} == {"good", "empty"}
    assert {tuple(r) for r in refused.collect()} == {
        ("dated", "commit-invalid"), ("link", "no-plain-file"), ("long", "size-invalid"), ("short", "size-mismatch"), ("other", "revision-mismatch"), ("gone", "missing"), ("twice", "repeated"), ("cut", "tree-truncated"),
        ("map", "content-invalid"), ("broken", "content-invalid"), ("repeated", "content-invalid"), ("number", "entry-invalid"), ("text", "entry-invalid"), ("again", "id-repeated"),
    }
    asked = [("good", "a"), ("good", "b"), ("good", "b"), ("good", "c"), ("good", "half"), ("good", None), ("empty", "a"), ("again", "a"), ("unknown", "a"), (None, "a")]
    got = resolution.directory_claims(spark.createDataFrame(asked, "directory string, id string"), snapshots, entries).collect()
    assert sorted((str(r.directory), str(r.id), r.state, r.repo) for r in got) == sorted([
        ("good", "a", "present", "o/a"), ("good", "b", "present", "o/b"), ("good", "b", "present", "o/b"), ("good", "c", "absent", None), ("good", "half", "refused", None), ("good", "None", "absent", None),
        ("empty", "a", "absent", None), ("again", "a", "refused", None), ("unknown", "a", "refused", None), ("None", "a", "refused", None),
    ])
    one = next(r for r in got if r.id == "b")
    assert one.entry_digest == hashlib.sha256(json.dumps(json.loads(good)[0], sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert (one.content_digest, one.registry_revision) == (hashlib.sha256(good.encode()).hexdigest(), 1714979289 * 1_000_000 + 0xAAAAA)
    assert all((r.content_digest is None) == (r.state == "refused") and (r.entry_digest is None) == (r.state != "present") for r in got)
