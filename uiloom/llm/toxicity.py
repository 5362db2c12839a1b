"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled, so token labels are made from them by cross-fitting: a bounded sample of the labelled
documents is cut in two halves, and a token of a toxic document is labelled toxic if in the other half its word, or
its first letters, are far more frequent in toxic documents (log odds of document counts of at least TOXIC_ODDS).
The field has two states and its own features: word, first letters, last letters and shape of a token, of which those are kept that
stand at toxic tokens more often than not in the segments it learns from. The weights of the features, the bias and the transitions are learned by gradient ascent on the
likelihood of the labelled tokens, then a logistic model maps the largest marginal and the expected number of toxic tokens to a document score.

Marginals come from the forward-backward recursion. Between tokens with features the recursion is a power of
one matrix, so it is exact while its cost depends on the tokens with features alone.

Training uses about SAMPLE labelled documents of each class, drawn by a hash of the id before any text is read, and
at most SEGMENTS segments of SEGMENT tokens with and as many without toxic tokens, by a hash of the segment. Documents of any length take part.

Edge cases: null and empty texts have no tokens and get the score of a document without features; very long texts are scored whole.
With labels of one class only, every score is that class's share, smoothed ((n1 + 0.5) / (n + 1)); without labelled rows every score is 0.
Labels other than 0 and 1 teach nothing. Repeated rows get equal scores. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import draw, in_scratch, stage

SAMPLE, SEGMENT, SEGMENTS, ROUNDS = 8_000, 64, 1_500, 60
TOXIC_ODDS, LEAST_DOCS = 3.0, 2
TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
KEEP_WORDS = 300_000


def features(word: str) -> list[str]:
    """What token labels are made from: a word and its first letters."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def shape(word: str) -> str:
    return "".join("A" if c.isupper() else "a" for c in word[:1] + word[-1:]) + (">" if len(word) > 8 else "")


def own_features(word: str) -> list[str]:
    """What the field sees of a token."""
    low = word.lower()
    return [*features(low), "*" + low[-3:], "*" + low[-4:], "/" + shape(word)]


@dataclass
class Field:
    """weights: of features; bias: of the toxic state; stay: transition scores; document: the logistic model; prior: the score where nothing was learned."""

    weights: dict[str, float]
    bias: float = -4.0
    stay: tuple[float, float] = (0.0, 0.0)  # for two ordinary tokens, for two toxic tokens, in a row
    document: tuple[float, float, float] = (-4.0, 0.7, 1.0)
    prior: float | None = None
    seen: dict[str, float] = field(default_factory=dict)

    def evidence(self, word: str) -> float:
        """The sum of the weights of a word's features, 0 if it has none."""
        found = self.seen.get(word)
        if found is None:
            found = sum(self.weights.get(f, 0.0) for f in own_features(word))
            if len(self.seen) >= KEEP_WORDS:
                self.seen.clear()
            self.seen[word] = found
        return found

    def tokens(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; places and evidence of those with evidence."""
        words = TOKEN.findall(text)
        seen, slow = self.seen.get, self.evidence
        values = np.fromiter(((slow(w) if (v := seen(w)) is None else v) for w in words), float, len(words))
        at = np.flatnonzero(values)
        return len(words), at, values[at]

    def marginals(self, n: int, at: np.ndarray, evidence: np.ndarray) -> list[float]:
        """Probability of `toxic` for each token with evidence, by forward-backward."""
        a, d = math.exp(self.stay[0]), math.exp(self.stay[1])
        neutral = math.exp(self.bias)
        # one neutral step: transition, then the token's score
        m = np.array([[a, neutral], [1.0, neutral * d]])
        values, vectors = np.linalg.eig(m)
        order = np.argsort(-values.real)
        values, vectors = values.real[order], vectors.real[:, order]
        inverse = np.linalg.inv(vectors)
        main, rest = (np.outer(vectors[:, i], inverse[i]) for i in (0, 1))
        ratio = values[1] / values[0]

        def gap(k: int) -> tuple[float, float, float, float]:
            x = main + ratio**k * rest if k else np.eye(2)
            return float(x[0, 0]), float(x[0, 1]), float(x[1, 0]), float(x[1, 1])

        # gaps[i]: neutral tokens before the i-th token with evidence; the last one: after all
        ends = [-1, *at.tolist(), n]
        gaps = [gap(ends[i + 1] - ends[i] - 1 - (i == 0 and ends[1] > 0)) for i in range(len(ends) - 1)]
        scores = [math.exp(min(30.0, self.bias + e)) for e in evidence.tolist()]
        forward: list[tuple[float, float]] = []
        x, y = 1.0, neutral
        for i, s in enumerate(scores):
            g = gaps[i]
            if i == 0 and ends[1] == 0:
                x, y = 1.0, s
            else:
                x, y = x * g[0] + y * g[2], x * g[1] + y * g[3]
                x, y = x * a + y, (x + y * d) * s
            x, y = x / (x + y), y / (x + y)
            forward.append((x, y))
        out = [0.0] * len(scores)
        u, v = 1.0, 1.0
        for i in range(len(scores) - 1, -1, -1):
            g = gaps[i + 1]
            u, v = g[0] * u + g[1] * v, g[2] * u + g[3] * v
            x, y = forward[i]
            out[i] = y * v / (x * u + y * v)
            s = scores[i]
            u, v = a * u + s * v, u + d * s * v
            u, v = u / (u + v), v / (u + v)
        return out

    def summary(self, text: str | None) -> tuple[float, float, np.ndarray, list[float]]:
        """Largest marginal, expected toxic tokens with evidence, places and marginals of the tokens with evidence."""
        n, at, evidence = self.tokens(text or "")
        if not len(at):
            return 0.0, 0.0, at, []
        own = self.marginals(n, at, evidence)
        return max(own), sum(own), at, own

    def score(self, top: float, expected: float) -> float:
        if self.prior is not None:
            return self.prior
        c, s, e = self.document
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, c + s * logit(top) + e * math.log1p(expected)))))


def logit(p: float) -> float:
    p = min(1 - 1e-6, max(1e-6, p))
    return math.log(p / (1 - p))


def train_chain(own: Field, segments: list[tuple[list[str], list[int]]]) -> None:
    """Gradient ascent with adapted steps on the log likelihood of the labels of segments (words, labels), all at once."""
    if not segments:
        return
    longest = max(len(w) for w, _ in segments)
    y, mask = np.zeros((len(segments), longest)), np.zeros((len(segments), longest))
    at: list[int] = []
    names: list[str] = []
    for i, (found, labels) in enumerate(segments):
        y[i, : len(found)], mask[i, : len(found)] = labels, 1
        for t, word in enumerate(found):
            own_ones = own_features(word)
            names += own_ones
            at += [i * longest + t] * len(own_ones)
    kinds, which = np.unique(np.array(names), return_inverse=True)
    places = np.array(at)
    toxic, every = np.bincount(which, y.ravel()[places], len(kinds)), np.bincount(which, minlength=len(kinds))
    kept = (2 * toxic > every) & (toxic >= LEAST_DOCS)
    number = np.cumsum(kept) - 1
    used = kept[which]
    which, places, kinds = number[which[used]], places[used], kinds[kept]
    pairs = mask[:, 1:]
    n = len(kinds)
    # bias, stay of ordinary tokens, stay of toxic tokens, then the features
    theta = np.concatenate(([own.bias, *own.stay], np.full(n, 1.0)))
    seen = np.concatenate(([(y * mask).sum(), ((1 - y[:, 1:]) * (1 - y[:, :-1]) * pairs).sum(), (y[:, 1:] * y[:, :-1] * pairs).sum()], np.bincount(which, y.ravel()[places], n)))
    squares = np.full(len(theta), 1e-8)
    for _ in range(ROUNDS):
        e = np.bincount(places, theta[3:][which], y.size).reshape(y.shape)
        score = np.stack((np.zeros_like(e), theta[0] + e), -1)
        score = np.where(mask[..., None] > 0, np.exp(score - score.max(-1, keepdims=True)), 1.0)
        step = np.exp(np.array([[theta[1], 0.0], [0.0, theta[2]]]))
        forward = np.empty_like(score)
        forward[:, 0] = score[:, 0] / score[:, 0].sum(-1, keepdims=True)
        for t in range(1, longest):
            x = forward[:, t - 1] @ step * score[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, x / x.sum(-1, keepdims=True), forward[:, t - 1])
        back = np.ones((len(segments), 2))
        marginal, want = np.zeros_like(y), np.zeros(len(theta))
        for t in range(longest - 1, -1, -1):
            p = forward[:, t] * back
            marginal[:, t] = p[:, 1] / p.sum(-1) * mask[:, t]
            if t:
                both = forward[:, t - 1, :, None] * step * (score[:, t] * back)[:, None, :]
                both /= both.sum((1, 2), keepdims=True)
                want[1] += (both[:, 0, 0] * mask[:, t]).sum()
                want[2] += (both[:, 1, 1] * mask[:, t]).sum()
                x = (score[:, t] * back) @ step.T
                back = np.where(mask[:, t, None] > 0, x / x.sum(-1, keepdims=True), back)
        want[0] = marginal.sum()
        want[3:] = np.bincount(which, marginal.ravel()[places], n)
        slope = seen - want - 0.05 * theta * np.concatenate(([0.0], np.ones(len(theta) - 1)))
        squares += slope * slope
        theta = theta + 0.4 * slope / np.sqrt(squares)
    own.bias, own.stay = float(theta[0]), (float(theta[1]), float(theta[2]))
    own.weights = dict(zip(kinds.tolist(), theta[3:].tolist(), strict=True))


def train_document(own: Field, rows: list[tuple[float, float, int]]) -> None:
    """Logistic regression by Newton steps; rows: largest marginal, expected tokens, label."""
    x = np.array([[1.0, logit(top), math.log1p(expected)] for top, expected, _ in rows])
    y = np.array([label for _, _, label in rows], float)
    w = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(3)
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
    own.document = tuple(map(float, w))


def toxic_words(drawn: DataFrame) -> list[dict[str, float]]:
    """For each half of the drawn documents, the features (of the label rule) whose log odds reach TOXIC_ODDS, and these."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = sorted({f for w in set(TOKEN.findall(text.as_py().lower())) for f in features(w)}) + [""]
                yield pa.RecordBatch.from_arrays([pa.array([half] * len(own), pa.int32()), pa.array([toxic] * len(own), pa.int32()), pa.array(own, pa.string())], names=["half", "toxic", "feature"])

    seen = drawn.select("half", "toxic", "text").mapInArrow(distinct, "half int, toxic int, feature string")
    counted = stage(seen.groupBy("half", "feature").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).where("bad > 0"), "counted")
    totals = counted.where("feature = ''").select("half", F.col("bad").alias("all_bad"), F.col("n").alias("every"))
    odds = F.log((F.col("bad") + 0.5) / (F.col("all_bad") + 1.0)) - F.log((F.col("n") - F.col("bad") + 0.5) / (F.col("every") - F.col("all_bad") + 1.0))
    kept = counted.where((F.col("feature") != "") & (F.col("bad") >= LEAST_DOCS)).join(F.broadcast(totals), "half").withColumn("odds", odds)
    out: list[dict[str, float]] = [{}, {}]
    for r in kept.where(F.col("odds") >= TOXIC_ODDS).select("half", "feature", "odds").collect():  # features of drawn documents
        out[r["half"]][r["feature"]] = r["odds"]
    return out


def labelled_segments(drawn: DataFrame, known: list[dict[str, float]]) -> list[tuple[list[str], list[int]]]:
    """At most SEGMENTS segments (words, labels) with and as many without toxic tokens."""
    shared = drawn.sparkSession.sparkContext.broadcast(known)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                other = shared.value[1 - half]
                found = TOKEN.findall(text.as_py())
                rows = []
                for i in range(0, len(found), SEGMENT):
                    part = found[i : i + SEGMENT]
                    labels = [int(bool(toxic) and any(f in other for f in features(w.lower()))) for w in part]
                    rows.append((int(any(labels)), xxhash64_of(part), part, labels))
                if rows:
                    kinds = (pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["some", "order", "words", "labels"])

    rows = stage(drawn.select("half", "toxic", "text").mapInArrow(cut, "some int, order long, words array<string>, labels array<int>"), "segments")
    out = []
    for some in (0, 1):
        out += [(r["words"], r["labels"]) for r in rows.where(F.col("some") == some).orderBy("order").limit(SEGMENTS).collect()]
    return out


def xxhash64_of(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words)) >> 1


def summaries(drawn: DataFrame, own: Field) -> list[tuple[float, float, int]]:
    """Largest marginal, expected toxic tokens and label of each drawn document."""
    shared = drawn.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.summary(text.as_py())[:2] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(0)], names=["top", "expected", "toxic"])

    rows = drawn.select("toxic", "text").mapInArrow(run, "top double, expected double, toxic int").collect()
    return [(r["top"], r["expected"], r["toxic"]) for r in rows]


@in_scratch
def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Learn from the documents that have a row (id, toxic) in labels. To the driver come numbers and features of the drawn documents only."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    zeros, ones = totals.get(0, 0), totals.get(1, 0)
    constant = Field({}, prior=(ones + 0.5) / (ones + zeros + 1) if ones + zeros else 0.0)
    if not zeros or not ones:
        return constant
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE / ones)).otherwise(min(1.0, SAMPLE / zeros))
    some = known.where(draw("id", "toxic") < share).withColumn("half", (draw("id", F.lit("half")) < 0.5).cast("int"))
    # about 2 SAMPLE rows of three numbers
    drawn = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(stage(some, "drawn")), "id")
    drawn = stage(drawn.select("half", "toxic", "text"), "labelled")
    own = Field({})
    train_chain(own, labelled_segments(drawn, toxic_words(drawn)))
    rows = summaries(drawn, own)
    if len({r[2] for r in rows}) < 2:
        return constant
    train_document(own, rows)
    own.seen.clear()
    return own


def score(df: DataFrame, own: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and the offending spans (start, stop, marginal) in code points."""
    shared = df.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(1):
                text = value.as_py()
                top, expected, at, own_marginals = crf.summary(text)
                scores.append(crf.score(top, expected))
                found = []
                if top >= 0.5:
                    wanted = {int(i): m for i, m in zip(at, own_marginals, strict=True) if m >= 0.5}
                    found = [{"start": m.start(), "stop": m.end(), "marginal": wanted[i]} for i, m in enumerate(TOKEN.finditer(text)) if i in wanted]
                spans.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    source = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, score double, spans array<struct<start:int,stop:int,marginal:double>>")
