"""Mixing sources to target weights, in DataFrame operations only.

A classifier learned from a labelled table gives every document a soft membership: posterior
probabilities of the domains. Document rates r >= 0 are then fitted so that the expected tokens of
each domain, sum of r * tokens * posterior, match its target share of all tokens.

Classifier: multinomial naive Bayes over BUCKETS hashed words, learned from about SAMPLE labelled
documents, drawn by a hash of the id before any text is read. Words of a text depend on each other, so their mean evidence counts as
that of a number of words at most; which number of EVIDENCE, is chosen by the log loss on a fifth of the sample that the counts don't see.

Fit: least squares by projected gradient steps from r = 1: of all rates that meet the targets, those nearest to 1 (where none do,
those that miss by least, as far as RIDGE tells). Documents of one cell
of a grid of posteriors share a rate; a cell's tokens and expected tokens are sums over all of its
documents, so the totals are exact. The projection is lazy: steps add up in one number b_k for each domain, and
a rate is the projection max(0, 1 - sum of b_k * p_k) of where they lead. A step is the gradient, preconditioned by the normal matrix of the cells whose
rate is positive, at the best of the WIDTHS. Gradient, matrix and widths are Spark aggregations of a few sums over the cells. The fit ends when the gradient
vanishes; then a miss of more than NEAR means that no rates reach the targets (warning Unreachable, other than Unfinished).
The grid is as fine as MAX_CELLS allows; with very many domains a cell is the likeliest domain.

Edge cases: a null or empty text has no tokens, the prior as posterior and the rate of its cell. Very long texts are read whole. Without
labelled rows all domains are equally likely. Repeated rows get equal rates; an empty table
gives an empty result. Further columns are kept; columns `n_tokens`, `p_<domain>`, `rate` and those that start with `_mix` are replaced.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import draw, outer, scratch, stage, words

SAMPLE, BUCKETS, GRID, MAX_CELLS = 20_000, 4096, 24, 200_000
EVIDENCE = (5, 10, 20, 40, 80, 1_000_000_000)
STEPS, TOLERANCE, RIDGE, NEAR = 100, 1e-9, 1e-12, 1e-5
WIDTHS = tuple(0.5**i for i in range(12))


def buckets(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def numbers(values: list[float]) -> Column:
    """An array literal; Catalyst folds it to one constant."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def gathered(values: list[float], of: str) -> Column:
    """The sum of the values of a document's buckets."""
    table = numbers(values)
    return F.aggregate(of, F.lit(0.0), lambda total, b: total + F.element_at(table, b + 1))


def labelled_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """domain and words (as buckets) of about SAMPLE documents that have a row (id, domain) in labels."""
    known = labels.select(F.col(id_col).alias("id"), "domain").where("id IS NOT NULL AND domain IS NOT NULL")
    share = min(1.0, SAMPLE / max(1, known.count()))
    some = stage(known.where(draw("id") <= share), "drawn")  # about SAMPLE rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id")
    return stage(texts.select("domain", buckets(F.col("text")).alias("b"), (draw("id", F.lit("held")) < 0.2).alias("held")), "labelled")


def counted(drawn: DataFrame, domains: list[str]) -> tuple[list[float], list[list[float]]]:
    """Log priors, and for each domain the log probabilities of the buckets. BUCKETS numbers for each domain reach the driver."""
    docs = {r["domain"]: r["count"] for r in drawn.groupBy("domain").count().collect()}
    counts = {name: [1.0] * BUCKETS for name in domains}
    for r in drawn.select("domain", F.explode("b").alias("b")).groupBy("domain", "b").count().collect():
        counts[r["domain"]][r["b"]] += r["count"]
    prior = [math.log((docs.get(name, 0) + 1) / (sum(docs.values()) + len(domains))) for name in domains]
    return prior, [[math.log(c / sum(counts[name])) for c in counts[name]] for name in domains]


def learn(drawn: DataFrame, domains: list[str]) -> tuple[list[float], list[list[float]], int]:
    """Log priors, log probabilities of the buckets, and the words' evidence that fits held-out documents best."""
    drawn = drawn.where(F.col("domain").isin(domains))
    prior, weights = counted(drawn.where("NOT held"), domains)
    held = drawn.where("held").withColumn("n", F.size("b"))
    k = range(len(domains))
    means = [gathered(weights[i], "b") / F.greatest("n", F.lit(1)) for i in k]
    held = held.withColumns({f"m{i}": m for i, m in enumerate(means)})
    losses = []
    for j, most in enumerate(EVIDENCE):
        scores = [prior[i] + F.col(f"m{i}") * F.least("n", F.lit(most)) for i in k]
        top = F.greatest(*scores) if len(domains) > 1 else scores[0]
        whole = top + F.log(sum((F.exp(x - top) for x in scores), F.lit(0.0)))
        own = sum((F.when(F.col("domain") == name, scores[i]).otherwise(0.0) for i, name in enumerate(domains)), F.lit(0.0))
        losses.append(F.avg(whole - own).alias(f"l{j}"))
    row = held.agg(*losses).first()
    best = min(range(len(EVIDENCE)), key=lambda j: (row[f"l{j}"] if row[f"l{j}"] is not None else 0.0, j))
    return *counted(drawn, domains), EVIDENCE[best]


def memberships(df: DataFrame, text_col: str, domains: list[str], prior: list[float], weights: list[list[float]], most: int) -> DataFrame:
    """df with n_tokens and the posteriors p_<domain>."""
    out = df.withColumn("_mix_b", buckets(F.col(text_col))).withColumn("n_tokens", F.size("_mix_b").cast("long"))
    scores = [F.lit(0.0)]
    for k in range(1, len(domains)):  # log odds against the first domain
        evidence = gathered([w - v for w, v in zip(weights[k], weights[0], strict=True)], "_mix_b")
        out = out.withColumn(f"_mix_s{k}", prior[k] - prior[0] + evidence / F.greatest("n_tokens", F.lit(1)) * F.least("n_tokens", F.lit(most)))
        scores.append(F.col(f"_mix_s{k}"))
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    out = out.withColumns({f"_mix_e{k}": F.exp(s - top) for k, s in enumerate(scores)})
    whole = sum((F.col(f"_mix_e{k}") for k in range(1, len(domains))), F.col("_mix_e0"))
    out = out.withColumns({f"p_{name}": F.col(f"_mix_e{k}") / whole for k, name in enumerate(domains)})
    return out.drop("_mix_b", *(f"_mix_s{k}" for k in range(1, len(domains))), *(f"_mix_e{k}" for k in range(len(domains))))


def cell(domains: list[str]) -> Column:
    """The cell of the grid that holds a document's posterior; there are at most MAX_CELLS, or as many as domains."""
    grid = max((g for g in range(1, GRID + 1) if (g + 1) ** (len(domains) - 1) <= MAX_CELLS), default=0)
    if grid:
        return sum((F.round(F.col(f"p_{name}") * grid).cast("long") * (grid + 1) ** k for k, name in enumerate(domains[1:])), F.lit(0).cast("long"))
    largest = F.array_max(F.array(*(F.struct(F.col(f"p_{name}"), F.lit(-k)) for k, name in enumerate(domains))))
    return (-largest["col2"]).cast("long")


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """A small linear system, by elimination with pivots."""
    n = len(right)
    rows = [[*row, right[i]] for i, row in enumerate(matrix)]
    for i in range(n):
        best = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for k in range(n):
            if k != i and rows[i][i]:
                factor = rows[k][i] / rows[i][i]
                rows[k] = [x - factor * y for x, y in zip(rows[k], rows[i], strict=True)]
    return [row[n] / row[i] if row[i] else 0.0 for i, row in enumerate(rows)]


class Unreachable(UserWarning):
    """No rates give the targets; the fitted ones are the least squares."""


class Unfinished(UserWarning):
    """The fit ended at STEPS, before its gradient vanished."""


def fit(cells: DataFrame, domains: list[str], shares: list[float]) -> Column:
    """The rate as an expression over the cells' mean posteriors q0, q1, ..; cells: tokens n and q of each."""
    total = cells.agg(F.sum("n")).first()[0] or 0.0
    if not total:
        return F.lit(1.0)
    k, weight = range(len(domains)), F.col("n") / total

    def rate(b: list[float]) -> Column:
        return F.greatest(F.lit(0.0), 1.0 - sum((F.lit(float(x)) * F.col(f"q{i}") for i, x in enumerate(b)), F.lit(0.0)))

    def slope(b: list[float]) -> tuple[list[float], list[float], list[list[float]]]:
        """Errors of the shares, gradient, and the normal matrix of the cells whose rate is positive."""
        r = rate(b)
        sums = [F.sum(r * weight * F.col(f"q{i}")).alias(f"s{i}") for i in k]
        sums += [F.sum(F.when(r > 0, weight * F.col(f"q{i}") * F.col(f"q{j}")).otherwise(0.0)).alias(f"g{i}_{j}") for i in k for j in k if i <= j]
        row = cells.agg(*sums).first()
        error = [row[f"s{i}"] - shares[i] for i in k]
        return error, [e - RIDGE * x for e, x in zip(error, b, strict=True)], [[row[f"g{min(i, j)}_{max(i, j)}"] + RIDGE * (i == j) for j in k] for i in k]

    b = [0.0 for _ in k]
    error, down, matrix = slope(b)
    for _ in range(STEPS):
        if math.hypot(*down) < max(TOLERANCE, NEAR * math.hypot(*error)):  # small, or small beside an error that stays
            break
        step = solve(matrix, down)
        tried = [[x + w * y for x, y in zip(b, step, strict=True)] for w in WIDTHS]
        values = cells.agg(*(F.sum(weight * rate(t) * rate(t)).alias(f"v{i}") for i, t in enumerate(tried))).first()
        cost = [values[f"v{i}"] / 2 + sum(x * s + RIDGE / 2 * x * x for x, s in zip(t, shares, strict=True)) for i, t in enumerate(tried)]
        close = min(cost) + 1e-14 * (1 + abs(min(cost)))  # what rounding can't tell apart
        b = next(t for t, c in zip(tried, cost, strict=True) if c <= close)
        error, down, matrix = slope(b)
    else:
        warnings.warn(f"the fit isn't finished after {STEPS} steps", Unfinished, stacklevel=3)
    off = math.hypot(*error)
    if off > NEAR:
        warnings.warn(f"no rates meet the targets; at the least squares the shares are off by {off:.2g}", Unreachable, stacklevel=3)
    return rate(b)


def mix(df: DataFrame, drawn: DataFrame, targets: dict[str, float], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """df (or its columns `carry`) with n_tokens, p_<domain> and rate. drawn: what labelled_words gives; targets: share of all tokens by domain."""
    domains, whole = list(targets), sum(targets.values())
    with scratch(df.sparkSession):
        return _mix(df, drawn, domains, [w / whole for w in targets.values()], text_col, carry)


def _mix(df: DataFrame, drawn: DataFrame, domains: list[str], shares: list[float], text_col: str, carry: list[str] | None) -> DataFrame:
    member = memberships(df.drop("rate"), text_col, domains, *learn(drawn, domains)).withColumn("_mix_cell", cell(domains))
    if carry is not None:
        member = member.select(*carry, "n_tokens", *(f"p_{name}" for name in domains), "_mix_cell")
    member = stage(member, "members", owner=outer())
    sums = [F.sum(F.col("n_tokens") * F.col(f"p_{name}")).alias(f"m{i}") for i, name in enumerate(domains)]
    grouped = member.groupBy("_mix_cell").agg(F.sum("n_tokens").cast("double").alias("n"), *sums, *(F.avg(f"p_{name}").alias(f"a{i}") for i, name in enumerate(domains)))
    means = [F.when(F.col("n") > 0, F.col(f"m{i}") / F.col("n")).otherwise(F.col(f"a{i}")).alias(f"q{i}") for i in range(len(domains))]
    cells = stage(grouped.select("_mix_cell", "n", *means), "cells", owner=outer())
    rates = cells.select("_mix_cell", fit(cells, domains, shares).alias("rate"))
    # MAX_CELLS rows at most
    return member.join(F.broadcast(rates), "_mix_cell").drop("_mix_cell")


def draw_copies(mixed: DataFrame, *key: Column) -> DataFrame:
    """Each row as often as its rate says: the whole part, and once more with the rest as probability, by a hash of the key."""
    chance = draw(*key, F.lit("copies"))
    copies = F.floor(F.col("rate") + chance).cast("int")
    return mixed.withColumn("_mix_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))).drop("_mix_copy")
