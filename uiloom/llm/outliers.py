"""Quality rules: simple bounds, then robust multivariate outliers, in DataFrame operations only.

Base rules read a text's words: too few words, or too many words in 8-word windows that the text
repeats, fail a document. All others become vectors of transformed statistics. For each language
and source, a minimum-covariance-determinant estimate is made. It starts from medians and median
absolute deviations, and from STARTS - 1 samples of about DRAWN rows each. Concentration steps each keep the SUPPORT share of rows nearest by
Mahalanobis distance and estimate mean and covariance anew from them. After TRIED steps the start with the smallest determinant goes on alone, until
no determinant's logarithm falls by more than TOLERANCE any more (STEPS times at most). Outliers, copies of one text
or not, can make up nearly half of a group. The covariance is scaled to
be consistent for normal data, and FLOORS are added to its diagonal, since most statistics are constant
in clean text. A row whose squared distance exceeds CUTOFF is rejected.

Estimates for a language and for all rows are made where a group needs them: a group of fewer than LEAST rows that pass the
base rules is judged by the estimate of its language, or of all rows if the language has fewer than LEAST too,
so every row that passes the base rules gets a verdict. Null language or source is a
group of its own; a null text has no words and fails the base rules. Repeated rows count as often
as they occur and get equal verdicts. Very long texts are read whole, as one row. An empty table gives an empty result. Only id, lang, source and text are read, so further columns can't clash.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import SPACE, draw, in_scratch, outer, stage, words

WINDOW = 8
SUPPORT, STARTS, DRAWN, TRIED, STEPS, TOLERANCE, LEAST = 0.5, 3, 60, 2, 8, 0.05, 50
#: 0.99999 quantile of chi-squared with 5 degrees of freedom, and SUPPORT / P(chi-squared with 7 <= the SUPPORT quantile with 5).
CUTOFF, CONSISTENCY = 30.86, 1.91
#: Least variance of each statistic: log words, log mean word length, log symbols in 1000 characters, shares of repeated lines and words.
FLOORS = (0.25, 0.02, 0.25, 0.02, 0.02)
FEATURES = tuple(f"x{i}" for i in range(len(FLOORS)))
GROUP = ["lang", "source"]
#: An estimate's rows: at level 0 a language and source, at 1 a language, at 2 all; what a level leaves out is null.
CELL = ["level", *GROUP]
#: An estimate in the making: one of each start.
TRIAL = ["start", *CELL]


def repeat_positions(hashes: Column) -> Column:
    """Sorted positions of the windows whose hash occurs more than once."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    following = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0)))
    same = F.zip_with(ordered, following, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    return F.sort_array(F.array_distinct(F.flatten(F.transform(same, lambda x: F.coalesce(x, F.array().cast("array<int>"))))))


def covered(positions: Column) -> Column:
    """Words that windows at these positions cover."""
    following = F.slice(positions, F.lit(2), F.greatest(F.size(positions) - 1, F.lit(0)))
    steps = F.zip_with(positions, following, lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; columns of these names are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    own = df.withColumns({"_words": words(F.col(text_col)), "_lines": lines})
    counts = own.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(
            F.size("_words") > WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("_words") - WINDOW + 1), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))),
        ),
    })
    distinct = F.size(F.array_distinct("_windows"))
    repeated = F.when(F.col("_windows").isNull() | (distinct == F.size("_windows")), 0).otherwise(covered(repeat_positions(F.col("_windows"))))
    return counts.withColumn("n_repeat_words", repeated.cast("long")).drop("_words", "_lines", "_windows")


def vectors(df: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    values = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / n),
        F.log1p(1000 * F.col("n_symbols") / chars),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
    ]
    return df.withColumns(dict(zip(FEATURES, values, strict=True)))


def estimate(rows: DataFrame) -> DataFrame:
    """Of each cell: number of rows, means m0.., and the covariance c00, c01, .. of the given rows."""
    p = range(len(FEATURES))
    sums = [F.count("*").alias("n"), *(F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES))]
    sums += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in p for j in p if j <= i]
    return rows.groupBy(*TRIAL).agg(*sums)


def factored(stats: DataFrame, scale: float) -> DataFrame:
    """stats with the Cholesky factor l00, l10, .. of scale times the covariance plus the floors."""
    p = len(FEATURES)
    for i in range(p):
        for j in range(i + 1):
            value = scale * F.col(f"c{i}{j}") + (FLOORS[i] if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            stats = stats.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"l{j}{j}"))
    return stats.drop(*(f"c{i}{j}" for i in range(p) for j in range(i + 1)))


def matched(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined with stats, whose columns get a leading underscore, where the keys are equal or both null."""
    named = stats.select(*(F.col(c).alias(f"_{c}") for c in stats.columns))
    return rows.join(named, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys)), how)


def needs(rows: DataFrame) -> DataFrame:
    """For each group: the level at which it is judged, and which of its cells any group is judged by (need0, need1, need2).
    Level 0 takes LEAST rows that pass the base rules, level 1 as many of the language, level 2 any."""
    groups = rows.groupBy(*GROUP).agg(F.count_if(~F.col("base_failed")).alias("n"))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.bool_or(F.col("n") < LEAST).alias("small"))
    own, known = F.col("n") >= LEAST, F.col("_n") >= LEAST
    placed = stage(matched(groups, langs, ["lang"]).select(*GROUP, F.when(own, 0).when(known, 1).otherwise(2).alias("level"), own.alias("need0"), (F.col("_small") & known).alias("need1")), "needs")
    return placed.withColumn("need2", F.lit(not placed.where("level = 2").isEmpty()))


def cells(rows: DataFrame, needed: DataFrame | None = None) -> DataFrame:
    """Each row once for each of its cells, or for those that are needed."""
    none = [F.lit(None).cast(rows.schema[c].dataType) for c in GROUP]
    levels = ((F.col("lang"), F.col("source")), (F.col("lang"), none[1]), (none[0], none[1]))
    own = [F.struct(F.lit(i).alias("level"), x.alias("lang"), y.alias("source")) for i, (x, y) in enumerate(levels)]
    kept = [c for c in rows.columns if c not in GROUP]
    if needed is not None:
        rows = matched(rows, needed, GROUP)
        own = [F.when(F.col(f"_need{i}"), c) for i, c in enumerate(own)]
    return rows.withColumn("_cell", F.explode(F.array_compact(F.array(*own)))).select("_cell.*", *kept)


def distances(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """rows with `far`, the squared Mahalanobis distance to the estimate that their keys have."""
    p = len(FEATURES)
    joined = matched(rows, stats, keys, "left")
    total = F.lit(0.0)
    for i in range(p):
        value = F.col(FEATURES[i]) - F.col(f"_m{i}")
        for k in range(i):
            value = value - F.col(f"_l{i}{k}") * F.col(f"_y{k}")
        joined = joined.withColumn(f"_y{i}", value / F.col(f"_l{i}{i}"))
        total = total + F.col(f"_y{i}") * F.col(f"_y{i}")
    return joined.withColumn("far", total).drop(*(c for c in joined.columns if c.startswith("_")))


def start(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Start 0: estimates from medians and median absolute deviations, without correlations. The others: from about DRAWN rows.
    A sample of copies only has no spread, but FLOORS keep its covariance regular."""
    p = range(len(FEATURES))
    medians = [F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(FEATURES)]
    centre = stage(rows.groupBy(*CELL).agg(F.count("*").alias("n"), *medians), "medians")
    joined = matched(rows, centre, CELL)
    spread = [F.percentile_approx(F.abs(F.col(x) - F.col(f"_m{i}")), 0.5).alias(f"s{i}") for i, x in enumerate(FEATURES)]
    first = joined.groupBy(*CELL).agg(F.first("_n").alias("n"), *(F.first(f"_m{i}").alias(f"m{i}") for i in p), *spread)
    own = {f"c{i}{j}": F.pow(1.4826 * F.col(f"s{i}"), 2) if i == j else F.lit(0.0) for i in p for j in p if j <= i}
    middle = factored(first.withColumns(own).withColumn("start", F.lit(0)), 1.0)
    sampled = matched(trials(rows, range(1, STARTS)), sizes, CELL).where(draw("doc_id", "start") * F.col("_size") <= DRAWN)
    columns = [c for c in middle.columns if c not in {f"s{i}" for i in p}]
    return middle.select(*columns).unionByName(factored(estimate(sampled), 1.0).select(*columns))


def trials(rows: DataFrame, starts: range) -> DataFrame:
    """Each row once for each start."""
    return rows.withColumn("start", F.explode(F.array(*map(F.lit, starts))))


def robust(rows: DataFrame, needed: DataFrame | None = None) -> DataFrame:
    """The minimum-covariance-determinant estimate of each cell (that is needed), its covariance factored; n counts all rows of the cell."""
    rows = cells(rows, needed)
    sizes = stage(rows.groupBy(*CELL).agg(F.count("*").alias("size")), "sizes")
    stats = stage(start(rows, sizes), "estimate")
    spread = sum((2 * F.log(f"l{i}{i}") for i in range(len(FEATURES))), F.lit(0.0))  # log of the determinant
    values = ["n", *(c for c in stats.columns if c[0] in "ml" and c[1:].isdigit()), "spread"]
    starts, before = STARTS, None
    for turn in range(TRIED + STEPS):
        # a cell whose sample is empty has no such trial
        near = distances(trials(rows, range(starts)), stats, TRIAL).where("far IS NOT NULL")
        limits = stage(near.groupBy(*TRIAL).agg(F.percentile_approx("far", SUPPORT).alias("limit")), "limits")
        core = matched(near, limits, TRIAL).where("far <= _limit")
        stats = factored(estimate(core), CONSISTENCY).withColumn("spread", spread)
        if turn == TRIED - 1:
            best = stats.groupBy(*CELL).agg(F.min_by(F.struct(*values), F.struct("spread", "start")).alias("best"))
            stats, starts = best.select(F.lit(0).alias("start"), *CELL, "best.*"), 1
        stats = stage(stats, "estimate")
        if turn >= TRIED:
            fallen = matched(stats, before, TRIAL).agg(F.max(F.col("_spread") - F.col("spread"))).first()[0]
            if fallen is None or fallen <= TOLERANCE:
                break
        before = stats
    return matched(stats.drop("start", "n"), sizes, CELL).withColumn("n", F.col("_size")).select(*CELL, "n", *values[1:])


def chosen(needed: DataFrame, stats: DataFrame) -> DataFrame:
    """For each language and source, the estimate that it is judged by."""
    own = needed.select(*(F.col(c).alias(f"own_{c}") for c in GROUP), "level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") == 0, F.col("source")).alias("source"))
    values = [c for c in stats.columns if c not in CELL]
    return matched(own, stats, CELL).select(*(F.col(f"own_{c}").alias(c) for c in GROUP), *(F.col(f"_{c}").alias(c) for c in values))


@in_scratch
def judge(df: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, the statistics, base_failed, the squared distance `far` and `kept` of each row of df."""
    measured = vectors(statistics(df.select("doc_id", *GROUP, F.col(text_col).alias("text")), "text").drop("text"))
    few = F.col("n_words") < 20
    repeats = 100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    rows = stage(measured.withColumn("base_failed", few | repeats), "statistics", owner=outer())
    needed = needs(rows)
    stats = stage(robust(rows.where(~F.col("base_failed")), needed), "robust")
    placed = distances(rows, stage(chosen(needed, stats), "chosen", owner=outer()), GROUP)
    return placed.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("far") > CUTOFF, F.lit(False)))
