"""Visible text of Markdown documents, in column expressions; one document is one row, so nothing is shuffled before the last step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import norm_text

# The Markdown grammar. [^\S\n] is white space within a line.
HEADING = r"^\s{0,3}#{1,6}(?:\s+|$)"
LIST_ITEM = r"^\s{0,3}(?:[-+*]|\d+[.)])\s+"
QUOTE = r"^\s{0,3}>\s?"
RULE = r"^\s{0,3}(?:-{3,}|\*{3,}|_{3,})\s*$"
CODE = r"(`+)([^`]*?)\1"
LINK = r"(!?)\[([^\]]*)\]\((?:\\.|[^)])*\)"
REFERENCE = r"(!?)\[([^\]]*)\]\[[^\]]*\]"
LINKED_IMAGE = r"(?i)\[\s*(?:!\[[^\]]*\]\((?:\\.|[^)])*\)|<img\b[^>]*>)\s*\]\((?:\\.|[^)])*\)"
AUTOLINK = r"<https?://[^>]+>"
TAG = r"</?[A-Za-z][^>]*>"
TOKEN = r"\{\{th:expr:\d+\}\}"
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'"}

FRONT = r"(?s)\A[^\S\n]*---[^\S\n]*\n(?:.*?\n)??[^\S\n]*(?:---|\.\.\.)[^\S\n]*(?=\n|\z)"
FENCE = r"[^\S\n]{{0,3}}({0}{{3,}}+)[^\n]*(?:\n(?s:.*?)(?:^[^\S\n]{{0,3}}\{1}{0}*[^\S\n]*$|\z)|\z)"
HIDDEN = rf"(?m)^(?:[^\S\n]*<!(?=--)(?s:.*?)(?:-->[^\n]*|\z)|{FENCE.format('`', 1)}|{FENCE.format('~', 2)})"

#: A protected part, and the marks around a part that is being judged.
HELD, OPEN, MID, SHUT = "\ue000", "\ufdd0", "\ufdd1", "\ufdd2"


def _protect(text: Column, pattern: str) -> Column:
    """Labels give way to HELD; those of images and blank ones go."""
    marked = F.regexp_replace(text, pattern, f"{OPEN}$1{MID}$2{SHUT}")
    bare = F.regexp_replace(marked, rf"(?U){OPEN}(?:!{MID}[^{SHUT}]*|[!`]*{MID}\s*){SHUT}", "")
    return F.regexp_replace(bare, f"{OPEN}`*{MID}[^{SHUT}]*{SHUT}", HELD)


def rendered(text: Column) -> Column:
    """The text as it reads, code, links and addresses as numbered placeholders; null if no letter is left."""
    out = F.regexp_replace(text, LINKED_IMAGE, "")
    for pattern in (CODE, LINK, REFERENCE):
        out = _protect(out, pattern)
    out = F.regexp_replace(F.regexp_replace(out, AUTOLINK, HELD), TAG, "")
    number = lambda part, i: F.when(i > 0, F.concat(F.lit("{{th:expr:"), (i - 1).cast("string"), F.lit("}}"), part)).otherwise(part)
    out = F.array_join(F.transform(F.split(out, HELD), number), "")
    out = F.regexp_replace(F.regexp_replace(out, LIST_ITEM, ""), "[*_~]+", "")
    for name, sign in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(sign))
    out = F.trim(F.regexp_replace(out, r"(?U)\s+", " "))
    return F.when(F.regexp_replace(out, TOKEN, "").rlike(r"\p{L}"), out)


def _labels(text: Column, pattern: str) -> Column:
    """Labels of the links, without those of images."""
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 1).alias("mark"), F.regexp_extract_all(text, F.lit(pattern), 2).alias("label"))
    return F.transform(F.filter(both, lambda m: m.mark == ""), lambda m: m.label)


def _line(text: Column) -> Column:
    """A line with its kind: blank, heading, list, quote or plain."""
    kind = (
        F.when(~text.rlike(r"(?U)\S"), "blank").when(text.rlike(HEADING), "heading").when(text.rlike(LIST_ITEM), "list")
        .when(text.rlike(QUOTE), "quote").otherwise("plain")
    )
    return F.struct(kind.alias("kind"), text.alias("text"))


def _starts(lines: str) -> Column:
    """Numbers of the lines that begin a run: each heading, and where the kind changes; lists and plain lines are one kind."""
    kind = lambda i: F.when(F.element_at(lines, i).kind == "list", "plain").otherwise(F.element_at(lines, i).kind)
    numbers = F.sequence(F.lit(1), F.size(lines))
    return F.filter(numbers, lambda i: F.when(i == 1, True).otherwise((kind(i) == "heading") | (kind(i) != kind(i - 1))))


def _texts(run: Column, pattern: str = "") -> Column:
    return F.transform(run, lambda x: F.trim(F.regexp_replace(x.text, pattern, "")) if pattern else x.text)


def _pieces(run: Column) -> Column:
    """What a run has to show: a paragraph or quote as a whole, list items and headings by line; tables and rules nothing."""
    first = F.array_position(F.transform(run, lambda x: x.kind), "list").cast("int")
    above = F.when(first > 0, F.slice(run, F.lit(1), F.greatest(first - 1, F.lit(0)))).otherwise(run)
    items = F.when(first > 0, F.slice(run, F.greatest(first, F.lit(1)), F.size(run))).otherwise(F.slice(run, 1, 0))
    no_table = lambda part, out: F.when(~F.exists(part, lambda x: F.contains(x.text, F.lit("|"))), out).otherwise(F.array().cast("array<string>"))
    whole = F.array_join(_texts(above), "\n")
    quoted = F.array_join(F.filter(_texts(run, QUOTE), lambda t: t != ""), "\n")
    kind = F.element_at(run, 1).kind
    return (
        F.when(kind == "blank", F.array().cast("array<string>"))
        .when(kind == "heading", F.transform(_texts(run, HEADING), lambda t: F.regexp_replace(t, r"\s+#+\s*$", "")))
        .when(kind == "quote", no_table(run, F.array(quoted)))
        .otherwise(F.concat(no_table(above, F.when(~whole.rlike(RULE), F.array(F.trim(whole))).otherwise(F.array().cast("array<string>"))), no_table(items, _texts(items))))
    )


def strings(documents: DataFrame) -> DataFrame:
    """Distinct rows (id, text) of documents (id, content string): headings, list items, quotes and paragraphs, and the labels
    of links beside the block that holds them. Front matter, comments, fenced code, tables and rules are left out.
    Null and empty contents give no row."""
    clean = F.regexp_replace(F.regexp_replace("content", "\\A\ufeff", ""), "\r\n?", "\n")
    clean = F.regexp_replace(F.regexp_replace(clean, FRONT, ""), HIDDEN, "\n")
    lines = documents.select("id", F.transform(F.split(clean, "\n"), _line).alias("lines")).where("lines IS NOT NULL")
    begun = lines.withColumn("starts", _starts("lines"))
    last = lambda k: F.coalesce(F.get("starts", k + 1), F.size("lines") + 1)
    runs = F.transform("starts", lambda s, k: F.slice("lines", s, last(k) - s))
    pieces = begun.select("id", F.explode(runs).alias("run")).select("id", F.explode(_pieces(F.col("run"))).alias("piece"))
    seen = pieces.select("id", F.regexp_replace("piece", LINKED_IMAGE, "").alias("piece"))
    shown = seen.select("id", F.explode(F.concat(F.array("piece"), _labels(F.col("piece"), LINK), _labels(F.col("piece"), REFERENCE))).alias("text"))
    found = shown.select("id", rendered(F.col("text")).alias("text")).where("text IS NOT NULL")
    return found.select("id", norm_text("text").alias("text")).distinct()
