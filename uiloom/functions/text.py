"""Column functions over user-visible text. All but norm_text and is_structured stay in the JVM."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType

# Shapes of text that is not for people.
NOT_UI_TEXT = (
    r"(?i)^(?:https?:|data:|app:|obsidian:)",
    r"(?i)[/\\].+\.(?:js|ts|json|css|svg|png|md)$",
    r"^[a-z0-9_.-]+(?:/[a-z0-9_.{}:-]+)+$",
    r"^[.#][A-Za-z0-9_-]+$",
    r"^[A-Za-z][A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]+){2,}$",
    r"^[a-z][A-Za-z0-9]*(?:[_-][A-Za-z0-9]+)+$",
    r"^[A-Z_][A-Z0-9_]+$",
    r"^%[A-Za-z_][A-Za-z0-9_]*$",
)
# Placeholders, and keys of machine-readable literals.
PLACEHOLDER = (
    r"\$\{[^}]+\}|\{\{[^}]+\}\}|\{\d+\}|%[sdif]|"
    r"</?[A-Za-z][A-Za-z0-9-]*(?:\s+[A-Za-z_:][\w:.-]*"
    r"(?:=(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*\s*/?>"
)
MACHINE_KEY = re.compile(r"kind|type|id|action|actions|mode|scope|scopes|status|variant|version|enabled|disabled", re.I)
MACHINE_SUFFIX = re.compile(r"[a-z][A-Za-z0-9]*(?:mode|order|sort|variant|scope|status|id|type|version)", re.I)
MACHINE_WORD = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.-]*")


def structured(text: str) -> bool:
    """Whether the text is a JSON object or list of identifiers only."""
    try:
        root = json.loads(text)
    except ValueError:
        return False
    if not isinstance(root, dict | list):
        return False
    todo = [root]
    while todo:
        value = todo.pop()
        if isinstance(value, str) and not MACHINE_WORD.fullmatch(value):
            return False
        if isinstance(value, dict):
            if not all(MACHINE_KEY.fullmatch(k) or MACHINE_SUFFIX.fullmatch(k) for k in value):
                return False
            todo += value.values()
        elif isinstance(value, list):
            todo += value
    return True


@pandas_udf(BooleanType())
def is_structured(text: pd.Series) -> pd.Series:
    return pd.Series([isinstance(t, str) and structured(t) for t in text], dtype=bool)


@pandas_udf(StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t).strip(), na_action="ignore")


def norm_text(text: Column | str) -> Column:
    """NFC, without white space at the ends. Python sees texts beyond ASCII only; of the others the ends are trimmed."""
    value = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(value, r"\A[\x09-\x0D\x1C-\x20]+|[\x09-\x0D\x1C-\x20]+\z", "")
    return F.coalesce(_composed(F.when(value.rlike(r"[^\x00-\x7F]"), value)), bare)


def looks_like_ui_text(text: Column, most: int | Column = 300) -> Column:
    """The gate without its last term: length, a letter, and none of the excluded shapes."""
    passed = F.length(text).between(2, most) & text.rlike(r"\p{L}")
    for shape in NOT_UI_TEXT:
        passed = passed & ~text.rlike(shape)
    return F.coalesce(passed, F.lit(False))


def is_ui_text(text: Column, most: int | Column = 300) -> Column:
    """The whole gate; Python sees only texts that start like JSON."""
    jsonish = F.when(text.rlike(r"^\s*[\[{]"), text)
    return looks_like_ui_text(text, most) & ~is_structured(jsonish)


def placeholder_signature(text: Column) -> Column:
    """Placeholders in order: none is "", one is itself, more are a JSON list."""
    found = F.regexp_extract_all(text, F.lit(PLACEHOLDER), 0)
    return F.when(F.size(found) == 0, "").when(F.size(found) == 1, found[0]).otherwise(F.to_json(found))


def string_key(owner: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(owner, F.lit("\x00"), text).cast("binary"), 256), 1, 32)


def inner_html_text(raw: Column) -> Column:
    """Markup without its tags; null if nothing with a letter is left or a part is dynamic."""
    bare = F.regexp_replace(raw, "<[^>]*>", "")
    return F.when(bare.rlike(r"\p{L}") & ~F.contains(raw, F.lit("{{th:expr:")), bare)


def canonical_locale(tag: Column) -> Column:
    """Language lower, script (four letters) title, region (two letters) upper, all else lower case; a bare zh means zh-CN; null for what is no tag."""
    parts = F.split(tag, "-")
    letters = lambda p, n: (F.length(p) == n) & p.rlike(r"\A\p{L}+\z")
    rest = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.when(letters(p, 4), F.initcap(p)).when(letters(p, 2), F.upper(p)).otherwise(F.lower(p)),
    )
    whole = F.concat_ws("-", F.concat(F.array(F.lower(parts[0])), rest))
    return F.when(tag.rlike(r"^[A-Za-z]{2,3}(-[A-Za-z0-9]{2,8})*$"), F.when(whole == "zh", "zh-CN").otherwise(whole))


def normal_bundle(bundle: Column) -> Column:
    """A script as installers leave it: without the note that suppresses source maps, without anything from its last source map line, without white space at the end."""
    note, mark = "\n/* nosourcemap */", "//# sourceMappingURL="
    bare = F.when(F.endswith(bundle, F.lit(note)), F.substring(bundle, F.lit(1), F.length(bundle) - len(note))).otherwise(bundle)
    lines = F.split(bare, F.lit("\n" + mark), -1)
    cut = F.when(F.size(lines) > 1, F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), "\n" + mark)).when(F.startswith(bare, F.lit(mark)), "").otherwise(bare)
    return F.regexp_replace(cut, r"(?U)\s+\z", "")


def pointer_segment(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def strict_json(text: Column) -> Column:
    """The text as a variant; null if it is malformed, repeats a key or holds NaN."""
    return F.try_parse_json(text)


def is_title_case(text: Column) -> Column:
    """Short text that starts with a basic Latin letter, has a capital and no punctuation of code."""
    return F.coalesce(F.length(text).between(2, 200) & text.rlike("^[A-Za-z]") & text.rlike("[A-Z]") & ~text.rlike(r"[:/.\[\]{}<>]"), F.lit(False))


def is_single_line(text: Column) -> Column:
    return F.coalesce(~text.rlike(r"[\r\n]"), F.lit(False))


def is_repository_path(path: Column) -> Column:
    """A relative path whose parts are plain names."""
    part = r"[A-Za-z0-9][A-Za-z0-9._ -]{0,239}"
    return F.coalesce((F.length(path) <= 512) & path.rlike(rf"\A{part}(?:/{part})*\z"), F.lit(False))


@pandas_udf(BooleanType())
def _mostly_latin(text: pd.Series) -> pd.Series:
    def judge(t: str) -> bool:
        letters = [c for c in t if c.isalpha()]
        return 2 * sum(unicodedata.name(c, "").startswith("LATIN") for c in letters) >= len(letters)

    return text.map(judge, na_action="ignore")


def fits_locale(text: Column, locale: Column) -> Column:
    """Whether at least half of the letters are Latin, where the locale is en; Python sees texts beyond ASCII only.
    A null text gives null."""
    beyond = F.when((locale == "en") & text.rlike(r"[^\x00-\x7F]"), text)
    return F.when(text.isNotNull(), F.coalesce(_mostly_latin(beyond), F.lit(True)))


def git_blob_id(content: Column) -> Column:
    """The SHA-1 by which git names a file with this content."""
    head = F.concat(F.lit("blob "), F.octet_length(content).cast("string"), F.lit("\x00"))
    return F.sha1(F.concat(head.cast("binary"), content.cast("binary")))


def canonical(text: str) -> str | None:
    """JSON without white space, keys ordered by UTF-16 units; None for what has no canonical form."""

    def pairs(found: list[tuple[str, object]]) -> dict[str, object]:
        out = dict(sorted(found, key=lambda p: p[0].encode("utf-16-be")))
        if len(out) < len(found):
            raise ValueError("repeated key")
        return out

    def whole(digits: str) -> int:
        if abs(n := int(digits)) >= 1 << 53:
            raise ValueError("unsafe integer")
        return n

    def refuse(number: str) -> float:
        raise ValueError(number)

    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_int=whole, parse_float=refuse, parse_constant=refuse)
        out = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
        out.encode()  # lone surrogates have no UTF-8 form
    except (ValueError, RecursionError):
        return None
    return out


@pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """The canonical form of JSON text; null for null, malformed text, repeated keys, fractions, unsafe integers and lone surrogates."""
    return text.map(canonical, na_action="ignore")
