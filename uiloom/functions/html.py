"""Text nodes of HTML, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose text isn't shown as such, the entities with names, and the longest document.
HIDDEN = ("script", "style", "code", "pre", "textarea")
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}
MOST = 100_000

TOKEN = r"""(?s)<!--.*?-->|<(?!!--)(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""
TAG = r"(?s)\A<\s*(/?)([A-Za-z][A-Za-z0-9:-]*)(?:\s.*|/.*)?>\z"
ENTITY = r"&(#(?:[xX][0-9A-Fa-f]+|[0-9]+)|[A-Za-z][A-Za-z0-9]+);"


def _character(entity: Column) -> Column:
    """The character of an entity (without & and ;); null for an unknown name and for a number that is no character."""
    named = F.element_at(F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair)), entity)
    hexadecimal = F.lower(F.substring(entity, 2, 1)) == "x"
    digits = F.regexp_replace(F.when(hexadecimal, F.substring(entity, F.lit(3), F.length(entity))).otherwise(F.substring(entity, F.lit(2), F.length(entity))), r"\A0+", "")
    number = F.when(F.length(digits).between(1, 7), F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
    sound = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    # decoded with its length as a check: the number as four bytes
    made = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(F.startswith(entity, F.lit("#")), F.when(sound, made)).otherwise(named)


def decode_entities(text: Column) -> Column:
    """The text with its entities as characters, each once; null if one is unknown. White space becomes single spaces, none at the ends."""
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), 1), _character)
    pieces = F.split(text, ENTITY, -1)
    whole = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(found, i), F.lit("")))), "")
    bare = F.trim(F.regexp_replace(whole, r"(?U)\s+", " "))
    return F.when(~F.exists(found, lambda e: e.isNull()), bare)


def text_nodes(html: Column, most: int = MOST) -> Column:
    """The texts between tags and comments, in order, outside HIDDEN elements; those that are blank or have an unknown entity are left out.

    Quotes in a tag may hold >. A document that is longer than `most`, ends inside a tag, a comment or a hidden element, or has a tag without a name gives no
    text; null gives null. One pass over the tokens carries the hidden element that is open, so nesting of other tags in it plays no part."""
    tokens = F.regexp_extract_all(html, F.lit(TOKEN), 0)
    name, closing = (lambda t: F.lower(F.regexp_extract(t, TAG, 2))), (lambda t: F.regexp_extract(t, TAG, 1) == "/")
    is_tag = lambda t: F.startswith(t, F.lit("<"))
    comment = lambda t: F.startswith(t, F.lit("<!--")) | t.rlike(r"\A<\s*!\s*>\z")
    unnamed = F.exists(tokens, lambda t: is_tag(t) & ~comment(t) & ~t.rlike(TAG))
    # what bears on the result: texts, and the tags of hidden elements
    telling = F.filter(tokens, lambda t: ~is_tag(t) | (~comment(t) & name(t).isin(*HIDDEN)))

    def step(state: Column, token: Column) -> Column:
        hidden = state["hidden"]
        opens = is_tag(token) & ~closing(token) & ~token.rlike(r"/\s*>\z")
        after = F.when((hidden == "") & opens, name(token)).when((hidden != "") & closing(token) & (name(token) == hidden), "").otherwise(hidden)
        shown = F.when(is_tag(token) | (hidden != ""), state["texts"]).otherwise(F.concat(state["texts"], F.array(token)))
        return F.struct(after.alias("hidden"), shown.alias("texts"))

    start = F.struct(F.lit("").alias("hidden"), F.array().cast("array<string>").alias("texts"))
    nothing = F.array().cast("array<string>")
    read = F.aggregate(telling, start, step, lambda s: F.when(s["hidden"] == "", s["texts"]).otherwise(nothing))
    decoded = F.filter(F.transform(read, decode_entities), lambda t: F.coalesce(t != "", F.lit(False)))
    return F.when(html.isNotNull(), F.when((F.length(html) > most) | unnamed, nothing).otherwise(decoded))
