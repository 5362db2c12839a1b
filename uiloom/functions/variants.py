"""Checks and walks of JSON values, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uiloom.functions.text import pointer_segment

# Fixed value: the deepest nesting of a value that is read at all.
DEPTH = 64
STRING = r'"(?:[^"\\]++|\\.)*+"'


def depth(text: Column) -> Column:
    """How deeply objects and lists are nested in JSON text: 0 for a bare value. Strings are taken out first, so brackets in them don't count."""
    marks = F.split(F.regexp_replace(F.regexp_replace(text, "(?s)" + STRING, ""), r"[^\[\]{}]", ""), "")
    step = lambda s, c: F.struct(
        (s["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)).alias("now"), F.greatest(s["most"], s["now"] + F.when(c.isin("[", "{"), 1).otherwise(0)).alias("most")
    )
    return F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda s: s["most"])


def strict_value(text: Column, most: int = DEPTH) -> Column:
    """The text as a variant; null if it is malformed, repeats a key, holds NaN, NUL or half of a surrogate pair, or is nested deeper than `most`."""
    # escaped backslashes go first, so what is left of \\u is an escape of a character
    bare = F.regexp_replace(text, r"\\\\", " ")
    halves = F.regexp_replace(bare, r"(?i)\\ud[89ab][0-9a-f]{2}\\ud[c-f][0-9a-f]{2}", "").rlike(r"(?i)\\u(?:d[89a-f][0-9a-f]{2}|0000)")
    return F.when((depth(text) <= most) & ~halves & ~F.contains(text, F.lit("\x00")), F.try_parse_json(text))


#: The first word of a variant's schema, and the kind it stands for; any other is a number.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer", "VOID": "null"}


def kind(value: Column) -> Column:
    """object, array, string, boolean, integer, number, null; null for no value."""
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    known = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    return F.when(value.isNotNull(), F.coalesce(F.element_at(known, word), F.lit("number")))


def members(value: Column) -> Column:
    """The members of an object as map<string, variant>; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def shape(own: Column, fields: dict[str, str], *, exact: bool = True) -> Column:
    """The codes of what is wrong with an object of these members, sorted: `not-object` (no members), `missing:<name>`, `kind:<name>`, and, if it must be `exact`, `unexpected:<name>`.
    fields: the kind of each member; several kinds are parted by |."""
    names, kinds = F.array(*map(F.lit, fields)), F.array(*(F.split(F.lit(k), r"\|") for k in fields.values()))
    given = F.transform(names, lambda n: F.struct(n.alias("name"), kind(F.element_at(own, n)).alias("kind")))
    code = lambda g, i: F.when(g["kind"].isNull(), F.concat(F.lit("missing:"), g["name"])).when(~F.array_contains(F.get(kinds, i), g["kind"]), F.concat(F.lit("kind:"), g["name"]))
    found = F.array_compact(F.transform(given, code))
    if exact:
        others = F.array_except(F.map_keys(own), names)
        found = F.concat(found, F.transform(others, lambda k: F.concat(F.lit("unexpected:"), k)))
    return F.when(own.isNull(), F.array(F.lit("not-object"))).otherwise(F.array_sort(found))


def walk(rows: DataFrame, id_col: str, text_col: str, most: int = DEPTH) -> DataFrame:
    """id, pointer (RFC 6901), kind, depth and value (text of a scalar) of every value in the JSON texts that are sound; texts that aren't give no rows.

    Each round opens the containers of the round before; there are as many rounds as the deepest text has levels, `most` at the most."""
    frontier = rows.select(F.col(id_col).alias("id"), F.lit("").alias("pointer"), F.lit(0).alias("depth"), strict_value(F.col(text_col), most).alias("v")).where("v IS NOT NULL")
    levels = rows.agg(F.max(F.least(depth(F.col(text_col)), F.lit(most)))).first()[0] or 0
    out = []
    for level in range(levels + 1):
        named = frontier.withColumn("kind", kind(F.col("v")))
        out.append(named.select("id", "pointer", "kind", "depth", F.when(~F.col("kind").isin("object", "array"), F.try_variant_get("v", "$", "string")).alias("value")))
        if level == levels:
            break
        of_object = F.transform(F.map_entries(members(F.col("v"))), lambda m: F.struct(pointer_segment(m["key"]).alias("k"), m["value"].alias("v")))
        items = F.when(F.col("kind") == "array", F.try_variant_get("v", "$", "array<variant>"))
        of_list = F.transform(items, lambda v, i: F.struct(i.cast("string").alias("k"), v.alias("v")))
        opened = named.select("id", "pointer", F.explode(F.coalesce(of_object, of_list)).alias("m"))
        frontier = opened.select("id", F.concat("pointer", F.lit("/"), "m.k").alias("pointer"), F.lit(level + 1).alias("depth"), "m.v")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole
