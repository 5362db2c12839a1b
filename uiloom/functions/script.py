"""Static reading of script bundles: tokens, literals and the calls that show text to people.

Nothing here knows Spark, and nothing runs a bundle. A bundle that can't be tokenised gives None.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

# Calls and assignments that show text, by the place of the text.
TEXT_CALLS = {
    "Notice": 0, "setText": 0, "setButtonText": 0, "setName": 0, "setDesc": 0, "setPlaceholder": 0,
    "setTooltip": 0, "setTitle": 0, "addHeading": 0, "appendText": 0, "addOption": 1,
}
CREATE_CALLS = {"createEl", "createSpan", "createDiv", "createButton"}
TEXT_SINKS = {"textContent", "innerText", "innerHTML"}
VISIBLE_ATTRIBUTES = {"aria-label", "title", "placeholder"}

OPEN, CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}
SKIP = re.compile(r"(?:\s+|//[^\n]*|/\*.*?\*/)+", re.S)
NAME = re.compile(r"[^\W\d][\w$]*|\$[\w$]*")
QUOTED = re.compile(r"'(?:[^'\\\n]|\\.)*'|\"(?:[^\"\\\n]|\\.)*\"", re.S)
PATTERN = re.compile(r"/(?![*/])(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*")
BEFORE_PATTERN = {"return", "typeof", "case", "in", "of", "delete", "void", "throw", "new", "else", "do", "await", "yield"}
ESCAPE = re.compile(r"\\(u\{[0-9A-Fa-f]+\}|u[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2}|\r\n|.)", re.S)
PLAIN = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": "", "\r\n": "", "\r": ""}


class Token(NamedTuple):
    kind: str  # name, literal, mark or other
    raw: str
    start: int


class Found(NamedTuple):
    origin: str
    symbol: str
    text: str
    probe: str
    offset: int


def template_end(source: str, start: int) -> int:
    """Behind the back-quote that closes the template at start; -1 if none does."""
    i, depth = start + 1, []
    while i < len(source):
        c = source[i]
        if c == "\\":
            i += 2
            continue
        if not depth or depth[-1] == "`":
            if c == "`":
                if not depth:
                    return i + 1
                depth.pop()
            elif source.startswith("${", i):
                depth.append("{")
                i += 1
        elif c in "'\"":
            m = QUOTED.match(source, i)
            i = m.end() if m else i + 1
            continue
        elif c in "`{":
            depth.append(c)
        elif c == "}":
            depth.pop()
        i += 1
    return -1


def tokenize(source: str) -> list[Token] | None:
    out: list[Token] = []
    i = 0
    while i < len(source):
        if m := SKIP.match(source, i):
            i = m.end()
            continue
        c = source[i]
        if source.startswith("/*", i):
            return None
        kind, end = "mark", i + 1
        if m := NAME.match(source, i):
            kind, end = "name", m.end()
        elif c in "'\"":
            m = QUOTED.match(source, i)
            if not m:
                return None
            kind, end = "literal", m.end()
        elif c == "`":
            kind, end = "literal", template_end(source, i)
            if end < 0:
                return None
        elif c == "/" and (not out or out[-1].raw in BEFORE_PATTERN or out[-1].kind == "mark" and out[-1].raw not in CLOSE):
            m = PATTERN.match(source, i)
            kind, end = ("other", m.end()) if m else ("mark", i + 1)
        elif c.isdigit():
            kind = "other"
        out.append(Token(kind, source[i:end], i))
        i = end
    return out


def partners(tokens: list[Token]) -> dict[int, int] | None:
    """For each opening mark its closing one; None if they don't pair."""
    out, waiting = {}, []
    for i, t in enumerate(tokens):
        if t.kind != "mark":
            continue
        if t.raw in OPEN:
            waiting.append(i)
        elif t.raw in CLOSE:
            if not waiting or OPEN[tokens[waiting[-1]].raw] != t.raw:
                return None
            out[waiting.pop()] = i
    return None if waiting else out


def unescape(body: str) -> str | None:
    """The text of a literal's body; None if it holds a surrogate without its partner."""

    def one(m: re.Match) -> str:
        e = m[1]
        if len(e) > 1 and e[0] in "ux":
            code = int(e[1:].strip("{}"), 16)
            return chr(code) if code <= 0x10FFFF else "\ud800"
        return PLAIN.get(e, e)

    text = ESCAPE.sub(one, body)
    try:
        return text.encode("utf-16", "surrogatepass").decode("utf-16")
    except UnicodeDecodeError:
        return None


def render(source: str, tokens: list[Token]) -> tuple[str, str] | None:
    """Text with a numbered placeholder for each dynamic part, and its static part; None if no part is static."""
    parts: list[str | None] = []
    depth, run = 0, []

    def close() -> bool:
        if not run:
            return False
        if len(run) == 1 and run[0].kind == "literal":
            raw = run[0].raw
            if raw[0] != "`":
                text = unescape(raw[1:-1])
                parts.append(text)
                return text is not None
            at, body = 1, raw
            while at < len(body) - 1:
                dollar = body.find("${", at)
                if dollar < 0:
                    dollar = len(body) - 1
                if dollar > at:
                    text = unescape(body[at:dollar])
                    if text is None:
                        return False
                    parts.append(text)
                if dollar == len(body) - 1:
                    break
                parts.append(None)
                at = expression_end(body, dollar + 2)
                if at < 0:
                    return False
        else:
            parts.append(None)
        run.clear()
        return True

    for t in tokens:
        if t.kind == "mark" and t.raw in OPEN:
            depth += 1
        elif t.kind == "mark" and t.raw in CLOSE:
            depth -= 1
        if not depth and t.kind == "mark" and t.raw in "?:|&=<>":
            return None
        if not depth and t.kind == "mark" and t.raw == "+":
            if not close():
                return None
            run.clear()
        else:
            run.append(t)
    if not close() or not any(parts):
        return None
    text, n = "", 0
    for p in parts:
        if p is None:
            n += 1
        text += f"{{{{th:expr:{n}}}}}" if p is None else p
    return text, "".join(p for p in parts if p)


def expression_end(body: str, start: int) -> int:
    """Behind the brace that closes the interpolation whose expression starts here."""
    depth, i = 1, start
    while i < len(body):
        c = body[i]
        if c in "'\"" and (m := QUOTED.match(body, i)):
            i = m.end()
            continue
        if c == "`":
            i = template_end(body, i)
            if i < 0:
                return -1
            continue
        depth += (c == "{") - (c == "}")
        if not depth:
            return i + 1
        i += 1
    return -1


def split_list(tokens: list[Token], pairs: dict[int, int], first: int, last: int) -> Iterator[tuple[int, int]]:
    """Ranges of the items between two marks, separated by commas at the top level."""
    start = i = first
    while i < last:
        if tokens[i].raw == "," and tokens[i].kind == "mark":
            yield start, i
            start = i + 1
        i = pairs.get(i, i) + 1
    if start < last:
        yield start, last


def is_receiver(tokens: list[Token], i: int) -> bool:
    """Whether a property name stands behind a name and a dot; behind a call or an index it doesn't count."""
    return i > 1 and tokens[i - 1].raw == "." and tokens[i - 2].kind == "name"


def without_tags(shown: tuple[str, str]) -> tuple[str, str] | None:
    """Static markup without its tags, if a letter is left."""
    bare = re.sub("<[^>]*>", "", shown[0])
    return (bare, bare) if any(map(str.isalpha, bare)) and "{{th:expr:" not in shown[0] else None


def entries(tokens: list[Token], pairs: dict[int, int], first: int, last: int) -> Iterator[tuple[str, int, int]]:
    """Key and range of the value of each entry, if the range is an object literal, in parentheses or not."""
    while last - first > 1 and tokens[first].raw == "(" and pairs.get(first) == last - 1:
        first, last = first + 1, last - 1
    if first >= last or tokens[first].raw != "{" or pairs.get(first) != last - 1:
        return
    for a, b in split_list(tokens, pairs, first + 1, last - 1):
        if b > a + 2 and tokens[a + 1].raw == ":":
            yield tokens[a].raw.strip("'\""), a + 2, b


def visible_text(source: str) -> list[Found] | None:
    """Texts shown by calls, options, created elements, sinks and visible attributes."""
    tokens = tokenize(source)
    pairs = None if tokens is None else partners(tokens)
    if pairs is None:
        return None
    out: list[Found] = []

    def add(origin: str, symbol: str, first: int, last: int, accept: Callable[[tuple[str, str]], tuple[str, str] | None] = lambda shown: shown) -> None:
        shown = render(source, tokens[first:last])
        if shown and (shown := accept(shown)):
            out.append(Found(origin, symbol, *shown, tokens[first].start))

    accepts = {
        "innerText": lambda shown: None if re.search("[\r\n]", shown[0]) else shown,
        "innerHTML": without_tags,
        "setAttribute": lambda shown: None if re.search("[\u3400-\u9fff\U00020000-\U0002fa1f]", shown[0]) else shown,
    }
    for i, t in enumerate(tokens):
        if t.kind != "name":
            continue
        called = i + 1 < len(tokens) and tokens[i + 1].raw == "(" and i + 1 in pairs
        items = [*split_list(tokens, pairs, i + 2, pairs[i + 1])] if called else []
        if t.raw in TEXT_CALLS and len(items) > TEXT_CALLS[t.raw]:
            add("ui-call", t.raw, *items[TEXT_CALLS[t.raw]])
        elif t.raw == "addOptions" and items:
            for _, a, b in entries(tokens, pairs, *items[0]):
                if b == a + 1 and tokens[a].kind == "literal":
                    add("ui-property", t.raw, a, b)
        elif t.raw in CREATE_CALLS:
            for item in items:
                for key, a, b in entries(tokens, pairs, *item):
                    if key == "text":
                        add("ui-property", t.raw, a, b)
        elif t.raw == "setAttribute" and len(items) > 1 and is_receiver(tokens, i):
            (a, b), (c, d) = items[:2]
            if b == a + 1 and tokens[a].kind == "literal" and unescape(tokens[a].raw[1:-1]) in VISIBLE_ATTRIBUTES and d == c + 1 and tokens[c].kind == "literal":
                add("ui-property", t.raw, c, d, accepts[t.raw])
        elif t.raw in TEXT_SINKS and i < len(tokens) - 2 and is_receiver(tokens, i) and tokens[i + 1].raw == "=" and tokens[i + 2].raw != "=":
            last = i + 2
            while last < len(tokens) and tokens[last].raw not in {";", ",", *CLOSE}:
                last = pairs.get(last, last) + 1
            add("ui-property", t.raw, i + 2, last, accepts.get(t.raw, lambda shown: shown))
    return out
