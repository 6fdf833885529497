"""Shell-style glob selectors as Spark Column predicates (operator C1).

A selector follows POSIX shell globbing on the whole name:

    *      any run of characters, including none
    ?      exactly one character
    [abc]  one character of the set, ranges allowed ([a-z]), [!..] negates
    other  itself, case-sensitive; "" matches only ""

An unclosed "[" is an ordinary character, a "]" right after "[" or "[!" belongs
to the set, and a reversed range such as "z-a" contributes nothing.

Selectors that are plain text, or plain text with a single leading and/or
trailing "*", become equality / startswith / endswith / contains so that
Catalyst can push them into the parquet scan.  Everything else becomes an
anchored Java regex evaluated by ``rlike`` inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GLOB_META = frozenset("*?[")


def _lit_char(c: str) -> str:
    # Java regex: a backslash before a non-alphabetic char always means the
    # char itself; letters and digits must stay bare (\1 is a back-reference).
    return c if c.isalnum() else "\\" + c


def _class_char(c: str) -> str:
    return f"\\x{{{ord(c):x}}}"


def _bracket_to_regex(body: str) -> str:
    """Translate the text between ``[`` and ``]`` into a Java character class."""
    negate = body.startswith("!")
    if negate:
        body = body[1:]
    items: list[str] = []
    i, n = 0, len(body)
    while i < n:
        lo = body[i]
        if i + 2 < n and body[i + 1] == "-":
            hi = body[i + 2]
            if lo <= hi:
                items.append(f"{_class_char(lo)}-{_class_char(hi)}")
            i += 3
        else:
            items.append(_class_char(lo))
            i += 1
    if not items:
        return "." if negate else "(?!)"
    return "[" + ("^" if negate else "") + "".join(items) + "]"


def glob_to_regex(pattern: str) -> str:
    """Anchored Java regex equivalent to the shell glob ``pattern``."""
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            if not out or out[-1] != ".*":
                out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append(_lit_char("["))
            else:
                out.append(_bracket_to_regex(pattern[i:j]))
                i = j + 1
        else:
            out.append(_lit_char(c))
    return "(?s)^" + "".join(out) + "\\z"


def literal_prefix(pattern: str) -> str:
    """Text before the first glob metacharacter."""
    for i, c in enumerate(pattern):
        if c in GLOB_META:
            return pattern[:i]
    return pattern


def is_literal(pattern: str) -> bool:
    return not any(c in GLOB_META for c in pattern)


def glob_match(col: Column | str, pattern: str) -> Column:
    """Whole-string, case-sensitive shell glob match of ``col``."""
    c = F.col(col) if isinstance(col, str) else col
    if is_literal(pattern):
        return c == F.lit(pattern)
    core = pattern.strip("*")
    lead, trail = pattern.startswith("*"), pattern.endswith("*")
    if core and is_literal(core) and pattern.count("*") == int(lead) + int(trail):
        if lead and trail:
            return c.contains(core)
        if trail:
            return c.startswith(core)
        return c.endswith(core)
    if pattern and set(pattern) == {"*"}:
        return c.isNotNull()
    return c.rlike(glob_to_regex(pattern))


def any_glob(col: Column | str, patterns: list[str] | tuple[str, ...]) -> Column:
    """OR over selectors; an empty selector list selects everything."""
    if not patterns:
        return F.lit(True)
    return reduce(lambda a, b: a | b, (glob_match(col, p) for p in patterns))
