"""Regular expressions that are tried only on texts which hold one of the words every match needs.

Searching a text for a plain word costs a small part of a regular expression.  The words come from the pattern
itself; where they cannot be told for certain, there are none and the pattern is tried on every text.
"""

from functools import lru_cache

from pyspark.sql import Column

from sitegauge.functions.text import as_col, by_sql, let

#: Shorter words are in too many texts; more words than this cost as much as the pattern.
SHORTEST, MOST = 2, 48


class _Unsure(Exception):
    """The pattern uses something that is not understood here."""


def _class_end(p: str, i: int) -> int:
    """Where the character class that starts at i ends; classes inside classes are not understood."""
    i += 2 if p[i + 1:i + 2] == "^" else 1
    first = i
    while i < len(p) and (p[i] != "]" or i == first):
        if p[i] == "[":
            raise _Unsure
        i += 2 if p[i] == "\\" else 1
    return i + 1


def _group_end(p: str, i: int) -> int:
    """Where the group that starts at i ends."""
    depth = 0
    while i < len(p):
        if p[i] == "\\":
            i += 2
        elif p[i] == "[":
            i = _class_end(p, i)
        else:
            depth += (p[i] == "(") - (p[i] == ")")
            i += 1
            if depth == 0:
                return i
    raise _Unsure


def _better(a, b):
    """The set whose shortest word is longer."""
    if a is None or b is None:
        return a or b
    return max(a, b, key=lambda s: (min(map(len, s)), -len(s)))


def _sequence(p: str):
    """Words of which one is in every match of a pattern without bars at its top level; None if there are none."""
    best, run, i = None, "", 0

    def close():
        nonlocal best, run
        if len(run) >= SHORTEST:
            best = _better(best, frozenset([run]))
        run = ""

    while i < len(p):
        literal, inner, c = None, None, p[i]
        if c == "\\":
            if i + 1 == len(p) or p[i + 1] in "QEpPxuc0123456789kN":
                raise _Unsure
            literal = None if p[i + 1].isalnum() else p[i + 1]
            i += 2
        elif c == "[":
            i = _class_end(p, i)
        elif c == "(":
            end = _group_end(p, i)
            body = p[i + 1:end - 1]
            if body.startswith("?:"):
                inner = _words(body[2:])
            elif not body.startswith("?"):
                inner = _words(body)
            elif not body.startswith(("?=", "?!", "?<=", "?<!")):
                raise _Unsure
            i = end
        else:
            literal = None if c in ".^$" else c
            if c in "*+?{)]}":
                raise _Unsure
            i += 1
        optional = repeated = False
        if i < len(p) and p[i] in "*+?{":
            repeated = True
            optional = p[i] in "*?" or p[i:i + 2] == "{0"
            i = p.index("}", i) + 1 if p[i] == "{" else i + 1
            if i < len(p) and p[i] in "?+":
                i += 1
        if literal is not None and not optional:
            run += literal
            if repeated:
                close()
            continue
        close()
        if not optional:
            best = _better(best, inner)
    close()
    return best


def _words(p: str):
    """Words of which one is in every match; None if one of the alternatives needs none."""
    parts, start, i = [], 0, 0
    while i < len(p):
        if p[i] == "\\":
            i += 2
        elif p[i] == "[":
            i = _class_end(p, i)
        elif p[i] == "(":
            i = _group_end(p, i)
        else:
            if p[i] == "|":
                parts.append(p[start:i])
                start = i + 1
            i += 1
    found = [_sequence(x) for x in [*parts, p[start:]]]
    return None if None in found else frozenset().union(*found)


@lru_cache(maxsize=1024)
def needed_words(pattern: str) -> tuple:
    """(words, whether case is ignored): every text that the pattern matches holds one of the words.  No words: not known."""
    ignore = pattern.startswith("(?i)")
    try:
        words = _words(pattern[4:] if ignore else pattern)
    except (_Unsure, ValueError):
        words = None
    if words is None or len(words) > MOST or any(ord(c) > 126 for w in words for c in w):
        return (), ignore
    words = {w.lower() for w in words} if ignore else words
    return tuple(sorted(w for w in words if not any(o != w and o in w for o in words))), ignore


def _literal(text: str) -> str:
    """SQL literal; backslashes stand for themselves wherever the quotes allow it."""
    if "'" not in text:
        return f"r'{text}'"
    return f'r"{text}"' if '"' not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def condition(name: str, pattern: str) -> str:
    """SQL text: whether the text that goes by `name` matches, the pattern being tried behind the words."""
    words, ignore = needed_words(pattern)
    tried = f"{name} RLIKE {_literal(pattern)}"
    if not words:
        return f"({tried})"
    place = "lowered" if ignore else name
    held = " OR ".join(f"contains({place}, {_literal(w)})" for w in words)
    return "(" + (let("lowered", f"lower({name})", f"({held})") if ignore else f"({held})") + f" AND {tried})"


def matches(c, pattern: str) -> Column:
    """rlike behind a search for the words that the pattern needs.

    The words are searched inside a lambda: as plain conditions, dozens of them would make one generated method so large
    that the virtual machine never compiles it."""
    if not needed_words(pattern)[0]:
        return as_col(c).rlike(pattern)
    return by_sql(c, "t", condition("t", pattern))


def first_match(c, patterns, values=None) -> Column:
    """The value of the first pattern that the text matches, by default its position; null when none does."""
    chosen = range(len(patterns)) if values is None else values
    arms = " ".join(f"WHEN {condition('t', p)} THEN {v}" for p, v in zip(patterns, chosen, strict=True))
    return by_sql(c, "t", f"CASE {arms} END")
