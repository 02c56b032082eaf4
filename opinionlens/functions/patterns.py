r"""Patterns in Python's syntax, made to mean the same to Java's regular expressions.

``\b``, ``\w``, ``\d`` and ``\s`` are given their Unicode meaning by spelling the classes
out. A ``\b`` beside something that is certainly a letter, digit or ``_`` looks one way
only; any other looks both ways.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterable

from opinionlens.functions.classes import SPACE_CHARS, WORD_CHARS

START, END = f"(?<![{WORD_CHARS}])", f"(?![{WORD_CHARS}])"
EDGE = f"(?:(?<=[{WORD_CHARS}]){END}|{START}(?=[{WORD_CHARS}]))"
INSIDE = f"(?:(?<=[{WORD_CHARS}])(?=[{WORD_CHARS}])|{START}{END})"
CLASSES = {"w": WORD_CHARS, "d": r"\p{Nd}", "s": SPACE_CHARS}


def _is_word(code: int) -> bool:
    return chr(code).isalnum() or chr(code) == "_"


def _certainly_word(nodes, last: bool) -> bool:
    """Whether every match of the nodes begins (or ends) with a letter, digit or ``_``."""
    for op, value in reversed(nodes) if last else nodes:
        if op is sre.LITERAL:
            return _is_word(value)
        if op is sre.IN:
            return all(
                (kind is sre.LITERAL and _is_word(item))
                or (kind is sre.RANGE and all(_is_word(c) for c in range(item[0], min(item[1], item[0] + 300) + 1)) and item[1] - item[0] <= 300)
                or (kind is sre.CATEGORY and item in (sre.CATEGORY_WORD, sre.CATEGORY_DIGIT))
                for kind, item in value
            )
        if op is sre.SUBPATTERN:
            return _certainly_word(list(value[3]), last)
        if op is sre.BRANCH:
            return all(_certainly_word(list(part), last) for part in value[1])
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            return _certainly_word(list(value[2]), last)
        return False
    return False


def _tokens(pattern: str) -> list[str]:
    """The pattern in pieces: escapes, classes and single characters."""
    found, at = [], 0
    while at < len(pattern):
        end = at + 2 if pattern[at] == "\\" else at + 1
        if pattern[at] == "[":
            end += pattern[end : end + 1] == "^"
            end += pattern[end : end + 1] == "]"
            while end < len(pattern) and pattern[end] != "]":
                end += 2 if pattern[end] == "\\" else 1
            end += 1
        found.append(pattern[at:end])
        at = end
    return found


def _beside(tokens: list[str], at: int, step: int) -> str:
    """What stands next to a token, as far as its group and alternative go."""
    opening, closing = ("(", ")") if step > 0 else (")", "(")
    found, depth, i = [], 0, at + step
    while 0 <= i < len(tokens):
        depth += (tokens[i] == opening) - (tokens[i] == closing)
        if depth < 0 or depth == 0 and tokens[i] == "|":
            break
        found.append(tokens[i])
        i += step
    text = "".join(found if step > 0 else reversed(found))
    # Going left one meets the ?: or ?i: of the group that holds the token.
    if step < 0 and depth < 0 and text.startswith("?"):
        text = text.partition(":")[2]
    return text


def _parsed(text: str) -> list:
    try:
        return list(sre_parser.parse(text))
    except (ValueError, KeyError, IndexError, sre_parser.error):
        return []  # refers to a group outside: nothing is certain


def _edge(tokens: list[str], at: int) -> str:
    if _certainly_word(_parsed(_beside(tokens, at, 1)), last=False):
        return START
    if _certainly_word(_parsed(_beside(tokens, at, -1)), last=True):
        return END
    return EDGE


def _class(token: str) -> str:
    """A bracketed class, or a class escape, spelt out."""
    if token.startswith("["):
        inner = ""
        for part in _tokens_in_class(token[1:-1]):
            kind = part[1:] if part.startswith("\\") else ""
            inner += CLASSES[kind] if kind in CLASSES else f"[^{CLASSES[kind.lower()]}]" if kind.lower() in CLASSES else "\\[" if part == "[" else "\\&" if part == "&" else part
        return f"[{inner}]"
    kind = token[1]
    return f"[{CLASSES[kind]}]" if kind in CLASSES else f"[^{CLASSES[kind.lower()]}]"


def _tokens_in_class(text: str) -> list[str]:
    found, at = [], 0
    while at < len(text):
        end = at + 2 if text[at] == "\\" else at + 1
        found.append(text[at:end])
        at = end
    return found


def portable(pattern: str) -> str:
    """One pattern in the form that Java reads as Python reads the original."""
    tokens, found = _tokens(pattern), []
    for at, token in enumerate(tokens):
        if token == r"\b":
            found.append(_edge(tokens, at))
        elif token == r"\B":
            found.append(INSIDE)
        elif token.startswith("[") or token in (r"\w", r"\W", r"\d", r"\D", r"\s", r"\S"):
            found.append(_class(token))
        elif token == r"\Z":
            found.append(r"\z")
        else:
            found.append(token)
    return "".join(found)


def _has_alternatives(pattern: str) -> bool:
    depth = 0
    for token in _tokens(pattern):
        depth += (token == "(") - (token == ")")
        if token == "|" and depth == 0:
            return True
    return False


def portable_pattern(patterns: Iterable[str]) -> str:
    """Patterns joined into one that finds any of them.

    Patterns that begin with a word share the test for its start, which is then made once
    per position; one with alternatives of its own at the top is left as it is.
    ``(?d)`` lets ``.`` stop at line feeds only.
    """
    translated = [portable(p) for p in patterns]
    shared = [p.startswith(START) and not _has_alternatives(p) for p in translated]
    words = [p.removeprefix(START) for p, s in zip(translated, shared) if s]
    others = [f"(?:{p})" for p, s in zip(translated, shared) if not s]
    if words:
        others.insert(0, START + "(?:" + "|".join(f"(?:{w})" for w in words) + ")")
    return "(?d)" + "|".join(others)
