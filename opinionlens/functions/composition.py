"""Canonical composition (NFC) as native column expressions.

A text is cut in front of characters that stay as they are and combine with nothing before
them; each part is normalised by itself: characters are taken apart, marks are put in the
order of their combining classes, and letters and marks are joined again, any number of
them. Hangul syllables follow by arithmetic. All tables come from the standard library.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_SYLLABLES, _LEADS, _VOWELS, _TRAILS = 0xAC00, 0x1100, 0x1161, 0x11A7
_VOWEL_COUNT, _TRAIL_COUNT, _SYLLABLE_COUNT = 21, 28, 11172


class Tables(NamedTuple):
    apart: dict[str, str]  # characters and what they are made of, but for Hangul
    order: dict[str, int]  # marks and their combining classes
    pairs: dict[str, str]  # two characters and the one that they make
    active: str  # all that does not stand alone, as a class of a pattern
    marks: str


def character_class(chars: Iterable[str]) -> str:
    """The inside of a pattern's class for the characters, as ranges."""
    ranges: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "".join(rf"\x{{{a:X}}}" + (rf"-\x{{{b:X}}}" if b > a else "") for a, b in ranges)


@cache
def tables() -> Tables:
    every = [chr(cp) for cp in (*range(0xD800), *range(0xE000, sys.maxunicode + 1)) if not _SYLLABLES <= cp < _SYLLABLES + _SYLLABLE_COUNT]
    apart = {c: unicodedata.normalize("NFD", c) for c in every if not unicodedata.is_normalized("NFD", c)}
    order = {c: unicodedata.combining(c) for c in every if unicodedata.combining(c)}
    pairs = {}
    for c in apart:
        parts = "".join(chr(int(x, 16)) for x in unicodedata.decomposition(c).split())
        if len(parts) == 2 and unicodedata.normalize("NFC", parts) == c:
            pairs[parts] = c
    hangul = [chr(cp) for cp in (*range(_VOWELS, _VOWELS + _VOWEL_COUNT), *range(_TRAILS + 1, _TRAILS + _TRAIL_COUNT))]
    active = {*order, *(p[1] for p in pairs), *hangul, *(c for c in apart if not unicodedata.is_normalized("NFC", c))}
    return Tables(apart, order, pairs, character_class(active), character_class(order))


def constant_map(table: dict[str, str]) -> Column:
    """A constant map, from one literal: thousands of them would slow down the planner."""
    pairs = "\x02".join(f"{old}\x01{new}" for old, new in table.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))


def character(code: Column) -> Column:
    """The character of a valid code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _letters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def _taken_apart(c: Column) -> Column:
    apart = constant_map(tables().apart)

    def syllable(c: Column) -> Column:
        at = F.ascii(c) - _SYLLABLES
        trail = at % _TRAIL_COUNT
        lead, vowel = F.floor(at / (_VOWEL_COUNT * _TRAIL_COUNT)), F.floor(at % (_VOWEL_COUNT * _TRAIL_COUNT) / _TRAIL_COUNT)
        return F.concat(character(lead + _LEADS), character(vowel + _VOWELS), F.when(trail > 0, character(trail + _TRAILS)).otherwise(""))

    def one(c: Column) -> Column:
        return F.when(c.between("가", "힣"), syllable(c)).otherwise(F.coalesce(F.try_element_at(apart, c), c))

    return F.array_join(F.transform(_letters(c), one), "")


def _class(order: Column, c: Column) -> Column:
    return F.coalesce(F.try_element_at(order, c).cast("int"), F.lit(0))


def _ordered(c: Column) -> Column:
    """Marks behind each letter by class; those of one class stay in their order."""
    order, marks = constant_map({m: str(x) for m, x in tables().order.items()}), tables().marks

    def run(letters: Column) -> Column:
        keyed = F.transform(_letters(letters), lambda m, i: F.struct(_class(order, m).alias("class"), i.alias("at"), m.alias("mark")))
        return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["mark"]), "")

    runs = F.regexp_extract_all(c, F.lit(f"(?s)[^{marks}][{marks}]*|[{marks}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(F.length(r) > 1, run(r)).otherwise(r)), "")


def _joined(c: Column) -> Column:
    """Letters and marks, which are in order, put together from left to right."""
    pairs, order = constant_map(tables().pairs), constant_map({m: str(x) for m, x in tables().order.items()})
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("letter"), F.lit("").alias("behind"), F.lit(256).alias("last"))

    def made_of(a: Column, b: Column) -> Column:
        syllable = character(((F.ascii(a) - _LEADS) * _VOWEL_COUNT + F.ascii(b) - _VOWELS) * _TRAIL_COUNT + _SYLLABLES)
        longer = character(F.ascii(a) + F.ascii(b) - _TRAILS)
        return (
            F.when(a.between("ᄀ", "ᄒ") & b.between("ᅡ", "ᅵ"), syllable)
            .when(a.between("가", "힣") & b.between("ᆨ", "ᇂ") & ((F.ascii(a) - _SYLLABLES) % _TRAIL_COUNT == 0), longer)
            .otherwise(F.try_element_at(pairs, F.concat(a, b)))
        )

    def step(state: Column, mark: Column) -> Column:
        def with_class(known: Column) -> Column:
            new, own = known["new"], known["own"]
            joins = new.isNotNull() & ((state["last"] < own) | (state["last"] == 0))
            starts = ~joins & (own == 0)
            return F.struct(
                F.when(starts, F.concat(state["done"], state["letter"], state["behind"])).otherwise(state["done"]).alias("done"),
                F.when(joins, new).when(starts, mark).otherwise(state["letter"]).alias("letter"),
                F.when(joins, state["behind"]).when(starts, "").otherwise(F.concat(state["behind"], mark)).alias("behind"),
                F.when(joins, state["last"]).otherwise(own).alias("last"),
            )

        return let(F.struct(made_of(state["letter"], mark).alias("new"), _class(order, mark).alias("own")), with_class)

    return F.aggregate(_letters(c), start, step, lambda s: F.concat(s["done"], s["letter"], s["behind"]))


def needs_composition(c: Column) -> Column:
    """Whether any character does not stand alone; all below U+0300 do."""
    return c.rlike(rf"(?![\x{{0}}-\x{{2FF}}\x{{2010}}-\x{{2027}}\x{{4E00}}-\x{{9FFF}}])[{tables().active}]")


def compose(c: Column) -> Column:
    """The text in canonical composition."""
    known = tables()
    pairs, active = constant_map(known.pairs), known.active
    pattern = F.lit(f"(?s)[^{active}]?[{active}]+|[^{active}]+(?=[^{active}][{active}])|[^{active}]+")

    def whole(part: Column) -> Column:
        full = let(let(_taken_apart(part), _ordered), _joined)
        short = F.coalesce(F.when(F.length(part) == 2, F.try_element_at(pairs, part)), full)
        return F.when(part.rlike(f"[{active}]$"), short).otherwise(part)

    def fine(run: Column) -> Column:
        parts = F.array_join(F.transform(F.regexp_extract_all(run, pattern, F.lit(0)), whole), "")
        return F.when(needs_composition(run), parts).otherwise(run)

    # All below U+0300 stand alone: texts are cut there first, by a class that costs little.
    low, high = r"[\x{0}-\x{2FF}]", r"[\x{300}-\x{10FFFF}]"
    coarse = F.lit(f"{low}?{high}+|{low}+(?={low}{high})|{low}+")
    return F.when(needs_composition(c), F.array_join(F.transform(F.regexp_extract_all(c, coarse, F.lit(0)), fine), "")).otherwise(c)
