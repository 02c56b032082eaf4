"""UTF-8 that was read in a wrong code page, undone by the reading of least cost.

Every code page gives one reading of a text: runs beyond ASCII whose bytes in the page are
valid UTF-8 are read anew, others stay. A character beyond ASCII costs one if it is a letter
that most languages with such letters use, and three if not. The cheapest reading is taken if
it saves at least two, and either leaves fewer characters that are no such letters or at most
two thirds of those beyond ASCII. This is repeated, so that damage on damage is undone as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionlens.functions.composition import character_class, let
from opinionlens.functions.text import ColumnOrName, column

PAGES = ("cp1252", "cp1251", "cp1250", "mac_roman", "cp437")
ROUNDS = 3
SAVED = 2
_HIGH = "".join(map(chr, range(0x80, 0x100)))
# Latin, Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, Vietnamese, kana, ideographs, Hangul.
USUAL_LETTERS = (
    r"À-ÖØ-öø-ÿĀ-ſΆ-ΊΌΎ-ΡΣ-ώЀ-џҐґ\x{5D0}-\x{5EA}\x{620}-\x{64A}\x{904}-\x{94D}\x{E01}-\x{E4E}\x{1E00}-\x{1EFF}"
    r"\x{3041}-\x{3096}\x{30A1}-\x{30FC}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}"
)
RUN_PATTERN = r"(?s)[^\x{0}-\x{7F}]+|[\x{0}-\x{7F}]+"


def page_letters(page: str) -> str:
    """The characters of the bytes from 0x80 on; a byte that the page leaves open stands for its control character."""
    found = []
    for b in range(0x80, 0x100):
        try:
            found.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            found.append(chr(b))
    return "".join(found)


def misread(c: ColumnOrName, page: str) -> Column:
    """The damage itself: the UTF-8 bytes of a text, each read as a character of the page."""
    as_letters = F.decode(F.encode(column(c), "UTF-8"), "ISO-8859-1")
    return F.translate(as_letters, _HIGH, page_letters(page))


def _beyond(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[\x{0}-\x{7F}]+", ""))


def _unusual(c: Column) -> Column:
    return F.length(F.regexp_replace(c, rf"[\x{{0}}-\x{{7F}}{USUAL_LETTERS}]+", ""))


def _cost(c: Column) -> Column:
    return _beyond(c) + 2 * _unusual(c)


def _reading(text: Column, page: str) -> Column:
    letters = page_letters(page)

    def read(run: Column) -> Column:
        content = F.encode(F.translate(run, letters, _HIGH), "ISO-8859-1")
        spelt = F.when(run.rlike(f"^[{character_class(letters)}]{{2,}}$"), F.try_validate_utf8(content.cast("string")))
        return F.coalesce(spelt, run)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(RUN_PATTERN), F.lit(0)), read), "")


def undo_misreading(c: ColumnOrName, pages: Sequence[str] = PAGES, rounds: int = ROUNDS) -> Column:
    """The text in its cheapest reading; null stays null.

    Of equally cheap ones the first page's is taken. A run that holds damaged and sound
    characters side by side is left as it is, and so is a lone pair of usual letters.
    """

    def once(text: Column) -> Column:
        def priced(reading: Column, at: int) -> Column:
            # A reading that saves just enough comes before the text itself.
            fits = (_unusual(reading) < _unusual(text)) | (3 * _beyond(reading) <= 2 * _beyond(text))
            return F.when(fits, F.struct((_cost(reading) + SAVED).alias("cost"), F.lit(at).alias("at"), reading.alias("text")))

        choices = [let(_reading(text, p), lambda r, k=k: priced(r, k)) for k, p in enumerate(pages)]
        own = F.struct(_cost(text).alias("cost"), F.lit(len(pages)).alias("at"), text.alias("text"))
        best = F.array_min(F.array(*choices, own))["text"]
        return F.when(text.rlike(r"[^\x{0}-\x{7F}]{2}"), best).otherwise(text)

    fixed = column(c)
    for _ in range(rounds):
        fixed = let(fixed, once)
    return fixed
