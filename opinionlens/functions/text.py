"""Text cleaning as native column expressions (no UDF).

Patterns spell character classes out instead of using ``\\s`` / ``\\w`` / ``\\b``:
those mean different things in Java, RE2 and Python, and the Java meaning of
``\\b`` changes with the JDK. ``\\x{...}`` is understood by Java and RE2 alike.

Large classes cost Java a chain of tests per character, so most patterns open with
a negative look-ahead that turns common characters away in one or two.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions.classes import SPACE_CHARS, WORD_CHARS
from opinionlens.functions.composition import character, character_class, compose, constant_map, let
from opinionlens.functions.patterns import portable_pattern  # noqa: F401

ColumnOrName = Column | str

URL_PATTERN = rf"(?=[hw])(?:http|www)[^{SPACE_CHARS}]+"
# Runs of white space, but for a lone ordinary space, which is right already.
SPACES_PATTERN = rf"(?![!-~])(?: [{SPACE_CHARS}]+|(?! )[{SPACE_CHARS}]+)"
TAG_PATTERN = rf"#[{WORD_CHARS}]+"
EMOJI_PATTERN = (
    r"(?![\x{00}-\x{25FF}])["
    + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in sorted(K.EMOJI_RANGES))
    + "]+"
)
NOT_LATIN_PATTERN = rf"(?![A-Za-z0-9 ])[^À-ÖØ-öø-ÿ{SPACE_CHARS}]"


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_emojis(c: ColumnOrName) -> Column:
    return F.regexp_replace(column(c), EMOJI_PATTERN, "")


def strip_urls(c: ColumnOrName) -> Column:
    """Delete ``http...`` and ``www...`` up to the next white space, also inside a word."""
    return F.regexp_replace(column(c), URL_PATTERN, "")


def normalize_spaces(c: ColumnOrName) -> Column:
    return F.trim(F.regexp_replace(column(c), SPACES_PATTERN, " "))


def extract_tags(c: ColumnOrName) -> Column:
    """Hashtags in order of appearance, repeats kept, as ``array<string>``."""
    return F.regexp_extract_all(column(c), F.lit(TAG_PATTERN), F.lit(0))


def delete_tags(c: ColumnOrName) -> Column:
    return F.regexp_replace(column(c), TAG_PATTERN, "")


# --- text repair --------------------------------------------------------------

# windows-1252 characters that stand for the bytes 0x80..0x9F, and those bytes
# read as Latin-1. Built from the codec, which leaves five bytes undefined.
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
CP1252_CHARS = bytes(_CP1252_BYTES).decode("cp1252")
C1_CHARS = bytes(_CP1252_BYTES).decode("latin-1")

# UTF-8 bytes that were read as Latin-1 or windows-1252: two-byte letters, general
# punctuation and letter-like signs, and emoji. A single pair behind the leads of Latin
# Extended-A, Greek and Cyrillic could be meant as it stands; two in a row are damage.
_TRAIL = r"\x{80}-\x{BF}" + CP1252_CHARS
_RUN_LEADS = r"\x{C4}\x{C5}\x{CE}\x{CF}\x{D0}\x{D1}"
MOJIBAKE_PATTERN = (
    rf"\x{{C2}}[\x{{A0}}-\x{{BF}}]|\x{{C3}}[{_TRAIL}]|(?:[{_RUN_LEADS}][{_TRAIL}]){{2,}}"
    rf"|\x{{E2}}[\x{{80}}\x{{84}}€„][{_TRAIL}]"
    rf"|\x{{F0}}[\x{{9F}}Ÿ][{_TRAIL}]{{2}}"
)
_LEADS = r"\x{C2}\x{C3}\x{E2}\x{F0}" + _RUN_LEADS
SEGMENT_PATTERN = rf"({MOJIBAKE_PATTERN}|[^{_LEADS}]+|[{_LEADS}])"

# One-to-one replacements, built by rule: stray C1 bytes, curly quotes, full-width forms.
_CURLY = {chr(cp): "'" for cp in range(0x2018, 0x201C)} | {chr(cp): '"' for cp in range(0x201C, 0x2020)}
_CHAR_MAP = (
    {c1: _CURLY.get(ch, ch) for c1, ch in zip(C1_CHARS, CP1252_CHARS)}
    | _CURLY
    | {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
    | {"　": " "}
)
REPAIR_FROM, REPAIR_TO = "".join(_CHAR_MAP), "".join(_CHAR_MAP.values())

LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
# Named character references that end in a semicolon, from the standard library.
ENTITIES = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
ENTITY_SEGMENTS = r"(&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&)"

CONTROL_PATTERN = r"(?![ -~])[\x{00}-\x{08}\x{0B}\x{0E}-\x{1F}\x{7F}\x{206A}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFC}]"
LINE_BREAK_PATTERN = r"(?![ -~])(?:\r\n?|[\x{2028}\x{2029}])"

# What each repair step could act on. They open with what most texts are made of.
_PLAIN = r"(?![\n !-~])"
MOJIBAKE_HINT = rf"(?=[{_LEADS}])(?:{MOJIBAKE_PATTERN})"
REPLACED_PATTERN = r"(?![\x{0}-\x{7F}])[" + character_class([*_CHAR_MAP, *LIGATURES]) + "]"
ODD_PATTERN = _PLAIN + r"[\x{00}-\x{08}\x{0B}\x{0D}-\x{1F}\x{7F}\x{2028}\x{2029}\x{206A}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFC}]"
# Any character that some of them could act on.
SUSPECT_PATTERN = (
    r"(?![\n !-%'-~])[&\x{00}-\x{08}\x{0B}\x{0D}-\x{1F}\x{7F}-\x{9F}" + _LEADS + r"\x{2018}-\x{201F}\x{2028}\x{2029}"
    r"\x{206A}-\x{206F}\x{3000}\x{FB00}-\x{FB06}\x{FEFF}\x{FF01}-\x{FF5E}\x{FFF9}-\x{FFFC}]"
)


def _replace_all(c: Column, table: Mapping[str, str]) -> Column:
    for old, new in table.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for what is none."""
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, character(code)).otherwise("�")


def _unescape(c: Column) -> Column:
    """Named and numeric character references, also where their & was escaped again."""
    named = constant_map(ENTITIES)

    def decoded(segment: Column) -> Column:
        inside = F.substring(segment, 2, F.length(segment) - 2)
        digits = F.substring(inside, 2, F.length(inside))
        number = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, F.length(digits)), 16, 10))
        number = number.otherwise(digits).try_cast("bigint")
        reference = F.when(inside.startswith("#"), _character(number)).otherwise(F.coalesce(F.try_element_at(named, inside), segment))
        return F.when((F.length(segment) > 2) & segment.startswith("&"), reference).otherwise(segment)

    once = F.regexp_replace(c, "&(?:amp;)+", "&")
    segments = F.regexp_extract_all(once, F.lit(ENTITY_SEGMENTS), F.lit(1))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(segments, decoded), "")).otherwise(c)


def _undo_mojibake(c: Column) -> Column:
    def repair(segment: Column) -> Column:
        as_bytes = F.encode(F.translate(segment, CP1252_CHARS, C1_CHARS), "ISO-8859-1")
        return F.when(segment.rlike(f"^(?:{MOJIBAKE_PATTERN})$"), as_bytes.cast("string")).otherwise(segment)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(SEGMENT_PATTERN), F.lit(1)), repair), "")


def _where(pattern: str, step) -> Callable[[Column], Column]:
    """A step for texts that hold the pattern; others are left alone."""
    return lambda c: F.when(c.rlike(pattern), step(c)).otherwise(c)


_STEPS: tuple[Callable[[Column], Column], ...] = (
    # Entities are left alone in text that holds a "<": it may be markup.
    lambda c: F.when(F.contains(c, F.lit("&")) & ~F.contains(c, F.lit("<")), _unescape(c)).otherwise(c),
    _where(MOJIBAKE_HINT, _undo_mojibake),
    _where(REPLACED_PATTERN, lambda c: _replace_all(F.translate(c, REPAIR_FROM, REPAIR_TO), LIGATURES)),
    _where(ODD_PATTERN, lambda c: F.regexp_replace(F.regexp_replace(c, LINE_BREAK_PATTERN, "\n"), CONTROL_PATTERN, "")),
)


def repair_text(c: ColumnOrName) -> Column:
    """Undo common damage: HTML entities, mis-decoded UTF-8, stray control bytes,
    curly quotes, full-width forms, ligatures, odd line breaks, control characters,
    letters apart from their accents.

    Entities are left alone in text that holds a ``<``: it may be markup. Rows with
    nothing suspect pay for two pattern searches only, others for the steps that they need.
    """
    c = column(c)

    def repaired(c: Column) -> Column:
        for step in _STEPS:
            c = let(c, step)
        return let(c, compose)

    return F.when(c.rlike(SUSPECT_PATTERN), repaired(c)).otherwise(compose(c))


def strip_noise(c: ColumnOrName) -> Column:
    """URLs, emoji and surplus white space out, in that order."""
    return normalize_spaces(strip_emojis(strip_urls(c)))


def clean_text(c: ColumnOrName) -> Column:
    return strip_noise(repair_text(F.coalesce(column(c), F.lit(""))))


def keep_latin(c: ColumnOrName) -> Column:
    return F.regexp_replace(column(c), NOT_LATIN_PATTERN, "")


def clean_description(c: ColumnOrName) -> Column:
    """As :func:`clean_text`, then only Latin letters, digits and spaces; gaps stay."""
    return keep_latin(clean_text(c))


def clean_username(c: ColumnOrName) -> Column:
    return normalize_spaces(clean_description(c))


# --- pattern builders ---------------------------------------------------------


def keyword_pattern(keywords: Sequence[str]) -> str:
    """One pattern that finds any keyword standing as a whole word."""
    words = [k.lower() for k in keywords if k]
    if not words:
        raise ValueError("at least one keyword is needed")
    initials = "".join(sorted({re.escape(k[0]) for k in words}))
    alternatives = "|".join(re.escape(k) for k in words)
    return rf"(?=[{initials}])(?<![{WORD_CHARS}])(?:{alternatives})(?![{WORD_CHARS}])"


def mentions(c: ColumnOrName, keywords: Sequence[str]) -> Column:
    """True where the lower-cased text names any keyword."""
    return F.lower(column(c)).rlike(keyword_pattern(keywords))
