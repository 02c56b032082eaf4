"""Word and hashtag-list tokens as native array expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions.text import ColumnOrName, column

# Greedy runs of three or more letters: the same tokens as splitting lower-cased
# text on non-letters and dropping the short pieces, in a single pattern pass.
WORD_PATTERN = "[a-z]{3,}"


def possible_words(words: Iterable[str]) -> list[str]:
    """The words that a token can equal, lower-cased and in order."""
    return sorted({w.lower() for w in words if re.fullmatch(WORD_PATTERN, w.lower())})


def stop_words(extra: Iterable[str] = K.EXTRA_STOPWORDS) -> list[str]:
    """Spark's English stop words plus ``extra``."""
    return possible_words([*K.ENGLISH_STOPWORDS, *extra])


def raw_words(c: ColumnOrName) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(column(c), F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))


def tokens(c: ColumnOrName, stops: Iterable[str] | None = None) -> Column:
    """Words of three letters or more without stop words, in order, repeats kept."""
    stops = stop_words() if stops is None else possible_words(stops)
    return F.filter(raw_words(c), lambda w: ~w.isin(stops)) if stops else raw_words(c)


def tag_pieces(c: ColumnOrName) -> Column:
    """Pieces of a hashtag list column: lower case, brackets and quotes as gaps."""
    cleaned = F.regexp_replace(F.lower(column(c)), r"[\[\]'\"{}]", " ")
    return F.split(cleaned, r"[,;\s]+")


def as_tag(piece: ColumnOrName) -> Column:
    piece = column(piece)
    return F.when(F.startswith(piece, F.lit("#")), piece).otherwise(F.concat(F.lit("#"), piece))
