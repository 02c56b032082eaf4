"""Quality rules as weak supervision.

Every rule looks at a few statistics of a text and votes for good, votes for bad or
abstains. Expectation-maximisation estimates from the agreements alone how often each
rule is right and how many documents are good; the posterior probability of a document
then decides, so that one failed rule alone rejects nothing.

The statistics come from one pass over the whole texts. EM only needs how often each
combination of votes occurs: at most 3 to the number of rules rows reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from opinionlens.llm.common import add_from_text, utf8

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_top_word",
    "n_distinct_words",
    "n_odd_bytes",
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

# Bytes by kind: ASCII white space, continuation bytes of UTF-8, symbols, and ASCII
# characters that are neither letters nor common in prose.
_SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_SYMBOLS = np.isin(np.arange(256), list(SYMBOLS))
_ODD = (np.arange(256) < 128) & ~np.isin(
    np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;:!?'\"()-\n")
)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, until = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, until)
            until = at + 3
    return covered


def _statistics(column: pa.Array) -> Sequence[pa.Array]:
    content, offsets = utf8(column)

    def count(kind: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(kind[content], dtype=np.int64)])
        return np.diff(running[offsets])

    word_chars = np.diff(offsets) - count(_SPACES) - count(_CONTINUES)
    rows = np.zeros((6, len(column)), np.int64)
    for at, text in enumerate(column.cast(pa.binary()).to_pylist()):
        words = text.split() if text else []
        if not words:
            continue
        lines = [line for line in text.split(b"\n") if line.strip()]
        tally = Counter(words)
        rows[:, at] = (
            len(words),
            len(lines) - len(set(lines)),
            _repeat_words(words),
            len(lines),
            max(tally.values()),
            len(tally),
        )
    n_words, dup_lines, repeats, n_lines, top, distinct = rows
    found = (n_words, word_chars, count(_SYMBOLS), dup_lines, repeats, n_lines, top, distinct, count(_ODD))
    return [pa.array(x) for x in found]


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``STATISTICS``, all ``bigint`` and never null.

    A null or empty text has zeros throughout. Input columns of these names are replaced.
    """
    return add_from_text(docs, [StructField(n, LongType()) for n in STATISTICS], lambda: _statistics, text)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules by name: 1 votes for good, -1 for bad, 0 abstains."""
    words, per = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    mean_size = F.col("word_chars") / words
    repeats = F.col("n_repeat_words") / words
    symbols = F.col("n_symbols") / words
    copies = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    top, variety, odd = F.col("n_top_word") / words, F.col("n_distinct_words") / words, F.col("n_odd_bytes") / per
    return {
        "length": _vote(F.col("n_words") >= 80, F.col("n_words") < MIN_WORDS),
        "word_size": _vote(mean_size.between(3, 10), (mean_size < 2) | (mean_size > 14)),
        "repeats": _vote(repeats < 0.10, repeats > 0.30),
        "symbols": _vote(symbols < 0.02, symbols > 0.10),
        "copied_lines": _vote(copies < 0.05, copies > 0.30),
        "top_word": _vote(top < 0.12, top > 0.30),
        "variety": _vote((variety > 0.25) | (F.col("n_distinct_words") > 200), variety < 0.12),
        "odd_characters": _vote(odd < 0.03, odd > 0.15),
    }


def base_failed() -> Column:
    """Whether a text is too short or repeats itself over half its length."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class LabelModel:
    """How often each rule is right when it votes, and the share of good documents."""

    accuracy: Mapping[str, float]
    prior: float

    def posterior(self) -> Column:
        """Probability that a document is good, from the columns named like the rules."""
        score = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, right in self.accuracy.items():
            score = score + F.col(name) * F.lit(math.log(right / (1 - right)))
        return 1 / (1 + F.exp(-score))


def fit_label_model(
    votes: DataFrame, names: Sequence[str], iterations: int = 100, start: float = 0.8
) -> LabelModel:
    """Estimate accuracies and the share of good documents from all votes.

    Accuracies start at ``start`` and stay between 0.55 and 0.99: a rule is weak but
    never turned round. The share stays between 0.05 and 0.95. Without a row or a vote
    the start values are returned.
    """
    counted = votes.groupBy(*names).agg(F.count("*").alias("rows")).collect()
    table = np.array([[r[n] for n in names] for r in counted], float).reshape(len(counted), len(names))
    weight = np.array([r["rows"] for r in counted], float)
    accuracy, prior = np.full(len(names), start), 0.5
    voted = weight @ (table != 0) if len(counted) else np.zeros(len(names))
    for _ in range(iterations if weight.sum() else 0):
        score = table @ np.log(accuracy / (1 - accuracy)) + math.log(prior / (1 - prior))
        good = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        right = weight @ np.where(table > 0, good[:, None], np.where(table < 0, 1 - good[:, None], 0))
        # One vote each way beforehand keeps a rule that hardly ever votes at its start.
        fresh = np.clip((right + start) / (voted + 1), 0.55, 0.99)
        share = float(np.clip(weight @ good / weight.sum(), 0.05, 0.95))
        done = np.abs(fresh - accuracy).max() < 1e-9 and abs(share - prior) < 1e-9
        accuracy, prior = fresh, share
        if done:
            break
    return LabelModel(dict(zip(names, accuracy.tolist())), prior)


def judge(statistics: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``statistics`` with ``base_failed``, ``quality`` (the posterior) and ``kept``.

    ``statistics`` comes from :func:`add_statistics` and is read twice. Repeated rows are
    judged alike; an empty table stays empty.
    """
    named = {f"__rule_{n}": vote for n, vote in rules().items()}
    voted = statistics.withColumns(named)
    model = fit_label_model(voted.select(*named), list(named))
    columns = {"base_failed": base_failed(), "quality": model.posterior()}
    judged = voted.withColumns(columns).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    return judged.drop(*named)


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are judged good, with their own columns only.

    Texts are read twice, once for the label model and once for the verdict, and nothing
    is stored in between.
    """
    own = [F.col(c).alias(f"__own_{i}") for i, c in enumerate(docs.columns)]
    kept = judge(add_statistics(docs.select(*own, F.col(text).alias("__body")), "__body"), threshold).filter("kept")
    return kept.select(*[F.col(f"__own_{i}").alias(c) for i, c in enumerate(docs.columns)])
