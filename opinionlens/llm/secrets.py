"""Secrets in texts, found with the help of a trigram index.

A Boolean query over trigrams is derived from each rule's pattern: every match must
hold certain strings of three letters. The index keeps, for the trigrams that the
queries name, which texts hold them; as texts stay where they are, the postings are kept
with the rows, one bit per trigram. Intersecting and uniting postings is bit arithmetic,
and only candidates are searched with the pattern. A rule whose pattern has no mandatory
trigram scans every text.

Everything here is native expressions; nothing is shuffled.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 64  # alternatives that the analysis of a pattern keeps apart


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long one group of a match must be at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]+", least=36),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment_key", r"sk_live_[0-9A-Za-z]+", least=24),
)
RULES = BASE_RULES + MORE_RULES


# --- trigram queries ----------------------------------------------------------
# A query is None (any text), a trigram, or ("and" | "or", parts).


def _all_of(parts) -> object:
    found = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not found else found[0] if len(found) == 1 else ("and", tuple(found))


def _any_of(parts) -> object:
    parts = list(dict.fromkeys(parts))
    if not parts or None in parts:
        return None
    # What asks for more than another alternative adds nothing.
    asked = [set(trigrams_of(p)) if isinstance(p, str) or p[0] == "and" else None for p in parts]
    parts = [p for p, own in zip(parts, asked) if own is None or not any(o is not None and o < own for o in asked)]
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _holding(strings: set[str]) -> object:
    """The query for texts that hold one of the strings."""
    return _any_of(
        [_all_of([s[i : i + 3] for i in range(len(s) - 2)]) if len(s) > 2 else None for s in sorted(strings)]
    )


def _letters(items) -> set[str] | None:
    """The characters of a small class, or None."""
    found = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value))
        elif op is sre.RANGE and value[1] - value[0] < 8:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _analyse(nodes) -> tuple[set[str] | None, object]:
    """Exactly which strings the nodes match, if these are few, and else their query."""
    exact, queries = {""}, []

    def join(strings: set[str] | None, query: object) -> None:
        nonlocal exact
        queries.append(query)
        if strings is not None and len(exact) * len(strings) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
        else:
            queries.append(_holding(exact))
            if strings is not None:
                queries.append(_holding(strings))
            exact = {""}
            broken.append(True)

    broken: list[bool] = []
    for op, value in nodes:
        if op is sre.LITERAL:
            join({chr(value).lower()}, None)
        elif op is sre.IN:
            letters = _letters(value)
            join(letters and {c.lower() for c in letters}, None)
        elif op is sre.SUBPATTERN:
            join(*_analyse(value[3]))
        elif op is sre.BRANCH:
            parts = [_analyse(part) for part in value[1]]
            if all(strings is not None for strings, _ in parts):
                join(set().union(*[strings for strings, _ in parts]), None)
            else:
                join(None, _any_of([q if s is None else _holding(s) for s, q in parts]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            strings, query = _analyse(inner)
            if (least, most) == (0, 1) and strings is not None:
                join(strings | {""}, None)
            elif least == most and strings is not None and len(strings) == 1:
                join({next(iter(strings)) * least}, None)
            else:
                join(None, (query if strings is None else _holding(strings)) if least else None)
        else:  # anchors, any character, classes of their own: nothing is known
            join(None, None)
    if broken:
        return None, _all_of([*queries, _holding(exact)])
    return exact, None


def trigram_query(pattern: str) -> object:
    """A query over lower-case trigrams that every text with a match satisfies."""
    exact, query = _analyse(sre_parser.parse(pattern))
    return query if exact is None else _holding(exact)


def trigrams_of(query: object) -> list[str]:
    if query is None:
        return []
    return [query] if isinstance(query, str) else sorted({t for part in query[1] for t in trigrams_of(part)})


class TrigramIndex:
    """Postings of the trigrams that some rules name, kept beside the texts."""

    WORD = 60

    def __init__(self, rules: Sequence[Rule]):
        self.queries = {r.kind: trigram_query(r.pattern) for r in rules}
        named = sorted({t for q in self.queries.values() for t in trigrams_of(q)})
        self.place = {t: i for i, t in enumerate(named)}

    def postings(self, text: Column) -> Column:
        """The trigrams that a text holds, as an array of ``bigint`` with one bit each."""
        words = []
        for start in range(0, len(self.place), self.WORD):
            bits = [
                F.when(F.contains(text, F.lit(t)), 1 << (i - start)).otherwise(0).cast("bigint")
                for t, i in self.place.items()
                if start <= i < start + self.WORD
            ]
            words.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
        return F.array(*words) if words else F.array(F.lit(0).cast("bigint"))

    def candidates(self, kind: str, postings: Column) -> Column:
        def holds(query: object) -> Column:
            if query is None:
                return F.lit(True)
            if isinstance(query, str):
                i = self.place[query]
                return postings[i // self.WORD].bitwiseAND(F.lit(1 << (i % self.WORD)).cast("bigint")) != 0
            parts = [holds(p) for p in query[1]]
            return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), parts)

        return holds(self.queries[kind])


# --- spans --------------------------------------------------------------------


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Start, order, end and kind of the rule's matches, leftmost and not overlapping.

    The text between the matches and the matches take turns, so that their lengths in
    code points add up to the positions. A match that is too short is dropped only after
    it has taken its place.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.transform(matches, F.length)
    judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else sizes
    steps = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(matches)), F.length).alias("gap"), sizes.alias("size"), judged.alias("judged")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        end = begin + one["size"]
        span = F.struct(
            begin.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        long_enough = one["judged"] >= rule.least
        spans = F.when(long_enough, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(steps, start, step, lambda state: state["spans"])


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def find_secrets(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, spans: str = "spans") -> DataFrame:
    """``docs`` with the array column ``spans`` of all secrets of each whole text.

    A span has ``start`` and ``end`` (code points, end exclusive), its ``kind`` and the
    ``order`` of its rule; the array is sorted by start, then by the rules' order. A null
    or empty text has no span. Spans of different kinds may overlap. A column already
    called ``spans`` is replaced.
    """
    index = TrigramIndex(rules)
    kept = [c for c in docs.columns if c.lower() != spans.lower()]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    searched = docs.select(*[F.col(c) for c in kept], body.alias("__body"))
    searched = searched.withColumn("__postings", index.postings(F.lower("__body")))
    none = F.array().cast(SPANS)
    found = []
    for order, rule in enumerate(rules):
        candidate = index.candidates(rule.kind, F.col("__postings"))
        # For a plain run of characters a search for one that is long enough comes first.
        shortest = _long_enough(rule)
        if shortest:
            candidate = candidate & F.col("__body").rlike(shortest)
        found.append(F.when(candidate, _spans(F.col("__body"), rule, order)).otherwise(none))
    return searched.withColumn(spans, F.array_sort(F.concat(*found))).drop("__body", "__postings")


def _long_enough(rule: Rule) -> str | None:
    """For a pattern that ends in ``+``, one that finds a whole match of the least length."""
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.group == 0 and _is_run(rule.pattern) else None


def _is_run(pattern: str) -> bool:
    """Whether a pattern is one character class, repeated."""
    nodes = sre_parser.parse(pattern)
    return len(nodes) == 1 and nodes[0][0] is sre.MAX_REPEAT and pattern.endswith("]+")


def joined(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced together, by the kind of the first. Texts without a
    secret, null ones too, are left as they are.
    """
    marked = find_secrets(docs, text, rules, "__spans")
    body = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        new = F.concat(
            state["parts"],
            F.array(
                F.substring(body, state["at"] + 1, span["start"] - state["at"]),
                F.concat(F.lit("["), span["kind"], F.lit("]")),
            ),
        )
        parts = F.when(span["start"] >= state["at"], new).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(body, state["at"] + 1, F.length(body)))

    clean = F.aggregate("__spans", start, step, finish)
    own = [F.when(F.size("__spans") > 0, clean).otherwise(body).alias(c) if c == text else F.col(c) for c in docs.columns]
    return marked.select(*own)
