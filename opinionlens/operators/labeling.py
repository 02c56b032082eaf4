"""Stance labels: explicit rules first, then an optional batch model."""

from __future__ import annotations

import string
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import text as tx
from opinionlens.functions import values as v
from opinionlens.functions.text import ColumnOrName, column
from opinionlens.schema import require_columns

PredictBatch = Callable[[list[str]], list[str]]
# Errors of a model that is away for the moment. Any other one is a fault and stops the job.
RETRYABLE: tuple[type[Exception], ...] = (OSError,)

PROMPT = """Decide which side the author of a social post supports.

Reply with a single character:
1 = the author favours side A or attacks side B
0 = the author favours side B or attacks side A
N = no clear side: plain news, an unclear joke, spam, or too little to go by

Naming a side or using its hashtag is not support in itself. When the text and
the hashtags disagree, go by the text.

Post: {text}
Hashtags: {hashtags}
Reply:"""


def rule_label(
    text: ColumnOrName,
    tags: ColumnOrName,
    neg_patterns: Sequence[str] = K.NEG_PATTERNS,
    pos_patterns: Sequence[str] = K.POS_PATTERNS,
) -> Column:
    """0 where a negative pattern is found, else 1 where a positive one is, else null."""
    content = F.lower(
        F.concat(F.coalesce(column(text), F.lit("")), F.lit(" "), F.coalesce(column(tags), F.lit("")))
    )
    return F.when(content.rlike(tx.portable_pattern(neg_patterns)), 0).when(
        content.rlike(tx.portable_pattern(pos_patterns)), 1
    )


def build_prompt(text: ColumnOrName, tags: ColumnOrName, template: str = PROMPT) -> Column:
    """``template`` with ``{text}`` and ``{hashtags}`` filled in; no hashtags become a word."""
    tags = F.coalesce(column(tags), F.lit(""))
    fields = {
        "text": F.coalesce(column(text), F.lit("")),
        "hashtags": F.when(tags == "", K.NO_TAGS_WORD).otherwise(tags),
    }
    parts = []
    for literal, field, _, _ in string.Formatter().parse(template):
        parts.append(F.lit(literal))
        if field is not None:
            parts.append(fields[field])
    return F.concat(*parts)


def parse_answer(answer: ColumnOrName) -> Column:
    """1 or 0 from a reply such as ``1`` or ``Answer: 0``, null for N or anything else.

    The character must stand alone, so neither the N of ANSWER nor the digits of 10 count.
    """
    found = F.regexp_extract(F.upper(F.trim(column(answer))), r"(?<![0-9A-Z])([01N])(?![0-9A-Z])", 1)
    return F.when(found == "1", 1).when(found == "0", 0)


def model_answers(
    predict_batch: PredictBatch,
    batch_size: int = 64,
    retries: int = K.MODEL_RETRIES,
    backoff: float = K.MODEL_BACKOFF_SECONDS,
    retryable: tuple[type[Exception], ...] = RETRYABLE,
    give_up: bool = True,
    in_flight: int = 1,
    per_second: float | None = None,
    deadline: float | None = None,
):
    """A vectorised function from prompts to replies.

    Up to ``in_flight`` calls of a task overlap, in threads, and at most ``per_second`` start
    in a second; replies keep the order of the prompts. ``deadline`` bounds the seconds that
    the prompts of one Arrow batch take: calls under way end, later ones count as failed.

    Null prompts are not asked. A batch is tried again after an error among ``retryable``
    (connection errors and time-outs are) or too few replies; other errors are raised at
    once. If it still fails after ``retries`` tries, its replies are null, which a later
    run may ask again, or with ``give_up=False`` the task fails.
    """

    def ask(prompts: list[str], turn: Callable[[], None], latest: float | None) -> list[str | None]:
        for attempt in range(1, retries + 1):
            try:
                turn()
                if latest is not None and time.monotonic() > latest:
                    raise TimeoutError("the time for a batch is over")
                replies = list(predict_batch(prompts))
                if len(replies) != len(prompts):
                    raise ConnectionError(f"{len(replies)} replies to {len(prompts)} prompts")
                return replies
            except (*retryable, ConnectionError, TimeoutError):
                if attempt < retries and (latest is None or time.monotonic() < latest):
                    time.sleep(backoff * attempt)
                elif not give_up:
                    raise
                else:
                    break
        return [None] * len(prompts)

    @F.pandas_udf("string")
    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lock, free_at = Lock(), [0.0]

        def turn() -> None:
            """Wait until the task may call again."""
            if per_second is None:
                return
            with lock:
                start = max(free_at[0], time.monotonic())
                free_at[0] = start + 1 / per_second
            time.sleep(max(0.0, start - time.monotonic()))

        with ThreadPoolExecutor(in_flight) as pool:
            for prompts in batches:
                out = pd.Series([None] * len(prompts), dtype=object)
                asked = [i for i, prompt in enumerate(prompts) if prompt is not None]
                parts = [asked[start : start + batch_size] for start in range(0, len(asked), batch_size)]
                latest = None if deadline is None else time.monotonic() + deadline
                calls: deque = deque()
                for places in parts:
                    # At most ``in_flight`` calls are under way; replies are taken in order.
                    if len(calls) == in_flight:
                        done, call = calls.popleft()
                        out.iloc[done] = call.result()
                    calls.append((places, pool.submit(ask, [prompts.iloc[i] for i in places], turn, latest)))
                for done, call in calls:
                    out.iloc[done] = call.result()
                yield out

    return replies.asNondeterministic()


def label_posts(
    posts: DataFrame,
    predict_batch: PredictBatch | None = None,
    *,
    relabel: bool = False,
    neg_patterns: Sequence[str] = K.NEG_PATTERNS,
    pos_patterns: Sequence[str] = K.POS_PATTERNS,
    template: str = PROMPT,
    **model_options,
) -> DataFrame:
    """Fill ``binary_label``: a label already there, else the rules, else the model.

    ``label_status`` tells which one decided (kept, rule, model), that the model
    saw no side (neutral) or failed (error), or that nobody was asked (pending).
    One pass without a shuffle; only the prompts of undecided posts leave the JVM.
    """
    require_columns(posts, ["text"], "posts to label")
    tags = F.col("hashtags") if "hashtags" in posts.columns else F.lit("")
    has_label = "binary_label" in posts.columns and not relabel
    kept = v.label_value("binary_label") if has_label else F.lit(None).cast("int")

    work = posts.withColumn("_kept", kept)
    rule = rule_label("text", tags, neg_patterns, pos_patterns)
    work = work.withColumn("_rule", F.when(F.col("_kept").isNull(), rule))
    decided = F.coalesce("_kept", "_rule")
    status = F.when(F.col("_kept").isNotNull(), "kept").when(F.col("_rule").isNotNull(), "rule")
    if predict_batch is None:
        label, status = decided, status.otherwise("pending")
    else:
        reply = model_answers(predict_batch, **model_options)
        work = work.withColumn("_reply", reply(F.when(decided.isNull(), build_prompt("text", tags, template))))
        work = work.withColumn("_model", parse_answer("_reply"))
        label = F.coalesce("_kept", "_rule", "_model")
        status = (
            status.when(F.col("_reply").isNull(), "error")
            .when(F.col("_model").isNotNull(), "model")
            .otherwise("neutral")
        )
    return work.withColumns({"binary_label": label, "label_status": status}).drop(
        "_kept", "_rule", "_reply", "_model"
    )


def still_to_label(
    posts: DataFrame, done: DataFrame, key: str | Sequence[str], retry: Sequence[str] = ("error", "pending")
) -> DataFrame:
    """Posts that a resumed batch run has to label: neutral ones are not asked again."""
    keys = [key] if isinstance(key, str) else list(key)
    settled = done.filter(~F.col("label_status").isin(list(retry))).select(*keys)
    return posts.join(settled, keys, "left_anti")
