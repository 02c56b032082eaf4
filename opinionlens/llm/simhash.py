"""Near-duplicate texts by SimHash fingerprints.

Fingerprints are 64 bits; two texts are linked if theirs differ in at most a few. The
search embeds a fingerprint as the counts of set bits in segments of two bits, 32 small
numbers. Their Manhattan distance never exceeds the number of differing bits, so it is
a lower bound. The 32 coordinates are dealt to blocks, and the grid has one axis for
each choice of blocks that must be at distance zero when the whole distance is within
the limit; fingerprints meet where they share a cell. What meets is filtered by the
Manhattan distance and then by the exact number of differing bits.

Texts with equal fingerprints are one class from the start: a group of copies costs one
row in the search, however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from opinionlens.llm.common import add_from_text, store
from opinionlens.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
BLOCKS = 4
_LOW_BITS = 0x5555555555555555


def _fingerprint_factory(shingle_words: int):
    def compute(column: pa.Array) -> Sequence[pa.Array]:
        fingerprints = np.zeros(len(column), np.uint64)
        digest = xxhash.xxh64_digest
        for row, text in enumerate(column.cast(pa.binary()).to_pylist()):
            words = text.lower().split() if text else []
            if not words:
                continue
            joined = b" ".join(words)
            n = len(words) - shingle_words + 1
            if n < 2:
                hashes = digest(joined, SEED)
                n = 1
            else:
                sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
                ends = np.cumsum(sizes)
                starts = (ends - sizes)[:n].tolist()
                ends = (ends[shingle_words - 1 :] - 1).tolist()
                hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends)])
            bits = np.zeros(64, np.int64)
            packed = np.frombuffer(hashes, np.uint8).reshape(n, 8)
            for at in range(0, n, 4096):
                bits += np.unpackbits(packed[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
            fingerprints[row] = np.packbits(2 * bits > n).view(">u8")[0]
        return [pa.array(fingerprints.view(np.int64))]

    return lambda: compute


def add_fingerprints(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each whole text as a signed ``bigint``.

    Letters A-Z are lower-cased, words are runs of anything but ASCII white space, and
    shingles of ``shingle_words`` words count as often as they occur; a shorter text is
    one shingle. A bit is set if it is in over half of the shingles' XXH64. A null or
    empty text has fingerprint zero, which is linked like any other.
    """
    return add_from_text(docs, [StructField(name, LongType())], _fingerprint_factory(shingle_words), text)


def hex_of(fingerprint: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _embedding(fingerprint: str) -> Column:
    """Counts of set bits in the 32 two-bit segments, each written as 00, 01 or 11.

    In this unary form the Manhattan distance of two embeddings is the number of bits
    in which they differ.
    """
    x, low = F.col(fingerprint), F.lit(_LOW_BITS)
    shifted = F.shiftrightunsigned(x, 1)
    return x.bitwiseOR(shifted).bitwiseAND(low).bitwiseOR(F.shiftleft(x.bitwiseAND(shifted).bitwiseAND(low), 1))


def close_pairs(fingerprints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most ``max_bits`` bits.

    ``fingerprints`` has one ``bigint`` column without repeats. A pair may be given more
    than once. ``blocks`` must exceed ``max_bits``: with d differing bits at least
    ``blocks - d`` blocks of coordinates agree, and each choice of that many is an axis.
    """
    if not max_bits < blocks <= 32:
        raise ValueError("between max_bits + 1 and 32 blocks are needed")
    (name,) = fingerprints.columns
    masks = [0] * blocks
    for segment in range(32):
        masks[segment * blocks // 32] |= 3 << (2 * segment)
    axes = [_signed(sum(chosen)) for chosen in combinations(masks, blocks - max_bits)]
    embedded = fingerprints.select(F.col(name).alias("fp"), _embedding(name).alias("counts"))
    cells = embedded.select(
        "fp", "counts", F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(m)) for m in axes])).alias("axis", "cell")
    )
    left, right = cells.alias("l"), cells.alias("r")
    met = left.join(right, (F.col("l.axis") == F.col("r.axis")) & (F.col("l.cell") == F.col("r.cell")) & (F.col("l.fp") < F.col("r.fp")))
    bound = F.bit_count(F.col("l.counts").bitwiseXOR(F.col("r.counts"))) <= max_bits
    exact = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits
    return met.filter(bound & exact).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def classes(signed: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``fingerprint``, ``component_id`` (the smallest key of its component) and ``root``, which names it.

    ``signed`` has ``key`` and ``fingerprint`` and is read several times: store it first.
    Null keys do not count for the minimum; a component with null keys only has a null id.
    """
    own = signed.groupBy("fingerprint").agg(F.min(key).alias("least"))
    roots = components(close_pairs(own.select("fingerprint"), max_bits))
    rooted = own.join(roots, own["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fingerprint", "component_id", "root")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (hexadecimal) and ``component_id``.

    Repeated keys give one row each. See :func:`add_fingerprints` and :func:`classes`
    for null and empty values.
    """
    signed = store(add_fingerprints(docs.select(key, F.col(text).alias("__body")), "__body").select(key, "fingerprint"))
    found = classes(signed, key, max_bits)
    return signed.join(found, "fingerprint").select(key, hex_of("fingerprint").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest key.

    Of rows with equal keys and texts one stays; rows with a null key stay only if no
    other row of their component has a key, and then one of them.
    """
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("__own")
    named = F.struct(F.col(key).isNull().alias("missing"), F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"))
    signed = add_fingerprints(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("__body")), "__body")
    signed = store(signed.select("key", "fingerprint"))
    found = classes(signed, "key", max_bits)
    # One text of each component: that of its smallest key, and of these the smallest fingerprint.
    first = (
        signed.join(found, "fingerprint")
        .filter(F.col("key").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("fingerprint").alias("fingerprint"), F.first("key").alias("key"))
    )
    chosen = first.select("fingerprint", F.struct(F.col("key").isNull().alias("missing"), F.coalesce("key", F.lit(0)).alias("key")).alias("__key"))
    marked = add_fingerprints(docs.select(own, named.alias("__key"), F.col(text).alias("__body")), "__body")
    kept = marked.join(chosen, ["fingerprint", "__key"], "left_semi")
    return kept.dropDuplicates(["fingerprint", "__key"]).select("__own.*")
