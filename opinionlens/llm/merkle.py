"""A Merkle manifest of a table: a tree for each group of rows and one over all groups.

Leaves of a group are ordered by key. Every ``RUN`` consecutive nodes become one of the
level above, until one is left, the group's root; the roots of the groups, in order, are the
leaves of the last tree. A proof of a leaf has the other nodes of its run on each level, up
to the root.

Proofs are made by octopus multiproofs. The leaves of a group are dealt out in blocks of
consecutive ones. A block works out which nodes it lacks: on each level those in the runs
that its known nodes are in, but for the known ones themselves. As whole runs give their
parents, this union over all its leaves is minimal. It fetches these nodes once, derives the
interiors that its proofs share, and expands the proof of each leaf by itself. No task holds
more than a block and the few nodes it lacks, however large a group is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from opinionlens.llm.common import others, small_batches, store

RUN = 16
BLOCK_LEVELS = 3  # a block has RUN ** BLOCK_LEVELS leaves
ROWS_AT_ONCE = 1024  # of a block, whose proofs are written out together
TOP = ""  # the name of the tree over all groups; those of groups are not empty
_PLACE = ("index", "n_leaves", "group_index", "n_groups")


def digest_of(columns: Sequence[Column]) -> Column:
    """The hash of a row: its values, each with its size in bytes, in one text. Null is ``-``."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# --- coordinates ----------------------------------------------------------------


def level_sizes(leaves: int) -> list[int]:
    """The number of nodes of each level that has more than one."""
    sizes = []
    while leaves > 1:
        sizes.append(leaves)
        leaves = -(-leaves // RUN)
    return sizes


def missing_nodes(known: np.ndarray, leaves: int) -> list[np.ndarray]:
    """For each level of a tree, the nodes that are needed to prove all ``known`` leaves, and cannot be derived.

    ``known`` are distinct numbers of leaves; they need not be consecutive.
    """
    found = []
    for size in level_sizes(leaves):
        runs = np.unique(known // RUN)
        needed = (runs[:, None] * RUN + np.arange(RUN)).ravel()
        found.append(np.setdiff1d(needed[needed < size], known, assume_unique=True))
        known = runs
    return found


def _parents(nodes: dict[int, bytes], size: int) -> tuple[dict[int, bytes], dict[int, bytes]]:
    """The parents of whole runs of hexadecimal digests, and each run as one text."""
    runs = {}
    for run in sorted({i // RUN for i in nodes}):
        runs[run] = b"".join([nodes[i] for i in range(run * RUN, min(run * RUN + RUN, size))])
    return {run: hashlib.sha256(text).hexdigest().encode() for run, text in runs.items()}, runs


def _derived(known: dict[int, bytes], fetched: list[dict[int, bytes]], leaves: int) -> tuple[list[tuple], bytes]:
    """The known nodes and their runs on each level, from known leaves and fetched nodes, and the root."""
    levels = []
    for size, more in zip(level_sizes(leaves), fetched):
        parents, runs = _parents({**known, **more}, size)
        levels.append((known, runs))
        known = parents
    (root,) = known.values()
    return levels, root


def _proofs(levels: list[tuple], above: bytes) -> dict[int, bytes]:
    """The siblings of each known leaf, up to the root of its tree, followed by ``above``."""
    tails = {0: above}
    for known, runs in reversed(levels):
        below = {}
        for i in known:
            text, at = runs[i // RUN], i % RUN * 64
            below[i] = text[:at] + text[at + 64 :] + tails[i // RUN]
        tails = below
    return tails


def fold(leaf: str, proof: bytes, places: Sequence[tuple[int, int]]) -> str:
    """The root that a leaf and a proof lead to; ``places`` are number and size of each tree."""
    siblings, at = proof.hex().encode(), 0
    known = leaf.encode()
    for index, leaves in places:
        for size in level_sizes(leaves):
            run = min(RUN, size - index // RUN * RUN)
            before, after = at + index % RUN * 64, at + (run - 1) * 64
            known = hashlib.sha256(siblings[at:before] + known + siblings[before:after]).hexdigest().encode()
            at, index = after, index // RUN
    return known.decode()


# --- tables ---------------------------------------------------------------------


def _name(group: Column) -> Column:
    """A text that orders like the group, null first, by bytes, and is never null or empty."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored ``rows`` with ``__i``, their number within ``__tree``, and ``__n``, how many it has.

    Ranges of all rows are sorted by themselves; only their bounds are counted up. The end of
    ``order`` must tell equal rows apart, so that no range holds all copies of one.
    """
    keys = ["__tree", *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = store(placed.withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    bounds = placed.groupBy("__tree", "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy("__tree")
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).withColumn("__n", F.sum("__rows").over(whole))
    found = placed.join(bounds, ["__tree", "__range"])
    return found.withColumn("__i", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__range", "__first", "__rows", "__before")


_NODE = ["__tree", "__level", "__i", "__n", "__hash"]


def _raised(nodes: DataFrame) -> DataFrame:
    """``nodes`` of one level of each tree, stored, and all above them; ``__n`` is the size of a node's level."""
    found, current = nodes, nodes
    while True:
        current = current.filter("__n > 1")
        (most,) = current.agg(F.max("__n")).first()
        if most is None:
            return found
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__hash"))), lambda x: x["__hash"])
        above = current.groupBy("__tree", "__level", F.floor(F.col("__i") / RUN).cast("bigint").alias("__up"), "__n").agg(
            F.sha2(F.array_join(ordered, "").cast("binary"), 256).alias("__hash")
        )
        current = store(
            above.select("__tree", (F.col("__level") + 1).alias("__level"), F.col("__up").alias("__i"), F.ceil(F.col("__n") / RUN).cast("bigint").alias("__n"), "__hash")
        )
        found = found.unionAll(current)


def _by_block(batches: Iterator[pa.RecordBatch], tree: int, block: int) -> Iterator[pa.Table]:
    """Tables of the rows of one block each, from rows that are sorted by tree and block."""
    waiting: list[pa.RecordBatch] = []

    def last(batch: pa.RecordBatch, row: int) -> tuple:
        return batch.column(tree)[row].as_py(), batch.column(block)[row].as_py()

    for batch in batches:
        if not len(batch):
            continue
        numbers, trees = batch.column(block).to_numpy(), batch.column(tree)
        change = numbers[1:] != numbers[:-1]
        if not trees[0].equals(trees[-1]):
            change |= np.array(trees.slice(1).to_pylist(), object) != np.array(trees.slice(0, len(batch) - 1).to_pylist(), object)
        borders = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        for start, end in zip(borders, borders[1:]):
            part = batch.slice(start, end - start)
            if waiting and last(waiting[-1], len(waiting[-1]) - 1) != last(part, 0):
                yield pa.Table.from_batches(waiting)
                waiting.clear()
            waiting.append(part)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _own_proofs(numbers: Sequence[int], levels: list[tuple], upper: dict[int, bytes]) -> Iterator[bytes]:
    """The proofs of some leaves, from their runs and the proofs of what is above these."""
    if not levels:
        yield from (upper[0] for _ in numbers)
        return
    runs = levels[0][1]
    for i in numbers:
        text, at = runs[i // RUN], i % RUN * 64
        yield bytes.fromhex((text[:at] + text[at + 64 :] + upper[i // RUN]).decode())


def prove(
    leaves: DataFrame, key: str = "doc_id", group: str = "source", leaf: str = "leaf", presented: str | None = None, folded: str = "folded_root"
) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and the proof of each row.

    ``leaf`` holds lower-case hexadecimal digests. A group's leaves ascend by ``key``, null
    first; rows with equal keys by leaf, so equal rows are leaves of their own side by side.
    Groups are ordered as texts by bytes, null first, and null is a group. ``proof`` has the
    siblings' digests in 32 bytes each, from the leaf's run to the root's, left to right;
    ``index`` of ``n_leaves`` and ``group_index`` of ``n_groups`` tell where the leaf stands.
    An empty table gives no rows. All columns are kept; those called like a new one are replaced.

    With ``presented``, a column of digests, the column ``folded`` is what :func:`verify` finds
    for them, in the same pass.
    """
    small_batches(leaves.sparkSession)
    new = ["subroot", "root", *_PLACE, "proof", *([folded] if presented else [])]
    kept = others(leaves, new)
    rows = leaves.select(*kept, _name(F.col(group)).alias("__tree"), F.monotonically_increasing_id().alias("__salt"))
    numbered = _numbered(store(rows), [key, leaf, "__salt"]).drop("__salt")
    most = RUN**BLOCK_LEVELS
    numbered = numbered.withColumn("__block", F.floor(F.col("__i") / most).cast("bigint"))
    dealt = store(numbered.repartition("__tree", "__block").sortWithinPartitions("__tree", "__block", "__i"))

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_block(batches, 0, 1):
            n = part["n"][0].as_py()
            nodes, level = dict(zip(part["i"].to_pylist(), (h.encode() for h in part["leaf"].to_pylist()))), 0
            for level, size in enumerate(level_sizes(n)[:BLOCK_LEVELS], 1):
                nodes, _ = _parents(nodes, size)
                n = -(-size // RUN)
            ((i, found),) = nodes.items()
            row = [[part["tree"][0].as_py()], [level], [i], [n], [found.decode()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()))], _NODE)

    named = dealt.select(F.col("__tree").alias("tree"), F.col("__block").alias("block"), F.col("__i").alias("i"), F.col("__n").alias("n"), F.col(leaf).alias("leaf"))
    nodes = _raised(store(named.mapInArrow(tops, "__tree string, __level int, __i bigint, __n bigint, __hash string")))

    # The groups' roots are numbered like leaves, in a tree of their own.
    subroots = nodes.filter("__n = 1").select("__tree", F.col("__hash").alias("subroot"))
    ranked = _numbered(store(subroots.select(F.lit(TOP).alias("__tree"), F.col("__tree").alias("name"), "subroot")), ["name"])
    ranked = store(ranked)
    base = ranked.select("__tree", F.lit(0).alias("__level"), "__i", "__n", F.col("subroot").alias("__hash"))
    nodes = nodes.unionAll(_raised(store(base)))

    # What each block lacks of its own tree and of the one above, fetched by one join.
    blocks = dealt.groupBy("__tree", "__block").agg(F.min("__i").alias("low"), F.max("__i").alias("high"), F.first("__n").alias("n"))
    groups = ranked.select(F.col("name").alias("__tree"), F.col("__i").alias("group"), F.col("__n").alias("groups"))
    blocks = store(blocks.join(groups, "__tree"))

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for tree, block, low, high, n, place, groups in zip(*[c.to_pylist() for c in batch.columns]):
                for name, known, size in ((tree, np.arange(low, high + 1), n), (TOP, np.array([place]), groups)):
                    for level, wanted in enumerate(missing_nodes(known, size)):
                        found += [(tree, block, name, level, i) for i in wanted.tolist()]
            if found:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], ["of", "block", "__tree", "__level", "__i"])

    wanted = blocks.mapInArrow(lacking, "of string, block bigint, __tree string, __level int, __i bigint")
    fetched = wanted.join(nodes.select("__tree", "__level", "__i", "__hash"), ["__tree", "__level", "__i"])
    one = F.struct((F.col("__tree") == TOP).alias("top"), F.col("__level").alias("level"), F.col("__i").alias("i"), F.col("__hash").alias("hash"))
    fetched = fetched.groupBy("of", "block").agg(F.collect_list(one).alias("__nodes"))
    heads = blocks.join(fetched, (blocks["__tree"] == fetched["of"]) & (blocks["__block"] == fetched["block"]), "left")
    # A block's head comes first among its rows.
    heads = heads.select("__tree", "__block", F.lit(-1).cast("bigint").alias("__i"), F.col("n").alias("__n"), F.col("group").alias("__group"), F.col("groups").alias("__groups"), "__nodes")
    union = dealt.unionByName(heads, allowMissingColumns=True)
    columns = ["__tree", "__block", "__i", "__n", "__group", "__groups", "__nodes", *kept]
    union = union.select(*columns).repartition("__tree", "__block").sortWithinPartitions("__tree", "__block", "__i")
    places = "index bigint, n_leaves bigint, group_index bigint, n_groups bigint"
    schema = StructType([*leaves.select(*kept).schema, *StructType.fromDDL(f"subroot string, root string, {places}"), StructField("proof", BinaryType())])
    if presented:
        schema = schema.add(StructField(folded, StringType()))
    leaf_at, presented_at = kept.index(leaf), kept.index(presented) if presented else -1

    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.binary(), *([pa.string()] if presented else [])]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_block(batches, 0, 1):
            head, rows = part.slice(0, 1).to_pylist()[0], part.slice(1).combine_chunks()
            n, group, groups = head["__n"], head["__group"], head["__groups"]
            own: list[dict[int, bytes]] = [{} for _ in level_sizes(n)]
            top: list[dict[int, bytes]] = [{} for _ in level_sizes(groups)]
            for x in head["__nodes"] or []:
                (top if x["top"] else own)[x["level"]][x["i"]] = x["hash"].encode()
            numbers = rows["__i"].to_pylist()
            known = dict(zip(numbers, (h.encode() for h in rows.column(7 + leaf_at).to_pylist())))
            levels, subroot = _derived(known, own, n)
            higher, root = _derived({group: subroot}, top, groups)
            above = _proofs(higher, b"")[group]
            upper = _proofs(levels[1:], above) if levels else {0: bytes.fromhex(above.decode())}
            for start in range(0, len(numbers), ROWS_AT_ONCE):
                part = rows.slice(start, ROWS_AT_ONCE)
                at = numbers[start : start + ROWS_AT_ONCE]
                proofs = list(_own_proofs(at, levels, upper))
                new = [[subroot.decode()] * len(at), [root.decode()] * len(at), at, *[[x] * len(at) for x in (n, group, groups)], proofs]
                if presented:
                    shown = part.column(7 + presented_at).to_pylist()
                    new.append([None if x is None else fold(x, p, ((i, n), (group, groups))) for i, x, p in zip(at, shown, proofs)])
                yield pa.RecordBatch.from_arrays([*[c.combine_chunks() for c in part.columns[7:]], *[pa.array(x, t) for x, t in zip(new, kinds)]], names=schema.names)

    return union.mapInArrow(expand, schema)


def verify(proofs: DataFrame, leaf: str = "leaf", folded: str = "folded_root") -> DataFrame:
    """Rows of :func:`prove` with the root that their ``leaf`` and proof lead to.

    A null leaf or proof leads to null. A column already called ``folded`` is replaced.
    """
    kept = others(proofs, [folded])
    schema = StructType([*proofs.select(*kept).schema, StructField(folded, StringType())])
    at = [kept.index(c) for c in (leaf, "proof", *_PLACE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for own, proof, index, leaves, group, groups in zip(*[batch.column(i).to_pylist() for i in at]):
                found.append(None if own is None or proof is None else fold(own, proof, ((index, leaves), (group, groups))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=schema.names)

    return proofs.select(*kept).mapInArrow(run, schema)
