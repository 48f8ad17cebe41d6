"""Merkle manifest of a table by time-forward processing.

Nodes of the tree are labelled in postorder, so that children come before their parent. A node sends its digest to
its parent through a priority queue ordered by the label of the receiver; a parent is processed when all messages to
it have arrived at the head of the queue. In the reversed order, a parent sends each child the siblings it needs for
its proof, followed by those of its own, and the leaves have their proofs when the queue is empty.

The queue's external part is Spark's sort: the nodes of a level are dealt out by subtrees of ``ARITY`` ** ``DEPTH``
leaves and sorted by label, and what crosses a subtree's root waits in a written table for the next round. The part in
a task's memory holds the messages of one subtree. So a group with a third of all rows is very many subtrees, and a
round divides the nodes by 512.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.llm.rows import ROW, identified, numbered
from supportlens.session import written

ARITY, DEPTH = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def record_hash(*values: Column) -> Column:
    """Hash of a record: each value as the number of its UTF-8 bytes, a colon and the value, nulls as a dash."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Queue:
    """Messages (receiver's label, place among its siblings, content), delivered in the order of the labels."""

    def __init__(self):
        self.heap: list[tuple] = []

    def send(self, label: tuple, place: int, content) -> None:
        heapq.heappush(self.heap, (label, place, content))

    def delivered(self, before: tuple | None = None) -> Iterator[tuple[tuple, list]]:
        """Receivers up to a label and their messages; all receivers without one. Receivers may send while this runs."""
        heap = self.heap
        while heap and (before is None or heap[0][0] < before):
            label, got = heap[0][0], []
            while heap and heap[0][0] == label:
                got.append(heapq.heappop(heap)[2])
            yield label, got


def _parent(i: int, level: int) -> tuple[int, int]:
    """Postorder label of the parent of node ``i`` of a level: the end of the leaves below it, then its level."""
    return (i // ARITY + 1) * ARITY ** (level + 1), level + 1


def ascend(nodes: Iterator[tuple[int, str]], top: int) -> Iterator[tuple[int, int, list[str], str]]:
    """Inner nodes (level, index, digests of the children, digest) over the leaves (index, digest) of one subtree,
    which come in ascending order, up to level ``top``; none if that is the leaves' own."""
    queue = Queue()

    def processed(before=None):
        for (end, level), children in queue.delivered(before):
            i, found = end // ARITY**level - 1, digest(children)
            if level < top:
                queue.send(_parent(i, level), i, found)
            yield level, i, children, found

    for i, leaf in nodes if top else ():
        yield from processed((i + 1, 0))
        queue.send(_parent(i, 0), i, leaf)
    yield from processed()


def descend(inner: list[tuple[int, int, list[str], str]], suffix: str) -> dict[int, str]:
    """Proofs of the leaves of one subtree, by index: the nodes are processed from the last label to the first.

    A proof has one part for each level, a slash between them: the number of siblings to the left, then the digests
    of all siblings. ``suffix`` is the part from the subtree's root on.
    """
    children = {((i + 1) * ARITY**level, level): (i, found) for level, i, found, _ in inner}
    queue, proofs = Queue(), {}
    queue.send(tuple(-x for x in max(children)), 0, suffix)
    for label, (above,) in queue.delivered():
        level = -label[1]
        i, digests = children[-label[0], level]
        for k, _ in enumerate(digests):
            own = str(k) + "".join(digests[:k] + digests[k + 1 :])
            child, proof = ARITY * i + k, own + ("/" + above if above else "")
            if level == 1:
                proofs[child] = proof
            else:
                queue.send((-(child + 1) * ARITY ** (level - 1), 1 - level), 0, proof)
    return proofs


def fold(leaf: str, proof: str) -> str:
    """The root that follows from a leaf and its proof."""
    for part in proof.split("/") if proof else ():
        cut = 1 + 64 * int(part[0])
        leaf = digest((part[1:cut], leaf, part[cut:]))
    return leaf


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each subtree of a sorted partition; its first two columns are the group and the subtree."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _emitted(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= 2048:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def _top(n: int, depth: int) -> int:
    """Levels a subtree is climbed: all of them if it is the whole group."""
    return min(depth, height(n))


def _dealt(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes sorted by label, a subtree in one partition."""
    block = F.floor(F.col("i") / ARITY**depth).cast("long")
    return nodes.withColumn("block", F.when(F.col("i") >= 0, block).otherwise(-F.col("i") - 1)).repartition("g", "block").sortWithinPartitions("g", "block", "i")


def up(nodes: DataFrame, depth: int) -> DataFrame:
    """Roots (g, i, n, digest) of the subtrees of a level (g, i, n, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def roots():
            for rows in _subtrees(batches):
                g, block, _, n, found = rows[0]
                for _, _, _, found in ascend(((r[2], r[4]) for r in rows), _top(n, depth)):
                    pass
                yield g, block, -(-n // ARITY**depth), found

        yield from _emitted(roots(), pa.schema({"g": pa.string(), "i": pa.int64(), "n": pa.int64(), "digest": pa.string()}))

    return _dealt(nodes, depth).select("g", "block", "i", "n", "digest").mapInArrow(run, "g string, i long, n long, digest string")


def down(nodes: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """Proofs of the nodes of a level: ``nodes`` with ``proof``, ``subroot`` and ``root``, given those of their
    subtrees' roots, (g, i, proof, subroot, root). The messages from above are sorted in before the nodes."""
    sent = above.select("g", (-F.col("i") - 1).alias("i"), "proof", "subroot", "root")
    both = _dealt(nodes.unionByName(sent, allowMissingColumns=True), depth)
    order = ["g", "block", "i", "n", "digest", "proof", "subroot", "root"]
    names = [*[c for c in nodes.columns if c not in order], "g", "i", "n", "digest", "proof", "subroot", "root"]
    kept = [c for c in nodes.columns if c not in order]
    ordered = both.select(*order, *kept)
    schema = both.select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {}

        def seen():
            for batch in batches:
                types.update(zip(batch.schema.names, batch.schema.types))
                yield batch

        def proven():
            for (message, *rows) in _subtrees(seen()):
                proof, subroot, root = message[5:8]
                inner = list(ascend(((r[2], r[4]) for r in rows), _top(rows[0][3], depth)))
                proofs = descend(inner, proof) if inner else {rows[0][2]: proof}
                for r in rows:
                    yield (*r[8:], r[0], *r[2:5], proofs[r[2]], subroot, root)

        held = []
        for row in proven():
            held.append(row)
            if len(held) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*held), names)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*held), names)], names)

    return ordered.mapInArrow(run, schema)


def climbed(leaves: DataFrame, name: str, depth: int) -> list[DataFrame]:
    """The written levels at which subtrees begin, from the leaves to one node for each group."""
    levels = [leaves]
    while levels[-1].filter("n > 1").limit(1).count():
        levels.append(written(up(levels[-1].select("g", "i", "n", "digest"), depth), f"{name}-{len(levels)}"))
    return levels


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
    also: Callable[[DataFrame], Column] | None = None, depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``group``, ``leaf`` (the hash of its ``fields``), ``place`` and ``leaves``
    (its number among the leaves of its group, and theirs), ``subroot``, ``root``, ``proof`` (see ``descend``), and
    ``other``, another leaf that ``also`` makes of the identified rows (null without it).

    Leaves of a group ascend by key, nulls first, equal keys by leaf and then by stored row, so that equal rows are
    leaves of their own. Groups are ordered by their UTF-8 bytes, null first. A lone leaf is its group's root, a lone
    group's root the root, and their proofs have no parts. An empty table gives an empty result. Other columns are
    neither read nor returned.
    """
    rows = identified(docs)
    hashed = rows.select(
        F.col(key).alias("key"), F.col(group).alias("of"), record_hash(*[F.col(f) for f in fields]).alias("digest"),
        (also(rows) if also else F.lit(None)).cast("string").alias("other"), *ROW,
    )
    # The sort reads its input twice, the texts are to be read once.
    placed = numbered(written(hashed, "merkle-hashed"), F.col("of"), ["key", "digest", *ROW], "merkle-sorted")
    named = F.when(F.col("of").isNotNull(), F.concat(F.lit("+"), F.col("of").cast("string"))).otherwise("-")
    leaves = written(placed.select("key", "of", "other", named.alias("g"), "i", "n", "digest"), "merkle-leaves")
    levels = climbed(leaves, "merkle-level", depth)

    subroots = levels[-1].select(F.col("g").alias("of"), "digest")
    bytewise = F.when(F.col("of") != "-", F.substring("of", 2, 1 << 30))
    top = numbered(subroots.withColumn("name", bytewise), F.lit(0), ["name"], "merkle-subroots")
    tops = climbed(top.select("of", F.lit("").alias("g"), "i", "n", "digest"), "merkle-top", depth)
    none = F.lit(None).cast("string")
    found = tops[-1].select("g", "i", F.lit("").alias("proof"), none.alias("subroot"), F.col("digest").alias("root"))
    for level in reversed(tops[:-1]):
        found = written(down(level, found, depth), "merkle-top-proofs")
    if len(tops) == 1:  # no group or one
        found = top.select("of", F.lit("").alias("proof"), "digest", F.col("digest").alias("root"))
    found = found.select(F.col("of").alias("g"), F.lit(0).cast("long").alias("i"), "proof", F.col("digest").alias("subroot"), "root")
    for level in reversed(levels[1:-1]):
        found = written(down(level, found, depth), "merkle-proofs").select("g", "i", "proof", "subroot", "root")
    if len(levels) > 1:
        found = down(leaves, found, depth)
    else:  # every group has one leaf
        found = leaves.join(found.drop("i"), "g")
    return found.select(
        F.col("key").alias(key), F.col("of").alias(group), F.col("digest").alias("leaf"), F.col("i").alias("place"),
        F.col("n").alias("leaves"), "subroot", "root", "proof", "other",
    )


@F.arrow_udf(T.StringType())
def folded(leaf: pa.Array, proof: pa.Array) -> pa.Array:
    """``fold`` for columns."""
    return pa.array(map(fold, leaf.to_pylist(), proof.to_pylist()), pa.string())


def proof_hash(proof: Column) -> Column:
    """SHA-256 of the digests of a proof, from the leaf to the root and left to right."""
    return F.sha2(F.regexp_replace(proof, r"(^|/)\d", ""), 256)


def verified(found: DataFrame) -> DataFrame:
    """A manifest with ``folded_root``, recomputed from ``other`` or else from ``leaf``, and ``verified``: whether it
    is the root."""
    checked = found.withColumn("folded_root", folded(F.coalesce("other", "leaf"), "proof"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """A to Z lower-cased, other letters as they are."""
    return F.translate(text, UPPER, LOWER)
