"""Merkle dataset manifest: a hash tree over the rows, folded again from retained hash states.

Leaves of a group stand in order and every ``arity`` consecutive nodes become their hash, until
one node remains. A parent keeps a copy of its hash state from before each child slot. To check a
changed child, the state of its slot is resumed with the new digest and the siblings to its right
only; nothing to the left is hashed again.

The tree is built in blocks of ``arity ** BLOCK_LEVELS`` nodes: a block becomes one node of the
next round, so a group of any size takes a few rounds and no task holds more than a block.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import forget, no_columns_missing, stage

ARITY = 2
# Levels a block spans: 1,024 leaves of a binary tree.
BLOCK_LEVELS = 10

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- hash states ----------------------------------------------------------------------------


@dataclass
class Parent:
    """A node's children, and its hash state from before each of them."""

    children: list[str]
    states: list
    digest: str

    @classmethod
    def of(cls, children: list[str]) -> Parent:
        state = hashlib.sha256()
        states = []
        for child in children:
            states.append(state.copy())
            state.update(child.encode())
        return cls(children, states, state.hexdigest())

    def resume(self, slot: int, digest: str) -> str:
        """The node's digest with another child in this slot."""
        state = self.states[slot].copy()
        state.update(digest.encode())
        for right in self.children[slot + 1 :]:
            state.update(right.encode())
        return state.hexdigest()


class Block:
    """The part of a group's tree over some consecutive nodes.

    ``above`` counts the nodes of the whole group at the level of these: a group that is one
    block ends as soon as one node remains, others are raised by all levels of a block.
    """

    def __init__(self, nodes: list[str], above: int, arity: int, levels: int):
        self.arity = arity
        self.parents: list[list[Parent]] = []
        whole = above <= arity**levels
        row = nodes
        while len(row) > 1 if whole else len(self.parents) < levels:
            made = [Parent.of(row[i : i + arity]) for i in range(0, len(row), arity)]
            self.parents.append(made)
            row = [parent.digest for parent in made]
        self.root = row[0]

    def path(self, at: int) -> list[tuple[Parent, int]]:
        """Ancestors of a node inside the block, with the slot below each, bottom up."""
        found = []
        for row in self.parents:
            found.append((row[at // self.arity], at % self.arity))
            at //= self.arity
        return found


def fold(digest: str, path: list[tuple[Parent, int]]) -> str:
    """The root with this digest in place of the node the path starts from."""
    for parent, slot in path:
        digest = parent.resume(slot, digest)
    return digest


def siblings(path: list[tuple[Parent, int]]) -> list[str]:
    return [d for parent, slot in path for i, d in enumerate(parent.children) if i != slot]


# --- rounds ---------------------------------------------------------------------------------


def number(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Every row with its ``at`` (from 0, by ``order``) in its group, and the group's ``total``.

    Rows are sorted by ranges, which split a hot group, and counted per range; the counts of the
    ranges before are added. One count per range and group is all that meets in a task.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    kept = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    kept = kept.withColumn("_range", F.shiftright("_place", 33))
    sizes = kept.groupBy(group, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group,
        "_range",
        (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("total"),
    )
    numbered = stage(
        kept.join(starts, [group, "_range"])
        .withColumn("at", F.col("_place") - F.col("_shift"))
        .drop("_range", "_place", "_shift"),
        "placed",
    )
    forget(kept)
    return numbered


def _raiser(arity: int, levels: int):
    def rise(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("at").to_pylist(), table.column("digest").to_pylist()))
        total, block = table.column("total")[0].as_py(), table.column("block")[0].as_py()
        root = Block([d for _, d in rows], total, arity, levels).root
        size = arity**levels
        return pa.table(
            {
                "grp": [table.column("grp")[0].as_py()],
                "at": [block],
                "total": [-(-total // size)],
                "digest": [root],
            },
            schema=pa.schema([("grp", pa.string()), ("at", pa.int64()), ("total", pa.int64()), ("digest", pa.string())]),
        )

    return rise


def _in_blocks(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {arity**levels}"))


def grow(nodes: DataFrame, arity: int = ARITY, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Rounds of a tree per group, from the given nodes to one root each.

    Takes and gives ``grp``, ``at``, ``total`` and ``digest``. A group that has its root stays as
    it is through later rounds. The number of rounds follows from the largest group: three for a
    thousand million leaves.
    """
    rounds = [nodes]
    largest = nodes.agg(F.max("total")).first()[0] or 0
    while largest > 1:
        blocks = _in_blocks(rounds[-1].select("grp", "at", "total", "digest"), arity, levels)
        raised = blocks.groupBy("grp", "block").applyInArrow(
            _raiser(arity, levels), "grp string, at long, total long, digest string"
        )
        rounds.append(stage(raised, "blocks"))
        largest = -(-largest // arity**levels)
    return rounds


_STEP = pa.struct([("children", pa.list_(pa.string())), ("slot", pa.int32())])
_PATHS = pa.schema([("grp", pa.string()), ("at", pa.int64()), ("path", pa.list_(_STEP))])
PATH = "array<struct<children: array<string>, slot: int>>"
PATHS = f"grp string, at long, path {PATH}"


def _without_ancestors(nodes: DataFrame) -> DataFrame:
    # Columns of their own, for a join with the nodes themselves.
    own = [F.col(c).alias(c) for c in ("grp", "at")]
    return nodes.select(*own, F.array().cast(PATH).alias("path"))


def _steps(path: list[tuple[Parent, int]]) -> list[dict]:
    return [{"children": parent.children, "slot": slot} for parent, slot in path]


def _pather(arity: int, levels: int):
    def paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        rows = sorted(zip(nodes.column("at").to_pylist(), nodes.column("digest").to_pylist()))
        block = Block([d for _, d in rows], nodes.column("total")[0].as_py(), arity, levels)
        upper = above.column("path")[0].as_py()
        group = nodes.column("grp")[0].as_py()
        return pa.table(
            {
                "grp": [group] * len(rows),
                "at": [at for at, _ in rows],
                "path": [_steps(block.path(i)) + upper for i in range(len(rows))],
            },
            schema=_PATHS,
        )

    return paths


def paths_of(rounds: list[DataFrame], arity: int = ARITY, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """For every round but the first (the leaves), each node's ancestors up to its group's root."""
    found = [_without_ancestors(rounds[-1])]
    for nodes in reversed(rounds[1:-1]):
        lower = _in_blocks(nodes, arity, levels).groupBy("grp", "block")
        upper = found[0].withColumnRenamed("at", "block").groupBy("grp", "block")
        found.insert(0, stage(lower.cogroup(upper).applyInArrow(_pather(arity, levels), PATHS), "paths"))
    return found


_FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _folder(arity: int, levels: int):
    names = [c.split()[0] for c in _FOLDED.split(", ")]

    def folded(leaves: pa.Table, above: pa.Table) -> pa.Table:
        rows = leaves.sort_by("at").to_pydict()
        block = Block(rows["digest"], rows["total"][0], arity, levels)
        top = above.to_pylist()[0]
        upper = [(Parent.of(s["children"]), s["slot"]) for s in top["path"]]
        rest = siblings(upper)
        out: dict[str, list] = {name: [] for name in names}
        for at, leaf in enumerate(rows["digest"]):
            path = block.path(at)
            proof = "".join(siblings(path) + rest)
            out["doc_id"].append(rows["doc_id"][at])
            out["leaf"].append(leaf)
            out["subroot"].append(top["subroot"])
            out["root"].append(top["root"])
            out["proof_sha256"].append(hashlib.sha256(proof.encode()).hexdigest())
            out["folded_root"].append(fold(rows["changed"][at], path + upper))
        kinds = [(name, pa.int64() if name == "doc_id" else pa.string()) for name in names]
        return pa.table(out, schema=pa.schema(kinds))

    return folded


# --- documents ------------------------------------------------------------------------------


def _spelled(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(docs: DataFrame, **replaced: Column) -> Column:
    """Digest of a row: each field ``-`` if null, else its UTF-8 length, ``:`` and its value."""
    parts = [_spelled(replaced.get(name, F.col(name))) for name in FIELDS]
    return F.sha2(F.concat(*parts), 256)


def tampered() -> Column:
    """Rows chosen to be tampered with: 7 divides the checksum of the id; null ids are not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest(
    docs: DataFrame, arity: int = ARITY, levels: int = BLOCK_LEVELS
) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """The rounds of a tree per language and of the tree over their roots, leaves first.

    Leaves of a language ascend by ``doc_id`` (null first), equal ids by digest; languages are
    ordered null first, then by their UTF-8 bytes. Nodes have ``grp`` (the language after ``s``,
    or ``n`` for null), ``at`` and ``digest``; leaves also ``doc_id`` and ``changed``, the digest
    with one more in ``n_chars`` where ``tampered`` chooses the row. Equal rows have equal leaves
    side by side. Only the fields of a leaf are read; missing columns count as null.
    """
    rows = no_columns_missing(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaves = (
        rows.withColumn("digest", leaf_digest(rows))
        .withColumn(
            "changed",
            F.when(tampered() & F.col("n_chars").isNotNull(), leaf_digest(rows, n_chars=more)).otherwise(
                F.col("digest")
            ),
        )
        .select("doc_id", F.coalesce(F.concat(F.lit("s"), "lang"), F.lit("n")).alias("grp"), "digest", "changed")
    )
    leaves = stage(leaves, "leaves")
    numbered = number(leaves, "grp", "doc_id", "digest")
    forget(leaves)
    groups = grow(numbered, arity, levels)
    roots = groups[-1].select(F.lit("").alias("all"), F.col("grp").alias("name"), "digest")
    tops = number(roots, "all", "name").withColumnRenamed("all", "grp")
    return numbered, groups, grow(tops, arity, levels)


def verify(docs: DataFrame, arity: int = ARITY, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per row of ``docs``: ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``
    and ``verified``.

    Bottom up, blocks become nodes; top down, each block learns the ancestors of its root and
    retains their hash states, so that every leaf is folded inside its block and on to the root
    of all. ``proof_sha256`` hashes the siblings met on that way, level by level; ``folded_root``
    starts from the changed leaf where the row was chosen for tampering, else from its own.
    An empty table gives no rows. See ``manifest`` for null and repeated ids.
    """
    numbered, groups, tops = manifest(docs, arity, levels)
    size = arity**levels
    # Per language: its root, its ancestors in the tree of languages, and the root of all.
    over = paths_of([tops[0], *tops], arity, levels)[0]
    root = tops[-1].select("grp", F.col("digest").alias("root"))
    above = (
        tops[0]
        .select("grp", "at", F.col("name"), F.col("digest").alias("subroot"))
        .join(over.select("at", F.col("path").alias("rest")), "at")
        .join(F.broadcast(root), "grp")
        .select(F.col("name").alias("grp"), "subroot", "root", "rest")
    )
    # A group of one leaf has no block of its own; its leaf is its root.
    below = paths_of(groups, arity, levels)[0] if len(groups) > 1 else _without_ancestors(groups[0])
    tasks = below.join(above, "grp").select(
        "grp", F.col("at").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root"
    )
    leaves = numbered.withColumn("block", F.expr(f"at div {size}")).groupBy("grp", "block")
    folded = leaves.cogroup(tasks.groupBy("grp", "block")).applyInArrow(_folder(arity, levels), _FOLDED)
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
