"""Merkle manifest of a dataset: a tree of SHA-256 digests that keeps its midstates.

Leaves are the digests of rows. In each series (a source, say) leaves ascend by
id, and every `FAN` consecutive nodes, the last run fewer, have as parent the
digest of their hexadecimal digests one after another, until one node remains:
the series' subroot. Subroots, ordered by series (null first, by UTF-8 bytes),
are the leaves of a last tree of the same kind, whose top is the root.

A parent keeps, beside its digest, a copy of the hash state before each child's
slot. `fold` replaces leaves and takes up the state before the replaced slot,
absorbs the replacement and the siblings right of it, and so on upwards: nothing
left of a slot is hashed again.

The tree is built in rounds. A round cuts a series into blocks of `FAN**HEIGHT`
nodes, each a whole subtree of `HEIGHT` levels, built in one task; the blocks' tops are the
nodes of the next round, so a series of n leaves takes log(n) / log(FAN**HEIGHT) rounds.
A block is one row of the manifest, with all digests and midstates packed. From
the top down each block gets its path: the slots, midstates and siblings above it.
Folding joins leaves with their block's row only.

Row digests are in SQL functions (`row_digest`), numbering is by range partitions
(ordered.py); no task holds more than a block. A manifest is two tables in a
folder: `leaves` and `blocks`; what a lost task left there is replaced by Spark's
commit of the retry.

A null series is a series of its own, before all others. A null id comes first.
Rows that share an id follow by their digest; equal rows have equal digests, so
their order does not matter. An empty table has no tree: no rows come back. Extra
columns are not read, their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airmart.llm import sha_state
from airmart.llm.ordered import number
from airmart.llm.sha_state import DIGEST
from airmart.session import materialize, scratch_path

FAN, HEIGHT = 3, 7  # children of a parent, levels of a block above its leaves
_STEP = 2 + DIGEST + (FAN - 1) * DIGEST  # of a path: slot, children, state before the slot, siblings
ABSENT = "-"


def row_digest(columns: list[Column]) -> Column:
    """Hexadecimal SHA-256 of fields: `-` for null, else UTF-8 bytes, a colon and the value."""
    fields = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit(ABSENT)) for c in columns]
    return F.sha2(F.concat(*fields), 256)


# -- a block in numpy ------------------------------------------------------


def heights(n: int, block: int, height: int) -> list[int]:
    """Nodes of each level of a block of a series of n nodes; one that is all of its series ends at one node, others have `height` levels above their leaves."""
    sizes = [min(FAN**height, n - block * FAN**height)]
    while sizes[-1] > 1 if n <= FAN**height else len(sizes) <= height:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


@dataclass
class Block:
    """Digests of each level, and of each level of parents the states before their slots."""

    levels: list[np.ndarray]  # (nodes, 32)
    states: list[np.ndarray]  # (parents, FAN, 8)

    @staticmethod
    def grown(leaves: np.ndarray, sizes: list[int]) -> Block:
        block = Block([leaves], [])
        for size in sizes[1:]:
            nodes = block.levels[-1]
            arity = np.minimum(FAN, len(nodes) - FAN * np.arange(size))
            state, before = sha_state.start(size), np.zeros((size, FAN, 8), np.uint32)
            for slot in range(FAN):
                has = arity > slot
                before[has, slot] = state[has]
                state[has] = sha_state.absorb(state[has], sha_state.block(nodes[slot::FAN]))
            block.states.append(before)
            block.levels.append(sha_state.finish(state, arity))
        return block

    @staticmethod
    def unpacked(nodes: bytes, states: bytes, sizes: list[int]) -> Block:
        digests = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
        before = np.frombuffer(states, np.uint32).reshape(-1, FAN, 8)
        return Block(np.split(digests, np.cumsum(sizes)[:-1]), np.split(before, np.cumsum(sizes[1:])[:-1]) if sizes[1:] else [])

    def packed(self) -> tuple[bytes, bytes]:
        return b"".join(x.tobytes() for x in self.levels), b"".join(x.tobytes() for x in self.states)

    def siblings(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The other children, left to right (n, FAN - 1, 32), of the parents of nodes, and which of these exist."""
        slot = np.arange(FAN - 1)[None, :]
        own = at[:, None] // FAN * FAN + slot + (slot >= at[:, None] % FAN)
        exist = own < len(self.levels[level])
        found = self.levels[level][np.where(exist, own, 0)]
        found[~exist] = 0
        return found, exist

    def steps(self, at: np.ndarray) -> np.ndarray:
        """Packed path (n, levels, _STEP) from the leaves at these places to the top."""
        out = np.zeros((len(at), len(self.states), _STEP), np.uint8)
        for level, before in enumerate(self.states):
            near, exist = self.siblings(level, at)
            out[:, level, 0], out[:, level, 1] = at % FAN, 1 + exist.sum(axis=1)
            out[:, level, 2 : 2 + DIGEST] = before[at // FAN, at % FAN].astype("<u4").view(np.uint8).reshape(-1, DIGEST)
            out[:, level, 2 + DIGEST :] = near.reshape(len(at), -1)
            at = at // FAN
        return out


def fold_steps(digests: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Tops that replaced nodes (n, 32) lead to by paths (n, levels, _STEP)."""
    for level in range(steps.shape[1]):
        own = steps[:, level]
        slot, arity = own[:, 0].astype(np.int64), own[:, 1].astype(np.int64)
        state = np.ascontiguousarray(own[:, 2 : 2 + DIGEST]).view("<u4").astype(np.uint32)
        state = sha_state.absorb(state, sha_state.block(digests))
        near = own[:, 2 + DIGEST :].reshape(len(own), FAN - 1, DIGEST)
        for k in range(FAN - 1):  # siblings from the replaced slot on are right of it
            right = (k >= slot) & (k < arity - 1)
            if right.any():
                state[right] = sha_state.absorb(state[right], sha_state.block(near[right, k]))
        digests = sha_state.finish(state, arity)
    return digests


def proof_text(steps: np.ndarray) -> str:
    """Hexadecimal siblings of one path (levels, _STEP), level by level, left to right."""
    near = steps[:, 2 + DIGEST :].reshape(-1, FAN - 1, DIGEST)
    exist = np.arange(FAN - 1)[None, :] < steps[:, 1:2].astype(np.int64) - 1
    return near[exist].tobytes().hex()


# -- the manifest ----------------------------------------------------------

BLOCKS = "tree string, n long, block long, digest binary, nodes binary, states binary"
# A key of each series that is never null, and sorts as series do; and the series of a key.
TREE = "coalesce(concat('s', series), '')"
SERIES = "if(tree = '', null, substring(tree, 2))"


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, id, digest, index, n; rounds and top_rounds: blocks by round; top: tree, index, n of each series."""

    leaves: DataFrame
    rounds: list[DataFrame]
    top: DataFrame
    top_rounds: list[DataFrame]
    height: int = HEIGHT

    def root(self) -> str | None:
        return self.top_rounds[-1].select(F.lower(F.hex("digest"))).first()[0] if self.top_rounds else None

    def subroots(self) -> DataFrame:
        """(series, subroot)"""
        return self.top.select(F.expr(SERIES).alias("series"), F.lower(F.hex("digest")).alias("subroot"))


def build(leaves: DataFrame, folder: str | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of a written table of leaves (series, id, digest), written to `folder` or to scratch."""
    folder = folder or scratch_path(leaves.sparkSession, "manifest")
    keyed = leaves.select(F.expr(TREE).alias("tree"), "id", F.unhex("digest").alias("digest"))
    placed = _written(number(keyed, "tree", ["id", "digest"]), f"{folder}/leaves")
    rounds = _grown(placed, f"{folder}/blocks", height)
    whole = [r.where(F.col("n") <= FAN**height).select("tree", "digest") for r in rounds]
    subroots = whole[0] if whole else placed.select("tree", "digest")
    for more in whole[1:]:
        subroots = subroots.union(more)
    top = number(materialize(subroots.withColumn("all", F.lit("")), "subroots"), "all", ["tree"])
    top = _written(top.select("tree", "digest", "index", "n"), f"{folder}/top")
    return Manifest(placed, rounds, top, _grown(top.withColumn("tree", F.lit("")), f"{folder}/top-blocks", height), height)


def read_manifest(spark: SparkSession, folder: str, height: int = HEIGHT) -> Manifest:
    """A manifest that `build` wrote with the same height."""
    leaves, top = spark.read.parquet(f"{folder}/leaves"), spark.read.parquet(f"{folder}/top")
    rounds = lambda name, n: [spark.read.schema(BLOCKS).parquet(f"{folder}/{name}/{k}") for k in range(n)]
    n_rounds = lambda nodes: _n_rounds(nodes, height)
    return Manifest(leaves, rounds("blocks", n_rounds(leaves)), top, rounds("top-blocks", n_rounds(top)), height)


def _n_rounds(numbered: DataFrame, height: int) -> int:
    nodes, n = numbered.agg(F.max("n")).first()[0], 0
    while nodes:
        n, nodes = n + 1, -(-nodes // FAN**height) if nodes > FAN**height else 0
    return n


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _grown(nodes: DataFrame, folder: str, height: int) -> list[DataFrame]:
    """Blocks of each round over numbered nodes (tree, index, n, digest)."""
    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        sizes = heights(group.column("n")[0].as_py(), group.column("block")[0].as_py(), height)
        block = Block.grown(digests(group.column("digest")), sizes)
        packed, states = block.packed()
        return pa.table({
            "tree": group.column("tree")[:1], "n": group.column("n")[:1], "block": group.column("block")[:1],
            "digest": pa.array([block.levels[-1].tobytes()], pa.binary()), "nodes": pa.array([packed], pa.binary()), "states": pa.array([states], pa.binary()),
        })

    rounds: list[DataFrame] = []
    span = FAN**height
    for k in range(_n_rounds(nodes, height)):
        own = nodes.select("tree", "n", F.expr(f"index div {span}").alias("block"), "index", "digest")
        rounds.append(_written(own.groupBy("tree", "block").applyInArrow(grow, BLOCKS), f"{folder}/{k}"))
        open_ = rounds[-1].where(F.col("n") > span)
        nodes = open_.select("tree", F.expr(f"(n + {span - 1}) div {span}").alias("n"), F.col("block").alias("index"), "digest")
    return rounds


def digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DIGEST)


PATHS = "tree string, index long, subroot binary, path binary"


def _child_paths(blocks: DataFrame, height: int) -> DataFrame:
    """(tree, index, subroot, path) of every leaf of blocks that have subroot and path themselves."""
    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = heights(row["n"], row["block"], height)
                leaves = sizes[0]
                steps = Block.unpacked(row["nodes"], row["states"], sizes).steps(np.arange(leaves))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * leaves), pa.array(np.arange(leaves) + row["block"] * FAN**height), pa.array([row["subroot"]] * leaves, pa.binary()), pa.array([x.tobytes() + row["path"] for x in steps], pa.binary())],
                    ["tree", "index", "subroot", "path"],
                )

    return blocks.mapInArrow(down, PATHS)


def _with_paths(rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame | None:
    """Blocks of the first round with subroot and path; tops has these of each tree's own top (tree, subroot, path)."""
    above, found = None, None
    for r in reversed(rounds):
        found = r.where(F.col("n") <= FAN**height).join(tops, "tree")
        if above is not None:
            upper = above.select("tree", F.col("index").alias("block"), "subroot", "path")
            found = found.unionByName(r.where(F.col("n") > FAN**height).join(upper, ["tree", "block"]))
        above = _child_paths(found, height)
    return found


FOLDED = "tree string, id {id}, leaf binary, subroot string, proof_sha256 string, n_siblings long, folded_root string"


def fold(manifest: Manifest, replacements: DataFrame | None = None, with_proof: bool = False) -> DataFrame:
    """Each leaf with its subroot, its proof (digest of all siblings, and their text if asked for) and the root it folds to.

    `replacements` (series, id, digest, replacement, all but ids not null) name a leaf
    and what to fold in its place; others fold as they are. The root of the manifest
    comes back as well, and whether both agree.
    """
    height = manifest.height
    id_type = manifest.leaves.schema["id"].dataType.simpleString()
    schema = FOLDED.format(id=id_type) + (", proof string" if with_proof else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def folded(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("index")
        row = blocks.to_pylist()[0]
        block = Block.unpacked(row["nodes"], row["states"], heights(row["n"], row["block"], height))
        steps = block.steps(leaves.column("index").to_numpy() - row["block"] * FAN**height)
        above = np.frombuffer(row["path"], np.uint8).reshape(1, -1, _STEP)
        tops = fold_steps(fold_steps(digests(leaves.column("replacement")), steps), np.broadcast_to(above, (len(leaves), *above.shape[1:])))
        shared = proof_text(above[0])
        proofs = [proof_text(x) + shared for x in steps]
        values = [
            leaves.column("tree"), leaves.column("id"), leaves.column("digest"), pa.array([row["subroot"].hex()] * len(leaves)),
            pa.array([hashlib.sha256(p.encode()).hexdigest() for p in proofs]), pa.array([len(p) // (2 * DIGEST) for p in proofs], pa.int64()),
            pa.array([t.tobytes().hex() for t in tops]), pa.array(proofs),
        ]
        return pa.table(values[: len(names)], names=names)

    leaves = manifest.leaves.withColumn("replacement", F.col("digest"))
    if replacements is not None:
        chosen = replacements.select(F.expr(TREE).alias("tree"), "id", F.unhex("digest").alias("digest"), F.unhex("replacement").alias("new")).distinct()
        same = [leaves["tree"] == chosen["tree"], leaves["id"].eqNullSafe(chosen["id"]), leaves["digest"] == chosen["digest"]]
        leaves = leaves.join(chosen, same, "left").select(leaves["tree"], leaves["id"], leaves["digest"], "index", "n", F.coalesce("new", leaves["digest"]).alias("replacement"))
    ends = manifest.top_rounds[-1].select(F.col("tree"), F.col("digest").alias("subroot"), F.lit(b"").alias("path")) if manifest.top_rounds else None
    top_blocks = _with_paths(manifest.top_rounds, ends, height) if ends is not None else None
    if top_blocks is None:
        return leaves.sparkSession.createDataFrame([], f"series{schema[4:]}, root string, verified boolean")
    tops = _child_paths(top_blocks, height).select("index", "path").join(manifest.top.select("tree", "digest", "index"), "index")
    tops = tops.select("tree", F.col("digest").alias("subroot"), "path")
    blocks = _with_paths(manifest.rounds, tops, height).select("tree", "n", "block", "nodes", "states", "subroot", "path")
    own = leaves.withColumn("block", F.expr(f"index div {FAN**height}")).select("tree", "block", "id", "digest", "replacement", "index")
    found = own.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(folded, schema)
    root = F.lit(manifest.root())
    return found.select(F.expr(SERIES).alias("series"), *names[1:], root.alias("root"), (F.col("folded_root") == root).alias("verified"))
