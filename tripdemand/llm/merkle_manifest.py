"""A Merkle manifest of a dataset: a digest tree per source, a tree of sources, proofs of every row.

The nodes of a level are grouped by ``FAN`` into runs, each run's digest is a node of the
level above, until one is left. Digests are lower-case hex sha256.

Trees grow by blocks: ``FAN ** DEEP`` consecutive nodes are one group of a task, which
derives ``DEEP`` levels at once. So a tree of n leaves takes log(n) / log(2187) shuffles of
quickly falling size, and no task holds more than a block. Only levels from ``DEEP`` on are
stored, one node for every 2,187 leaves and a third more.

Proofs are made as one multiproof for each block of leaves (octopus): climbing from all its
leaves at once, it lists the coordinates of the nodes that it cannot derive itself, and that
some proof needs; equal needs are listed once. The lists are joined to the stored nodes by
coordinate, once. Each block then derives the levels its leaves share and expands the proofs
of its leaves from both. Nodes near the roots are wanted by many blocks; they are
joined under ``SALTS`` keys.

Nulls are written ``-`` in a leaf, a null source is a source of its own (the first), null ids
come first. Rows with equal source and id are ordered by their leaf digests; repeated rows
are leaves each. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.row_order import places
from tripdemand.llm.stored import on_workers, stored, written

FAN = 3
DEEP = 7
BLOCK = FAN**DEEP
SALTS = 16
#: The number under which the tree of sources stands among the trees.
TOP = -1
NODE = "tree long, level int, pos long, size long, digest string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(digests: list[str], size: int, steps: int) -> Iterator[list[str]]:
    """The levels above consecutive nodes that start a run, of a level of ``size`` nodes."""
    while steps and size > 1:
        digests = [digest("".join(digests[i : i + FAN])) for i in range(0, len(digests), FAN)]
        size, steps = -(-size // FAN), steps - 1
        yield digests


def missing(pos: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes which the proofs of leaves need and which these leaves don't give.

    The least set: a node is in it if its run holds a known node and it cannot be derived.
    """
    need = []
    level, known = 0, np.unique(pos)
    while size > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        need += [(level, int(p)) for p in np.setdiff1d(members[members < size], known)]
        level, known, size = level + 1, runs, -(-size // FAN)
    return need


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: each value as its length in bytes, ``:`` and itself, ``-`` if null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)), 256)


def level_up(nodes: DataFrame) -> DataFrame:
    """The ``DEEP`` levels (or as many as there are) above the nodes of one level, block by block."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        tree, level, size, place = int(block.tree.iloc[0]), int(block.level.iloc[0]), int(block["size"].iloc[0]), int(block.pos.iloc[0])
        out = []
        for digests in climb(block.digest.tolist(), size, DEEP):
            level, size, place = level + 1, -(-size // FAN), place // FAN
            out += [(tree, level, place + i, size, d) for i, d in enumerate(digests)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in NODE.split(", ")])

    return nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK)).applyInPandas(run, NODE)


def forest(leaves: DataFrame, inner: bool) -> DataFrame:
    """All stored nodes of the trees of ``leaves`` (the columns of NODE, level 0).

    Levels 1 to ``DEEP - 1`` are left out, unless the tree's root is one of them or ``inner``
    asks for all; leaves are left out but for lone ones, or with ``inner``.
    """
    stop = F.col("size") == 1
    out = leaves if inner else leaves.where(stop)
    nodes = leaves.where(~stop)
    first = True
    while True:
        levels = stored(level_up(nodes))
        last = levels.agg(F.max("level")).first()[0]
        if last is None:
            return out
        out = out.union(levels if inner or not first else levels.where((F.col("level") == DEEP) | stop))
        nodes, first = levels.where((F.col("level") % DEEP == 0) & ~stop), False


def merkle_proofs(docs: DataFrame, fields: list[str], keep: list[Column], altered: dict[str, Column], source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: the columns of ``keep``, its digests and whether its proof holds.

    ``leaf``, ``subroot`` (of its source), ``root``; ``proof_sha256`` of all siblings from the
    leaf up, left to right; ``folded_root``, what the proof makes of the row as it is with the
    columns of ``altered`` in place of its own; ``verified``, whether that is the root.
    """
    spark = docs.sparkSession
    on_workers(spark)
    kept = [f"_keep{i}" for i in range(len(keep))]
    names = docs.select(*keep).columns
    rows = docs.select(
        *(c.alias(k) for c, k in zip(keep, kept, strict=True)), F.col(source_col).cast("string").alias("_source"), F.col(id_col).alias("_id"),
        leaf([F.col(f) for f in fields]).alias("digest"), leaf([altered.get(f, F.col(f)) for f in fields]).alias("_claim"),
    )
    placed = places(rows, [F.col("_id").asc_nulls_first(), F.col("digest")], "_source", "tree")
    leaves = written(placed.drop("_source", "_id").withColumn("level", F.lit(0)), "leaves")

    low = forest(leaves.select(*_node_columns()), inner=False)
    subroots = stored(low.where("size = 1").select("tree", "digest"))
    trees = subroots.count()
    high = forest(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("pos"), F.lit(trees).cast("long").alias("size"), "digest"), inner=True)
    nodes = low.union(high).select("tree", "level", "pos", "digest")

    block = F.floor(F.col("pos") / BLOCK).alias("block")

    def wants(part: pd.DataFrame) -> pd.DataFrame:
        tree, size, at = int(part.tree.iloc[0]), int(part["size"].iloc[0]), int(part.pos.iloc[0]) // BLOCK
        own = [(tree, level, pos) for level, pos in missing(part.pos.to_numpy(), size)]
        shared = [(TOP, level, pos) for level, pos in missing(np.array([tree]), trees)]
        return pd.DataFrame([(tree, at, *x) for x in own + shared], columns=["tree", "block", "of", "level", "pos"])

    wanted = leaves.select("tree", "pos", "size").groupBy("tree", block).applyInPandas(wants, "tree long, block long, of long, level int, pos long")
    wanted = wanted.withColumn("salt", (F.xxhash64("tree", "block") % SALTS + SALTS) % SALTS)
    offered = nodes.select(F.col("tree").alias("of"), "level", "pos", "digest", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    fetched = wanted.join(offered, ["of", "level", "pos", "salt"]).select("tree", "block", "of", "level", "pos", "digest")

    types = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    result = ", ".join(f"{k} {types[k]}" for k in kept) + ", leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    grouped = leaves.select(*kept, "tree", "pos", "size", "digest", "_claim", block).groupBy("tree", "block")
    out = grouped.cogroup(fetched.groupBy("tree", "block")).applyInArrow(lambda part, got: expanded(part, got, trees, kept), result)
    return out.select(*(F.col(k).alias(n) for k, n in zip(kept, names, strict=True)), *(F.col(c) for c in out.columns[len(kept) :]))


def _node_columns() -> list[Column]:
    return [F.col(c.split()[0]) for c in NODE.split(", ")]


def expanded(part: pa.Table, got: pa.Table, trees: int, kept: list[str]) -> pa.Table:
    """The results of one block of leaves: shared levels derived once, proofs spelled out for each leaf."""
    part = part.sort_by("pos")
    pos = part.column("pos").to_numpy()
    tree, size = (part.column(c)[0].as_py() for c in ("tree", "size"))
    own = part.column("digest").to_pylist()
    known = {x[:3]: x[3] for x in zip(*(got.column(c).to_pylist() for c in ("of", "level", "pos", "digest")), strict=True)}
    known |= {(tree, 0, p): d for p, d in zip(pos.tolist(), own, strict=True)}
    levels = derive(known, tree, pos, size)
    subroot = known[TOP, 0, tree] = known[tree, len(levels), 0]
    above = derive(known, TOP, np.array([tree]), trees)
    root = known[TOP, len(above), 0]
    # the path of siblings from a node up to the root: those of its run, then its parent's path
    paths = {0: tuple(beside(known, TOP, level, places_of[0], n) for level, places_of, n in above)}
    for level, places_of, n in reversed(levels):
        paths = {p: (beside(known, tree, level, p, n), *paths[p // FAN]) for p in places_of}
    proofs, folds = [], []
    for p, claim in zip(pos.tolist(), part.column("_claim").to_pylist(), strict=True):
        proofs.append(digest("".join(a + b for a, b in paths[p])))
        for a, b in paths[p]:
            claim = digest(a + claim + b)
        folds.append(claim)
    n = len(own)
    columns = [part.column(k) for k in kept] + [pa.array(x, pa.string()) for x in (own, [subroot] * n, [root] * n, proofs, folds)]
    return pa.table([*columns, pa.array([f == root for f in folds])], [*kept, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def derive(known: dict[tuple[int, int, int], str], tree: int, pos: np.ndarray, size: int) -> list[tuple[int, list[int], int]]:
    """Add the nodes above ``pos`` to the known ones. (level, places, size) of each level passed, the root's left out."""
    levels = []
    here = np.unique(pos)
    while size > 1:
        level, runs = len(levels), np.unique(here // FAN)
        for r in runs.tolist():
            known[tree, level + 1, r] = digest("".join(known[tree, level, p] for p in range(r * FAN, min(size, r * FAN + FAN))))
        levels.append((level, here.tolist(), size))
        here, size = runs, -(-size // FAN)
    return levels


def beside(known: dict[tuple[int, int, int], str], tree: int, level: int, pos: int, size: int) -> tuple[str, str]:
    """The digests left and right of a node in its run."""
    first = pos // FAN * FAN
    return ("".join(known[tree, level, p] for p in range(first, pos)), "".join(known[tree, level, p] for p in range(pos + 1, min(size, first + FAN))))
