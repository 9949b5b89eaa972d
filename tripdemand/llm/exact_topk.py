"""Exact top-k search by inner product with the three-phase uniform threshold method.

Vectors are cut into segments of components; a vector's score for a query is the sum of
its segment scores, so each segment is one score list.

1. Every block of vectors gives, for each query, the entries that lead its local segment
   lists, with their sums. The k-th largest sum over all blocks is a safe cutoff: no more
   than k - 1 vectors can be left out above it.
2. The cutoff goes back to the blocks. A sum of m parts reaches it only if some part
   reaches a m-th of it, so each block collects the entries at or above that uniform
   threshold in any segment. That is sufficient and usually few.
3. The remaining scores are resolved exactly, and the k best of each block are merged.

Queries meet all vectors block by block: an equi-join of query blocks, repeated for each
vector block, with the vector blocks. A block is one row of packed integers of bounded
size, so no task holds more than two blocks.

Components become floor(scale * x). Vectors that are null or hold a null or non-finite
component, or have a null id, take no part; shorter vectors count as padded with zeros, empty
ones as all zeros. Every row is a vector of its own, also where rows repeat an id: a query row
meets all rows but itself. Ties go to the smaller id. With fewer than k candidates all are
returned; an empty table gives an empty result. A component, or a score among the best of a
block of vectors, that does not fit a long is an error; sums on the way are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers, stored

VECTORS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 512
SEGMENTS = 4
#: Largest absolute component whose products of up to 2 ** 12 components stay exact in doubles.
EXACT = 1 << 20
LONG = np.iinfo(np.int64)
RESULT = "query long, query_id long, vec_id long, score long"


def to_integers(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, v) of the vectors that take part; ``row`` is a number of the row's own."""
    x = F.col("_v")
    whole = (
        vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
        .where(F.col("_id").isNotNull() & x.isNotNull())
        .where(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))))
    )
    scaled = F.transform(x, lambda e: F.lit(float(scale)) * e)
    fits = F.forall(scaled, lambda e: (e >= -(2.0**63)) & (e < 2.0**63))
    ints = F.when(fits, F.transform(scaled, lambda e: F.floor(e).cast("long"))).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("array<long>"))
    # kept, so that a row's number is the same wherever it is read
    return stored(whole.select(F.monotonically_increasing_id().alias("row"), F.col("_id").alias("vec_id"), ints.alias("v")))


def packed(vectors: DataFrame, per_block: int) -> DataFrame:
    """(block, rows, ids, width, data): bounded blocks of vectors, each one row of packed integers."""
    blocks = max(1, math.ceil(vectors.count() / per_block))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        width = max(1, *map(len, rows["v"]))
        data = np.zeros((len(rows), width), np.int64)
        for i, v in enumerate(rows["v"]):
            data[i, : len(v)] = v
        numbers = [[rows[c].to_numpy(np.int64).tobytes()] for c in ("row", "vec_id")]
        return pd.DataFrame({"block": [int(rows["block"].iloc[0])], "rows": numbers[0], "ids": numbers[1], "width": [width], "data": [data.tobytes()]})

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, "block int, rows binary, ids binary, width int, data binary")


def _matrix(data: bytes, width: int, to: int) -> np.ndarray:
    out = np.frombuffer(data, np.int64).reshape(-1, width)
    return np.pad(out, ((0, 0), (0, to - width)))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: by doubles where they are exact, else by Python's integers."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT and a.shape[1] <= 4096:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(object) @ b.T.astype(object)


def _leading(line: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest."""
    if line.dtype == object:  # whole numbers of any size
        return np.argsort(line, kind="stable")[-k:]
    return np.argpartition(line, -min(k, len(line)))[-k:]


def _longs(numbers: np.ndarray | list) -> np.ndarray:
    out = np.array(numbers, object)
    if len(out) and (max(out) > LONG.max or min(out) < LONG.min):
        raise OverflowError("a score does not fit a long")
    return out.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, by falling score, then rising id."""
    if len(scores) > 4 * k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    by_id = some[np.argsort(ids[some], kind="stable")]
    return by_id[np.argsort(-scores[by_id], kind="stable")[:k]]


class Meeting(NamedTuple):
    """A query block and a vector block: the numbers and ids of their rows, and matrices of one width."""

    row: pd.Series
    q_rows: np.ndarray
    q_ids: np.ndarray
    q: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    v: np.ndarray

    def segments(self, n: int) -> list[np.ndarray]:
        """Each segment's scores, queries by vectors."""
        return [_product(self.q[:, c], self.v[:, c]) for c in np.array_split(np.arange(self.q.shape[1]), n)]


def _meetings(batches: Iterator[pd.DataFrame]) -> Iterator[Meeting]:
    for rows in batches:
        for _, r in rows.iterrows():
            to = max(r["width"], r["q_width"])
            numbers = (np.frombuffer(r[c], np.int64) for c in ("q_rows", "q_ids", "rows", "ids"))
            q_rows, q_ids, v_rows, ids = numbers
            yield Meeting(r, q_rows, q_ids, _matrix(r["q_data"], r["q_width"], to), v_rows, ids, _matrix(r["data"], r["width"], to))


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
               vectors_per_block: int = VECTORS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK, segments: int = SEGMENTS) -> DataFrame:
    """For every query row (``is_query``, over vec_id) its k best other vectors.

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = vectors.sparkSession
    on_workers(spark)
    numbers = to_integers(vectors, scale, id_col, vector_col)
    blocks = stored(packed(numbers, vectors_per_block))
    queries = stored(packed(numbers.where(is_query), queries_per_block))
    n_blocks, n_queries = blocks.count(), queries.count()
    if not n_blocks or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    to = queries.select(F.col("block").alias("q_block"), *(F.col(c).alias(f"q_{c}") for c in ("rows", "ids", "width", "data")))
    pairs = to.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(r[0] for r in blocks.agg(F.max("block")).collect()))))).join(blocks, "block")
    # a block pair is heavy and there are few: one to a task
    pairs = pairs.repartition(min(n_blocks * n_queries, int(spark.conf.get("spark.sql.shuffle.partitions"))), "q_block", "block")

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for m in _meetings(batches):
            parts = m.segments(segments)
            total = sum(parts)
            rows, sums = [], []
            for i in range(len(m.q_rows)):
                other = np.flatnonzero(m.rows != m.q_rows[i])
                if len(other):
                    lead = np.unique(np.concatenate([other[_leading(p[i, other], k)] for p in parts]))
                    top = np.sort(total[i, lead])[::-1][:k]
                    rows += [m.q_rows[i]] * len(top)
                    sums += top.tolist()
            yield pd.DataFrame({"q_block": int(m.row["q_block"]), "query": np.array(rows, np.int64), "score": _longs(sums)})

    lists = pairs.mapInPandas(gather, "q_block int, query long, score long")
    # at most k sums of each block and query; their k-th largest bounds the true one from below
    kept = F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, k)
    cutoffs = lists.groupBy("q_block", "query").agg(kept.alias("top"))
    least = F.when(F.size("top") == k, F.element_at("top", k))  # null: all are among the best
    cutoffs = cutoffs.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("query", least.alias("cutoff")))).alias("cut"))

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for m in _meetings(batches):
            cut = {c["query"]: c["cutoff"] for c in m.row["cut"]}
            parts = m.segments(segments)
            found = []
            for i, (query, query_id) in enumerate(zip(m.q_rows, m.q_ids, strict=True)):
                cutoff = cut.get(query)
                some = m.rows != query
                if cutoff is not None:
                    uniform = -((-int(cutoff)) // segments)  # a sum at the cutoff has a part at least this large
                    some &= np.any([p[i] >= uniform for p in parts], axis=0)
                at = np.flatnonzero(some)
                score = _product(m.q[i : i + 1], m.v[at])[0]
                if cutoff is not None:
                    at, score = at[score >= cutoff], score[score >= cutoff]
                best = _best(score, m.ids[at], k)
                found.append((np.full(len(best), query), np.full(len(best), query_id), m.ids[at][best], _longs(score[best])))
            yield pd.DataFrame(dict(zip(("query", "query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    # ~score falls as the score rises, and exists for every long
    best = F.slice(F.array_sort(F.collect_list(F.struct(F.bitwise_not("score").alias("s"), "vec_id", "score"))), 1, k)
    # block pairs without a cutoff row have no candidate but the query itself
    merged = pairs.join(cutoffs, "q_block").mapInPandas(resolve, RESULT).groupBy("query", "query_id").agg(best.alias("b"))
    return merged.select("query_id", F.posexplode("b")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), F.col("col.score").alias("score"))
