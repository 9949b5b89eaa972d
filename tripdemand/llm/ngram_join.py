"""N-gram Jaccard self-join of documents: MinHash candidates, Bayesian pruning, exact check.

Texts become lower-case words (runs of ASCII letters, digits and non-ASCII characters) and
sets of five-word shingles; a text of one to four words has one shingle of all of them.
Two documents are linked if the Jaccard similarity of their sets is at least ``threshold``.

1. Rows with the same set of shingles are one class of copies; one of them stands for it.
2. Every representative has a MinHash signature. Representatives that agree in all rows
   of a band are in one bucket; buckets are joined to coarse groups (connected
   components), so every candidate pair lies within one group and each representative
   travels once, not once a band. Groups of more than ``BLOCK`` members are cut into
   blocks, and every two blocks of a group meet in a task of their own.
3. Within a meeting, the pairs that share a band compare their signatures step by step.
   After each step the posterior probability (uniform prior, hence a Beta tail) that the
   similarity reaches the threshold, given the agreements so far, decides: pairs below
   ``TOLERANCE`` are dropped, the rest go on.
4. Pairs that survive are verified on their shingle sets.

A meeting returns the links of each member and a spanning forest of the verified pairs,
never the pairs themselves. A pair at the threshold shares no band with a probability of
(1 - threshold ** ROWS) ** BANDS (5e-5 at 0.8), and is pruned at any step only if its
agreements are that unlikely.

Result: one row per document row: its class (the smallest id linked to it, directly or
through others) and n_links, the number of other representatives it is linked to. Texts
that are null or without words take no part: class of their own, no links. Rows repeating
a text are copies. An id with several texts is a node for one of them (the smallest by its
keys). Null ids are excluded from the result, since they can't be named.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.components import components
from tripdemand.llm.stored import on_workers, stored
from tripdemand.llm.text_arrays import U64, RangeHash, chunks, flatten, mix, strings

WORDS = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 25
TOLERANCE = 1e-4
#: Signature values compared between two prunings.
STEP = 25
#: Members of a coarse group that one side of a meeting holds.
BLOCK = 256
SEED = 7
CHUNK_BYTES = 512 << 10


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, distinct 64-bit shingles of all texts end to end, and the number for each."""
    data, starts = flatten(t.lower() if t else t for t in texts)
    n = len(starts) - 1
    if not len(data):
        return np.zeros(0, U64), np.zeros(n, np.int64)
    is_word = np.zeros(256, bool)
    is_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    inside = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    begin = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | first[:-1]))
    end = np.flatnonzero(inside & (np.append(~inside[1:], True) | first[1:])) + 1
    word = RangeHash(data).of(begin, end)
    doc = np.searchsorted(starts, begin, "right") - 1
    per_doc = np.bincount(doc, minlength=n)
    at = np.cumsum(per_doc) - per_doc
    size = np.minimum(per_doc, WORDS)
    heads = np.concatenate([np.flatnonzero(np.arange(len(word)) + WORDS <= (at + per_doc)[doc]), at[(per_doc > 0) & (per_doc < WORDS)]])
    of = doc[heads]
    value = np.zeros(len(heads), U64)
    for k in range(WORDS):
        live = k < size[of]
        value[live] = mix(value[live] + word[heads[live] + k] + U64(k + 1))
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])) if len(value) else np.zeros(0, bool)
    return value[new], np.bincount(of[new], minlength=n)


def set_keys(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit keys of each set, equal for equal sets (0 for empty ones)."""
    some = counts > 0
    at = (np.cumsum(counts) - counts)[some]
    keys = np.zeros((2, len(counts)), U64)
    if len(at):
        keys[0, some] = np.add.reduceat(mix(values), at) ^ counts[some].astype(U64)
        keys[1, some] = np.add.reduceat(mix(values + U64(1)), at)
    return keys


@cache
def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, count, dtype=np.uint64) * U64(2) + U64(1)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The MinHash signature (uint32) of each non-empty set."""
    at = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(at), ROWS * BANDS), np.uint32)
    if len(at):
        for j, m in enumerate(_multipliers(ROWS * BANDS)):
            out[:, j] = np.minimum.reduceat(((values * m) >> U64(32)).astype(np.uint32), at)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key of each signature and band."""
    out = np.empty((len(sig), BANDS), U64)
    for b in range(BANDS):
        key = np.full(len(sig), b + 1, U64)
        for j in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key + sig[:, j])
        out[:, b] = key
    return out


@cache
def fewest_agreements(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each multiple of STEP values compared, the fewest agreements with which a pair stays.

    With a uniform prior the posterior after m agreements of n is Beta(m + 1, n - m + 1);
    its tail at the threshold is a sum of binomial terms.
    """
    out = []
    for n in range(STEP, ROWS * BANDS + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail = sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
        out.append(m)
    return tuple(out)


def surviving(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of signatures that no step of the comparison prunes."""
    agreed = np.zeros(len(i), np.int64)
    for step, least in enumerate(fewest_agreements(threshold, TOLERANCE)):
        part = slice(step * STEP, (step + 1) * STEP)
        agreed += (left[i, part] == right[j, part]).sum(1)
        live = agreed >= least
        i, j, agreed = i[live], j[live], agreed[live]
    return i, j


def linked(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs of shingle sets reach the threshold, exactly."""
    out = np.zeros(len(i), bool)
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = left[a], right[b]
        if min(len(x), len(y)) >= threshold * max(len(x), len(y)) - 1e-9:
            at = np.searchsorted(x, y)
            at[at == len(x)] = 0
            both = int((x[at] == y).sum())
            out[k] = both >= threshold * (len(x) + len(y) - both) - 1e-9
    return out


def _meet(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links and spanning edges of the members of one meeting of two blocks (or one with itself)."""
    rows = rows.sort_values("rep").reset_index(drop=True)
    sets = [np.frombuffer(s, U64) for s in rows["shingles"]]
    sig = signatures(np.concatenate(sets), np.array([len(s) for s in sets]))
    keys = band_keys(sig)
    side = rows["side"].to_numpy()
    ids = rows["rep"].to_numpy(np.int64)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(b)
    other = a if alone else b
    links, edges = np.zeros(len(rows), np.int64), []
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for at, p in enumerate(a):  # one member against a block: at most BLOCK pairs at a time
        against = other[at + 1 :] if alone else other
        near = against[(keys[against] == keys[p]).any(1)]
        i, j = surviving(sig, sig, np.full(len(near), p), near, threshold)
        for q in j[linked(sets, sets, i, j, threshold)].tolist():
            links[p] += 1
            links[q] += 1
            x, y = find(int(p)), find(q)
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((ids[p], ids[q]))
    some = np.flatnonzero(links)
    out = [(int(ids[x]), None, int(links[x])) for x in some] + [(int(x), int(y), 0) for x, y in edges]
    # column by column: a frame of rows would turn ids beside nulls into floats, exact to 2**53 only
    return pd.DataFrame({c: pd.array([r[k] for r in out], dtype="Int64") for k, c in enumerate(("a", "b", "n"))})


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, n_links) of every document row with an id."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")

    on_workers(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK_BYTES):
            values, counts = shingle_sets(strings(batch.column("text")))
            some = counts > 0
            keys = set_keys(values, counts)
            sig = signatures(values, counts)
            bands = np.zeros((len(counts), BANDS), np.int64)
            bands[some] = band_keys(sig).view(np.int64)
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(np.where(some, BANDS, 0))).astype(np.int32), pa.array(bands[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(k.view(np.int64)) for k in keys), pa.array(counts), lists], ["id", "k1", "k2", "size", "bands"])

    # ids, keys of the set and band keys: about 250 bytes a document, written once and read three times
    prints = stored(source.mapInArrow(digest, "id long, k1 long, k2 long, size long, bands array<long>"))
    worded = prints.where("size > 0")
    sets = ["k1", "k2", "size"]
    # an id with several texts stands for the one whose keys are smallest
    named = worded.groupBy("id").agg(F.min(F.struct(*sets)).alias("s")).select("id", "s.*")
    copies = stored(named.groupBy(*sets).agg(F.min("id").alias("rep")))
    bands = worded.join(copies.select(*sets, F.col("rep").alias("id")), [*sets, "id"], "left_semi").dropDuplicates(["id"])
    buckets = bands.select("id", F.explode("bands").alias("key"))
    # the smallest member of a bucket stands for it; a bucket of one has no edge
    heads = buckets.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head < last").select("key", "head")
    coarse = components(buckets.join(heads, "key").select(F.col("head").alias("a"), F.col("id").alias("b")))
    groups = stored(coarse.select(F.col("node").alias("rep"), F.col("component").alias("grp")))

    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    member = groups.join(sizes, "grp").select("rep", "grp", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK_BYTES):
            values, counts = shingle_sets(strings(batch.column("text")))
            ends = np.append(0, np.cumsum(counts)) * 8
            data = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])
            keys = [pa.array(k.view(np.int64)) for k in set_keys(values, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *keys, data], ["rep", "k1", "k2", "shingles"])

    wanted = source.join(groups.select("rep"), F.col("id") == F.col("rep"), "left_semi").mapInArrow(sets_of, "rep long, k1 long, k2 long, shingles binary")
    shingles = wanted.join(copies.select("rep", "k1", "k2"), ["rep", "k1", "k2"], "left_semi").dropDuplicates(["rep"]).select("rep", "shingles")
    # a block meets itself and every other block of its group; (low, high) names the meeting
    meeting = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("low"), F.greatest("block", o).alias("high"), F.when(F.col("block") <= o, 0).otherwise(1).alias("side")))
    meetings = member.join(shingles, "rep").select("rep", "grp", "shingles", F.explode(meeting).alias("m")).select("rep", "grp", "shingles", "m.*")
    met = stored(meetings.groupBy("grp", "low", "high").applyInPandas(lambda rows: _meet(rows, threshold), "a long, b long, n long"))

    classes = components(met.where("b is not null").select("a", "b")).select(F.col("node").alias("rep"), F.col("component").alias("class_id"))
    links = met.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
    reps = copies.join(classes, "rep", "left").join(links, "rep", "left").select(
        *sets, F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    of = named.join(reps, sets).select("id", "class_id", "n_links")
    rows = source.select("id").join(of, "id", "left")
    return rows.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near duplicates: of each class the row with the smallest id.

    Rows that repeat an id stay together; rows without an id stay.
    """
    gone = near_duplicate_classes(docs, id_col, text_col, threshold).where(F.col(id_col) != F.col("class_id")).select(F.col(id_col).cast("long").alias("_gone_id")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone_id"], "left_anti")


def one_row_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near duplicates: of each class of texts one row, that with the smallest id, null last.

    Texts are the nodes, by a 63-bit number, so ids may repeat, have several texts or be null.
    Rows of one id go by their other columns; texts without words stay.
    """
    at, of = (next(f"_{c}{i}" for i in range(len(docs.columns) + 1) if f"_{c}{i}" not in docs.columns) for c in ("node", "row"))  # names that no column has
    node, row = F.xxhash64(F.col(f"`{text_col}`")).bitwiseAND(F.lit(2**63 - 1)), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    worded = docs.where(F.col(f"`{text_col}`").rlike(r"[A-Za-z0-9\x{80}-\x{10FFFF}]"))
    texts = worded.select(node.alias(at), F.col(f"`{text_col}`").alias("_text"))
    classes = near_duplicate_classes(texts, at, "_text", threshold).select(at, F.col("class_id").alias("_class")).distinct()
    ranks = worded.select(node.alias(at), F.struct(F.col(f"`{id_col}`").isNull().alias("no"), F.col(f"`{id_col}`").alias("id"), row.alias("row")).alias("rank"))
    classed = stored(ranks.groupBy(at, "rank").agg(F.count(F.lit(1)).alias("n")).join(classes, at))
    first = classed.groupBy("_class").agg(F.min("rank").alias("first"))
    keys = [at, of]
    gone = classed.join(first, "_class").where(F.col("rank") != F.col("first")).select(at, F.col("rank.row").alias(of))
    kept = docs.withColumns({at: node, of: row}).join(gone, keys, "left_anti")
    equal = classed.join(first, "_class").where((F.col("rank") == F.col("first")) & (F.col("n") > 1)).select(at, F.col("rank.row").alias(of))
    if not equal.isEmpty():  # rows equal in all columns
        kept = kept.join(equal, keys, "left_anti").unionByName(kept.join(equal, keys, "left_semi").dropDuplicates(keys))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
