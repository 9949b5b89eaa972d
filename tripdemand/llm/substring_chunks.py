"""Substring deduplication by content-defined chunks.

A gear rolling hash runs over the UTF-8 bytes of every text. A chunk starts where no hash
within ``REACH`` positions to either side is smaller, so the cuts depend on the bytes
around them alone: an insertion moves no cut beyond its neighbourhood, and periodic text
is cut once a period. Stretches without such a place (long runs of one character) are
cut every ``LONGEST`` bytes. Chunks are compared by 128-bit digests.

A run of consecutive chunks that each occur more than once in the corpus, of at least
``LEAST_RUN`` bytes, is a repeated passage. The first occurrence of a chunk (smallest id,
then position) is kept, the others are removed. The chunks at the two ends of a passage
also hold bytes around it, so a run is up to about two chunks shorter than its passage.
With ``whole`` a run that is all of a document is a passage whatever its length.

Digest counts are combined map-side, and only chunks that occur twice are joined back,
so a passage of a third of all documents is no single task's work. Null and empty texts
have no chunks. Null ids take no part, since removals could not be named. Rows repeating
an id and a text count as one document; an id with several texts has the chunks of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers, written
from tripdemand.llm.text_arrays import RangeHash, chunks, flatten, strings

REACH = 16
LONGEST = 256
LEAST_RUN = 96
GEAR_BITS = 32
SEED = 9
TEXT_BYTES = 512 << 10
CHUNK = "id long, doc long, size int, at int, len int, d1 long, d2 long"


def gear_hash(data: np.ndarray) -> np.ndarray:
    """hash[i] = (hash[i - 1] << 1) + gear[data[i]], in 32 bits: the last 32 bytes count."""
    table = np.random.default_rng(SEED).integers(0, 2**GEAR_BITS, 256, dtype=np.uint32)
    h = table[data]
    step = 1
    while step < GEAR_BITS:  # twice as many bytes each time
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h, step = more, step * 2
    return h


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values from a position on."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        np.minimum(out[:-step], out[step:], out=out[:-step])
        have += step
    return out


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the chunks of all documents start, rising; every document starts one."""
    h = gear_hash(data)
    none = np.uint32(2**32 - 1)
    padded = np.concatenate([np.full(REACH, none), h, np.full(REACH + 1, none)])
    before = least_of(padded, REACH)[: len(h)]
    after = least_of(padded, REACH)[REACH + 1 : REACH + 1 + len(h)]
    # hashes and neighbours of other documents must not decide
    offset = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(data))
    cut = (h <= before) & (h <= after) & (offset >= REACH + GEAR_BITS) & (left > REACH)
    cut[1:] &= ~cut[:-1]  # in a run of one character all hashes are equal
    cut[starts[:-1][np.diff(starts) > 0]] = True
    at = np.flatnonzero(cut)
    size = np.diff(np.append(at, len(data)))
    if len(size) and size.max() > LONGEST:
        parts = -(-size // LONGEST)
        first = np.repeat(at, parts)
        at = first + (np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)) * LONGEST
    return at


def find_chunks(docs: DataFrame, id_col: str, text_col: str, short: int = 0) -> DataFrame:
    """The chunks of every document: id, a number and the bytes of its text (0 from ``short`` bytes on), at and len in bytes, digest."""

    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", TEXT_BYTES):
            data, starts = flatten(strings(batch.column("text")))
            if not len(data):
                continue
            at = cuts(data, starts)
            end = np.append(at[1:], len(data))
            doc = np.searchsorted(starts, at, "right") - 1
            d = [RangeHash(data, base).of(at, end).view(np.int64) for base in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
            text = RangeHash(data, 0x9E3779B97F4A7C15).of(starts[:-1], starts[1:]).view(np.int64)
            size = np.diff(starts)
            few = size < short
            cols = [batch.column("id").to_numpy()[doc], np.where(few, text, 0)[doc], np.where(few, size, 0)[doc].astype(np.int32), (at - starts[doc]).astype(np.int32), (end - at).astype(np.int32), *d]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "doc", "size", "at", "len", "d1", "d2"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    return source.mapInArrow(run, CHUNK)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = LEAST_RUN, whole: bool = False) -> DataFrame:
    """The repeated passages: id, start, end (bytes), n_chunks, n_removed (bytes of the chunks not kept here).

    ``whole``: runs of all chunks of a text are passages even if shorter than ``least_run``.
    """
    found = find_chunks(docs, id_col, text_col, least_run if whole else 0)
    # half of the digest is enough to leave out what occurs once
    maybe = found.select("d1", "id", "at").groupBy("d1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("d1")
    several = written(found.join(maybe, "d1", "left_semi").select(*found.columns), "chunks")
    first = several.groupBy("d1", "d2").agg(F.min(F.struct("id", "at")).alias("first"), F.max(F.struct("id", "at")).alias("last")).where("first < last")
    # written: a join of two plain shuffles, of which Spark splits what a hot digest has
    first = written(first.select("d1", "d2", "first"), "firsts")
    parts = several.join(first, ["d1", "d2"]).select("id", "doc", "size", "at", "len", (F.struct("id", "at") != F.col("first")).alias("gone"))
    each = parts.select("id", "at", "len", "gone").distinct()
    by_place = Window.partitionBy("id").orderBy("at", "len")
    new = F.coalesce(F.lag(F.col("at") + F.col("len")).over(by_place) != F.col("at"), F.lit(True))
    runs = each.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    passages = runs.groupBy("id", "run").agg(
        F.min("at").alias("start"), F.max(F.col("at") + F.col("len")).alias("end"), F.count(F.lit(1)).alias("n_chunks"),
        F.sum(F.when(F.col("gone"), F.col("len")).otherwise(0)).alias("n_removed"))
    found_runs = passages.where(F.col("end") - F.col("start") >= least_run).select("id", "start", "end", "n_chunks", "n_removed")
    if whole:
        short = parts.where("size > 0").distinct().groupBy("id", "doc").agg(
            F.lit(0).alias("start"), F.max("size").alias("end"), F.count(F.lit(1)).alias("n_chunks"),
            F.sum(F.when(F.col("gone"), F.col("len")).otherwise(0)).alias("n_removed"), F.sum("len").alias("held"))
        found_runs = found_runs.unionAll(short.where(F.col("held") == F.col("end")).select(*found_runs.columns))
    return found_runs.withColumnRenamed("id", id_col)


def repeated_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = LEAST_RUN, whole: bool = False) -> DataFrame:
    """One row per document with repeated passages: id, n_passages, n_repeated and n_removed (bytes), passages (``start:end``, comma-joined)."""
    by = repeated_passages(docs, id_col, text_col, least_run, whole).groupBy(id_col)
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    shown = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return by.agg(F.count(F.lit(1)).alias("n_passages"), F.sum(F.col("end") - F.col("start")).alias("n_repeated"), F.sum("n_removed").alias("n_removed"), shown.alias("passages"))
