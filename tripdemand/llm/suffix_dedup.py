"""Suffix-array deduplication: remove every byte covered by a 200-byte string seen twice.

Texts are UTF-8 bytes. A window is a string of ``length`` bytes within a document; it is
repeated if it also starts anywhere else, in another document or the same one.

1. Meeting places. Every window names the position of the smallest rolling hash among its
   32-byte grams; equal windows name equal grams at equal offsets. Windows next to each
   other mostly name the same position, so a document is a list of *sites*: an anchor
   gram and a span, the bytes of the windows naming it. Anchors that occur once are done.
2. Equal spans. Sites with the same anchor and the same span repeat each other's windows;
   one of them stands for all.
3. Suffix arrays. The different spans of an anchor go to one task, many anchors at a time,
   and are laid end to end with separators. Two-stage sorting: only suffixes smaller than
   their successors are sorted directly, the rest is induced by one scan of the buckets.
   Windows whose common prefix with a neighbour is a whole window are repeated.
   Anchors with more than ``SPANS_PER_ANCHOR`` different spans (a passage shared by a
   third of all documents has as many at its edges) count their windows by 128-bit digest
   instead, which aggregates before the shuffle and needs no group in one task.
4. Removal. The repeated windows of a document are joined to its text and cut out.

Anchors and spans are compared by 64-bit hashes each, spans of different sites by bytes.
Null and empty texts have no bytes and no removal. Every row is a document: rows that
repeat a text are copies of each other, whatever their ids (null too).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers, written
from tripdemand.llm.text_arrays import U64, RangeHash, chunks, mix, ranges, strings

LENGTH = 200
GRAM = 32
SEED = 5
#: Bytes of text handled at a time when sites are found; keeps the arrays in cache.
SITE_BYTES = 256 << 10
CHUNK_BYTES = 4 << 20
#: Bytes of text cut at a time; each takes some sixteen bytes of counts.
CUT_BYTES = 1 << 20
#: Different spans in one suffix array, about.
SPANS_PER_ARRAY = 8192
SPANS_PER_ANCHOR = 20_000

SITE = "a long, g long, k1 long, k2 int, lo int, n int"


# sites ------------------------------------------------------------------------


def gear(data: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The gear hash (uint32) of the last ``width`` bytes (a power of two) at each position."""
    table = np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)
    h = table[data]
    step = 1
    while step < width:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h, step = more, step * 2
    return h


def sites(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows) of all sites of documents laid end to end."""
    n = len(data)
    ends = np.repeat(starts[1:], np.diff(starts))
    at = np.flatnonzero(np.arange(n) + length <= ends)
    if not len(at):
        return at, at, at
    gram = np.full(n, 2**32 - 1, np.uint64)
    gram[: n - GRAM + 1] = gear(data, GRAM, SEED)[GRAM - 1 :]
    least = (gram << U64(32)) | np.arange(n, dtype=U64)  # ties go to the leftmost
    grams, width = length - GRAM + 1, 1
    while width * 2 <= grams:
        np.minimum(least[:-width], least[width:], out=least[:-width])
        width *= 2
    if grams > width:
        np.minimum(least[: width - grams], least[grams - width :], out=least[: width - grams])
    anchor = (least[at] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(new)
    return anchor[first], at[first], np.diff(np.append(first, len(at)))


def site_keys(data: np.ndarray, anchor: np.ndarray, lo: np.ndarray, n: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each anchor gram, and of each span with the place of the anchor in it."""
    of = RangeHash(data).of
    return of(anchor, anchor + GRAM), of(lo, lo + n + (length - 1)) ^ mix((anchor - lo).astype(U64))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of a binary column."""
    parts = [x or b"" for x in strings(column)]
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)


def find_sites(texts: DataFrame) -> DataFrame:
    """The sites of (k1, k2, data): anchor and span hashes, the document's key, first window, windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "data", SITE_BYTES):
            data, starts = _flat(batch.column("data"))
            anchor, lo, n = sites(data, starts)
            if not len(lo):
                continue
            a, g = site_keys(data, anchor, lo, n)
            doc = np.searchsorted(starts, lo, "right") - 1
            k1, k2 = (batch.column(k).to_numpy(zero_copy_only=False)[doc] for k in ("k1", "k2"))
            cols = (a.view(np.int64), g.view(np.int64), k1, k2, (lo - starts[doc]).astype(np.int32), n.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "g", "k1", "k2", "lo", "n"])

    return texts.select("k1", "k2", "data").mapInArrow(run, SITE)


# suffix arrays ----------------------------------------------------------------


def next_words(sym: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The eight symbols from each position as one big-endian number; zeros after the separator.

    ``rest`` is the number of symbols before the next separator.
    """
    wide = np.concatenate([sym, np.zeros(8, np.uint8)]).astype(U64)
    pair = (wide[:-1] << U64(8)) | wide[1:]
    four = (pair[:-2] << U64(16)) | pair[2:]
    eight = ((four[:-4] << U64(32)) | four[4:])[: len(sym)]
    cut = np.minimum(rest, 8).astype(U64)
    return np.where(cut == 8, eight, (eight >> ((U64(8) - cut) * U64(8) % U64(64))) << ((U64(8) - cut) * U64(8) % U64(64))) * (cut > 0)


def sort_directly(at: np.ndarray, words: np.ndarray, rest: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``depth`` symbols, cut at separators."""
    if not len(at):
        return at
    order = at[np.argsort(words[at], kind="stable")]
    key = words[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    for o in range(8, depth, 8):
        # groups of equal prefixes in which some suffix goes on
        open_ = (np.bincount(group) > 1) & (np.bincount(group, weights=rest[order] > o) > 0)
        tied = np.flatnonzero(open_[group])
        if not len(tied):
            break
        of = order[tied]
        _, rank = np.unique(np.where(rest[of] > o, words[np.minimum(of + o, len(words) - 1)], U64(0)), return_inverse=True)
        again = np.argsort(group[tied] * np.int64(rank.max() + 1) + rank, kind="stable")
        order[tied] = of[again]
        value = np.full(len(order), -1, np.int64)
        value[tied] = rank[again]
        group = np.cumsum(np.append(False, (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
    return order


def suffix_array(sym: np.ndarray, words: np.ndarray, rest: np.ndarray, depth: int, asked: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of ``sym`` (0: separator) in the order of at least their first ``depth`` symbols.

    With ``asked`` (which positions matter), those and the ones their places are induced from.

    Two stages. Suffixes smaller than their successors are sorted directly. Every other
    suffix starts with a symbol not below its successor's, so it comes later in the scan
    of the buckets than its successor, and takes its place from there.
    """
    step = np.append(np.sign(sym[1:].astype(np.int16) - sym[:-1]), -1)
    turn = np.flatnonzero(step)  # a run of equal symbols is decided where it ends
    smaller = step[turn[np.searchsorted(turn, np.arange(len(sym)))]] > 0
    if asked is None:
        asked = np.ones(len(sym), bool)
    # a suffix that is induced needs its successors, up to one that is sorted directly
    need = asked.copy()
    edge = np.flatnonzero(asked & ~np.append(asked[1:], False) & ~smaller)
    sorted_ones = np.append(np.flatnonzero(smaller), len(sym) - 1)
    need[ranges(edge + 1, sorted_ones[np.searchsorted(sorted_ones[:-1], edge)] - edge)] = True
    direct = sort_directly(np.flatnonzero(smaller & need), words, rest, depth)
    heads = sym[direct]
    pending: dict[int, list[np.ndarray]] = {int(c): [] for c in np.flatnonzero(np.bincount(sym, minlength=256))}
    if need[-1]:
        pending[int(sym[-1])].append(np.array([len(sym) - 1]))
    out = []
    for c in sorted(pending):
        own = np.concatenate([*pending[c], np.zeros(0, np.int64)])
        larger = [own]
        while len(own):  # runs of the same symbol induce within their bucket
            own = own[own > 0] - 1
            own = own[(sym[own] == c) & ~smaller[own] & need[own]]
            larger.append(own)
        bucket = np.concatenate([*larger, direct[np.searchsorted(heads, c) : np.searchsorted(heads, c, "right")]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(sym[before] > c) & need[before]]
        to = sym[before]
        before = before[np.argsort(to, kind="stable")]
        sizes = np.bincount(to, minlength=256)
        ends = np.cumsum(sizes)
        for d in np.flatnonzero(sizes):
            pending[int(d)].append(before[ends[d] - sizes[d] : ends[d]])
    return np.concatenate(out)


def repeated_windows(spans: list[bytes], windows: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each span, which of its windows also starts elsewhere in the spans."""
    sizes = np.array([len(s) for s in spans], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    sym = np.frombuffer(b"\xff".join([*spans, b""]), np.uint8) + np.uint8(1)  # no byte of UTF-8 is 0xff
    rest = np.repeat(ends - 1, sizes + 1) - np.arange(len(sym))
    words = next_words(sym, rest)
    is_window = np.zeros(len(sym), bool)
    counts = np.array(windows, np.int64)
    is_window[ranges(starts, counts)] = True
    order = suffix_array(sym, words, rest, length, is_window)
    order = order[is_window[order]]
    # common prefixes of neighbours, eight symbols at a time, as far as a window
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for o in [*range(0, length - 7, 8), length - 8]:
        same = same[words[a[same] + o] == words[b[same] + o]]
    repeated = np.zeros(len(sym), bool)
    repeated[a[same]] = True
    repeated[b[same]] = True
    return [np.flatnonzero(repeated[s : s + n]) for s, n in zip(starts.tolist(), windows, strict=True)]


def _array_task(rows: pd.DataFrame) -> pd.DataFrame:
    found = repeated_windows(rows["span"].tolist(), rows["n"].tolist())
    some = [k for k, f in enumerate(found) if len(f)]
    return pd.DataFrame({"a": rows["a"].to_numpy()[some], "g": rows["g"].to_numpy()[some], "dup": [found[k].astype(np.int32) for k in some]})


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "span", SITE_BYTES):
        data, starts = _flat(batch.column("span"))
        n = batch.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        at = ranges(starts[:-1], n)
        d = [RangeHash(data, base).of(at, at + LENGTH).view(np.int64) for base in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
        cols = [*d, batch.column("a").to_numpy()[row], batch.column("g").to_numpy()[row], (at - starts[row]).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["d1", "d2", "a", "g", "i"])


def resolve_spans(spans: DataFrame, spans_per_anchor: int = SPANS_PER_ANCHOR) -> DataFrame:
    """(a, g, dup) of the different spans that have windows repeated in other spans of their anchor."""
    crowded = spans.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > spans_per_anchor).select("a")
    arrays = max(1, -(-spans.count() // SPANS_PER_ARRAY))
    # spans of one anchor stay together; several anchors share an array
    sorted_ = (
        spans.join(crowded, "a", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("a"), F.lit(arrays)))
        .groupBy("bucket").applyInPandas(_array_task, "a long, g long, dup array<int>")
    )
    windows = spans.join(crowded, "a", "left_semi").select("a", "g", "n", "span").mapInArrow(_window_digests, "d1 long, d2 long, a long, g long, i int")
    twice = windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("d1", "d2")
    counted = windows.join(twice, ["d1", "d2"]).groupBy("a", "g").agg(F.collect_list("i").alias("dup"))
    return sorted_.union(counted)


# documents --------------------------------------------------------------------


def cut_out(data: np.ndarray, starts: np.ndarray, marks: pa.ListArray, length: int = LENGTH) -> np.ndarray:
    """Which bytes of documents laid end to end are removed, for each document's marks
    (first window, windows, the repeated ones or null for all)."""
    doc = np.repeat(np.arange(len(marks)), pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False))
    mark = pc.list_flatten(marks)
    lo = starts[doc] + mark.field("lo").to_numpy(zero_copy_only=False)
    dup = mark.field("dup")
    whole = pc.is_null(dup).to_numpy(zero_copy_only=False)
    some = np.repeat(lo, pc.fill_null(pc.list_value_length(dup), 0).to_numpy(zero_copy_only=False)) + pc.list_flatten(dup).to_numpy(zero_copy_only=False)
    n = mark.field("n").to_numpy(zero_copy_only=False)
    # a window removes its bytes; a stretch of windows, all up to the last one's end
    change = np.bincount(np.concatenate([lo[whole], some]).astype(np.int64), minlength=len(data) + 1)
    change -= np.bincount(np.concatenate([(lo + n - 1 + length)[whole], some + length]).astype(np.int64), minlength=len(data) + 1)
    return np.cumsum(change[:-1]) > 0


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, spans_per_anchor: int = SPANS_PER_ANCHOR) -> DataFrame:
    """One row per document row: id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for."""
    on_workers(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("k1"), F.hash(text, F.col(id_col)).alias("k2"), text.cast("binary").alias("data"))
    found = find_sites(keyed)
    again = found.groupBy("a").agg(F.count(F.lit(1)).alias("c"), F.min("g").alias("x"), F.max("g").alias("y")).where("c > 1")
    # of the anchors that occur twice: whether their spans differ
    again = written(again.select("a", (F.col("x") != F.col("y")).alias("differ")), "anchors")
    shared = written(found.join(again, "a"), "sites")
    equal = shared.groupBy("a", "g").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("k1", "k2", "lo", "n")).alias("s"), F.first("differ").alias("differ"))
    equal = written(equal.select("a", "g", "c", "differ", "s.*"), "spans")

    # the text of one of each different span comes from a document that holds it
    chosen = equal.where("differ").groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "g", "lo", "n")).alias("take"))
    holders = shared.select("k1", "k2").distinct().withColumn("holds", F.lit(True))
    asked = holders.join(chosen, ["k1", "k2"], "left")

    def pool_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("a", pa.int64()), ("g", pa.int64()), ("n", pa.int32()), ("span", pa.binary())])
        for batch in chunks(batches, "data", CHUNK_BYTES):
            data, take, holds = strings(batch.column("data")), *(batch.column(c).to_pylist() for c in ("take", "holds"))
            spans = [[{"a": t["a"], "g": t["g"], "n": t["n"], "span": d[t["lo"] : t["lo"] + t["n"] + LENGTH - 1]} for t in own or ()] for d, own in zip(data, take, strict=True)]
            cols = [
                batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array([len(d) for d in data], pa.int64()),
                pa.array([None if h else hashlib.sha256(d).hexdigest() for d, h in zip(data, holds, strict=True)], pa.string()),
                pa.array([d if h or with_kept else None for d, h in zip(data, holds, strict=True)], pa.binary()),
                pa.array(spans, pa.list_(span)),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["id", "k1", "k2", "n_bytes", "sha", "data", "spans"])

    id_type = keyed.schema["id"].dataType.simpleString()
    pool = keyed.join(asked, ["k1", "k2"], "left").select("id", "k1", "k2", "data", "take", "holds").mapInArrow(
        pool_of, f"id {id_type}, k1 long, k2 int, n_bytes long, sha string, data binary, spans array<struct<a:long,g:long,n:int,span:binary>>")
    pool = written(pool, "pool")
    # rows that repeat an id and a text name the same span; one is enough
    spans = pool.select(F.explode("spans").alias("s")).select("s.*").dropDuplicates(["a", "g"])
    dups = written(resolve_spans(spans, spans_per_anchor), "windows")

    verdict = equal.select("a", "g", "c").join(dups, ["a", "g"], "left").where("c > 1 or dup is not null")
    # written: a join of two plain shuffles, of which Spark splits what a hot span has
    verdict = written(verdict.select("a", "g", F.when(F.col("c") == 1, F.col("dup")).alias("dup")), "verdicts")
    marks = shared.select("a", "g", "k1", "k2", "lo", "n").join(verdict, ["a", "g"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "n", "dup")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "data", CUT_BYTES):
            data, starts = _flat(batch.column("data"))
            gone = cut_out(data, starts, batch.column("marks"))
            head = gone & ~np.append(False, gone[:-1])
            head[starts[:-1][np.diff(starts) > 0]] = gone[starts[:-1][np.diff(starts) > 0]]  # documents end runs
            count = lambda x: np.diff(np.append(0, np.cumsum(x))[starts])
            left = np.append(0, np.cumsum(~gone))[starts].tolist()
            kept = data[~gone].tobytes()
            kept = [kept[a:b] for a, b in zip(left, left[1:], strict=False)]
            cols = [
                batch.column("id"), batch.column("n_bytes"), pa.array(count(gone), pa.int64()), pa.array(count(head), pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k if with_kept else None for k in kept], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    touched = pool.where("sha is null").select("id", "k1", "k2", "n_bytes", "data").join(marks, ["k1", "k2"], "left")
    changed = touched.select("id", "n_bytes", "data", "marks").mapInArrow(cut, f"id {id_type}, {RESULT}")
    zero = F.lit(0).cast("long")
    whole = pool.where("sha is not null").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"), F.col("data").alias("kept"))
    out = changed.union(whole).withColumnRenamed("id", id_col)
    return out if with_kept else out.drop("kept")
