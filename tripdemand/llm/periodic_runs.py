"""Stretches of words that repeat with a period, found by seeds on diagonals.

Words are the runs of anything but ASCII white space. A run is a stretch with smallest
period q (words q apart are the same), at least ``max(6, 4 * q)`` words long, that no
neighbouring word extends. On the diagonal of lag q (word i beside word i + q) a run is
an unbroken line of at least ``max(6 - q, 3 * q)`` equal words, the guaranteed overlap.

- Lags fall into classes, 1 to 5, 6 to 18, 19 to 57 and on: (b, k] with k = 3 * (b + 1),
  so that every run of the class holds a line of k equal words. The windows of k words
  are the class's k-grams, identified exactly: a window's number is that of the tuple of
  windows of the class before that cover it. What occurs once in its document gets no
  number, and no wider window over it either, so prose without repeats costs two levels.
- Same-document occurrence pairs: each occurrence is paired with the next one. That loses
  nothing, because k is at least q: a window of a run cannot recur within the run at less
  than q words, or q would not be its smallest period. So a document of n words gives at
  most n pairs a class, whatever repeats how often.
- Pairs are ordered by lag and place. A pair that lies within what the pairs before it on
  its lag already cover is not extended again; only the others grow, left and right.

Null texts have no words. Repeated rows give repeated results, an empty table an empty one;
a null id stays null. Only the named columns are read. Memory is bounded by one chunk of
texts, or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers
from tripdemand.llm.text_arrays import chunks, strings

WORD = r"[^\x20\x09-\x0D]+"
#: The fewest words of a run, and the fewest periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Lags up to here make the first class; the guaranteed overlap of its runs is as long.
FIRST = LEAST_WORDS - 1
CHUNK_BYTES = 1 << 20
RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def numbered_words(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray]:
    """The words of each text, and all of them as numbers that differ from text to text."""
    words = [t.encode("utf-8").split() if t else [] for t in texts]  # bytes split at exactly the six ASCII blanks
    numbers = np.empty(sum(map(len, words)), np.int64)
    at = first = 0
    for own in words:
        index: dict[bytes, int] = {}
        numbers[at : at + len(own)] = [index.setdefault(w, len(index)) for w in own]
        numbers[at : at + len(own)] += first
        at, first = at + len(own), first + len(index)
    return words, numbers


def widened(rank: np.ndarray, at: np.ndarray, width: int, wider: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows of ``wider`` words from those of ``width`` words (at most a third less one).

    ``rank[i]`` numbers the window at word i, -1 if it occurs nowhere else; ``at`` lists
    the others. Returned in the same form.
    """
    offsets = [*range(0, wider - width, width), wider - width]
    at = at[at + wider - width < len(rank)]
    for o in offsets[1:]:
        at = at[rank[at + o] >= 0]
    key = rank[at]
    out = np.full(len(rank), -1, np.int64)
    for o in offsets[1:]:
        number, key = np.unique(key * len(rank) + rank[at + o], return_inverse=True)
    if len(at):
        often = np.bincount(key)[key] > 1
        at = at[often]
        out[at] = key[often]
    return out, at


def pairs_of_lag(rank: np.ndarray, at: np.ndarray, above: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each window and its next occurrence, for lags over ``above`` up to ``most``."""
    order = np.argsort(rank[at], kind="stable")  # places of equal windows stay in order
    place = at[order]
    lag = np.diff(place)
    ok = (np.diff(rank[place]) == 0) & (lag > above) & (lag <= most)
    return place[:-1][ok], lag[ok]


def extended(words: np.ndarray, place: np.ndarray, lag: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, lag) of the lines of equal words that the pairs lie on, each line once."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # covered: the pair before on this lag reaches this one, so both lie on one line
    covered = np.append(False, (lag[1:] == lag[:-1]) & (place[1:] <= place[:-1] + width))
    heads = np.flatnonzero(~covered)
    begin, lag = place[heads], lag[heads]
    end = place[np.append(heads[1:], len(place)) - 1] + width
    while len(grow := np.flatnonzero((begin > 0) & (words[begin - 1] == words[begin - 1 + lag]))):
        begin[grow] -= 1
    last = len(words) - 1
    while len(grow := np.flatnonzero((end + lag <= last) & (words[np.minimum(end, last)] == words[np.minimum(end + lag, last)]))):
        end[grow] += 1
    return begin, end, lag


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start, then period. Numbers of different texts must differ."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    often = np.bincount(words)[words] > 1 if len(words) else np.zeros(0, bool)
    rank, at = np.where(often, words, -1), np.flatnonzero(often)
    rank, at = widened(rank, at, 1, 2)
    above, width, most = 0, 2, FIRST
    while len(at):
        rank, at = widened(rank, at, width, most)
        place, lag = pairs_of_lag(rank, at, above, most)
        if len(place):
            found.append(extended(words, place, lag, most))
        above, width, most = most, most, LEAST_PERIODS * (most + 1) - (most + 1)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    begin, end, lag = (np.concatenate(x) for x in zip(*found, strict=True))
    length = end - begin + lag
    whole = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * lag)
    begin, length, lag = begin[whole], length[whole], lag[whole]
    order = np.lexsort((lag, begin))
    return begin[order], length[order], lag[order]


def greatest(length: np.ndarray, period: np.ndarray) -> int:
    """The index of the greatest exact length / period; of equal ones, the first."""
    best = 0
    # a float tells apart all but neighbours, and whole numbers decide among those
    for i in np.flatnonzero(length / period >= (length / period).max() * (1 - 1e-12)):
        if int(length[i]) * int(period[best]) > int(length[best]) * int(period[i]):
            best = int(i)
    return best


def periodic_runs(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """One row per input row: the columns of ``keep`` and what its runs are.

    ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` (a thousandth of
    length / period, rounded down) of the run that repeats most often, null if there is none
    (ties: smallest start, then period); ``runs_sha256`` of the lines ``start,length,period``
    of all runs; ``collapsed_sha256`` of the words, one space apart, without what a run adds
    to its first period.
    """
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text", CHUNK_BYTES):
            words, numbers = numbered_words(strings(batch.column("_text")))
            start, length, period = find_runs(numbers)
            ends = np.cumsum([len(w) for w in words])
            of = np.searchsorted(ends, start, "right")
            cuts = np.searchsorted(of, np.arange(len(words) + 1))
            depth = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(depth, start + period, 1)
            np.add.at(depth, start + length, -1)
            kept = np.cumsum(depth)[:-1] == 0
            rows = []
            for i, own in enumerate(words):
                mine = slice(cuts[i], cuts[i + 1])
                first = int(ends[i]) - len(own)
                if cuts[i] == cuts[i + 1]:
                    rows.append((0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(own)).hexdigest()))
                    continue
                s, n, q = start[mine] - first, length[mine], period[mine]
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist(), strict=True))
                best = greatest(n, q)
                rest = b" ".join(compress(own, kept[first : int(ends[i])].tolist()))
                rows.append((len(s), int(s[best]), int(n[best]), int(q[best]), 1000 * int(n[best]) // int(q[best]),
                             hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            results = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns - 1)] + results,
                                             [*batch.schema.names[:-1], *(c.split()[0] for c in RESULT.split(", "))])

    source = docs.select(*keep, F.col(text_col).alias("_text"))
    kept_columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(run, kept_columns + RESULT)


def with_repeated_tail(text: Column, number: Column) -> Column:
    """The text, or where ``number`` is divisible by ten its words with a tail that repeats.

    With g = number div 10 and n words: from word a = g mod n on, the words are those of the
    first p = 1 + (n - a) div (3 + g mod 8) from there, over and over. Null numbers change
    nothing, and neither do texts without words.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        g = F.floor(number / 10)
        return F.transform(F.array(F.struct(w.alias("w"), (g % n).cast("int").alias("a"), n.cast("int").alias("n"),
                                            (1 + F.floor((n - g % n) / (3 + g % 8))).cast("int").alias("p"))), rebuilt)[0]

    def rebuilt(x: Column) -> Column:
        period = F.slice(x["w"], x["a"] + 1, x["p"])
        times = F.ceil((x["n"] - x["a"]) / x["p"]).cast("int")
        repeated = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), x["n"] - x["a"])
        return F.array_join(F.concat(F.slice(x["w"], F.lit(1), x["a"]), repeated), " ")

    # the words are bound once, as the only element of an array, so that nothing extracts them again
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(text))[0]
    return F.when(number % 10 == 0, changed).otherwise(text)
