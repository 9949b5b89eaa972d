"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from its code point, so workers
agree without sharing anything). The vector of three characters is the product of their
letter vectors, the first permuted twice and the second once; a text's vector is the sum
over its trigrams, and a language's prototype the sum over its texts. A text gets the
language whose prototype has the largest cosine with its vector; ties go to the label
that sorts first. Letters are lower-cased, every other stretch counts as one blank.

Null texts and texts without letters get ``und`` and score 0, and so does every text if
no labelled text has letters. Training skips null labels. Repeated rows count as often
as they occur in training and give repeated results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdemand.llm.stored import on_workers
from tripdemand.llm.text_arrays import MIX_A, U64, chunks, mix, strings

DIMENSION = 512
SEED = 20_26
UNDETERMINED = "und"
#: Prototypes go to every task; a label column with more values than this is no language column.
MAX_LABELS = 4096
CHUNK_BYTES = 1 << 20
BLANK = 0
_LETTER = None


def letter_table() -> np.ndarray:
    """For every code point, its lower-case letter, or BLANK."""
    global _LETTER
    if _LETTER is None:
        table = np.zeros(0x110000, np.int32)
        for c in range(0x30000):  # letters beyond are unified ideographs; they stand for themselves
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        table[0x30000:0x32400] = np.arange(0x30000, 0x32400)
        _LETTER = table
    return _LETTER


def letter_vectors(codes: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """One random vector of +1 and -1 for each code point."""
    bits = mix(mix(codes.astype(U64)[:, None] + U64(seed * int(MIX_A) % 2**64)) + np.arange(dim, dtype=U64)[None, :] * MIX_A)
    return np.where((bits >> U64(40)) & U64(1), 1, -1).astype(np.float32)


def bundle(texts: list[str | None], dim: int, seed: int) -> np.ndarray:
    """The vector of each text (zeros if it has no letters). Exact: sums of whole numbers."""
    lens = np.array([len(t) + 2 if t else 0 for t in texts])
    joined = "".join(f" {t} " for t in texts if t)
    out = np.zeros((len(texts), dim), np.float32)
    if not joined:
        return out
    sym = letter_table()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    keep = (sym != BLANK) | np.append(True, (sym[:-1] != BLANK) | (doc[1:] != doc[:-1]))
    sym, doc = sym[keep], doc[keep]
    codes = np.flatnonzero(np.bincount(sym))
    index = np.zeros(codes[-1] + 1, np.int64)
    index[codes] = np.arange(len(codes))
    s = index[sym]
    a = len(codes)
    whole = np.flatnonzero((doc[2:] == doc[:-2]) & ~((sym[:-2] == BLANK) & (sym[2:] == BLANK) & (sym[1:-1] == BLANK)))
    if not len(whole):
        return out
    gram = (s[whole] * a + s[whole + 1]) * a + s[whole + 2]
    grams, at = _numbered(gram, a**3)
    letters = letter_vectors(codes, dim, seed)
    vectors = np.roll(letters, 2, 1)[grams // (a * a)] * np.roll(letters, 1, 1)[grams // a % a] * letters[grams % a]
    of = doc[whole]
    step = max(1, 1_000_000 // len(grams))
    cuts = np.searchsorted(of, np.arange(0, len(texts) + step, step))
    for k, first in enumerate(range(0, len(texts), step)):
        n = min(step, len(texts) - first)
        part = slice(cuts[k], cuts[k + 1])
        counts = np.bincount((of[part] - first).astype(np.int64) * len(grams) + at[part], minlength=n * len(grams))
        out[first : first + n] = counts.reshape(n, len(grams)).astype(np.float32) @ vectors
    return out


def _numbered(gram: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values and the index of each among them."""
    if limit > 4_000_000:
        return np.unique(gram, return_inverse=True)
    grams = np.flatnonzero(np.bincount(gram, minlength=limit))
    number = np.zeros(limit, np.int64)
    number[grams] = np.arange(len(grams))
    return grams, number[gram]


def fit_prototypes(docs: DataFrame, text_col: str = "text", label_col: str = "lang", dim: int = DIMENSION, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """The labels, sorted, and their prototypes, from every labelled row.

    A task adds up its own rows; Spark adds the tasks' sums by (label, component). What
    reaches the driver is labels x dim numbers, whatever the size of the corpus.
    """

    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in chunks(batches, "text", CHUNK_BYTES):
            vectors = bundle(strings(batch.column("text")), dim, seed).astype(np.int64)
            labels = strings(batch.column("label"))
            for label in set(labels):
                own = vectors[[x == label for x in labels]].sum(0)
                sums[label] = sums.get(label, 0) + own
            if len(sums) > MAX_LABELS:
                raise ValueError(f"more than {MAX_LABELS} languages")
        for label, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([label] * dim), pa.array(np.arange(dim), pa.int32()), pa.array(v, pa.int64())], ["label", "component", "total"])

    source = docs.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")).where("label is not null and text is not null")
    sums = source.mapInArrow(run, "label string, component int, total long")
    rows = sums.groupBy("label", "component").agg(F.sum("total").alias("total")).limit(MAX_LABELS * dim + 1).collect()
    labels = sorted({r.label for r in rows})
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} languages")
    at = {x: i for i, x in enumerate(labels)}
    out = np.zeros((len(labels), dim))
    for r in rows:
        out[at[r.label], r.component] = r.total
    some = np.abs(out).sum(1) > 0
    return [x for x, ok in zip(labels, some, strict=True) if ok], out[some]


def predict_language(docs: DataFrame, labels: list[str], prototypes: np.ndarray, keep: list[Column], text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per input row: the columns of ``keep``, lang_pred and score (cosine, 0 to 1)."""
    dim = prototypes.shape[1] if prototypes.size else DIMENSION
    unit = prototypes / np.sqrt((prototypes**2).sum(1, keepdims=True)) if prototypes.size else np.zeros((0, dim))
    names = np.array([*labels, UNDETERMINED], object)

    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text", CHUNK_BYTES):
            vectors = bundle(strings(batch.column("_text")), dim, seed).astype(np.float64)
            norm = np.sqrt((vectors**2).sum(1))
            best, score = np.full(len(vectors), len(labels)), np.zeros(len(vectors))
            if len(labels):
                cos = vectors @ unit.T / np.where(norm > 0, norm, 1)[:, None]
                some = norm > 0
                best[some] = cos.argmax(1)[some]
                score[some] = np.clip(cos.max(1), 0, 1)[some]
            cols = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(names[best].tolist(), pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:-1], "lang_pred", "score"])

    source = docs.select(*keep, F.col(text_col).alias("_text"))
    return source.mapInArrow(run, T.StructType([*source.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
