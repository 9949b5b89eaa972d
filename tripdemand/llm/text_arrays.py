"""Array helpers that the operators share: flat byte arrays of whole texts and their hashes.

Texts of a batch are laid end to end in one ``uint8`` array; ``starts`` holds the
offset of each text, with the total length at its end. Every helper works on the
flat array with numpy only, so a batch costs a few passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MIX_A = U64(0xBF58476D1CE4E5B9)
MIX_B = U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (wraps silently)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= MIX_A
    x ^= x >> U64(27)
    x *= MIX_B
    x ^= x >> U64(31)
    return x


def flatten(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the start of each (null: empty)."""
    parts = [t.encode("utf-8") if t else b"" for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers are kept for later arrays of up to this many bytes; those of longer ones are made for them alone.
KEPT_POWERS = 1 << 20


class RangeHash:
    """Polynomial hashes of any ranges of one byte array, from one pass over it."""

    def __init__(self, data: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> None:
        have = _POWERS.get(base)
        if have is None or len(have[0]) <= len(data):
            have = powers(base, len(data) + 1), powers(pow(base, -1, 2**64), len(data) + 1)
            if len(data) <= KEPT_POWERS:
                _POWERS[base] = have
        self.back = have[1]
        self.sum = np.zeros(len(data) + 1, U64)
        # byte i weighs base ** i; the inverse powers move a range back to the start
        np.cumsum((data.astype(U64) + U64(1)) * have[0][: len(data)], out=self.sum[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each data[begin:end]; equal ranges have equal hashes, wherever they are."""
        raw = (self.sum[end] - self.sum[begin]) * self.back[begin]
        return mix(raw ^ ((end - begin).astype(U64) * MIX_A))


def strings(column: pa.Array) -> list:
    """The values of a string or binary column; many times faster than asking for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def chunks(batches: Iterator[pa.RecordBatch], column: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of at most ``chunk_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + chunk_bytes, "right")))
            yield batch.slice(first, last - first)
            first = last


def ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices begin[0] .. begin[0] + length[0] - 1, then those of the next range, and so on."""
    length = np.asarray(length, np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    jump = np.repeat(np.asarray(begin, np.int64) - (np.cumsum(length) - length), length)
    return jump + np.arange(total)
