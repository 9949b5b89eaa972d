"""Token ids packed into rows of equal length, by best-fit-decreasing.

Texts are encoded with a byte-level BPE vocabulary and closed by an end id. Documents
longer than a row are split into full rows and a rest; nothing is dropped. The pieces of a
pack group (the texts of one stretch of a task's input, bounded in tokens) are placed from
the longest to the shortest, each into the fullest row with room for it. A segment tree
over room sizes, whose nodes count the rows below them, finds the smallest sufficient room.

Each packed row holds its ids, the cumulative lengths of its segments and the position
of every id within its segment (0 again where a segment starts), little-endian.

Null and empty texts are an end id alone. Every input row is packed, also rows that repeat
an id or a text; null ids are carried along. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers
from tripdemand.llm.text_arrays import chunks, ranges, strings

ROW_LENGTH = 2048
#: Tokens of a pack group; about 1,000 rows.
GROUP_TOKENS = 2 << 20
KEPT_WORDS = 400_000
CHUNK_BYTES = 2 << 20
#: Texts with two white-space characters side by side, at an end, or of an uncommon kind.
MIXED_SPACE = r"\s\s|^\s|\s$|[\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class CapacityTree:
    """Rows by their room (0 .. size), in a segment tree that counts the rows below each node."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the smallest room of at least ``need``; None if there is none."""
        at = need + self.leaves
        if not self.count[at]:
            # up to the first ancestor with rows to the right, then down to its leftmost
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The row of each piece (at most ``size`` long), longest pieces first."""
    rows = np.empty(len(lengths), np.int64)
    tree, made = CapacityTree(size), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        got = tree.take(need)
        if got is None:
            got, made = (size, made), made + 1
        room, row = got
        rows[k] = row
        tree.add(room - need, row)
    return rows


class ByteEncoder:
    """Ids of whole texts, with the ids of words seen before kept (bounded in number).

    The vocabulary's pattern never joins what follows a space that stands between two other
    characters to what precedes it, so texts are cut there; texts with runs of spaces are
    encoded whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number for each text, end id counted."""
        if len(self.slot) > KEPT_WORDS:
            self._forget()
        texts = pc.fill_null(texts, "")
        # next to other white space the pattern's alternatives for spaces decide
        mixed = pc.match_substring_regex(texts, MIXED_SPACE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~mixed)), " ")
        coded = lists.flatten().dictionary_encode()
        slots = self._slots([" " + w for w in strings(coded.dictionary)])[coded.indices.to_numpy()]
        # the first word of a text has no space before it; so it and mixed texts are encoded apart
        per = np.diff(lists.offsets.to_numpy())
        first = lists.offsets.to_numpy()[:-1]
        heads, head_n = self._apart(strings(coded.dictionary.take(coded.indices.take(pa.array(first)))))
        others, other_n = self._apart(strings(texts.filter(pa.array(mixed))))
        store = np.concatenate([self.ids, heads, others])
        begin, length = self.at[slots], np.diff(self.at)[slots]
        begin[first] = len(self.ids) + np.cumsum(head_n) - head_n
        length[first] = head_n
        words = np.ones(len(texts), np.int64)
        words[~mixed] = per
        where = np.cumsum(words) - words
        all_begin, all_length = np.empty(int(words.sum()), np.int64), np.empty(int(words.sum()), np.int64)
        inside = ranges(where[~mixed], per)
        all_begin[inside], all_length[inside] = begin, length
        all_begin[where[mixed]] = len(self.ids) + len(heads) + np.cumsum(other_n) - other_n
        all_length[where[mixed]] = other_n
        n = np.diff(np.append(0, np.cumsum(all_length))[np.append(0, np.cumsum(words))])
        out = np.full(int(n.sum()) + len(n), end_id, np.int32)
        body = np.ones(len(out), bool)
        body[np.cumsum(n + 1) - 1] = False
        out[body] = store[ranges(all_begin, all_length)]
        return out, n + 1

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the ids of these different words (or whole texts) are kept; encodes those that are new."""
        new = [w for w in words if w not in self.slot]
        if new:
            # one call for all: tokens never reach across a cut, so byte lengths tell them apart
            joined = "".join(new)
            ids = np.array(self.encoding.encode_ordinary(joined), np.int32)
            ends = np.append(0, np.cumsum(self.n_bytes[ids]))
            word_end = np.cumsum(np.fromiter((len(w.encode()) for w in new), np.int64, len(new)))
            at = np.searchsorted(ends, word_end)
            self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new)), strict=True))
            self.at = np.concatenate([self.at, self.at[-1] + at])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts or words encoded one by one, and their number for each."""
        each = [self.encoding.encode_ordinary(t) for t in texts]
        return np.array([i for x in each for i in x], np.int32), np.array([len(x) for x in each], np.int64)


_ENCODERS: dict[tuple, ByteEncoder] = {}


def encoder_of(lines: bytes, pattern: str) -> ByteEncoder:
    """The worker's encoder of this vocabulary (the bytes of its rank file), built once."""
    key = (hash(lines), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteEncoder({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines.splitlines()) if t}, pattern)
    return _ENCODERS[key]


def split_long(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, offset in it, length) of the pieces of documents with that many tokens."""
    parts = -(-counts // size)
    doc = np.repeat(np.arange(len(counts)), parts)
    offset = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * size
    return doc, offset, np.minimum(counts[doc] - offset, size)


def pack_documents(docs: DataFrame, vocabulary_path: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   row_length: int = ROW_LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows: pack_id, n_tokens, n_segments, ids and positions (binary, uint16 or int32 as the
    vocabulary needs, and int32), cu_seqlens (array<int>), doc_ids, offsets (of each segment in its document).

    One pass without a shuffle: a task packs its own documents group by group.
    """
    on_workers(docs.sparkSession)
    with open(vocabulary_path, "rb") as f:
        lines = f.read()
    kind = np.uint16 if max(end_id, lines.count(b"\n")) < 2**16 else np.int32

    def rows_of(task: int, group: int, ids: np.ndarray, counts: np.ndarray, doc_ids: list) -> pa.RecordBatch:
        doc, offset, length = split_long(counts, row_length)
        row = best_fit(length, row_length)
        order = np.lexsort((offset, doc, row))
        doc, offset, length, row = doc[order], offset[order], length[order], row[order]
        begin = (np.cumsum(counts) - counts)[doc] + offset
        flat = ids[ranges(begin, length)].astype(kind).tobytes()
        where = ranges(np.zeros(len(length), np.int64), length).astype(np.int32).tobytes()
        heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        ends = np.append(heads[1:], len(row))
        at = np.append(0, np.cumsum(length))
        width = np.dtype(kind).itemsize
        cu = [(at[a : b + 1] - at[a]).astype(np.int32) for a, b in zip(heads, ends, strict=True)]
        cols = [
            pa.array((task << 40) + (group << 20) + np.arange(len(heads)), pa.int64()),
            pa.array([int(c[-1]) for c in cu], pa.int64()), pa.array([len(c) - 1 for c in cu], pa.int64()),
            pa.array([flat[at[a] * width : at[b] * width] for a, b in zip(heads, ends, strict=True)], pa.binary()),
            pa.array([where[at[a] * 4 : at[b] * 4] for a, b in zip(heads, ends, strict=True)], pa.binary()),
            pa.array(cu, pa.list_(pa.int32())),
            pa.array([[doc_ids[d] for d in doc[a:b]] for a, b in zip(heads, ends, strict=True)], pa.list_(pa.int64())),
            pa.array([offset[a:b].astype(np.int32) for a, b in zip(heads, ends, strict=True)], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(cols, ["pack_id", "n_tokens", "n_segments", "ids", "positions", "cu_seqlens", "doc_ids", "offsets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(lines, pattern)
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        task, group, tokens = None, 0, 0

        def flush() -> pa.RecordBatch:
            ids, counts, names = zip(*held, strict=True)
            return rows_of(task, group, np.concatenate(ids), np.concatenate(counts), [x for n in names for x in n])

        for batch in chunks(batches, "text", CHUNK_BYTES):
            task = batch.column("task")[0].as_py()
            ids, counts = encoder.encode(batch.column("text"), end_id)
            held.append((ids, counts, batch.column("id").to_pylist()))
            tokens += len(ids)
            if tokens >= group_tokens:
                yield flush()
                held, tokens, group = [], 0, group + 1
        if held:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("task"))
    return source.mapInArrow(run, "pack_id long, n_tokens long, n_segments long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, offsets array<int>")


def read_row(row: pd.Series | object, kind: type = np.uint16) -> list[tuple[int | None, int, np.ndarray]]:
    """(document, offset, ids) of every segment of a packed row."""
    ids = np.frombuffer(row["ids"], kind)
    cuts = row["cu_seqlens"]
    return [(d, o, ids[a:b]) for d, o, a, b in zip(row["doc_ids"], row["offsets"], cuts[:-1], cuts[1:], strict=True)]


MATRIX = "matrix long, n_rows int, width int, ids binary, positions binary, cu_seqlens binary, n_tokens binary, pack_ids array<long>"


def packed_matrices(packed: DataFrame, pad_id: int, row_length: int = ROW_LENGTH, rows_per_matrix: int = 1024, kind: type = np.uint16) -> DataFrame:
    """Packed rows as matrices of ``row_length`` columns, ``rows_per_matrix`` rows each (a task's last one fewer).

    ``ids`` is the matrix in row order, each row filled up with ``pad_id``; ``positions`` the
    matrix of positions (int32), 0 where a segment starts and in the filling; ``n_tokens`` the
    ids of each row before its filling; ``cu_seqlens`` the ends of all segments in the flattened
    matrix (int32, from 0), the filling of a row a segment of its own, so that the last is the
    matrix's size. No shuffle: each task cuts its own rows.
    """

    def matrix(number: int, rows: pa.Table) -> pa.RecordBatch:
        n = rows.num_rows
        ids, positions = np.full((n, row_length), pad_id, kind), np.zeros((n, row_length), np.int32)
        used = rows.column("n_tokens").to_numpy()
        ends = []
        for i, (own, where, cuts) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("ids", "positions", "cu_seqlens")), strict=True)):
            ids[i, : used[i]] = np.frombuffer(own, kind)
            positions[i, : used[i]] = np.frombuffer(where, np.int32)
            ends += [i * row_length + c for c in cuts[1:]] + [(i + 1) * row_length] * int(used[i] < row_length)
        data = [ids.tobytes(), positions.tobytes(), np.array([0, *ends], np.int32).tobytes(), used.astype(np.int32).tobytes()]
        cols = [pa.array([number], pa.int64()), pa.array([n], pa.int32()), pa.array([row_length], pa.int32()), *(pa.array([d], pa.binary()) for d in data)]
        return pa.RecordBatch.from_arrays([*cols, pa.array([rows.column("pack_id").to_pylist()], pa.list_(pa.int64()))], [c.split()[0] for c in MATRIX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, task, number = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                task = batch.column("task")[0].as_py()
                room = rows_per_matrix - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == rows_per_matrix:
                    yield matrix((task << 32) + number, pa.Table.from_batches(held))
                    held, number = [], number + 1
        if held:
            yield matrix((task << 32) + number, pa.Table.from_batches(held))

    on_workers(packed.sparkSession)
    source = packed.select("pack_id", "n_tokens", "ids", "positions", "cu_seqlens", F.spark_partition_id().alias("task"))
    return source.mapInArrow(run, MATRIX)
