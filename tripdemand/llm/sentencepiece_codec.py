"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

Texts are cut into words at spaces; each new word of a batch becomes a stretch of one
flat symbol array. A round looks up the rank of every adjacent pair, takes the smallest
rank of each word (a segmented minimum), merges its pairs from the left in all words at
once, and compacts the array. Words leave when no pair of theirs is in the vocabulary.
The ids of words seen before are kept, bounded in number, between batches of a worker.

Equal to the library for BPE models with byte fallback, a dummy prefix, no other
normalisation and no user-defined pieces. Null and empty texts encode to the end id
alone and decode to the empty text. Rows are independent: repeated rows give repeated
results, and only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers
from tripdemand.llm.text_arrays import chunks, ranges, strings

SPACE = "▁"
NO_RANK = np.int32(2**31 - 1)
MAX_CODE = 0x110000
#: Rounds over whole words; what still merges then (words of dozens to thousands of letters) goes on by rank.
ROUNDS = 24
#: Words whose ids a worker keeps; beyond it the kept words are dropped and gathered anew.
KEPT_WORDS = 100_000
#: Bytes of text handled at a time; ids, their decimals and the decoded bytes take some hundred bytes for each.
CHUNK_BYTES = 256 << 10


class PairTable:
    """Exact vectorised lookup of 64-bit keys: two hashed tables, the second for what collides in the first."""

    BITS = 22

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys, np.int64(-1))
        rng = np.random.default_rng(11)
        while True:
            self.mult = rng.integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            self.tables = np.full((2, 1 << self.BITS), len(keys), np.int32)
            rest = np.arange(len(keys), dtype=np.int32)
            for t in range(2):
                slots = self._slot(keys[rest], t)
                _, first = np.unique(slots, return_index=True)
                self.tables[t, slots[first]] = rest[first]
                rest = np.delete(rest, first)
            if not len(rest):
                return

    def _slot(self, keys: np.ndarray, t: int) -> np.ndarray:
        return (keys.astype(np.uint64) * self.mult[t]) >> np.uint64(64 - self.BITS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or the number of keys if it is not there."""
        at = self.tables[0, self._slot(keys, 0)]
        miss = np.flatnonzero(self.keys[at] != keys)
        if len(miss):
            other = self.tables[1, self._slot(keys[miss], 1)]
            at[miss] = np.where(self.keys[other] == keys[miss], other, len(self.keys) - 1)
        return at


class PieceCodec:
    """Encoder and decoder of one model, from its list of (piece, score, kind)."""

    def __init__(self, pieces: list[tuple[str, float, str]], end_id: int) -> None:
        self.end_id = end_id
        self.n_pieces = len(pieces)
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # symbols beyond the pieces stand for characters that are no piece
        self.base = self.n_pieces
        self.symbol_of_code = np.arange(MAX_CODE, dtype=np.int32) + np.int32(self.base)
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol_of_code[ord(p)] = i
        keys, merged, ranks = [], [], []
        width = self.base + MAX_CODE
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = (normal.get(x, self.base + ord(x) if len(x) == 1 else None) for x in (p[:k], p[k:]))
                if a is not None and b is not None:
                    keys.append(a * width + b)
                    merged.append(i)
                    ranks.append(rank_of[pieces[i][1]])
        self.width = np.int64(width)
        self.pairs = PairTable(np.array(keys, np.int64))
        self.merged = np.append(np.array(merged, np.int32), np.int32(0))
        self.ranks = np.append(np.array(ranks, np.int32), NO_RANK)
        self.byte_id = np.zeros(256, np.int64)
        surface = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_id[int(p[3:5], 16)] = i
            surface.append({"byte": lambda p=p: bytes([int(p[3:5], 16)]), "control": lambda: b"", "unknown": lambda: " ⁇ ".encode()}
                           .get(kind, lambda p=p: p.replace(SPACE, " ").encode())())
        self.starts_with_space = np.array([s[:1] == b" " and k == "normal" for s, (_, _, k) in zip(surface, pieces, strict=True)])
        self.is_control = np.array([k == "control" for _, _, k in pieces])
        self.surface_len = np.array([len(s) for s in surface], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        shown = [f" {i}".encode() for i in range(self.n_pieces)]
        self.shown_len = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.word_ids = np.zeros(0, np.int32)
        self.word_at = np.zeros(1, np.int64)

    # encoding ---------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.pairs.find(left.astype(np.int64) * self.width + right)
        return self.ranks[at], at

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and their number for each."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = self.symbol_of_code[codes]
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)))
        out_sym, out_word = [], []
        for _ in range(ROUNDS):
            if not len(sym):
                break
            rank = np.full(len(sym), NO_RANK, np.int32)
            at = np.zeros(len(sym), np.int32)
            same = word[1:] == word[:-1]
            inner = np.flatnonzero(same)
            rank[inner], at[inner] = self._ranks(sym[inner], sym[inner + 1])
            head = np.append(True, ~same)
            heads = np.flatnonzero(head)
            seg = np.cumsum(head, dtype=np.int32) - np.int32(1)
            least = np.minimum.reduceat(rank, heads)
            stay = (least != NO_RANK)[seg]
            out_sym.append(sym[~stay])
            out_word.append(word[~stay])
            take = np.flatnonzero(stay & (rank == least[seg]))
            # of a run of overlapping pairs, every second one from the left
            run_head = np.append(True, np.diff(take) != 1) if len(take) else np.zeros(0, bool)
            in_run = np.arange(len(take)) - np.flatnonzero(run_head)[np.cumsum(run_head) - 1]
            take = take[in_run % 2 == 0]
            take = self._in_order(sym, word, seg, least, take, at)
            sym = sym.copy()
            sym[take] = self.merged[at[take]]
            stay[take + 1] = False
            sym, word = sym[stay], word[stay]
        if len(sym):
            one, of = self._merge_by_rank(sym, word)
            out_sym.append(one)
            out_word.append(of)
        sym, word = np.concatenate([*out_sym, np.zeros(0, np.int32)]), np.concatenate([*out_word, np.zeros(0, np.int32)])
        order = np.argsort(word, kind="stable")
        sym, word = self._bytes_of_unknown(sym[order], word[order])
        return sym, np.bincount(word, minlength=len(words))

    def _in_order(self, sym: np.ndarray, word: np.ndarray, seg: np.ndarray, least: np.ndarray, take: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``take`` without the later merges of words in which an earlier one makes a pair that goes first."""
        if len(take) < 2:
            return take
        more = np.append(seg[take[1:]] == seg[take[:-1]], False)  # another merge follows in the word
        i = take[more]
        if not len(i):
            return take
        new = self.merged[at[i]]
        after = np.minimum(i + 2, len(sym) - 1)
        right = np.where((i + 2 < len(sym)) & (word[after] == word[i]), self._ranks(new, sym[after])[0], NO_RANK)
        before = np.maximum(i - 1, 0)
        chosen = np.zeros(len(sym), bool)
        chosen[take] = True
        left_sym = np.where((i >= 2) & chosen[np.maximum(i - 2, 0)] & (word[np.maximum(i - 2, 0)] == word[i]), self.merged[at[np.maximum(i - 2, 0)]], sym[before])
        left = np.where((i >= 1) & (word[before] == word[i]), self._ranks(left_sym, new)[0], NO_RANK)
        early = np.zeros(len(least), bool)
        early[seg[i[np.minimum(left, right) <= least[seg[i]]]]] = True
        first = np.append(True, seg[take[1:]] != seg[take[:-1]])
        return take[first | ~early[seg[take]]]

    def _merge_by_rank(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same rounds for long words, of which each changes little: pairs wait under their ranks.

        A round takes the smallest rank that waits, in all words, and looks up only the pairs
        that its merges make. Each word still meets its pairs smallest rank first, from the left.
        """
        n = len(sym)
        sym = sym.copy()
        last, first = np.append(word[1:] != word[:-1], True), np.append(True, word[1:] != word[:-1])
        nxt, prv = np.where(last, -1, np.arange(1, n + 1)), np.where(first, -1, np.arange(-1, n - 1))
        rank, at = np.full(n, NO_RANK, np.int32), np.zeros(n, np.int32)
        made, joined = np.zeros(n, np.int32), np.zeros(n, bool)  # of one round's merges
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(i: np.ndarray) -> None:
            rank[i], at[i] = NO_RANK, 0
            i = i[nxt[i] >= 0]
            rank[i], at[i] = self._ranks(sym[i], sym[nxt[i]])
            i = i[rank[i] != NO_RANK]
            i = i[np.argsort(rank[i], kind="stable")]
            for part in np.split(i, np.flatnonzero(np.diff(rank[i])) + 1):
                if len(part):
                    put(int(rank[part[0]]), part)

        def put(r: int, part: np.ndarray) -> None:
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(part)

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            take = np.unique(np.concatenate(waiting.pop(r)))
            take = take[(rank[take] == r) & (nxt[take] >= 0)]
            if not len(take):
                continue
            # of a run of overlapping pairs, every second one from the left
            heads = np.append(True, nxt[take[:-1]] != take[1:])
            in_run = np.arange(len(take)) - np.flatnonzero(heads)[np.cumsum(heads) - 1]
            later = take[in_run % 2 == 1]
            take = take[in_run % 2 == 0]
            # where a merge makes a pair that goes before the next one, the word's others wait
            new = self.merged[at[take]]
            right, left = nxt[nxt[take]], prv[take]
            made[take], joined[take] = new, True
            end = nxt[take]
            whole_left = (left >= 0) & joined[np.maximum(prv[np.maximum(left, 0)], 0)] & (prv[np.maximum(left, 0)] >= 0)
            left_sym = np.where(whole_left, made[np.maximum(prv[np.maximum(left, 0)], 0)], sym[np.maximum(left, 0)])
            joined[take] = False
            low = np.full(len(take), NO_RANK, np.int32)
            some = np.flatnonzero(left >= 0)
            low[some] = self._ranks(left_sym[some], new[some])[0]
            some = np.flatnonzero(right >= 0)
            low[some] = np.minimum(low[some], self._ranks(new[some], sym[right[some]])[0])
            lead = np.append(True, word[take[1:]] != word[take[:-1]])
            group = np.cumsum(lead) - 1
            early = np.bincount(group, weights=low <= r) > 0
            go = lead | ~early[group]
            later = np.concatenate([later, take[~go]])
            take, new, right, end = take[go], new[go], right[go], end[go]
            sym[take], rank[end], nxt[take] = new, NO_RANK, right
            sym[end], nxt[end] = -1, -1
            prv[right[right >= 0]] = take[right >= 0]
            before = prv[take]
            wait(np.unique(np.concatenate([take, before[before >= 0]])))
            if len(later := later[rank[later] == r]):
                put(r, later)
        stay = sym >= 0
        return sym[stay], word[stay]

    def _bytes_of_unknown(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odd = np.flatnonzero(sym >= self.base)
        if not len(odd):
            return sym, word
        parts = [chr(c).encode() for c in (sym[odd] - self.base).tolist()]
        times = np.ones(len(sym), np.int64)
        times[odd] = [len(p) for p in parts]
        at = np.cumsum(times) - times
        sym, word = np.repeat(sym, times), np.repeat(word, times)
        sym[ranges(at[odd], times[odd])] = self.byte_id[np.frombuffer(b"".join(parts), np.uint8)]
        return sym, word

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the ids of each of these different words are kept; merges those that are new."""
        new = [w for w in words if w not in self.slot]
        if new:
            ids, count = self.merge_words([SPACE + w for w in new])
            self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new)), strict=True))
            self.word_ids = np.concatenate([self.word_ids, ids.astype(np.int32)])
            self.word_at = np.concatenate([self.word_at, self.word_at[-1] + np.cumsum(count)])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and the number for each (end id counted)."""
        if len(self.slot) > KEPT_WORDS:
            self._forget()
        words, per_doc = words_of(pa.array(texts, pa.string()))
        coded = words.dictionary_encode()
        slots = self._slots(strings(coded.dictionary))[coded.indices.to_numpy()]
        per_word = np.diff(self.word_at)[slots]
        n = np.diff(np.append(0, np.cumsum(per_word))[np.append(0, np.cumsum(per_doc))])
        ids = np.full(int(n.sum()) + len(per_doc), self.end_id, np.int32)
        body = np.ones(len(ids), bool)
        body[np.cumsum(n + 1) - 1] = False
        ids[body] = self.word_ids[ranges(self.word_at[slots], per_word)]
        return ids, n + 1

    def decimal(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Each stretch of ids as decimal numbers joined by one space."""
        length = self.shown_len[ids]
        data = self.shown[ranges(self.shown_at[ids], length)].tobytes()
        ends = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(counts))].tolist()
        return [data[a + 1 : b] for a, b in zip(ends, ends[1:], strict=False)]

    # decoding ---------------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each stretch of ids, as UTF-8; a byte that is no character becomes U+FFFD."""
        ids = np.asarray(ids, np.int64)
        length = self.surface_len[ids]
        data = self.surface[ranges(self.surface_at[ids], length)].tobytes()
        id_end = np.cumsum(counts)
        byte_end = np.append(0, np.cumsum(length))[id_end].tolist()
        id_at = (id_end - counts).tolist()
        out = []
        for k, (a, b) in enumerate(zip([0, *byte_end], byte_end, strict=False)):
            own = id_at[k]
            while own < id_end[k] and self.is_control[ids[own]]:
                own += 1
            if own < id_end[k] and self.starts_with_space[ids[own]]:
                a += 1  # the dummy prefix
            one = data[a:b]
            try:
                one.decode()
            except UnicodeDecodeError:
                one = one.decode("utf-8", "replace").encode()
            out.append(one)
        return out


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts and their number for each: cut before every space that follows
    another character. The first space of a word (the dummy prefix, for the first) is left out."""
    texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
    odd = pc.or_(pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")), pc.match_substring(texts, "  "))
    odd = pc.or_(odd, pc.equal(texts, "")).to_numpy(zero_copy_only=False)
    if not odd.any():
        lists = pc.split_pattern(texts, " ")
        return lists.flatten(), np.diff(lists.offsets.to_numpy())
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    runs = pa.array([_spaced(t) for t in strings(texts.filter(pa.array(odd)))], pa.list_(pa.string()))
    order = np.empty(len(texts), np.int64)
    order[~odd] = np.arange(len(plain))
    order[odd] = len(plain) + np.arange(len(runs))
    lists = pa.concat_arrays([plain, runs]).take(pa.array(order))
    return lists.flatten(), pc.list_value_length(lists).to_numpy()


def _spaced(text: str) -> list[str]:
    """The words of a text with runs of spaces: a run goes with the word after it."""
    out, spaces = [], -1
    for w in text.split(" ") if text else ():
        spaces += 1
        if w:
            out.append(SPACE * spaces + w)
            spaces = -1
    if spaces >= 0:
        out.append(SPACE * spaces)
    return out


def read_model(path: str) -> tuple[list[tuple[str, float, str]], int]:
    """Pieces and end id of a model file, read on the driver and sent to the tasks (its size is the vocabulary's)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "byte" if model.is_byte(i) else "normal"
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())], model.eos_id()


_CODECS: dict[str, PieceCodec] = {}


def codec_of(pieces: list[tuple[str, float, str]], end_id: int) -> PieceCodec:
    """The worker's codec of this model, built once."""
    key = hashlib.md5(repr((pieces, end_id)).encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceCodec(pieces, end_id)
    return _CODECS[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each text with an end id and decode it again.

    Returns one row per input row: the id column, n_tokens, ids_sha256, decoded_sha256,
    and the ids themselves (array<int>) if asked for. One pass, no shuffle.
    """
    on_workers(docs.sparkSession)
    pieces, end_id = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(pieces, end_id)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            ids, counts = codec.encode(batch.column("text"))
            decoded = codec.decode(ids, counts)
            cols = [
                batch.column("id"), pa.array(counts, pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in codec.decimal(ids, counts)]),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            ]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(cols)])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out = source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)
