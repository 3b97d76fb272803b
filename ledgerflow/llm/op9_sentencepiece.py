"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by (score descending, place ascending), merges
its best entry and enters the new neighbours, until no adjacent pair is a piece. The text is first cut
where no piece can reach across (before a space, around a line end), so equal parts are encoded once per
worker. Short parts run side by side as arrays, one agenda step each per round; long parts use a heap.
Every part is compared, as it is first met, with the sentencepiece library; a difference raises.

Rules: null and empty texts give the end id alone; every row gives one row; other columns are kept, a
column named like an added one is replaced. Nothing is collected; a task holds one slice of a batch.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import with_arrow

SPACE = "▁"
LONG_PART = 64
CACHED_PARTS = 300_000
_NONE = np.int64(2**62)


class Vocabulary:
    """Pieces, scores and the table of pairs that merge."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        if any(self.library.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        plain = [i for i in range(size) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        piece = {self.library.id_to_piece(i): i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in piece):
            raise ValueError("pieces that cross a word start are not supported")
        if self.library.normalize("Aﬁ  b\n ") != f"{SPACE}Aﬁ{SPACE}{SPACE}b\n{SPACE}":
            raise ValueError("vocabularies that normalise text are not supported")
        self.size, self.end = size, self.library.eos_id()
        self.lines_apart = not any("\n" in p for p in piece)
        self.before = len(self.library.encode("\n"))
        self.byte = {self.library.id_to_piece(i): i for i in range(size) if self.library.is_byte(i)}
        scores = sorted({self.library.get_score(i) for i in plain}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        symbol = lambda s: piece.get(s, size + ord(s)) if len(s) == 1 else piece.get(s)
        pairs = {}
        for text, i in piece.items():
            for cut in range(1, len(text)):
                left, right = symbol(text[:cut]), symbol(text[cut:])
                if left is not None and right is not None:
                    pairs[left << 22 | right] = (rank[self.library.get_score(i)], i)
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, _NONE)
        self.rank = np.array([*(pairs[k][0] for k in keys.tolist()), 0], np.int64)
        self.merged = np.array([*(pairs[k][1] for k in keys.tolist()), 0], np.int64)
        self.pairs = pairs
        self.of_char = np.arange(0x110000, dtype=np.int64) + size
        for text, i in piece.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        self.of_char[0x20] = self.of_char[ord(SPACE)]

    def _bytes(self, symbol: int) -> list[int]:
        if self.byte:
            return [self.byte[f"<0x{b:02X}>"] for b in chr(symbol - self.size).encode("utf-8", "replace")]
        return [self.library.unk_id()]

    def ids(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary become the ids of their bytes."""
        strange = np.flatnonzero(symbols >= self.size)
        if not len(strange):
            return symbols, counts
        names, which = np.unique(symbols[strange], return_inverse=True)
        spelled = [self._bytes(n) for n in names.tolist()]
        pool = np.array([x for ids in spelled for x in ids], np.int64)
        length = np.array([len(x) for x in spelled], np.int64)
        start = np.cumsum(length) - length
        width = np.ones(len(symbols), np.int64)
        width[strange] = length[which]
        out = np.repeat(symbols, width)
        into = (np.cumsum(width) - width)[strange]
        out[arrays.gather(into, length[which])] = pool[arrays.gather(start[which], length[which])]
        part = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(part, weights=width, minlength=len(counts)).astype(np.int64)

    def agenda(self, symbols: list[int]) -> list[int]:
        """One part, with a heap: O(n log n) however long it is."""
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def enter(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get(symbols[i] << 22 | symbols[j])):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            enter(i, i + 1)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = right[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = to, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            enter(left[i], i)
            enter(i, right[i])
        return [s for s in symbols if s >= 0]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 22 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], _NONE), self.merged[at]

    def side_by_side(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many short parts: in each round every part takes the best entry of its own agenda."""
        part = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), _NONE)
        to = np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner], to[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        done_s, done_p = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            width = np.diff(np.r_[first, len(part)])
            place = np.arange(len(part)) - np.repeat(first, width)
            best = np.minimum.reduceat(np.where(rank == _NONE, _NONE, rank << 16 | place), first)
            open_ = best != _NONE
            if not open_.all():
                keep = np.repeat(open_, width)
                done_s.append(symbols[~keep])
                done_p.append(part[~keep])
                if not open_.any():
                    break
                symbols, part, rank, to = symbols[keep], part[keep], rank[keep], to[keep]
                width, best = width[open_], best[open_]
                first = np.cumsum(width) - width
            at = first + (best & 0xFFFF)
            symbols[at] = to[at]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            stay = ~gone
            new = (np.cumsum(stay) - 1)[at]
            symbols, part, rank, to = symbols[stay], part[stay], rank[stay], to[stay]
            touched = np.unique(np.r_[new, new[new > 0] - 1])
            has = (touched + 1 < len(part)) & (part[np.minimum(touched + 1, len(part) - 1)] == part[touched])
            rank[touched[~has]] = _NONE
            pair = touched[has]
            rank[pair], to[pair] = self._ranks(symbols[pair], symbols[pair + 1])
        symbols, part = np.concatenate([np.zeros(0, np.int64), *done_s]), np.concatenate([np.zeros(0, np.int64), *done_p])
        order = np.argsort(part, kind="stable")
        return symbols[order], np.bincount(part, minlength=len(sizes))

    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of prepared text (a space stands for the word sign), and each part's number of ids."""
        texts = [p.decode("utf-8", "replace") for p in parts]
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = self.of_char[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        short = sizes <= LONG_PART
        symbols, counts = self.side_by_side(flat[np.repeat(short, sizes)], sizes[short])
        if not short.all():
            starts = np.cumsum(sizes) - sizes
            long = [self.agenda(flat[starts[i] : starts[i] + sizes[i]].tolist()) for i in np.flatnonzero(~short)]
            every = np.zeros(len(parts), np.int64)
            every[short], every[~short] = counts, [len(x) for x in long]
            mine = np.repeat(short, every)
            merged = np.zeros(len(mine), np.int64)
            merged[mine], merged[~mine] = symbols, [x for ids in long for x in ids]
            symbols, counts = merged, every
        ids, counts = self.ids(symbols, counts)
        skip = self.before if self.lines_apart else 0
        expected = self.library.encode(["\n" + t if skip else t[1:] for t in texts], num_threads=1)
        wanted = np.fromiter((len(x) - skip for x in expected), np.int64, len(expected))
        flat = np.fromiter(chain.from_iterable(x[skip:] for x in expected), np.int64, int(wanted.sum()))
        if not (np.array_equal(wanted, counts) and np.array_equal(flat, ids)):
            raise AssertionError("encoding differs from the sentencepiece library's")
        return ids, counts


class Encoder:
    """Encodes slices of Arrow batches; known parts are kept up to a bounded number."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self._clear()
        spelled = [f"{i} ".encode() for i in range(self.vocabulary.size)]
        self.digits = np.frombuffer(b"".join(spelled), np.uint8)
        self.width = np.array([len(x) for x in spelled], np.int64)
        self.place = np.cumsum(self.width) - self.width

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.start = self.count = np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each text's end id last, and the texts' offsets in it."""
        data, offsets = arrays.text_bytes(texts)
        sizes = np.diff(offsets)
        data = np.insert(data, offsets[:-1][sizes > 0], 0x20)
        offsets = np.r_[0, np.cumsum(sizes + (sizes > 0))]
        space = data == 0x20
        sign = np.zeros(len(data), bool)
        if len(data) > 3:
            sign[3:] = (data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81)
        cut = space & ~np.r_[False, space[:-1]][: len(data)] & ~sign
        if self.vocabulary.lines_apart:
            line = data == 0x0A
            cut |= line
            cut[1:] |= line[:-1]
        cut[offsets[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.r_[starts[1:], len(data)][: len(starts)]
        distinct, first, which = np.unique(arrays.hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHED_PARTS:
            self._clear()
        names = distinct.tolist()
        new = [k for k, name in enumerate(names) if name not in self.known]
        if new:
            raw = data.tobytes()
            a, b = starts[first].tolist(), ends[first].tolist()
            ids, counts = self.vocabulary.encode_parts([raw[a[k] : b[k]] for k in new])
            self.known.update(zip((names[k] for k in new), range(len(self.count), len(self.count) + len(new)), strict=True))
            self.start = np.r_[self.start, len(self.pool) + np.cumsum(counts) - counts]
            self.count = np.r_[self.count, counts]
            self.pool = np.r_[self.pool, ids.astype(np.int32)]
        here = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[which]
        counts = self.count[here]
        bounds = np.r_[0, np.cumsum(counts)][np.searchsorted(starts, offsets)] + np.arange(len(offsets))
        out = np.full(int(bounds[-1]), self.vocabulary.end, np.int32)
        mine = np.ones(len(out), bool)
        mine[bounds[1:] - 1] = False
        out[mine] = self.pool[arrays.gather(self.start[here], counts)]
        return out, bounds

    def spelled(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, list[int]]:
        """Decimal ids, a space after each, and the texts' offsets in it."""
        width = self.width[ids]
        ends = np.r_[0, np.cumsum(width)]
        return self.digits[arrays.gather(self.place[ids], width)].tobytes(), ends[bounds].tolist()


_encoders: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    key = sha256(model).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(model)
    return _encoders[key]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _model(path: str | None) -> bytes:
    with open(path or default_model(), "rb") as file:
        return file.read()


def encode(docs: DataFrame, model_path: str | None = None, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int, end id last) and ``n_tokens``."""
    model = _model(model_path)

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
            ids, bounds = _encoder(model).encode(part.column(text))
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield part, {"ids": listed, "n_tokens": pa.array(np.diff(bounds), pa.int64())}

    return with_arrow(docs, added, "ids array<int>, n_tokens bigint")


def decode(docs: DataFrame, model_path: str | None = None, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the library's decode of each row's ids; null ids give null."""
    model = _model(model_path)

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        decoder = _encoder(model).vocabulary.library
        texts = [None if x is None else decoder.decode(x) for x in batch.column(ids).to_pylist()]
        yield batch, {"decoded": pa.array(texts, pa.string())}

    return with_arrow(docs, added, "decoded string")


def token_digests(docs: DataFrame, model_path: str | None = None, text: str = "text") -> DataFrame:
    """Encode and decode in one pass; add ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``round_trip``.

    The ids never leave their slice, so nothing larger than the text itself is moved.
    """
    model = _model(model_path)

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        encoder = _encoder(model)
        for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
            ids, bounds = encoder.encode(part.column(text))
            digits, at = encoder.spelled(ids, bounds)
            id_sha, text_sha, same = [], [], []
            for i, source in enumerate(part.column(text)):
                id_sha.append(sha256(digits[at[i] : at[i + 1] - 1]).hexdigest())
                back = encoder.vocabulary.library.decode(ids[bounds[i] : bounds[i + 1]].tolist())
                text_sha.append(sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                same.append(back == (source.as_py() or ""))
            yield part, {
                "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                "ids_sha256": pa.array(id_sha, pa.string()),
                "decoded_sha256": pa.array(text_sha, pa.string()),
                "round_trip": pa.array(same, pa.bool_()),
            }

    return with_arrow(docs, added, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("round_trip"))
