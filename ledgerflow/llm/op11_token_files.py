"""Token ids as binary files: an adaptive context-mixing range coder in independent, checksummed blocks.

Documents are range-partitioned by id and sorted, tokenised, and each task writes one file of *chunks*. A chunk holds
whole documents (about ``CHUNK_IDS`` ids): a header with its document table and its dictionary (the ids it uses, most
frequent first), then blocks of at most ``BLOCK_IDS`` ids. A block starts from the same state as every other and has
two checksums, of its bytes and of its ids, so it is decoded alone and damage is found where it is.

Inside a block an id has three predictions. Order 2 (the two ids before, hashed) and order 1 (the id before) each
remember one successor with a confidence of 0 to 7; order 0 is a frequency table that starts from the dictionary's
rank order. The mixer is a table of adaptive weights, addressed by both confidences and by whether the two agree: it
says how much of the interval belongs to the order-2 id, to the order-1 id, and to order 0. A 64-bit range coder with
carries narrows the interval. The blocks of a chunk are the lanes of one array computation: each step codes the next
id of every block.

Files carry a name of their own per task attempt; only those that the manifest lists count, so a task that ran twice
or an executor that was lost leaves nothing but an unlisted file. The manifest has one row per chunk; positions in the
whole sequence come from the chunks' totals.

Rules: null and empty texts give the end id alone; null ids come first; rows with equal ids follow one another by
their text's hash; repeated rows stay; an empty table writes no file; long texts span many blocks of one chunk.
Only ``doc_id`` and ``text`` are read, so other columns, whatever their names, are left aside.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerflow.llm.frames import documents
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import fresh_path, store

BLOCK_IDS = 8192
LEAST_BLOCK = 512
LANES = 512
CHUNK_IDS = BLOCK_IDS * LANES
TABLE_BYTES = 96 << 20
CACHED_PARTS = 150_000
END_ID = 0

# white space as the tokenizer's pattern sees it; a part is white space and what follows it up to the next
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PART = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

MAGIC = b"LFTK"
HEADER = struct.Struct("<4sIQQIIIII")  # magic, crc of the rest, documents, ids, block size, blocks, dictionary, bytes of the table, unused
_WORD, _TOP = np.uint64(32), np.uint64(1 << 32)
_SCALE = np.uint64(16)
_FAR_BITS = 13
_RATE, _LEAST, _MOST = 5, 64, 1 << 16
_RANK_WEIGHT, _SEEN_WEIGHT = 6000, 24


class Tokens:
    """Ids of texts, by the tokenizers library; parts that were met before are looked up by their text."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        probe = "x  y\n z <b>'s"
        if self.library.encode(probe, add_special_tokens=False).ids != [i for p in PART.findall(probe) for i in self._ids(p)]:
            raise ValueError("tokenizers that look across white space are not supported")
        self.known: dict[str, bytes] = {}

    def _ids(self, part: str) -> list[int]:
        return self.library.encode(part, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit integers."""
        cut = [PART.findall(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > CACHED_PARTS:
            self.known = {}
            new = set().union(*cut)
        listed = list(new)
        for part, found in zip(listed, self.library.encode_batch_fast(listed, add_special_tokens=False), strict=True):
            self.known[part] = array("I", found.ids).tobytes()
        return [b"".join(map(self.known.__getitem__, parts)) for parts in cut]


class Mixer:
    """The model of ``lanes`` blocks side by side; encoder and decoder drive it alike."""

    def __init__(self, lanes: int, kinds: int):
        self.kinds = kinds
        self.width = 1 << max(1, (kinds - 1).bit_length())
        rank = np.arange(kinds)
        start = np.zeros(self.width, np.int32)
        start[:kinds] = 1 + _RANK_WEIGHT // (rank + 4)
        self.seen = np.tile(start, (lanes, 1))
        self.upto = np.zeros((lanes, self.width + 1), np.int32)
        self.recount()
        # one table for both orders: order 1 by id, then order 2 by hash; an entry is successor << 3 | confidence
        row = kinds + (1 << _FAR_BITS)
        self.table = np.zeros(lanes * row, np.int32)
        self.lane = np.arange(lanes)
        self.row, self.far = self.lane * row, self.lane * row + kinds
        sure = np.arange(128)
        first = 65536 * (1 + (sure >> 3 & 7)) // (10 - (sure >> 6) * 1)
        second = 65536 * (1 + (sure & 7)) // 10
        self.first = np.tile(np.clip(first, _LEAST, 60000), lanes)
        self.second = np.tile(np.clip(second, _LEAST, 60000), lanes)
        self.state_row = self.lane * 128
        self.before = np.zeros((2, lanes), np.int64)

    def recount(self) -> None:
        np.cumsum(self.seen, axis=1, out=self.upto[:, 1:])

    def cut(self, lanes: int) -> None:
        self.lane, self.row, self.far, self.state_row = (x[:lanes] for x in (self.lane, self.row, self.far, self.state_row))
        self.before = self.before[:, :lanes]

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order 1's and order 2's id, and the 16-bit borders: order 2 below the first, order 1 below the second."""
        one, two = self.before
        self.at = np.stack([self.row + one, self.far + (((two * 0x9E3779B1 + one * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - _FAR_BITS))])
        self.entry = self.table[self.at]
        self.sure = self.entry & 7
        self.guess = self.entry >> 3
        self.state = self.state_row + (self.sure[1] << 3) + self.sure[0] + ((self.guess[0] == self.guess[1]) << 6)
        self.p2, self.p1 = self.first[self.state], self.second[self.state]
        return self.guess[0], self.guess[1], self.p2, self.p2 + 1 + ((65534 - self.p2) * self.p1 >> 16)

    def learn(self, ids: np.ndarray, by_two: np.ndarray, by_one: np.ndarray) -> None:
        self.first[self.state] = self.p2 + ((np.where(by_two, _MOST, _LEAST) - self.p2) >> _RATE)
        after = self.p1 + ((np.where(by_one, _MOST, _LEAST) - self.p1) >> _RATE)
        self.second[self.state] = np.where(by_two, self.p1, after)
        kept = np.where(self.sure > 1, self.entry - (self.sure + 1 >> 1), ids << 3 | 1)
        self.table[self.at] = np.where(self.guess == ids, self.entry + (self.sure < 7), kept)
        self.before = np.stack([ids, self.before[0]])


def _recounts(step: int) -> bool:
    return step >= 16 and step & (step - 1) == 0


def _lanes_of(ids: np.ndarray, block: int) -> tuple[np.ndarray, int]:
    """Ids as (step, lane), and the length of the last lane."""
    lanes = -(-len(ids) // block)
    padded = np.zeros(lanes * block, np.int64)
    padded[: len(ids)] = ids
    return np.ascontiguousarray(padded.reshape(lanes, block).T), len(ids) - (lanes - 1) * block


def encode_blocks(ids: np.ndarray, kinds: int, block: int) -> list[bytes]:
    """Range-code ids below ``kinds``: one byte string per block."""
    steps, last = _lanes_of(ids, block)
    lanes = steps.shape[1]
    model = Mixer(lanes, kinds)
    low = np.zeros(lanes, np.uint64)
    size = np.full(lanes, 2**64 - 1, np.uint64)
    out = np.zeros((lanes, block + block // 4 + 4), np.uint64)
    at = np.zeros(lanes, np.int64)

    def narrow(which: np.ndarray | slice, unit: np.ndarray, start: np.ndarray, width: np.ndarray, names: np.ndarray) -> None:
        """Take the part ``start .. start + width`` of the interval, in units; carries go to the words before."""
        add = unit * start
        moved = low[which] + add
        if (over := np.flatnonzero(moved < add)).size:
            lane = names[over]
            out[lane, at[lane] - 1] += np.uint64(1)
        left = unit * width
        if (small := np.flatnonzero(left < _TOP)).size:
            lane = names[small]
            out[lane, at[lane]] = moved[small] >> _WORD
            at[lane] += 1
            moved[small] <<= _WORD
            left[small] <<= _WORD
        low[which], size[which] = moved, left

    live, count = slice(None), lanes
    for step in range(block if lanes > 1 else last):
        if step == last:
            count = lanes - 1
            live = slice(0, count)
            model.cut(count)
        if _recounts(step):
            model.recount()
        x = steps[step, :count]
        one, two, border, end = model.predict()
        by_two = two == x
        by_one = (one == x) & ~by_two
        start = np.where(by_two, 0, np.where(by_one, border, end))
        stop = np.where(by_two, border, np.where(by_one, end, 65536))
        narrow(live, size[live] >> _SCALE, start.view(np.uint64), (stop - start).view(np.uint64), model.lane)
        if (rest := np.flatnonzero(~(by_two | by_one))).size:
            y = x[rest]
            upto = model.upto[rest, y].astype(np.uint64)
            width = model.upto[rest, y + 1].astype(np.uint64) - upto
            narrow(rest, size[rest] // model.upto[rest, -1].astype(np.uint64), upto, width, rest)
            model.seen[rest, y] += _SEEN_WEIGHT
        model.learn(x, by_two, by_one)
    lane = np.arange(lanes)
    out[lane, at] = low >> _WORD
    out[lane, at + 1] = low & np.uint64(0xFFFFFFFF)
    while (out >> _WORD).any():
        out[:, :-1] += out[:, 1:] >> _WORD
        out &= np.uint64(0xFFFFFFFF)
    words = out.astype("<u4")
    return [words[k, : n + 2].tobytes() for k, n in enumerate(at.tolist())]


def decode_blocks(blocks: list[bytes], count: int, kinds: int, block: int) -> np.ndarray:
    """The inverse of :func:`encode_blocks` for blocks that hold ``count`` ids together."""
    lanes = len(blocks)
    last = count - (lanes - 1) * block
    words = np.frombuffer(b"".join(blocks) + bytes(8), "<u4").astype(np.uint64)
    length = np.array([len(b) // 4 for b in blocks], np.int64)
    at = np.cumsum(length) - length
    code = words[at] << _WORD | words[at + 1]
    at += 2
    size = np.full(lanes, 2**64 - 1, np.uint64)
    model = Mixer(lanes, kinds)
    out = np.zeros((block, lanes), np.int64)

    def narrow(which: np.ndarray | slice, value: np.ndarray, unit: np.ndarray, start: np.ndarray, width: np.ndarray, names: np.ndarray) -> None:
        value = value - unit * start
        left = unit * width
        if (small := np.flatnonzero(left < _TOP)).size:
            lane = names[small]
            value[small] = value[small] << _WORD | words[at[lane]]
            at[lane] += 1
            left[small] <<= _WORD
        code[which], size[which] = value, left

    halves = [1 << k for k in range(model.width.bit_length() - 2, -1, -1)]
    live, active = slice(None), lanes
    for step in range(block if lanes > 1 else last):
        if step == last:
            active = lanes - 1
            live = slice(0, active)
            model.cut(active)
        if _recounts(step):
            model.recount()
        one, two, border, end = model.predict()
        unit, value = size[live] >> _SCALE, code[live]
        point = np.minimum(value // unit, np.uint64(65535)).view(np.int64)
        by_two = point < border
        by_one = (point < end) & ~by_two
        x = np.where(by_two, two, one).astype(np.int64)
        start = np.where(by_two, 0, np.where(by_one, border, end))
        stop = np.where(by_two, border, np.where(by_one, end, 65536))
        narrow(live, value, unit, start.view(np.uint64), (stop - start).view(np.uint64), model.lane)
        if (rest := np.flatnonzero(~(by_two | by_one))).size:
            value = code[rest]
            total = model.upto[rest, -1].astype(np.uint64)
            unit = size[rest] // total
            point = np.minimum(value // unit, total - np.uint64(1)).astype(np.int32)
            y = np.zeros(len(rest), np.int64)
            for half in halves:
                y += half * (model.upto[rest, y + half] <= point)
            upto = model.upto[rest, y].astype(np.uint64)
            width = model.upto[rest, y + 1].astype(np.uint64) - upto
            narrow(rest, value, unit, upto, width, rest)
            model.seen[rest, y] += _SEEN_WEIGHT
            x[rest] = y
        model.learn(x, by_two, by_one)
        out[step, :active] = x
    return out.T.reshape(-1)[:count]


def _groups(blocks: int, kinds: int) -> Iterator[tuple[int, int]]:
    """Blocks coded side by side: no more than fit into ``TABLE_BYTES``."""
    lane = 20 * kinds + (4 << _FAR_BITS) + 2048
    most = max(1, min(LANES, TABLE_BYTES // lane))
    for k in range(0, blocks, most):
        yield k, min(blocks, k + most)


def pack_chunk(names: list[int | None], lengths: list[int], ids: bytes) -> bytes:
    """One chunk: header, document table, dictionary, block table, blocks."""
    flat = np.frombuffer(ids, "<u4")
    times = np.bincount(flat)
    distinct = np.flatnonzero(times)
    distinct = distinct[np.argsort(-times[distinct], kind="stable")]
    rank = np.zeros(len(times), np.int64)
    rank[distinct] = np.arange(len(distinct))
    block = int(min(BLOCK_IDS, max(LEAST_BLOCK, -(-len(flat) // LANES))))
    count = -(-len(flat) // block)
    mapped = rank[flat]
    payloads: list[bytes] = []
    for a, b in _groups(count, len(distinct)):
        payloads += encode_blocks(mapped[a * block : b * block], len(distinct), block)
    table = zlib.compress(
        np.packbits([n is None for n in names]).tobytes() + np.array([n or 0 for n in names], "<i8").tobytes() + np.array(lengths, "<u8").tobytes(), 1
    )
    sums = [(len(p), zlib.crc32(p), zlib.crc32(flat[k * block : (k + 1) * block].tobytes())) for k, p in enumerate(payloads)]
    rest = table + distinct.astype("<u4").tobytes() + np.array(sums, "<u4").tobytes()
    head = (len(names), len(flat), block, count, len(distinct), len(table), 0)
    crc = zlib.crc32(rest, zlib.crc32(HEADER.pack(MAGIC, 0, *head)))
    return b"".join([HEADER.pack(MAGIC, crc, *head), rest, *payloads])


def unpack_chunk(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document names, document lengths and all ids; raises where a checksum does not hold."""
    magic, crc, *head = HEADER.unpack_from(data)
    docs, ids, block, count, kinds, table_size, _ = head
    at = HEADER.size
    end = at + table_size + 4 * kinds + 12 * count
    if magic != MAGIC or zlib.crc32(data[at:end], zlib.crc32(HEADER.pack(MAGIC, 0, *head))) != crc:
        raise ValueError("damaged chunk header")
    table = zlib.decompress(data[at : at + table_size])
    bits = -(-docs // 8)
    missing = np.unpackbits(np.frombuffer(table, np.uint8, bits), count=docs)
    names = np.frombuffer(table, "<i8", docs, bits).tolist()
    lengths = np.frombuffer(table, "<u8", docs, bits + 8 * docs).astype(np.int64)
    dictionary = np.frombuffer(data, "<u4", kinds, at + table_size)
    sums = np.frombuffer(data, "<u4", 3 * count, end - 12 * count).reshape(count, 3).tolist()
    payloads = []
    for k, (size, own, _) in enumerate(sums):
        payloads.append(data[end : end + size])
        end += size
        if zlib.crc32(payloads[-1]) != own:
            raise ValueError(f"damaged block {k}")
    parts = [decode_blocks(payloads[a:b], min(ids, b * block) - a * block, kinds, block) for a, b in _groups(count, kinds)]
    flat = dictionary[np.concatenate(parts)] if parts else np.zeros(0, "<u4")
    for k, (_, _, own) in enumerate(sums):
        if zlib.crc32(flat[k * block : (k + 1) * block].tobytes()) != own:
            raise ValueError(f"block {k} decodes to other ids than were written")
    return [None if gone else name for gone, name in zip(missing, names, strict=True)], lengths, flat


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as files in ascending order of ``doc_id``; the manifest, one row per chunk.

    ``folder`` is a path or URI that pyarrow opens on every executor.
    """
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as file:
        definition = file.read()
    spark = docs.sparkSession
    ship_package(spark)
    end = array("I", [end_id]).tobytes()
    order = ["doc_id", "__hash", "__read"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__hash"), F.monotonically_increasing_id().alias("__read"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", F.col("text").cast("binary").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task = TaskContext.get().partitionId()
        tokens, sink, place, chunk, file = None, None, 0, 0, ""
        names: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal sink, place, chunk, file, size
            if sink is None:
                files, top = fs.FileSystem.from_uri(folder)
                files.create_dir(top)
                file = f"shard-{task:06d}-{uuid.uuid4().hex}.tok"
                sink = files.open_output_stream(f"{top}/{file}")
            data = pack_chunk(names, [len(x) // 4 for x in held], b"".join(held))
            sink.write(data)
            row = {"shard": task, "chunk": chunk, "file": file, "place": place, "size": len(data), "n_docs": len(names), "n_ids": size}
            place, chunk, size = place + len(data), chunk + 1, 0
            names.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tokens = tokens or _tokens(definition)
                texts = [(t or b"").decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                for name, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(texts), strict=True):
                    names.append(name)
                    held.append(ids + end)
                    size += len(held[-1]) // 4
                    if size >= CHUNK_IDS:
                        yield flush()
        if names:
            yield flush()
        if sink is not None:
            sink.close()

    schema = "shard bigint, chunk bigint, file string, place bigint, size bigint, n_docs bigint, n_ids bigint"
    manifest = placed.mapInArrow(write, schema)
    return store(manifest.withColumn("folder", F.lit(folder)), "token_manifest")


_known: dict[int, Tokens] = {}


def _tokens(definition: str) -> Tokens:
    key = hash(definition)
    if key not in _known:
        _known.clear()
        _known[key] = Tokens(definition)
    return _known[key]


def _placed(manifest: DataFrame) -> DataFrame:
    """Add ``start``, the number of ids before each chunk; shards, one per writing task, are summed first."""
    shards = manifest.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.withColumn("inside", inside).join(before, "shard").withColumn("start", F.col("first") + F.col("inside"))


def read_tokens(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """Read the files back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids`` of each document."""
    ship_package(manifest.sparkSession)
    chunks = _placed(manifest).select("folder", "file", "place", "size", "start")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int64()))] if ids else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                files, top = fs.FileSystem.from_uri(row["folder"])
                with files.open_input_file(f"{top}/{row['file']}") as source:
                    source.seek(row["place"])
                    names, lengths, flat = unpack_chunk(source.read(row["size"]))
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = memoryview(np.ascontiguousarray(flat)).cast("B")
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(names, pa.int64()), pa.array(starts + row["start"]), pa.array(lengths), pa.array(sums, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    out = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else "")
    return chunks.repartition(max(1, manifest.count())).mapInArrow(read, out)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_tokens(documents(spark, sf_dir), fresh_path(spark, "tokens"))
    return read_tokens(manifest, ids=False)
