"""Suffix-array dedup: remove every byte of a repeated 200-byte string, by distributed difference-cover sorting.

Sorting all suffixes of a corpus in one array would need many times its size, so the work is first dealt by content:

1. *Deal.* The 32-byte hash that is smallest in a 200-byte window (of the 169 in it) names the window's class; equal windows
   are in one class, wherever they stand. Neighbouring windows of one class form a run. Only run records travel (about one per 90 bytes).
2. *Keep* classes with two or more runs (or with a smallest hash that occurs twice in one run). Runs equal in class, bytes hash and length collapse
   to one; a run that was met twice is repeated as a whole.
3. *Sort.* The remaining distinct runs, with their bytes, are gathered by class into shards of about ``SHARD_BYTES``. Each shard builds its
   suffix array with the difference cover {1, 2} mod 3: sort sampled triples, name them, recurse on the names until they reach
   200 bytes, merge the remaining suffixes. Prefixes of neighbours are then compared byte by byte.
   A class above ``HOT_BYTES`` (a passage that a large share of all documents holds) is split: its windows are dealt once more by
   their 128-bit hashes and counted, so no task holds the class; neighbouring windows that repeat leave as one stretch.
4. *Mark.* Repeated windows go back to all runs and to their documents, overlaps are joined, and the bytes between are kept.

Rules: null is empty; a text under 200 bytes can't lose anything; strings never cross documents; all copies lose the string, none is kept;
repeated rows are different documents; an empty table gives an empty result. Documents are told apart by their place in the scan
(``monotonically_increasing_id``), which is the same on every read of the same files. Runs are compared by class and a 64-bit hash (together 128 bits).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import documents, with_arrow
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import store

WINDOW = 200
GRAM = 32
SHARD_BYTES = 512 << 10
HOT_BYTES = 3 << 20
#: Small enough for the arrays of a slice to stay in the cache.
SLICE = 128 << 10
#: Run lists up to this size are broadcast to the texts; beyond it they are joined by a shuffle. Marks are always joined by a shuffle.
BROADCAST_BYTES = 48 << 20


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each place."""
    h, k = arrays._BYTE[data], 1
    while k < size:
        h = arrays.mix(h[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
        k *= 2
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    rest = width - k
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def window_runs(column: pa.Array, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, class, bytes hash, first window, number of windows and whether the class hash occurs twice, of each run."""
    data, offsets = arrays.text_bytes(column)
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none.astype(bool)
    span = window - gram + 1
    h = _gram_hashes(data, gram)
    low = _sliding_min(h, span)
    places = np.arange(len(low))
    row = np.repeat(np.arange(len(column)), np.diff(offsets))[: len(low)]
    inside = places + window <= offsets[row + 1]
    joined = np.zeros(len(low), bool)
    joined[1:] = (low[1:] == low[:-1]) & (row[1:] == row[:-1]) & inside[:-1]
    first = np.flatnonzero(inside & ~joined)
    ends = inside.copy()
    ends[:-1] &= ~joined[1:] | ~inside[1:]
    last = np.flatnonzero(ends)
    view = np.lib.stride_tricks.sliding_window_view(h, span)
    twice = np.zeros(len(first), bool)
    for at in range(0, len(first), 4096):
        part = slice(at, at + 4096)
        name = low[first[part]][:, None]
        head = first[part] + (view[first[part]] == name).argmax(1)
        tail = last[part] + span - 1 - (view[last[part]] == name)[:, ::-1].argmax(1)
        twice[part] = head != tail
    return row[first], low[first], arrays.hashes(data, first, last + window), first - offsets[row[first]], last - first + 1, twice


def _runs(text: str, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, text, SLICE):
                row, name, content, first, n, twice = window_runs(part.column(text), window, gram)
                rid = part.column("rid").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), pa.array(name.view(np.int64)), pa.array(content.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(twice)],
                    names=["rid", "m", "f", "p", "n", "twice"],
                )

    return run


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number per pair, in the order of the pairs."""
    top = int(b.max(initial=0)) + 1
    if (int(a.max(initial=0)) + 1) * top < 1 << 62:
        return a * top + b
    return _dense(a) * top + b


def _below(values: np.ndarray, wanted: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many ``values`` are smaller than each wanted one; ``order`` sorts ``wanted``, so the search runs forward."""
    out = np.empty(len(wanted), np.int64)
    out[order] = np.searchsorted(np.sort(values), wanted[order])
    return out


def _smaller(rank: np.ndarray) -> np.ndarray:
    """How many entries are smaller than each entry of a small-number array."""
    counts = np.bincount(rank)
    return (np.cumsum(counts) - counts)[rank]


def suffix_ranks(s: np.ndarray, reach: int) -> np.ndarray:
    """Number of smaller suffixes for each place of ``s`` (integers from 1); suffixes equal in their first ``reach`` symbols may tie.

    Difference cover {1, 2} of 3.
    """
    n = len(s)
    if reach <= 1 or n < 3:
        return _smaller(s) if reach <= 1 else _plain_ranks(s)
    p = np.r_[s, 0, 0, 0]
    one, two, zero = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.r_[one, two]
    # sort sampled triples and name them
    names = _dense(_pairs(_pairs(p[sample], p[sample + 1]), p[sample + 2])) + 1
    if names.max() == len(sample):
        rank = names
    else:
        # recurse on the names: first those at 1 mod 3, a border, then those at 2 mod 3
        inner = suffix_ranks(np.r_[names[: len(one)], 0, names[len(one) :]] + 1, -(-reach // 3))
        rank = np.r_[inner[: len(one)], inner[len(one) + 1 :]] + 1
    of = np.zeros(n + 3, np.int64)
    of[sample] = rank
    # merge the remaining suffixes: a place at 0 meets one at 1 by (symbol, rank), one at 2 by (symbol, symbol, rank)
    in_one = _pairs(p[np.r_[zero, one]], of[np.r_[zero, one] + 1])
    zero_1, one_1 = in_one[: len(zero)], in_one[len(zero) :]
    both = np.r_[zero, two]
    in_two = _pairs(_pairs(p[both], p[both + 1]), of[both + 2])
    zero_2, two_2 = in_two[: len(zero)], in_two[len(zero) :]
    by_1, by_2 = np.argsort(zero_1), np.argsort(zero_2)
    out = np.zeros(n, np.int64)
    out[zero] = _below(zero_1, zero_1, by_1) + _below(one_1, zero_1, by_1) + _below(two_2, zero_2, by_2)
    smaller = _smaller(rank)
    out[one] = smaller[: len(one)] + _below(zero_1, one_1, np.argsort(one_1))
    out[two] = smaller[len(one) :] + _below(zero_2, two_2, np.argsort(two_2))
    return out


def _plain_ranks(s: np.ndarray) -> np.ndarray:
    suffixes = [s[i:].tolist() for i in range(len(s))]
    return np.array([sum(x < y for x in suffixes) for y in suffixes], np.int64)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` have equal bytes."""
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,)) if len(data) >= 8 and window >= 8 else None
    for k in [*range(0, window - 7, 8), window - 8] if words is not None else range(window):
        source = words if words is not None else data
        ok = source[a[left] + k] == source[b[left] + k]
        same[left[~ok]] = False
        left = left[ok]
    return same


Windows = tuple[np.ndarray, np.ndarray, np.ndarray]


def repeated_windows(parts: list[bytes], window: int = WINDOW) -> Windows:
    """(part, first, end) of window starts whose string starts at another place of the parts as well."""
    size = np.array([len(x) for x in parts], np.int64)
    start = np.cumsum(size + 1) - size - 1
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + 2
    symbols[start + size] = 1
    order = np.argsort(suffix_ranks(symbols, window), kind="stable")
    valid = np.zeros(len(data), bool)
    valid[arrays.gather(start, np.maximum(size - window + 1, 0))] = True
    order = order[valid[order]]
    repeated = np.zeros(len(data) + 1, bool)
    if len(order) > 1:
        same = _equal(data, order[:-1], order[1:], window)
        repeated[order[:-1][same]] = True
        repeated[order[1:][same]] = True
    edges = np.flatnonzero(np.diff(np.r_[False, repeated].astype(np.int8)))
    first, end = edges[::2], edges[1::2]
    whose = np.searchsorted(start, first, "right") - 1
    return whose, first - start[whose], end - start[whose]


def _sorted_shard(window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        part, w0, w1 = repeated_windows([x.as_py() for x in table.column("bytes")], window)
        take = lambda c: table.column(c).combine_chunks().take(pa.array(part))
        return pa.table([take("m"), take("f"), take("n"), pa.array(w0.astype(np.int32)), pa.array(w1.astype(np.int32))], names=["m", "f", "n", "w0", "w1"])

    return run


def _cut(text: str, window: int):
    """Bytes of the chosen runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, f, n, shard, out = [], [], [], [], []
            for body, chosen in zip(batch.column(text), batch.column("chosen").to_pylist(), strict=True):
                raw = body.as_py().encode()
                for c in chosen:
                    m.append(c["m"]), f.append(c["f"]), n.append(c["n"]), shard.append(c["shard"])
                    out.append(raw[c["p"] : c["p"] + c["n"] + window - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(m, pa.int64()), pa.array(f, pa.int64()), pa.array(n, pa.int32()), pa.array(out, pa.binary())],
                names=["shard", "m", "f", "n", "bytes"],
            )

    return run


def _window_hashes(window: int):
    """Every window of a run with its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("bytes")[i].as_py()
                names = [hashlib.blake2b(raw[k : k + window], digest_size=16).digest() for k in range(len(raw) - window + 1)]
                k = len(names)
                same = lambda c: pa.array([batch.column(c)[i].as_py()] * k, batch.column(c).type)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same("m"), same("f"), same("n"), pa.array(range(k), pa.int32()), pa.array(names, pa.binary())], names=["m", "f", "n", "w0", "name"])

    return run


def _joined_windows(windows: DataFrame) -> DataFrame:
    """Neighbouring windows ``w0`` of a run as one stretch (``w0`` to ``w1``), so a run leaves a row per stretch and not per window."""
    nth = F.row_number().over(Window.partitionBy("m", "f", "n").orderBy("w0"))
    stretches = windows.select("m", "f", "n", "w0", (F.col("w0") - nth).alias("stretch")).groupBy("m", "f", "n", "stretch")
    return stretches.agg(F.min("w0").alias("w0"), (F.max("w0") + 1).alias("w1")).select("m", "f", "n", "w0", "w1")


def _beside(docs: DataFrame, other: DataFrame) -> DataFrame:
    """Join by ``rid``; the other side (stored, array column ``c``) is broadcast only when it is known to be small."""
    bytes_ = other.agg(F.sum(F.lit(40) + F.size("c") * 40)).first()[0] or 0
    return docs.join(F.broadcast(other) if bytes_ <= BROADCAST_BYTES else other, "rid")


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``rid`` and ``c`` (array of (start, end) bytes, overlapping) for documents (columns ``rid`` and text) with repeated strings."""
    spark = docs.sparkSession
    ship_package(spark)
    runs = store(docs.mapInArrow(_runs(text, window, gram), "rid bigint, m bigint, f bigint, p int, n int, twice boolean"), "runs")
    kinds = runs.groupBy("m").agg(F.count("*").alias("k"), F.max(F.col("twice").cast("int")).alias("t")).where("k > 1 OR t = 1").select("m")
    kept = store(runs.join(kinds, "m", "left_semi"), "kept")
    distinct = store(
        kept.groupBy("m", "f", "n").agg(F.count("*").alias("copies"), F.max("twice").alias("twice"), F.min(F.struct("rid", "p")).alias("one")), "distinct"
    )
    whole = distinct.where("copies > 1").select("m", "f", "n", F.lit(0).alias("w0"), F.col("n").alias("w1"))
    sizes = distinct.groupBy("m").agg(F.count("*").alias("k"), F.max(F.col("twice").cast("int")).alias("t"), F.sum(F.col("n") + window - 1).alias("bytes"))
    open_ = store(sizes.where("k > 1 OR t = 1").select("m", "bytes"), "open")
    total = open_.where(F.col("bytes") <= hot_bytes).agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))
    shard = F.when(F.col("bytes") <= hot_bytes, F.pmod(F.xxhash64("m"), F.lit(shards))).otherwise(F.lit(-1))
    chosen = distinct.join(open_, "m").select("one.rid", F.struct("m", "f", "n", F.col("one.p").alias("p"), shard.alias("shard")).alias("x"))
    chosen = store(chosen.groupBy("rid").agg(F.collect_list("x").alias("c")), "chosen")
    beside = _beside(docs, chosen).select(text, F.col("c").alias("chosen"))
    cut = beside.mapInArrow(_cut(text, window), "shard bigint, m bigint, f bigint, n int, bytes binary")
    found = "m bigint, f bigint, n int, w0 int, w1 int"
    if open_.where(F.col("bytes") > hot_bytes).limit(1).count():
        cut = store(cut, "cut")
        names = cut.where("shard = -1").mapInArrow(_window_hashes(window), "m bigint, f bigint, n int, w0 int, name binary")
        names = store(names, "names")
        # stored, so that the join's skewed partitions can be split: one window may stand in very many runs
        again = store(names.groupBy("m", "name").count().where("count > 1").select("m", "name"), "again")
        hot = _joined_windows(names.join(again, ["m", "name"], "left_semi"))
    else:
        hot = spark.createDataFrame([], found)
    cold = cut.where("shard >= 0").groupBy("shard").applyInArrow(_sorted_shard(window), found)
    # runs that were met twice are known to be repeated already
    parts = store(cold.union(hot).join(whole.select("m", "f", "n"), ["m", "f", "n"], "left_anti").union(whole), "parts")
    marks = kept.join(parts, ["m", "f", "n"]).select("rid", F.struct((F.col("p") + F.col("w0")).alias("start"), (F.col("p") + F.col("w1") + window - 1).alias("stop")).alias("x"))
    return store(marks.groupBy("rid").agg(F.collect_list("x").alias("c")), "marks")


def dedup(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (bytes left, as binary: a cut can split a character)."""
    named = docs.withColumn("__rid", F.monotonically_increasing_id())
    marks = repeated_spans(named.select(F.col("__rid").alias("rid"), text).where(F.octet_length(text) >= window), text, window, gram, hot_bytes)
    marks = marks.select(F.col("rid").alias("__rid"), F.col("c").alias("__spans"))

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        for part in arrays.slices(batch, text):
            rows = []
            for body, spans in zip(part.column(text), part.column("__spans").to_pylist(), strict=True):
                raw = (body.as_py() or "").encode()
                kept, at, removed, n = [], 0, 0, 0
                for s, e in sorted((x["start"], x["stop"]) for x in spans or []):
                    if s > at or not n:
                        kept.append(raw[at:s])
                        n += 1
                        removed += e - s
                    elif e > at:
                        removed += e - at
                    at = max(at, e)
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((len(raw), removed, n, hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield part, dict(zip(["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], map(pa.array, columns, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]), strict=True))

    found = with_arrow(named.join(marks.hint("merge"), "__rid", "left"), added, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return found.drop("__rid", "__spans")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
