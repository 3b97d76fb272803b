"""Benchmark decontamination with suffix arrays over the training shards.

A shard is one slice of an Arrow batch (at most 1 MB of text, or one longer document). Its word suffixes
are sorted into a suffix array; every test suffix, as long as a window, is located in it by binary search.
Only suffixes that can hold a window are sorted: they start a run of words, all known from the test set,
at least as long as the shortest window. A window knows every place of every item it stands at; matches of one item that
follow each other in item and document alike are joined into the longest verbatim ones, with their places.

The test set goes to the tasks in blocks of at most ``BLOCK_BYTES``; a larger set takes more passes, each of
which adds to the places found before, so memory stays bounded and no document is moved. The structure holds about 25 bytes
for each byte of items: some 50 MB a block.

Rules: null and wordless texts have no words, no hits; an item without words has no window; equal windows
of several items count for each; items that share an id count once; an item without id still hits but is not
listed; every input row gives one row (repeated rows too); with no items nothing is hit. Added columns
replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import documents, with_arrow

WINDOW = 13
BLOCK_BYTES = 2 << 20
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
ADDED = (
    "n_words bigint, n_hit bigint, item_ids array<string>, "
    "matches array<struct<item_id:string,item_word:bigint,start:bigint,length:bigint>>, hits array<bigint>"
)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    data, offsets = arrays.text_bytes(column)
    data = arrays.LOWER[data]
    starts, ends = arrays.spans(WORD[data], offsets)
    return arrays.hashes(data, starts, ends), arrays.row_of(starts, offsets)


def _keys(words: np.ndarray, places: np.ndarray, room: np.ndarray, window: int, fill: int = 0) -> np.ndarray:
    """The next ``window`` words from each place as one sortable byte string; beyond ``room`` stands ``fill``."""
    padded = np.r_[words, np.zeros(window, np.uint32)].astype(np.uint32)
    key = np.lib.stride_tricks.sliding_window_view(padded, window)[places].copy()
    key[np.arange(window) >= room[:, None]] = fill
    return np.ascontiguousarray(key.astype(">u4")).view(f"S{4 * window}").ravel()


class TestSet:
    """The distinct windows of a block of items as sorted keys, and all places (item, word) of each, window by window."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int = WINDOW):
        hashed, row = _words(pa.array(texts, pa.string()))
        self.window = window
        self.vocabulary, number = np.unique(hashed, return_inverse=True)
        words = number.astype(np.uint32) + 1
        size = np.bincount(row, minlength=len(ids))
        first = np.cumsum(size) - size
        within = np.arange(len(words)) - first[row]
        width = np.minimum(size, window)
        place = np.flatnonzero(within + width[row] <= size[row])
        self.shortest = int(width[width > 0].min(initial=window))
        keys = _keys(words, place, width[row[place]], window)
        high = _keys(words, place, width[row[place]], window, 0xFFFFFFFF)
        _, one, which = np.unique(high, return_index=True, return_inverse=True)
        self.low, self.high = keys[one], high[one]
        self.length = width[row[place]][one].astype(np.int32)
        by_window = np.argsort(which, kind="stable")
        self.item, self.word = row[place][by_window].astype(np.int32), within[place][by_window].astype(np.int32)
        self.places = np.bincount(which, minlength=len(one))
        self.first = np.cumsum(self.places) - self.places
        self.ids = ids


def _joined(places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals given in order of their start."""
    if not len(places):
        return places, places
    reach = np.maximum.accumulate(places + sizes)
    new = np.r_[True, places[1:] > reach[:-1]]
    start = places[new]
    end = reach[np.r_[np.flatnonzero(new)[1:] - 1, len(places) - 1]]
    return start, end


def _search(tests: TestSet, column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[list, set[str], np.ndarray]]]:
    """Words of each row; and for each row that is hit its matches, items and covered words (start, end pairs)."""
    hashed, row = _words(column)
    count = np.bincount(row, minlength=len(column))
    found: dict[int, tuple[list, set[str], np.ndarray]] = {}
    if not len(hashed) or not len(tests.low):
        return count, found
    at = np.minimum(np.searchsorted(tests.vocabulary, hashed), len(tests.vocabulary) - 1)
    known = tests.vocabulary[at] == hashed
    words = np.where(known, at + 1, 0).astype(np.uint32)
    n = len(words)
    ends = np.flatnonzero(~known | np.r_[row[1:] != row[:-1], True])
    stop = ends[np.searchsorted(ends, np.arange(n))]
    room = np.where(known, stop - np.arange(n) + known[stop], 0)
    place = np.flatnonzero(room >= tests.shortest)
    if not len(place):
        return count, found
    keys = _keys(words, place, np.minimum(room[place], tests.window), tests.window)
    order = np.argsort(keys, kind="stable")
    suffixes, place = keys[order], place[order]
    low = np.searchsorted(suffixes, tests.low, "left")
    high = np.searchsorted(suffixes, tests.high, "right")
    hit = np.flatnonzero(high > low)
    sizes = (high - low)[hit]
    spot = place[arrays.gather(low[hit], sizes)]
    test = np.repeat(hit, sizes)
    order = np.argsort(spot, kind="stable")
    spot, test = spot[order], test[order]
    first = np.cumsum(count) - count
    for r, lo, hi in _groups(row[spot]):
        p, t = spot[lo:hi] - first[r], test[lo:hi]
        start, end = _joined(p, tests.length[t])
        matches = _verbatim(tests, p, t)
        names = {m["item_id"] for m in matches} - {None}
        found[r] = (matches, names, np.stack([start, end], 1))
    return count, found


def _groups(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)] if len(values) else np.zeros(1, np.int64)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(values[lo]), lo, hi


def _verbatim(tests: TestSet, place: np.ndarray, test: np.ndarray) -> list[dict]:
    """Longest verbatim matches with every item: its windows that follow each other along one diagonal are one."""
    many = tests.places[test]
    every = arrays.gather(tests.first[test], many)
    item, word = tests.item[every].astype(np.int64), tests.word[every].astype(np.int64)
    size, place = np.repeat(tests.length[test], many).astype(np.int64), np.repeat(place, many)
    order = np.lexsort((place, place - word, item))
    item, word, size, place = item[order], word[order], size[order], place[order]
    new = np.r_[True, (item[1:] != item[:-1]) | (place[1:] - word[1:] != place[:-1] - word[:-1]) | (place[1:] > place[:-1] + size[:-1])]
    firsts = np.flatnonzero(new)
    lasts = np.r_[firsts[1:] - 1, len(place) - 1]
    return [
        {"item_id": tests.ids[i], "item_word": w, "start": s, "length": e - s}
        for i, w, s, e in zip(item[firsts].tolist(), word[firsts].tolist(), place[firsts].tolist(), (place[lasts] + size[lasts]).tolist(), strict=True)
    ]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list]]:
    """The items in blocks of bounded size; an item larger than a block is a block of its own."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    parts = max(1, math.ceil(total / BLOCK_BYTES))
    held = F.pmod(F.xxhash64("i", "t"), F.lit(parts))
    for k in range(parts):
        rows = (items if parts == 1 else items.where(held == k)).sort("i", "t").collect()
        yield [r.i for r in rows], [r.t for r in rows]


def find_matches(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``item_ids`` (sorted), ``matches`` and ``hits``.

    ``matches``: item, its word, the document's word, words; ``hits``: start, end, start, end ... of the
    covered words. A block's window list is held by each task: it is bounded by ``BLOCK_BYTES``.
    """
    spark = docs.sparkSession
    out = docs
    for k, (ids, texts) in enumerate(_blocks(benchmark, item_id, text)):
        tests = spark.sparkContext.broadcast(TestSet(ids, texts, window))
        out = with_arrow(out, _pass(tests, text, k > 0), ADDED)
    return out


def _pass(tests, text: str, again: bool):
    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
            count, found = _search(tests.value, part.column(text))
            rows = part.num_rows
            matches: list[list] = [[] for _ in range(rows)]
            items: list[list[str]] = [[] for _ in range(rows)]
            hits: list[list[int]] = [[] for _ in range(rows)]
            if again:
                matches, items, hits = (part.column(n).to_pylist() for n in ("matches", "item_ids", "hits"))
            for r, (m, names, covered) in found.items():
                matches[r] = matches[r] + m
                items[r] = sorted({*items[r], *names})
                every = np.concatenate([np.array(hits[r], np.int64).reshape(-1, 2), covered])
                every = every[np.argsort(every[:, 0], kind="stable")]
                hits[r] = np.stack(_joined(every[:, 0], every[:, 1] - every[:, 0]), 1).ravel().tolist()
            yield part, {
                "n_words": pa.array(count, pa.int64()),
                "n_hit": pa.array([sum(h[1::2]) - sum(h[::2]) for h in hits], pa.int64()),
                "item_ids": pa.array(items, pa.list_(pa.string())),
                "matches": pa.array(matches, pa.list_(_MATCH)),
                "hits": pa.array(hits, pa.list_(pa.int64())),
            }

    return added


def contaminated(numerator: int = 1, denominator: int = 20):
    """At least 1/20 of the words are hit."""
    return (F.col("n_hit") > 0) & (denominator * F.col("n_hit") >= numerator * F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = find_matches(docs.select(F.struct(*docs.columns).alias("__row"), "text"), benchmark)
    return found.where(~contaminated()).select("__row.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
