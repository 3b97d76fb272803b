"""Language-model scoring with an Elias-Fano bigram trie.

Model: Witten-Bell. ``P(w | v) = a(v, w) + l(v) P(w)``, where ``a = c(v, w) / (c(v) + T(v))``, ``l = T(v) / (c(v) + T(v))`` (1 for a new ``v``), ``T(v)`` is
the number of different words after ``v`` and ``P(w)`` is the base: ``(c + 0.5) / (N + 0.5 (V + 1))``. Every text starts after a start sign
and closes with an end sign, which is a token.

The trie is dealt over shards by the context's hash. Documents stay in blocks of ``BLOCK_ROWS`` rows; each block sends each shard its distinct
contexts and bigrams once, with their training counts. A shard sums the counts of all blocks, builds its part of the trie, writes the levels to a
file, maps it into memory, and answers each block: the context's count and ``l``, and ``a`` of each bigram, both quantised to one byte
(256 steps in the logarithm; counts are exact). The answers meet the block's texts again and give the scores. So what travels is one
record per distinct bigram of a block, shards and blocks are of bounded size, and the model is never held in one place.

Levels: sorted context hashes, sorted successors made monotone by adding each context's place, and the pointers from contexts to
successors, each an Elias-Fano sequence (low bits packed, high bits in unary). A query finds its context by successor search, then
searches between its two pointers only.

Rules: null is empty (the end sign alone); a row without an id learns and is not held out; repeated rows count and score each time; with no training rows N and V are 0
and every base probability is 1 / 1. Words are told apart by 64-bit hashes, successors of one context by 40-bit ones.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import documents
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import store

BLOCK_ROWS = 1024
SHARD_BYTES = 16 << 20
SUCCESSOR_BITS = 40
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Signs can't be words: they hold a space.
_SIGNS = arrays.hashes(np.frombuffer(b" start end", np.uint8), np.array([0, 6]), np.array([6, 10]))
#: Quantised logarithm: code 0 is absent, codes 1 to 255 run from 10^-12.7 to 1 in steps of 10^0.05.
_STEP = 0.05


def quantised(p: np.ndarray) -> np.ndarray:
    out = np.zeros(len(p), np.uint8)
    some = p > 0
    out[some] = np.clip(np.rint(np.log10(p[some]) / _STEP) + 255, 1, 255)
    return out


def restored(code: np.ndarray) -> np.ndarray:
    table = 10.0 ** ((np.arange(256) - 255) * _STEP)
    table[0] = 0.0
    return table[code]


class Grams:
    """Tokens of a slice of texts, its distinct contexts and bigrams, and their training counts."""

    def __init__(self, column: pa.Array, trains: np.ndarray):
        data, offsets = arrays.text_bytes(column)
        data = arrays.LOWER[data]
        starts, ends = arrays.spans(WORD[data], offsets)
        rows = len(column)
        size = np.bincount(arrays.row_of(starts, offsets), minlength=rows) if len(starts) else np.zeros(rows, np.int64)
        self.size = size + 1
        last = np.cumsum(self.size) - 1
        first = last - size
        token = np.empty(int(self.size.sum()), np.uint64)
        inner = np.ones(len(token), bool)
        inner[last] = False
        token[inner] = arrays.hashes(data, starts, ends)
        token[last] = _SIGNS[1]
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[first] = _SIGNS[0]
        self.row = np.repeat(np.arange(rows), self.size)
        learnt = trains[self.row]
        self.context, of = np.unique(np.r_[token, before], return_inverse=True)
        self.token_of, before_of = of[: len(token)], of[len(token) :]
        # a start sign counts as a context only; as a token it never occurs
        self.count = np.bincount(self.token_of[learnt], minlength=len(self.context))
        pair = before_of.astype(np.int64) << 32 | self.token_of
        distinct, self.pair_of = np.unique(pair, return_inverse=True)
        self.pair_context = distinct >> 32
        successor = arrays.mix(self.context[distinct & 0xFFFFFFFF]) >> np.uint64(64 - SUCCESSOR_BITS)
        # within a context in the order of the successors' hashes
        order = np.lexsort((successor, self.pair_context))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_of = place[self.pair_of]
        self.pair_context, self.successor = self.pair_context[order], successor[order]
        self.pair_count = np.bincount(self.pair_of[learnt], minlength=len(order))

    def borders(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each shard's contexts and bigrams begin: shards are equal ranges of the hash."""
        edges = np.array([(k << 64) // shards for k in range(shards)], np.uint64)
        at = np.r_[np.searchsorted(self.context, edges), len(self.context)]
        return at, np.searchsorted(self.pair_context, at)


def _five(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


class EliasFano:
    """A monotone sequence of integers below ``universe``: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.bits = n, max(0, (universe // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        unary = np.zeros(n + (int(universe) >> self.bits) + 2, np.uint8)
        unary[high + np.arange(n)] = 1
        self.high = np.packbits(unary)
        self.low = _packed(values & np.uint64((1 << self.bits) - 1), self.bits)

    def levels(self) -> list[np.ndarray]:
        return [self.high, self.low]

    def mapped(self, high: np.ndarray, low: np.ndarray) -> EliasFano:
        """Read from mapped levels from now on; the buckets' borders are decoded once."""
        zeros = np.flatnonzero(np.unpackbits(high) == 0)
        # before the zero that closes bucket h stand as many ones as there are values with high bits up to h
        self.border = np.r_[0, zeros - np.arange(len(zeros))]
        self.high, self.low = high, low
        return self

    def at(self, i: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self.border, i, "right") - 1
        return high.astype(np.uint64) << np.uint64(self.bits) | _unpacked(self.low, i, self.bits)

    def successor(self, wanted: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value not below each wanted one, within ``lo`` to ``hi``, and whether it is equal."""
        high = (wanted >> np.uint64(self.bits)).astype(np.int64)
        last = len(self.border) - 1
        a, b = self.border[np.minimum(high, last)], self.border[np.minimum(high + 1, last)]
        if lo is not None:
            a, b = np.minimum(np.maximum(a, lo), hi), np.minimum(np.maximum(b, lo), hi)
        low = wanted & np.uint64((1 << self.bits) - 1)
        end = b
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            mid = (a[open_] + b[open_]) >> 1
            less = _unpacked(self.low, mid, self.bits) < low[open_]
            a[open_] = np.where(less, mid + 1, a[open_])
            b = b.copy() if b is end else b
            b[open_] = np.where(less, b[open_], mid)
        inside = a < end
        found = np.zeros(len(a), bool)
        found[inside] = _unpacked(self.low, a[inside], self.bits) == low[inside]
        return a, found


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    words = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(bits) > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpacked(words: np.ndarray, i: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), np.uint64)
    at = i.astype(np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    rest = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (words[word] >> shift | rest) & np.uint64((1 << bits) - 1)


class Trie:
    """One shard's levels, mapped into memory from a file of the task's own."""

    def __init__(self, context: np.ndarray, count: np.ndarray, owner: np.ndarray, successor: np.ndarray, pairs: np.ndarray, base: int, width: int):
        """``owner``: place of each bigram's context; both levels sorted; only what training has seen."""
        self.base, self.width = base, width
        kinds = np.bincount(owner, minlength=len(context))
        after = np.bincount(owner, weights=pairs, minlength=len(context))
        mass = after + kinds
        back = quantised(np.where(mass > 0, kinds / np.where(mass > 0, mass, 1), 1.0))
        share = quantised(pairs / mass[owner]) if len(owner) else np.zeros(0, np.uint8)
        monotone = owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successor
        self.contexts = EliasFano(context - np.uint64(base), width)
        self.successors = EliasFano(monotone, max(1, len(context)) << SUCCESSOR_BITS)
        self.pointers = EliasFano(np.r_[0, np.cumsum(kinds)].astype(np.uint64), len(owner) + 1)
        parts = [*self.contexts.levels(), *self.successors.levels(), *self.pointers.levels(), count.astype(np.int64), back, share]
        with tempfile.TemporaryFile(dir=os.environ.get("TMPDIR")) as file:
            places = []
            for part in parts:
                file.write(b"\0" * (-file.tell() % 8))
                places.append(file.tell())
                file.write(part.tobytes())
            file.write(b"\0" * 8)
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        levels = [whole[at : at + part.nbytes].view(part.dtype) for at, part in zip(places, parts, strict=True)]
        self.contexts.mapped(*levels[0:2])
        self.successors.mapped(*levels[2:4])
        self.pointers.mapped(*levels[4:6])
        self.count, self.back, self.share = levels[6:]

    def look_up(self, context: np.ndarray, owner: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count and back-off code of each context, share code of each bigram (its context as place in ``context``)."""
        at, found = self.contexts.successor(context - np.uint64(self.base))
        count, back = np.zeros(len(context), np.int64), np.full(len(context), 255, np.uint8)
        count[found], back[found] = self.count[at[found]], self.back[at[found]]
        share = np.zeros(len(owner), np.uint8)
        asked = np.flatnonzero(found[owner])
        if len(asked):
            node = at[owner[asked]]
            lo, hi = self.pointers.at(node).astype(np.int64), self.pointers.at(node + 1).astype(np.int64)
            spot, equal = self.successors.successor(node.astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successor[asked], lo, hi)
            share[asked[equal]] = self.share[spot[equal]]
        return count, back, share


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut and joined so that each holds one block; rows come in the order of ``rid``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if held and held[0].column("block")[0].as_py() != block[a]:
                yield _one(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _messages(shards: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(b for b in batches if b.num_rows):
            for seq, part in enumerate(arrays.slices(block, text)):
                g = Grams(part.column(text), part.column("trains").to_numpy(zero_copy_only=False).astype(bool))
                at, pair_at = g.borders(shards)
                rows: dict[str, list] = {n: [] for n in ("shard", "contexts", "counts", "fan", "successors", "pairs")}
                kinds = np.bincount(g.pair_context, minlength=len(g.context))
                for k in range(shards):
                    a, b, x, y = at[k], at[k + 1], pair_at[k], pair_at[k + 1]
                    if a == b:
                        continue
                    rows["shard"].append(k)
                    rows["contexts"].append(g.context[a:b].tobytes())
                    rows["counts"].append(g.count[a:b].astype(np.int32).tobytes())
                    rows["fan"].append(kinds[a:b].astype(np.int32).tobytes())
                    rows["successors"].append(_five(g.successor[x:y]))
                    rows["pairs"].append(g.pair_count[x:y].astype(np.int32).tobytes())
                n = len(rows["shard"])
                kinds_of = {"shard": pa.int32()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.column("block")[0].as_py()] * n, pa.int64()), pa.array([seq] * n, pa.int32()), *(pa.array(v, kinds_of.get(c, pa.binary())) for c, v in rows.items())],
                    names=["block", "seq", *rows],
                )

    return run


def _answers(shards: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        read = lambda c, kind: [np.frombuffer(x.as_py(), kind) for x in table.column(c)]
        contexts, counts, fans, pairs = read("contexts", np.uint64), read("counts", np.int32), read("fan", np.int32), read("pairs", np.int32)
        successors = [_from_five(x.as_py()) for x in table.column("successors")]
        every = np.concatenate(contexts)
        context, place = np.unique(every, return_inverse=True)
        count = np.bincount(place, weights=np.concatenate(counts), minlength=len(context)).astype(np.int64)
        owner = np.repeat(place, np.concatenate(fans))
        successor, pair = np.concatenate(successors), np.concatenate(pairs).astype(np.int64)
        learnt = pair > 0
        order = np.lexsort((successor[learnt], owner[learnt]))
        o, s, c = owner[learnt][order], successor[learnt][order], pair[learnt][order]
        new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (s[1:] != s[:-1])]) if len(o) else np.zeros(0, np.int64)
        o, s, c = o[new], s[new], np.add.reduceat(c, new) if len(new) else c
        # contexts that training has not seen are not in the trie
        seen = count > 0
        seen[o] = True
        base, width = (shard << 64) // shards, (1 << 64) // shards + 1
        trie = Trie(context[seen], count[seen], (np.cumsum(seen) - 1)[o], s, c, base, width)
        out: dict[str, list] = {n: [] for n in ("count", "back", "share")}
        for ctx, fan, suc in zip(contexts, fans, successors, strict=True):
            n, back, share = trie.look_up(ctx, np.repeat(np.arange(len(ctx)), fan), suc)
            out["count"].append(n.astype(np.int64).tobytes())
            out["back"].append(back.tobytes())
            out["share"].append(share.tobytes())
        rows = table.num_rows
        return pa.table(
            {
                "block": table.column("block"),
                "seq": table.column("seq"),
                "shard": pa.array([shard] * rows, pa.int32()),
                **{n: pa.array(v, pa.binary()) for n, v in out.items()},
                # once per shard: its known words and training tokens
                "words": pa.array([int((count > 0).sum())] + [0] * (rows - 1), pa.int64()),
                "tokens": pa.array([int(count.sum())] + [0] * (rows - 1), pa.int64()),
            }
        )

    return run


def _scored(text: str, words: int, tokens: int, keep: list[str], types: list):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = _one(texts.sort_by("rid").to_batches())
        answers = answers.sort_by([("seq", "ascending"), ("shard", "ascending")])
        of_seq = answers.column("seq").to_numpy()
        parts = []
        for seq, part in enumerate(arrays.slices(block, text)):
            g = Grams(part.column(text), np.zeros(part.num_rows, bool))
            mine = answers.slice(int(np.searchsorted(of_seq, seq)), int((of_seq == seq).sum()))
            read = lambda c, kind: np.frombuffer(b"".join(x.as_py() for x in mine.column(c)), kind)  # noqa: B023, E731
            count, back, share = read("count", np.int64), restored(read("back", np.uint8)), restored(read("share", np.uint8))
            p = (count + 0.5) / (tokens + 0.5 * (words + 1))
            each = p[g.token_of]
            ngram = share[g.pair_of] + back[g.pair_context[g.pair_of]] * each
            total = lambda x: np.bincount(g.row, weights=x, minlength=part.num_rows)  # noqa: B023, E731
            added = [
                pa.array(g.size, pa.int64()),
                pa.array(total((count > 0)[g.token_of]).astype(np.int64)),
                pa.array(total(np.log10(each))),
                pa.array(total(np.log10(np.minimum(ngram, 1.0)))),
            ]
            parts.append(pa.Table.from_arrays([*(part.column(n) for n in keep), *added], names=[*keep, "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(parts)

    return run


def score(docs: DataFrame, trains: Column, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shard_bytes: int = SHARD_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``keep``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row; rows where ``trains`` is true are learnt."""
    ship_package(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    named = docs.select(*keep, text, F.coalesce(trains, F.lit(False)).alias("trains"), F.monotonically_increasing_id().alias("rid"))
    named = named.withColumn("block", F.floor(F.col("rid") / F.lit(block_rows)).cast("bigint"))
    messages = named.select(text, "trains", "block").mapInArrow(
        _messages(shards, text), "block bigint, seq int, shard int, contexts binary, counts binary, fan binary, successors binary, pairs binary"
    )
    answers = store(
        messages.groupBy("shard").applyInArrow(_answers(shards), "block bigint, seq int, shard int, count binary, back binary, share binary, words bigint, tokens bigint"),
        "answers",
    )
    sums = answers.agg(F.sum("words"), F.sum("tokens")).first()
    words, tokens = sums[0] or 0, sums[1] or 0
    fields = [f for f in named.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = named.select(*keep, text, "rid", "block").groupBy("block").cogroup(answers.groupBy("block"))
    found = rows.applyInArrow(_scored(text, words, tokens, list(keep), fields), f"{schema}, n_tokens bigint, n_known bigint, base_score double, score double")
    return found.select(*keep, "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def op8_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = score(docs.withColumn("held_out", held_out()), ~held_out(), keep=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
