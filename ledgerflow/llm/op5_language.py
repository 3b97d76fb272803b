"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1, made from its code point. A letter trigram is bound
as ``roll(a, 2) * roll(b, 1) * c``; a text is the bundle (sum) of its trigrams. Runs of other characters
count as one space, letters are lower-cased one by one. A language's prototype bundles all its training
texts, each with the same weight, so that a very long one does not stand for its language; a text takes the language of the prototype with the highest cosine (ties: first label in order).

The prototypes are integer sums over all training rows, so they do not depend on partitioning; they are
labels x 1024 numbers, which is what the driver and the tasks hold.

Rules: a null text, or one without letters, or no training rows at all, gives ``und`` and score 0; rows without a label are
predicted but not learned from; repeated rows count each time. The score is the cosine, cut to 0..1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import documents, with_arrow
from ledgerflow.shipping import ship_package

DIMENSIONS = 1024
UNKNOWN = "und"
PART_BYTES = 256 << 10
BLOCK = 4096
#: Whole-number weight of a training text; a trigram weighs this divided by the text's trigrams, rounded.
TEXT_WEIGHT = 1 << 24
#: A text must resemble a language by this many deviations of unrelated vectors (1 / sqrt(DIMENSIONS) each) once it has SURE
#: effective trigrams; up to DOUBT it need not, as few trigrams of a language can lie as low as noise; between them the limit rises evenly.
#: Measured on the sf0.01 documents: texts of a learnt language with 100 effective trigrams or more score 0.54 or more, those of
#: a language left out of training 0.26 or less (19 of 20), random letters 0.20 or less.
DEVIATIONS = 10.0
DOUBT, SURE = 10, 110


def least_score(effective: Column, deviations: float = DEVIATIONS) -> Column:
    """The score that a text must exceed, by its effective trigrams: (sum of counts)^2 / sum of counts^2, so repeating a word adds none."""
    rise = F.least(F.greatest((effective - DOUBT) / (SURE - DOUBT), F.lit(0.0)), F.lit(1.0))
    return deviations / DIMENSIONS**0.5 * rise


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for all other characters."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _vectors(points: np.ndarray) -> np.ndarray:
    """The random vector of each code point: 1024 hash bits as +1 and -1."""
    words = DIMENSIONS // 64
    seed = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    bits = np.unpackbits(arrays.mix(arrays.mix(seed + np.uint64(0x5851F42D))).view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1).reshape(len(points), DIMENSIONS)


def _trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams as three code points, each occurrence's trigram and row, and whether a row has letters."""
    data, offsets = arrays.text_bytes(column)
    heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    places = heads[offsets]
    letters = _letters()[points]
    size = np.diff(places)
    rows = len(size)
    has = np.bincount(np.repeat(np.arange(rows), size)[letters != 0], minlength=rows) > 0
    # one space before and one after each text
    x = np.insert(letters, np.r_[places[:-1], places[1:]], 0)
    row = np.repeat(np.arange(rows), size + 2)
    keep = (x != 0) | np.r_[True, (x[:-1] != 0) | (row[1:] != row[:-1])][: len(x)]
    x, row = x[keep], row[keep]
    ok = np.flatnonzero(row[2:] == row[:-2]) if len(x) > 2 else np.zeros(0, np.int64)
    seen = np.zeros(0x110000, bool)
    seen[x] = True
    alphabet = np.flatnonzero(seen)
    small = np.zeros(0x110000, np.int64)
    small[alphabet] = np.arange(len(alphabet))
    k = len(alphabet)
    y = small[x]
    code = (y[ok] * k + y[ok + 1]) * k + y[ok + 2]
    if k**3 <= 1 << 22:
        used = np.zeros(k**3, bool)
        used[code] = True
        distinct = np.flatnonzero(used)
        number = np.zeros(k**3, np.int64)
        number[distinct] = np.arange(len(distinct))
        which = number[code]
    else:
        distinct, which = np.unique(code, return_inverse=True)
    parts = alphabet[np.stack([distinct // (k * k), distinct // k % k, distinct % k], 1)] if len(distinct) else np.zeros((0, 3), np.int64)
    return parts, which, row[ok], has


def _bound(parts: np.ndarray) -> np.ndarray:
    """Vectors of trigrams."""
    points, place = np.unique(parts, return_inverse=True)
    base = _vectors(points)
    place = place.reshape(parts.shape)
    return np.roll(base, 2, 1)[place[:, 0]] * np.roll(base, 1, 1)[place[:, 1]] * base[place[:, 2]]


def _bundles(parts: np.ndarray, counts: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """``counts`` (rows x trigrams) times the trigrams' vectors, some trigrams at a time."""
    out = np.zeros((len(counts), DIMENSIONS))
    for at in range(0, len(parts), BLOCK):
        out += counts[:, at : at + BLOCK].astype(kind) @ _bound(parts[at : at + BLOCK]).astype(kind)
    return out


def prototypes(train: DataFrame, text: str = "text", label: str = "lang") -> tuple[list[str], np.ndarray]:
    """Labels in order, and their bundles scaled to length 1. Rows without a label are left out."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in arrays.slices(batch, text, PART_BYTES):
                parts, which, row, _ = _trigrams(part.column(text))
                names, of = np.unique(part.column(label).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                # each text weighs the same, however long; whole-number weights keep the sums exact
                share = np.rint(TEXT_WEIGHT / np.maximum(np.bincount(row, minlength=part.num_rows), 1))
                counts = np.bincount(of[row] * len(parts) + which, weights=share[row], minlength=len(names) * len(parts)).reshape(len(names), len(parts))
                for name, total in zip(names.tolist(), _bundles(parts, counts, np.float64), strict=True):
                    held[name] = held.get(name, 0) + np.rint(total).astype(np.int64)
        if held:
            names = sorted(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(names, DIMENSIONS), pa.string()),
                    pa.array(np.tile(np.arange(DIMENSIONS), len(names)), pa.int32()),
                    pa.array(np.concatenate([held[n] for n in names]), pa.int64()),
                ],
                names=["label", "place", "total"],
            )

    ship_package(train.sparkSession)
    labelled = train.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(text, F.col(label).cast("string").alias(label))
    rows = (
        labelled.mapInArrow(sums, "label string, place int, total bigint")
        .groupBy("label", "place")
        .agg(F.sum("total").alias("total"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("place", "total"))).alias("v"))
        .sort("label")
        .collect()
    )
    found = np.array([[x.total for x in r.v] for r in rows], np.float64).reshape(len(rows), DIMENSIONS)
    length = np.linalg.norm(found, axis=1, keepdims=True)
    return [r.label for r in rows], found / np.where(length == 0, 1, length)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", effective: str | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score`` and, as ``effective`` if named, the effective trigrams; only the text is looked at."""
    labels, proto = model

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        for part in arrays.slices(batch, text, PART_BYTES):
            parts, which, row, has = _trigrams(part.column(text))
            n = part.num_rows
            best, score, even = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            if labels and len(parts):
                for at in range(0, n, 256):
                    mine = (row >= at) & (row < at + 256)
                    m = min(256, n - at)
                    counts = np.bincount((row[mine] - at) * len(parts) + which[mine], minlength=m * len(parts)).reshape(m, len(parts))
                    even[at : at + m] = counts.sum(1) ** 2 / np.maximum((counts.astype(np.float64) ** 2).sum(1), 1)
                    bundle = _bundles(parts, counts)
                    length = np.linalg.norm(bundle, axis=1)
                    cosine = np.round(bundle @ proto.T / np.where(length == 0, 1, length)[:, None], 9)
                    best[at : at + m] = cosine.argmax(1)
                    score[at : at + m] = cosine.max(1)
            known = has & bool(labels)
            names = [labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            values = {
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.where(known, np.clip(score, 0, 1), 0.0), pa.float64()),
            }
            yield part, values | ({effective: pa.array(even, pa.float64())} if effective else {})

    return with_arrow(docs, added, "lang_pred string, score double" + (f", `{effective}` double" if effective else ""))


def held_out(doc_id: str = "doc_id") -> Column:
    """A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, train: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """Drop documents without letters or unlike every known language (``least_score``); own columns only."""
    model = prototypes(train)
    found = predict(docs.select(F.struct(*docs.columns).alias("__row"), "text"), model, effective="effective")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > least_score(F.col("effective"), deviations))).select("__row.*")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = prototypes(docs.where(~held_out()))
    found = predict(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
