"""URL filter: ratio of two variable-order Markov models, one of accepted and one of rejected URLs.

The URLs that a rule decides are the labelled rows. Of them at most ``FIT_ROWS`` per class, chosen by hash, are
learned from (4 of 5) or calibrate (1 of 5). A model gives each byte the Witten-Bell mixture over contexts of 4, 3, 2, 1 and 0
bytes, down to even odds; contexts that were not seen fall through, which makes the order vary. The score of a URL
is the difference of its two log-likelihoods divided by its number of bytes; the cut is the one with the
highest balanced accuracy on the calibration rows. A URL at or above the cut is allowed.

The n-gram table has at most 2 * FIT_ROWS * (bytes of a URL) * 5 entries whatever the input; scoring is one narrow pass over all rows.

Rules: a null URL, or one without ``://``, has empty host and path and fits no rule; an empty URL scores 0; with no rows of
one class there is no model and the verdict is allow; equal URLs get equal verdicts, and a repeated row stays repeated; a URL of any length is scored whole;
an empty table gives an empty result. Columns of the table named host, path, rule, ratio or verdict are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.frames import with_arrow
from ledgerflow.shipping import ship_package

#: Rule (host and path) and verdict.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
FIT_ROWS = 50_000
ORDER = 4
_START = 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte and each order 0..4 the packed context and gram, and each byte's row."""
    data, offsets = arrays.text_bytes(column)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(data)) - offsets[row]
    grams = np.zeros((ORDER + 1, len(data)), np.uint64)
    context = np.zeros((ORDER + 1, len(data)), np.uint64)
    byte = data.astype(np.uint64)
    for k in range(1, ORDER + 1):
        earlier = np.full(len(data), _START, np.uint64)
        if len(data) > k:
            earlier[k:] = np.where(place[k:] >= k, byte[:-k], np.uint64(_START)) if k else byte
        context[k] = context[k - 1] | earlier << np.uint64(8 * k)
    for k in range(ORDER + 1):
        tag = np.uint64(k + 1) << np.uint64(56)
        grams[k] = context[k] | byte | tag
        context[k] |= tag
    return context, grams, row


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in arrays.slices(batch, "url"):
            _, grams, row = _grams(part.column("url"))
            accepted = part.column("accepted").to_numpy(zero_copy_only=False).astype(bool)[row]
            for yes in (True, False):
                keys, n = np.unique(grams[:, accepted == yes], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), yes)), pa.array(n, pa.int64())], names=["gram", "accepted", "n"]
                )


class Ratio:
    """Sorted n-grams and contexts with counts per class; ``cut`` is set by calibration."""

    def __init__(self, gram: np.ndarray, yes: np.ndarray, no: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.n = gram[order], np.stack([yes[order], no[order]]).astype(np.float64)
        at = np.concatenate([[0], np.flatnonzero(np.diff(self.gram >> np.uint64(8))) + 1]) if len(gram) else np.zeros(0, np.int64)
        self.context = self.gram[at] & ~np.uint64(0xFF)
        self.total = np.add.reduceat(self.n, at, axis=1) if len(gram) else self.n
        self.kinds = np.add.reduceat((self.n > 0).astype(np.float64), at, axis=1) if len(gram) else self.n
        self.cut = 0.0

    @staticmethod
    def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def score(self, column: pa.Array) -> np.ndarray:
        """(log P of the accepted model - log P of the rejected one) / bytes."""
        context, grams, row = _grams(column)
        p = np.full((2, len(row)), 1 / 256)
        for k in range(ORDER + 1 if len(self.gram) else 0):
            c, has = self._found(self.context, context[k])
            g, seen = self._found(self.gram, grams[k])
            total, kinds = self.total[:, c] * has, self.kinds[:, c] * has
            mass = total + kinds
            p = np.where(mass > 0, (self.n[:, g] * seen + kinds * p) / np.where(mass > 0, mass, 1), p)
        size = np.bincount(row, minlength=len(column))
        return np.bincount(row, weights=np.log(p[0]) - np.log(p[1]), minlength=len(column)) / np.maximum(size, 1)


def fit(pages: DataFrame, url: str = "url", rule: str = "rule", rules: dict[str, str] = RULES, fit_rows: int = FIT_ROWS) -> Ratio | None:
    """Learn and calibrate; None when a class has no rows."""
    known = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    labelled = pages.where(F.col(rule).isNotNull() & (F.length(url) > 0)).select(
        F.col(url).alias("url"), (known[F.col(rule)] == "allow").alias("accepted"), F.pmod(F.xxhash64(url), F.lit(1_000_000)).alias("h")
    )
    sizes = {r.accepted: r["count"] for r in labelled.groupBy("accepted").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("accepted"), min(1.0, fit_rows / sizes[True])).otherwise(min(1.0, fit_rows / sizes[False]))
    chosen = labelled.where(F.col("h") < share * 1_000_000)
    ship_package(pages.sparkSession)
    calibrates = F.col("h") % 5 == 0
    rows = (
        chosen.where(~calibrates)
        .mapInArrow(_counts, "gram bigint, accepted boolean, n bigint")
        .groupBy("gram")
        .agg(F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("no"))
        .toArrow()
    )
    column = lambda n: rows.column(n).to_numpy()
    model = Ratio(column("gram").astype(np.int64).view(np.uint64), column("yes"), column("no"))
    binned = F.floor(F.col("ratio") * 100).cast("int")
    scored = with_ratio(chosen.where(calibrates), model).groupBy(binned.alias("bin"), "accepted").count().collect()
    model.cut = _cut({(r.bin, r.accepted): r["count"] for r in scored})
    return model


def _cut(counts: dict[tuple[int, bool], int]) -> float:
    """The border with the highest balanced accuracy; ties go to the border nearest to 0."""
    yes, no = (sum(n for (_, a), n in counts.items() if a == c) for c in (True, False))
    if not yes or not no:
        return 0.0
    best = (-1.0, 0, 0)
    for border in sorted({b + d for b, _ in counts for d in (0, 1)} | {0}):
        right = sum(n for (b, a), n in counts.items() if a and b >= border) / yes + sum(n for (b, a), n in counts.items() if not a and b < border) / no
        best = max(best, (round(right, 12), -abs(border), border))
    return best[2] / 100


def with_ratio(pages: DataFrame, model: Ratio, url: str = "url") -> DataFrame:
    """Add ``ratio``."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        for part in arrays.slices(batch, url, 512 << 10):
            yield part, {"ratio": pa.array(held.value.score(part.column(url)), pa.float64())}

    return with_arrow(pages, added, "ratio double")


def judge(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``ratio`` (null without a model) and ``verdict``."""
    host, path = host_and_path(F.col(url))
    ruled = pages.withColumns({"host": host, "path": path})
    ruled = ruled.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    model = fit(ruled, url, "rule", rules, fit_rows)
    if model is None:
        scored, own = ruled.withColumn("ratio", F.lit(None).cast("double")), F.lit("allow")
    else:
        scored, own = with_ratio(ruled, model, url), F.when(F.col("ratio") >= model.cut, "allow").otherwise("block")
    known = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    return scored.withColumn("verdict", F.coalesce(known[F.col("rule")], own))


def op6_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", F.round("ratio", 9).alias("ratio"))
