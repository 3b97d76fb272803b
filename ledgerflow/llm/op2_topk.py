"""Exact top-k by inner product: candidates by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors are ``floor(64 x)``. All are rotated by the right singular vectors of the whole table (from the sum of
outer products, dimension x dimension numbers), so the first coordinates hold most of every inner product. Candidates are
range-partitioned by length, longest first, into chunks of about ``CHUNK_ROWS``. Each query gets a first threshold, its k-th best score among the
``SEEDS`` longest vectors; lengths bound scores, so it is only sent to the chunks whose longest vector can still reach that, and a chunk only to the
query blocks with a query that reaches it. A query block and a chunk meet in one task, in products of ``SIDE`` queries and ``BLOCK`` candidates: the partial
sums of ``HEAD`` and then ``2 HEAD`` coordinates, with the product of the remaining lengths as bound, drop pairs before the exact integer score is taken. The threshold only drops what cannot be among the k best, so results are exact.
Where the product of two lengths reaches 2^52, 64-bit floats may round: there the score is only a bound, and what is left is scored in Python integers.

Query set against all rows in blocks: the work is queries x candidates by nature, each block pair is bounded.

Rules: vectors that are null, or hold null, NaN or infinite components, take no part; all others do, however long. A listed score beyond a bigint, or
lengths beyond a 64-bit float, raise an error, as the SQL does;
shorter vectors are padded with zeros; repeated rows are candidates of each other (a query leaves out its own row only); equal scores go by
smaller ``vec_id``, a null id last. A table without vectors or queries gives no rows. Other columns of the table are not read, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.llm.frames import with_arrow
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import store

K = 20
SEEDS = 2048
HEAD = 16
CHUNK_ROWS = 8192
MAX_CHUNKS = 1 << 16
QUERY_BLOCK = 2048
#: Candidates and queries that meet in one product: 8 MB a matrix.
BLOCK = 2048
SIDE = 512
#: Products of lengths below this keep every partial sum exact in a 64-bit float.
_EXACT = float(1 << 52)


def prepared(table: DataFrame, vector: str, ids: str, is_query: Column) -> DataFrame:
    """``rid``, ``id``, ``q`` (a query?), ``v`` (integers, held as doubles) and ``norm2`` of the vectors that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    # from 2^53 on a double is a whole number, which may not fit floor's bigint
    whole = lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)
    v = F.transform(x, lambda c: whole(c.cast("double") * 64))
    asks = F.coalesce(is_query, F.lit(False)).alias("q")
    rows = table.select(F.monotonically_increasing_id().alias("rid"), F.col(ids).alias("id"), asks, F.when(x.isNotNull() & finite, v).alias("v"))
    return rows.where(F.col("v").isNotNull()).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of integers, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), size), np.float64)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _rotation(rows: DataFrame, size: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column("v").slice(at, 4096), size)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(size * size), pa.int32()), pa.array(total.ravel())], names=["at", "x"])

    sums = rows.select("v").mapInArrow(products, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(size * size)
    for r in sums:
        gram[r["at"]] = r.x
    gram = gram.reshape(size, size)
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


class Candidates:
    """Vectors by descending length with the rotated coordinates and what is left of their lengths."""

    def __init__(self, rid: np.ndarray, ids: list, v: np.ndarray, rotation: np.ndarray):
        order = np.argsort(-(v * v).sum(1), kind="stable")
        self.rid, self.v = rid[order], v[order]
        self.ids = [ids[i] for i in order.tolist()]
        self.length = np.sqrt((self.v * self.v).sum(1))
        self.turned = self.v @ rotation
        self.rests = _rests(self.turned)


def _rests(turned: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Length of what the first coordinates leave out, for each stage."""
    size = turned.shape[1]
    return [(h, np.sqrt(np.maximum((turned[:, h:] ** 2).sum(1), 0))) for h in (HEAD, 2 * HEAD) if h < size]


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Inner products as Python integers."""
    lengths = np.sqrt((vectors * vectors).sum(1)) * math.sqrt(float(query @ query))
    rough = vectors @ query
    q = [int(x) for x in query.tolist()]
    return [int(s) if n < _EXACT else sum(a * int(b) for a, b in zip(q, v.tolist(), strict=True)) for s, n, v in zip(rough.tolist(), lengths.tolist(), vectors, strict=True)]


def best(queries: np.ndarray, own: np.ndarray, least: np.ndarray, rotation: np.ndarray, c: Candidates, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (row of ``queries``, place in ``c``) that may be among the k best of a query, its last threshold, and how many pairs got a full score.

    Blocks of candidates meet all queries that they can still reach. Each stage is one product of the coordinates it adds, over the rows and columns that
    still have a pair alive. Ties, and what rounding can't tell apart, are kept whole. Below ``_EXACT`` a score is exact, above it has a margin.
    """
    least = least.copy()
    turned = queries @ rotation
    length = np.sqrt((queries * queries).sum(1))
    rests = dict(_rests(turned))
    tops = np.full((len(queries), k), -math.inf)
    asks, places, highs, scored = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], 0
    for at in range(0, len(c.rid), BLOCK):
        block = slice(at, min(len(c.rid), at + BLOCK))
        # those that follow are shorter: a query that is out of reach stays so
        rows = np.flatnonzero(~(length * c.length[at] * (1 + 1e-9) + 1e-6 < least))
        if not len(rows):
            break
        cols = np.arange(block.start, block.stop)
        alive = c.rid[cols][None, :] != own[rows][:, None]
        part, start = np.zeros(alive.shape), 0
        for h, left in c.rests:
            part += turned[rows, start:h] @ c.turned[cols, start:h].T
            bound = part + rests[h][rows][:, None] * left[cols][None, :] + (1e-9 * length[rows][:, None] * c.length[cols][None, :] + 1e-6)
            alive &= ~(bound < least[rows][:, None])
            some, of = alive.any(1), alive.any(0)
            rows, cols, start = rows[some], cols[of], h
            alive, part = alive[np.ix_(some, of)], part[np.ix_(some, of)]
        if not alive.size:
            continue
        scored += int(alive.sum())
        score = queries[rows] @ c.v[cols].T
        reach = length[rows][:, None] * c.length[cols][None, :]
        error = np.where(reach * (1 + 1e-9) < _EXACT, 0.0, 1e-9 * reach) if reach.max() * (1 + 1e-9) >= _EXACT else 0.0
        known = np.concatenate([tops[rows], np.where(alive, score - error, -math.inf)], axis=1)
        tops[rows] = np.partition(known, known.shape[1] - k, axis=1)[:, known.shape[1] - k :]
        least[rows] = np.maximum(least[rows], tops[rows].min(1))
        high = score + error
        i, j = np.nonzero(alive & (high >= least[rows][:, None]))
        asks.append(rows[i])
        places.append(cols[j])
        highs.append(high[i, j])
    ask, place = np.concatenate(asks), np.concatenate(places)
    keep = np.concatenate(highs) >= least[ask]
    return ask[keep], place[keep], least, scored


def top_k(table: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", ids: str = "vec_id", chunk_rows: int = CHUNK_ROWS, seeds: int = SEEDS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the candidate's id as ``ids``, ``score``; ``is_query`` is a condition on ``table``."""
    spark = table.sparkSession
    ship_package(spark)
    base = store(prepared(table, vector, ids, is_query), "vectors")
    figures = base.agg(F.count("*"), F.max(F.size("v")), F.max("norm2")).first()
    if figures[2] is not None and not math.isfinite(figures[2]):
        raise ValueError("the length of a vector is beyond a 64-bit float")
    count, size = figures[0], figures[1] or 1
    id_type = dict(table.dtypes)[ids]
    schema = f"query_rid bigint, query_id {id_type}, rid bigint, id {id_type}, score bigint"
    rotation = _rotation(base, max(size, 1))
    chunks = max(1, min(MAX_CHUNKS, math.ceil(count / chunk_rows)))
    ranged = base.repartitionByRange(chunks, F.desc("norm2"), F.col("rid")).withColumn("chunk", F.spark_partition_id())
    rows = store(ranged, "chunks")
    longest = rows.sort(F.desc("norm2"), "rid").limit(seeds).toArrow()
    seed = Candidates(longest.column("rid").to_numpy(), longest.column("id").to_pylist(), _matrix(longest.column("v"), size), rotation)
    # one number per chunk: at most MAX_CHUNKS
    tops = rows.groupBy("chunk").agg(F.sqrt(F.max("norm2").cast("double")).alias("top")).sort("chunk").collect()
    names, reach = [r.chunk for r in tops], np.array([r.top for r in tops])
    held = spark.sparkContext.broadcast((seed, rotation, names, reach))

    def routed(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        first, turn, chunk_names, top = held.value
        for at in range(0, batch.num_rows, SIDE):
            some = batch.slice(at, SIDE)
            vectors = _matrix(some.column("v"), size)
            _, _, least, _ = best(vectors, some.column("rid").to_numpy(), np.full(len(vectors), -math.inf), turn, first, k)
            length = np.sqrt((vectors * vectors).sum(1))
            # chunks hold ever shorter vectors: a query reaches a prefix of them
            near = (~(length[:, None] * top[None, :] * (1 + 1e-9) + 1e-6 < least[:, None])).sum(1)
            last = np.where(near > 0, np.array(chunk_names)[near - 1], -1)
            yield some, {"least": pa.array(least, pa.float64()), "last": pa.array(last, pa.int32())}

    # Queries of like reach (the same power of two of chunks) share a block, and a chunk goes only to the blocks that have a query which reaches it.
    asked = with_arrow(rows.where("q").select("rid", "id", "v"), routed, "least double, last int").where(F.col("last") >= 0)
    asked = store(asked.withColumn("level", F.floor(F.log2(F.col("last") + 1)).cast("int")), "queries")
    # at most one number for each power of two up to MAX_CHUNKS
    level_sizes = {r.level: r["count"] for r in asked.groupBy("level").count().collect()}
    blocks = F.lit(1)
    for level, queries in level_sizes.items():
        blocks = F.when(F.col("level") == level, math.ceil(queries / query_block)).otherwise(blocks)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("rid"), blocks) * 32 + F.col("level"))
    chunks_upto = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("chunk")
    wanted = asked.groupBy("part").agg(F.max("last").alias("last")).select(F.col("part").alias("part"), chunks_upto)
    against = rows.select("rid", "id", "v", "chunk").join(wanted, "chunk")
    asked = asked.select("rid", "id", "v", "least", "part", chunks_upto)

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        turn = held.value[1]
        out: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            c = Candidates(right.column("rid").to_numpy(), right.column("id").to_pylist(), _matrix(right.column("v"), size), turn)
            for at in range(0, left.num_rows, SIDE):
                some = left.slice(at, SIDE)
                vectors = _matrix(some.column("v"), size)
                rids, names = some.column("rid").to_numpy(), some.column("id").to_pylist()
                ask, place, _, _ = best(vectors, rids, some.column("least").to_numpy(), turn, c, k)
                by = np.argsort(ask, kind="stable")
                ends = np.searchsorted(ask[by], np.arange(len(vectors) + 1))
                for i in np.unique(ask).tolist():
                    here = place[by[ends[i] : ends[i + 1]]]
                    score = exact_scores(vectors[i], c.v[here])
                    # ties at the border are cut by id; a null id comes last
                    order = sorted(range(len(here)), key=lambda j: (-score[j], c.ids[here[j]] is None, c.ids[here[j]] or 0))[:k]
                    out[0] += [int(rids[i])] * len(order)
                    out[1] += [names[i]] * len(order)
                    out[2] += [int(c.rid[here[j]]) for j in order]
                    out[3] += [c.ids[here[j]] for j in order]
                    out[4] += [score[j] for j in order]
        kind = left.schema.field("id").type
        return pa.table([pa.array(v, t) for v, t in zip(out, [pa.int64(), kind, pa.int64(), kind, pa.int64()], strict=True)], names=["query_rid", "query_id", "rid", "id", "score"])

    found = asked.groupBy("chunk", "part").cogroup(against.groupBy("chunk", "part")).applyInArrow(meet, schema)
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(ids), "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


ORACLE_SQL = """
WITH cells AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE embedding IS NOT NULL
), good AS (
    SELECT vec_id FROM cells GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), v AS (
    SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM cells WHERE vec_id IN (SELECT vec_id FROM good)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.i = c.i AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) AS ranked
WHERE rank <= 20
"""
