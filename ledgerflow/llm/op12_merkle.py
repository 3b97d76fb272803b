"""Merkle manifest of a dataset: subtrees stored in van Emde Boas order, their roots hashed again.

A tree has eight children a node. It is cut into *blocks*: aligned subtrees of ``HEIGHT`` levels of children, each one
binary value that holds its nodes' digests (32 bytes each) in van Emde Boas order: the upper half of the levels first,
then the lower subtrees from left to right, each laid out the same way. :func:`layout` computes the places from level
and position alone, so building, reading a node and fetching a path's siblings are address arithmetic over few
contiguous ranges. The roots of a level of blocks are the leaves of the next level of blocks, until one block holds a
tree's root; the trees' roots (one per key) are the leaves of the top tree, built by the same code.

Leaves are ranked by range partitions (:mod:`ledgerflow.operators.ordered`), so a tree may hold any share of the rows;
a block is one small group of at most 8**HEIGHT digests, whatever the data. A proof is the list of the sibling digests
from a leaf to the root. The part above a block is the same for all its leaves and is joined to the block's row, so the
leaves' proofs are put together and folded where their block is read, and never moved.

Rules: a null value hashes as ``-``; leaves of a tree ascend by id, null ids first, equal ids by leaf digest; repeated
rows are leaves of their own; the null key is a tree; a tree of one leaf has this leaf as its root; an empty table
has no tree. A row with a null id is never tampered with. Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.functions.keyed import attach_stats, join_series
from ledgerflow.llm.frames import documents
from ledgerflow.operators.ordered import running_totals
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import store

ARITY = 8
HEIGHT = 4
DIGEST = 32
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and itself, or ``-`` if null."""
    spelled = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*spelled), 256)


@lru_cache
def layout(height: int = HEIGHT) -> tuple[np.ndarray, ...]:
    """Places of a full subtree's nodes: one array per level, root first, by position.

    A tree of ``n`` levels of nodes is the upper ``n // 2`` levels followed by the subtrees below them.
    """

    def placed(levels: int) -> list[np.ndarray]:
        if levels == 1:
            return [np.zeros(1, np.int64)]
        top = placed(levels // 2)
        low = placed(levels - levels // 2)
        first, each = sum(len(x) for x in top), sum(len(x) for x in low)
        below = first + each * np.arange(len(top[-1]) * ARITY)
        return top + [(below[:, None] + x[None, :]).reshape(-1) for x in low]

    return tuple(placed(height + 1))


def nodes_in(height: int = HEIGHT) -> int:
    return sum(len(x) for x in layout(height))


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def build_block(leaves: list[bytes], alone: bool, height: int = HEIGHT) -> tuple[bytes, bytes, int]:
    """A block's bytes, its root digest and the number of levels hashed.

    A block that holds its whole tree (``alone``) is hashed until one node remains; any other over its full height.
    """
    places = layout(height)
    block = np.zeros((nodes_in(height), DIGEST), np.uint8)
    nodes, level = leaves, height

    def put() -> None:
        block[places[level][: len(nodes)]] = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, DIGEST)

    put()
    while level and not (alone and len(nodes) == 1):
        nodes = [sha256(b"".join(nodes[i : i + ARITY]).hex().encode()).digest() for i in range(0, len(nodes), ARITY)]
        level -= 1
        put()
    return block.tobytes(), nodes[0], height - level


def block_runs(block: bytes, leaves: int, hashed: int, height: int = HEIGHT) -> list[list[str]]:
    """For each hashed level, leaves first, the runs of siblings as hex text; read by address from the block."""
    places = layout(height)
    nodes = np.frombuffer(block, np.uint8).reshape(-1, DIGEST)
    out, count = [], leaves
    for level in range(height, height - hashed, -1):
        text = nodes[places[level][:count]].tobytes().hex()
        width = 2 * DIGEST * ARITY
        out.append([text[i : i + width] for i in range(0, len(text), width)])
        count = -(-count // ARITY)
    return out


def proof(runs: list[list[str]], position: int) -> tuple[str, list[int]]:
    """A leaf's siblings up to the block's root, as hex text, and a step per level: place in the run * 16 + its size."""
    wide = 2 * DIGEST
    siblings, steps = [], []
    for level in runs:
        run, place = level[position // ARITY], position % ARITY
        siblings.append(run[: place * wide] + run[(place + 1) * wide :])
        steps.append(place * 16 + len(run) // wide)
        position //= ARITY
    return "".join(siblings), steps


def fold(leaf: str, siblings: str, steps: list[int]) -> str:
    """The root that follows from a leaf and its siblings."""
    wide = 2 * DIGEST
    at = 0
    for step in steps:
        place, size = divmod(step, 16)
        end, cut = at + (size - 1) * wide, at + place * wide
        leaf = _hash(siblings[at:cut] + leaf + siblings[cut:end])
        at = end
    return leaf


def _ddl(fields) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)


def _level(nodes: DataFrame, keys: Sequence[str], height: int) -> DataFrame:
    """Blocks over ``nodes`` (keys, place, digest, n, item): keys, block, n, data, leaves, hashed, root, items.

    ``item`` is a struct that stays with its leaf, in the leaves' order.
    """
    ship_package(nodes.sparkSession)
    size = ARITY**height
    grouped = nodes.groupBy(*keys, F.expr(f"place div {size}").alias("block"))
    gathered = grouped.agg(F.sort_array(F.collect_list(F.struct("place", "digest", "item"))).alias("held"), F.first("n").alias("n"))
    flat = gathered.select(*keys, "block", "n", F.col("held.digest").alias("digests"), F.col("held.item").alias("items"))
    kept = [*[flat.schema[k] for k in keys], flat.schema["block"], flat.schema["n"], flat.schema["items"]]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, total = batch.column("digests").to_pylist(), batch.column("n").to_pylist()
            made = [build_block(d, n <= size, height) for d, n in zip(digests, total, strict=True)]
            columns = [batch.column(k) for k in names]
            columns += [pa.array([m[0] for m in made], pa.binary()), pa.array([len(d) for d in digests], pa.int32())]
            columns += [pa.array([m[2] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "data", "leaves", "hashed", "root"])

    return flat.mapInArrow(run, f"{_ddl(kept)}data binary, leaves int, hashed int, root binary")


def build(leaves: DataFrame, keys: Sequence[str] = (), height: int = HEIGHT) -> list[DataFrame]:
    """Stored blocks, one table per level of blocks.

    ``leaves`` has the keys, ``place`` (from 0 in each tree), ``digest`` (binary), ``n`` (the tree's leaves) and ``item``.
    """
    size = ARITY**height
    levels = [store(_level(leaves, keys, height), "merkle_blocks")]
    while True:
        more = levels[-1].where(F.col("n") > size)
        if more.isEmpty():
            return levels
        upper = more.select(*keys, F.col("block").alias("place"), F.col("root").alias("digest"), F.ceil(F.col("n") / size).alias("n"), F.struct(F.lit(0).alias("none")).alias("item"))
        levels.append(store(_level(upper, keys, height), "merkle_blocks"))


def roots(levels: list[DataFrame], keys: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """The keys and ``root`` of each tree."""
    found = [b.where(F.col("n") <= ARITY**height).select(*keys, "root") for b in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def opened(blocks: DataFrame, keys: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """One row per leaf of ``blocks`` (which carry ``above`` and ``above_steps``, the rest of the way up): the keys,
    ``place``, ``item``, ``siblings`` (hex text, level by level, left to right) and ``steps``."""
    ship_package(blocks.sparkSession)
    size = ARITY**height
    item = blocks.schema["items"].dataType.elementType
    kept = [blocks.schema[k] for k in keys]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.select(["block", "data", "leaves", "hashed", "above", "above_steps"]).to_pylist()[0]
                runs = block_runs(row["data"], row["leaves"], row["hashed"], height)
                found = [proof(runs, p) for p in range(row["leaves"])]
                same = pa.array(np.zeros(len(found), np.int64))
                columns = [one.column(k).take(same) for k in names]
                columns += [pa.array(row["block"] * size + np.arange(len(found))), one.column("items").flatten()]
                columns.append(pa.array([s + row["above"] for s, _ in found], pa.string()))
                columns.append(pa.array([t + row["above_steps"] for _, t in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "place", "item", "siblings", "steps"])

    return blocks.mapInArrow(run, f"{_ddl(kept)}place bigint, item {item.simpleString()}, siblings string, steps array<int>")


def with_way_up(levels: list[DataFrame], keys: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """The lowest blocks with ``above`` and ``above_steps``: siblings and steps from a block's root to the tree's."""
    none = {"above": F.lit(""), "above_steps": F.array().cast("array<int>")}
    here = levels[-1].withColumns(none)
    for blocks in reversed(levels[:-1]):
        way = opened(here, keys, height).select(*keys, F.col("place").alias("block"), F.col("siblings").alias("__s"), F.col("steps").alias("__t"))
        here = join_series(blocks, store(way, "merkle_ways"), keys, "left", ["block"])
        here = here.withColumns({"above": F.coalesce("__s", none["above"]), "above_steps": F.coalesce("__t", none["above_steps"])}).drop("__s", "__t")
    return here


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``place`` (from 0) along ``order`` in each tree, and ``n``, the tree's number of leaves."""
    named = rows.withColumn("__read", F.monotonically_increasing_id())
    places = running_totals(named, keys, [*order, "__read"], {"place": F.lit(1).cast("bigint")}).drop("__read")
    numbered = store(places.withColumn("place", F.col("place").cast("bigint") - 1), "merkle_leaves")
    return attach_stats(numbered, store(numbered.groupBy(*keys).agg(F.count("*").alias("n")), "merkle_sizes"), keys)


def manifest(rows: DataFrame, key: str, order: Sequence[str], digest: str, height: int = HEIGHT) -> DataFrame:
    """The lowest blocks of all trees, each with ``subroot``, ``whole`` (the root of all trees) and the way up to it.

    ``rows`` has ``key``, the columns of ``order``, ``digest`` (binary) and any others: all of them become the leaf's ``item``.
    """
    item = F.struct(*[F.col(c) for c in rows.columns if c != key])
    leaves = ranked(rows.select(key, *order, F.col(digest).alias("__digest"), item.alias("item")), [key], [*order, "__digest"])
    levels = build(leaves.select(key, "place", F.col("__digest").alias("digest"), "n", "item"), [key], height)
    subroots = store(roots(levels, [key], height), "merkle_subroots")
    top = ranked(subroots, [], [key])
    top_levels = build(top.select("place", F.col("root").alias("digest"), "n", F.struct(F.col(key).alias("tree"), "root").alias("item")), [], height)
    ends = attach_stats(opened(with_way_up(top_levels, [], height), [], height), store(roots(top_levels, [], height), "merkle_root"), [])
    ends = ends.select(F.col("item.tree").alias(key), F.col("item.root").alias("subroot"), F.col("root").alias("whole"), F.col("siblings").alias("__s"), F.col("steps").alias("__t"))
    lowest = join_series(with_way_up(levels, [key], height), store(ends, "merkle_ends"), [key])
    return lowest.withColumns({"above": F.concat("above", "__s"), "above_steps": F.concat("above_steps", "__t")}).drop("__s", "__t")


def proofs(lowest: DataFrame, keys: Sequence[str], height: int = HEIGHT) -> DataFrame:
    """Each leaf's proof: the keys, ``item``, ``siblings`` and ``steps``."""
    return opened(lowest, keys, height).drop("place")


def folded(lowest: DataFrame, leaf: str, height: int = HEIGHT) -> DataFrame:
    """Each leaf's item, ``subroot``, ``root``, ``proof_sha256`` and ``folded_root``: the root recomputed from the item's
    binary field ``leaf`` and the siblings. Proofs are used where their block is read and never moved."""
    ship_package(lowest.sparkSession)
    item = lowest.schema["items"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.select(["data", "leaves", "hashed", "above", "above_steps", "subroot", "whole"]).to_pylist()[0]
                runs = block_runs(row["data"], row["leaves"], row["hashed"], height)
                items = one.column("items").flatten()
                digests, ends = [], []
                for p, given in enumerate(items.field(items.type.get_field_index(leaf)).to_pylist()):
                    siblings, steps = proof(runs, p)
                    siblings += row["above"]
                    digests.append(_hash(siblings))
                    ends.append(fold(given.hex(), siblings, steps + row["above_steps"]))
                same = [pa.array([row[c].hex()] * len(ends), pa.string()) for c in ("subroot", "whole")]
                columns = [items, *same, pa.array(digests, pa.string()), pa.array(ends, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "subroot", "root", "proof_sha256", "folded_root"])

    return lowest.mapInArrow(run, f"item {item.simpleString()}, subroot string, root string, proof_sha256 string, folded_root string")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    own = [F.col(c) for c in LEAF_COLUMNS]
    changed = [*own[:-1], F.translate("text", CAPITALS, SMALL)]
    leaf = leaf_digest(own)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest(changed)).otherwise(leaf)
    rows = docs.select("doc_id", "lang", F.unhex(leaf).alias("leaf"), F.unhex(tampered).alias("given"))
    proven = folded(manifest(rows, "lang", ["doc_id"], "leaf"), "given")
    return proven.select(
        F.col("item.doc_id").alias("doc_id"),
        F.lower(F.hex("item.leaf")).alias("leaf"),
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Levels of the SQL's trees: enough for 8**9 rows of a language.
_SQL_LEVELS = 9


def _oracle() -> str:
    spelled = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in LEAF_COLUMNS[:-1])

    def value(text: str) -> str:
        return f"sha256({spelled} || coalesce(strlen({text}) || ':' || {text}, '-'))"

    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
        "lambda h, b: list_reduce(list_prepend(xor(h, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"
    )
    parts = [
        f"rows AS (SELECT row_number() OVER () AS r, doc_id, lang, {value('text')} AS leaf, "
        f"CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {value(f'''translate(text, '{CAPITALS}', '{SMALL}')''')} ELSE {value('text')} END AS given FROM documents)",
        "a0 AS (SELECT r, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS p, leaf AS h FROM rows)",
        "w0 AS (SELECT r, tree, p, given AS x, '' AS proof FROM a0 JOIN rows USING (r))",
    ]

    def climb(nodes: str, walkers: str, level: int, tree: str) -> None:
        """One level up: a run's digest for every tree that still has several nodes, and each walker's siblings."""
        a, b, w, v = f"{nodes}{level}", f"{nodes}{level + 1}", f"{walkers}{level}", f"{walkers}{level + 1}"
        parts.append(f"{a}n AS (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {a})")
        parts.append(
            f"{b} AS (SELECT {tree}, p // 8 AS p, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h FROM {a}n GROUP BY {tree}, p // 8)"
        )
        parts.append(
            f"{v} AS (SELECT w.r, w.tree, w.p // 8 AS p, CASE WHEN max(a.n) = 1 THEN max(w.x) ELSE sha256(string_agg(CASE WHEN a.p = w.p THEN w.x ELSE a.h END, '' ORDER BY a.p)) END AS x, "
            f"max(w.proof) || coalesce(string_agg(a.h, '' ORDER BY a.p) FILTER (WHERE a.p <> w.p), '') AS proof "
            f"FROM {w} w JOIN {a}n a ON a.{tree} = w.{tree} AND a.p // 8 = w.p // 8 GROUP BY w.r, w.tree, w.p)"
        )

    for k in range(_SQL_LEVELS):
        climb("a", "w", k, "tree")
    parts.append(f"subs AS (SELECT tree, h FROM a{_SQL_LEVELS})")
    parts.append("b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS p, tree AS member, h FROM subs)")
    parts.append(f"u0 AS (SELECT r, '' AS tree, b0.p, x, proof FROM w{_SQL_LEVELS} w JOIN b0 ON b0.member = w.tree)")
    for k in range(3):
        climb("b", "u", k, "tree")
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subs.h AS subroot, b3.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = b3.h AS verified "
        "FROM rows JOIN u3 USING (r) JOIN subs ON subs.tree = coalesce('=' || lang, '') CROSS JOIN b3"
    )


ORACLE_SQL = _oracle()
