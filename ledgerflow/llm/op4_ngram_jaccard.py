"""N-gram Jaccard join (grouped prefix join) and its classes of linked documents.

1. One pass over the texts makes each document's set of shingle hashes and counts shingles that repeat within a
   stretch of documents; the most repeated ones (at most ``COMMON``) get a place at the end of the global order,
   before which stand all others by hash. The order only decides how many candidates there are, never the result.
2. A second pass gives each set its prefix: the first ``n - ceil(0.85 n) + 1`` shingles. Documents with the same
   prefix and size are one group and give one row per prefix shingle.
3. Shingles that only one group has are dropped (an aggregate with map-side combine). In what remains each group
   meets the *hub* of each of its shingles, the one that has it earliest; pairs must pass the size and position filters.
   Pairs are expanded to member sets, verified, and linked sets become classes.
4. Then every remaining pair that shares a prefix shingle, passes the filters and lies in two classes is verified as well. A
   pair inside one class needs no check: it can't change the classes. So no link is missed, and a group of
   thousands of near copies costs a star, not all its pairs.

Rules: null and wordless texts have no shingles, size 0, and are their own class; fewer than 4 words are one shingle; equal sets are
linked; repeated rows (equal ids too) each give a row; a row with a null id is linked like any other, and its class is named by the least id that is
not null (null where there is none); an empty table gives an empty result. Only the id and text columns are read, so other columns of any name may
stand beside them. Texts of any length are cut whole. Sets are compared by 64-bit shingle
hashes and named by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm import arrays
from ledgerflow.llm.components import components
from ledgerflow.llm.frames import documents
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import fresh_path, store

SHINGLE = 4
PERCENT = 85
COMMON = 1 << 18
STRETCH = 4_000_000
#: Up to this many rows the ids of the documents to read again are broadcast; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 2_000_000

_MASK = (1 << 64) - 1

WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after another, and their offsets."""
    data, offsets = arrays.text_bytes(column)
    data = arrays.LOWER[data]
    starts, ends = arrays.spans(WORD[data], offsets)
    words = arrays.hashes(data, starts, ends)
    count = np.bincount(arrays.row_of(starts, offsets), minlength=len(column)) if len(starts) else np.zeros(len(column), np.int64)
    first = np.cumsum(count) - count
    width = np.minimum(count, size)
    n = np.where(count > 0, count - width + 1, 0)
    at = arrays.gather(first, n)
    hashed = np.zeros(len(at), np.uint64)
    reach = np.repeat(width, n)
    for k in range(size):
        here = reach > k
        step = np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & _MASK)
        hashed[here] = arrays.mix(hashed[here] * np.uint64(0xD6E8FEB86659FD93) + words[at[here] + k] + step)
    bounds = np.r_[0, np.cumsum(n)]
    kept, sizes = [], np.zeros(len(column), np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        one = np.sort(hashed[a:b])
        if len(one) > 1:
            one = one[np.r_[True, one[1:] != one[:-1]]]
        kept.append(one)
        sizes[i] = len(one)
    return np.concatenate([np.zeros(0, np.uint64), *kept]), np.r_[0, np.cumsum(sizes)]


def set_names(hashed: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128-bit names of sets; empty sets are named too."""
    filled = np.diff(bounds) > 0
    out = np.zeros((len(filled), 2), np.uint64)
    for side, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        if filled.any():
            out[filled, side] = np.add.reduceat(arrays.mix(hashed ^ np.uint64(salt)), bounds[:-1][filled])
    raw = out.tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _repeats(text: str, size: int):
    """Shingles met twice or more within a stretch of different sets, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        total = 0

        def counted() -> pa.RecordBatch:
            every = np.concatenate(held)
            held.clear()
            every.sort()
            at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            n = np.diff(np.r_[at, len(every)])
            token = every[at[n > 1]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(token), pa.array(n[n > 1], pa.int64())], names=["token", "n"])

        for batch in batches:
            for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
                hashed, bounds = shingle_sets(part.column(text), size)
                for i, name in enumerate(set_names(hashed, bounds)):
                    if name not in seen:
                        seen.add(name)
                        held.append(hashed[bounds[i] : bounds[i + 1]])
                        total += int(bounds[i + 1] - bounds[i])
                if total >= STRETCH:
                    yield counted()
                    seen, total = set(), 0
        if held:
            yield counted()

    return run


def common_shingles(docs: DataFrame, text: str = "text", size: int = SHINGLE, limit: int = COMMON) -> np.ndarray:
    """The most repeated shingles, rarest first: at most ``limit``, whatever the input."""
    ship_package(docs.sparkSession)
    counts = store(docs.select(text).mapInArrow(_repeats(text, size), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).where("n > 3"), "repeats")
    steps = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).count().sort(F.desc("step")).collect()
    room, least = limit, None
    for s in steps:
        room -= s["count"]
        if room < 0:
            break
        least = s.step
    if least is None:
        return np.zeros(0, np.uint64)
    rows = counts.where(F.floor(F.log2("n") * 8) >= least).sort("n", "token").select("token").toArrow()
    return rows.column("token").to_numpy().astype(np.int64).view(np.uint64)


def _prefixes(text: str, size: int, percent: int, common, keep: str):
    """Rows of two kinds: a document with its set, group and size; a group's prefix shingle with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarest_first = common.value
        by_hash = np.argsort(rarest_first)
        listed = rarest_first[by_hash]
        seen: set[int] = set()
        for batch in batches:
            for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
                hashed, bounds = shingle_sets(part.column(text), size)
                sizes = np.diff(bounds)
                names = set_names(hashed, bounds)
                place = np.minimum(np.searchsorted(listed, hashed), max(len(listed) - 1, 0))
                is_common = listed[place] == hashed if len(listed) else np.zeros(len(hashed), bool)
                room = sizes - -(-percent * sizes // 100) + 1
                groups = np.zeros(len(sizes), np.int64)
                tokens, whose, spot, of_size = [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    if a == b:
                        continue
                    late = is_common[a:b]
                    prefix = hashed[a:b][~late][: room[i]]
                    if len(prefix) < room[i]:
                        rest = np.sort(by_hash[place[a:b][late]])[: room[i] - len(prefix)]
                        prefix = np.r_[prefix, rarest_first[rest]]
                    mixed = arrays.mix(prefix + np.arange(len(prefix), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    group = int(np.uint64((int(mixed.sum(dtype=np.uint64)) * 31 + b - a) & _MASK).view(np.int64))
                    groups[i] = group
                    if group not in seen:
                        seen.add(group)
                        tokens.append(prefix)
                        whose.append(group)
                        spot.append(len(prefix))
                        of_size.append(b - a)
                n, m = part.num_rows, int(sum(spot))
                nothing = lambda kind, k: pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column(keep), pa.array(names, pa.binary()), pa.array(groups), pa.array(sizes.astype(np.int32)), nothing(pa.int64(), n), nothing(pa.int32(), n)],
                    names=[keep, "set", "grp", "size", "token", "pos"],
                )
                if m:
                    run_of = np.array(spot)
                    yield pa.RecordBatch.from_arrays(
                        [
                            nothing(part.column(keep).type, m),
                            nothing(pa.binary(), m),
                            pa.array(np.repeat(np.array(whose, np.int64), run_of)),
                            pa.array(np.repeat(np.array(of_size, np.int32), run_of)),
                            pa.array(np.concatenate(tokens).view(np.int64)),
                            pa.array((arrays.gather(np.zeros(len(run_of), np.int64), run_of) + 1).astype(np.int32)),
                        ],
                        names=[keep, "set", "grp", "size", "token", "pos"],
                    )

    return run


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of two linked sets: 100 i >= percent (a + b - i)."""
    return F.ceil((percent * (a + b)) / F.lit(float(100 + percent)) - F.lit(1e-9))


def _may_link(x: str, y: str, percent: int) -> Column:
    """Size filter, and position filter at the first shingle the two share."""
    sx, sy, px, py = F.col(f"{x}.size"), F.col(f"{y}.size"), F.col(f"{x}.pos"), F.col(f"{y}.pos")
    sizes = (100 * sx >= percent * sy) & (100 * sy >= percent * sx)
    return sizes & (1 + F.least(sx - px, sy - py) >= _needed(sx, sy, percent))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of set names that link; ``sets`` has ``set`` and ``hashes``."""
    one = pairs.join(sets.select(F.col("set").alias("a"), F.col("hashes").alias("ha")), "a")
    two = one.join(sets.select(F.col("set").alias("b"), F.col("hashes").alias("hb")), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    return two.where(100 * shared >= percent * (F.size("ha") + F.size("hb") - shared)).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, members: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """``set`` and ``hashes`` of the wanted sets, from one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, text, arrays.HASHED_BYTES):
                hashed, bounds = shingle_sets(part.column(text), size)
                listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashed.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_names(hashed, bounds), pa.binary()), listed], names=["set", "hashes"])

    one = store(members.join(wanted, "set").groupBy("set").agg(F.min(id_column).alias(id_column)), "chosen")
    rows = one.agg(F.count("*").alias("all"), F.count(id_column).alias("named")).first()
    ids = one.select(id_column).distinct()
    few = rows["all"] <= BROADCAST_ROWS
    chosen = docs.select(id_column, text).join(F.broadcast(ids) if few else ids, id_column, "left_semi")
    schema = "set binary, hashes array<bigint>"
    found = chosen.select(text).mapInArrow(run, schema)
    if rows["named"] < rows["all"]:  # sets that only rows without an id have
        unnamed = docs.where(F.col(id_column).isNull()).select(text).mapInArrow(run, schema)
        missing = one.where(F.col(id_column).isNull()).select("set")
        found = found.union(unnamed.join(missing, "set", "left_semi").dropDuplicates(["set"]))
    return found.where(F.size("hashes") > 0)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``set`` and ``root`` for all ``nodes`` (column ``set``)."""
    found = components(links).withColumnRenamed("node", "set")
    return nodes.join(found, "set", "left").select("set", F.coalesce("root", "set").alias("root"))


def linked_sets(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents with ``set`` and ``size``; links between different sets, columns ``a`` and ``b``).

    The links are those of the star and of pairs between different classes: they span the same classes as all links.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs, text, size))
    kind = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, set binary, grp bigint, size int, token bigint, pos int"
    place = fresh_path(spark, "prefixes")
    docs.select(id_column, text).mapInArrow(_prefixes(text, size, percent, common, id_column), schema).write.parquet(place)
    rows = spark.read.schema(schema).parquet(place)
    members = store(rows.where(F.col("set").isNotNull()).select(id_column, "set", "grp", "size"), "members")
    prefix = rows.where(F.col("token").isNotNull()).select("token", "grp", "size", "pos")
    shared = prefix.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low <> high").select("token")
    near = store(prefix.join(shared, "token", "left_semi").distinct(), "shared")
    _delete(spark, place)  # the largest table on disk; nothing reads it again

    hubs = near.groupBy("token").agg(F.min(F.struct("pos", "grp", "size")).alias("h")).select("token", "h.*")
    stars = near.alias("x").join(hubs.alias("y"), "token").where((F.col("x.grp") != F.col("y.grp")) & _may_link("x", "y", percent))
    stars = stars.select(*_ordered("x.grp", "y.grp")).distinct()
    filled = members.where("size > 0").select("grp", "set").distinct()
    first = filled.groupBy("grp").agg(F.min("set").alias("set"), F.max("set").alias("last"))
    # a group's first set stands for it in the star; its other sets meet the first one
    one, other = first.select(F.col("grp").alias("a"), F.col("set").alias("sa")), first.select(F.col("grp").alias("b"), F.col("set").alias("sb"))
    between = stars.join(one, "a").join(other, "b").select(*_ordered("sa", "sb"))
    several = first.where("set <> last").select("grp", F.col("set").alias("a"))
    within = filled.join(several, "grp").where(F.col("set") != F.col("a")).select(*_ordered("a", "set"))
    pairs = store(between.union(within).distinct(), "pairs")
    # every set that can be in a pair at all: of the groups in ``near``, and of groups with several sets
    grouped = near.select("grp").union(several.select("grp")).distinct()
    nodes = store(filled.join(grouped, "grp"), "nodes")

    def checked(candidates: DataFrame) -> DataFrame:
        wanted = candidates.select(F.col("a").alias("set")).union(candidates.select(F.col("b").alias("set"))).distinct()
        held = fresh_path(spark, "sets")
        _sets(docs, wanted, members, id_column, text, size).write.parquet(held)
        found = store(_verified(candidates, spark.read.schema("set binary, hashes array<bigint>").parquet(held), percent).distinct(), "links")
        _delete(spark, held)
        return found

    links = checked(pairs)

    rooted = store(nodes.join(_roots(nodes.select("set").distinct(), links), "set"), "rooted")
    placed = near.join(rooted, "grp")
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    open_ = store(placed.join(mixed, "token", "left_semi"), "open")
    x, y = open_.alias("x"), open_.alias("y")
    across = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") < F.col("y.root")) & _may_link("x", "y", percent))
    inside = rooted.alias("x").join(rooted.alias("y"), (F.col("x.grp") == F.col("y.grp")) & (F.col("x.root") < F.col("y.root")))
    rest = across.select(*_ordered("x.set", "y.set")).union(inside.select(*_ordered("x.set", "y.set"))).distinct()
    rest = store(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    return members, links.union(checked(rest))


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``id_column``, ``n_shingles`` and ``component_id`` of every row."""
    members, links = linked_sets(docs, id_column, text, size, percent)
    roots = components(links).select(F.col("node").alias("set"), "root")
    filled = members.where("size > 0").select(id_column, "set", "size")
    least = filled.groupBy("set").agg(F.min(id_column).alias("least"))
    rooted = store(least.join(roots, "set", "left").select("set", "least", F.coalesce("root", "set").alias("root")), "least")
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(whole, "root").select("set", "component_id")
    found = filled.join(named, "set").select(id_column, F.col("size").cast("bigint").alias("n_shingles"), "component_id")
    empty = members.where("size = 0").select(id_column, F.lit(0).cast("bigint").alias("n_shingles"), F.col(id_column).alias("component_id"))
    return found.union(empty)


def one_per_class(docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each class (the first in the scan); documents without words stay. Own columns only."""
    named = docs.withColumn("__rid", F.monotonically_increasing_id())
    found = classes(named.select("__rid", text), "__rid", text, size, percent)
    gone = store(found.where(F.col("__rid") != F.col("component_id")).select("__rid"), "gone")
    few = gone.count() <= BROADCAST_ROWS
    return named.join(F.broadcast(gone) if few else gone, "__rid", "left_anti").select(*docs.columns)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir).select("doc_id", "text"))
