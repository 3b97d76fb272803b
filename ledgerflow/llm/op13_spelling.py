"""Spelling variants: words one edit apart, found by a trie frontier of relational joins.

The trie over all words is a table of edges (node, letter), one folder per depth; a node is its prefix, a word's end is an
edge without a letter. A state (word, position, node, edits) says that the first ``position`` letters of a word lead to
``node`` after that many edits. States are kept per *prefix* of the word, so words that begin alike share them and a
prefix of any popularity is one row. The states without an edit are the nodes themselves: a first edit at a node pairs
two of its letters (replacement) or lets the other side take one letter alone (insertion). States with one edit must
follow equal letters from then on: level by level each is joined with the edges of its word's prefix and of its node,
and where both end, the two words are neighbours. The first edit stands at the first difference of two words, so every pair is found once;
a prefix has at most a few states per letter of the alphabet and position, whatever the data.

Early edits would pair most of the trie's upper levels before the rest of the words tells them apart. So edits at the
first ``EARLY`` letters are left to a second trie, over the words read backwards, where they come late. Both tries stand under one
root (a mark before the word) and are walked together, so a level is one job and the driver plans half as many.

Words above ``LEVELS`` letters leave the trie: one row per letter with the hash of the word without it, joined on hash,
length and place, and every pair that meets is compared letter by letter.

Rules: null text has no words; a null id is written as an empty string before the colon; repeated rows count each; an
empty table gives an empty result; ties go to the smaller word in code-point order. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm.arrays import mix
from ledgerflow.llm.frames import documents
from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import fresh_path, store

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
LEVELS = 40
EARLY = 4
#: The letter before a word that names its trie: as it is written, or read backwards.
FORWARD, BACKWARD = ">", "<"
RUN = rf"([A-Za-z\u00C0-\u00FF]{{{LEAST_LETTERS},}})"
_PIECE = 1 << 16


def words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: runs of letters after the contract's deletions, with their number of occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(1))).alias("run"))
    low = runs.select("doc_id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    named = low.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run"))
    counted = named.select(word.alias("word")).where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def edges(spelled: DataFrame) -> str:
    """Write the trie of ``word``: folders by depth with ``node``, ``letter`` (empty at a word's end) and ``n`` (there)."""
    size = F.char_length("word")
    steps = spelled.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("depth"))
    cut = steps.select(
        "depth",
        F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        F.substring("word", F.col("depth") + 1, F.lit(1)).alias("letter"),
        F.when(F.col("depth") == size, F.col("n")).alias("n"),
    )
    path = fresh_path(spelled.sparkSession, "trie")
    rows = cut.groupBy("depth", "node", "letter").agg(F.max("n").alias("n"))
    rows.write.partitionBy("depth").parquet(path)
    return path


def trie_pairs(spelled: DataFrame, tries: dict[str, tuple[int, int | None]]) -> DataFrame:
    """``word``, ``other``, ``n``, ``other_n`` of all words one edit apart in the same trie.

    A word begins with the mark of its trie, so one walk down the levels serves all tries. Per mark: the letter (the mark is
    letter 0) at or after which the first difference stands, and the most letters of the rest after it (or no limit).
    ``other`` is the longer one or has the greater letter at the difference.
    """
    spark = spelled.sparkSession
    deepest = spelled.agg(F.max(F.char_length("word"))).first()[0]
    none = F.lit(None).cast("string")
    if deepest is None:
        return spelled.select("word", none.alias("other"), "n", F.col("n").alias("other_n"))
    path = edges(spelled)
    edge = "node string, letter string, n bigint"

    def level(depth: int) -> DataFrame:
        if depth > deepest:
            return spark.createDataFrame([], edge)
        return spark.read.schema(edge).parquet(f"{path}/depth={depth}")

    def fresh(rows: DataFrame, place: int, barred) -> DataFrame:
        return rows.select("word", "node", F.lit(1).alias("edits"), F.lit(place).alias("place"), barred.alias("barred"))

    waiting, found = None, fresh_path(spark, "frontier")
    state = "word string, node string, edits int, place int, barred string, n bigint, other_n bigint, done boolean"
    for depth in range(min(first for first, _ in tries.values()), deepest + 1):
        here = level(depth)
        started = [mark for mark, (first, _) in tries.items() if first <= depth]
        letters = here.where("letter <> ''").where(F.substring("node", 1, 1).isin(started))
        inserted = letters.select(F.col("node").alias("word"), F.concat("node", "letter").alias("node"), "letter")
        states = fresh(inserted, depth, F.col("letter"))
        states = states if waiting is None else states.unionByName(waiting)
        # the word's side takes an edge of this depth; the node's side one of this depth, or of the next after an insertion
        mine = here.select(F.col("node").alias("word"), "letter", "n")
        theirs = here.unionByName(level(depth + 1)).select(F.concat("node", "letter").alias("reached"), (F.col("letter") == "").alias("done"), F.col("n").alias("other_n"))
        tried = states.join(mine, "word").where("barred IS NULL OR letter <> barred")
        tried = tried.withColumns({"reached": F.concat("node", "letter"), "done": F.col("letter") == ""})
        moved = tried.join(theirs, ["reached", "done"]).select(F.concat("word", "letter").alias("word"), F.col("reached").alias("node"), "edits", "place", none.alias("barred"), "n", "other_n", "done")
        pairs = letters.select("node", "letter").join(letters.select("node", F.col("letter").alias("other")), "node").where("letter < other")
        replaced = fresh(pairs.select(F.concat("node", "letter").alias("word"), F.concat("node", "other").alias("node")), depth, none)
        bare = {"n": F.lit(None).cast("bigint"), "other_n": F.lit(None).cast("bigint"), "done": F.lit(False)}
        moved.unionByName(replaced.withColumns(bare)).write.parquet(f"{found}/depth={depth}")
        made = spark.read.schema(state).parquet(f"{found}/depth={depth}")
        waiting = made.where("NOT done").select("word", "node", "edits", "place", "barred")
        for mark, (_, steps) in tries.items():
            if steps is not None:
                waiting = waiting.where((F.substring("word", 1, 1) != mark) | (F.col("place") + steps >= depth))
    if waiting is None:
        return spelled.where("false").select("word", none.alias("other"), "n", F.col("n").alias("other_n"))
    return spark.read.schema(state).parquet(found).where("done").select("word", F.col("node").alias("other"), "n", "other_n")


def long_pairs(spelled: DataFrame, above: int) -> DataFrame:
    """The pairs of which at least one word has more than ``above`` letters."""
    ship_package(spelled.sparkSession)
    long = store(spelled.where(F.char_length("word") >= above).withColumn("id", F.monotonically_increasing_id()), "long_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, name in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), strict=True):
                code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                size = len(code)
                base = np.full(size + 1, 0x9E3779B97F4A7C15, np.uint64)
                base[0] = 1
                power = np.multiply.accumulate(base)
                upto = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(code) * power[:-1], dtype=np.uint64)]
                # what follows a deleted letter moves down by one power
                back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
                without = upto[:-1] + (upto[-1] - upto[1:]) * back
                # last comes the word as it is, at place -1
                places, values = np.r_[np.arange(size), -1], np.r_[without, upto[-1:]].view(np.int64)
                letters = np.r_[code, np.zeros(1, np.uint64)].astype(np.int32)
                for a in range(0, size + 1, _PIECE):
                    at = slice(a, a + _PIECE)
                    same = [pa.array(np.full(len(places[at]), x, np.int64)) for x in (name, size)]
                    yield pa.RecordBatch.from_arrays([*same, *map(pa.array, (places[at], values[at], letters[at]))], names=["id", "size", "place", "hash", "letter"])

    variants = store(long.select("id", "word").mapInArrow(run, "id bigint, size bigint, place bigint, hash bigint, letter int"), "variants")
    cut = variants.where("place >= 0")
    one = cut.where(F.col("size") > above).select("id", "size", "place", "hash", "letter")
    two = one.select(F.col("id").alias("with"), "size", "place", "hash", F.col("letter").alias("other"))
    replaced = one.join(two, ["size", "place", "hash"]).where("letter < other").select("id", "with", "place", F.lit(1).alias("taken"))
    whole = variants.where("place < 0").select("id", F.col("size").alias("shorter"), "hash")
    longer = cut.select(F.col("id").alias("with"), (F.col("size") - 1).alias("shorter"), "place", "hash")
    inserted = whole.join(longer, ["shorter", "hash"]).groupBy("id", "with").agg(F.min("place").alias("place")).withColumn("taken", F.lit(0))
    texts = long.select("id", "word", "n")
    others = long.select(F.col("id").alias("with"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = replaced.unionByName(inserted).join(texts, "id").join(others, "with")
    place = F.col("place").cast("int")
    rest = F.substring("word", place + F.col("taken") + 1, F.char_length("word"))
    same = (F.substring("word", F.lit(1), place) == F.substring("other", F.lit(1), place)) & (rest == F.substring("other", place + 2, F.char_length("other")))
    return met.where(same).select("word", "other", "n", "other_n")


def neighbours(spelled: DataFrame) -> DataFrame:
    """All pairs of words one edit apart, each in both directions: ``word``, ``other``, ``n``, ``other_n``."""
    short = store(spelled.where(F.char_length("word") <= LEVELS), "short_words")
    marked = short.select(F.concat(F.lit(FORWARD), "word").alias("word"), "n")
    turned = short.select(F.concat(F.lit(BACKWARD), F.reverse("word")).alias("word"), "n")
    met = trie_pairs(marked.unionByName(turned), {FORWARD: (1 + EARLY, None), BACKWARD: (1 + LEAST_LETTERS - EARLY, EARLY)})
    back = F.substring("word", 1, 1) == BACKWARD
    bare = {c: F.substring(c, F.lit(2), F.char_length(c)) for c in ("word", "other")}
    plain = met.select(back.alias("back"), *[F.when(back, F.reverse(c)).otherwise(c).alias(name) for name, c in bare.items()], "n", "other_n")
    early = F.substring("word", F.lit(1), F.lit(EARLY)) != F.substring("other", F.lit(1), F.lit(EARLY))
    pairs = plain.where(~F.col("back") | early).drop("back").unionByName(long_pairs(spelled, LEVELS))
    back = pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n"))
    return pairs.unionByName(back)


def forms(spelled: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word's ``form``, ``n_near`` and ``form_n``: its most frequent neighbour, if at least ``ratio`` times as frequent."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = spelled.join(best, "word", "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """Add ``root``. A form is at least ten times as frequent as its word, so the rounds, which double the way, are few."""
    ways = store(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "ways")
    while True:
        next_ = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = ways.join(next_, "root", "left")
        after = store(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = after.select("word", "root")
        if after.where("moved").isEmpty():
            return formed.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs``."""
    spelled = store(words(docs), "words")
    formed = store(forms(spelled, neighbours(spelled)), "forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
