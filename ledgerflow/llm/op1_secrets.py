"""Secret scan in DataFrame functions only: fixed patterns and a randomness battery.

Patterns (``assign``, ``access``, ``hex``) give the base spans. The battery looks at every run of key characters
with a letter and a digit that can reach ``MIN_BITS``, infers its encoding (smallest alphabet that holds it), and
tests the null hypothesis "each symbol is drawn evenly and independently from that alphabet":
chi-squared against even counts, the runs test about the alphabet's middle, and lag-1 serial correlation.
Fisher's method joins the three p-values. Within each length class the Benjamini-Hochberg rule dismisses
runs as structured, so that of those dismissed at most 5 % are expected to be random ones; what
it cannot dismiss is a ``random`` span. The p-values of all rows enter that rule as a histogram (length class x
0.1 in -log10 p), whose size does not depend on the data.

An equals sign ends a run, unless it is padding at the end. ``/``, ``+``, ``-`` and ``_`` may be symbols or stand between a name and a key, so
every part between them is a run of its own besides the whole. A whole that mixes ``/`` or ``+`` with ``-`` or ``_`` is held by no
alphabet: there the parts between the signs of one pair, which keep the other pair, are runs too, and count where no smaller run
inside them is found. Runs that are found and overlap are one span.

One pattern finds the runs of key characters that hold a letter and a digit; the cuts at signs then work on these few short runs, not on
the text. All passes are narrow: no text is shuffled and a document is a row of its own, repeated or not. ``secret_spans`` scans the texts once
and stores what it found beside the other columns; ``find_secrets``, which keeps the texts, looks for runs in a pass of its own first.

Rules: a null text is empty and has no spans; positions are code points, end exclusive; an overlong run is tested whole; spans
of different kinds may overlap. An empty table gives an empty result. A column ``secrets`` of the input is replaced; columns whose names start
with two underscores are the operator's own (``redact`` packs the row first, so there any name may occur).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.llm.frames import documents
from ledgerflow.sources.shared import store

#: The patterns of the base kinds.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a run of 32 or more is the same as a run that is then found to be that long
KINDS = ["assign", "access", "hex", "random"]

#: Encodings, smallest alphabet first; padding and separators are not symbols.
ENCODINGS = {
    "hex_lower": ("^[0-9a-f]+$", "0123456789abcdef"),
    "hex_upper": ("^[0-9A-F]+$", "0123456789ABCDEF"),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36_lower": ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base36_upper": ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "base62": ("^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": ("^[0-9A-Za-z+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^[0-9A-Za-z_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
MIN_BITS = 80.0
#: Fewer symbols can't reach MIN_BITS, even of the largest alphabet.
SHORTEST = math.ceil(MIN_BITS / math.log2(max(len(symbols) for _, symbols in ENCODINGS.values())))
_PAD = r"(?:=+(?![A-Za-z0-9+/_=-]))?"
#: Whole stretches of key characters with a digit and a letter; every run lies in one, as no alphabet is inferred without both.
KEY = rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{{{SHORTEST},}}+{_PAD}"
#: Runs inside a stretch, by name: between all signs; whole; between ``-`` and ``_``; between ``/`` and ``+``. The last two are parts of mixed runs. No run is in two columns.
RUNS = {
    "__plain": rf"(?<![A-Za-z0-9])[A-Za-z0-9]{{{SHORTEST},}}+{_PAD}",
    "__whole": rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9]*[+/_-])(?:[A-Za-z0-9+/]{{{SHORTEST},}}+|[A-Za-z0-9_-]{{{SHORTEST},}}+)(?![A-Za-z0-9+/_-]){_PAD}",
    "__base64": rf"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9]*[+/])(?:(?<=[_-])[A-Za-z0-9+/]{{{SHORTEST},}}+|[A-Za-z0-9+/]{{{SHORTEST},}}+(?=[_-])){_PAD}",
    "__base64url": rf"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*[_-])(?:(?<=[+/])[A-Za-z0-9_-]{{{SHORTEST},}}+|[A-Za-z0-9_-]{{{SHORTEST},}}+(?=[+/])){_PAD}",
}
LEVEL = 0.05
LENGTH_CLASSES = [24, 32, 48, 64, 128]
LEAST_P = 1e-30
_BLOCK = 512


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (before: characters since the last match, size, size of the group, match), in order."""
    rx = F.lit(pattern)
    before = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    inner = F.regexp_extract_all(text, rx, F.lit(group)) if group else whole
    return F.arrays_zip(
        F.slice(before, 1, F.size(whole)).alias("before"),
        F.transform(whole, F.length).alias("size"),
        F.transform(inner, F.length).alias("inner"),
        whole.alias("match"),
    )


def _placed(text: str, pattern: str, group: int) -> Column:
    return F.when(F.col(text).rlike(pattern), _matches(F.col(text), pattern, group))


def _starts(column: str) -> str:
    """Places from running sums, in blocks: appending to an array copies it, so long arrays are not built in one go."""
    return f"""
        CASE WHEN size({column}) > 0 THEN flatten(zip_with(
            sequence(0, (size({column}) - 1) div {_BLOCK}),
            aggregate(
                transform(sequence(0, (size({column}) - 1) div {_BLOCK}),
                    b -> aggregate(slice({column}, b * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x.before + x.size)),
                named_struct('at', 0L, 'all', cast(array() as array<bigint>)),
                (a, n) -> named_struct('at', a.at + n, 'all', concat(a.all, array(a.at))),
                a -> a.all),
            (b, base) -> aggregate(
                slice({column}, b * {_BLOCK} + 1, {_BLOCK}),
                named_struct('at', base, 'all', cast(array() as array<struct<start:bigint,stop:bigint,inner:int,match:string>>)),
                (a, x) -> named_struct('at', a.at + x.before + x.size, 'all', concat(a.all, array(
                    named_struct('start', a.at + x.before, 'stop', a.at + x.before + x.size, 'inner', x.inner, 'match', x.match)))),
                a -> a.all)))
        ELSE cast(array() as array<struct<start:bigint,stop:bigint,inner:int,match:string>>) END"""


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["stop"].alias("stop")))


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution (complementary error function, absolute error below 2e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (1 + 0.5 * x)
    coefficients = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        poly = poly * t + c
    return F.least(F.greatest(t * F.exp(poly - x * x), F.lit(LEAST_P)), F.lit(1.0))


def _inferred(runs: str) -> Column:
    """The symbols of each run without padding, and the smallest alphabet that holds them; null when it has no letter or no digit."""
    rules = " ".join(f"WHEN x.match RLIKE '{rule}' THEN '{symbols}'" for rule, symbols in ENCODINGS.values())
    return F.expr(f"""transform({runs}, x -> named_struct(
        'start', x.start, 'stop', x.stop, 'part', x.part,
        'core', trim(TRAILING '=' FROM x.match),
        'alphabet', CASE WHEN NOT (x.match RLIKE '[0-9]' AND x.match RLIKE '[A-Za-z]') THEN NULL {rules} END))""")


def _values(runs: str) -> Column:
    return F.expr(f"""transform(filter({runs}, x -> x.alphabet IS NOT NULL), x -> named_struct(
        'start', x.start, 'stop', x.stop, 'part', x.part,
        'n', cast(length(x.core) as double), 'k', cast(length(x.alphabet) as double),
        'squares', aggregate(split(x.alphabet, ''), 0D, (a, c) -> a + power(length(x.core) - length(replace(x.core, c, '')), 2)),
        'v', transform(split(x.core, ''), c -> cast(instr(x.alphabet, c) as double))))""")


def _sums(runs: str) -> Column:
    """Sums that the three tests need; one pass over the values each."""
    return F.expr(f"""transform({runs}, x -> named_struct(
        'start', x.start, 'stop', x.stop, 'part', x.part, 'n', x.n, 'k', x.k, 'squares', x.squares,
        'sum', aggregate(x.v, 0D, (a, y) -> a + y),
        'sum2', aggregate(x.v, 0D, (a, y) -> a + y * y),
        'low', aggregate(x.v, 0D, (a, y) -> a + IF(2 * y <= x.k, 1D, 0D)),
        'lag', aggregate(zip_with(slice(x.v, 1, size(x.v) - 1), slice(x.v, 2, size(x.v) - 1), (y, z) -> y * z), 0D, (a, y) -> a + y),
        'turns', aggregate(zip_with(slice(x.v, 1, size(x.v) - 1), slice(x.v, 2, size(x.v) - 1),
            (y, z) -> IF((2 * y <= x.k) = (2 * z <= x.k), 0D, 1D)), 0D, (a, y) -> a + y),
        'ends', x.v[0] * x.v[size(x.v) - 1]))""")


def _p(x: Column) -> Column:
    n, k = x["n"], x["k"]
    even = (x["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    high = n - x["low"]
    mean_runs = 1 + 2 * x["low"] * high / n
    spread = F.sqrt(F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(0.0)))
    turns = F.when(spread > 0, (x["turns"] + 1 - mean_runs) / spread).otherwise(F.lit(40.0))
    variance = x["sum2"] - x["sum"] * x["sum"] / n
    # circular lag: the last symbol meets the first
    serial = F.when(variance > 0, ((x["lag"] + x["ends"] - x["sum"] * x["sum"] / n) / variance + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(40.0))
    # uneven counts only: counts more even than chance are left to the other two tests
    joined = -(F.log(_tail(F.greatest(even, F.lit(0.0)))) + F.log(_tail(turns)) + F.log(_tail(serial)))
    return F.greatest(F.exp(-joined) * (1 + joined + joined * joined / 2), F.lit(LEAST_P))


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for limit in LENGTH_CLASSES:
        out = out + (n >= limit).cast("int")
    return out


def _bin(p: Column) -> Column:
    """-log10 p in steps of 0.1, rounded down: 0 to 300."""
    return F.least(F.floor(-F.log10(p) * 10), F.lit(300)).cast("int")


def _cut(docs: DataFrame) -> DataFrame:
    """Replace the stretches ``__keys`` by the runs inside them, ``__runs``, placed in the text."""
    parts = [c.strip("_") for c in RUNS]
    found = docs.withColumn("__keys", F.transform("__keys", lambda y: F.struct(
        y["start"].alias("at"), *[_matches(y["match"], rx).alias(c) for c, rx in zip(parts, RUNS.values())])))
    placed = found.withColumn("__keys", F.expr(f"transform(__keys, y -> named_struct('at', y.at, {', '.join(f'{c!r}, ' + _starts(f'y.{c}') for c in parts)}))"))
    marked = [f"transform(y.{c}, x -> named_struct('start', y.at + x.start, 'stop', y.at + x.stop, 'part', {c in ('base64', 'base64url')}, 'match', x.match))" for c in parts]
    return placed.withColumn("__runs", F.expr(f"flatten(transform(__keys, y -> concat({', '.join(marked)})))")).drop("__keys")


def _scored(docs: DataFrame, text: str, base: bool) -> DataFrame:
    """Add the arrays ``__assign``, ``__access``, ``__hex`` (places) and ``__runs`` (places with p-values).

    Each step is a projection of its own: it is used several times by the next.
    """
    wanted = {"__assign": (ASSIGN, 2), "__access": (ACCESS, 0), "__hex": (HEX, 0)} if base else {}
    wanted |= {"__keys": (KEY, 0)}
    found = docs.withColumns({c: _placed(text, rx, g) for c, (rx, g) in wanted.items()})
    placed = _cut(found.withColumns({c: F.expr(_starts(c)) for c in wanted}))
    for step in (_inferred, _values, _sums):
        placed = placed.withColumn("__runs", step("__runs"))
    tested = F.transform(F.filter("__runs", lambda x: x["n"] * F.log2(x["k"]) >= MIN_BITS), lambda x: F.struct(x["start"], x["stop"], x["part"], _length_class(x["n"]).alias("class"), _bin(_p(x)).alias("bin")))
    return placed.withColumn("__runs", tested)


def _dismissed(scored: DataFrame, level: float) -> dict[int, int]:
    runs = scored.select(F.explode("__runs").alias("x")).groupBy("x.class", "x.bin").count()
    upward = Window.partitionBy("class").orderBy(F.desc("bin"))
    whole = Window.partitionBy("class")
    # a bin's largest p-value is 10^(-bin / 10)
    steps = runs.select("class", "bin", F.sum("count").over(upward).alias("rank"), F.sum("count").over(whole).alias("m"))
    passed = steps.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= level * F.col("rank") / F.col("m"))
    return {r["class"]: r["bin"] for r in passed.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def dismissal_bins(docs: DataFrame, text: str = "text", level: float = LEVEL) -> dict[int, int]:
    """Benjamini-Hochberg per length class over all rows: the lowest bin that is dismissed as structured."""
    with_keys = docs.select(text).where(F.col(text).rlike(KEY))
    return _dismissed(store(_scored(with_keys, text, base=False).select("__runs"), "runs"), level)


def _joined(spans: str) -> str:
    """Sorted spans; those that overlap are one."""
    return f"""aggregate({spans}, cast(array() as array<struct<start:bigint,stop:bigint>>), (a, s) ->
        IF(size(a) > 0 AND s.start < element_at(a, -1).stop,
           concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'stop', greatest(element_at(a, -1).stop, s.stop)))),
           concat(a, array(named_struct('start', s.start, 'stop', s.stop)))))"""


def _with_secrets(scored: DataFrame, bins: dict[int, int]) -> DataFrame:
    """Turn the arrays of ``_scored`` into ``secrets``."""

    def undecided(x: Column) -> Column:
        ok = F.lit(True)
        for c, b in bins.items():
            ok = ok & ~((x["class"] == c) & (x["bin"] >= b))
        return ok

    kept = F.filter("__assign", lambda x: x["inner"] >= 8)
    access = F.filter("__access", lambda x: x["inner"] >= 16)
    base = F.concat(_spans(kept, 0), _spans(access, 1), _spans(F.col("__hex"), 2))
    scored = scored.withColumn("__runs", F.filter("__runs", undecided))
    scored = scored.withColumn("__fine", F.filter("__runs", lambda x: ~x["part"]))
    outer = F.filter("__runs", lambda x: x["part"] & ~F.exists("__fine", lambda y: (y["start"] >= x["start"]) & (y["stop"] <= x["stop"])))
    scored = scored.withColumn("__runs", F.sort_array(F.concat("__fine", outer)))
    own = _spans(F.expr(_joined("__runs")), 3)
    return scored.withColumn("secrets", F.sort_array(F.concat(base, own))).drop("__assign", "__access", "__hex", "__runs", "__fine")


def find_secrets(docs: DataFrame, text: str = "text", level: float = LEVEL) -> DataFrame:
    """Add ``secrets``: array of (start, kind, stop), by start, then kind (0 assign, 1 access, 2 hex, 3 random)."""
    bins = dismissal_bins(docs, text, level)
    return _with_secrets(_scored(docs.withColumn("__text", F.col(text)), "__text", base=True).drop("__text"), bins)


def secret_spans(docs: DataFrame, text: str = "text", level: float = LEVEL) -> DataFrame:
    """``secrets`` beside all columns but the text, which is scanned once."""
    scored = store(_scored(docs, text, base=True).drop(text), "secret_spans")
    return _with_secrets(scored, _dismissed(scored, level))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>", level: float = LEVEL, size: str = "n_chars") -> DataFrame:
    """Replace every span by ``mark``; overlapping spans are one. Own columns only; other texts stay as they are.

    A column ``size`` of changed texts is set to the new number of characters.
    """
    found = find_secrets(docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__body")), "__body", level)
    clean = F.expr(f"""array_join(transform(sequence(0, size(__spans)), i -> substring(
        __body,
        cast(IF(i = 0, 0, __spans[i - 1].stop) + 1 as int),
        cast(IF(i = size(__spans), length(__body), __spans[i].start) - IF(i = 0, 0, __spans[i - 1].stop) as int))), '{mark}')""")
    masked = found.withColumn("__spans", F.expr(_joined("secrets"))).withColumn("__clean", F.when(F.size("__spans") > 0, clean).otherwise(F.col("__body")))
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == text:
            return F.col("__clean").alias(c)
        if c == size:
            return F.when(F.size("__spans") > 0, F.length("__clean").cast(kinds[c])).otherwise(F.col("__row")[c]).alias(c)
        return F.col("__row")[c].alias(c)

    return masked.select(*map(column, docs.columns))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spelled(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        spelled(F.col("secrets")).alias("spans"),
        count(3).alias("n_random"),
    )
