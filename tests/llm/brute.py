"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

KEEP = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ASSIGN = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', re.I | re.A)


def base_secrets(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(KEEP))


def jaccard_classes(rows: list[tuple], size: int = 4, percent: int = 85) -> list[tuple[int, int]]:
    """(set size, index of the first row of the class) of each row."""
    sets = []
    for _, text in rows:
        w = spaced_words(text)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def benchmark_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(KEEP))


def contamination(texts: list[str | None], items: list[tuple[str | None, str | None]], window: int = 13) -> list[tuple[int, int, list[str]]]:
    windows = defaultdict(set)
    for name, text in items:
        w = benchmark_words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i : i + k])].add(name)
    out = []
    for text in texts:
        w = benchmark_words(text)
        hit, names = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    names |= found
        out.append((len(w), len(hit), sorted(n for n in names if n is not None)))
    return out


def language_model(rows: list[tuple]) -> list[tuple[int, int, int, float, float]]:
    """n_tokens, n_known, train_tokens, base score and Witten-Bell score."""
    from math import log10

    tokens = [[*spaced_words(t), " end"] for _, t in rows]
    count, after = Counter(), defaultdict(Counter)
    for (name, _), w in zip(rows, tokens, strict=True):
        if name is None or zlib.crc32(str(name).encode()) % 5 != 1:
            count.update(w)
            for a, b in zip([" start", *w], w, strict=False):
                after[a][b] += 1
    n, v = sum(count.values()), len(count)
    out = []
    for w in tokens:
        base = score = 0.0
        for a, b in zip([" start", *w], w, strict=False):
            p = (count[b] + 0.5) / (n + 0.5 * (v + 1))
            kinds = len(after[a])
            mass = sum(after[a].values()) + kinds
            base += log10(p)
            score += log10((after[a][b] + kinds * p) / mass if mass else p)
        out.append((len(w), sum(count[b] > 0 for b in w), n, base, score))
    return out


def repeated_bytes(texts: list[str | None], window: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans and the hash of what is left."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - window + 1):
            if seen[r[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        starts = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), starts, hashlib.sha256(left).hexdigest()))
    return out
