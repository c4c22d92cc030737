"""Plain versions of the operators, one text at a time, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_quality(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), failed


def id_bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def fingerprint(text: str | None) -> int:
    w = words(lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_components(values: list[int], names: list, linked) -> list:
    """For each place the smallest name among the places connected to it."""
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                parent[root(i)] = root(j)
    least: dict[int, object] = {}
    for i, name in enumerate(names):
        known = least.get(root(i))
        if known is None or (name is not None and name < known):
            least[root(i)] = name
    return [least[root(i)] for i in range(len(values))]


KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def unigram_scores(rows: list[tuple]) -> list[tuple]:
    """(n_tokens, n_known, train_tokens, base_score) of each (doc_id, text)."""
    tokens = [words(lower(t or "")) + [""] for _, t in rows]
    counts = Counter(t for (i, _), ts in zip(rows, tokens) if not held_out(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    score = lambda t: math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1)))
    return [(len(ts), sum(t in counts for t in ts), n, sum(map(score, ts))) for ts in tokens]


def padding(fills) -> int:
    return sum(0 if f & (f - 1) == 0 else 2048 - f for f in fills)
