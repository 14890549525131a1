"""Plain, row-at-a-time versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def base_failed(text: str | None) -> bool:
    n, _, _, _, rep = base_stats(text)
    return n < 10 or 100 * rep > 20 * n


def exact_groups(rows: list[tuple]) -> dict:
    """(doc_id, text) rows -> {doc_id: (keep_id, group_size)}."""
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    return {i: (max(g), len(g)) for g in groups.values() for i in g}


def shingles(text: str | None) -> set:
    w = words(low(text))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 2 else set(zip(w, w[1:]))


def components(rows: list[tuple], percent: int = 80) -> dict:
    """(doc_id, text) rows -> {doc_id: (n_shingles, component_id)} by comparing every pair."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: (len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


def repeats(rows: list[tuple], length: int = 400) -> dict:
    """(doc_id, text) rows -> {doc_id: bytes mask of what a repeated string covers}."""
    seen: Counter = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = {}
    for i, b in data:
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                mask[p:p + length] = b"\1" * length
        out[i] = bytes(mask)
    return out


def best_padding(histogram: list[tuple[int, int]], buckets: int) -> int:
    """Least padding over every choice of boundaries."""
    from itertools import combinations

    lens = sorted(x for x, _ in histogram)
    best = None
    for k in range(min(buckets, len(lens))):
        for inner in combinations(lens[:-1], k):
            bounds = [*inner, lens[-1]]
            cost = sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram)
            best = cost if best is None else min(best, cost)
    return best or 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs: list[tuple], items: list[tuple], top: int = 50) -> list[tuple]:
    """(item_id, rank, doc_id, score) from (doc_id, text) and (item_id, text) rows."""
    counts = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(TERM.findall(low(text))) if t in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, s) for r, (_, _, i, s) in enumerate(scored[:top])]
    return out


def variants(docs: list[tuple]) -> dict:
    """{word: (form, root, n, n_near, form_n)} from (doc_id, text) rows, by comparing all words."""
    n: Counter = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}

    def near(u, v):
        if len(u) == len(v):
            return sum(a != b for a, b in zip(u, v)) == 1
        u, v = sorted((u, v), key=len)
        return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))

    out, form = {}, {}
    for w, k in n.items():
        close = [v for v in n if v != w and near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * k else None
        out[w] = len(close)
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), k, out[w], n.get(form[w])) for w, k in n.items()}


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by the patterns themselves."""
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                twice = [sum(divmod(2 * d, 10)) for d in digits[::-1][1::2]]
                if not 14 <= len(digits) <= 19 or (sum(digits[::-1][::2]) + sum(twice)) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)
