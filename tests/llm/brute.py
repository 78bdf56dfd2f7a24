"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near_duplicates(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component)"""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    where = defaultdict(list)
    both: Counter = Counter()
    for i in sorted(sets):
        for x in sets[i]:
            for j in where[x]:
                both[j, i] += 1
            where[x].append(i)
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), n in both.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def contamination(rows: list[tuple[int, str | None]], items: list[tuple[int, str | None]], size: int = 13) -> list[tuple]:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(str(item))
    lengths = {len(x) for x in windows}
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def base_rules(rows: list[tuple[int, str | None]]) -> list[tuple]:
    out = []
    for i, text in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed))
    return out
