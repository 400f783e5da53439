"""Plain versions of the operators, one text or one list at a time."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    text, out = text or "", []
    for place, (kind, pattern, good) in enumerate((
        ("assign", ASSIGN, lambda m: len(m.group(2)) >= 8), ("access", ACCESS, lambda m: len(m.group()) >= 16),
        ("hex", HEX, lambda m: len(m.group()) >= 32),
    )):
        out += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text) if good(m)]
    return sorted(out)


def shown(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def simhash(text: str | None, width: int = 4) -> int:
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], ids: list[int], radius: int = 4) -> list[int]:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(ids))]


def contamination(texts: list[str | None], items: list[tuple[object, str | None]], width: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i: i + n])].add("null" if item is None else str(item))
    out = []
    for text in texts:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i: i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((len(words), len(hit), len(names), digest(",".join(sorted(names))), bool(hit)))
    return out


def size(text: str | None) -> int:
    return len(SPACED.findall(text or ""))


def targets(totals: dict[str | None, int], weights=(3, 1, 2), share=1.5, most=2) -> dict[str | None, float]:
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_ = {}, set(order)
    left = share * sum(totals.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level >= most * totals[s]]
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = float(most * totals[s])
            left -= most * totals[s]
            open_.discard(s)
    return out


def shingle_groups(texts: list[str | None], ids: list[int], width: int = 5, least: float = 0.8) -> tuple[list[set], int]:
    """Groups of ids that links of at least that similarity connect, by all pairs that share a shingle, and the number of links
    between different sequences of words."""
    sets = []
    for text in texts:
        words = SPACED.findall((text or "").translate(LOWER))
        w = min(width, len(words))
        sets.append(frozenset(" ".join(words[i: i + w]) for i in range(len(words) - w + 1)) if words else frozenset([""]))
    first, parent = {}, {}
    for i, s in zip(ids, sets):
        parent[i] = first.setdefault(s, i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where, shared, links = defaultdict(list), defaultdict(int), 0
    for s in first:
        for x in s:
            where[x].append(s)
    for holders in where.values():
        for j, b in enumerate(holders):
            for a in holders[:j]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if n >= least * (len(a) + len(b) - n):
            links += 1
            parent[root(first[a])] = root(first[b])
    groups = defaultdict(set)
    for i in ids:
        groups[root(i)].add(i)
    return list(groups.values()), links
