"""Plain-Python versions of the text operators, for small inputs."""
from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring_dedup(docs, width):
    """[(key, text)] -> key -> (words, removed, kept)."""
    split = [(k, words(t)) for k, t in docs]
    seen = Counter(tuple(w[i : i + width]) for _, w in split for i in range(len(w) - width + 1))
    out = {}
    for k, w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out[k] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def rule_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    again = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again), len(lines)


def shingles(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_components(docs):
    """[(id, text)] -> id -> (set size, smallest id reachable)."""
    sets = [(k, shingles(t)) for k, t in docs]
    at = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            at[x].append(i)
    shared = Counter(p for rows in at.values() for p in itertools.combinations(rows, 2))
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for (a, b), o in shared.items():
        if 100 * o >= 75 * (len(sets[a][1]) + len(sets[b][1]) - o):
            label[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(sets):
        r = find(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return [(k, len(s), least[find(i)]) for i, (k, s) in enumerate(sets)]
