"""License scan: winnowed fingerprints pick candidates, banded alignment decides.

Words are compared in lower case without the punctuation around them.  The
``gram``-word hashes of each template are winnowed (the smallest of every
``window`` neighbours stays), which leaves a small inverted index, fingerprint
-> (template, place).  All grams of a document are looked up in it, so a run of
``gram + window - 1`` equal words is always noticed: three, and a match at a
threshold of 0.75 that has no words between has such a run.  A template of fewer than
``short`` words is noticed by single words too, by so many of its rarest that a
match at the threshold has at least one of them.  Each diagonal with a hit is a
candidate if enough words of the template stand about it; there the template is
aligned to the document (local alignment, gaps within a band), and the share of
its words that match and the stretch of the document they span are reported
when the share reaches ``least_coverage``.  What is left before and behind such
a stretch is aligned again.  A find needs the words that tell its license from
others (``DISTINCT``: version, NC, SA ..), in the stretch or as near as its
missing words may be.  Of finds of different licenses the better one wins where
it covers half of the other; an exact one always stays.

The templates are a fixed few kilobytes; documents are scanned where they lie,
without a shuffle.

Defined results: null and empty texts have no matches; a template found at
several places is reported at each, overlapping finds of one template once, the
better one (ties: the earlier); repeated rows are scanned alike; an empty table
gives an empty table; other columns pass unchanged.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import LOWER, Words, ragged, slices, window_hash, words_of
from .license_templates import DISTINCT, TEMPLATES

P = "lic__"


@dataclass(frozen=True)
class Settings:
    gram: int = 2
    window: int = 2
    band: int = 8
    least_coverage: float = 0.75
    #: Templates of fewer words are looked for by single words as well.
    short: int = 30


_PLAIN = np.zeros(256, bool)  # bytes that are no ASCII punctuation or control
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = _PLAIN[128:] = True


def bare_words(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words without punctuation around them; each one's place among all
    words of the slice; its hash in lower case."""
    w = words_of(texts)
    if not len(w.start):
        return w, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(w.data))
    plain = _PLAIN[w.data]
    following = np.minimum.accumulate(np.where(plain, at, len(at))[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(plain, at, -1))
    start, end = np.minimum(following[w.start], w.end), preceding[w.end - 1] + 1
    kept = np.flatnonzero(end > start)
    bare = w._replace(start=start[kept], end=end[kept], first=np.searchsorted(kept, w.first))
    return bare, kept, bare.hashes(LOWER[w.data])


@dataclass(frozen=True)
class Index:
    names: tuple[str, ...]
    words: tuple[np.ndarray, ...]
    keys: np.ndarray  # fingerprints in order
    template: np.ndarray
    place: np.ndarray
    #: The same for single words of short templates.
    one_keys: np.ndarray
    one_template: np.ndarray
    one_place: np.ndarray
    #: All words of the templates in order, and for each template which are its own (none for what is behind).
    vocabulary: np.ndarray
    own: np.ndarray
    needs: tuple[tuple[tuple[int, ...], ...], ...]
    excludes: tuple[tuple[int, ...], ...]


@lru_cache(maxsize=8)
def index_of(templates: tuple[tuple[str, str], ...], s: Settings) -> Index:
    found: set[tuple[int, int, int]] = set()
    words = []
    for t, (_, text) in enumerate(templates):
        _, _, word = bare_words(pa.array([text]))
        words.append(word)
        grams = window_hash(word, s.gram)
        for a in range(max(1, len(grams) - s.window + 1)):
            part = grams[a : a + s.window]
            if len(part):
                best = a + int(len(part) - 1 - part[::-1].argmin())  # the last of equals, as winnowing has it
                found.add((int(grams[best]), t, best))
    vocabulary, uses = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_counts=True)
    own = np.zeros((len(templates), len(vocabulary) + 1), bool)
    single: set[tuple[int, int, int]] = set()
    for t, word in enumerate(words):
        number = np.searchsorted(vocabulary, word)
        own[t, number] = True
        if len(word) < s.short:
            spare = len(word) - least_words(len(word), s)  # so many words may be missing
            rare = np.argsort(uses[number], kind="stable")[: spare + 1]
            single |= {(int(word[i]), t, int(i)) for i in rare}
    columns = [np.array([r[i] for r in sorted(x)], kind) for x in (found, single) for i, kind in enumerate((np.uint64, np.int64, np.int64))]
    # The distinguishing words belong to the texts of the bank, not to another text of that name.
    told = [DISTINCT.get(n, ((), ())) if TEMPLATES.get(n) == text else ((), ()) for n, text in templates]
    hashes = lambda some: tuple(int(bare_words(pa.array([x]))[2][0]) for x in some)
    needs, excludes = tuple(tuple(map(hashes, a)) for a, _ in told), tuple(hashes(b) for _, b in told)
    return Index(tuple(n for n, _ in templates), tuple(words), *columns, vocabulary, own, needs, excludes)


def least_words(n: int, s: Settings) -> int:
    """Words of a template of n that have to match."""
    return max(1, math.ceil(s.least_coverage * n - 1e-9))


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(matching words, first, behind the last) of the best local alignment of
    the template with ``text`` where text place - template place stays within
    ``band`` of ``diagonal``.  Match 2, mismatch and gap -1."""
    n, width = len(text), 2 * band + 1
    empty = (0, 0, 0)  # score, matches, first word
    above: list[tuple[int, int, int]] = [empty] * (width + 1)
    best, where = empty, (0, 0)
    for i, word in enumerate(template.tolist()):
        row: list[tuple[int, int, int]] = [empty] * (width + 1)
        for k in range(width):
            j = i + diagonal - band + k
            if not 0 <= j < n:
                continue
            score, matches, first = above[k]  # diagonal step: same k in the row above
            if word == text[j]:
                cell = (score + 2, matches + 1, first if score else j)
            else:
                cell = (score - 1, matches, first)
            up, left = above[k + 1], row[k - 1] if k else empty
            cell = max(cell, (up[0] - 1, up[1], up[2]), (left[0] - 1, left[1], left[2]), key=lambda c: (c[0], c[1]))
            row[k] = cell if cell[0] > 0 else empty
            if row[k][0] > best[0]:
                best, where = row[k], (i, j)
        above = row
    return best[1], best[2], where[1] + 1


def _region(diagonal, n, s: Settings):
    """Where an alignment of n words within the band of a diagonal may lie."""
    return diagonal - 2 * s.band, diagonal + n + 2 * s.band + 1


def _distinct(index: Index, t: int, text: np.ndarray, n: int, a: int, b: int) -> bool:
    """Whether the words that tell the template's license stand in text[a:b],
    or as far from it as the words that did not match."""
    missing = len(index.words[t]) - n
    about = set(text[max(0, a - missing) : b + missing].tolist())
    return all(about.intersection(some) for some in index.needs[t]) and not set(text[a:b].tolist()).intersection(index.excludes[t])


def matches(texts: pa.Array, index: Index, s: Settings) -> list[list[dict]]:
    """Per document: license, coverage and the span in words and code points."""
    w, place, word = bare_words(texts)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    doc = w.doc()
    seeds: set[tuple[int, int, int]] = set()
    for width, keys, template, at in (
        (s.gram, index.keys, index.template, index.place), (1, index.one_keys, index.one_template, index.one_place)
    ):
        grams = window_hash(word, width) if width > 1 else word
        low = np.searchsorted(keys, grams)
        hit = np.flatnonzero(np.append(keys, np.uint64(0))[low] == grams) if len(keys) else np.zeros(0, np.int64)
        hit = hit[doc[hit] == doc[hit + width - 1]]
        low = low[hit]
        times = np.searchsorted(keys, grams[hit], "right") - low
        hit, x = np.repeat(hit, times), ragged(low, times)
        t = template[x]
        # Too few of the template's words in the region, too few to match.
        lo, hi = _region(hit - at[x], np.array([len(v) for v in index.words], np.int64)[t], s)
        lo, hi = np.clip(lo, w.first[doc[hit]], w.first[doc[hit] + 1]), np.clip(hi, w.first[doc[hit]], w.first[doc[hit] + 1])
        near = np.searchsorted(index.vocabulary, word)
        near[np.append(index.vocabulary, np.uint64(0))[near] != word] = len(index.vocabulary)
        for one in np.unique(t).tolist():
            mine = np.flatnonzero(t == one)
            upto = np.concatenate([[0], np.cumsum(index.own[one][near])])
            mine = mine[upto[hi[mine]] - upto[lo[mine]] >= least_words(len(index.words[one]), s)]
            d = doc[hit[mine]]
            seeds |= {(int(a), one, int(b)) for a, b in zip(d, hit[mine] - w.first[d] - at[x[mine]])}
    if not seeds:
        return out
    all_words = np.searchsorted(words_of(texts).start, w.text_start)  # each text's first word
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for d, t, diagonal in sorted(seeds):
        text = word[w.first[d] : w.first[d + 1]]
        lo, hi = _region(diagonal, len(index.words[t]), s)
        spans = found.setdefault((d, t), [])
        todo = [(max(0, lo), min(hi, len(text)))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo < least_words(len(index.words[t]), s):
                continue
            n, a, b = align(index.words[t], text[lo:hi].tolist(), diagonal - lo, s.band)
            if n >= least_words(len(index.words[t]), s) and _distinct(index, t, text, n, lo + a, lo + b):
                spans.append((n, lo + a, lo + b))
            if n >= least_words(len(index.words[t]), s):
                todo += [(lo, lo + a), (lo + b, hi)]  # another copy may be as near
    kept: dict[int, list[tuple[float, int, int, int, int]]] = {}
    for (d, t), spans in sorted(found.items()):
        taken: list[tuple[int, int]] = []
        for n, a, b in sorted(set(spans), key=lambda x: (-x[0], x[1], x[2])):
            if any(a < y and x < b for x, y in taken):
                continue
            taken.append((a, b))
            kept.setdefault(d, []).append((n / len(index.words[t]), n, t, a, b))
    for d, finds in kept.items():
        better: list[tuple[str, int, int]] = []
        for coverage, n, t, a, b in sorted(finds, key=lambda x: (-x[0], -x[1], x[3], x[2])):
            name = index.names[t].partition("/")[0]
            if coverage < 1 and any(other != name and 2 * (min(b, y) - max(a, x)) >= b - a for other, x, y in better):
                continue
            better.append((name, a, b))
            f, g = w.first[d] + a, w.first[d] + b - 1
            out[d].append(
                {
                    "license": name, "template": index.names[t], "coverage": coverage, "matched_words": n,
                    "first_word": int(place[f] - all_words[d]), "last_word": int(place[g] - all_words[d]),
                    "start": int(points[w.start[f]] - points[w.text_start[d]]), "end": int(points[w.end[g]] - points[w.text_start[d]]),
                }
            )
    for row in out:
        row.sort(key=lambda m: (m["start"], m["template"]))
    return out


_FIELDS = [
    ("license", pa.string(), StringType()), ("template", pa.string(), StringType()), ("coverage", pa.float64(), DoubleType()),
    *[(c, pa.int64(), LongType()) for c in ("matched_words", "first_word", "last_word", "start", "end")],
]


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, s: Settings = Settings(), text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``lic__matches``: license, template, coverage,
    matched words, first and last word, start and end in code points."""
    names = [c for c in docs.columns if keep_text or c != text_col]
    kind = pa.list_(pa.struct([(c, t) for c, t, _ in _FIELDS]))
    wanted = tuple(templates.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(wanted, s)
        for part in slices(batches, text_col):
            found = pa.array(matches(part.column(text_col), index, s), kind)
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [found], names=names + [P + "matches"])

    row = StructType([StructField(c, t) for c, _, t in _FIELDS])
    return docs.mapInArrow(run, StructType([docs.schema[c] for c in names] + [StructField(P + "matches", ArrayType(row))]))


def digest(docs: DataFrame) -> DataFrame:
    found = F.col(P + "matches")
    return scan(docs.select("doc_id", "text"), keep_text=False).select(
        "doc_id",
        F.size(found).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform(found, lambda m: m["coverage"])), F.lit(0.0)).alias("best_coverage"),
        F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["template"], m["start"], m["end"])), ",").alias("spans"),
    )
