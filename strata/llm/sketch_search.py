"""Ranked lexical search with hashed max-sketches.

Terms are maximal runs of ASCII letters and digits and of characters beyond
ASCII; only A-Z are lower-cased.  A document's score for an item sums, over the
item's different terms, w * impact: w = floor(1000 ln((2N + 2) / (2 df + 1))),
impact = 10**9 tf div (1000 tf + 20 m), m = 50 + 50 n N div L, where N counts
the documents with a term, L their terms, n the document's and df the
documents that hold the term.

1. One pass counts N, L and the df of the items' terms.
2. A second pass folds each document's impacts, all its terms, into a sketch:
   a term's hash names one of ``coordinates`` and the greatest impact of each
   coordinate stays.  No impact of a term is greater than its coordinate's.
3. The items' weights, folded to coordinates too, times the sketches of a
   slice of documents give upper bounds of all scores at once.
4. Each item's documents are rescored exactly by descending bound until the
   bound falls below its k-th best score so far, which the task carries from
   slice to slice.  A task returns k documents an item, merged in two steps.

Items go through in blocks of bounded text, dealt by hash; each block reads the
documents again.  Terms are compared as bytes; hashes only make bounds.

Defined results: null texts and texts without terms match nothing and count
for nothing; an item without terms, or with none that scores, has no rows;
repeated documents rank each for itself; items repeated whole are one item;
equal scores rank by ascending doc_id, null ids last; empty tables give no
rows; other columns are ignored.
"""
from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices

#: Bytes of terms as they are compared; all others end a term.
_TERM = bytes(
    x if 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A or x >= 0x80 else x + 32 if 0x41 <= x <= 0x5A else 0x20 for x in range(256)
)


@dataclass(frozen=True)
class Settings:
    k: int = 50
    #: Coordinates of a sketch, a power of two.
    coordinates: int = 1_024
    #: A block of items: so many, and so many bytes of text, on average.
    block_items: int = 1_000
    block_bytes: int = 8 << 20
    #: Groups in which the tasks' results are merged first.
    merges: int = 64


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM).split()


def _binary(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


@dataclass(frozen=True)
class Collection:
    """Documents with terms, all their terms, and the df of the items' terms."""

    n: int
    length: int
    df: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return math.floor(1000 * math.log((2 * self.n + 2) / (2 * self.df[term] + 1)))

    def norm(self, n: int) -> int:
        return 50 + 50 * n * self.n // self.length


def collection(docs: DataFrame, wanted: frozenset[bytes]) -> Collection:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = length = 0
        df: Counter[bytes] = Counter()
        for part in slices(batches, "text"):
            for text in _binary(part.column("text")):
                found = terms(text)
                n += bool(found)
                length += len(found)
                df.update(wanted.intersection(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, None, *df], pa.binary()), pa.array([0, 1] + [2] * len(df), pa.int32()),
             pa.array([n, length, *df.values()], pa.int64())],
            names=["term", "what", "count"],
        )

    counts = docs.select("text").mapInArrow(run, "term binary, what int, count long")
    # One row for each term of the block of items, and two.
    rows = counts.groupBy("what", "term").agg(F.sum("count").alias("count")).collect()
    total = {r["what"]: r["count"] for r in rows if r["what"] < 2}
    return Collection(total.get(0, 0), total.get(1, 0), {bytes(r["term"]): r["count"] for r in rows if r["what"] == 2})


def impact(tf, m):
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def sketches(counts: list[Counter[bytes]], norms: list[int], s: Settings) -> np.ndarray:
    """(documents, coordinates): greatest impact of the terms of each coordinate."""
    size = np.array([len(c) for c in counts], np.int64)
    tf = np.fromiter((x for c in counts for x in c.values()), np.int64, int(size.sum()))
    at = np.fromiter((hash(t) for c in counts for t in c), np.int64, len(tf)) & (s.coordinates - 1)
    doc = np.repeat(np.arange(len(counts)), size)
    out = np.zeros((len(counts), s.coordinates))
    np.maximum.at(out, (doc, at), impact(tf, np.array(norms, np.int64)[doc]))
    return out


def _search(docs: DataFrame, items: list[tuple[object, dict[bytes, int]]], kept: Collection, kinds: tuple[str, str], s: Settings) -> DataFrame:
    """item (its number in ``items``), doc_id, score: k documents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros((s.coordinates, len(items)))
        for i, (_, query) in enumerate(items):
            for t, w in query.items():
                weights[hash(t) & (s.coordinates - 1), i] += w
        top: list[list[tuple]] = [[] for _ in items]
        theta = np.ones(len(items))  # a score above 0 is wanted
        for part in slices(batches, "text"):
            found = [(i, f) for i, f in enumerate(map(terms, _binary(part.column("text")))) if f]
            if not found:
                continue
            ids = part.column("doc_id").take(pa.array([i for i, _ in found])).to_pylist()
            counts = [Counter(f) for _, f in found]
            norms = [kept.norm(len(f)) for _, f in found]
            bounds = sketches(counts, norms, s) @ weights  # sums of integers below 2**53
            for i in np.flatnonzero((bounds >= theta).any(0)):
                query, best, bound = items[i][1], top[i], bounds[:, i]
                open_ = np.flatnonzero(bound >= theta[i])
                for d in open_[np.argsort(-bound[open_], kind="stable")].tolist():
                    if bound[d] < theta[i]:
                        break
                    count, m = counts[d], norms[d]
                    score = sum(w * impact(count[t], m) for t, w in query.items() if t in count)
                    if score:
                        insort(best, (-score, ids[d] is None, ids[d]))
                        del best[s.k :]
                    if len(best) == s.k:
                        theta[i] = -best[-1][0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, b in enumerate(top) for _ in b], pa.int64()),
             pa.array([x[2] for b in top for x in b], id_type), pa.array([-x[0] for b in top for x in b], pa.int64())],
            names=["item", "doc_id", "score"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    return docs.mapInArrow(run, f"item long, doc_id {kinds[1]}, score long")


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", s: Settings = Settings(),
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    kinds = tuple(x.dataType.simpleString() for x in (asked.schema["item_id"], docs.schema["doc_id"]))
    n, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // s.block_items), -(-(size or 0) // s.block_bytes))
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        split = [(r["item_id"], sorted(set(terms((r["text"] or "").encode())))) for r in rows]
        split = [(i, found) for i, found in split if found]
        if not split:
            continue
        kept = collection(docs, frozenset(t for _, found in split for t in found))
        queries = [(i, {t: kept.weight(t) for t in found if t in kept.df}) for i, found in split]
        if max(sum(q.values()) for _, q in queries) * 1_000_000 >= 1 << 53:
            raise ValueError("scores exceed exact sums")
        found = _search(docs, queries, kept, kinds, s)
        first = Window.partitionBy("item", "part").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        last = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        some = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(s.merges)))
        some = some.withColumn("place", F.row_number().over(first)).where(F.col("place") <= s.k)
        best = saved(some.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= s.k).select("item", "rank", "doc_id", "score"))
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(queries)], f"item long, item_id {kinds[0]}")
        out = out.union(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked(docs, items)
