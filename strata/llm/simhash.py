"""SimHash near-duplicates by multi-index hashing.

A document's shingles are its runs of four words (A-Z lower-cased, joined by
one space; the whole sequence if it has fewer), repeats included.  Each gets
its XXH64; a fingerprint's bit is 1 if it is set in more than half of them.
Documents link when their fingerprints differ in at most 4 of the 64 bits.
The result is each document's connected component.

1. Equal fingerprints are one node.
2. The 64 bits are cut into segments, each with a table from its value to the
   fingerprints that have it.  With distance r = m * a + b over m segments, two
   linked fingerprints differ by at most a bits in one of the first b + 1
   segments or by at most a - 1 in one of the others, so a fingerprint looks up
   the Hamming ball of that radius around each of its segments.  It asks at
   greater values only: each pair of values has one asker.
3. What a table's cell holds is compared with itself and with who asks there,
   by the complete distance.  A task returns its links as stars around the
   smallest fingerprint, never as pairs.
4. A cell with more rows than a task should hold is dealt into blocks that
   meet two by two.  Beyond ``widest`` rows pairs are found without comparing
   rows at all: two fingerprints at distance 4 or less have a common midpoint
   at distance 2 or less of both, and any two that share a midpoint link, so
   everyone who names a midpoint links to the smallest who does.
5. Links become components by star contraction (``components``).

Three segments (22, 21 and 21 bits, radii 1, 1 and 0) put some 24 rows of a
few bytes a fingerprint into the tables and leave a thousandth of a percent of
the fingerprints in an average cell.

Defined results: texts that are null or without words have fingerprint zero
and link like any other; equal rows link; a null doc_id is never the smallest
(a component of null ids only has none); an empty table gives an empty table;
other columns are ignored.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, ragged, saved, signed, slices
from .components import components

BITS = 64
_LOWER = LOWER.tobytes()


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    seed: int = 42
    #: Differing bits of a link; an even number.
    distance: int = 4
    segments: int = 3
    #: Rows of a cell's block; a task meets two blocks.
    block: int = 4_096
    #: Rows beyond which a cell's links are found by midpoints.
    widest: int = 1 << 18
    #: Rows of small cells a task looks at together, and pairs compared at once.
    chunk_rows: int = 100_000
    chunk_pairs: int = 1 << 20


def fingerprint(text: bytes | None, s: Settings = Settings()) -> int:
    words = (text or b"").translate(_LOWER).split()  # splits at the six ASCII spaces
    if not words:
        return 0
    joined, length = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    n = max(1, len(words) - s.shingle + 1)
    count = np.zeros(BITS, np.int64)
    hash_of, seed = xxhash.xxh64_intdigest, s.seed
    for i in range(0, n, 1 << 15):
        to = min(i + (1 << 15), n)
        ranges = zip(start[i:to].tolist(), end[len(words) - n + i : len(words) - n + to].tolist())
        h = np.array([hash_of(joined[a:b], seed) for a, b in ranges], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """doc_id, fp (the 64 bits as a bigint) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text").cast(pa.large_binary() if pa.types.is_large_string(part.schema.field("text").type) else pa.binary())
            found = np.array([fingerprint(t.as_py(), s) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(signed(found))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` of them set."""
    return [sum(1 << i for i in some) for r in range(radius + 1) for some in itertools.combinations(range(width), r)]


def tables(s: Settings) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment that is looked up."""
    least, rest = divmod(s.distance, s.segments)
    edge = [round(BITS * i / s.segments) for i in range(s.segments + 1)]
    radii = [least if i <= rest else least - 1 for i in range(s.segments)]
    return [(a, b - a, r) for a, b, r in zip(edge, edge[1:], radii) if r >= 0]


def cells(fps: DataFrame, s: Settings) -> DataFrame:
    """fp, cell, stored: where a fingerprint is kept, and where it asks."""

    def visits(k: int, first: int, width: int, radius: int) -> Column:
        value = F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)
        near = F.transform(F.array(*[F.lit(x).cast("long") for x in ball(width, radius)]), lambda x: value.bitwiseXOR(x))
        near = F.filter(near, lambda v: v >= value)
        return F.transform(near, lambda v: F.struct((v + F.lit(k << 40)).alias("cell"), (v == value).alias("stored")))

    at = F.explode(F.concat(*[visits(k, *t) for k, t in enumerate(tables(s))]))
    return fps.select("fp", at.alias("at")).select("fp", "at.cell", "at.stored")


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a and b; a label is its component's first row."""
    while True:
        x, y = label[a], label[b]
        unlike = x != y
        if not unlike.any():
            return
        a, b, x, y = a[unlike], b[unlike], x[unlike], y[unlike]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def stars(fp: np.ndarray, group: np.ndarray, stored: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links within each group, every linked row to its component's first;
    rows are sorted by group, stored ones first."""
    n = len(fp)
    label = np.arange(n)
    last = np.searchsorted(group, group, "right")
    rows = np.flatnonzero(stored & (last > np.arange(n) + 1))
    pairs = np.cumsum(last[rows] - rows - 1)
    at = 0
    while at < len(rows):
        done = pairs[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(pairs, done + s.chunk_pairs, "right")))
        some = rows[at:to]
        count = last[some] - some - 1
        a, b = np.repeat(some, count), ragged(some + 1, count)
        near = np.bitwise_count(fp[a] ^ fp[b]) <= s.distance
        _join_labels(label, a[near], b[near])
        at = to
    joined = np.flatnonzero(label != np.arange(n))
    return fp[joined], fp[label[joined]]


def _compare(placed: DataFrame, s: Settings) -> DataFrame:
    """(a, b) links of rows that are sorted by (cell, one, two)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            *key, stored, fp = rows
            new = np.ones(len(fp), bool)
            if len(fp):
                new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
            a, b = stars(fp.view(np.uint64), np.cumsum(new), stored, s)
            return pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b))], names=["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "one", "two", "stored", "fp")))
            size += batch.num_rows
            if size < s.chunk_rows:
                continue
            whole = tuple(np.concatenate(c) for c in zip(*held))
            cell, one, two = whole[:3]
            open_ = np.flatnonzero((cell == cell[-1]) & (one == one[-1]) & (two == two[-1]))[0]  # the last group may go on
            if open_:
                yield links(tuple(c[:open_] for c in whole))
            held, size = [tuple(c[open_:] for c in whole)], len(cell) - open_
        if size:
            yield links(tuple(np.concatenate(c) for c in zip(*held)))

    order = ["cell", "one", "two"]
    dealt = placed.repartition(*order).sortWithinPartitions(*order, F.desc("stored"), "fp")
    return dealt.mapInArrow(run, "a long, b long")


def midpoint_links(fps: DataFrame, s: Settings) -> DataFrame:
    """(a, b) links among fingerprints without comparing them.  No midpoint
    has more neighbours than its ball has members."""
    if s.distance % 2:
        raise ValueError("midpoints need an even distance")
    masks = [x - (1 << BITS) if x >> (BITS - 1) else x for x in ball(BITS, s.distance // 2)]
    near = F.transform(F.array(*[F.lit(x).cast("long") for x in masks]), lambda x: F.col("fp").bitwiseXOR(x))
    named = fps.select("fp", F.explode(near).alias("midpoint"))
    least = named.groupBy("midpoint").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most")
    return named.join(least, "midpoint").where("fp != b").select(F.col("fp").alias("a"), "b")


def links(fps: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(a, b): links that connect what the links of all pairs connect."""
    rows = cells(fps, s)
    large = saved(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > s.block))
    most = large.agg(F.max("members")).first()[0] or 0
    placed = rows.join(large, "cell", "left").where(F.coalesce("members", F.lit(0)) <= s.widest)
    blocks = F.ceil(F.coalesce("members", F.lit(1)) / s.block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (x != F.col("own")) | (F.col("blocks") == 1))
    placed = (
        placed.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(other))
        .select("cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "stored", "fp")
    )
    found = _compare(placed, s)
    if most > s.widest:
        crowd = rows.join(large.where(F.col("members") > s.widest), "cell").select("fp").distinct()
        found = found.union(midpoint_links(crowd, s))
    return found


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """doc_id, fp, component_id of every row."""
    rows = saved(fingerprints(docs, id_col, text_col, s))
    fps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(fps.select("fp"), s)).toDF("fp", "root")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = saved(rooted.join(smallest, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
