"""Vector codes: each part of a vector becomes the number of its nearest
codebook entry.

Components are the integers floor(scale * x); a vector is cut into equal parts
and every part position has a codebook of its own, fitted by rounds of exact
integer k-means that begin with the vectors of the smallest ids.

1. The parts of each position are sorted along a Hilbert curve (range
   partitions, sorted within) and cut into flat blocks.  A block stores its
   points, how often each stands for a vector, their box (least and greatest
   components) and their sums.  Equal points of a task are one point.
2. A round reads the blocks.  For each entry the box gives the least and the
   greatest squared distance any point of the block can have; entries that are
   farther at least than another is at most are off the block's shortlist.
   A shortlist of one takes the block's sums as they are; the others are
   evaluated point by point, for the shortlisted entries only, in 64-bit
   integers.  The driver gets one sum for each entry's component.
3. The codes are assigned vector by vector, a task's stretch of rows in such
   blocks again.

Defined results: a null vector, or one with null or non-finite components, is
dropped; a shorter vector counts as filled up with 0 to the longest (and that
to a multiple of the number of parts); ids order the first entries, null ids
last, equal ids by their vectors, and every row counts; with fewer rows than
entries the codebooks have as many; ties go to the lower index; an unused
entry stays; null labels are one label; an empty table has no codes.
Components beyond 2**28 are refused: their distances exceed 64 bits.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, saved


@dataclass(frozen=True)
class Settings:
    scale: float = 4096.0
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    #: Points of a block.
    block: int = 64
    #: Bits of a Hilbert key, at least one for each component.
    key_bits: int = 64
    #: Vectors a task sorts together.
    chunk: int = 16_384


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """(points, bytes): places along the Hilbert curve of (points, dimensions)
    cells below 2**bits, as big-endian bytes (Skilling's transform)."""
    axes = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        high, below = 1 << level, (1 << level) - 1
        for axis in axes:
            up = (axis & high) != 0
            swap = np.where(up, 0, (axes[0] ^ axis) & below)
            axis ^= swap
            axes[0] ^= np.where(up, below, swap)
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    spread = [((axis ^ turn) >> level) & 1 for level in range(bits - 1, -1, -1) for axis in axes]
    return np.packbits(np.stack(spread, 1).astype(np.uint8), axis=1)


@dataclass(frozen=True)
class Space:
    """What all tasks agree on: components of a part and their range."""

    dims: int
    low: int
    high: int

    def keys(self, points: np.ndarray, s: Settings) -> np.ndarray:
        bits = max(1, min(16, s.key_bits // self.dims))
        wide = max(1, self.high - self.low)
        return hilbert_keys((points - self.low) * ((1 << bits) - 1) // wide, bits)


def boxes(points: np.ndarray, weights: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """(first point, least, greatest, weighted sums, weight) of the blocks of sorted points."""
    first = np.arange(0, len(points), s.block)
    return (
        first, np.minimum.reduceat(points, first), np.maximum.reduceat(points, first),
        np.add.reduceat(points * weights[:, None], first), np.add.reduceat(weights, first),
    )


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(blocks, entries): which entries may be nearest to a point of the box."""
    outside = np.maximum(np.maximum(low[:, None] - book, book - high[:, None]), 0)
    across = np.maximum(np.abs(book - low[:, None]), np.abs(high[:, None] - book))
    return (outside * outside).sum(2) <= (across * across).sum(2).min(1)[:, None]


def nearest(points: np.ndarray, book: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each point's nearest listed entry."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    entry = np.zeros(len(points), np.int64)
    for k in np.flatnonzero(listed):
        away = points - book[k]
        far = np.einsum("ij,ij->i", away, away)
        less = far < best
        best[less], entry[less] = far[less], k
    return entry, best


def by_shortlist(lists: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entries listed, blocks) of blocks that have the same shortlist."""
    kinds, which = np.unique(lists, axis=0, return_inverse=True)
    for k, listed in enumerate(kinds):
        yield listed, np.flatnonzero(which.reshape(-1) == k)


def encode(points: np.ndarray, book: np.ndarray, space: Space, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point, in Hilbert-sorted blocks."""
    order = np.lexsort(space.keys(points, s).T[::-1])
    sorted_ = points[order]
    first, low, high, *_ = boxes(sorted_, np.ones(len(points), np.int64), s)
    block = np.arange(len(points)) // s.block
    entry, error = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for listed, blocks in by_shortlist(shortlists(low, high, book)):
        of = np.zeros(len(first), bool)
        of[blocks] = True
        rows = np.flatnonzero(of[block])
        entry[order[rows]], error[order[rows]] = nearest(sorted_[rows], book, listed)
    return entry, error


def integers(vector: Column, s: Settings) -> Column:
    """floor(scale * x) of each component; null if one is no finite number."""
    fine = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda v: F.floor(F.lit(s.scale) * v.cast("double"))))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    n = np.asarray(rows.value_lengths()).astype(np.int64)
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width)[None, :] < n[:, None]] = np.asarray(rows.flatten())
    return out


def _stretches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows some ``rows`` at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)
    give_back()


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as a binary column."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _numbers(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


BLOCK = "part int, points binary, weights binary, low binary, high binary, sums binary, weight long"


def sorted_blocks(kept: DataFrame, space: Space, s: Settings) -> DataFrame:
    """The blocks of all part positions, in the shared folder."""
    kind = "<i2" if -(1 << 15) <= space.low and space.high < 1 << 15 else "<i4"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _stretches(batches, s.chunk):
            vectors = _matrix(some.column("v"), s.parts * space.dims).reshape(-1, s.parts, space.dims)
            for part in range(s.parts):
                points, times = np.unique(vectors[:, part], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(points), part, np.int32)), _fixed(space.keys(points, s)),
                     _fixed(points.astype(kind)), pa.array(times.astype(np.int64))],
                    names=["part", "key", "point", "times"],
                )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, times = batch.column("part").to_numpy(), batch.column("times").to_numpy()
            points = _numbers(batch.column("point"), kind, space.dims)
            for part in np.unique(parts):
                mine = parts == part
                p, w = points[mine], times[mine]
                first, low, high, sums, weight = boxes(p, w, s)
                upto = np.append(first[1:], len(p))
                raw, heavy = p.astype(kind), w.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), part, np.int32)),
                     pa.array([raw[a:b].tobytes() for a, b in zip(first, upto)], pa.binary()),
                     pa.array([heavy[a:b].tobytes() if (heavy[a:b] != 1).any() else None for a, b in zip(first, upto)], pa.binary()),
                     _fixed(low), _fixed(high), _fixed(sums), pa.array(weight)],
                    names=["part", "points", "weights", "low", "high", "sums", "weight"],
                )

    rows = kept.select("v").mapInArrow(cut, "part int, key binary, point binary, times long")
    rows = rows.repartitionByRange("part", "key").sortWithinPartitions("part", "key", "point")
    return saved(rows.mapInArrow(build, BLOCK).withColumn("kind", F.lit(kind)))


def one_round(blocks: DataFrame, books: list[np.ndarray], space: Space, s: Settings) -> list[np.ndarray]:
    """The codebooks after one more round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((s.parts, s.entries, space.dims), np.int64)
        count = np.zeros((s.parts, s.entries), np.int64)
        for batch in batches:
            parts, weight = batch.column("part").to_numpy(), batch.column("weight").to_numpy()
            low, high, sums = (_numbers(batch.column(c), "<i8", space.dims) for c in ("low", "high", "sums"))
            kind = batch.column("kind")[0].as_py() if batch.num_rows else "<i4"
            for part in np.unique(parts):
                mine = np.flatnonzero(parts == part)
                for listed, blocks_ in by_shortlist(shortlists(low[mine], high[mine], books[part])):
                    at = mine[blocks_]
                    if listed.sum() == 1:  # the whole block goes to one entry
                        k = int(listed.argmax())
                        total[part, k] += sums[at].sum(0)
                        count[part, k] += weight[at].sum()
                        continue
                    of = pa.array(at)
                    raw = batch.column("points").take(of).to_pylist()
                    heavy = batch.column("weights").take(of).to_pylist()
                    n = [len(p) // (np.dtype(kind).itemsize * space.dims) for p in raw]
                    points = np.frombuffer(b"".join(raw), kind).reshape(-1, space.dims).astype(np.int64)
                    w = np.concatenate([np.ones(m, np.int64) if h is None else np.frombuffer(h, "<i8") for m, h in zip(n, heavy)])
                    entry, _ = nearest(points, books[part], listed)
                    np.add.at(total[part], entry, points * w[:, None])
                    np.add.at(count[part], entry, w)
        part, k, d = (x.ravel() for x in np.indices(total.shape))
        used = count[part, k] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used].astype(np.int64)) for x in (part, k, d, total[part, k, d], count[part, k])],
            names=["part", "entry", "d", "total", "count"],
        )

    sums = blocks.mapInArrow(run, "part long, entry long, d long, total long, count long")
    out = [book.copy() for book in books]
    # At most a row for each component of the codebooks.
    for r in sums.groupBy("part", "entry", "d").agg(F.sum("total").alias("total"), F.sum("count").alias("count")).collect():
        out[r["part"]][r["entry"], r["d"]] = r["total"] // r["count"]
    return out


def fit(kept: DataFrame, s: Settings) -> tuple[list[np.ndarray], Space] | None:
    """The codebooks of all part positions (None without vectors)."""
    longest, low, high = kept.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if longest is None:
        return None
    space = Space(max(1, -(-longest // s.parts)), min(low or 0, 0), max(high or 0, 0))
    if max(-space.low, space.high) > 1 << 28:
        raise ValueError("squared distances exceed 64-bit integers")
    width = s.parts * space.dims
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(s.entries).select("v").collect()
    start = np.array([r["v"] + [0] * (width - len(r["v"])) for r in first], np.int64).reshape(-1, s.parts, space.dims)
    books = [np.ascontiguousarray(start[:, p]) for p in range(s.parts)]
    blocks = sorted_blocks(kept, space, s)
    for _ in range(s.rounds):
        books = one_round(blocks, books, space, s)
    return books, space


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          s: Settings = Settings()) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code (hex), error) of every vector that is kept, and the codebooks."""
    kept = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), integers(F.col(vector_col), s).alias("v")
    ).where("v is not null")
    books, space = fit(kept, s) or ([], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _stretches(batches, s.chunk):
            points = _matrix(some.column("v"), s.parts * space.dims).reshape(-1, s.parts, space.dims)
            code, error = np.zeros((len(points), s.parts), np.uint8), np.zeros(len(points), np.int64)
            for part, book in enumerate(books):
                code[:, part], far = encode(points[:, part], book, space, s)
                error += far
            hexed = pa.array([c.tobytes().hex() for c in code], pa.string())
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), some.column("label"), hexed, pa.array(error)], names=["id", "label", "code", "error"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return kept.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long"), books


def digest(vectors: DataFrame) -> DataFrame:
    found, books = codes(vectors)
    found = saved(found)
    by_label = saved(found.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "of")
    named = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return found.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(hashlib.sha256(named.encode()).hexdigest()).alias("codebooks_sha256"),
    )
