"""Exact top-k by integer inner product, with MaxScore bounds.

Components become integers floor(scale * x).  The candidates are dealt out to
shards and the queries to blocks; a task meets one block with one shard and
both are bounded.  A query's terms are the components, and the most a term can
add to any candidate of the shard is its bound.  With a threshold from some
full scores, the terms whose bounds together stay under it are non-essential:
no candidate gets in by them alone.  The essential terms are traversed for all
candidates; the others are probed, largest bounds first, only for candidates
that the remaining bounds still let in.  The shards' results are merged by a
window over each query.

Sums are exact: floating-point products are used only where the bounds prove
that every partial sum is an integer below 2**24 or 2**53.

Defined results: a null vector, or one with null or non-finite components,
takes no part; a shorter vector counts as filled up with 0; rows with the
query's own id are never its candidates, other repeated rows are candidates
each; ties go to the smaller id, null ids last; null ids are never queries; a
query with fewer candidates than k has all; an empty table has no results.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


@dataclass(frozen=True)
class Settings:
    k: int = 20
    scale: float = 64.0
    shard_rows: int = 16_384
    block_queries: int = 4_096
    #: Terms probed between two looks at the bounds.
    step: int = 8
    #: Share of competitive candidates under which they are probed one by one.
    sparse: float = 0.02


def _matrix(rows: pa.ChunkedArray) -> np.ndarray:
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    n = np.asarray(lists.value_lengths()).astype(np.int64)
    flat = np.asarray(lists.flatten())
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), np.int64)
    out[np.arange(out.shape[1])[None, :] < n[:, None]] = flat
    return out


def _number_kind(q: np.ndarray, x: np.ndarray) -> type:
    """A type in which all partial sums of products are exact."""
    most = sum(int(a) * int(b) for a, b in zip(np.abs(q).max(0), np.abs(x).max(0)))
    if most >= 1 << 62:
        raise ValueError("inner products exceed 64-bit integers")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def search(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, candidate's row, score) of each query's k best here."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    kind = _number_kind(q, x)
    high, low = x.max(0), x.min(0)
    bound = np.maximum(q * high, q * low)  # the most a term can add
    order = np.argsort(-np.abs(bound).sum(0), kind="stable")  # strong terms first
    q, x, bound = q[:, order].astype(kind), np.ascontiguousarray(x[:, order]).astype(kind), bound[:, order]
    rest = np.zeros((len(q), width + 1), np.int64)  # rest[:, j]: bounds of the terms from j on
    rest[:, :-1] = np.cumsum(bound[:, ::-1], 1)[:, ::-1]

    # A first threshold: the k-th best of some candidates' full scores.
    some = min(len(x), 64 * s.k)
    first = q @ x[:some].T
    first = np.where(q_ids[:, None] == x_ids[None, :some], -np.inf, first)
    theta = np.full(len(q), -np.inf)
    if some > s.k:
        theta = np.partition(first, some - s.k, 1)[:, some - s.k]

    essential = np.where(rest <= theta[:, None], 0, 1).sum(1)  # terms before the rest falls to the threshold
    essential = np.minimum(-(-essential // s.step) * s.step, width)
    out: list[tuple[np.ndarray, ...]] = []
    by_split = np.argsort(essential, kind="stable")
    for part in np.array_split(by_split, max(1, len(by_split) // 64)):
        if not len(part):
            continue
        at = int(essential[part].max())
        score = q[part, :at] @ x[:, :at].T
        open_ = score >= (theta[part] - rest[part, at])[:, None]
        # While many candidates stay competitive, the next terms are cheaper traversed than probed.
        while at < width and open_.mean() > s.sparse:
            to = min(at + s.step, width)
            score += q[part, at:to] @ x[:, at:to].T
            at = to
            open_ = score >= (theta[part] - rest[part, at])[:, None]
        row, col = np.nonzero(open_)
        row, value = part[row], score[row, col]
        while at < width and len(row):
            to = min(at + s.step, width)
            value = value + (q[row, at:to] * x[col, at:to]).sum(1)
            at = to
            keep = value + rest[row, at] >= theta[row]
            row, col, value = row[keep], col[keep], value[keep]
        own = q_ids[row] == x_ids[col]
        row, col, value = row[~own], col[~own], value[~own].astype(np.int64)
        rank = np.lexsort((x_ids[col], -value, row))
        row, col, value = row[rank], col[rank], value[rank]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        out.append(tuple(v[place < s.k] for v in (row, col, value)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(v) for v in zip(*out))


def integers(vector: Column, s: Settings) -> Column:
    """floor(scale * x) of each component; null if a component is no finite number."""
    fine = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda v: F.floor(F.lit(s.scale) * v.cast("double"))))


def nearest(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", s: Settings = Settings()
) -> DataFrame:
    """query_id, rank (from 1), id, score: for the rows that ``queries``
    marks, the k best of all other rows."""
    whole = vectors.select(
        F.col(id_col).alias("id"), integers(F.col(vector_col), s).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where("v is not null")
    # Rows repeated whole are one candidate that counts k times at most.
    whole = saved(whole.groupBy("id", "v", "asks").agg(F.least(F.count(F.lit(1)), F.lit(s.k)).cast("int").alias("times")))
    n, n_queries = whole.agg(F.count(F.lit(1)), F.sum(F.when(F.col("asks") & F.col("id").isNotNull(), 1).otherwise(0))).first()
    shards, blocks = max(1, -(-n // s.shard_rows)), max(1, -(-(n_queries or 0) // s.block_queries))
    deal = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "id", "v"), F.lit(parts))
    cell = lambda shard, block: (shard * blocks + block).cast("long")
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    # Equal rows of one query id ask the same: one of them asks.
    asked = whole.where("asks and id is not null").dropDuplicates(["id", "v"]).withColumn("shard", every(shards)).select(
        cell(F.col("shard"), deal(1, blocks)).alias("cell"), "id", "v"
    )
    stored = whole.withColumn("block", every(blocks)).select(cell(deal(2, shards), F.col("block")).alias("cell"), "id", "v", "times")

    def run(ask: pa.Table, have: pa.Table) -> pa.Table:
        ids = have["id"].to_numpy(zero_copy_only=False) if not have["id"].null_count else None
        names = ["query_id", "id", "score", "times"]
        kinds = [pa.int64()] * 3 + [pa.int32()]
        if not ask.num_rows or not have.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        if ids is None:  # null ids sort last among equals and are nobody's own
            ids = np.asarray(have["id"].fill_null(np.iinfo(np.int64).max))
        row, col, score = search(
            np.asarray(ask["id"]), _matrix(ask["v"]), np.asarray(ids), _matrix(have["v"]), s
        )
        col_ = pa.array(col)
        return pa.table([ask["id"].take(pa.array(row)), have["id"].take(col_), pa.array(score), have["times"].take(col_)], names=names)

    found = asked.groupBy("cell").cogroup(stored.groupBy("cell")).applyInArrow(run, "query_id long, id long, score long, times int")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k).select("query_id", "rank", "id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    found = nearest(vectors, F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
