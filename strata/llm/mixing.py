"""Mixing sources to target weights.

The size of a document is its number of words.  Sources, in code-point order
with null last, weigh 5, 2, 1, 5, 2, 1 ... and share ``share`` times all words;
none gets more than ``most_epochs`` times its own, the excess is shared again
by weight.

The documents of a source fall into blocks of about ``block_words`` words by a
hash.  A source's quota is a number of whole passes over its blocks, then
blocks in permuted order until the target is reached; in the last block the
documents with the smallest hashes, as near to the target as they come.  A
binary tree over the output shards splits the quotas: at each node the left
half's blocks per source are one multivariate hypergeometric draw from the
node's, so the leaves add up to the quotas exactly and each shard holds a
random mix.  Each shard takes its own stretch of every source's permuted
blocks, disjoint by construction, and puts its documents in random order.

Each draw is seeded by its node, each permutation by a hash: reruns agree.
The driver holds one row per source while these are ``driver_sources`` at
most; beyond, sources are ranked, given targets and joined on Spark, and the
tree is split by groups of sources first, then within a group, which is the
same distribution.  Blocks and shards always stay on the executors; the
blocks of a source are put in order within stretches of their hash, so no
task holds a whole source.

Defined results: a null or empty text has size 0 and follows its block; rows
with one doc_id are drawn alike; null sources are one source; a source without
words has target 0; an empty table gives an empty mix; other columns pass.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import WORD_PATTERN, saved, slices, word_counts

P = "mix__"  # columns of the plan beside the document's own


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most_epochs: int = 2
    block_words: int = 1 << 18
    shard_words: int = 1 << 22
    seed: int = 20240917
    #: Plans of up to this many blocks (about 100 bytes each) may be broadcast.
    broadcast_blocks: int = 100_000
    #: Sources (about 100 bytes each) the driver collects and broadcasts at most.
    driver_sources: int = 100_000
    #: Sources that are split together beyond that.
    group_sources: int = 4096


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Words to take from each source: by weight, at most ``most_epochs``
    times its size, what is cut off shared again among the others."""
    out = [0.0] * len(sizes)
    left = mix.share * sum(sizes)
    open_ = [i for i, size in enumerate(sizes) if size > 0]
    weight = lambda i: mix.weights[i % len(mix.weights)]
    while open_:
        total = sum(map(weight, open_))
        full = [i for i in open_ if left * weight(i) / total > mix.most_epochs * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weight(i) / total
            break
        for i in full:
            out[i] = float(mix.most_epochs * sizes[i])
        left -= sum(out[i] for i in full)
        closed = set(full)
        open_ = [i for i in open_ if i not in closed]
    return out


def ranked(totals: DataFrame) -> DataFrame:
    """source, n and rank (by code point, null last), no task holding all."""
    dealt = saved(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("pid", F.spark_partition_id()))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = dealt.groupBy("pid").agg(F.count(F.lit(1)).alias("in")).select("pid", F.coalesce(F.sum("in").over(before), F.lit(0)).alias("off"))
    local = F.row_number().over(Window.partitionBy("pid").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("local", local).join(F.broadcast(offsets), "pid").select("source", "n", (F.col("off") + F.col("local")).cast("int").alias("rank"))


def with_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``targets`` on Spark: a round is one aggregate, and what is shared again
    grows until no further source is full."""
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    sources = saved(sources.withColumn("weight", F.get(weights, F.col("rank") % len(mix.weights))))
    most = F.col("n") * mix.most_epochs
    some = sources.where("n > 0")
    words, open_weight = some.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    left, n_full = mix.share * words, -1
    while open_weight:
        full = F.lit(left) * F.col("weight") / F.lit(open_weight) > most
        now, cut, rest = some.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        if now in (0, n_full):
            break
        n_full, left, open_weight = now, mix.share * words - cut, rest
    share = F.lit(left) * F.col("weight") / F.lit(open_weight or 1.0)
    full = (share > most) if open_weight else F.lit(True)
    goal = F.when(F.col("n") == 0, F.lit(0.0)).when(full, most.cast("double")).otherwise(share)
    return sources.withColumn("target", goal)


def split_quotas(quota: np.ndarray, shards: int, first: int, last: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first unit per source, units per source) of shards first..last-1.

    Walks only the nodes above them; every walk draws the same at a node.
    """
    todo = [(0, shards, quota.astype(np.int64), np.zeros(len(quota), np.int64))]
    while todo:
        lo, hi, own, start = todo.pop()
        if hi <= first or lo >= last:
            continue
        if hi - lo == 1:
            yield lo, start, own
            continue
        mid = (lo + hi) // 2
        draw = np.random.default_rng([seed, lo, hi])
        n_left = int(own.sum()) * (mid - lo) // (hi - lo)
        left = draw.multivariate_hypergeometric(own, n_left, method="marginals")
        todo.append((mid, hi, own - left, start + left))
        todo.append((lo, mid, left, start))


def split_group(
    top: np.ndarray, group: int, quota: np.ndarray, shards: int, first: int, last: int, seed: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """As ``split_quotas`` for one group of sources out of many: (shard, index,
    first unit, units) of its sources that have some.  ``top`` holds the quota of
    each group; a node draws the left half's units of each group, then those of
    this group's sources.  Sources and groups that are used up are left out on
    the way down, so the work follows the units.
    """
    index = np.flatnonzero(quota)
    groups = np.flatnonzero(top)
    todo = [(0, shards, groups, top[groups].astype(np.int64), index, quota[index].astype(np.int64), np.zeros(len(index), np.int64))]
    while todo:
        lo, hi, groups, totals, index, own, start = todo.pop()
        if hi <= first or lo >= last or not len(own):
            continue
        if hi - lo == 1:
            yield lo, index, start, own
            continue
        mid = (lo + hi) // 2
        n_left = int(totals.sum()) * (mid - lo) // (hi - lo)
        shares = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(totals, n_left, method="marginals")
        n_own = int(shares[np.searchsorted(groups, group)])
        left = np.random.default_rng([seed, lo, hi, group + 1]).multivariate_hypergeometric(own, n_own, method="marginals")
        for a, b, of_groups, units, begin in ((mid, hi, totals - shares, own - left, start + left), (lo, mid, shares, left, start)):
            g, u = of_groups > 0, units > 0
            todo.append((a, b, groups[g], of_groups[g], index[u], units[u], begin[u]))


def _with_size(docs: DataFrame, text_col: str, keep_text: bool) -> DataFrame:
    """The documents with ``mix__size``, their number of words."""
    names = [c for c in docs.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            size = pa.array(word_counts(part.column(text_col)))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [size], names=names + [P + "size"])

    return docs.mapInArrow(run, StructType([docs.schema[c] for c in names] + [StructField(P + "size", LongType())]))


def _key(id_col: str, source_col: str, mix: Mix) -> Column:
    return F.xxhash64(F.lit(mix.seed), F.col(id_col).cast("string"), F.col(source_col))


def _shard_plan(spark: SparkSession, quota: np.ndarray, shards: int, mix: Mix) -> DataFrame:
    """(rank of the source, unit) -> shard, computed where the shards are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = [
                    (s, int(a), int(a + n), shard)
                    for shard, start, count in split_quotas(quota, shards, int(batch["id"].min()), int(batch["id"].max()) + 1, mix.seed)
                    for s, (a, n) in enumerate(zip(start, count))
                    if n
                ]
                yield pd.DataFrame(rows, columns=["rank", "u0", "u1", "shard"])

    ranges = spark.range(shards).mapInPandas(run, "rank int, u0 long, u1 long, shard long")
    return ranges.select("rank", "shard", F.explode(F.sequence("u0", F.col("u1") - 1)).alias("unit"))


def _grouped_shard_plan(quotas: DataFrame, shards: int, mix: Mix) -> DataFrame:
    """The same for any number of sources: a row of the job is a group of
    sources and a stretch of shards; the driver holds a number for each group."""
    members = saved(
        quotas.groupBy(F.expr(f"rank div {mix.group_sources}").cast("long").alias("grp"))
        .agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("of"))
    )
    totals = {r["grp"]: r["total"] for r in members.select("grp", "total").collect()}
    top = np.zeros(max(totals) + 1, np.int64)
    for group, total in totals.items():
        top[group] = total
    stretch = 4096
    cells = members.select("grp", "of.rank", "of.n", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // stretch))).alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                group, part = batch.column("grp")[i].as_py(), batch.column("part")[i].as_py()
                rank = np.asarray(batch.column("rank")[i].values)
                quota = np.asarray(batch.column("n")[i].values)
                first, last = part * stretch, min(shards, (part + 1) * stretch)
                for shard, index, start, own in split_group(top, group, quota, shards, first, last, mix.seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rank[index]), pa.array(start), pa.array(start + own), pa.array(np.full(len(index), shard))],
                        names=["rank", "u0", "u1", "shard"],
                    )

    ranges = cells.repartition("grp", "part").mapInArrow(run, "rank int, u0 long, u1 long, shard long")
    return ranges.select("rank", "shard", F.explode(F.sequence("u0", F.col("u1") - 1)).alias("unit"))


def plan(
    docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", mix: Mix = Mix(),
    sizes_too: bool = True, keep_text: bool = True,
) -> DataFrame:
    """The documents with ``mix__source_size``, ``mix__target`` and
    ``mix__copies``: an array of (epoch, shard), empty if not taken; with
    ``sizes_too`` also ``mix__size``."""
    spark = docs.sparkSession
    # Counted once: the steps below read it three times.
    narrow = saved(
        _with_size(docs.select(id_col, source_col, text_col), text_col, keep_text=False).select(
            F.col(source_col).alias("source"), P + "size", _key(id_col, source_col, mix).alias(P + "key")
        )
    )
    totals = saved(narrow.groupBy("source").agg(F.sum(P + "size").alias("n")))
    few = totals.count() <= mix.driver_sources
    small = F.broadcast if few else (lambda df: df)
    if few:
        # One row per source; the sort by code point is Spark's own order of strings.
        listed = sorted(((r["source"], r["n"]) for r in totals.collect()), key=lambda r: (r[0] is None, (r[0] or "").encode()))
        per_source = []
        for rank, ((source, size), goal) in enumerate(zip(listed, targets([n for _, n in listed], mix))):
            epochs = int(goal // size) if size else 0
            per_source.append((source, rank, size, goal, epochs, goal - epochs * size, max(1, math.ceil(size / mix.block_words))))
        sources = spark.createDataFrame(
            per_source, "source string, rank int, source_size long, target double, epochs int, rest double, n_blocks long"
        )
    else:
        epochs = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("int")
        sources = saved(
            with_targets(ranked(totals), mix).select(
                "source", "rank", F.col("n").alias("source_size"), "target", epochs.alias("epochs"),
                (F.col("target") - epochs * F.col("n")).alias("rest"),
                F.greatest(F.ceil(F.col("n") / mix.block_words), F.lit(1)).alias("n_blocks"),
            )
        )
    marked = sources.select([F.col(c).alias(P + "s_" + c) for c in sources.columns])

    def with_block(rows: DataFrame, source: str) -> DataFrame:
        joined = rows.join(small(marked), rows[source].eqNullSafe(F.col(P + "s_source")), "left")
        block = F.pmod(F.xxhash64(F.lit(mix.seed + 1), F.col(P + "key")), F.col(P + "s_n_blocks"))
        return joined.withColumn(P + "block", block)

    narrow = with_block(narrow, "source").withColumnRenamed(P + "s_rank", "rank")
    blocks = saved(narrow.groupBy("rank", P + "block").agg(F.sum(P + "size").alias("words")))
    blocks = blocks.join(small(sources.drop("source")), "rank")

    # Units of work: every block once for each whole pass, then the drawn part.
    units = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs")))).withColumn(
        "order", F.xxhash64(F.lit(mix.seed + 2), "rank", "epoch", P + "block")
    )
    # Running sums and numbers (a hash leaves some blocks empty: units are numbered
    # as they are) within 4,096 stretches of the order, each after those before it.
    units = units.withColumn("part", F.shiftright("order", 52))
    stretches = units.groupBy("rank", "epoch", "part").agg(F.sum("words").alias("in_words"), F.count(F.lit(1)).alias("in_units"))
    of_epoch = Window.partitionBy("rank", "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_source = Window.partitionBy("rank").orderBy("epoch", "part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        "rank", "epoch", "part",
        F.coalesce(F.sum("in_words").over(of_epoch), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("in_units").over(of_source), F.lit(0)).alias("units_before"),
    )
    within = Window.partitionBy("rank", "epoch", "part").orderBy("order", P + "block")
    units = (
        units.join(stretches, ["rank", "epoch", "part"])
        .withColumn("upto", F.col("words_before") + F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("unit", F.col("units_before") + F.row_number().over(within) - 1)
        .withColumn("before", F.col("upto") - F.col("words"))
        .withColumn("whole", (F.col("epoch") < F.col("epochs")) | (F.col("upto") <= F.col("rest")))
        .where(F.col("whole") | ((F.col("before") < F.col("rest")) & (F.col("rest") > 0)))
        .withColumn("missing", F.when(~F.col("whole"), F.col("rest") - F.col("before")))
    )
    units = saved(units.select("rank", P + "block", "epoch", "whole", "missing", "unit"))

    # The block that is taken in part: the key up to which its documents go.
    part = units.where(~F.col("whole")).select("rank", P + "block", "missing")
    keys = (
        narrow.join(small(part), ["rank", P + "block"])  # one row per source at most
        .where(F.col(P + "size") > 0)
        .groupBy("rank", "missing", P + "key", F.length(F.bin(P + "size")).alias("bits"))
        .agg(F.sum(P + "size").alias("words"))
    )
    # The documents up to the key whose sum is nearest, of all sizes or of those
    # whose size has 1, 2, 3, .. bits at most: one long document at the cut is
    # left out where the shorter ones behind it fill the gap better.
    keys = keys.withColumn("top", F.max("bits").over(Window.partitionBy("rank")))
    keys = keys.withColumn("level", F.explode(F.sequence("bits", "top")))
    running = Window.partitionBy("rank", "level").orderBy(P + "key").rangeBetween(Window.unboundedPreceding, 0)
    keys = keys.withColumn("upto", F.sum("words").over(running))
    near = F.abs(F.col("upto") - F.col("missing"))
    longest = F.when(F.col("level") < F.col("top"), F.pow(F.lit(2), F.col("level")).cast("long") - 1)
    cutoff = (
        keys.where(near < F.col("missing"))  # nearer than taking none
        .groupBy("rank").agg(F.min_by(F.struct(F.col(P + "key").alias("key"), longest.alias("longest")), F.struct(near, -F.col("level"), P + "key")).alias("cutoff"))
    )

    quotas = units.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    goal = sources.agg(F.sum("target")).first()[0] or 0.0 if not few else sum(r[3] for r in per_source)
    shards = max(1, math.ceil(goal / mix.shard_words))
    copies = units.join(small(cutoff), "rank", "left")
    if not units.isEmpty():
        if few:
            found = {r["rank"]: r["n"] for r in quotas.collect()}
            dealt = _shard_plan(spark, np.array([found.get(i, 0) for i in range(len(per_source))], np.int64), shards, mix)
        else:
            dealt = _grouped_shard_plan(quotas, shards, mix)
        copies = copies.join(dealt, ["rank", "unit"])
    else:
        copies = copies.withColumn("shard", F.lit(0).cast("long"))
    by_block = saved(
        copies.where(F.col("whole") | F.col("cutoff").isNotNull())
        .groupBy(F.col("rank").alias(P + "rank"), F.col(P + "block").alias(P + "b"))
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("whole"), F.struct("epoch", "shard")))).alias(P + "whole"),
            F.max(F.when(~F.col("whole"), F.struct("cutoff", "epoch", "shard"))).alias(P + "part"),
        )
    )
    if by_block.count() <= mix.broadcast_blocks:
        by_block = F.broadcast(by_block)

    # The texts pass by Python only if their sizes are asked for.
    named = _with_size(docs, text_col, keep_text) if sizes_too else docs
    rows = with_block(named.withColumn(P + "key", _key(id_col, source_col, mix)), source_col)
    rows = rows.join(by_block, (rows[P + "s_rank"] == F.col(P + "rank")) & (rows[P + "block"] == F.col(P + "b")), "left")
    none = F.array().cast("array<struct<epoch:int,shard:bigint>>")
    cut = F.col(P + "part")["cutoff"]
    # Sizes are asked for in this block alone, and only if it leaves some out.
    size = F.col(P + "size") if sizes_too else F.coalesce(F.regexp_count(text_col, F.lit(WORD_PATTERN)), F.lit(0))
    partly = F.when(
        F.col(P + "part").isNotNull() & (F.col(P + "key") <= cut["key"]) & (cut["longest"].isNull() | (size <= cut["longest"])),
        F.array(F.struct(F.col(P + "part")["epoch"].alias("epoch"), F.col(P + "part")["shard"].alias("shard"))),
    )
    return rows.select(
        *[rows[c] for c in named.columns],
        F.col(P + "s_source_size").alias(P + "source_size"),
        F.col(P + "s_target").alias(P + "target"),
        F.concat(F.coalesce(F.col(P + "whole"), none), F.coalesce(partly, none)).alias(P + "copies"),
    )


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", mix: Mix = Mix()) -> DataFrame:
    """The mix: a row for each copy of a document, with ``mix__epoch`` and
    ``mix__shard``, each shard in one partition and in random order."""
    found = plan(docs, text_col, source_col, id_col, mix, sizes_too=False)
    rows = found.select(*docs.columns, F.explode(P + "copies").alias(P + "copy")).select(
        *docs.columns, F.col(P + "copy")["epoch"].alias(P + "epoch"), F.col(P + "copy")["shard"].alias(P + "shard")
    )
    place = F.xxhash64(F.lit(mix.seed + 3), P + "shard", P + "epoch", F.col(id_col).cast("string"))
    return rows.repartition(P + "shard").sortWithinPartitions(P + "shard", place, id_col)


def digest(docs: DataFrame) -> DataFrame:
    found = plan(docs.select("doc_id", "source", "text"), keep_text=False)
    return found.select(
        "doc_id",
        F.col(P + "size").alias("size"),
        F.col(P + "source_size").alias("source_size"),
        F.col(P + "target").alias("target"),
        (F.col(P + "size") * F.size(P + "copies")).alias("taken"),
    )
