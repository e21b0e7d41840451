"""Helpers the text operators share.

Word rule of every operator: a word is a maximal run of bytes other than
space, tab, LF, VT, FF and CR (``[^\\x20\\x09-\\x0D]+``).  All six are ASCII,
so words can be found on the UTF-8 bytes of a whole Arrow column at once.
"""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of text a task looks at together; a longer document is a slice of its own.
SLICE_BYTES = 1 << 19

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Ranges of more 8-byte words are hashed one by one.
_LANES = 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finisher)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _in_lanes(length: np.ndarray, count: np.ndarray, lane, whole) -> np.ndarray:
    """64-bit hash of each range: its length, then its lanes (``lane(which, k)``),
    each mixed before the next comes in.  No place is only multiplied by a
    power of one base, so no pattern of equal symbols cancels out.  Ranges of
    more than ``_LANES`` lanes are left to ``whole(which)``."""
    out = mix64(length.astype(np.uint64) * _STEP + _SEED)
    far = np.flatnonzero(count > _LANES)
    near = np.flatnonzero((count > 0) & (count <= _LANES))
    k = 0
    while len(near):
        out[near] = mix64(out[near] ^ lane(near, k))
        k += 1
        near = near[count[near] > k]
    if len(far):
        out[far] = whole(far)
    return out


def byte_lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def bytes_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of bytes; equal content, equal hash.  Ranges
    of one length up to eight bytes never share one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length, lanes = ends - starts, byte_lanes(data)

    def lane(which: np.ndarray, k: int) -> np.ndarray:
        return lanes[starts[which] + 8 * k] & _MASKS[np.minimum(length[which] - 8 * k, 8)]

    def whole(which: np.ndarray) -> list[int]:
        view = memoryview(np.ascontiguousarray(data))
        return [xxhash.xxh64_intdigest(view[a:b], 1) for a, b in zip(starts[which].tolist(), ends[which].tolist())]

    return _in_lanes(length, -(-length // 8), lane, whole)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range values[start:end] of 64-bit numbers."""
    if not len(starts):
        return np.zeros(0, np.uint64)

    def whole(which: np.ndarray) -> list[int]:
        view = memoryview(np.ascontiguousarray(values)).cast("B")
        return [xxhash.xxh64_intdigest(view[8 * a : 8 * b], 2) for a, b in zip(starts[which].tolist(), ends[which].tolist())]

    return _in_lanes(ends - starts, ends - starts, lambda which, k: values[starts[which] + k], whole)


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours, whatever document they are
    in: hashes of runs of 1, 2, 4, .. neighbours, put together in order."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, size, run = None, 0, 1, values.astype(np.uint64, copy=False)
    while True:
        if width & size:
            part = run[at : at + n]
            out = mix64(part + _SEED) if out is None else mix64(out * _STEP + part)
            at += size
        if 2 * size > width:
            return out
        run = mix64(run[:-size] * _STEP + run[size:])
        size *= 2


class Words(NamedTuple):
    """Words of some documents: byte ranges in ``data``, and each document's share."""

    data: np.ndarray  # uint8, all texts one after the other
    text_start: np.ndarray  # per document
    text_end: np.ndarray
    start: np.ndarray  # per word
    end: np.ndarray
    first: np.ndarray  # document d has the words first[d] : first[d + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        data = self.data if data is None else data
        return bytes_hash(data, self.start, self.end)


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text, without looking for their ends."""
    data, t0, t1 = text_bytes(texts)
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    total = np.zeros(len(data) + 1, np.int64)
    first = t0[(t1 > t0)]
    begins[first] = inside[first]
    np.cumsum(begins, out=total[1:])
    return total[t1] - total[t0]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's range; null is empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    buf = np.frombuffer(data, np.uint8)[lo:hi] if data is not None else np.zeros(0, np.uint8)
    start, end = offsets[:-1] - lo, offsets[1:] - lo
    if texts.null_count:
        end = np.where(np.asarray(texts.is_null()), start, end)
    return buf, start, end


def words_of(texts: pa.Array) -> Words:
    data, t0, t1 = text_bytes(texts)
    inside = _IS_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[t0], cut[t1] = True, True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.append(np.searchsorted(start, t0), np.searchsorted(start, t1[-1:]) if len(t1) else 0)
    return Words(data, t0, t1, start, end, first)


def give_back() -> None:
    """Returns freed memory to the system: a worker outlives its task, and
    what it keeps is missing where the next one runs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``most`` bytes of text, one document at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, t0, t1 = text_bytes(batch.column(column))
        group = t0 // most  # rows whose text begins in the same stretch
        big = (t1 - t0) > most
        edge = np.flatnonzero((np.diff(group) != 0) | big[1:] | big[:-1]) + 1
        for a, b in zip([0, *edge], [*edge, batch.num_rows]):
            yield batch.slice(a, b - a)
    give_back()


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for each range, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    step = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(np.asarray(starts, np.int64), counts) + step


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python 10,000 at a time unless told otherwise; of texts
    that is tens of MB in the JVM and again in each worker.  Sessions that
    leave the setting alone get 1,000."""
    if not spark.sparkContext.getConf().contains(ROWS_PER_BATCH) and spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.  Where it
    is unset (tests) a folder of the local machine serves a local master."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found is None:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if found is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            import tempfile

            found = tempfile.mkdtemp(prefix="strata-llm-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir() or found
    return found


#: Spark's setting that drops an action's shuffle files as soon as it ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint in the shared folder: the lineage ends
    here and a lost executor costs no earlier work.  Nothing reads the shuffle
    files of these rows again, so they go at once, not when a JVM collects."""
    conf = df.sparkSession.conf
    checkpoint_folder(df.sparkSession)
    was = conf.get(_DROP_SHUFFLES, None)
    conf.set(_DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new plan, that heeds the setting
    finally:
        conf.unset(_DROP_SHUFFLES) if was is None else conf.set(_DROP_SHUFFLES, was)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished steps now: it
    acts when the driver's JVM collects the plans nothing refers to any more.
    The bridge to Python lets go of its references a moment after Python does."""
    import gc
    import time

    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder of this run under the shared folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
