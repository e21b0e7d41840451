"""Substring dedup: every word covered by a repeated run of words is removed.

A window is ``width`` consecutive words of a document.  A word goes when a
window over it has a word sequence that starts anywhere else too, in the same
document or another.

1. Sharding by content.  Of the ``width`` words of a window, the ``gram``-word
   run with the smallest hash is its key: equal windows have equal keys, at
   equal places.  Neighbouring windows whose key stands at one place make a
   segment, so no segment holds a window twice.
2. Only keys that occur twice can hold a repeated window; the segments of all
   others are left out before any text moves.
3. Copies of a segment are counted and one of them is fetched.  Each shard
   takes whole keys and builds a compressed FM-index (Burrows-Wheeler
   transform in a wavelet matrix) of its segments, a counted copy twice, and
   streams the segments against it: backward search gives the matching
   statistics, and the windows whose range holds two or more are reported.
4. The windows go back to every copy, and the documents lose the words.

A key with more than ``hot`` segments that are not all alike would fill one
shard.  Its windows become segments of their own with their own hash as key:
then all segments of a key are copies, and copies are counted on the map side.
``hot`` is the same for every corpus.  Up to ``hot_keys`` such keys go to the
tasks as a list; of more, the segments are found by a join and their windows
cut from the documents that hold them, with the same result.

Words are compared by 64-bit hashes.  Defined results: null and empty texts
have no words and stay null or become empty; documents shorter than a window
are kept whole; repeated rows and copies count as occurrences, so all of them
lose the shared words; an empty table gives an empty one; other columns pass.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import Words, free_shuffles, give_back, mix64, ragged, range_hash, saved, signed, slices, window_hash, words_of
from .fm_index import FMIndex, repeated_windows

P = "sub__"


@dataclass(frozen=True)
class Settings:
    width: int = 35
    #: width - gram + 1 windows make a segment at most: 64, the bits of a mask.
    gram: int = 12
    #: Segments of a key beyond which it is taken apart by window.
    hot: int = 50_000
    #: Such keys that tasks get as a list (8 bytes each) at most.
    hot_keys: int = 1_000_000
    #: Words of one FM-index.
    index_words: int = 500_000

    def __post_init__(self) -> None:
        if not 0 <= self.width - self.gram < 64:
            raise ValueError("a segment may have 1 to 64 windows")


def _sliding_min(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of each n neighbours, and where the first such one is."""

    def less(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        m = min(len(a[0]), len(b[0]))
        left = a[0][:m] <= b[0][:m]
        return np.where(left, a[0][:m], b[0][:m]), np.where(left, a[1][:m], b[1][:m])

    have, out = 1, (x, np.arange(len(x), dtype=np.int32))
    while 2 * have <= n:
        out = less(out, (out[0][have:], out[1][have:]))
        have *= 2
    return less(out, (out[0][n - have :], out[1][n - have :])) if have < n else out


def segments(w: Words, s: Settings, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first word in the document, windows, key, content hash)."""
    counts = w.counts()
    n_windows = np.maximum(counts - s.width + 1, 0)
    total = int(n_windows.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    word = w.hashes()
    doc = np.repeat(np.arange(len(counts)), n_windows)
    at = ragged(w.first[:-1], n_windows)  # word at which each window begins
    key, place = (x[at] for x in _sliding_min(mix64(window_hash(word, s.gram)), s.width - s.gram + 1))
    alone = np.isin(key, hot) if len(hot) else np.zeros(total, bool)
    new = np.ones(total, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1]) | alone[1:] | alone[:-1]
    begin = np.flatnonzero(new)  # width - gram + 1 windows apart at most
    n = np.diff(np.append(begin, total))
    start = at[begin]
    content = range_hash(word, start, start + n + s.width - 1)
    return doc[begin], start - w.first[doc[begin]], n, np.where(alone[begin], content, key[begin]), content


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Text with two hashes that name the row; equal rows share them and all results."""
    return docs.select(
        F.xxhash64(F.lit(1), F.col(id_col).cast("string")).alias("h1"),
        F.xxhash64(F.lit(2), F.col(text_col)).alias("h2"),
        F.col(text_col).alias("text"),
    )


def _segment_rows(rows: DataFrame, s: Settings, hot: list[int], only_hot: bool = False) -> DataFrame:
    """h1, h2, key, content and pos = first word * 64 + windows - 1."""
    hot_keys = np.array(hot, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = words_of(part.column("text"))
            doc, first, n, key, content = segments(w, s, hot_keys)
            if only_hot and len(doc):
                keep = key == content  # windows on their own: one hash for both
                doc, first, n, key, content = (x[keep] for x in (doc, first, n, key, content))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("h1").take(take),
                    part.column("h2").take(take),
                    pa.array(signed(key)),
                    pa.array(signed(content)),
                    pa.array(first * 64 + n - 1),
                ],
                names=["h1", "h2", "key", "content", "pos"],
            )

    return rows.mapInArrow(run, "h1 long, h2 long, key long, content long, pos long")


def _positions(rows: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """text and segs (array of the columns) of each different row with segments."""
    lists = found.groupBy("h1", "h2").agg(F.collect_list(F.struct(*columns)).alias("segs"))
    # A row that is repeated whole is needed once; the join has it sorted already.
    return rows.join(lists, ["h1", "h2"]).dropDuplicates(["h1", "h2"])


def _window_rows(rows: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """The windows of the segments (h1, h2, pos) as segments of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = words_of(part.column("text"))
            lists = part.column("segs")
            n_segments = np.asarray(lists.value_lengths())
            pos = np.asarray(lists.flatten().field("pos"))
            doc = np.repeat(np.arange(len(n_segments)), n_segments)
            n = (pos & 63) + 1
            first, doc = ragged(pos >> 6, n), np.repeat(doc, n)
            start = w.first[doc] + first
            content = pa.array(signed(range_hash(w.hashes(), start, start + s.width)))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("h1").take(take), part.column("h2").take(take), content, content, pa.array(first * 64)],
                names=["h1", "h2", "key", "content", "pos"],
            )

    # A segment that stands in a repeated row counts as often as the row.
    cut = _positions(rows, found.dropDuplicates(["h1", "h2", "pos"]), "pos").select("h1", "h2", "text", "segs")
    cut = cut.mapInArrow(run, "h1 long, h2 long, key long, content long, pos long")
    times = found.groupBy("h1", "h2").agg((F.count(F.lit(1)) / F.count_distinct("pos")).cast("int").alias("times"))
    return cut.join(times, ["h1", "h2"]).withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")


def _fetch(rows: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """Word hashes of one copy of each segment: key, content, twice, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = words_of(part.column("text"))
            word = signed(w.hashes())
            lists = part.column("segs")
            flat = lists.flatten()
            n = np.asarray(lists.value_lengths())
            base = np.repeat(w.first[:-1], n)
            pos = np.asarray(flat.field("pos"))
            start, length = base + (pos >> 6), (pos & 63) + s.width
            words = word[ragged(start, length)]
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [flat.field("key"), flat.field("content"), flat.field("twice"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(words))],
                names=["key", "content", "twice", "words"],
            )

    joined = _positions(rows, wanted, "pos", "key", "content", "twice").select("text", "segs")
    return joined.mapInArrow(run, "key long, content long, twice boolean, words array<long>")


def _search(fetched: DataFrame, s: Settings) -> DataFrame:
    """content, mask: the repeated windows of each distinct segment.  A task
    streams its keys in order and indexes some at a time."""

    def found(keys: np.ndarray, content: np.ndarray, twice: np.ndarray, start: np.ndarray, length: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        _, first = np.unique(content, return_index=True)
        copies = np.concatenate([first, first[twice[first]]])
        n = length[copies] + 1
        at = np.concatenate([[0], np.cumsum(n)])
        symbols = np.zeros(at[-1], np.int64)
        spelled, alphabet = np.unique(words[ragged(start[copies], length[copies])], return_inverse=True)
        symbols[ragged(at[:-1], n - 1)] = alphabet + 1
        index = FMIndex(symbols, len(spelled) + 1)
        mask = repeated_windows(index, symbols, at[: len(first)], length[first], s.width)
        some = mask != 0
        return pa.RecordBatch.from_arrays(
            [pa.array(content[first][some]), pa.array(signed(mask[some]))], names=["content", "mask"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            lists = batch.column("words")
            length = np.asarray(lists.value_lengths()).astype(np.int64)
            held.append((np.asarray(batch.column("key")), np.asarray(batch.column("content")), batch.column("twice").to_numpy(zero_copy_only=False), length, np.asarray(lists.flatten())))
            size += int(length.sum())
            if size >= s.index_words:
                key, content, twice, length, words = (np.concatenate(x) for x in zip(*held))
                start = np.cumsum(length) - length
                # Index in runs of whole keys; the last key may go on in the next batch.
                edges = np.append(np.flatnonzero(np.diff(key, prepend=key[0] - 1)), len(key))
                a = 0
                for b, end in zip(edges[1:-1].tolist(), edges[2:].tolist()):
                    if start[end - 1] + length[end - 1] - start[a] >= s.index_words or end == len(key):
                        yield found(key[a:b], content[a:b], twice[a:b], start[a:b], length[a:b], words)
                        a = b
                keep = int(start[a])
                held = [(key[a:], content[a:], twice[a:], length[a:], words[keep:])]
                size = int(length[a:].sum())
        if size:
            key, content, twice, length, words = (np.concatenate(x) for x in zip(*held))
            yield found(key, content, twice, np.cumsum(length) - length, length, words)
        give_back()

    return fetched.repartition("key").sortWithinPartitions("key").mapInArrow(run, "content long, mask long")


def _seen(rows: DataFrame, s: Settings) -> DataFrame:
    """The segments whose key occurs twice, no key with more than ``s.hot``
    segments that are not all alike."""
    keys = _segment_rows(rows, s, []).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), (F.min("content") != F.max("content")).alias("unlike")
    ).where("n > 1")
    keys = saved(keys)
    frequent = keys.where(F.col("unlike") & (F.col("n") > s.hot)).select("key")
    n_hot = frequent.count()
    if not n_hot:
        return saved(_segment_rows(rows, s, []).join(keys.select("key"), "key", "left_semi"))
    others = keys.select("key").join(frequent, "key", "left_anti")
    # What is joined below is saved, so that the join shuffles it afresh: only
    # then can the occurrences of a hot key be split over tasks.
    if n_hot <= s.hot_keys:
        hot = [r["key"] for r in frequent.collect()]
        apart = _segment_rows(rows, s, hot, only_hot=True).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        twice = saved(others.unionByName(apart.select("key")))
        return saved(_segment_rows(rows, s, hot).join(twice, "key", "left_semi"))
    found = saved(_segment_rows(rows, s, []).join(saved(frequent), "key", "left_semi").select("h1", "h2", "pos"))
    windows = saved(_window_rows(rows, found, s))
    apart = saved(windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    rest = _segment_rows(rows, s, []).join(saved(others), "key", "left_semi")
    return saved(rest.unionByName(windows.join(apart, "key", "left_semi")))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """h1, h2 (see ``_rows``) and marks: array of (pos, mask), the repeated
    windows of each document that has some."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    seen = _seen(rows, s)
    free_shuffles(spark)
    place = F.struct("h1", "h2", "pos")
    distinct = seen.groupBy("key", "content").agg((F.count(F.lit(1)) > 1).alias("twice"), F.min(place).alias("at"))
    wanted = distinct.select("key", "content", "twice", "at.h1", "at.h2", "at.pos")
    masks = saved(_search(_fetch(rows, wanted, s), s))
    free_shuffles(spark)
    marked = seen.join(masks, "content").groupBy("h1", "h2").agg(F.collect_set(F.struct("pos", "mask")).alias("marks"))
    return marked


def _covered(w: Words, marks: pa.ListArray, width: int) -> np.ndarray:
    """Per word of the slice: is it under a repeated window?"""
    n = np.asarray(marks.value_lengths().fill_null(0)).astype(np.int64)
    if not n.sum():
        return np.zeros(len(w.start), bool)
    flat = marks.drop_null().flatten()
    pos, mask = np.asarray(flat.field("pos")), np.asarray(flat.field("mask"))
    begin = np.repeat(w.first[:-1], n) + (pos >> 6)
    row, k = np.nonzero(np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    hit = begin[row] + k
    size = len(w.start) + 1
    return np.cumsum(np.bincount(hit, minlength=size) - np.bincount(hit + width, minlength=size))[:-1] > 0


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings(), keep_text: bool = True) -> DataFrame:
    """The documents with ``sub__kept`` (the words left, one space between),
    ``sub__n_words``, ``sub__n_removed`` and ``sub__spans`` (first and last
    word of each removed stretch)."""
    names = [c for c in docs.columns if keep_text or c != text_col]
    marks = repeated(docs, id_col, text_col, s).select(
        F.col("h1").alias(P + "h1"), F.col("h2").alias(P + "h2"), F.col("marks").alias(P + "marks")
    )
    hashed = docs.select(
        *docs.columns,
        F.xxhash64(F.lit(1), F.col(id_col).cast("string")).alias(P + "h1"),
        F.xxhash64(F.lit(2), F.col(text_col)).alias(P + "h2"),
    )
    joined = hashed.join(marks, [P + "h1", P + "h2"], "left").select(*docs.columns, P + "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            w = words_of(part.column(text_col))
            gone = _covered(w, part.column(P + "marks"), s.width)
            doc = w.doc()
            n = len(w.text_start)
            kept = np.flatnonzero(~gone)
            left = np.bincount(doc[kept], minlength=n)
            # Bytes of the kept words, each with the byte behind it made a space.
            length = w.end[kept] - w.start[kept] + 1
            data = np.append(w.data, np.uint8(32))
            blob = data[ragged(w.start[kept], length)]
            ends = np.cumsum(length)
            blob[ends - 1] = 32
            edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(left)])]
            raw = blob.tobytes()
            null = part.column(text_col).is_null().to_pylist()
            texts = [None if z else raw[a : max(a, b - 1)] for a, b, z in zip(edge[:-1].tolist(), edge[1:].tolist(), null)]
            first = gone & ~(np.concatenate([[False], gone[:-1]]) & (np.concatenate([[-1], doc[:-1]]) == doc))
            last = gone & ~(np.concatenate([gone[1:], [False]]) & (np.concatenate([doc[1:], [-1]]) == doc))
            a, b = np.flatnonzero(first), np.flatnonzero(last)
            base = w.first[doc[a]]
            spans = np.stack([a - base, b - base], 1).ravel()
            per_doc = np.bincount(doc[a], minlength=n)
            pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(spans) + 1, 2), pa.int32()), pa.array(spans))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names]
                + [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(w.counts()), pa.array(w.counts() - left), lists],
                names=names + [P + c for c in ("kept", "n_words", "n_removed", "spans")],
            )

    schema = StructType(
        [docs.schema[c] for c in names]
        + [StructField(P + "kept", StringType()), StructField(P + "n_words", LongType()), StructField(P + "n_removed", LongType())]
        + [StructField(P + "spans", ArrayType(ArrayType(LongType())))]
    )
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """The documents, the texts that lose words replaced by what is left."""
    found = dedup(docs, id_col, text_col, s)
    text = F.when(F.col(P + "n_removed") > 0, F.col(P + "kept")).otherwise(F.col(text_col))
    return found.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    found = dedup(docs.select("doc_id", "text"), keep_text=False)
    return found.select(
        "doc_id",
        F.col(P + "n_words").alias("n_words"),
        F.col(P + "n_removed").alias("n_removed"),
        F.sha2(F.coalesce(P + "kept", F.lit("")), 256).alias("kept_sha256"),
    )
