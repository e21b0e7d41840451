"""Token ids in bit-packed files.

Each id takes the fewest bits that hold every id of the vocabulary.  A file
holds blocks of ``BLOCK_IDS`` ids; its footer has each block's byte offset and
each document's id and number of ids, so that numpy unpacks a block at once
and any stretch of ids is read from its own blocks alone:

    block 0 | block 1 | ... | footer arrays | trailer
    footer   doc_id int64[d], known uint8[d], n_ids int64[d], offset uint64[blocks + 1]
    trailer  magic, bits, ids a block, documents, ids, footer's offset

Documents are sorted by id across files by a range partitioning of the texts
and each task streams its documents into one file.  A file gets a new name at
each attempt and only the attempt that ends well is in the manifest, so a lost
executor leaves at most a file nobody reads.

The ids are the tokenizers library's own.  It is asked once per distinct
fragment and worker: text is cut before white space that follows another
character and between a letter and punctuation, where the pre-tokenizer cuts
too whatever stands around.

Defined results: null and empty texts hold the end id only; rows with one
doc_id follow one another; null doc_ids come first; other columns are not
stored; an empty table gives no ids.
"""
from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import ENCODE_BYTES, letter_mark_cuts, vocabulary
from .common import saved, slices, text_bytes, work_path
from .id_cache import IdCache, library_ids

MAGIC = b"IDPACK01"
BLOCK_IDS = 1 << 16
TRAILER = struct.Struct("<8sIIQQQ")


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = np.ascontiguousarray(ids, "<u4")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    flat = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(flat, bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def _open(path: str):
    """(file system, path there) of a folder any executor reaches: the scheme says which."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class PackedWriter:
    def __init__(self, path: str, bits: int):
        system, at = _open(path)
        system.create_dir(at.rpartition("/")[0], recursive=True)
        self.out, self.bits, self.offsets, self.n_ids = system.open_output_stream(at), bits, [0], 0
        self.waiting, self.held = [], 0
        self.docs: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 8 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, all_: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        whole = len(ids) if all_ else len(ids) // BLOCK_IDS * BLOCK_IDS
        for a in range(0, whole, BLOCK_IDS):
            data = pack(ids[a : min(a + BLOCK_IDS, whole)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        at = self.offsets[-1]
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(np.array([d is not None for d in self.docs], np.uint8).tobytes())
        self.out.write(np.array(self.counts, "<i8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, BLOCK_IDS, len(self.docs), self.n_ids, at))
        self.out.close()


class PackedReader:
    def __init__(self, path: str):
        system, at = _open(path)
        self.file = system.open_input_file(at)
        size = self.file.size()
        magic, self.bits, self.block, n_docs, self.n_ids, foot = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        data = self.file.read_at(size - TRAILER.size - foot, foot)
        known = np.frombuffer(data, np.uint8, n_docs, 8 * n_docs)
        self.docs = [int(d) if k else None for d, k in zip(np.frombuffer(data, "<i8", n_docs), known)]
        self.counts = np.frombuffer(data, "<i8", n_docs, 9 * n_docs)
        self.offsets = np.frombuffer(data, "<u8", -(-self.n_ids // self.block) + 1, 17 * n_docs).astype(np.int64)

    def ids(self, first: int, count: int) -> np.ndarray:
        """ids[first : first + count], from the blocks that hold them."""
        if not count:
            return np.zeros(0, "<u4")
        b0, b1 = first // self.block, (first + count - 1) // self.block + 1
        data = self.file.read_at(int(self.offsets[b1] - self.offsets[b0]), int(self.offsets[b0]))
        parts = []
        for b in range(b0, b1):
            n = min(self.block, self.n_ids - b * self.block)
            lo = int(self.offsets[b] - self.offsets[b0])
            parts.append(unpack(data[lo : lo + int(self.offsets[b + 1] - self.offsets[b])], n, self.bits))
        return np.concatenate(parts)[first - b0 * self.block :][:count]


class LibraryTokenizer:
    """The tokenizers library over distinct fragments of byte-level BPE text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.known = IdCache()
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        if any(c.isspace() for s in special for c in s):
            raise ValueError("special tokens with white space are not supported")
        # The apostrophe may go with letters; a special token must stay whole.
        cut = letter_mark_cuts(set("'") | set("".join(special)))
        space = [9, 10, 11, 12, 13, 32]
        for b in range(256):
            if 33 <= b <= 126 or b >= 128:
                cut[b, space] = True
        self.cut = cut
        # Last two bytes of the white space beyond ASCII; no cut behind these.
        wide = np.zeros((256, 256), bool)
        for code in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
            raw = chr(code).encode()
            wide[raw[-2], raw[-1]] = True
        self.wide = wide

    def fragments(self, data: np.ndarray, t0: np.ndarray, t1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.cut[data[:-1], data[1:]]) + 1
        two = at >= 2
        at = at[~(two & self.wide[data[at - 2], data[at - 1]])]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = edge[t0] = edge[t1] = True
        edge = np.flatnonzero(edge)
        start, end = edge[:-1], edge[1:]
        return start, end, np.append(np.searchsorted(start, t0), len(start))

    def encode_texts(self, texts: pa.Array) -> list[bytes]:
        data, t0, t1 = text_bytes(texts)
        if not len(data):
            return [b""] * len(texts)
        start, end, edges = self.fragments(data, t0, t1)

        def new(parts: list[bytes], _: np.ndarray) -> Iterator[list[int]]:
            return library_ids(self.tok, [p.decode("utf-8", "replace") for p in parts])

        return self.known.encode(data, start, end, edges, new)


@lru_cache(maxsize=4)
def tokenizer(path: str) -> LibraryTokenizer:
    return LibraryTokenizer(path)


def write(
    docs: DataFrame, folder: str, file: str = "byte_bpe_50k.json", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes the documents' ids; returns the manifest: shard (in order of
    doc_id), path, n_docs, n_ids, bits, before (ids in earlier shards)."""
    tie = F.xxhash64(F.col("text"))  # splits one doc_id's repeated rows, if they are many
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        own = tokenizer(file if file.startswith("/") else vocabulary(file))
        bits, out, path = bits_for(own.vocab), None, ""
        for part in slices(batches, "text", ENCODE_BYTES):
            if out is None:
                path = f"{folder}/{shard:07d}-{uuid.uuid4().hex}.ids"
                out = PackedWriter(path, bits)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), own.encode_texts(part.column("text"))):
                out.add(doc_id, np.frombuffer(ids + end_id.to_bytes(4, "little"), "<u4"))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [path], "n_docs": [len(out.docs)], "n_ids": [out.n_ids], "bits": [bits]}
            )

    manifest = saved(rows.mapInArrow(run, "shard long, path string, n_docs long, n_ids long, bits long"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long")))


def read(manifest: DataFrame, batch_ids: int = 1 << 20) -> DataFrame:
    """doc_id, start (ids before the document in all shards), n_tokens, ids
    (binary, little-endian 32-bit), read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = PackedReader(row["path"])
                upto = np.concatenate([[0], np.cumsum(file.counts)])
                a = 0
                while a < len(file.docs):
                    b = max(a + 1, int(np.searchsorted(upto, upto[a] + batch_ids, "right")) - 1)
                    raw = file.ids(int(upto[a]), int(upto[b] - upto[a])).tobytes()
                    edge = (4 * (upto[a : b + 1] - upto[a])).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.docs[a:b], pa.int64()),
                            pa.array(upto[a:b] + row["before"], pa.int64()),
                            pa.array(file.counts[a:b], pa.int64()),
                            pa.array([raw[x:y] for x, y in zip(edge, edge[1:])], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    a = b

    # A file a task, dealt out in turn; with the number given Spark keeps it.
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame) -> DataFrame:
    manifest = write(docs, work_path(docs.sparkSession, "token-ids"))
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
