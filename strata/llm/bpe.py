"""BPE encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand side by side in no token of the vocabulary
can never end up in one token, whatever is merged: between them is a certain
cut.  Text is cut there, each fragment is encoded alone, and the ids of the
fragments follow one another.  Fragments repeat so often that a task encodes
each distinct one once and looks the rest up.

* On raw text the cuts are those beside ASCII white space, which no token
  holds, and between an ASCII letter and ASCII punctuation where no token has
  the pair.  They survive normalization (NFC composes no two ASCII characters,
  lower case and white-space folding work on each side alone) and the
  pre-tokenizer cuts there too.
* Each piece the pre-tokenizer makes of such a unit is cut again between every
  byte pair the vocabulary lacks.  Only the last fragment of a piece carries
  the end-of-word mark, so the two kinds go to two models with the same merges.

Which piece is normal text, a special token or a normalized form is decided by
the file's own normalizer and pre-tokenizer.  The tests compare ids with the
tokenizers library's on whole texts.

Defined results: null and empty texts have no ids and decode to the empty
string; special tokens' strings in a text become their ids, as in the
library; repeated rows are encoded alike; other columns pass unchanged.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .common import Words, slices, words_of
from .id_cache import IdCache, library_ids

#: Distinct fragments of cut units that a worker remembers.
CACHE_ENTRIES = 100_000
#: Bytes of text encoded together.
ENCODE_BYTES = 1 << 19


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Recent(dict):
    """A bounded cache of two generations: what was not asked for while one
    generation filled up is forgotten."""

    def __init__(self, most: int):
        super().__init__()
        self.half, self.old = most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()


def letter_mark_cuts(kept: set[str]) -> np.ndarray:
    """256 x 256: an ASCII letter beside ASCII punctuation that is not ``kept``."""
    marks = [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in kept]
    letters, out = np.flatnonzero(_LETTER), np.zeros((256, 256), bool)
    for m in marks:
        out[letters, m] = out[m, letters] = True
    return out


def split_further(w: Words, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words' parts between the cuts of ``table``, and
    each document's first part (with one more for the end)."""
    cut = np.flatnonzero(table[w.data[:-1], w.data[1:]]) + 1
    cut = cut[~np.isin(cut, w.text_start)]
    start, end = np.sort(np.concatenate([w.start, cut])), np.sort(np.concatenate([w.end, cut]))
    return start, end, np.append(np.searchsorted(start, w.text_start), len(start))


class BoundaryEncoder:
    """Encoder of one tokenizer file with byte-level BPE and word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["pre_tokenizer"] is None or model["type"] != "BPE" or model.get("dropout"):
            raise ValueError("a pre-tokenized BPE file without dropout is needed")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("added tokens with matching options are not supported")
        self.find_special = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens = [whole.id_to_token(i) for i in range(whole.get_vocab_size(with_added_tokens=True))]
        self.token_bytes = np.array([(t or "").encode() for t in self.tokens], object)
        bare = [t[: -len(self.suffix)] if self.suffix and t.endswith(self.suffix) else t for t in model["vocab"]]
        #: Pairs of byte symbols that some token holds side by side.
        self.inside = {t[i : i + 2] for t in bare for i in range(len(t) - 1)}
        self.ends, self.inner = self._model(spec, True), self._model(spec, False)
        self.units, self.fragments = IdCache(), Recent(CACHE_ENTRIES)
        self.raw_cut = self._raw_cuts()
        #: 256 x 256: are these two ASCII letters that no token holds side by side?
        self.letter_cut = np.zeros((256, 256), bool)
        for a in range(26):
            for b in range(26):
                lone = chr(97 + a) + chr(97 + b) not in self.inside
                for x in (65 + a, 97 + a):
                    self.letter_cut[x, [65 + b, 97 + b]] = lone
        self.lowers = self.normalizer is not None and self.normalizer.normalize_str("A") == "a"
        if not self.lowers and self.normalizer is not None and self.normalizer.normalize_str("A") != "A":
            raise ValueError("only lower-casing normalizers are supported")
        # White space may be cut only if no token holds it (as itself, before the byte alphabet).
        held = set("".join(bare))
        for ws in " \t\n\r\x0b\x0c":
            symbols = {p for p, _ in self.pre_tokenizer.pre_tokenize_str(f"a{ws}a")}
            if any(set(p) - set("a") for p in symbols) or ws in held:
                raise ValueError("tokens of this file may span white space")

    @staticmethod
    def _model(spec: dict, word_end: bool):
        from tokenizers import Tokenizer

        own = {**spec, "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": []}
        own["model"] = {**spec["model"], "end_of_word_suffix": spec["model"].get("end_of_word_suffix") if word_end else None}
        return Tokenizer.from_str(json.dumps(own))

    def cuts(self, piece: str) -> list[str]:
        """The piece between its certain cuts."""
        at = [i for i in range(1, len(piece)) if piece[i - 1 : i + 1] not in self.inside]
        return [piece[a:b] for a, b in zip([0, *at], [*at, len(piece)])] if at else [piece]

    def _pieces(self, word: str) -> list[str | int]:
        """Pieces in the byte alphabet, and special ids, of one word."""
        if self.find_special and (m := self.find_special.search(word)):
            rest = word[m.end() :]
            head = self._pieces(word[: m.start()]) if m.start() else []
            return [*head, self.special[m[0]], *(self._pieces(rest) if rest else [])]
        if word.isascii() and word.isalpha():
            return [word.lower() if self.lowers else word]
        if self.normalizer is not None:
            word = self.normalizer.normalize_str(word)
        return [p for p, _ in self.pre_tokenizer.pre_tokenize_str(word)]

    def _raw_cuts(self) -> np.ndarray:
        """256 x 256: may raw text be cut between these bytes (besides white space)?

        Letters against punctuation, unless a token has the pair in lower case;
        not at characters of special tokens, nor at the apostrophe, which the
        pre-tokenizer takes together with letters.
        """
        out = letter_mark_cuts(set("'") | set("".join(self.special)))
        for a, b in zip(*np.nonzero(out)):
            out[a, b] = (chr(a) + chr(b)).lower() not in self.inside
        return out

    def encode_units(self, units: list[bytes], plain: list[bool]) -> list[list[int]]:
        """Ids of each unit of raw text.  ``plain`` ones are ASCII letters
        without a cut: one fragment each."""
        out: list[list[int]] = [[]] * len(units)
        simple = [i for i, p in enumerate(plain) if p]
        texts = [(units[i].lower() if self.lowers else units[i]).decode() for i in simple]
        for i, ids in zip(simple, library_ids(self.ends, texts)):
            out[i] = ids
        self.fragments.trim()
        parts, plans, missing = self.fragments, {}, set()
        for i in (i for i, p in enumerate(plain) if not p):
            plan = plans[i] = []
            for piece in self._pieces(units[i].decode("utf-8", "replace")):
                if isinstance(piece, int):
                    plan.append(piece)
                    continue
                cut = self.cuts(piece)
                last = len(cut) - 1
                plan += [(k == last, p) for k, p in enumerate(cut)]
            missing.update(k for k in plan if not isinstance(k, int) and parts[k] is None)
        for end, model in ((True, self.ends), (False, self.inner)):
            todo = [p for e, p in missing if e == end]
            for p, ids in zip(todo, library_ids(model, todo)):
                parts[end, p] = ids
        for i, plan in plans.items():
            out[i] = [x for k in plan for x in ([k] if isinstance(k, int) else parts[k])]
        return out

    def encode_texts(self, texts: pa.Array) -> list[bytes]:
        w = words_of(texts)
        if not len(w.start):
            return [b""] * len(texts)
        start, end, edges = split_further(w, self.raw_cut)
        other = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum(~_LETTER[w.data], out=other[1:])
        pairs = np.zeros(len(w.data) + 1, np.int64)  # pairs[p]: cuts before position p
        np.cumsum(self.letter_cut[w.data[:-1], w.data[1:]], out=pairs[2:])
        plain = (other[end] == other[start]) & (pairs[end] == pairs[start + 1])
        return self.units.encode(
            w.data, start, end, edges, lambda new, unit: self.encode_units(new, plain[unit].tolist())
        )

    def decode(self, ids: bytes) -> bytes:
        """The library's text of the ids: without a decoder, tokens joined by a space."""
        return b" ".join(self.token_bytes[np.frombuffer(ids, "<u4")].tolist())


@lru_cache(maxsize=4)
def encoder(path: str) -> BoundaryEncoder:
    """Once per path and worker process; it is kept from task to task."""
    return BoundaryEncoder(path)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(
    docs: DataFrame,
    file: str = "word_bpe_49k.json",
    text_col: str = "text",
    ids_col: str = "bpe__ids",
    decoded_col: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """The documents with their ids (binary, little-endian 32-bit) and, if
    asked for, the text decoded from these ids.  ``file`` is a public
    tokenizer's name, looked up on each executor, or an absolute path there."""
    names = [c for c in docs.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file if file.startswith("/") else vocabulary(file))
        for part in slices(batches, text_col, ENCODE_BYTES):
            ids = own.encode_texts(part.column(text_col))
            columns = [part.column(c) for c in names] + [pa.array(ids, pa.binary())]
            if decoded_col:
                columns.append(pa.array([own.decode(x) for x in ids], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names + [ids_col] + [decoded_col] * bool(decoded_col))

    fields = [docs.schema[c] for c in names] + [StructField(ids_col, BinaryType())]
    if decoded_col:
        fields.append(StructField(decoded_col, StringType()))
    return docs.mapInArrow(run, StructType(fields))


def digest(docs: DataFrame, file: str = "word_bpe_49k.json") -> DataFrame:
    found = encode(docs.select("doc_id", "text"), file, decoded_col="bpe__decoded", keep_text=False)
    return found.select(
        "doc_id",
        (F.octet_length("bpe__ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("bpe__ids", 256).alias("ids_sha256"),
        F.sha2("bpe__decoded", 256).alias("decoded_sha256"),
    )
