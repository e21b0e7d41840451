"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words.  Each passage is
described by counts and hashed words and encoded by a small layer; a gated
attention (tanh times sigmoid) weighs the passages of a document; the weighted
sum of their codes is scored.  Only documents have labels, so the weights are
learned from them alone (Ilse et al., "Attention-based deep multiple instance
learning").

Fitting takes at most ``train_docs`` labelled rows, the ones with the smallest
hashes of doc_id, and of each at most ``train_passages`` passages, evenly
spaced; both are bounds on the sample alone.  Every document is scored by all
its passages.  Features come from the text only.

Defined results: null and empty texts are one empty passage and get a score;
rows with one doc_id are each scored by their own text; labels that are null
or of the held-out fifth are not learned from; without labels of both classes
the score is the share of label 1 (0.5 without any); an empty table gives an
empty table; other columns pass unchanged.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from .common import Words, mix64, range_hash, slices, window_hash, words_of

P = "mil__"


@dataclass(frozen=True)
class Settings:
    passage_words: int = 64
    buckets: int = 32
    hidden: int = 16
    attention: int = 8
    train_docs: int = 3_000
    #: All passages of a sampled text count; rows are taken while their passages
    #: together stay within this, and a text of a hundredth of it is not taken.
    train_passages: int = 300_000
    rounds: int = 200
    rate: float = 0.03
    decay: float = 1e-3
    seed: int = 7
    #: Scores from here on are label 1.
    threshold: float = 0.3


COUNTS = (
    "words", "chars_per_word", "symbols_per_word", "digit_share", "upper_share", "punctuation_per_word",
    "distinct_share", "repeated_share", "dup_line_share", "non_ascii_share", "longest_word", "long_word_share", "lines_per_word",
)

_SYMBOL, _DIGIT, _UPPER, _PUNCT = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>^~=+_@{}[]\\")] = True
_DIGIT[48:58] = True
_UPPER[65:91] = True
_PUNCT[list(b".,;:!?'\"()-/")] = True


def _within(flags: np.ndarray, w: Words) -> np.ndarray:
    """Per word: how many of its bytes are flagged."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[w.end] - total[w.start]


def _repeats(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each value occurs under its owner; whether it is the first."""
    key = mix64(value + mix64(owner.astype(np.uint64)))
    _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(key), bool)
    is_first[first] = True
    return count[back], is_first


def passages(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of each document's."""
    w = words_of(texts)
    n, doc = w.counts(), w.doc()
    per_doc = np.maximum(1, -(-n // s.passage_words))
    base = np.cumsum(per_doc) - per_doc
    k = int(per_doc.sum())
    x = np.zeros((k, len(COUNTS) + s.buckets), np.float32)
    if not len(doc):
        return x, per_doc
    at = np.arange(len(doc)) - w.first[doc]
    passage = base[doc] + at // s.passage_words
    add = lambda v: np.bincount(passage, v, k)
    word = w.hashes()
    size = np.maximum(add(np.ones(len(doc))), 1)
    points = _within((w.data & 0xC0) != 0x80, w)
    chars = np.maximum(add(points), 1)
    # Words in 3-word windows that the document has more than once.
    again = np.zeros(len(doc), bool)
    start = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    if len(start):
        often, _ = _repeats(doc[start], window_hash(word, 3)[start])
        for j in range(3):
            again[start[often > 1] + j] = True
    # Words in lines that stood in the document before.
    feeds = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(w.data == 10, out=feeds[1:])
    line = feeds[w.start]
    new_line = np.ones(len(doc), bool)
    new_line[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    l0 = np.flatnonzero(new_line)
    l1 = np.append(l0[1:], len(doc))
    _, first = _repeats(doc[l0], range_hash(word, l0, l1))
    dup = np.repeat(~first, l1 - l0)
    _, novel = _repeats(passage, word)
    longest = np.zeros(k)
    np.maximum.at(longest, passage, points)
    columns = (
        np.log1p(size), add(points) / size, add(_within(_SYMBOL[w.data], w)) / size, add(_within(_DIGIT[w.data], w)) / chars,
        add(_within(_UPPER[w.data], w)) / chars, add(_within(_PUNCT[w.data], w)) / size, add(novel) / size, add(again) / size,
        add(dup) / size, add(_within(w.data >= 0xC0, w)) / chars, np.log1p(longest), add(points > 20) / size, add(new_line) / size,
    )
    x[:, : len(COUNTS)] = np.stack(columns, 1)
    bucket = (word % np.uint64(s.buckets)).astype(np.int64)
    hashed = np.bincount(passage * s.buckets + bucket, minlength=k * s.buckets).reshape(k, s.buckets)
    x[:, len(COUNTS) :] = np.sqrt(hashed / size[:, None])
    return x, per_doc


@dataclass
class Model:
    """Weights; ``score`` is the whole forward pass."""

    mean: np.ndarray
    std: np.ndarray
    enc: np.ndarray  # features x hidden
    enc_b: np.ndarray
    tan: np.ndarray  # hidden x attention
    gate: np.ndarray
    att: np.ndarray  # attention
    out: np.ndarray  # hidden
    out_b: np.ndarray

    def forward(self, x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        start = np.cumsum(n) - n
        x = np.clip((x - self.mean) / self.std, -5, 5)
        code = np.tanh(x @ self.enc + self.enc_b)
        t, g = np.tanh(code @ self.tan), 1 / (1 + np.exp(-(code @ self.gate)))
        weight = (t * g) @ self.att
        weight = np.exp(weight - np.repeat(np.maximum.reduceat(weight, start), n))
        weight /= np.repeat(np.add.reduceat(weight, start), n)
        bag = np.add.reduceat(weight[:, None] * code, start)
        score = 1 / (1 + np.exp(-np.clip(bag @ self.out + self.out_b, -30, 30)))
        return {"x": x, "code": code, "t": t, "g": g, "weight": weight, "bag": bag, "score": score}


def fit(x: np.ndarray, n: np.ndarray, y: np.ndarray, s: Settings) -> Model | float:
    """The model, or the share of label 1 where there is nothing to tell apart."""
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(s.seed)
    draw = lambda a, b: rng.normal(0, a**-0.5, (a, b)).astype(np.float32)
    x, y = x.astype(np.float32), y.astype(np.float32)
    m = Model(
        x.mean(0), x.std(0) + 1e-3, draw(x.shape[1], s.hidden), np.zeros(s.hidden, np.float32), draw(s.hidden, s.attention),
        draw(s.hidden, s.attention), draw(s.attention, 1)[:, 0], draw(s.hidden, 1)[:, 0], np.zeros(1, np.float32),
    )
    names = [f.name for f in fields(Model)][2:]
    first, second = ({k: np.zeros_like(getattr(m, k)) for k in names} for _ in range(2))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    balance = (balance / balance.sum()).astype(np.float32)
    for step in range(1, s.rounds + 1):
        f = m.forward(x, n)
        d_out = balance * (f["score"] - y)
        d_bag = np.repeat(d_out[:, None] * m.out, n, axis=0)
        along = (d_bag * f["code"]).sum(1)
        mean_along = np.add.reduceat(f["weight"] * along, np.cumsum(n) - n)
        d_weight = f["weight"] * (along - np.repeat(mean_along, n))
        d_t = d_weight[:, None] * m.att * f["g"] * (1 - f["t"] ** 2)
        d_g = d_weight[:, None] * m.att * f["t"] * f["g"] * (1 - f["g"])
        d_code = f["weight"][:, None] * d_bag + d_t @ m.tan.T + d_g @ m.gate.T
        d_code *= 1 - f["code"] ** 2
        slope = {
            "enc": f["x"].T @ d_code, "enc_b": d_code.sum(0), "tan": f["code"].T @ d_t, "gate": f["code"].T @ d_g,
            "att": (f["t"] * f["g"]).T @ d_weight, "out": f["bag"].T @ d_out, "out_b": np.array([d_out.sum()]),
        }
        for k in names:
            g = slope[k] + s.decay * getattr(m, k) * (k not in ("enc_b", "out_b"))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            setattr(m, k, getattr(m, k) - s.rate * move)
    return m


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Model | float:
    """Fits on the bounded sample; its passages' features come to the driver."""
    known = labels.select(F.col("doc_id").alias(P + "id"), F.col("quality").cast("int").alias(P + "y")).where(
        F.col(P + "y").isNotNull() & F.col(P + "id").isNotNull() & ~held_out(F.col(P + "id"))
    )
    sample = known.distinct().orderBy(F.xxhash64(P + "id"), P + "id", P + "y").limit(s.train_docs)
    rows = docs.select(F.col(id_col).alias(P + "doc"), F.col(text_col).alias("text"))
    # train_docs rows of 12 bytes: a bound that does not depend on the data.
    rows = rows.join(F.broadcast(sample), F.col(P + "doc") == F.col(P + "id"))
    # A doc_id that many rows repeat is worth its texts once each.
    rows = rows.select(P + "y", P + "id", "text", F.xxhash64("text").alias(P + "h")).dropDuplicates([P + "y", P + "id", P + "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x, n = passages(part.column("text"), s)
            start = np.cumsum(n) - n
            few = np.flatnonzero(n <= s.train_passages // 100)
            rows_ = pa.array(few)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(P + "id").take(rows_), part.column(P + "y").take(rows_), pa.array(n[few].astype(np.int32)),
                    pa.array([x[a : a + c].astype("<f4").tobytes() for a, c in zip(start[few], n[few])], pa.binary()),
                ],
                names=["id", "y", "n", "x"],
            )

    kind = labels.schema["doc_id"].dataType.simpleString()
    # The bound holds for a doc_id of many texts too.
    order = [F.xxhash64("id"), "id", "y", "x"]
    found = rows.mapInArrow(run, f"id {kind}, y int, n int, x binary").orderBy(*order).limit(s.train_docs)
    upto = F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # train_docs rows
    found = found.withColumn("upto", upto).where(F.col("upto") <= s.train_passages).collect()
    if not found:
        return 0.5
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in found), "<f4").reshape(-1, len(COUNTS) + s.buckets)
    return fit(x, np.array([r["n"] for r in found], np.int64), np.array([r["y"] for r in found], np.float64), s)


def score(docs: DataFrame, model: Model | float, s: Settings = Settings(), text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``mil__score``, ``mil__passages`` and
    ``mil__attention``, the weight of each passage."""
    names = [c for c in docs.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            x, n = passages(part.column(text_col), s)
            if isinstance(model, Model):
                f = model.forward(x.astype(np.float64), n)
                value, weight = f["score"], f["weight"]
            else:
                value, weight = np.full(len(n), model), np.repeat(1 / n, n)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names]
                + [pa.array(value), pa.array(n, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(weight, pa.float32()))],
                names=names + [P + "score", P + "passages", P + "attention"],
            )

    schema = StructType(
        [docs.schema[c] for c in names]
        + [StructField(P + "score", DoubleType()), StructField(P + "passages", IntegerType()), StructField(P + "attention", ArrayType(FloatType()))]
    )
    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    docs = docs.select("doc_id", "text")
    found = score(docs, train(docs, labels, s), s, keep_text=False)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(P + "score").alias("score"),
        F.when(F.col(P + "score") >= s.threshold, 1).otherwise(0).alias("predicted"),
    )
