"""Quality rules with host verdicts.

Each document gets counts, the counts give rule failures, and the failures
are summed by host.  A host's failure rate is shrunk towards the corpus by a
beta prior whose two parameters come from the spread of the hosts themselves
(method of moments), so that a host with few documents is judged by the
corpus and one with many by its own record.  The host verdict goes back to
its documents: on a suspect host the tighter set of limits holds.

A document is kept when it passes the base rules and the limits that its host
calls for.  A document that fails no limit is kept on every host.

Defined results: null and empty texts have no words and fail the base rule;
null hosts form one host; repeated rows count as often as they occur; an
empty table gives an empty table; other columns pass through unchanged.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bytes_hash, mix64, saved, slices, window_hash, words_of

#: Counts of a document, as columns beside its own; the prefix keeps them apart.
PREFIX = "rules__"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Largest shares that pass.  ``strict`` ones hold on suspect hosts."""

    symbols_per_word: float = 0.10
    dup_lines_per_line: float = 0.30
    #: Fewer repeated lines than this are no pattern, whatever their share.
    least_dup_lines: int = 3
    chars_per_word: float = 40.0
    strict_share: float = 0.5
    #: A host whose shrunk failure rate is above this is suspect.
    suspect_rate: float = 0.5
    #: Hosts up to this number (some 30 bytes each) may be broadcast; more are joined by shuffle.
    broadcast_hosts: int = 200_000


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def _distinct_repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how often its value occurs in its document; whether it is the first."""
    key = mix64(value + mix64(doc.astype(np.uint64) + np.uint64(1)))
    _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(key), bool)
    is_first[first] = True
    return count[back], is_first


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    w = words_of(texts)
    n, n_words, doc = len(w.text_start), w.counts(), w.doc()
    whole = (w.data & 0xC0) != 0x80  # first byte of a code point
    chars = _sums(whole, w.start, w.end)
    symbols = _sums(_IS_SYMBOL[w.data], w.text_start, w.text_end)

    # Lines: between line feeds and the ends of texts.
    feed = np.flatnonzero(w.data == 10)
    l0 = np.sort(np.concatenate([w.text_start, feed + 1]))
    l1 = np.sort(np.concatenate([w.text_end, feed]))
    per_line = np.searchsorted(w.start, l1) - np.searchsorted(w.start, l0)
    l0, l1 = l0[per_line > 0], l1[per_line > 0]
    line_doc = np.searchsorted(w.text_start, l0, "right") - 1
    _, first = _distinct_repeats(line_doc, bytes_hash(w.data, l0, l1))

    # Words in 3-word windows that occur twice or more in the document.
    covered = np.zeros(len(w.start), bool)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    if len(at):
        times, _ = _distinct_repeats(doc[at], window_hash(w.hashes(), 3)[at])
        again = at[times > 1]
        for k in range(3):
            covered[again + k] = True
    return {
        "n_words": n_words,
        "word_chars": np.bincount(doc, chars, n).astype(np.int64),
        "n_symbols": symbols,
        "n_dup_lines": np.bincount(line_doc[~first], minlength=n),
        "n_repeat_words": np.bincount(doc[covered], minlength=n),
        "n_lines": np.bincount(line_doc, minlength=n),
    }


def with_counts(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with their counts (columns PREFIX + name)."""
    names = [c for c in docs.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            own = [part.column(c) for c in names]
            found = counts(part.column(text_col))
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(found[c].astype(np.int64)) for c in COUNTS],
                names=names + [PREFIX + c for c in COUNTS],
            )

    schema = StructType(
        [docs.schema[c] for c in names] + [StructField(PREFIX + c, LongType()) for c in COUNTS]
    )
    return docs.mapInArrow(run, schema)


def _n(name: str) -> Column:
    return F.col(PREFIX + name)


def base_failed() -> Column:
    return (_n("n_words") < 50) | (100 * _n("n_repeat_words") > 50 * _n("n_words"))


def rule_failures(limits: Limits, share: float = 1.0) -> dict[str, Column]:
    """Rule -> whether the document fails it, with limits times ``share``."""
    words, lines = F.greatest(_n("n_words"), F.lit(1)), F.greatest(_n("n_lines"), F.lit(1))
    return {
        "symbols": _n("n_symbols") > limits.symbols_per_word * share * words,
        "dup_lines": (_n("n_dup_lines") >= limits.least_dup_lines)
        & (_n("n_dup_lines") > limits.dup_lines_per_line * share * lines),
        "long_words": _n("word_chars") > limits.chars_per_word * share * words,
    }


def host_rates(counted: DataFrame, host_col: str, limits: Limits) -> DataFrame:
    """One row per host: documents, failed documents, shrunk rate, suspect.

    The prior is moment-matched over hosts: with rates p_h of mean m and
    variance v, a + b = m (1 - m) / v - 1.  A corpus of one host, or hosts that
    all agree, has no spread to learn from: the prior then weighs one document.
    """
    failed = base_failed()
    for rule in rule_failures(limits).values():
        failed = failed | rule
    hosts = saved(
        counted.groupBy(F.col(host_col).alias("host")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(failed.cast("long")).alias("failures")
        )
    )
    rate = F.col("failures") / F.col("n")
    m, v = hosts.agg(F.avg(rate), F.var_samp(rate)).first()
    m = min(max(m or 0.0, 1e-6), 1 - 1e-6)
    weight = max(m * (1 - m) / v - 1, 1e-3) if v else 1.0
    shrunk = (F.col("failures") + m * weight) / (F.col("n") + weight)
    return hosts.withColumn("rate", shrunk).withColumn("suspect", F.col("rate") > limits.suspect_rate)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
    keep_text: bool = True,
) -> DataFrame:
    """The documents with their counts, ``rules__base_failed``,
    ``rules__host_rate``, ``rules__host_suspect`` and ``rules__kept``."""
    counted = with_counts(docs, text_col, keep_text)
    # The counts of the hosts need no text: the scan is read again without shuffling it.
    hosts = host_rates(
        with_counts(docs.select(host_col, text_col), text_col, keep_text=False), host_col, limits
    )
    hosts = hosts.select(
        F.col("host").alias(PREFIX + "host"),
        F.col("rate").alias(PREFIX + "host_rate"),
        F.col("suspect").alias(PREFIX + "host_suspect"),
    )
    if hosts.count() <= limits.broadcast_hosts:
        hosts = F.broadcast(hosts)
    joined = counted.join(hosts, counted[host_col].eqNullSafe(hosts[PREFIX + "host"]), "left")
    own, tight = F.lit(False), F.lit(False)
    for rule in rule_failures(limits).values():
        own = own | rule
    for rule in rule_failures(limits, limits.strict_share).values():
        tight = tight | rule
    return (
        joined.drop(PREFIX + "host")
        .withColumn(PREFIX + "base_failed", base_failed())
        .withColumn(
            PREFIX + "kept", ~F.col(PREFIX + "base_failed") & ~own & ~(F.col(PREFIX + "host_suspect") & tight)
        )
    )


def kept_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Rows of ``docs`` that pass, with their columns as they were."""
    return judge(docs, text_col, host_col, limits).where(F.col(PREFIX + "kept")).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    found = judge(docs.select("doc_id", "source", "text"), keep_text=False)
    return found.select(
        "doc_id",
        *[F.col(PREFIX + c).alias(c) for c in COUNTS[:5]],
        *[F.col(PREFIX + c).alias(c) for c in ("base_failed", "kept")],
    )
