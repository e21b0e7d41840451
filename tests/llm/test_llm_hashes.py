"""Names of words, windows and units must not collide for certain."""
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_brute import rule_counts, shingles, substring_dedup
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bpe, common, id_cache, ngram_join, quality_rules, substring, token_files


def thue_morse(n, a, b):
    out = [a]
    while len(out) < n:
        out += [b if x == a else a for x in out]
    return out[:n]


#: Sequences that every polynomial modulo 2**64 takes for one another.
PAIR = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
LONG = " ".join(thue_morse(2048, "left", "right")), " ".join(thue_morse(2048, "right", "left"))


def test_hashes_tell_the_sequences_apart():
    text = "".join(PAIR).encode() + b"12345678" * 80 + b"xy"
    data = np.frombuffer(text, np.uint8)
    a = np.array([0, 1024, 0, 3, 2048, 2056, 2048, 2112])
    b = np.array([1024, 2048, 300, 9, 2056, 2064, 2648, 2688])
    got = common.bytes_hash(data, a, b)
    same = {}
    for h, x, y in zip(got.tolist(), a, b):
        assert same.setdefault(h, text[x:y]) == text[x:y]
    assert len(same) == len({text[x:y] for x, y in zip(a, b)})
    symbols = common.mix64(np.array([1 if w == "left" else 2 for x in LONG for w in x.split()], np.uint64))
    for n in (32, 1024, 2048):
        x, y = common.range_hash(symbols, np.array([0, 2048]), np.array([n, 2048 + n]))
        assert x != y and len(set(common.window_hash(symbols, n)[[0, 2048]].tolist())) == 2


@pytest.mark.parametrize("width", [1, 2, 3, 5, 12, 35])
def test_window_hash_is_a_function_of_the_window(width):
    rng = np.random.default_rng(width)
    values = rng.integers(0, 3, 500).astype(np.uint64)
    got = common.window_hash(values, width)
    assert len(got) == 500 - width + 1 and len(common.window_hash(values[: width - 1], width)) == 0
    name = {}
    for i, h in enumerate(got.tolist()):
        assert name.setdefault(tuple(values[i : i + width].tolist()), h) == h
    assert len(set(name.values())) == len(name)


def odd_texts():
    return [PAIR[0], PAIR[1], "\n".join(PAIR), "\n".join([*PAIR, PAIR[0]]), *LONG, f"{LONG[0]} {LONG[1]}", f"{PAIR[0]} {PAIR[1]} {PAIR[0]}", None, ""]


def frame(spark):
    return spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").withColumn("source", F.lit("s"))


def test_op1_and_op3_tell_them_apart(spark):
    docs = list(enumerate(odd_texts()))
    want = substring_dedup(docs, 35)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.digest(frame(spark)).collect()}
    assert got == {k: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for k, (n, gone, kept) in want.items()}
    for r in quality_rules.digest(frame(spark)).collect():
        n, chars, symbols, dup, again, _ = rule_counts(docs[r["doc_id"]][1])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, again)


def test_op8_links_none_of_them(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.digest(frame(spark)).collect()}
    sets = [shingles(t) for t in odd_texts()]
    assert {k: n for k, (n, _) in got.items()} == {k: len(s) for k, s in enumerate(sets)}
    assert got[0][1] == 0 and got[1][1] == 1


@pytest.mark.parametrize("few", [False, True])
def test_op2_and_op4_equal_the_library(few, monkeypatch):
    """Also when hashes are so few that nearly all units share one."""
    if few:
        real = common.bytes_hash
        monkeypatch.setattr(id_cache, "bytes_hash", lambda *a: real(*a) % np.uint64(5))
    texts = [t or "" for t in odd_texts()] + ["some more words", "words more some, some words!", "a b c d e f g h i j k l", "longer-than-eight bytes, longer-than-eight bits"]
    for encoder, name in ((bpe.BoundaryEncoder, "word_bpe_49k.json"), (token_files.LibraryTokenizer, "byte_bpe_50k.json")):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        mine = encoder(path)
        for _ in range(2):
            got = [np.frombuffer(x, "<u4").tolist() for x in mine.encode_texts(pa.array(texts))]
            assert got == want
