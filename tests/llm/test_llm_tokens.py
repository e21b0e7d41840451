import os
import subprocess
import sys
import zlib

import numpy as np
import pytest
from llm_brute import SF, sha

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from strata.llm import bpe, token_files  # noqa: E402
from strata.llm.id_cache import IdCache  # noqa: E402
from strata.llm.queries import op2_token_files, op4_bpe  # noqa: E402

ODD = [
    None, "", " ", "\n", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>c<|endoft", "İstanbul ΣΑΣ Σ é ́x", "\x85 a\x1c \x1d b",
    "don't I'LL you're 12345 　  x\u0085y", "中文字符测试，你好 wörld ﬁ Å 각 \U0001F600\U0001F469‍\U0001F469",
    "q" * 4000 + "xq" * 300, "  lead  trail  \n\n", "x'S 's don't,'s '", "a,b.c;d(e)f-g_h", "\x00a\x7fb", "word  x  y\n\n z  w",
]


@pytest.fixture(scope="module")
def texts(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    return docs + [(10**6 + i, t) for i, t in enumerate(ODD)]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_word_bpe_equals_the_library_and_decodes(spark, texts):
    tok = library("word_bpe_49k.json")
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as ids")
    rows = {r["doc_id"]: r for r in bpe.encode(df, decoded_col="back").collect()}
    for k, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[k]["bpe__ids"], "<u4").tolist() == ids, t
        assert rows[k]["back"] == tok.decode(ids, skip_special_tokens=False)
        assert rows[k]["text"] == t


def test_op4_digest(spark):
    tok = library("word_bpe_49k.json")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op4_bpe(spark, SF).collect():
        ids = tok.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha(tok.decode(ids, skip_special_tokens=False))


def test_cuts_never_part_a_token():
    own = bpe.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for t in own.tokens:
        piece = t[: -len(own.suffix)] if t.endswith(own.suffix) else t
        if t not in own.special:
            assert own.cuts(piece) == [piece]
    assert any(len(own.cuts(a + b)) == 2 for a in "jqxz" for b in "jqxz")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 16, 17, 24, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003, dtype=np.uint64).astype("<u4")
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1003 * bits // 8)
    assert (token_files.unpack(packed, 1003, bits) == ids).all()


def test_vocabulary_sizes():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access_crosses_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << 17, n, dtype=np.uint64).astype("<u4") for n in (0, 1, 63, 64, 65, 1000, 0, 7)]
    out = token_files.PackedWriter(f"{tmp_path}/a/x.ids", 17)
    for i, d in enumerate(docs):
        out.add(i if i else None, d)
    out.close()
    file, whole = token_files.PackedReader(f"{tmp_path}/a/x.ids"), np.concatenate(docs)
    assert file.docs == [None, *range(1, 8)] and file.counts.tolist() == [len(d) for d in docs]
    for a, n in ((0, 0), (0, 1), (60, 10), (63, 1), (64, 64), (5, 1100), (1199, 1)):
        assert (file.ids(a, n) == whole[a : a + n]).all()


def test_op2_files_equal_the_library(spark, texts):
    tok = library("byte_bpe_50k.json")
    df = spark.createDataFrame(texts[::-1] + [(None, "x"), (7, "again")], "doc_id long, text string")
    rows = sorted(token_files.digest(df).collect(), key=lambda r: r["start"])
    at, ids = 0, []
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        ids.append(r["doc_id"])
    assert ids == [None] + sorted(k for k in ids if k is not None) and ids.count(7) == 2
    want = {k: tok.encode(t or "", add_special_tokens=False).ids + [2] for k, t in texts}
    for r in rows:
        if r["doc_id"] in want and r["doc_id"] != 7:
            assert r["ids_crc32"] == zlib.crc32(np.array(want[r["doc_id"]], "<u4").tobytes())
    assert token_files.digest(df.limit(0)).count() == 0


def test_op2_query(spark):
    rows = op2_token_files(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in rows)


def test_a_full_cache_starts_anew():
    cache = IdCache(most=3)
    data = np.frombuffer(b"abcdefgh", np.uint8)
    at = np.arange(8)
    for _ in range(3):
        out = cache.encode(data, at, at + 1, np.array([0, 3, 3, 8]), lambda units, _: ([u[0], u[0]] for u in units))
        assert [np.frombuffer(x, "<u4").tolist() for x in out] == [[97, 97, 98, 98, 99, 99], [], [100, 100, 101, 101, 102, 102, 103, 103, 104, 104]]


@pytest.mark.skipif(not os.path.isdir("/proc/self/task"), reason="threads are counted in /proc")
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoding_starts_no_threads(name):
    code = f"""
import os
import pyarrow as pa
from strata.llm import bpe, token_files
own = (bpe.encoder if {name!r}.startswith("word") else token_files.tokenizer)(bpe.vocabulary({name!r}))
texts = pa.array([" ".join(f"{{w}}{{i}}" for w in ("alpha", "Beta", "x-y", "q'r")) for i in range(3000)])
before = len(os.listdir("/proc/self/task"))
print(len(own.encode_texts(texts)), len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["3000", "0"], out.stderr
