"""op13 (SimHash near-duplicates) against comparing all pairs of fingerprints."""
import re

import numpy as np
import pytest
import xxhash
from llm_brute import SF
from pyspark.sql import functions as F

from strata.llm import simhash
from strata.llm.queries import op13_simhash
from strata.llm.simhash import Settings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = [
    Settings(),
    Settings(block=6, chunk_rows=20, chunk_pairs=7),
    Settings(block=4, widest=9, chunk_rows=50),
    Settings(segments=4),
    Settings(segments=2, block=8),
    Settings(segments=6),
]


def brute_fingerprint(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, distance=4):
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    label = np.arange(len(x))
    while True:
        least = np.where(near, label[None, :], len(x)).min(1)
        if (least == label).all():
            break
        label = least
    least = {}
    for k, r in zip(ids, label.tolist()):
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return [(k, f"{f:016x}", least[r]) for k, f, r in zip(ids, fps, label.tolist())]


def brute(docs):
    return sorted(brute_components([k for k, _ in docs], [brute_fingerprint(t) for _, t in docs]), key=repr)


def rows(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def test_op13_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert rows(op13_simhash(spark, SF)) == want and any(k != c for k, _, c in want)


def test_sparks_xxhash64_is_the_same_hash(spark):
    texts = ["", "a", "abc defg hij klm", "x" * 31, "ü" * 40]
    got = [r[0] % (1 << 64) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert got == [xxhash.xxh64_intdigest(t, 42) for t in texts]


def odd_documents():
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 900, 120)]
    docs = [(i, " ".join(f"v{x}" for x in rng.integers(0, 5000, 30))) for i in range(40)]
    for i in range(60):  # a dense group
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            w[rng.integers(0, 120)] = f"u{rng.integers(0, 99)}"
        docs.append((100 + i, " \t\n".join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [docs[0]] * 30 + [(None, docs[45][1]), (None, "only one of these here"), (300, None), (301, ""), (302, " \n\t"), (303, "a"), (304, "A b"),
             (305, "a b c d"), (306, " x  y")]
    docs.append((307, "long " * 70_000 + " ".join(f"z{i}" for i in range(40_000))))
    return docs


def test_op13_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, other columns with clashing names."""
    docs = odd_documents()
    df = spark.createDataFrame([(k, t, 1, "x", 0) for k, t in docs], "doc_id long, text string, fp int, least string, root int").repartition(5)
    assert rows(simhash.digest(df)) == brute(docs)


def test_op13_empty_table(spark):
    assert simhash.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def crowd():
    """Fingerprints: chains and dense clouds around hot values, and far ones."""
    rng = np.random.default_rng(9)
    out = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for centre in out[:3]:
        for _ in range(70):
            x = centre
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    x = 0
    for b in rng.choice(64, 30, replace=False):  # a chain in steps of at most 4 bits
        x ^= 1 << int(b)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("s", SMALL)
def test_links_connect_what_all_pairs_connect(spark, s):
    fps = crowd()
    rng = np.random.default_rng(1)
    ids = rng.permutation(len(fps)).tolist()
    want = {f: c for _, f, c in brute_components(ids, fps)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    label = {f"{f:016x}": f"{f:016x}" for f in fps}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in simhash.links(df, s).collect():
        label[root(f"{a % (1 << 64):016x}")] = root(f"{b % (1 << 64):016x}")
    found = {}
    for f in label:
        found.setdefault(root(f), []).append(f)
    wanted = {}
    for f, c in want.items():
        wanted.setdefault(c, []).append(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))


def test_a_hot_cell_is_dealt_into_bounded_tasks(spark, monkeypatch):
    most, real = [], simhash.stars

    def stars(fp, group, stored, s):
        most.append(int(np.bincount(group).max()))
        return real(fp, group, stored, s)

    rows_ = spark.range(4000).select(F.col("id").bitwiseXOR(F.lit(1 << 40)).alias("fp"))  # one value in two segments
    s = Settings(block=200)
    large = simhash.cells(rows_, s).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert large >= 4000
    placed = []
    monkeypatch.setattr(simhash, "_compare", lambda p, s: placed.append(p) or p.selectExpr("fp as a", "fp as b").limit(0))
    simhash.links(rows_, s).collect()
    biggest = placed[0].groupBy("cell", "one", "two").count().agg(F.max("count")).first()[0]
    assert biggest <= 4 * s.block
