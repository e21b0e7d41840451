"""op11 (vector codes) and op12 (sketch search) against plain Python."""
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_brute import SF

from strata.llm import sketch_search, vector_codes
from strata.llm.queries import op11_vector_codes, op12_sketch_search
from strata.llm.vector_codes import Settings, hilbert_keys

# ---------------------------------------------------------------- op11


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """[(id, vector, label)] -> sorted (id, code, error, label_error), codebook digest."""
    fine = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not fine:
        return [], None
    width = max(1, -(-max(len(v) for _, v, _ in fine) // parts)) * parts
    whole = [(i, [math.floor(4096 * x) for x in v], l) for i, v, l in fine]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    pad = lambda v: v + [0] * (width - len(v))
    d = width // parts
    cut = lambda v, p: pad(v)[p * d : p * d + d]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def assign(p):
        out = []
        for _, v, _ in whole:
            far = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e)) for e in books[p]]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        for p in range(parts):
            found = assign(p)
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), (e, _) in zip(whole, found) if e == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [assign(p) for p in range(parts)]
    error = [sum(last[p][r][1] for p in range(parts)) for r in range(len(whole))]
    by_label = Counter()
    for (_, _, l), e in zip(whole, error):
        by_label[l] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    rows = [
        (i, "".join(f"{last[p][r][0]:02x}" for p in range(parts)), error[r], by_label[l]) for r, (i, _, l) in enumerate(whole)
    ]
    return sorted(rows, key=repr), digest


def got_codes(df):
    rows = df.collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=repr), {r["codebooks_sha256"] for r in rows}


def test_op11_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, digest = brute_codes(rows)
    assert got_codes(op11_vector_codes(spark, SF)) == (want, {digest})


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=16)], int(i) % 3 or None) for i in range(80)]
    rows += [rows[7]] * 40  # a hot row
    rows += [(None, [0.5] * 16, 1), (None, [0.25] * 16, None), (200, [0.5] * 16, 1), (200, [-0.5] * 16, 1)]
    rows += [(-5, None, 1), (-4, [1.0, None], 1), (-3, [float("nan")] * 16, 1), (-2, [float("inf")] * 16, 2), (201, [1.0, -1.0], 2), (202, [], 2)]
    return rows


@pytest.mark.parametrize("n", [None, 9, 1])
def test_op11_odd_rows(spark, n):
    """Nulls, short vectors, repeated rows, fewer rows than entries, other columns."""
    rows = odd_vectors()[:n]
    want, digest = brute_codes(rows)
    df = spark.createDataFrame(
        [(i, v, l, "x", 1) for i, v, l in rows], "vec_id long, embedding array<double>, label int, code string, id int"
    ).repartition(5)
    assert got_codes(vector_codes.digest(df)) == (want, {digest})


def test_op11_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.digest(df).collect() == []
    assert vector_codes.digest(spark.createDataFrame([(1, None, 1)], df.schema)).collect() == []


def test_op11_wide_values_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64-bit"):
        vector_codes.digest(df)


def test_hilbert_neighbours_are_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack([x.ravel() for x in np.indices((1 << bits,) * dims)], 1)
        keys = [bytes(k) for k in hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(keys)
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(2)
    for spread in (3, 40, 400):
        points = rng.integers(-spread, spread, (640, 4))
        book = rng.integers(-spread, spread, (16, 4))
        far = ((points[:, None] - book) ** 2).sum(2)
        space = vector_codes.Space(4, -spread, spread)
        entry, error = vector_codes.encode(points, book, space, Settings(block=16))
        assert (entry == far.argmin(1)).all() and (error == far.min(1)).all()


def test_blocks_that_go_whole_are_not_opened(spark, monkeypatch):
    """Clustered points: most blocks have a shortlist of one entry."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = (centres[rng.integers(0, 16, 4096)] + rng.integers(-20, 20, (4096, 8)))
    space = vector_codes.Space(8, int(points.min()), int(points.max()))
    order = np.lexsort(space.keys(points, Settings()).T[::-1])
    _, low, high, *_ = vector_codes.boxes(points[order], np.ones(4096, np.int64), Settings(block=16))
    alone = vector_codes.shortlists(low, high, centres).sum(1) == 1
    assert alone.mean() > 0.8


# ---------------------------------------------------------------- op12

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def brute_ranks(docs, items, k=50):
    """[(doc_id, text)], [(item_id, text)] -> sorted (item_id, rank, doc_id, score)."""
    split = [(d, TERM.findall((t or "").translate(LOW))) for d, t in docs]
    split = [(d, w) for d, w in split if w]
    n, length = len(split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    counts = [(d, Counter(w), 50 + 50 * len(w) * n // length) for d, w in split]
    out = []
    for item, text in set(items):
        asked = set(TERM.findall((text or "").translate(LOW)))
        scores = []
        for d, tf, m in counts:
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in asked if t in tf
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got_ranks(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def test_op12_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got_ranks(op12_sketch_search(spark, SF)) == brute_ranks(docs, items)


def odd_documents():
    rng = np.random.default_rng(8)
    word = lambda: f"w{int(rng.zipf(1.4)) % 300}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for i in range(150)]
    docs += [docs[3]] * 70 + [(500 + i, docs[5][1]) for i in range(60)]  # repeated rows, ties
    docs += [(None, docs[5][1]), (None, None), (600, None), (601, ""), (602, " .,- "), (603, "Ünïcode W7 w7.W7 ÜNÏCODE x\x00y")]
    docs.append((604, " ".join(f"w{i % 3000}" for i in range(60_000))))
    return docs


def odd_items():
    return [(1, "W1 w2, w3 w1"), (2, "w7 Ünïcode nowhere"), (3, ""), (4, None), (5, "nowhere"), (6, "w5"), (6, "w5"), (6, "w9 w11"), (None, "w4 w8"),
            (7, " ".join(f"w{i}" for i in range(400)))]


@pytest.mark.parametrize("s", [sketch_search.Settings(), sketch_search.Settings(k=5, coordinates=8, block_items=3, merges=2)])
def test_op12_odd_rows(spark, s):
    docs, items = odd_documents(), odd_items()
    df = spark.createDataFrame([(d, t, "x", 1.0, 0) for d, t in docs], "doc_id long, text string, item_id string, score double, n int").repartition(6)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    assert got_ranks(sketch_search.ranked(df, asked, s=s)) == brute_ranks(docs, items, s.k)


def test_op12_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert sketch_search.digest(docs, items).collect() == []
    assert sketch_search.digest(spark.createDataFrame([(1, "w1")], docs.schema), items.limit(0)).collect() == []
    assert sketch_search.digest(spark.createDataFrame([(1, None), (2, "..")], docs.schema), items).collect() == []


def test_sketches_bound_every_score():
    counts = [Counter(f"t{x}".encode() for x in np.random.default_rng(i).integers(0, 500, 200)) for i in range(30)]
    s = sketch_search.Settings(coordinates=64)
    found = sketch_search.sketches(counts, [80] * 30, s)
    for d, c in enumerate(counts):
        assert all(found[d, hash(t) & 63] >= sketch_search.impact(f, 80) for t, f in c.items())
