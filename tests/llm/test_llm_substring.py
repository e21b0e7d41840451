import numpy as np
import pytest
from llm_brute import SF, sha, substring_dedup

from strata.llm import substring
from strata.llm.fm_index import FMIndex, repeated_windows
from strata.llm.queries import op1_substring_dedup
from strata.llm.substring import Settings, dedup, without_repeats


def got(df):
    return {r["doc_id"]: (r["sub__n_words"], r["sub__n_removed"], r["sub__kept"] or "") for r in df.collect()}


def test_query_equals_brute_force_on_the_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {k: (n, m, sha(t)) for k, (n, m, t) in substring_dedup(docs, 35).items()}
    rows = op1_substring_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want
    assert sum(m for _, m, _ in want.values()) > 0


def test_hot_keys_and_small_indexes_change_nothing(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 9, 60).astype(str).tolist()
    docs = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 4):
            w[rng.integers(0, 60)] = f"u{rng.integers(0, 5)}"
        docs.append((i, " ".join(w[: 30 + i % 30])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = substring_dedup(docs, 6)
    for s in (Settings(width=6, gram=3), Settings(width=6, gram=3, hot=2, index_words=50), Settings(width=6, gram=6, hot=1)):
        assert got(dedup(df, s=s)) == want
    # More hot keys than a list may hold; rows repeated whole count each time.
    twice = df.unionByName(df.where("doc_id % 7 = 0"))
    list_of_keys, by_join = Settings(width=6, gram=3, hot=2), Settings(width=6, gram=3, hot=2, hot_keys=0)
    assert got(dedup(df, s=by_join)) == want
    plain = sorted(map(str, dedup(twice, s=list_of_keys).select("doc_id", "sub__kept", "sub__spans").collect()))
    assert plain == sorted(map(str, dedup(twice, s=by_join).select("doc_id", "sub__kept", "sub__spans").collect()))
    cut = lambda s: substring._seen(substring._rows(twice, "doc_id", "text"), s)
    columns = ["h1", "h2", "key", "content", "pos"]
    assert sorted(map(tuple, cut(list_of_keys).select(columns).collect())) == sorted(map(tuple, cut(by_join).select(columns).collect()))


def test_no_key_fills_an_index(spark):
    """A third of the documents hold one passage in different surroundings: the
    different segments of a key stay within the fixed bound, at any size."""
    from pyspark.sql import functions as F

    for n in (300, 1500):
        docs = [(i, (f"a{i} b{i} c{i} " + "p q r s t u " + f"d{i} e{i} f{i}") if i % 3 == 0 else " ".join(f"x{i}y{j}" for j in range(12))) for i in range(n)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        for hot_keys in (10, 0):
            s = Settings(width=8, gram=4, hot=40, hot_keys=hot_keys)
            seen = substring._seen(substring._rows(df, "doc_id", "text"), s)
            assert (seen.groupBy("key").agg(F.count_distinct("content").alias("n")).agg(F.max("n")).first()[0] or 0) <= s.hot
        assert got(dedup(df, s=Settings(width=6, gram=4, hot=40))) == substring_dedup(docs, 6)


def test_nulls_empty_long_repeated_rows_and_clashing_columns(spark):
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f a b c d x"), (5, "z " * 3000 + "end"),
        (6, "q w e r t"), (7, "q w e r t"), (8, "é ü x é ü x é"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as h1", "2 as content", "3 as pos", "4 as sub")
    s = Settings(width=4, gram=2)
    out = dedup(df, s=s)
    assert got(out) == substring_dedup(docs, 4)
    assert out.columns[:6] == df.columns
    spans = {r["doc_id"]: r["sub__spans"] for r in out.collect()}
    assert spans[4] == [[0, 3], [6, 9]] and spans[1] == []
    kept = {r["doc_id"]: r["text"] for r in without_repeats(df, s=s).collect()}
    assert kept[1] is None and kept[3] == " \t\n" and kept[4] == "e f x"  # an untouched text stays as it was
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d e")], "doc_id long, text string")
    assert sorted(r["sub__n_removed"] for r in dedup(twice, s=s).collect()) == [4, 4, 4]
    assert dedup(df.limit(0), s=s).count() == 0
    with pytest.raises(ValueError):
        Settings(width=90, gram=2)


def test_backward_search_reports_exactly_the_repeated_windows():
    from collections import Counter

    rng = np.random.default_rng(1)
    for _ in range(80):
        width, base = int(rng.integers(2, 7)), rng.integers(1, 5, 200)
        seqs = []
        for _ in range(rng.integers(1, 10)):
            n, a = int(rng.integers(1, 50)), int(rng.integers(0, 140))
            x = base[a : a + n].copy()
            x[rng.integers(0, n)] = rng.integers(1, 6)
            seqs.append(x)
        text = np.concatenate([np.append(x, 0) for x in seqs])
        length = np.array([len(x) for x in seqs])
        start = np.cumsum(length + 1) - length - 1
        mask = repeated_windows(FMIndex(text, 6), text, start, length, width)
        often = Counter(tuple(x[k : k + width]) for x in seqs for k in range(len(x) - width + 1))
        for x, m in zip(seqs, mask):
            assert int(m) == sum(1 << k for k in range(len(x) - width + 1) if often[tuple(x[k : k + width])] > 1)


def test_equal_windows_have_equal_keys():
    import pyarrow as pa

    from strata.llm.common import words_of

    text = " ".join(f"w{i % 37}" for i in range(200))
    w = words_of(pa.array([text, "x " + text]))
    doc, first, n, key, _ = substring.segments(w, Settings(width=10, gram=4), np.zeros(0, np.uint64))
    keys = [{}, {}]
    for d, f, m, k in zip(doc, first, n, key):
        for j in range(m):
            keys[d][f + j] = k
    assert len(keys[0]) == 191
    assert all(keys[1][i + 1] == k for i, k in keys[0].items())
