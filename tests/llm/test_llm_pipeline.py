import hashlib

import numpy as np
from llm_brute import SF, jaccard_components, rule_counts, substring_dedup, words

import corpus_pipeline
from strata.llm import mixing


def test_stages_equal_their_brute_force_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    stage = [f for _, f in corpus_pipeline.STAGES]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = stage[0](spark, docs, SF).cache()
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in good.collect()}
    for k, t in text.items():
        n, _, symbols, dup, again, lines = rule_counts(t)
        base = n < 50 or 100 * again > 50 * n
        clean = not base and symbols == 0 and dup == 0
        assert (k not in kept) if base or symbols > 0.1 * n else (k in kept) if clean else True

    near = stage[1](spark, good, SF).cache()
    want = {c for _, _, c in jaccard_components([(k, text[k]) for k in kept])}
    assert {r["doc_id"] for r in near.collect()} == want and near.columns == docs.columns

    cut = stage[2](spark, near, SF).cache()
    brute = substring_dedup([(k, text[k]) for k in want], 35)
    for r in cut.collect():
        assert r["text"] == (brute[r["doc_id"]][2] if brute[r["doc_id"]][1] else text[r["doc_id"]])
        assert not brute[r["doc_id"]][1] or r["n_chars"] == len(r["text"])

    mixed = stage[3](spark, cut, SF).cache()
    plan = {r["doc_id"]: r for r in mixing.plan(cut).collect()}
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r["mix__copies"]) for r in plan.values())
    taken = sum(len(words(r["text"])) for r in mixed.collect())
    total = sum(len(words(r["text"])) for r in cut.collect())
    assert abs(taken / total - 1.5) < 0.1

    rows = stage[4](spark, mixed, SF).collect()
    assert len(rows) == mixed.count()
    for r in rows[:20]:
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest()
        assert len(np.frombuffer(r["ids"], "<u4")) == r["n_tokens"]


def test_run_takes_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, " ".join(f"w{i}" for i in range(80)), "en", "s", 400),
            (4, " ".join(f"w{i}" for i in range(80)), "en", "s", 400), (None, " ".join(f"v{i}" for i in range(60)), None, None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, part in enumerate((rows, [])):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{k}/documents.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/0")
    assert {r["doc_id"] for r in out.collect()} <= {3, None} and out.count() >= 2
    assert corpus_pipeline.run(spark, f"{tmp_path}/1").count() == 0
