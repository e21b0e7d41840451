import numpy as np
import pytest
from llm_brute import SF, sha
from pyspark.sql import functions as F

from strata.llm import chat, mil_quality
from strata.llm.chat import Template, format_conversations, read_turns
from strata.llm.mil_quality import Settings


def check(turns_df):
    groups = {}
    for c, t, r, x in [tuple(r)[:4] for r in turns_df.collect()]:
        groups.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    rows = {r["conv_id"]: r for r in chat.digest(turns_df).collect()}
    assert rows.keys() == groups.keys()
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss))
        assert (rows[c]["n_turns"], rows[c]["turns_sha256"], rows[c]["loss_chars"], rows[c]["loss_sha256"]) == want
    return rows


ODD = [
    (None, None, None, None), (9001, 1, "tool]x\\", "a [TURN b]\\[INST]\\\\ </s"), (9001, 0, "weird[TURN ", "[INST"),
    (9001, 2, "assistant", "<s>\\"), (9002, 0, "assistant", ""), (9003, 0, "user", "x"), (9003, 0, "user", "x"),
    (9003, 1, "assistant", "é\U0001F600</s></s>"), (9004, 0, "user", "[[INST]]<</s>>\n[OUT] [/INST]"), (9004, 1, "assistant", "\\" * 7 + "[SYS]"),
    (9005, 0, "system", None), (9005, 1, "user", "long " * 5000), (9005, 2, "assistant", "a"), (9005, 3, "assistant", "b"),
]


def test_turns_and_loss_come_back(spark):
    base = chat.with_probe(spark, SF)
    rows = check(base.unionByName(spark.createDataFrame(ODD, base.schema)).selectExpr("*", "1 as at", "2 as open"))
    assert rows[-1]["n_turns"] == 2 and rows[-1]["valid"]
    assert rows[9005]["first_bad_turn"] == 3 and not rows[9002]["valid"]
    assert chat.digest(base.limit(0)).count() == 0


def test_segments_tile_the_text_and_carry_the_loss(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u[INST]"), (1, 2, "assistant", "é<s>")], "conv_id int, turn int, role string, text string")
    row = format_conversations(df).first()
    assert row["formatted"] == "[SYS] s [/SYS][INST] u[\\INST] [/INST][OUT] é<\\s></s>"
    at = 0
    for s in row["segments"]:
        assert s["start"] == at
        at += s["length"]
    assert at == len(row["formatted"])
    learned = [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["segments"] if s["loss"]]
    assert learned == ["é<\\s>"] and row["valid"] and row["first_bad_turn"] is None


def test_other_templates(spark):
    t = Template(
        markers={"a": ("<A>", "</A>"), "b": ("<B>", "</B>")}, other=("<X ", "]>", "</X>"), learned=("a", "b"),
        controls=("<A>", "</A>", "<B>", "</B>", "<X ", "</X>"), transitions={"start": {"a": "a"}, "a": {"b": "b"}}, final=("b",),
    )
    df = spark.createDataFrame([(1, 0, "a", "<A>x"), (1, 1, "b", "y</B>"), (2, 0, "b", ""), (2, 1, "c]", "z")], "conv_id int, turn int, role string, text string")
    out = format_conversations(df, t)
    got = {r["conv_id"]: ([tuple(x) for x in r["t"]], r["valid"]) for r in out.select("conv_id", read_turns(out["formatted"], t).alias("t"), "valid").collect()}
    assert got == {1: ([("a", "<A>x"), ("b", "y</B>")], True), 2: ([("b", ""), ("c]", "z")], False)}
    with pytest.raises(ValueError):
        Template(controls=("[IN[ST]",))


def test_plan_has_no_python(spark):
    plan = chat.digest(chat.with_probe(spark, SF))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = mil_quality.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    base = max(np.mean([r["quality"] for r in rows]), 1 - np.mean([r["quality"] for r in rows]))
    assert len(rows) > 40 and right >= 0.95 and right > base
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_fifth_is_not_learned_from(spark):
    import zlib

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    turned = labels.selectExpr("doc_id", f"case when doc_id in ({','.join(map(str, held))}) then 1 - quality else quality end as quality")
    s = Settings(rounds=5)
    a, b = ({r["doc_id"]: (r["score"], r["held_out"]) for r in mil_quality.digest(docs, x, s).collect()} for x in (labels, turned))
    assert a == b and {k for k, v in a.items() if v[1]} >= set(held)


def test_odd_documents(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "a b"), (2, "x " * 5000)], "doc_id long, text string").selectExpr("*", "'q' as quality", "1 as score")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    rows = mil_quality.digest(df, labels).collect()
    assert [r["score"] for r in rows] == [0.5] * 4
    model = mil_quality.train(df, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), Settings(rounds=3))
    out = mil_quality.score(df, model)
    assert out.columns[:4] == df.columns
    for r in out.collect():
        assert len(r["mil__attention"]) == r["mil__passages"] and abs(sum(r["mil__attention"]) - 1) < 1e-4
    assert max(r["mil__passages"] for r in out.collect()) == -(-5000 // 64)
    assert mil_quality.score(df.limit(0), model).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    n = np.array([1, 3, 2, 5])
    x, y = rng.normal(size=(11, 6)).astype(np.float32), np.array([1.0, 0, 1, 0])
    first, last = (mil_quality.fit(x, n, y, Settings(rounds=r, hidden=4, attention=3)) for r in (1, 150))
    loss = lambda m: -np.mean(np.log(np.where(y == 1, (p := m.forward(x, n)["score"]), 1 - p) + 1e-9))
    assert loss(last) < 0.2 < loss(first)


def test_repeated_rows_do_not_fill_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mil_quality, "fit", lambda x, n, y, s: seen.append(y.tolist()) or 0.5)
    ids = [r["id"] for r in spark.range(40).where(~mil_quality.held_out(F.col("id"))).collect()]
    docs = spark.createDataFrame([(i, f"some words of {i}") for i in ids for _ in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids for _ in range(10)], "doc_id long, quality int")
    for s in (mil_quality.Settings(train_docs=1000), mil_quality.Settings(train_docs=20)):
        mil_quality.train(docs, labels, s)
    assert sorted(seen[0]) == sorted(i % 2 for i in ids)
    assert len(seen[1]) == 20 and set(seen[1]) == {0, 1}
