import numpy as np
import pytest
from llm_brute import SF, rule_counts, words

from strata.llm import mixing, quality_rules
from strata.llm.mixing import Mix, split_quotas, targets
from strata.llm.quality_rules import COUNTS, PREFIX, Limits


def test_rule_counts_equal_plain_python(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = [None, "", "\n\n", "a\na\n b\na", "x x x x x", "é#$ <b>\r\n é#$ <b>\n", "a b c a b c " * 400, "w " * 49, "w w " * 60]
    docs += [(10**6 + i, t, None) for i, t in enumerate(odd)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as host", "2 as n_words")
    rows = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    for k, t, _ in docs:
        want = rule_counts(t)
        assert tuple(rows[k][PREFIX + c] for c in COUNTS) == want
        assert rows[k][PREFIX + "base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    kept = quality_rules.kept_documents(df)
    assert kept.columns == df.columns
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_host_verdicts(spark):
    clean = " ".join(f"w{i}" for i in range(200))
    junk = " ".join(f"w{i}#$%" for i in range(200))
    slightly = clean + " #" * 14  # within the limits, beyond the strict ones
    rows = [(i, junk, "bad") for i in range(60)] + [(100, slightly, "bad"), (101, clean, "bad"), (102, slightly, "good"), (103, junk, "good")]
    rows += [(200 + i, clean, "good") for i in range(60)] + [(300, junk, None), (301, clean, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    kept = {k for k, r in got.items() if r[PREFIX + "kept"]}
    assert {101, 102, 301} <= kept and not kept & {0, 100, 103, 300}
    assert got[101][PREFIX + "host_suspect"] and not got[102][PREFIX + "host_suspect"]
    # Shrinking: between the host's own rate and the corpus's.
    assert 0 < got[102][PREFIX + "host_rate"] < 0.5 < got[101][PREFIX + "host_rate"] < 62 / 62
    one = {r["doc_id"]: r[PREFIX + "kept"] for r in quality_rules.judge(df, limits=Limits(broadcast_hosts=0)).collect()}
    assert one == {k: r[PREFIX + "kept"] for k, r in got.items()}  # the shuffle join


def test_targets():
    got = targets([10, 1000, 1000], Mix())
    assert got[0] == 20 and abs(sum(got) - 1.5 * 2010) < 1e-6 and abs(got[1] / got[2] - 2) < 1e-9
    got = targets([1000, 10, 10, 10, 0], Mix())
    assert all(g <= 2 * s for g, s in zip(got, [1000, 10, 10, 10, 0])) and abs(sum(got) - 1.5 * 1030) < 1e-6
    assert targets([], Mix()) == [] and targets([0, 0], Mix()) == [0, 0]


def test_the_tree_hands_out_every_unit_once():
    quota = np.array([0, 7, 1000, 13])
    for shards in (1, 2, 7, 64):
        seen = [set() for _ in quota]
        for _, start, n in split_quotas(quota, shards, 0, shards, 5):
            for s, (a, m) in enumerate(zip(start, n)):
                stretch = set(range(a, a + m))
                assert not stretch & seen[s]
                seen[s] |= stretch
        assert [len(x) for x in seen] == quota.tolist()
        whole = {k: (tuple(a), tuple(n)) for k, a, n in split_quotas(quota, shards, 0, shards, 5)}
        part = {k: (tuple(a), tuple(n)) for k, a, n in split_quotas(quota, shards, shards // 2, shards, 5)}
        assert all(whole[k] == v for k, v in part.items())


def test_mix_meets_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as rank", "2 as size", "3 as target")
    m = Mix(block_words=1500, shard_words=20_000)
    first = {r["doc_id"]: r for r in mixing.plan(docs, mix=m).collect()}
    again = {r["doc_id"]: r for r in mixing.plan(docs.repartition(5), mix=m).collect()}
    assert first.keys() == again.keys()
    by = {}
    for r in docs.collect():
        f = first[r["doc_id"]]
        assert f["mix__size"] == len(words(r["text"])) and len(f["mix__copies"]) <= 2
        assert f["mix__copies"] == again[r["doc_id"]]["mix__copies"]
        got = by.setdefault(r["source"], [0, f["mix__target"], 0, f["mix__source_size"]])
        got[0] += f["mix__size"] * len(f["mix__copies"])
        got[2] = max(got[2], f["mix__size"])
    for taken, target, largest, size in by.values():
        assert abs(taken - target) <= largest and target <= 2 * size + 1e-6
    rows = mixing.mixed(docs, mix=m)
    assert rows.columns[: len(docs.columns)] == docs.columns
    assert rows.count() == sum(len(r["mix__copies"]) for r in first.values())
    assert rows.select("mix__shard").distinct().count() > 5
    wide = {r["doc_id"]: r["mix__copies"] for r in mixing.plan(docs, mix=Mix(block_words=1500, shard_words=20_000, broadcast_blocks=0)).collect()}
    assert wide == {k: r["mix__copies"] for k, r in first.items()}  # the shuffle join


def test_mix_of_odd_rows(spark):
    rows = [(None, None, None), (1, "", None), (1, "a b c", None), (1, "a b c", None), (2, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.digest(df).collect()
    assert len(got) == 5
    assert sorted(r["taken"] for r in got) == [0, 0, 0, 3, 3]  # rows of one doc_id are drawn alike
    assert {(r["source_size"], r["target"]) for r in got} == {(6, 9.0), (0, 0.0)}
    assert mixing.digest(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0


def test_a_long_document_at_the_cut_is_left_out(spark):
    """One document of 1,000 words and 100 of ten: 3,000 can be met exactly."""
    rows = [(i, "w " * (1000 if i == 50 else 10), "s") for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: (r["taken"], r["target"]) for r in mixing.digest(df).collect()}
    assert sum(t for t, _ in got.values()) == 3000.0 == got[0][1]
    copies = [r["doc_id"] for r in mixing.mixed(df).collect()]  # sizes are counted in this block only
    assert sorted(copies) == sorted(k for k, (t, _) in got.items() for _ in range(t // (1000 if k == 50 else 10)))


def test_the_cut_is_as_near_as_any_length_limit_allows(spark):
    rng = np.random.default_rng(12)
    for seed in range(3):
        sizes = (rng.pareto(1.0, 60) * 8 + 1).astype(int).tolist()
        df = spark.createDataFrame([(i, "w " * n, "s") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
        m = Mix(seed=seed)
        found = mixing.plan(df, mix=m).withColumn("k", mixing._key("doc_id", "source", m)).collect()
        goal = 1.5 * sum(sizes)
        taken = sum(r["mix__size"] * len(r["mix__copies"]) for r in found)
        in_order = sorted((r["k"], r["mix__size"]) for r in found)
        reach = [sum(sizes)]
        for bits in range(1, 40):
            at = sum(sizes)
            for _, n in in_order:
                if n < 1 << bits:
                    at += n
                    reach.append(at)
        assert abs(taken - goal) == min(abs(x - goal) for x in reach)


def plain_plan(docs, m):
    """Copies of each (doc_id, source): the plan spelled out in plain Python,
    the sum of a hash's blocks, then the cut, without shards."""
    import struct

    import xxhash

    def spark_hash(*values):
        h = 42
        for v in values:
            raw = v.encode() if isinstance(v, str) else v
            if raw is not None:
                h = xxhash.xxh64(raw, seed=h).intdigest()
        return h - (1 << 64) if h >> 63 else h

    i32, i64 = (lambda v: struct.pack("<i", v)), (lambda v: struct.pack("<q", v))
    sizes = {}
    for _, source, n in docs:
        sizes[source] = sizes.get(source, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goals = mixing.targets([sizes[s] for s in order], m)
    copies = {}
    for rank, (source, goal) in enumerate(zip(order, goals)):
        own = [(spark_hash(i32(m.seed), str(i), source), n, i) for i, s, n in docs if s == source]
        n_blocks = max(1, -(-sizes[source] // m.block_words))
        blocks = {}
        for key, n, i in own:
            blocks.setdefault(spark_hash(i32(m.seed + 1), i64(key)) % n_blocks, []).append((key, n, i))
        epochs = int(goal // sizes[source]) if sizes[source] else 0
        rest = goal - epochs * sizes[source]
        for _, n, i in own:
            copies[i, source] = epochs
        for b in sorted(blocks, key=lambda b: (spark_hash(i32(m.seed + 2), i32(rank), i32(epochs), i64(b)), b)):
            inside = sorted(blocks[b])
            words_in = sum(n for _, n, _ in inside)
            if words_in <= rest:
                taken = inside
            else:
                # (distance, -longest length class, key): every prefix of every class
                best, taken = (rest, 0, 0), []
                top = max(n.bit_length() for _, n, _ in inside if n)
                for bits in range(1, top + 1):
                    fit = [x for x in inside if x[1] < 1 << bits]
                    upto = 0
                    for at, x in enumerate(fit):
                        upto += x[1]
                        new = (abs(upto - rest), -bits, x[0])
                        if x[1] and new[0] < rest and (new < best or not taken):
                            best, taken = new, fit[: at + 1]
            for _, n, i in taken:
                copies[i, source] += 1
            rest -= words_in
            if rest < 0:
                break
    return copies


@pytest.mark.parametrize("many", [False, True])
def test_taken_equals_the_plain_plan(spark, many):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["source"], len(words(r["text"]))) for r in docs.collect()]
    m = Mix(block_words=1500, shard_words=20_000, driver_sources=0 if many else 100, group_sources=2)
    found = mixing.plan(docs, mix=m).collect()
    want = plain_plan(rows, m)
    sized = {(i, s) for i, s, n in rows if n}
    got = {(r["doc_id"], r["source"]): len(r["mix__copies"]) for r in found}
    assert {k: got[k] for k in sized} == {k: want[k] for k in sized}


def test_many_sources_are_mixed_on_spark(spark):
    """20,000 sources, one with a third of the rows: nothing by source on the driver."""
    from pyspark.sql import functions as F

    df = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), "id")).alias("source"),
        F.expr("repeat('w ', 1 + int(id % 7))").alias("text"),
    )
    m = Mix(driver_sources=1000, block_words=500, shard_words=4000)
    many = {r["doc_id"]: r for r in mixing.plan(df, mix=m).collect()}
    few = {r["doc_id"]: r for r in mixing.plan(df, mix=Mix(block_words=500, shard_words=4000)).collect()}
    assert many.keys() == few.keys() and len(many) == 30_000
    assert all(many[k]["mix__target"] == few[k]["mix__target"] and many[k]["mix__source_size"] == few[k]["mix__source_size"] for k in few)
    assert all(len(many[k]["mix__copies"]) == len(few[k]["mix__copies"]) for k in few)
    by_shard = {}
    for r in many.values():
        for c in r["mix__copies"]:
            by_shard[c["shard"]] = by_shard.get(c["shard"], 0) + r["mix__size"]
    # Shards get equal numbers of blocks; those of small sources are small.
    assert len(by_shard) == 45 and max(by_shard.values()) < 2 * m.shard_words
    assert not mixing.plan(df.limit(0), mix=Mix(driver_sources=-1)).collect()


def test_groups_of_sources_split_into_the_quotas():
    rng = np.random.default_rng(4)
    quota, shards, size = rng.integers(0, 30, 23), 9, 5
    top = np.array([quota[a : a + size].sum() for a in range(0, 23, size)])
    per_shard = np.zeros(shards, np.int64)
    for g in range(len(top)):
        own = quota[g * size : (g + 1) * size]
        taken = [set() for _ in own]
        found = {k: (tuple(i), tuple(a), tuple(n)) for k, i, a, n in mixing.split_group(top, g, own, shards, 0, shards, 5)}
        half = {k: (tuple(i), tuple(a), tuple(n)) for k, i, a, n in mixing.split_group(top, g, own, shards, 4, shards, 5)}
        assert half == {k: v for k, v in found.items() if k >= 4}
        for shard, (index, start, count) in found.items():
            per_shard[shard] += sum(count)
            for i, a, n in zip(index, start, count):
                stretch = set(range(a, a + n))
                assert not stretch & taken[i]
                taken[i] |= stretch
        assert [len(x) for x in taken] == own.tolist()
    assert per_shard.sum() == quota.sum() and per_shard.max() - per_shard.min() <= 4
