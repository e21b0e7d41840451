"""Cent arithmetic against exact rational arithmetic on random groups."""
import random
from fractions import Fraction

from pyspark.sql import functions as F

from strata.functions.money import avg_money, cents, half_up_ratio_pct


def _half_up(x: Fraction) -> int:
    return int((x * 2 + 1) // 2)


def test_average_and_share_are_exact_half_up(spark):
    rng = random.Random(7)
    rows, expected = [], {}
    for g in range(300):
        n = rng.randint(1, 9)
        amounts = [rng.randint(0, 10**7) for _ in range(n)]
        if g % 10 == 0:  # force half-cent ties
            amounts = [1, 2] if g % 20 == 0 else [5, 0]
        rows += [(g, a / 100) for a in amounts]
        s = sum(amounts)
        total = s + 12345
        expected[g] = (
            _half_up(Fraction(s, len(amounts))) / 100,
            _half_up(Fraction(s * 100, total) * 100) / 100,
        )
    df = spark.createDataFrame(rows, "g INT, usd DOUBLE").repartition(7)
    got = (
        df.groupBy("g")
        .agg(F.sum(cents("usd")).alias("s"), F.count("usd").alias("n"))
        .select(
            "g",
            avg_money("s", "n").alias("avg"),
            half_up_ratio_pct(F.col("s"), F.col("s") + 12345).alias("pct"),
        )
        .collect()
    )
    assert {r["g"]: (r["avg"], r["pct"]) for r in got} == expected
