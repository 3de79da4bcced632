import random

import brute
import numpy as np
from pyspark.sql import functions as F

from surgemark.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value string, size int"


def make(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, g, s, "x", 1, "y", 2) for i, (g, s, t) in enumerate(rows)], SCHEMA).repartition(parts)


def corpus(seed, n=60):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abÄéß日") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    pick = lambda: stock[min(int(rng.expovariate(0.1)), 59)]
    rows = [(rng.choice(["en", "de", None, "solo"]), rng.choice(["a", "a", "a", "b", "ç", None, "zz"]),
             rng.choice([" ", "1", "_\n"]).join(pick() for _ in range(rng.randint(0, 40)))) for _ in range(n)]
    rows = [("solo", "only", t) if g == "solo" else (g, s, t) for g, s, t in rows]
    return rows + [("en", "bare", None), ("en", "blank", " 12 "), ("xx", "p", "rare"), ("xx", "q", ""), *rows[:5],
                   ("en", "a", "AbÄ É " * 900)]


def got(spark, rows, **more):
    return [tuple(r) for r in dv.divergence(make(spark, rows), **more).collect()]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK", 4)
    monkeypatch.setattr(dv, "HELD", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for top in (200, 5):
            rows = corpus(top)
            found = got(spark, rows, top=top)
            assert len(found) == len(set(found)) and set(found) == brute.divergence(rows, top)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_source_and_many_sources(spark):
    rng = random.Random(3)
    rows = [("en", "hot" if i % 3 == 0 else f"s{i % 40}", " ".join(rng.choices("a b c d e f gg hh".split(), k=9)))
            for i in range(400)]
    assert set(got(spark, rows)) == brute.divergence(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_skyband_keeps_what_can_be_first():
    rng = random.Random(1)
    for k in (1, 3, 20):
        rows = sorted((-rng.randint(1, 30), rng.randint(1, 40), b"%d" % i) for i in range(900))
        band = dv.Skyband(k)
        kept = band.retain(np.array([r[1] for r in rows]), [r[2] for r in rows])
        above = [sum(o[1] <= r[1] and o[2] <= r[2] for o in rows[:i]) for i, r in enumerate(rows)]
        assert kept == [i for i, n in enumerate(above) if n < k]


def test_weights_of_huge_counts(spark):
    row = spark.range(1).select(dv.weight(dv.F.lit(4 * 10**15), dv.F.lit(9 * 10**17), dv.F.lit(12345)).alias("p")).first()
    assert row.p == 1 + 10**9 * (4 * 10**15 + 1) // (9 * 10**17 + 12345)


def test_retained_that_dominate_are_counted_as_one_by_one():
    rng = random.Random(4)
    for held in (0, 1, 9, 60):
        band = dv.Skyband(3)
        band.totals = np.array([rng.randint(0, 9) for _ in range(held)], np.int64)
        some = np.array([rng.randint(0, 9) for _ in range(40)], np.int64)
        place = np.array([rng.randint(0, held) for _ in range(40)])
        want = [sum(band.totals[:p] <= t) for t, p in zip(some.tolist(), place.tolist())]
        assert band._above(some, place).tolist() == want


def test_weights_of_counts_that_are_too_large_for_a_long(spark):
    counts = [0, 5, dv.SMALL - 1, dv.SMALL, 2 ** 62]
    rows = spark.createDataFrame([(n, 2 ** 62, 7) for n in counts], "n long, size long, v long")
    got = rows.select(dv.weight(F.col("n"), F.col("size"), F.col("v")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 1_000_000_000 * (n + 1) // (2 ** 62 + 7) for n in counts]
