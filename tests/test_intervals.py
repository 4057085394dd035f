"""Interval joins against all pairs, for intervals of one base to whole contigs."""

import random

from pyspark.sql import functions as F

from varlake.operators import joins as J

SPAN = "id long, chrom string, start long, end long"


def intervals(rng, n):
    out = []
    for i in range(n):
        start = rng.randint(0, 2_000_000)
        out.append((i, rng.choice(["1", "2"]), start, start + rng.choice([0, 1, 1, rng.randint(1, 50), rng.randint(1, 3000), rng.randint(1, 1_000_000)])))
    return out + [(n, "1", 0, 250_000_000), (n + 1, "2", 0, 1), (n + 2, None, 0, 10), (n + 3, "1", None, 10), (n + 4, "1", 5, None)]


def test_interval_join(spark):
    rng = random.Random(8)
    a, b = intervals(rng, 150), intervals(rng, 120)
    pairs = {(x[0], y[0]) for x in a for y in b if None not in x and None not in y and x[1] == y[1] and x[2] < y[3] and y[2] < x[3]}
    left, right = spark.createDataFrame(a, SPAN), spark.createDataFrame(b, SPAN).toDF("rid", "rchrom", "rstart", "rend")
    for size in (10, 1000, 100_000):
        args = size, ("chrom", "rchrom"), ("start", "end"), ("rstart", "rend")
        got = [(r.id, r.rid) for r in J.interval_join(left, right, *args).select("id", "rid").collect()]
        assert sorted(got) == sorted(pairs)
    twice = left.union(left)
    semi = [r.id for r in J.interval_join(twice, right, *args, how="left_semi").collect()]
    assert sorted(semi) == sorted(2 * list({p[0] for p in pairs}))


def test_rows_of_whole_contigs(spark):
    """A contig of 250 Mb gets two rows a level at most, not one for each narrow bin; bases get one row for each level there is."""
    whole = spark.createDataFrame([(1, "1", 0, 250_000_000), (2, "1", 0, 1_000_000_000_000)], SPAN)
    points = spark.createDataFrame([(i, "1", i * 1000, i * 1000 + 1) for i in range(1000)], SPAN)
    span = ("start", "end")
    assert J.binned(whole, points, span, span, 1000).count() <= 2 * 2
    assert J.binned(points, whole, span, span, 1000).count() == 1000 * 3
    many = points.union(spark.createDataFrame([(0, "1", 0, 10**n) for n in range(12)], SPAN))
    assert J.binned(whole, many, span, span, 1000).groupBy("id").count().agg(F.max("count")).first()[0] <= 2 * 12


def test_region_restrict(spark):
    rows = spark.createDataFrame([("1", 5, "a"), ("1", 5, "a"), ("1", 10, "b"), ("1", 11, "c"), ("2", 5, "d"), (None, 5, "e"), ("1", None, "f")], "CHROM string, POS long, start_pos string")
    regions = spark.createDataFrame([("1", 4, 10), ("1", 0, 9_000_000), ("1", 4, 5), ("3", 0, 100)], "chrom string, start_pos long, end_pos long")
    assert sorted(r.start_pos for r in J.region_restrict(rows, regions.where("end_pos < 100")).collect()) == ["a", "a", "b"]
    assert sorted(r.start_pos for r in J.region_restrict(rows, regions).collect()) == ["a", "a", "b", "c"]
    assert J.region_restrict(rows, regions.limit(0)).count() == 0
