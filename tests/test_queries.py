"""Every registered query with SQL against DuckDB on the smallest tables, and partition invariance of some."""

import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from varlake.plans.catalogue import ORACLE_SQL, QUERIES  # noqa: E402
from varlake.plans.views import TABLES  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value if value is None or isinstance(value, (bool, int)) else float(value) if type(value).__name__ == "Decimal" else str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLE_SQL:
        found = duck.execute(ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows(columns, found.fetchall())


def test_structural_classes_hold_all_transcripts(spark, duck):
    got = {r.o: (r.first, r.n) for r in QUERIES["structural_transcript_classes"](spark, DATA).collect()}
    exons = {}
    for o, s in duck.execute("SELECT DISTINCT l_orderkey, l_linenumber * 100 FROM lineitem").fetchall():
        exons.setdefault(o, []).append(s)
    classes = {}
    for o, starts in exons.items():
        starts.sort()
        introns = tuple((a + 50, b) for a, b in zip(starts, starts[1:]))
        classes.setdefault((o % 7, introns or starts[0]), []).append(o)
    assert got == {o: (min(c), len(c)) for c in classes.values() for o in c}
    assert all(got[r.a][0] == got[r.b][0] for r in QUERIES["structural_transcript_match"](spark, DATA).collect())


@pytest.mark.parametrize("name", ["candidate_funnel", "spliceai_unpack", "compound_het_trans", "dedupe_merge", "region_restrict"])
def test_partitions_do_not_matter(name, spark):
    results = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = QUERIES[name](spark, DATA)
        results.append(rows(df.columns, [tuple(r) for r in df.repartition(n).collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_intervals_plan_no_nested_loop(spark):
    plan = QUERIES["region_restrict"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
