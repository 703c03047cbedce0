"""Registered queries against their SQL, over the smallest tables (queries of the llm subpackage have their own tests)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")

from smallseq.plans import registry  # noqa: E402

SOME = ["feature_counts", "rule_counts", "overlap_shift", "root_feature", "collapse_trim", "kmer_align_mismatch", "bh_adjust", "nt_len_assigned", "class_props", "aliases", "natural_sort", "annotation_issues"]


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(registry.ORACLES) if os.environ.get("ALL_ORACLES") else SOME)
def test_query_matches_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    cur = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
