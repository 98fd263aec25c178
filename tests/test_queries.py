"""Registered queries against DuckDB on the smallest tables.

One query per family runs by default; LODESTAR_ALL=1 runs every query that has SQL.
"""

import os

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUICK = """
s01 s02 s05 s06 s07 s14_merge p04 p08_recode p11_impute_median p16 p17 p19 p20 p26 p27 a03 a05 a09 a10 a16 a17_describe
a22_spearman a24_information a25 a27_classification a28_auc a31_qq j03 j05 j08 j09_align w01 w02 w03 w04 w05 w06 v02_pivot_unique
v05 v07 v08 v09 u02 u05_sample_n u07 ts01_resample_gaps ts04_epidemic_top ts06 ts07 ts08 t01 t03 t07 t10_vocabulary t11 t12 t18 t19
g01 g04 g05 g08 g10_modularity_random g11_sp_kernel g13 r02 k04 k05 k06_nearest_centroid_median k07_knn_classification ml06_naive
ml13_discriminant_one ml16_mixed_features ml21_per_group_models ml26
""".split()

SQL = entry.oracle_sql()
NAMES = [n for n in SQL if os.environ.get("LODESTAR_ALL") or any(n.startswith(q) for q in QUICK)]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    mine = entry.queries()[name](spark, FOLDER).toPandas()
    assert oracle.differences(mine, con.execute(SQL[name]).df()) is None


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10
