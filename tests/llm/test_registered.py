"""The eleven queries are registered and hold what their contracts say."""

import os
import re
import subprocess
import sys

import duckdb
import pytest
from conftest import MEDIUM, ROOT, rows_of

import __spark_entry__ as entry_module

COLUMNS = {
    1: "doc_id n_bytes n_tokens over_limit",
    2: "doc_id size text_crc32 law shard slot grown_shard",
    3: "doc_id n_tokens ids_sha256 decoded_sha256",
    4: "doc_id held_out score predicted",
    5: "doc_id n_words n_hit n_items items_sha256 contaminated",
    6: "query_id rank vec_id score",
    7: "doc_id held_out n_tokens n_known train_tokens base_score score",
    8: "doc_id fingerprint component_id",
    9: "doc_id held_out score predicted",
    10: "doc_id n_bytes n_removed n_spans kept_sha256",
    11: "vec_id component n deviation whitened explained identity_error",
    12: "doc_id piece start length ids_crc32 sequence_id offset",
    13: "doc_id n_features weight score rank",
}


def test_one_query_for_each_operator():
    names = entry_module.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns_at_the_smallest_size(spark, n):
    name = next(q for q in entry_module.queries() if q.startswith(f"op{n}_"))
    df = entry_module.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.columns == COLUMNS[n].split()
    if n == 12:
        assert df.where("piece = 0").count() == 200
    else:
        assert df.count() == {6: 25 * 20, 11: 500 * 32}.get(n, 200)


@pytest.mark.parametrize("name", sorted(n for n in entry_module.oracle_sql() if n[:2] == "op"))
def test_equal_to_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MEDIUM}/{table}.parquet'")
    result = connection.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in result.description]
    rows = [dict(zip(names, r)) for r in result.fetchall()]
    df = entry_module.queries()[name](spark, MEDIUM)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df) == sorted(tuple(repr(r[n]) for n in sorted(names)) for r in rows)


def test_the_rest_works_without_the_subpackage():
    """As if both folders and the pipeline were gone."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("gatewatch.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
assert set(e.queries()) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True,
                   env=os.environ | {"PYTHONPATH": ROOT})
