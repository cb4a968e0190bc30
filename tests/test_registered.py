import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from lanes.oracle import ORACLE
from lanes.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
FAST = ["salted_hash", "glossary_locator", "prefilter", "peak_island", "similarity_events", "library_rank",
        "csv_quotes", "run_account"]


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    ok, note = compare(entry.queries()[name](spark, SF_DIR), duck(SF_DIR), entry.oracle_sql()[name])
    assert ok, note


def test_the_rest_stands_without_the_optional_package():
    """The entry and everything it registers import when the folders of the optional package are hidden."""
    code = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["peakloom", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
assert set(entry.queries()) == set(entry.QUERIES) and set(entry.oracle_sql()) == set(entry.ORACLE)
"""
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
