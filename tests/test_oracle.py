"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from marquee.plans import bindings, file_bindings, oracle, stream_bindings
from oracle_check import connect, differences


ROOT = Path(__file__).resolve().parents[1]
QUERIES = {**bindings.BATCH, **file_bindings.FILES, **stream_bindings.STREAMS}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(oracle.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tiny, name):
    problem, _ = differences(
        contract.queries()[name](spark, tiny), connect(tiny), contract.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark, tiny):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"country", "total"}


def test_training_data_may_be_left_out():
    """Without that package the other queries are there; a fault in one of its modules shows."""
    code = ("import sys; sys.modules['marquee.llm'] = None; import __spark_entry__ as e; "
            "assert 'q2_top_solo' in e.queries() and 'pipeline' not in e.queries()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
    if (ROOT / "marquee/llm").is_dir():
        code = "import sys; sys.modules['marquee.llm.common'] = None; import __spark_entry__"
        assert subprocess.run([sys.executable, "-c", code], capture_output=True, cwd=ROOT).returncode != 0
