import os

import oracle
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_registry():
    import __spark_entry__ as contract

    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert contract.queries().keys() >= QUERIES.keys() | {"pipeline"}
    assert contract.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    if name.startswith(("op1_", "op5_")):
        assert "Python" not in plan and "Arrow" not in plan
    if name in ORACLES:
        assert oracle.compare(frame, duck, ORACLES[name]) is None
    elif not name.startswith("op11_"):
        assert frame.count() == duck.execute(f"SELECT count(*) FROM {'pages' if name.startswith('op1_') else 'documents'}").fetchone()[0]
