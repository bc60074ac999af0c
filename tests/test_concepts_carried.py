from seedmill.plans import catalog, fixtures as fx
from tests.conftest import SF0001


def _plan(df) -> list:
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_batches_read_their_concepts_once(spark):
    """Drawn numbers are not joined with their concepts again, which would sort 700 numbers a row."""
    b = catalog._fresh_batches(spark, SF0001).select("batch_id", "concept_definition", "combos_text")
    assert sum("_a#" in line and "Join" in line for line in _plan(b)) == 0
    assert sum("p_partkey" in line and "Relation" in line for line in _plan(b)) == 1


def test_done_rows_read_their_concepts_once(spark):
    plan = _plan(fx.validity_done(spark, SF0001))
    assert sum("p_partkey" in line and "Relation" in line for line in plan) == 1


def test_a_concept_meets_its_part_with_its_share_of_the_text(spark):
    plan = _plan(fx.concepts(spark, SF0001))
    at = next(i for i, line in enumerate(plan) if "Join Inner" in line and "_pk" in line)
    below = next(line for line in plan[at + 1:] if "Project" in line)
    assert "substring(text" in below
