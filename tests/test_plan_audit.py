"""No registered query may plan a cartesian product, a nested-loop join or a Python UDF."""

from tests.conftest import SF_SMALL
from tools.plan_audit import audit
from tripmart.plans import catalog


def test_no_forbidden_operators(spark):
    rows = audit(spark, SF_SMALL)
    assert len(rows) == len(catalog.QUERIES)
    assert [r["query"] for r in rows if r["forbidden"]] == []
