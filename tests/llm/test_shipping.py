"""The queries in workers that have no copy of the package."""

from tests.conftest import SF
from tests.test_shipping import run_elsewhere


def test_queries_run_where_workers_lack_the_package(tmp_path):
    script = f"""
from tastewell.llm import queries
for name in ("op2_simhash", "op5_string_kernel", "op8_page_model", "op9_direct_codes", "op10_hyperdimensional", "op11_backtracking", "op12_score_slots", "op13_run_length"):
    print(name, queries.registered()[name](spark, {SF!r}).count())
"""
    found = run_elsewhere(script, tmp_path)
    assert len(found) == 16 and all(int(n) > 0 for n in found[1::2])
