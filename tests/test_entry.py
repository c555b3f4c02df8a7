"""The driver contract without its optional parts."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def queries_without(*modules):
    """Names of the queries when importing ``modules`` fails."""
    code = (f"import sys; sys.path.insert(0, {REPO!r})\n"
            f"for m in {modules!r}: sys.modules[m] = None\n"
            "import __spark_entry__ as e\n"
            "print(*sorted(e.queries()))\n"
            "assert set(e.oracle_sql()) <= set(e.queries())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         timeout=120)
    return out.stdout.split()


def test_core_queries_stay_without_a_library_of_the_optional_part():
    from tidemart.plans.registry import QUERIES
    for missing in ("ahocorasick", "public_tokenizers", "tidemart.llm"):
        assert queries_without(missing) == sorted(QUERIES)


def test_core_queries_stay_without_the_pipeline():
    assert "pipeline" not in queries_without("corpus_pipeline")
