"""Source rules for the library: every driver fetch and every limit is a known,
bounded site; no local checkpoints, cross joins, Python UDFs or RDD detours."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parent.parent / "monthwise"

# site -> why it is bounded
ALLOWED_FETCH = {
    "plans/report.py": "distinct (type, month) pairs of the report's two types",
    "plans/trigger.py": "the one-row calendar gate",
    "plans/catalog.py": "one row of extreme dates",
    "operators/crosstab.py": "distinct periods: one value for a month",
    "operators/gating.py": "emptiness and one-row lookups",
    "plans/catalog_stores.py": "one row of extreme dates",
    "operators/skew_join.py": "one row with at most MOST_HEAVY keys",
    "sources/outbox_store.py": "touched outbox dates: one value for a day",
    "sources/fact_layout.py": "the one-row calendar gate, a scalar subquery",
    "sources/month_parts.py": "changed months: one value for a month",
}
ALLOWED_LIMIT = {
    "operators/ranking.py": "top-n is the feature",
}
FETCH = r"\.(collect|first|head|take|tail|scalar|isEmpty|toLocalIterator|toArrow)\("


def sources():
    for p in ROOT.rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue                       # its own tests look after it
        code = "\n".join(ln for ln in p.read_text().splitlines() if not ln.lstrip().startswith("#"))
        yield str(p.relative_to(ROOT)), code


def test_no_forbidden_constructs():
    for name, code in sources():
        for pat in (r"localCheckpoint", r"crossJoin", r"\budf\(", r"pandas_udf", r"\.rdd\b",
                    r"toPandas", r"tempfile\.mkdtemp", r"broadcast\(", r"\.persist\(", r"\.cache\("):
            if pat == r"tempfile\.mkdtemp" and name == "session.py":
                continue          # only on a local master without a checkpoint folder
            assert not re.search(pat, code), (name, pat)


def test_driver_fetches_and_limits_are_known_sites():
    for name, code in sources():
        if re.search(FETCH, code):
            assert name in ALLOWED_FETCH, name
        if re.search(r"\.limit\(", code):
            assert name in ALLOWED_LIMIT, name


def test_nothing_outside_imports_the_llm_subpackage():
    for name, code in sources():
        assert "monthwise.llm" not in code and "import llm" not in code, name
