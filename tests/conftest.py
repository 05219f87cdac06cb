import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from monthwise.session import get_session
    # Tests run locally; a checkpoint folder is set only if the session has none.
    s = get_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tmp_shared(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collected rows as tuples (sorted for order-insensitive comparison)."""
    out = [tuple(r) for r in df.collect()]
    key = (lambda t: tuple((x is None, str(x)) for x in t))
    return sorted(out, key=key) if order is None else out


def scanned_files(df, under=""):
    """Files that the scans of ``df`` open (of tables below the path ``under``), run time
    pruning included: it is run, and the scans' own counts are read."""
    df = df.select("*")
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec" and under in node.relation().location().rootPaths().mkString():
            found += node.metrics().get("numFiles").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found
