"""Scale regression checks on the physical plans of every registered query.

* No query may contain a Cartesian product.
* A broadcast nested-loop join is allowed only when its build (broadcast)
  side is provably bounded: a global aggregate (exactly one row, e.g. the
  totals attached by ``attach_row``), a local literal table, joins / unions
  of those, or a table bounded by design (see ``BOUNDED_BY_DESIGN``).
* Both hold for every frame that is checkpointed on the way, not only for
  what is left after the last checkpoint.
"""

import pytest

from helpers import SF_SMALL
import __spark_entry__ as entry_mod

from tessera.plans import QUERIES as LIBRARY_QUERIES

QUERIES = entry_mod.queries()
MODEL_FITS = ("C03", "C05", "C06", "C08", "C09", "C11", "K05", "N08", "N12", "N13", "T20")
# nested-loop build sides bounded by design rather than by plan shape: the (bucket, pos, neg) table of
# a threshold-grid sweep (<= one row per threshold) and one split's metric row (V22, grouped by split)
BOUNDED_BY_DESIGN = ("V04_", "V05_", "C10_", "M04_", "X02_", "V22_")
PASS_THROUGH = {"ProjectExec", "FilterExec", "WholeStageCodegenExec", "InputAdapter", "BroadcastExchangeExec",
                "ShuffleExchangeExec", "SortExec", "AQEShuffleReadExec"}


def _children(node):
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _name(node):
    return node.getClass().getSimpleName()


def _bounded_root(node) -> bool:
    """True when the subtree provably yields a bounded number of rows."""
    n = _name(node)
    if n in PASS_THROUGH and _children(node):
        return _bounded_root(_children(node)[0])
    if n in ("HashAggregateExec", "ObjectHashAggregateExec", "SortAggregateExec"):
        return node.groupingExpressions().size() == 0
    if n in ("BroadcastNestedLoopJoinExec", "BroadcastHashJoinExec", "SortMergeJoinExec", "UnionExec"):
        return all(_bounded_root(c) for c in _children(node))
    return n in ("LocalTableScanExec", "RDDScanExec")


def _bnlj_build_sides(node, out):
    if _name(node) == "BroadcastNestedLoopJoinExec":
        side = str(node.buildSide())
        kids = _children(node)
        out.append(kids[1] if "Right" in side else kids[0])
    for c in _children(node):
        _bnlj_build_sides(c, out)
    return out


@pytest.mark.parametrize("name", sorted(n for n in LIBRARY_QUERIES if not n.startswith(MODEL_FITS)))
def test_plan_has_no_unbounded_nested_loop(spark, name, monkeypatch):
    seen, frame = [], type(spark.range(1))
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: (seen.append(self._jdf.queryExecution()), checkpoint(self, *a, **k))[1])
    seen.append(QUERIES[name](spark, SF_SMALL)._jdf.queryExecution())
    for qe in seen:
        assert "CartesianProduct" not in qe.executedPlan().toString()
        for build in _bnlj_build_sides(qe.sparkPlan(), []):
            assert _bounded_root(build) or name.startswith(BOUNDED_BY_DESIGN), \
                f"{name}: nested-loop join with an unbounded build side: {_name(build)}"
