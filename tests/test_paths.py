"""Rules over stored ancestor paths give what rules over plain nodes give, from one scan."""

from __future__ import annotations

import pytest

from codequarry.operators import calls as C
from codequarry.operators import definitions as D
from codequarry.operators import imports as I
from codequarry.operators.matching import match_rules, rule_candidates, with_candidate_names
from codequarry.plans.corpus import corpus
from codequarry.sources.rules import CALL_RULES, DEFINITION_RULES, IMPORT_RULES, RULES, rule_set


@pytest.fixture(scope="module")
def prepared(spark, sf_dir, tmp_path_factory):
    data, place = corpus(spark, sf_dir), str(tmp_path_factory.mktemp("paths"))
    rule_candidates(data.nodes, RULES).write.parquet(place + "/paths")
    with_candidate_names(spark.read.parquet(place + "/paths"), data.sources).write.parquet(place + "/named")
    return data, spark.read.parquet(place + "/named")


def same(a, b):
    assert a.exceptAll(b.select(a.columns)).count() == 0 and b.exceptAll(a.select(b.columns)).count() == 0


@pytest.mark.parametrize("family", ["definitions", "calls", "imports"])
def test_rules_over_paths_equal_rules_over_nodes(prepared, family):
    data, named = prepared
    run = {"definitions": lambda n: D.raw_definitions(n, data.sources), "calls": lambda n: C.calls(n, data.sources),
           "imports": lambda n: I.imports(n, data.sources)}[family]
    assert run(named).count() > 0
    same(run(data.nodes), run(named))


def test_definitions_over_paths_scan_once_and_join_only_the_rules(prepared):
    _, named = prepared
    for found, rules in ((D.raw_definitions(named), DEFINITION_RULES), (C.calls(named), CALL_RULES), (I.imports(named, None), IMPORT_RULES)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert plan.count("BroadcastHashJoin") + plan.count("BroadcastNestedLoopJoin") == 1 and rules


def test_rules_that_look_further_up_are_refused(prepared, spark, sf_dir):
    flat = rule_set("definition", [("python", "function", "identifier", "name", "function_definition")])
    deep = rule_set("definition", [("python", "function", "identifier", "name", "function_definition", None, "decorated_definition")])
    nodes = corpus(spark, sf_dir).nodes
    shallow = rule_candidates(nodes, flat)
    same(match_rules(nodes, flat), match_rules(shallow, flat))
    if max(r.kind_level for r in deep) > 1:
        with pytest.raises(ValueError):
            match_rules(shallow, deep)
