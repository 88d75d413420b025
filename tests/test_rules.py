"""One golden case per rule, on hand-written trees."""

from collections import Counter

import pytest

from codequarry.operators.calls import calls
from codequarry.operators.definitions import raw_definitions
from codequarry.operators.imports import imports
from codequarry.sources.rules import CALL_RULES, DEFINITION_RULES, IMPORT_RULES, RULES, rules_table
from tests.helpers import NODE_SCHEMA, collect


def rule_tree(rule, file_id, hit=True):
    """The smallest tree a rule matches, one node per line; without ``hit``, its top type is wrong."""
    chain = [(rule.t1, rule.f1), (rule.t2, rule.f2), (rule.t3, None)][: rule.kind_level]
    rows = []

    def add(pre, last, parent, depth, type_, field, text=None, child_ix=0):
        rows.append((file_id, rule.lang, pre, last, parent, depth, child_ix, type_, field, True, False, False,
                     0, 5, pre, 0, last, 5, text))

    guard = rule.guard_field is not None
    last = rule.kind_level + 1 + guard
    add(0, last, None, 0, "program", None)
    for i, (type_, field) in enumerate(reversed(chain)):
        wrong = i == 0 and not hit
        add(i + 1, last, i, i + 1, "other" if wrong else type_, field if i else None)
    parent = rule.kind_level
    add(parent + 1, parent + 1, parent, parent + 1, rule.name_type or "anything", rule.name_field, "'nm'")
    if guard:
        add(parent + 2, parent + 2, parent, parent + 1, rule.guard_types[0], rule.guard_field, "x", 1)
    return rows


@pytest.fixture(scope="module")
def matched(spark):
    rows = []
    for i, rule in enumerate(RULES):
        rows += rule_tree(rule, f"hit{i}") + rule_tree(rule, f"miss{i}", hit=False)
    nodes = spark.createDataFrame(rows, NODE_SCHEMA).cache()
    files = nodes.select("file_id").distinct().selectExpr("file_id", "'abcde' AS code")
    return {
        "definition": Counter(collect(raw_definitions(nodes), "file_id", "kind", "name", "start_line", "pattern_ix")),
        "call": Counter(collect(calls(nodes), "file_id", "name", "line")),
        "import": Counter(collect(imports(nodes, files), "file_id", "module", "line", "raw")),
    }


def test_catalogue_sizes(spark):
    assert (len(DEFINITION_RULES), len(CALL_RULES), len(IMPORT_RULES)) == (53, 25, 7)
    assert rules_table(spark).count() == 85


@pytest.mark.parametrize("i", range(len(RULES)))
def test_rule(matched, i):
    rule = RULES[i]
    found = matched[rule.family]
    mine = [k for k in found if k[0] == f"hit{i}"]
    line = rule.kind_level + 2
    if rule.family == "definition":
        assert (f"hit{i}", rule.kind, "'nm'", 2, rule.pattern_ix) in mine
    elif rule.family == "call":
        assert mine == [(f"hit{i}", "'nm'", line)]
    else:
        assert mine == [(f"hit{i}", "nm", 2, "abcde")]
    # With a wrong top node this rule finds nothing; a rule for an inner shape may.
    assert not [k for k in found if k[0] == f"miss{i}" and (rule.family != "definition" or k[4] == rule.pattern_ix)]
