import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidelog.functions.predicates import (
    FALSE, TRUE, And, Compare, In, Not, NotTrue, Option, Or, PredicateError, bool_option, column_name, equal, from_json, normalize, params_json, predicate_key, snake_case, text, to_column, to_json, to_options, to_sql, uuid_option,
)
from tidelog.plans.algebra import disjoint, in_minus_in, is_subset, minus, negate, options_subset, order_is_prefix, union

AGE, STATUS = (lambda op, v: Compare("age", op, v)), (lambda v: Compare("status", "=", v))


def test_normalize():
    p, q = AGE(">", 1), STATUS("x")
    assert normalize(And((p, And((q, p)), TRUE))) == And((p, q))
    assert normalize(Or((FALSE,))) == FALSE and normalize(And(())) == TRUE and normalize(Or((p, TRUE))) == TRUE
    assert normalize(Not(Not(p))) == p and normalize(Not(TRUE)) == FALSE
    assert normalize(And((AGE("=", 1), AGE("=", 1.0)))) == AGE("=", 1)
    assert normalize(And((Compare("a", "=", 1), Compare("a", "=", True)))) == And((Compare("a", "=", 1), Compare("a", "=", True)))


def test_sql_and_parameters():
    p = STATUS("open") & (Compare("priority", "=", 1) | Compare("priority", "=", 2))
    assert to_sql(p) == ("(status = $1 AND (priority = $2 OR priority = $3))", {"1": "open", "2": 1, "3": 2})
    assert to_sql(In("id", (1, 2)))[0] == "id IN ($1, $2)" and params_json(to_sql(In("id", (1, 2)))[1]) == '{"1":1,"2":2}'
    assert to_sql(Compare("createdAt", "=", None)) == ("created_at IS NULL", {})
    assert to_sql(Not(TRUE))[0] == "NOT (TRUE)" and to_sql(And(()))[0] == "TRUE" and to_sql(Or((AGE(">", 1),)))[0] == "age > $1"
    for bad in (Compare("id; DROP TABLE", "=", 1), In("id", ()), Compare("a", ">", None), Compare("a", "!=", 1), Compare("1a", "=", 1)):
        with pytest.raises(PredicateError):
            to_sql(bad)


def test_names_text_and_json():
    assert [snake_case(x) for x in ("fooID2Bar", "sourceType", "dateTimeValue", "already_snake")] == ["foo_id2_bar", "source_type", "datetime_value", "already_snake"]
    assert column_name("a.bC") == "a.b_c"
    p = Or((And((AGE(">", 10), In("s", ("a", "b")))), Not(Compare("x", "=", None))))
    assert text(p) == "(age > 10 AND s IN ('a', 'b')) OR NOT (x IS NULL)"
    assert equal(from_json(to_json(p)), p) and json.loads(to_json(AGE("=", True)))["value"] == {"bool": True, "type": "bool"}
    assert predicate_key(None, "OPEN") != predicate_key(None, "open") and predicate_key(p, "x") == predicate_key(p, "y") and predicate_key(None) == "all"


def test_options():
    fields = {"Status": Option("status", ("=",), True), "age": Option("age", (">", ">="))}
    assert to_options(STATUS("x") & AGE(">", 3), fields) == {"status": "x", "age>": 3}
    assert to_options(In("STATUS", ("a", "b")), fields) == {"status": ["a", "b"]} and to_options(TRUE, fields) == {}
    for bad in (STATUS("a") | STATUS("b"), Not(STATUS("a")), FALSE, AGE("<", 1), In("age", (1,)), Compare("other", "=", 1)):
        with pytest.raises(PredicateError):
            to_options(bad, fields)
    assert uuid_option("123e4567-e89b-12d3-a456-426614174000") and bool_option(True)
    with pytest.raises(PredicateError):
        uuid_option("no")
    with pytest.raises(PredicateError):
        bool_option(1)


def test_literals_of_another_kind_are_refused(spark):
    with pytest.raises(PredicateError):
        to_column(AGE("=", "old"), {"age": "bigint"})


def test_known_differences():
    assert equal(minus(AGE(">", 10), AGE(">", 20)), And((AGE(">", 10), AGE("<=", 20))))
    assert equal(minus(In("status", ("A", "B", "C")), In("status", ("A", "B"))), STATUS("C"))
    assert equal(minus(STATUS("o") & AGE(">", 10), STATUS("o") & AGE(">", 20)), And((STATUS("o"), AGE(">", 10), AGE("<=", 20))))
    p, q = STATUS("a"), Compare("source", "=", "b")
    assert minus(p & q, (p & q) & (p & q)) == FALSE and minus(p, None) == FALSE and equal(minus(None, p), NotTrue(p))
    assert in_minus_in(("a", "b"), ("a", "b"), "f") == FALSE and in_minus_in((1, 2, 3), (2,), "f") == In("f", (1, 3))
    assert union([]) == FALSE and union([p]) == p and negate(negate(p)) == p


def test_known_containment():
    assert is_subset(AGE("=", 5), AGE(">", 3)) and is_subset(AGE(">=", 6), AGE(">", 5)) and not is_subset(AGE(">=", 5), AGE(">", 5))
    assert not is_subset(AGE("<", 5), AGE("=", 5)) and not is_subset(AGE("<=", 5), AGE("<", 5)) and not is_subset(In("age", (1, 2)), AGE("=", 1))
    assert is_subset(In("age", (1,)), AGE("=", 1.0)) and is_subset(AGE("=", None), AGE("=", None)) and not is_subset(AGE("=", True), AGE("=", 1))
    assert is_subset(AGE(">", 1), Or((AGE(">", 0), STATUS("x")))) and is_subset(None, None) and not is_subset(None, AGE(">", 1)) and is_subset(AGE(">", 1), None)
    assert is_subset(AGE(">", 0) & AGE("<", 10), Or((AGE("<=", 5), AGE(">", 5)))) and disjoint(AGE(">", 5), AGE("<", 5)) and disjoint(AGE("=", None), AGE(">", 1))
    assert order_is_prefix([], [("a", True)]) and order_is_prefix([("a", True)], [("a", True), ("b", False)]) and not order_is_prefix([("a", False)], [("a", True)])
    p = AGE(">", 1)
    assert options_subset((AGE(">", 2), [], 5), (p, [], None)) and options_subset((p, [], 5), (p, [("a", True)], 10)) and not options_subset((p, [], None), (p, [], 10)) and not options_subset((AGE(">", 2), [], 5), (p, [], 10))


leaf = st.one_of(
    st.builds(Compare, st.sampled_from("xy"), st.sampled_from(["=", ">", ">=", "<", "<="]), st.integers(0, 3)),
    st.builds(Compare, st.sampled_from("xy"), st.just("="), st.none()),
    st.builds(In, st.sampled_from("xy"), st.lists(st.integers(0, 3), min_size=1, max_size=3).map(tuple)),
    st.sampled_from([TRUE, FALSE]),
)
tree = st.recursive(leaf, lambda t: st.one_of(st.builds(lambda a, b: And((a, b)), t, t), st.builds(lambda a, b: Or((a, b)), t, t), st.builds(Not, t)), max_leaves=5)
#: Values around and between the literals; half steps, because fields may be real numbers.
POINTS = [None, -0.5, 0, 0.5, 1, 1.5, 2, 2.5, 3, 3.5]


def holds(p, row):
    """Three-valued evaluation."""
    match p:
        case Compare(f, "=", None):
            return row[f] is None
        case Compare(f, op, v):
            x = row[f]
            return None if x is None else {"=": x == v, ">": x > v, ">=": x >= v, "<": x < v, "<=": x <= v}[op]
        case In(f, vs):
            return None if row[f] is None else row[f] in vs
        case And(ps):
            got = [holds(q, row) for q in ps]
            return False if False in got else None if None in got else True
        case Or(ps):
            got = [holds(q, row) for q in ps]
            return True if True in got else None if None in got else False
        case Not(q):
            got = holds(q, row)
            return None if got is None else not got
        case NotTrue(q):
            return holds(q, row) is not True
    return p.value


ROWS = [{"x": a, "y": b} for a in POINTS for b in POINTS]


@settings(max_examples=600, deadline=None)
@given(tree, tree)
def test_containment_is_sound_and_difference_exact(a, b):
    if is_subset(a, b):
        assert not [r for r in ROWS if holds(a, r) is True and holds(b, r) is not True], (text(a), text(b))
    if disjoint(a, b):
        assert not [r for r in ROWS if holds(a, r) is True and holds(b, r) is True]
    m = minus(a, b)
    assert [r for r in ROWS if holds(m, r) is True] == [r for r in ROWS if holds(a, r) is True and holds(b, r) is not True], (text(a), text(b), text(m))
    assert all(holds(normalize(a), r) is holds(a, r) or holds(a, r) is None for r in ROWS)


@settings(max_examples=300, deadline=None)
@given(leaf, leaf)
def test_containment_is_complete_for_one_field(a, b):
    fields = {getattr(a, "field", "x"), getattr(b, "field", "x")}
    if len(fields) == 1 and not [r for r in ROWS if holds(a, r) is True and holds(b, r) is not True] and FALSE not in (a, b) and TRUE not in (a, b):
        assert is_subset(a, b)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(p=tree)
def test_columns_evaluate_alike(spark, p):
    df = spark.createDataFrame([(i, float(r["x"]) if r["x"] is not None else None, float(r["y"]) if r["y"] is not None else None) for i, r in enumerate(ROWS)], "i int, x double, y double")
    assert {r.i for r in df.where(to_column(p)).collect()} == {i for i, r in enumerate(ROWS) if holds(p, r) is True}


def test_difference_of_what_nothing_fulfils():
    never = And((Compare("x", "=", None), Not(Compare("x", "=", None))))
    assert minus(never, Not(Compare("x", "=", None))) == FALSE
