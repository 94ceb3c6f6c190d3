"""Predicates of subset queries: a small expression language over columns and literals.

The language has constants, comparisons of a field with a literal, membership, AND, OR and NOT; remainders of
coverage planning add IS NOT TRUE. A predicate is turned into a Spark Column (execution is Catalyst's), into
parameterised SQL, into canonical text, which keys caches, and to and from JSON.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Literal = str | int | float | bool | None
OPS = ("=", ">", ">=", "<", "<=")
FLIPPED = {">": "<=", ">=": "<", "<": ">=", "<=": ">"}


class PredicateError(ValueError):
    """A predicate that cannot be compiled."""


class Predicate:
    """Base of the nodes; they combine with &, | and ~."""

    def __and__(self, other: Predicate) -> Predicate:
        return And((self, other))

    def __or__(self, other: Predicate) -> Predicate:
        return Or((self, other))

    def __invert__(self) -> Predicate:
        return Not(self)


@dataclass(frozen=True)
class Constant(Predicate):
    value: bool


@dataclass(frozen=True)
class Compare(Predicate):
    field: str
    op: str
    value: Literal


@dataclass(frozen=True)
class In(Predicate):
    field: str
    values: tuple[Literal, ...]


@dataclass(frozen=True)
class And(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True)
class Or(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True)
class Not(Predicate):
    part: Predicate


@dataclass(frozen=True)
class NotTrue(Predicate):
    """True where the part is false or unknown: what a null-safe remainder needs."""

    part: Predicate


TRUE, FALSE = Constant(True), Constant(False)


def kind(value: Literal) -> str:
    """The comparison class of a literal; integers and floats compare with each other, nothing else across kinds."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    return "number" if isinstance(value, int | float) else "string"


def same(a: Literal, b: Literal) -> bool:
    """Structural equality: nulls are equal, 1 equals 1.0, true does not equal 1."""
    return kind(a) == kind(b) and a == b


def _key(p: Predicate) -> Any:
    """Identity of a node under same()."""
    lit = lambda v: (kind(v), float(v) if kind(v) == "number" and abs(v) < 2**53 else v)
    match p:
        case Constant(v):
            return ("const", v)
        case Compare(f, op, v):
            return ("cmp", f, op, lit(v))
        case In(f, vs):
            return ("in", f, tuple(map(lit, vs)))
        case And(ps) | Or(ps):
            return (type(p).__name__, tuple(map(_key, ps)))
        case Not(x) | NotTrue(x):
            return (type(p).__name__, _key(x))
    raise PredicateError(f"unknown node {p!r}")


def equal(a: Predicate | None, b: Predicate | None) -> bool:
    if a is None or b is None:
        return a is b
    return _key(normalize(a)) == _key(normalize(b))


def normalize(p: Predicate) -> Predicate:
    """Flattens AND and OR, drops neutral parts and repeats, folds absorbing ones, double negation and negated constants."""
    match p:
        case And(parts) | Or(parts):
            conj = isinstance(p, And)
            flat: list[Predicate] = []
            for part in map(normalize, parts):
                flat += part.parts if type(part) is type(p) else [part]
            if any(x == Constant(not conj) for x in flat):
                return Constant(not conj)
            seen: dict[Any, Predicate] = {}
            for x in flat:
                if x != Constant(conj):
                    seen.setdefault(_key(x), x)
            kept = tuple(seen.values())
            return Constant(conj) if not kept else kept[0] if len(kept) == 1 else type(p)(kept)
        case Not(part):
            inner = normalize(part)
            if isinstance(inner, Constant):
                return Constant(not inner.value)
            return inner.part if isinstance(inner, Not) else Not(inner)
        case NotTrue(part):
            inner = normalize(part)
            return Constant(not inner.value) if isinstance(inner, Constant) else NotTrue(inner)
    return p


def _plain(v: Literal) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    return f"'{v}'" if isinstance(v, str) else str(v)


def text(p: Predicate) -> str:
    """Canonical text, for display and cache keys; never executed."""
    match p:
        case Constant(v):
            return "TRUE" if v else "FALSE"
        case Compare(f, "=", None):
            return f"{f} IS NULL"
        case Compare(f, op, v):
            return f"{f} {op} {_plain(v)}"
        case In(f, vs):
            return f"{f} IN ({', '.join(map(_plain, vs))})"
        case And(ps) | Or(ps):
            return f" {type(p).__name__.upper()} ".join(f"({text(x)})" if isinstance(x, And | Or) else text(x) for x in ps)
        case Not(x):
            return f"NOT ({text(x)})"
        case NotTrue(x):
            return f"({text(x)}) IS NOT TRUE"
    raise PredicateError(f"unknown node {p!r}")


def predicate_key(p: Predicate | None, raw: str | None = None) -> str:
    """The cache key: the structured form where there is one, else the raw text as it stands, else `all`."""
    if p is not None:
        return f"pred:{to_json(p)}"
    return f"sql:{raw}" if raw else "all"


# --- JSON


def _tagged(v: Literal) -> dict:
    match v:
        case None:
            return {"type": "null"}
        case bool():
            return {"type": "bool", "bool": v}
        case int():
            return {"type": "int", "int": v}
        case float():
            return {"type": "double", "double": v}
    return {"type": "string", "string": v}


def _untagged(d: dict) -> Literal:
    return None if d["type"] == "null" else d[d["type"]]


def _tree(p: Predicate) -> dict:
    match p:
        case Constant(v):
            return {"node": "constant", "value": v}
        case Compare(f, op, v):
            return {"node": "compare", "field": f, "op": op, "value": _tagged(v)}
        case In(f, vs):
            return {"node": "in", "field": f, "values": [_tagged(v) for v in vs]}
        case And(ps) | Or(ps):
            return {"node": type(p).__name__.lower(), "parts": [_tree(x) for x in ps]}
        case Not(x):
            return {"node": "not", "part": _tree(x)}
        case NotTrue(x):
            return {"node": "not_true", "part": _tree(x)}
    raise PredicateError(f"unknown node {p!r}")


def to_json(p: Predicate) -> str:
    return json.dumps(_tree(normalize(p)), sort_keys=True, separators=(",", ":"))


def _from_tree(d: dict) -> Predicate:
    match d["node"]:
        case "constant":
            return Constant(d["value"])
        case "compare":
            return Compare(d["field"], d["op"], _untagged(d["value"]))
        case "in":
            return In(d["field"], tuple(map(_untagged, d["values"])))
        case "and" | "or":
            return (And if d["node"] == "and" else Or)(tuple(map(_from_tree, d["parts"])))
        case "not":
            return Not(_from_tree(d["part"]))
        case "not_true":
            return NotTrue(_from_tree(d["part"]))
    raise PredicateError(f"unknown node {d['node']!r}")


def from_json(data: str) -> Predicate:
    return normalize(_from_tree(json.loads(data)))


# --- field names

#: Fixed names that the general rule would split otherwise.
ALIASES = {"dateTimeValue": "datetime_value", "endDateTimeValue": "end_datetime_value", "startDateTime": "start_datetime", "endDateTime": "end_datetime"}
FIELD = re.compile(r"[^\W\d]\w*(?:\.[^\W\d]\w*)*")


def snake_case(name: str) -> str:
    """camelCase to snake_case, runs of capitals as one word: fooID2Bar is foo_id2_bar."""
    if name in ALIASES:
        return ALIASES[name]
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def snake_case_column(name: Column) -> Column:
    """snake_case() of a column of names."""
    general = F.lower(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_"))
    chosen = F.when(name == next(iter(ALIASES)), ALIASES[next(iter(ALIASES))])
    for alias, to in list(ALIASES.items())[1:]:
        chosen = chosen.when(name == alias, to)
    return chosen.otherwise(general)


def column_name(field: str) -> str:
    """The validated column path of a field: each segment in snake case."""
    if not FIELD.fullmatch(field):
        raise PredicateError(f"invalid field {field!r}")
    return ".".join(map(snake_case, field.split(".")))


# --- to Spark and to SQL


def _checked(p: Compare | In) -> None:
    if isinstance(p, In) and not p.values:
        raise PredicateError(f"empty list for {p.field}")
    if isinstance(p, Compare):
        if p.op not in OPS:
            raise PredicateError(f"unknown operator {p.op}")
        if p.value is None and p.op != "=":
            raise PredicateError(f"{p.op} with null")


def to_column(p: Predicate, types: dict[str, str] | None = None) -> Column:
    """The Column of a predicate. types: columns' Spark type names, to refuse literals of another kind before Spark casts them."""
    match p:
        case Constant(v):
            return F.lit(v)
        case Compare(f, op, v):
            _checked(p)
            c = F.col(".".join(f"`{x}`" for x in column_name(f).split(".")))
            if v is None:
                return c.isNull()
            _fits(f, v, types)
            return {"=": c == v, ">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v}[op]
        case In(f, vs):
            _checked(p)
            c = F.col(".".join(f"`{x}`" for x in column_name(f).split(".")))
            for v in vs:
                _fits(f, v, types)
            return c.isin(*vs)
        case And(ps):
            return F.lit(True) if not ps else reduce(lambda a, b: a & b, (to_column(x, types) for x in ps))
        case Or(ps):
            return F.lit(False) if not ps else reduce(lambda a, b: a | b, (to_column(x, types) for x in ps))
        case Not(x):
            return ~to_column(x, types)
        case NotTrue(x):
            return ~F.coalesce(to_column(x, types), F.lit(False))
    raise PredicateError(f"unknown node {p!r}")


def _fits(field: str, value: Literal, types: dict[str, str] | None) -> None:
    if types is None or value is None or column_name(field) not in types:
        return
    t = types[column_name(field)]
    has = "string" if t.startswith(("string", "varchar", "char", "timestamp", "date")) else "bool" if t == "boolean" else "number"
    if kind(value) != has:
        raise PredicateError(f"{field} is {t}, {value!r} is not")


def to_sql(p: Predicate, marker: str = "${}") -> tuple[str, dict[str, Literal]]:
    """A WHERE clause and its parameters, numbered in depth-first order from 1."""
    params: dict[str, Literal] = {}

    def bind(v: Literal) -> str:
        params[str(len(params) + 1)] = v
        return marker.format(len(params))

    def walk(p: Predicate) -> str:
        match p:
            case Constant(v):
                return "TRUE" if v else "FALSE"
            case Compare(f, op, v):
                _checked(p)
                return f"{column_name(f)} IS NULL" if v is None else f"{column_name(f)} {op} {bind(v)}"
            case In(f, vs):
                _checked(p)
                return f"{column_name(f)} IN ({', '.join(map(bind, vs))})"
            case And(ps) | Or(ps):
                if not ps:
                    return "TRUE" if isinstance(p, And) else "FALSE"
                return walk(ps[0]) if len(ps) == 1 else "(" + f" {type(p).__name__.upper()} ".join(map(walk, ps)) + ")"
            case Not(x):
                return f"NOT ({walk(x)})"
            case NotTrue(x):
                return f"({walk(x)}) IS NOT TRUE"
        raise PredicateError(f"unknown node {p!r}")

    return walk(p), params


def params_json(params: dict[str, Literal]) -> str:
    return json.dumps(params, sort_keys=True, separators=(",", ":"))


# --- options pushed to a source


@dataclass(frozen=True)
class Option:
    """A source option that comparisons of one field with one of these operators set."""

    name: str
    ops: tuple[str, ...] = ("=",)
    allows_in: bool = False


def to_options(p: Predicate, fields: dict[str, Option]) -> dict[str, Any]:
    """Source options of a conjunction; field names in any case. Anything else than AND of known fields is refused."""
    known = {k.lower(): v for k, v in fields.items()}
    out: dict[str, Any] = {}

    def put(field: str, op: str, value: Any) -> None:
        option = known.get(field.lower())
        if option is None or (op == "in" and not option.allows_in) or (op != "in" and op not in option.ops):
            raise PredicateError(f"{field} {op} is not supported")
        out[option.name if op in ("=", "in") else f"{option.name}{op}"] = value

    def walk(p: Predicate) -> None:
        match p:
            case Constant(True):
                return
            case Compare(f, op, v):
                put(f, op, v)
            case In(f, vs):
                put(f, "in", list(vs))
            case And(ps):
                for x in ps:
                    walk(x)
            case _:
                raise PredicateError(f"{type(p).__name__} is not supported")

    walk(normalize(p))
    return out


UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")


def uuid_option(value: Literal) -> str:
    if not isinstance(value, str) or not UUID.fullmatch(value):
        raise PredicateError(f"not a UUID: {value!r}")
    return value


def bool_option(value: Literal) -> bool:
    if not isinstance(value, bool):
        raise PredicateError(f"not a boolean: {value!r}")
    return value
