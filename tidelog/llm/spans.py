"""Native span extraction: positions of regular-expression matches as Spark expressions.

Spark returns the text of matches but not their places. Splitting the same text by the same expression
returns the gaps between them, and running sums over gap and match lengths give every start. All offsets
are code points, end exclusive.

The expressions are long, so they are written as SQL text, which the JVM parses at once.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
#: Matches that are appended to one array; more go into an array of such arrays, because appending copies.
BLOCK = 512
NO_SPANS = f"cast(array() as {SPAN})"
Sql = Callable[[str], str]
_NUMBERS = count()


def name() -> str:
    """A fresh name for a lambda's variable."""
    return f"v{next(_NUMBERS)}"


def quoted(text: str) -> str:
    """text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def let(value: str, use: Sql) -> str:
    """use(value), with value computed once for each row."""
    x = name()
    return f"transform(array({value}), {x} -> {use(x)})[0]"


def spans(text: str, pattern: str, kind: str, rank: int, keep: Sql | None = None, hint: str | None = None, group: tuple[int, Sql] | None = None) -> str:
    """Leftmost non-overlapping matches of pattern in text that pass keep(match), in order of start.

    hint: a cheap condition that is false where no match can be; there, the expression is not run.
    group: (number, test) tests that capturing group of each match besides.
    """
    p = quoted(pattern)
    m, g, gap, r = name(), name(), name(), name()
    found = f"regexp_extract_all({text}, {p}, 0)"
    parts = f"regexp_extract_all({text}, {p}, {group[0]})" if group else found
    passes = " and ".join([*([f"({keep(m)})"] if keep else []), *([f"({group[1](g)})"] if group else [])]) or "true"
    gaps = let(f"split({text}, {p}, -1)", lambda x: f"slice({x}, 1, greatest(size({x}) - 1, 0))")
    tested = f"zip_with({found}, {parts}, ({m}, {g}) -> named_struct('m', {m}, 'ok', coalesce({passes}, false)))" if group else f"transform({found}, {m} -> named_struct('m', {m}, 'ok', coalesce({passes}, false)))"
    rows = f"zip_with({gaps}, {tested}, ({gap}, {r}) -> named_struct('gap', length({gap}), 'm', {r}.m, 'ok', {r}.ok))"
    some = f"{text} rlike {p}" if hint is None else f"{hint} and {text} rlike {p}"
    return f"case when {some} then {let(rows, lambda x: _placed(x, kind, rank))} else {NO_SPANS} end"


def _block(at: str, rows: str, kind: str, rank: int) -> str:
    a, r = name(), name()
    end = f"{a}.at + {r}.gap + length({r}.m)"
    own = f"cast(array(named_struct('start', {a}.at + {r}.gap, 'rank', {rank}, 'end', {end}, 'kind', '{kind}', 'value', {r}.m)) as {SPAN})"
    return f"aggregate({rows}, named_struct('at', {at}, 'out', {NO_SPANS}), ({a}, {r}) -> named_struct('at', {end}, 'out', case when {r}.ok then concat({a}.out, {own}) else {a}.out end))"


def _placed(rows: str, kind: str, rank: int) -> str:
    """Spans of (gap, m, ok): matches with the length of what stands before each."""
    i, a, part = name(), name(), name()
    blocks = f"transform(sequence(0, cast((size({rows}) - 1) div {BLOCK} as int)), {i} -> slice({rows}, {i} * {BLOCK} + 1, {BLOCK}))"
    step = let(_block(f"{a}.at", part, kind, rank), lambda d: f"named_struct('at', {d}.at, 'out', concat({a}.out, array({d}.out)))")
    many = f"aggregate({blocks}, named_struct('at', 0, 'out', cast(array() as array<{SPAN}>)), ({a}, {part}) -> {step}, {a} -> flatten({a}.out))"
    return f"case when size({rows}) <= {BLOCK} then {_block('0', rows, kind, rank)}.out else {many} end"


def replace(text: str, found: str, mark: Sql) -> str:
    """text with every span replaced by mark(span); of overlapping spans the first (then the longest) stays and the others' rest goes with it."""
    a, b, s = name(), name(), name()
    ordered = f"array_sort({found}, ({a}, {b}) -> case when {a}.start <> {b}.start then {a}.start - {b}.start else {b}.`end` - {a}.`end` end)"
    kept = f"named_struct('at', {s}.`end`, 'out', concat({a}.out, substring({text}, {a}.at + 1, {s}.start - {a}.at), {mark(s)}))"
    passed = f"named_struct('at', greatest({a}.at, {s}.`end`), 'out', {a}.out)"
    done = f"aggregate({ordered}, named_struct('at', 0, 'out', ''), ({a}, {s}) -> case when {s}.start >= {a}.at then {kept} else {passed} end, {a} -> concat({a}.out, substring({text}, {a}.at + 1, length({text}))))"
    return f"case when size({found}) > 0 then {done} else {text} end"


def listed(found: Column) -> Column:
    """kind:start:end of spans in order of start, then rank, comma-joined."""
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: Column) -> Column:
    return F.sha2(listed(found).cast("binary"), 256)


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
