"""Secret scan (operator 2, native): fixed credential patterns and a randomness test battery.

Base spans are `assign` (a credential name, a separator, a value of six characters or more), `access`
(AKIA keys) and `hex` (runs of 24 or more). The battery adds `random` spans: every maximal run of 20 or more base64
characters that holds a digit and a letter is given the smallest alphabet that fits it (its inferred
encoding) and tested against uniform randomness: chi-squared of the symbol counts (over single symbols, and over cells
of neighbouring symbols wide enough to expect five in each), the Wald-Wolfowitz runs test about the alphabet's middle
and the lag-one serial correlation. Stouffer's sum of the one-sided departures is the run's score z: about standard
normal for random runs, and growing with the length of identifiers, paths and other ordinary text.

A run is a discovery if it is much closer to random than ordinary text of its length. The null hypothesis is that it is
ordinary: z is normal about ORDINARY's line in the square root of the length. The corpus' own ordinary runs (those without
a digit) may move that line towards random and widen it, never the other way. P-values are the lower tail of that, so the
same score says more of a long run than of a short one. Runs that uniform randomness itself rejects (z over MOST) get
p = 1. Benjamini and Hochberg's rule over the distinct candidate runs of the corpus holds the false discoveries to `fdr` of what is
reported. A run that holds both + or / and - or _ fits no alphabet: its parts between / and + are tested and its parts
between - and _; a part that is found within another that is, is not reported.

The ranking needs no sort of runs: they are counted in bins of 1/STEP standard deviations, and the rule is applied to the
bins' upper edges. Three numbers come back, and each text is judged where it lies.

Defined cases. Null text: as empty, no spans and the digest of the empty string. Empty table: no rows.
Repeated rows: each gets its own result row. Further columns of the input are ignored. Texts are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.scratch import Scratch
from tidelog.llm.spans import SPAN, count_of, digest, let, listed, name, quoted, spans

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}+"
#: Runs of the symbols of all alphabets, and with two of the four separators only.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}"
RUN_OF = r"(?<![A-Za-z0-9{0}])(?=[0-9{0}]*+[A-Za-z])[A-Za-z0-9{0}]{{20,}}+={{0,2}}"
KINDS = ("assign", "access", "hex", "random")
#: Alphabets from narrow to wide: the symbols of an encoding in order of value.
HEX_LOWER, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER36 = "0123456789abcdefghijklmnopqrstuvwxyz"
UPPER36 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE64URL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
ALPHABETS = (HEX_LOWER, HEX_UPPER, BASE32, LOWER36, UPPER36, BASE62, BASE64, BASE64URL)
#: Ordinary runs of n symbols have z about SLOPE * sqrt(n) + BASE with deviation SPREAD (fitted on generated identifiers,
#: paths and dated names); that counts as WEIGHT runs beside the corpus' own.
SLOPE, BASE, SPREAD, WEIGHT = 1.6, -5.0, 1.25, 50
MOST = 3.09
STEP = 100
_HALF_NORMAL_MEAN = 0.7978845608028654


def base_spans(text: str) -> str:
    """assign, access and hex spans of a text that is not null."""
    return "concat(" + ", ".join([
        spans(text, ASSIGN, "assign", 0, group=(2, lambda g: f"length({g}) >= 6")),
        spans(text, ACCESS, "access", 1, keep=lambda m: f"length({m}) >= 20", hint=f"contains({text}, 'AKIA')"),
        spans(text, HEX, "hex", 2),
    ]) + ")"


def _segments(run: str) -> str:
    """The spans to test of a run: itself, or where it fits no alphabet, its parts between / and + and its parts between - and _."""
    x = name()
    parts = f"array_distinct(concat({spans(run + '.value', RUN_OF.format('_-'), 'random', 3)}, {spans(run + '.value', RUN_OF.format('+/'), 'random', 3)}))"
    moved = f"transform({parts}, {x} -> named_struct('start', {x}.start + {run}.start, 'rank', {x}.rank, 'end', {x}.`end` + {run}.start, 'kind', {x}.kind, 'value', {x}.value))"
    return f"case when {run}.value rlike '[+/]' and {run}.value rlike '[_-]' then cast({moved} as {SPAN}) else cast(array({run}) as {SPAN}) end"


def normal_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal: the rational approximation 26.2.17 of Abramowitz and Stegun (error below 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * t * (0.31938153 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(value: str) -> str:
    """A struct (n, z) of a run: its number of symbols and its score; null where no alphabet fits."""
    c, j, a, b, i = (name() for _ in range(5))
    bare = f"trim(trailing '=' from {value})"
    fits = lambda letters: quoted("^[" + letters.replace("-", r"\-") + "]+$")
    alphabet = lambda x: "case " + " ".join(f"when {x} rlike {fits(letters)} then {quoted(letters)}" for letters in ALPHABETS) + " end"
    codes = lambda x, letters: f"transform(split({x}, '(?!^)(?!$)'), {c} -> cast(instr({letters}, {c}) - 1 as double))"
    # chi-squared, by Wilson and Hilferty's cube root as a normal score
    score = lambda chi, k: f"(pow(greatest({chi}, 0D) / {k}, 1D / 3) - (1 - 2D / (9 * {k}))) / sqrt(2D / (9 * {k}))"

    def counted(s: str) -> str:
        """s: m, codes. Adds n, the number of cells, and sums."""
        high = lambda x: f"{x} >= {s}.m / 2"
        head, tail = f"slice({s}.codes, 1, size({s}.codes) - 1)", f"slice({s}.codes, 2, size({s}.codes) - 1)"
        total = lambda values: f"aggregate({values}, 0D, ({a}, {b}) -> {a} + {b})"
        fields = {
            "m": f"{s}.m", "n": f"cast(size({s}.codes) as double)", "codes": f"{s}.codes", "cells": f"greatest(2, least(cast({s}.m as int), size({s}.codes) div 5))",
            "squares": f"aggregate(array_distinct({s}.codes), 0D, ({a}, {b}) -> {a} + pow(cast(size(filter({s}.codes, {i} -> {i} = {b})) as double), 2))",
            "high": f"cast(size(filter({s}.codes, {i} -> {high(i)})) as double)",
            "changes": total(f"zip_with({head}, {tail}, ({a}, {b}) -> if(({high(a)}) <> ({high(b)}), 1D, 0D))") + " + 1",
            "s1": total(f"{s}.codes"), "s2": total(f"transform({s}.codes, {i} -> {i} * {i})"), "s12": total(f"zip_with({head}, {tail}, ({a}, {b}) -> {a} * {b})"),
            "ends": f"{s}.codes[0] + {s}.codes[size({s}.codes) - 1]",
        }
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def scored(s: str) -> str:
        expected = f"{s}.n / {s}.m * (ceil(({j} + 1) * {s}.m / {s}.cells) - ceil({j} * {s}.m / {s}.cells))"
        seen = f"size(filter({s}.codes, {i} -> floor({i} * {s}.cells / {s}.m) = {j}))"
        pooled = f"aggregate(sequence(0, {s}.cells - 1), 0D, ({a}, {j}) -> {a} + pow({seen} - {expected}, 2) / ({expected}))"
        chi = score(f"{s}.m / {s}.n * {s}.squares - {s}.n", f"({s}.m - 1)") + " + " + score(pooled, f"({s}.cells - 1)")
        # runs above and below the middle of the alphabet
        mean = f"(2 * {s}.high * ({s}.n - {s}.high) / {s}.n + 1)"
        var = f"(({mean} - 1) * ({mean} - 2) / ({s}.n - 1))"
        changes = f"case when {var} > 0 then abs({s}.changes - {mean}) / sqrt({var}) else 6D end"
        # serial correlation of neighbours
        avg = f"({s}.s1 / {s}.n)"
        cov, ss = f"({s}.s12 - {avg} * (2 * {s}.s1 - {s}.ends) + ({s}.n - 1) * {avg} * {avg})", f"({s}.s2 - {s}.n * {avg} * {avg})"
        serial = f"case when {ss} > 1e-9D then abs({cov} / {ss}) * sqrt({s}.n) else 6D end"
        # the half-normal mean is taken off the two-sided scores; the chi-squared pair is correlated by about a half
        h = f"{_HALF_NORMAL_MEAN}D"
        return f"named_struct('n', {s}.n, 'z', ({chi} + ({changes} - {h}) + ({serial} - {h})) / sqrt(3 + 2 * (1 - {h} * {h})))"

    made = let(bare, lambda x: let(alphabet(x), lambda letters: f"case when {letters} is not null then named_struct('m', cast(length({letters}) as double), 'codes', {codes(x, letters)}) end"))
    return let(made, lambda s: f"case when {s} is not null then {let(counted(s), scored)} end")


def _departure(n: str, z: str, shift: float = 0.0, spread: float = SPREAD) -> str:
    """Standard deviations by which a score departs from ordinary runs of its length."""
    return f"(({z} - ({SLOPE}D * sqrt({n}) + {BASE}D) - {shift!r}D) / {spread!r}D)"


def _bin(n: str, z: str, shift: float, spread: float) -> str:
    return f"cast(floor(-{_departure(n, z, shift, spread)} * {STEP}) as int)"


def tested(texts: DataFrame) -> DataFrame:
    """value, n, z and candidate (holds a digit) of every distinct run of a column text that fits an alphabet."""
    run, of = name(), name()
    runs = texts.select(F.expr(f"explode(flatten(transform({spans('text', RUN, 'random', 3)}, {run} -> {_segments(run)})))").alias("s")).select("s.value").distinct()
    rows = runs.select("value", F.expr(f"explode(array({battery('value')}))").alias(of)).where(F.col(of).isNotNull())
    return rows.select("value", f"{of}.n", f"{of}.z", F.col("value").rlike("[0-9]").alias("candidate"))


def controlled(runs: DataFrame, fdr: float) -> tuple[float, float, int | None]:
    """Of tested(): shift and spread of the ordinary runs, and the bin from which on candidates are discoveries (None: there are none)."""
    e = F.expr(_departure("n", "z")) * SPREAD
    k, e1, e2 = runs.where("not candidate").agg(F.count("*"), F.coalesce(F.sum(e), F.lit(0.0)), F.coalesce(F.sum(e * e), F.lit(0.0))).first()
    shift = min(0.0, e1 / (k + WEIGHT))
    spread = max(SPREAD, ((WEIGHT * SPREAD**2 + max(0.0, e2 - (e1 * e1 / k if k else 0.0))) / (WEIGHT + k)) ** 0.5)
    candidates = runs.where("candidate")
    bins = candidates.withColumn("bin", F.expr(f"case when z <= {MOST} then greatest({_bin('n', 'z', shift, spread)}, -1) else -1 end")).groupBy("bin").agg(F.count("*").alias("here"))
    ranked = bins.select("bin", F.sum("here").over(Window.orderBy(F.desc("bin"))).alias("rank"), F.sum("here").over(Window.partitionBy()).alias("tests"))  # some thousand rows at most
    found = ranked.where((F.col("bin") >= 0) & (normal_tail(F.col("bin") / STEP) <= F.lit(fdr) * F.col("rank") / F.col("tests")))
    return shift, spread, found.agg(F.min("bin")).first()[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.05) -> DataFrame:
    """id, text, base (spans), found (base and random spans) for every row of docs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shift, spread, cut = controlled(Scratch(docs.sparkSession).save(tested(rows), "runs"), fdr)  # distinct runs are few and short
    based = rows.select("*", F.expr(f"explode(array({base_spans('text')}))").alias("base"))
    if cut is None:
        return based.select("*", F.col("base").alias("found"))
    run, kept, x, y = (name() for _ in range(4))
    told = let(battery(f"{x}.value"), lambda b: f"coalesce({b}.z <= {MOST} and {_bin(f'{b}.n', f'{b}.z', shift, spread)} >= {cut}, false)")
    own = f"filter({_segments(run)}, {x} -> {x}.value rlike '[0-9]' and {told})"
    outer = let(own, lambda kept: f"filter({kept}, {x} -> not exists({kept}, {y} -> {y}.start <= {x}.start and {y}.`end` >= {x}.`end` and {y}.`end` - {y}.start > {x}.`end` - {x}.start))")
    more = f"flatten(transform({spans('text', RUN, 'random', 3)}, {run} -> {outer}))"
    return based.select("*", F.expr(f"concat(base, {more})").alias("found"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        *(count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]),
        digest(F.col("base")).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        count_of(F.col("found"), "random").alias("n_random"),
    )
