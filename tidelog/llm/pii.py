"""PII (operator 9, native): fixed patterns and information-theoretic sanitisation.

Base spans are `email`, `ip`, `card` (12 to 19 digits that pass Luhn) and `phone`. Each distinct base value is
a protected entity c. A term t discloses c when knowing t gives away most of what c says: with probabilities
counted over the distinct texts of the whole corpus, PMI(t, c) >= ALPHA * IC(c), where
PMI = log(n(t,c) N / (n(t) n(c))) and IC = -log(n(c) / N). N counts the distinct texts (copies are one), n(t) and
n(c) those that hold t or c, n(t,c) those that hold both, at any distance; terms are WORD matches of three code
points or more outside base spans. Co-occurrence must not come from copying: among the texts of n(t,c), c must stand in
SUPPORT distinct contexts at least, and in one for every 1 / INDEPENDENT texts. The context of c in a text is the three smallest
hashes of two neighbouring words within CONTEXT code points of it (words that the edge cuts left out), so that a passage copied into
several texts is one context, and near copies of a text, few words of which differ, mostly are. Disclosing terms become
`term` spans wherever they stand, in texts that do not hold c too; sanitise() generalises them (to the class of their
shape) and removes the base values.

The rule can be written n(t,c) / n(t) >= (n(c) / N) ^ (1 - ALPHA). Texts that hold an entity are few; n(t) is at least the
number of those among them that hold t, so most pairs fail before n(t) is counted over the corpus, and only the terms of
the others are looked for in all texts. Terms, entities and texts are known by 64-bit hashes.

Defined cases. Null text: as empty, no spans and the digest of the empty string. Empty table: no rows.
Repeated rows: each gets its own result row. Further columns of the input are ignored. Texts are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.scratch import Scratch
from tidelog.llm.spans import count_of, digest, let, listed, name, quoted, replace, spans

#: The base patterns, with possessive repetition where what follows cannot match what it took.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{N}](?:[\p{L}\p{N}'’-]*[\p{L}\p{N}])?"
EDGE_LEFT, EDGE_RIGHT = r"^[\p{L}\p{N}'’-]+", r"[\p{L}\p{N}'’-]+$"  # what may be a part of a word
KINDS = ("email", "ip", "card", "phone", "term")
ALPHA = 0.8
SUPPORT, INDEPENDENT = 3, 1 / 2
CONTEXT = 80


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """True where a string of digits passes Luhn's check."""
    c, i, a, b = name(), name(), name(), name()
    figures = f"transform(split(reverse({digits}), '(?!^)(?!$)'), ({c}, {i}) -> case when {i} % 2 = 0 then cast({c} as int) else cast({c} as int) * 2 - if(cast({c} as int) > 4, 9, 0) end)"
    return f"aggregate({figures}, 0, ({a}, {b}) -> {a} + {b}) % 10 = 0"


def _octets(value: str) -> str:
    x = name()
    return f"forall(split({value}, '\\\\.'), {x} -> length(regexp_replace({x}, '^0+', '')) <= 3 and coalesce(try_cast({x} as decimal(38, 0)), 999) <= 255)"


def base_spans(text: str) -> str:
    """email, ip, card and phone spans of a text that is not null."""
    return "concat(" + ", ".join([
        spans(text, EMAIL, "email", 0, hint=f"contains({text}, '@')"),
        spans(text, IP, "ip", 1, keep=_octets, hint=f"contains({text}, '.')"),
        spans(text, CARD, "card", 2, keep=lambda m: f"case when length({_digits(m)}) between 12 and 19 then {_luhn(_digits(m))} else false end"),
        spans(text, PHONE, "phone", 3, keep=lambda m: f"length({_digits(m)}) between 9 and 15", hint=f"contains({text}, '+')"),
    ]) + ")"


def with_base(rows: DataFrame) -> DataFrame:
    """Adds the column base. It is made once: by a generator, so that filters and projections over it do not repeat it."""
    return rows.select("*", F.expr(f"explode(array({base_spans('text')}))").alias("base"))


def _entity(span: str) -> str:
    """What a base span protects, alike however it is written."""
    return f"concat_ws(':', {span}.kind, case when {span}.kind in ('card', 'phone') then {_digits(span + '.value')} else lower({span}.value) end)"


def _words(text: str, base: str) -> str:
    """The WORD matches of a text outside its base spans, in order."""
    return f"regexp_extract_all({replace(text, base, lambda _: quoted(' '))}, {quoted(WORD)}, 0)"


def _term(word: str) -> str:
    return f"xxhash64(lower({word}))"


def _held(text: str, base: str) -> str:
    """The entities of a text, ascending, each with a hash of its context there (the smallest, where it stands several times)."""
    s, x, i = name(), name(), name()
    left = f"substring({text}, greatest({s}.start - {CONTEXT}, 0) + 1, least({s}.start, {CONTEXT}))"
    left = f"case when {s}.start > {CONTEXT} then regexp_replace({left}, {quoted(EDGE_LEFT)}, '') else {left} end"
    right = f"substring({text}, {s}.`end` + 1, {CONTEXT})"
    right = f"case when {s}.`end` + {CONTEXT} < length({text}) then regexp_replace({right}, {quoted(EDGE_RIGHT)}, '') else {right} end"
    words = lambda side: f"regexp_extract_all(lower({side}), {quoted(WORD)}, 0)"
    pairs = let(f"concat({words(left)}, array(''), {words(right)})", lambda w: f"case when size({w}) > 1 then xxhash64(slice(array_sort(transform(sequence(1, size({w}) - 1), {i} -> xxhash64({w}[{i} - 1], {w}[{i}]))), 1, 3)) else 0L end")
    each = f"array_sort(transform({base}, {s} -> named_struct('entity', xxhash64({_entity(s)}), 'context', {pairs})))"
    return let(each, lambda all_: f"filter({all_}, ({x}, {i}) -> {i} = 0 or get({all_}, {i} - 1).entity <> {x}.entity)")


def disclosing(rows: DataFrame, scratch: Scratch, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """doc_id, mark, terms: the disclosing terms that each row (doc_id, mark, text) holds, from counts over every distinct text.

    What texts are joined with is written first, so that Spark knows its size and texts are not shuffled where it is small.
    """
    based = with_base(rows.select("doc_id", "mark", "text"))
    words = based.select("doc_id", "mark", F.expr(f"explode({_words('text', 'base')})").alias("word")).where(F.length("word") >= 3).select("doc_id", "mark", F.expr(_term("word")).alias("term"))
    n = max(1, rows.select("mark").distinct().count())
    # each distinct text that holds an entity, once
    m = name()
    own = f"array_distinct(transform(filter({_words('text', 'base')}, {m} -> length({m}) >= 3), {m} -> {_term(m)}))"
    texts = based.where(F.size("base") > 0).select("mark", F.expr(_held("text", "base")).alias("held"), F.expr(own).alias("terms"))
    texts = scratch.save(texts.dropDuplicates(["mark"]), "texts")
    entities = texts.select(F.inline("held")).groupBy("entity").agg(F.count("*").alias("n_c"), F.countDistinct("context").alias("n_contexts"))
    entities = scratch.save(entities.where(F.col("n_contexts") >= support).select("entity", "n_c"), "entities")  # of others no term can have the support
    near = texts.select("terms", F.inline("held")).join(entities, "entity").select("entity", "n_c", "context", F.explode("terms").alias("term"))
    pairs = near.groupBy("term", "entity", "n_c").agg(F.count("*").alias("n_tc"), F.countDistinct("context").alias("n_contexts")).where(F.col("n_contexts") >= F.greatest(F.lit(support), F.ceil(INDEPENDENT * F.col("n_tc")))).drop("n_contexts")
    pairs = scratch.save(pairs, "pairs")
    tells = lambda n_t: F.col("n_tc") / F.col(n_t) >= F.pow(F.col("n_c") / F.lit(float(n)), F.lit(1 - alpha)) * (1 - 1e-9)
    least = texts.select(F.explode("terms").alias("term")).join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_least"))
    pairs = scratch.save(pairs.join(least, "term").where(tells("n_least")).drop("n_least"), "likely")
    asked = scratch.save(pairs.select("term").distinct(), "asked")
    uses = scratch.save(words.join(asked, "term", "left_semi").distinct(), "uses")
    terms = uses.groupBy("term").agg(F.countDistinct("mark").alias("n_t"))
    told = scratch.save(pairs.join(terms, "term").where(tells("n_t")).select("term").distinct(), "told")
    return scratch.save(uses.join(told, "term", "left_semi").groupBy("doc_id", "mark").agg(F.collect_set("term").alias("terms")), "terms")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, support: int = SUPPORT, carry: Column | None = None) -> DataFrame:
    """doc_id, text, base (spans), found (base and term spans) and carry (a column to take along) for every row of docs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (F.lit(None) if carry is None else carry).alias("carry")).withColumn("mark", F.xxhash64("text"))
    based = with_base(rows)
    scratch = Scratch(docs.sparkSession)
    added = disclosing(rows.drop("carry"), scratch, alpha, support)
    scratch.release()
    added = added.select(F.col("doc_id").alias("added_id"), F.col("mark").alias("added_mark"), "terms")
    joined = based.join(added, F.col("doc_id").eqNullSafe(F.col("added_id")) & (F.col("mark") == F.col("added_mark")), "left")
    x, y = name(), name()
    places = spans("text", WORD, "term", 4, keep=lambda m: f"array_contains(terms, {_term(m)})", hint="terms is not null")
    more = f"filter({places}, {x} -> not exists(base, {y} -> {y}.start < {x}.`end` and {x}.start < {y}.`end`))"
    return joined.select("doc_id", "text", "base", F.expr(f"concat(base, {more})").alias("found"), "carry")


def _shape(value: str) -> str:
    """What a term is generalised to."""
    return f"case when {value} rlike '^\\\\p{{N}}+$' then '[NUMBER]' when {value} rlike '^\\\\p{{Lu}}' then '[NAME]' else '[TERM]' end"


def sanitise(scanned: DataFrame) -> DataFrame:
    """Adds `clean`: base values removed (their kind stands for them), disclosing terms generalised."""
    return scanned.withColumn("clean", F.expr(replace("text", "found", lambda s: f"case when {s}.kind = 'term' then {_shape(s + '.value')} else concat('[', upper({s}.kind), ']') end")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        *(count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]),
        digest(F.col("base")).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        count_of(F.col("found"), "term").alias("n_term"),
    )
