"""The registry of queries over the test tables, each with a DuckDB twin written by hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import rowkey
from tidelog.functions.predicates import Compare, In, snake_case_column
from tidelog.operators import cdc, membership
from tidelog.plans import algebra
from tidelog.plans.coverage import Cursor, Entry, Query, compute_missing, predicate_key
from tidelog.plans.subset import answer, project, subset, where
from tidelog.sources.changelog import event_data, events_changelog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    """Registers a function (spark, tables) under its name. tables(name) reads a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders, dearest first."""
    return QUERIES["topk_orders"](spark, sf_dir)


ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
ORDER_SQL = "o_orderkey, o_orderstatus, o_orderpriority, o_totalprice"
PRICE = "o_totalprice"


def orders(t, p=None) -> DataFrame:
    return where(t("orders"), p).select(*ORDER_COLUMNS)


# --- filters and projections


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_totalprice >= 200000 AND o_orderstatus = 'O'")
def filter_compare(spark, t):
    return orders(t, Compare(PRICE, ">=", 200_000) & Compare("o_orderstatus", "=", "O"))


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH')")
def filter_in(spark, t):
    return orders(t, In("o_orderpriority", ("1-URGENT", "5-LOW", "2-HIGH")))


@query(f"SELECT {ORDER_SQL} FROM orders WHERE NOT (o_orderstatus = 'F' OR (o_totalprice < 100000 AND o_orderpriority <> '1-URGENT'))")
def filter_or_not(spark, t):
    return orders(t, ~(Compare("o_orderstatus", "=", "F") | (Compare(PRICE, "<", 100_000) & ~Compare("o_orderpriority", "=", "1-URGENT"))))


def nulled():
    """The events' value, null in every seventh row."""
    return F.when(F.col("event_id") % 7 != 0, F.round("value", 4))


NULLED_SQL = "CASE WHEN event_id % 7 <> 0 THEN round(value, 4) END"


@query(f"SELECT event_id, v FROM (SELECT event_id, {NULLED_SQL} AS v FROM events) WHERE v IS NULL OR v > 50")
def filter_is_null(spark, t):
    rows = t("events").select("event_id", nulled().alias("v"))
    return where(rows, Compare("v", "=", None) | Compare("v", ">", 50))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def project_filter(spark, t):
    return project(where(t("orders"), Compare("o_orderstatus", "=", "P")), ["o_totalprice", "o_orderkey"])


@query(r"""
WITH n AS (SELECT p_partkey, CASE p_partkey % 11 WHEN 0 THEN 'dateTimeValue' WHEN 1 THEN 'endDateTimeValue' WHEN 2 THEN 'startDateTime' WHEN 3 THEN 'endDateTime' WHEN 4 THEN 'dateTime' WHEN 5 THEN 'fooID2Bar'
  WHEN 6 THEN 'HTTPServer' WHEN 7 THEN 'a1B' ELSE replace(p_type, ' ', '') || 'URLOf' || replace(p_brand, '#', '') || 'x' || p_size END AS name FROM part)
SELECT p_partkey, name, CASE name WHEN 'dateTimeValue' THEN 'datetime_value' WHEN 'endDateTimeValue' THEN 'end_datetime_value' WHEN 'startDateTime' THEN 'start_datetime' WHEN 'endDateTime' THEN 'end_datetime'
  ELSE lower(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '([A-Z])([A-Z][a-z])', '\1_\2', 'g')) END AS snake FROM n
""")
def snake_case_columns(spark, t):
    """Every part gives a name: a fixed one, or one made of its columns."""
    fixed = ["dateTimeValue", "endDateTimeValue", "startDateTime", "endDateTime", "dateTime", "fooID2Bar", "HTTPServer", "a1B"]
    made = F.concat(F.replace("p_type", F.lit(" "), F.lit("")), F.lit("URLOf"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("x"), F.col("p_size").cast("string"))
    name = F.coalesce(F.get(F.array(*map(F.lit, fixed)), (F.col("p_partkey") % 11).cast("int")), made)
    return t("part").select("p_partkey", name.alias("name")).select("p_partkey", "name", snake_case_column(F.col("name")).alias("snake"))


# --- order, limit, pages


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey ASC NULLS LAST LIMIT 25")
def topk_orders(spark, t):
    return subset(orders(t), Query(Compare("o_orderstatus", "=", "O"), ((PRICE, False),), 25), key=("o_orderkey",))


@query("""
(SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error' AND user_id = 40)
UNION ALL (SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error' AND user_id > 40 ORDER BY user_id ASC NULLS LAST, event_id ASC NULLS LAST LIMIT 30)
""")
def keyset_page_ties(spark, t):
    cursor = Cursor(Compare("user_id", ">", 40), Compare("user_id", "=", 40))
    q = Query(~Compare("event_type", "=", "error"), (("user_id", True),), 30, cursor)
    return subset(t("events").select("event_id", "user_id", "event_type"), q, key=("event_id",))


@query(f"SELECT event_id, v FROM (SELECT event_id, {NULLED_SQL} AS v FROM events) ORDER BY v ASC NULLS LAST, event_id LIMIT 40")
def topk_nulls_last(spark, t):
    return subset(t("events").select("event_id", nulled().alias("v")), Query(None, (("v", True),), 40), key=("event_id",))


# --- coverage


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_totalprice > 100000 AND NOT (o_totalprice > 250000)")
def coverage_remainder_range(spark, t):
    return orders(t, algebra.minus(Compare(PRICE, ">", 100_000), Compare(PRICE, ">", 250_000)))


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')")
def coverage_remainder_in(spark, t):
    return orders(t, algebra.minus(In("o_orderpriority", ("1-URGENT", "2-HIGH", "5-LOW")), In("o_orderpriority", ("2-HIGH", "3-MEDIUM"))))


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000 AND (o_orderstatus = 'O' AND o_totalprice > 300000) IS NOT TRUE")
def coverage_remainder_common(spark, t):
    open_ = Compare("o_orderstatus", "=", "O")
    return orders(t, algebra.minus(open_ & Compare(PRICE, ">", 100_000), open_ & Compare(PRICE, ">", 300_000)))


@query(f"SELECT event_id, user_id, v FROM (SELECT event_id, user_id, {NULLED_SQL} AS v FROM events) WHERE user_id < 60 AND (v > 20) IS NOT TRUE")
def coverage_remainder_null_safe(spark, t):
    rows = t("events").select("event_id", "user_id", nulled().alias("v"))
    return where(rows, algebra.minus(Compare("user_id", "<", 60), Compare("user_id", "<", 60) & Compare("v", ">", 20)))


@query(f"SELECT {ORDER_SQL} FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P'")
def coverage_union(spark, t):
    """A request answered from what is local and the remainder."""
    fetched = [Compare(PRICE, ">", 280_000), Compare("o_orderstatus", "=", "F")]
    q = Query(Compare(PRICE, ">", 100_000) & ~Compare("o_orderstatus", "=", "P"))
    plan = compute_missing(q, [Entry("orders", predicate_key(p), p) for p in fetched])
    return answer(orders(t, algebra.union(fetched)), orders(t), q, plan)


@query("SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*)::BIGINT AS n, CASE WHEN count(*) > 0 THEN 'present' ELSE 'absent' END AS outcome FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def coverage_plan_stats(spark, t):
    """What a fetch of open orders records: the range of its order field and its outcome."""
    rows = where(t("orders"), Compare("o_orderstatus", "=", "O"))
    batch = rows.select("o_orderpriority", F.col("o_orderkey").alias("offset"), F.lit(True).alias("is_subset_snapshot"), F.col("o_orderpriority").alias("payload"), F.lit(None).cast("string").alias("snapshot"))
    return cdc.value_range(rows, PRICE, by=("o_orderpriority",)).join(cdc.observation(batch, by=("o_orderpriority",)).drop("boundary"), "o_orderpriority")


@query("""SELECT batch_id, CASE WHEN bool_or("offset" % 4 = 0 AND batch_id % 3 <> 0 AND payload <> '') THEN 'present' ELSE 'absent' END AS outcome,
  max("offset") FILTER (WHERE "offset" % 50 = 7) AS boundary FROM (SELECT event_id AS "offset", event_id // 200 AS batch_id, CASE WHEN event_id % 11 <> 0 THEN props ELSE '' END AS payload FROM events) GROUP BY 1""")
def subset_observation(spark, t):
    """Of each batch: whether a subset row came, and the last snapshot in it."""
    at = F.col("offset")
    rows = log(t).select("batch_id", "offset", "payload", ((at % 4 == 0) & (F.col("batch_id") % 3 != 0)).alias("is_subset_snapshot"), F.when(at % 50 == 7, F.struct(at.alias("xmin"))).alias("snapshot"))
    return cdc.observation(rows, by=("batch_id",)).select("batch_id", "outcome", F.col("boundary.xmin").alias("boundary"))


# --- change log

CL = f"""(SELECT event_id AS "offset", user_id AS key, 100 + event_id // 5 AS txid,
  CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
  event_type <> 'click' AS has_v, event_type <> 'view' AS has_k, {NULLED_SQL} AS v, CAST(props->>'$.k' AS BIGINT) AS k,
  event_id // 200 AS batch_id, CASE WHEN event_id % 1777 = 1776 THEN 'must_refetch' WHEN event_id % 200 = 199 THEN 'up_to_date' END AS control,
  CASE WHEN event_id % 11 <> 0 THEN props ELSE '' END AS payload FROM events)"""


def log(t) -> DataFrame:
    return events_changelog(t("events"))


LWW = f"""SELECT key, "offset", op, v, k FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS r FROM {CL}) WHERE r = 1 AND op <> 'delete'"""


@query(LWW)
def cdc_lww(spark, t):
    return cdc.current_rows(log(t).select("key", "offset", "op", "v", "k"))


@query(f"""
WITH l AS (SELECT *, max("offset") FILTER (WHERE op = 'delete') OVER (PARTITION BY key) AS ended FROM {CL}),
a AS (SELECT *, min("offset") FILTER (WHERE op = 'insert') OVER (PARTITION BY key) AS begun FROM l WHERE ended IS NULL OR "offset" > ended),
rows AS (SELECT * FROM a WHERE "offset" >= begun),
lv AS (SELECT key, v FROM (SELECT key, v, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS r FROM rows WHERE has_v) WHERE r = 1),
lk AS (SELECT key, k FROM (SELECT key, k, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS r FROM rows WHERE has_k) WHERE r = 1)
SELECT key, v, k, "offset" FROM (SELECT key, max("offset") AS "offset" FROM rows GROUP BY key) LEFT JOIN lv USING (key) LEFT JOIN lk USING (key)
""")
def cdc_partial_merge(spark, t):
    return cdc.partial_rows(log(t), {"v": "has_v", "k": "has_k"})


MISSING = f"""SELECT DISTINCT key FROM (SELECT key, op, last_value(CASE WHEN op IN ('insert', 'delete') THEN op END IGNORE NULLS) OVER (PARTITION BY key ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS life FROM {CL}) WHERE op = 'update' AND life IS DISTINCT FROM 'insert'"""


@query(MISSING)
def cdc_missing_keys(spark, t):
    return cdc.missing_updates(log(t))


@query(f"SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM ({MISSING}) m WHERE m.key = c_custkey)")
def cdc_hydrate(spark, t):
    return cdc.hydrate(t("customer").select("c_custkey", "c_name", "c_mktsegment"), cdc.missing_updates(log(t)), "c_custkey")


SNAPSHOTS = [("s1", "120", "600", ["150", "151"]), ("s2", "300", "900", []), ("s3", "x", "700", ["400"])]
SNAPSHOT_SQL = "(VALUES ('s1', '120', '600', ['150', '151']), ('s2', '300', '900', []), ('s3', 'x', '700', ['400'])) s(snapshot_id, xmin, xmax, xip)"
VISIBLE_SQL = "CASE WHEN TRY_CAST(xmin AS BIGINT) IS NULL OR TRY_CAST(xmax AS BIGINT) IS NULL THEN FALSE WHEN txid < TRY_CAST(xmin AS BIGINT) THEN TRUE WHEN txid >= TRY_CAST(xmax AS BIGINT) THEN FALSE ELSE NOT list_contains(xip, CAST(txid AS VARCHAR)) END"


def snapshots(spark) -> DataFrame:
    return spark.createDataFrame(SNAPSHOTS, "snapshot_id string, xmin string, xmax string, xip array<string>")


def visibilities(changes: DataFrame) -> DataFrame:
    array = F.array(*(F.struct(F.lit(i).alias("snapshot_id"), F.lit(a).alias("xmin"), F.lit(b).alias("xmax"), F.array(*map(F.lit, x)).cast("array<string>").alias("xip")) for i, a, b, x in SNAPSHOTS))
    rows = changes.select("offset", "txid", F.explode(array).alias("s"))
    return rows.select("s.snapshot_id", "offset", cdc.visible(F.col("txid"), F.col("s.xmin"), F.col("s.xmax"), F.col("s.xip")).alias("visible"))


@query(f'SELECT snapshot_id, "offset", {VISIBLE_SQL} AS visible FROM {CL} l, {SNAPSHOT_SQL}')
def snapshot_visibility(spark, t):
    return visibilities(log(t))


@query(f"""
WITH l AS (SELECT "offset", key, txid FROM {CL}), s AS (SELECT * FROM {SNAPSHOT_SQL}),
retired AS (SELECT snapshot_id, min("offset") AS at FROM s LEFT JOIN l ON txid >= TRY_CAST(xmax AS BIGINT) GROUP BY 1)
SELECT "offset", key, txid FROM l WHERE NOT EXISTS (SELECT 1 FROM s JOIN retired r USING (snapshot_id)
  WHERE l.key % 3 = CAST(substr(s.snapshot_id, 2) AS INT) - 1 AND {VISIBLE_SQL} AND (r.at IS NULL OR l."offset" < r.at))
""")
def snapshot_dedupe_live(spark, t):
    live = log(t).select("offset", "key", "txid", F.array("txid").alias("txids"))
    keys = t("events").select(F.col("user_id").alias("key")).distinct()
    tracked = keys.select(F.concat(F.lit("s"), (F.col("key") % 3 + 1).cast("string")).alias("snapshot_id"), "key")
    return cdc.without_snapshot_overlap(live, snapshots(spark), tracked).drop("txids")


@query(f"""SELECT "offset", batch_id, control FROM (SELECT *, max(CASE WHEN control = 'must_refetch' THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id) AS reset FROM {CL}) WHERE reset = 0 OR control = 'must_refetch'""")
def wire_reset_projection(spark, t):
    return cdc.reset_projection(log(t).select("offset", "batch_id", "control"))


@query(f"""SELECT batch_id, count(*)::BIGINT AS messages, count(*) FILTER (WHERE op = 'insert')::BIGINT AS inserts, count(*) FILTER (WHERE op = 'update')::BIGINT AS updates,
  count(*) FILTER (WHERE op = 'delete')::BIGINT AS deletes, count(control)::BIGINT AS controls, sum(octet_length(encode(payload)))::BIGINT AS payload_bytes,
  count(*) FILTER (WHERE payload = '')::BIGINT AS empty_payloads, bool_or(coalesce(control = 'must_refetch', FALSE)) AS has_reset FROM {CL} GROUP BY 1""")
def message_stats(spark, t):
    return cdc.message_stats(log(t))


@query(f"""SELECT "offset", key, k FROM {CL} WHERE payload <> ''""")
def header_only_messages(spark, t):
    return cdc.payloads(log(t)).select("offset", "key", "k")


@query(f"""SELECT batch_id, arg_max(h, "offset") FILTER (WHERE h IS NOT NULL) AS handle, arg_max(c, "offset") FILTER (WHERE c IS NOT NULL) AS cursor FROM
  (SELECT batch_id, "offset", CASE WHEN "offset" % 9 = 0 THEN 'h' || ("offset" // 9) END AS h, CASE WHEN "offset" % 14 = 3 THEN 'c' || txid END AS c FROM {CL}) GROUP BY 1""")
def resume_identity(spark, t):
    rows = log(t).select(
        "batch_id", "offset",
        F.when(F.col("offset") % 9 == 0, F.concat(F.lit("h"), F.expr("offset div 9"))).alias("handle"),
        F.when(F.col("offset") % 14 == 3, F.concat(F.lit("c"), F.col("txid"))).alias("cursor"),
    )
    return cdc.resume_identity(rows, "batch_id")


@query(f"""SELECT batch_id, bool_or(coalesce(control IN ('up_to_date', 'snapshot_end', 'subset_end'), FALSE)) AS is_complete, bool_or(coalesce(control = 'up_to_date', FALSE)) AS is_up_to_date FROM {CL} GROUP BY 1""")
def batch_completion(spark, t):
    return cdc.completion(log(t), by=("batch_id",))


@query(f"SELECT DISTINCT key AS row_id, op, txid FROM {CL} WHERE op <> 'update'")
def optimistic_evidence(spark, t):
    return cdc.evidence(log(t).where("op <> 'update'").select("key", "op", F.array("txid").alias("txids")))


@query(f"SELECT key AS row_id, op, txid FROM (SELECT DISTINCT key, op, txid FROM {CL}) p WHERE NOT EXISTS (SELECT 1 FROM {CL} s WHERE s.\"offset\" % 2 = 0 AND s.key = p.key AND s.op = p.op AND s.txid = p.txid)")
def optimistic_retirement(spark, t):
    """Every change as a pending mutation; those of even offsets are confirmed."""
    evidence = lambda rows: cdc.evidence(rows.select("key", "op", F.array("txid").alias("txids")))
    return cdc.retire_mutations(evidence(log(t)), evidence(log(t).where("offset % 2 = 0")))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'present_value' WHEN 1 THEN 'explicit_null' ELSE 'absent' END AS k_presence, 'absent' AS z_presence FROM events""")
def field_presence(spark, t):
    body = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, '{"k":null}').otherwise('{"other":1}')
    return cdc.field_presence(t("events").select("event_id", body.alias("value")), ["k", "z"]).drop("value")


# --- row keys


@query("""SELECT p_partkey, '"pub..lic"."part"/"' || p_partkey || '"/"' || replace(replace(p_name, ' ', '/'), '/', '//') || '"/_' AS row_key FROM part""")
def row_key_encode(spark, t):
    return t("part").select("p_partkey", rowkey.encode(F.lit("pub.lic"), F.lit("part"), [F.col("p_partkey"), F.replace(F.col("p_name"), F.lit(" "), F.lit("/")), F.lit(None)]).alias("row_key"))


@query("""SELECT p_partkey, 'pub.lic' AS schema_name, 'part' AS table_name, CAST(p_partkey AS VARCHAR) AS pk0, replace(p_name, ' ', '/') AS pk1, CAST(NULL AS VARCHAR) AS pk2 FROM part""")
def row_key_parse(spark, t):
    keys = row_key_encode(spark, t).withColumn("x", rowkey.parse(F.col("row_key")))
    return keys.select("p_partkey", F.col("x.schema").alias("schema_name"), F.col("x.table").alias("table_name"), *(F.col("x.pk")[i].alias(f"pk{i}") for i in range(3)))


# --- membership

TAGS = "[o_orderstatus || '/' || o_orderpriority, 'all/' || CAST(o_orderkey % 5 AS VARCHAR)]"


def tagged(t) -> DataFrame:
    tags = F.array(F.concat_ws("/", "o_orderstatus", "o_orderpriority"), F.concat(F.lit("all/"), (F.col("o_orderkey") % 5).cast("string")))
    return t("orders").select("o_orderkey", tags.alias("tags"))


@query(f"SELECT o_orderkey, tag, (i - 1)::INT AS pos, value FROM (SELECT o_orderkey, tag, unnest(string_split(tag, '/')) AS value, generate_subscripts(string_split(tag, '/'), 1) AS i FROM (SELECT o_orderkey, unnest({TAGS}) AS tag FROM orders)) WHERE value <> ''")
def tag_index(spark, t):
    return membership.tag_index(tagged(t), "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'O' OR o_orderpriority = '1-URGENT') AND o_orderkey % 5 IN (1, 2)")
def moveout_simple(spark, t):
    patterns = spark.createDataFrame([(0, "O"), (1, "1-URGENT"), (1, "1"), (1, "2")], "pos int, value string")
    return membership.moved_out(tagged(t), patterns, "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 OR o_orderpriority = '1-URGENT'")
def moveout_legacy_wildcard(spark, t):
    tag = F.concat_ws("/", "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "_").otherwise(F.col("o_orderpriority")))
    rows = t("orders").select("o_orderkey", F.array(tag).alias("tags"))
    return membership.moved_out(rows, spark.createDataFrame([(1, "1-URGENT")], "pos int, value string"), "o_orderkey", legacy=True)


@query(f"""SELECT key, tag FROM (
  SELECT key, tag, arg_max(adds, ("offset", adds)) AS adds, max("offset") AS last_at FROM (
    SELECT key, "offset", 'a/' || (txid % 4) AS tag, 1 AS adds FROM {CL} WHERE op <> 'delete'
    UNION ALL SELECT key, "offset", 'a/' || (k % 4) AS tag, 0 FROM {CL} WHERE op = 'update' AND k % 4 <> txid % 4) GROUP BY 1, 2) f
  WHERE adds = 1 AND last_at > coalesce((SELECT max("offset") FROM {CL} d WHERE d.key = f.key AND d.op = 'delete'), -1)""")
def tag_fold(spark, t):
    changes = log(t).select(
        "key", "offset", "op", F.array(F.concat(F.lit("a/"), F.col("txid") % 4)).alias("tags"),
        F.when((F.col("op") == "update") & (F.col("k") % 4 != F.col("txid") % 4), F.array(F.concat(F.lit("a/"), F.col("k") % 4))).otherwise(F.array().cast("array<string>")).alias("removed_tags"),
    )
    return membership.tag_fold(changes)


@query("SELECT o_orderkey, (o_orderkey % 2 = 0 AND o_orderkey % 3 = 0) OR o_orderkey % 5 = 0 AS visible FROM orders")
def dnf_visible(spark, t):
    active = F.array(*(F.col("o_orderkey") % n == 0 for n in (2, 3, 5)))
    shape = F.array(F.array(F.lit(0), F.lit(1)), F.array(F.lit(2)), F.array(F.lit(2), F.lit(7)))
    return t("orders").select("o_orderkey", membership.row_visible(active, shape).alias("visible"))


@query("""
WITH r AS (SELECT o_orderkey, o_orderstatus = 'O' AS s, o_orderpriority = '1-URGENT' AS u, o_orderpriority = '2-HIGH' AS h FROM orders)
SELECT o_orderkey, CASE WHEN s AND u THEN 2 WHEN FALSE THEN 0 END::BIGINT AS evicted_at, CASE WHEN s AND u THEN FALSE WHEN s THEN TRUE ELSE TRUE END AS a0, NOT (u OR h) AS a1 FROM r
""")
def dnf_moves_timeline(spark, t):
    rows = t("orders").select("o_orderkey", F.array(F.concat(F.col("o_orderstatus"), F.lit("/")), F.concat(F.lit("/"), F.col("o_orderpriority"))).alias("tags"), F.array(F.lit(True), F.lit(True)).alias("active"))
    events = spark.createDataFrame([(1, "move_out", 0, "O"), (2, "move_out", 1, "1-URGENT"), (3, "move_in", 0, "O"), (4, "move_out", 1, "2-HIGH")], "seq long, kind string, pos int, value string")
    out = membership.dnf_fold(rows, events, "o_orderkey", membership.disjuncts(["x/", "/y"]))
    return out.select("o_orderkey", "evicted_at", F.col("active")[0].alias("a0"), F.col("active")[1].alias("a1"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS row_key FROM orders WHERE o_totalprice > 150000 AND o_orderstatus <> 'O'")
def ownership_orphans(spark, t):
    o = t("orders")
    owned = lambda p, shape: where(o, p).select(F.col("o_orderkey").cast("string").alias("row_key"), F.lit(shape).alias("shape_id"))
    dear = owned(Compare(PRICE, ">", 150_000), "dear")
    return membership.orphans(dear.unionByName(owned(Compare("o_orderstatus", "=", "O"), "open")), dear)


@query("""SELECT o_orderkey AS row_key, CASE WHEN NOT b THEN 'claimed' WHEN NOT a THEN 'released' ELSE 'retagged' END AS change FROM
  (SELECT o_orderkey, o_totalprice > 150000 AS b, o_orderstatus = 'O' AS a FROM orders) WHERE (a OR b) AND NOT (a AND b AND o_orderkey % 2 = 0)""")
def ownership_delta(spark, t):
    o = t("orders").withColumnRenamed("o_orderkey", "row_key")
    old = where(o, Compare(PRICE, ">", 150_000)).select("row_key", F.array(F.lit("x"), F.lit("y")).alias("tags"))
    new = where(o, Compare("o_orderstatus", "=", "O")).select("row_key", F.when(F.col("row_key") % 2 == 0, F.array(F.lit("y"), F.lit("x"))).otherwise(F.array(F.lit("z"))).alias("tags"))
    return membership.ownership_delta(old, new)


@query("SELECT event_id, user_id, event_id AS version FROM events e WHERE event_id > coalesce((SELECT max(d.event_id) FROM events d WHERE d.user_id = e.user_id AND d.event_type = 'error'), -1)")
def tombstone_fence(spark, t):
    rows = t("events").select("event_id", "user_id", F.col("event_id").alias("version"))
    stones = t("events").where("event_type = 'error'").select("user_id", F.col("event_id").alias("version"))
    return membership.fenced(rows, stones, "user_id")


@query("SELECT event_id AS row_id, ts AS deleted_at FROM events WHERE event_type = 'error' AND ts < (SELECT max(ts) FROM events) - INTERVAL 86400 SECONDS ORDER BY ts, event_id LIMIT 200")
def tombstone_gc(spark, t):
    stones = t("events").where("event_type = 'error'").select(F.col("event_id").alias("row_id"), F.col("ts").alias("deleted_at"))
    now = t("events").agg(F.max("ts")).scalar()
    return membership.expired(stones, now, 86_400)


@query("SELECT CAST(o_custkey AS VARCHAR) AS cursor_key, count(DISTINCT o_orderpriority)::BIGINT AS owners FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def owner_collisions(spark, t):
    owners = t("orders").select(F.col("o_custkey").cast("string").alias("cursor_key"), F.col("o_orderpriority").alias("client_id"))
    return membership.owner_collisions(owners)


# --- streams


@query("SELECT event_id, event_id AS n, props || chr(10) || 'x' AS data FROM events")
def sse_events(spark, t):
    wire = F.concat(F.lit(": hi\n\nid: 1\ndata: "), F.col("props"), F.lit("\r\ndata:x\n\n\nevent: e\n\ndata\n\ndata: not ended"))
    rows = t("events").select("event_id", F.explode(event_data(wire)).alias("data"))
    return rows.select("event_id", F.col("event_id").alias("n"), "data")


@query("""
WITH a AS (SELECT user_id, event_id, event_id / 40.0 AS secs, event_type AS reason, event_type IN ('error', 'click') AS failed FROM events),
g AS (SELECT *, count(*) FILTER (WHERE NOT failed) OVER (PARTITION BY user_id ORDER BY event_id) AS since FROM a),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, since ORDER BY event_id) AS failures,
  coalesce(lag(reason) OVER w = reason AND secs - lag(secs) OVER w <= 5, FALSE) AS again FROM g WHERE failed WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS repeats FROM r)
SELECT user_id, event_id, failures::INT AS failures, repeats::INT AS repeats, CASE WHEN repeats >= 5 THEN 30.0 ELSE least(30.0, 0.5 * pow(2.0, failures - 1)) END::DOUBLE AS delay, repeats >= 5 OR failures >= 3 AS opens FROM n
""")
def backoff_schedule(spark, t):
    """Errors and clicks as failures of each user's reads: how long each is held off, and which open the breaker."""
    from tidelog.streaming.breaker import schedule

    return schedule(t("events"), "user_id", "event_id", F.col("event_id") / 40.0, F.col("event_type").isin("error", "click"), F.col("event_type"))


@query("SELECT reason, count(*)::BIGINT AS messages FROM (SELECT CASE WHEN event_id % 97 = 0 THEN 'schema' WHEN event_id % 89 = 0 THEN 'control' WHEN event_id % 83 = 0 THEN 'tag' WHEN event_id % 79 = 0 THEN 'active_conditions' END AS reason FROM events) WHERE reason IS NOT NULL GROUP BY 1")
def quarantine_report(spark, t):
    from tidelog.streaming.quarantine import report

    e = F.col("event_id")
    rows = t("events").select(
        F.when(e % 97 == 0, "").otherwise("public").alias("schema"), F.lit("1").alias("version"), F.when(e % 89 == 0, "strange").alias("control"), F.lit(None).cast("string").alias("event"),
        F.array(F.when(e % 83 == 0, "a/b/c").otherwise("a/b")).alias("tags"), F.when(e % 79 == 0, F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False))).alias("active_conditions"),
    )
    return report(rows, segments=2)


@query(LWW)
def stream_cdc_equals_batch(spark, t):
    """The change log through Structured Streaming into a generation table: the same rows as the batch query."""
    from tidelog.streaming.pipeline import replay

    return replay(spark, log(t).select("key", "offset", "op", "v", "k"))


@query(f"""SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, op, count(*)::BIGINT AS n FROM {CL.replace('FROM events)', ', ts FROM events)')} GROUP BY ALL""")
def changes_by_day(spark, t):
    rows = t("events").select(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update").alias("op"))
    return rows.groupBy("w", "op").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("day"), "op", "n")



PARTIAL = ORACLES["cdc_partial_merge"]


@query(PARTIAL)
def stream_partial_equals_batch(spark, t):
    """Partial updates through the stream, part by part over what is stored: the same rows as the fold over the whole log."""
    from tidelog.streaming.pipeline import replay_in_order

    rows = log(t).select("key", "offset", "op", "has_v", "has_k", "v", "k", sixth(t).alias("part"))
    return replay_in_order(spark, rows, "part", 6, fields={"v": "has_v", "k": "has_k"}, at_boundaries=False)


def sixth(t):
    """The sixth of the log that an offset lies in."""
    low, high = t("events").agg(F.min("event_id"), F.max("event_id")).first()
    return F.floor((F.col("offset") - low) * 6 / (high - low + 1)).cast("int")


SIXTHS = """(SELECT l.*, (("offset" - (SELECT min(event_id) FROM events)) * 6 // (SELECT max(event_id) - min(event_id) + 1 FROM events))::INT AS part FROM """ + CL + """ l)"""


@query(f"""WITH f AS (SELECT * FROM {SIXTHS}), a AS (SELECT * FROM f WHERE part > 2), e AS (SELECT max("offset") AS shown FROM a WHERE "offset" % 200 = 199 AND part < 5),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS r FROM a, e WHERE "offset" <= shown AND "offset" % 200 <> 199)
SELECT key, "offset", op, v, k FROM n WHERE r = 1 AND op <> 'delete'""")
def stream_reset_swap(spark, t):
    """A reset in the third sixth of the log replaces all rows, at the first boundary after it; the last sixth has no boundary and waits."""
    from tidelog.streaming.pipeline import replay_in_order

    part, at = sixth(t), F.col("offset")
    rows = log(t).withColumn("part", part)
    control = F.when((at % 200 == 199) & (F.col("part") < 5), "up_to_date").when((at % 200 == 199) & (F.col("part") == 5), "note").when((F.col("part") == 2) & (at % 50 == 7), "must_refetch")
    return replay_in_order(spark, rows.select("key", "offset", "op", "v", "k", control.alias("control"), "part"), "part", 6)


# --- metadata


def metadata(spark):
    from tidelog.streaming.metadata import Metadata
    from tidelog.streaming.pipeline import new_folder

    return Metadata(spark, new_folder(spark, "metadata"))


@query(f"""SELECT batch_id::VARCHAR AS collection, max("offset")::VARCHAR AS "offset", arg_max('h' || ("offset" // 9), "offset") AS handle, arg_max('c' || txid, "offset") AS cursor, arg_max(coalesce(control = 'up_to_date', FALSE), "offset") AS is_up_to_date
  FROM {CL} GROUP BY batch_id HAVING batch_id % 5 <> 0""")
def sync_state_upsert(spark, t):
    """The resume state of every batch of the log, written twice and read back; of every fifth it is reset."""
    m = metadata(spark)
    rows = log(t).select(F.col("batch_id").cast("string").alias("collection"), "offset", F.concat(F.lit("h"), F.expr("offset div 9")).alias("handle"), F.concat(F.lit("c"), F.col("txid")).alias("cursor"), F.coalesce(F.col("control") == "up_to_date", F.lit(False)).alias("is_up_to_date"))
    m.update_sync_states(rows.where("offset % 3 = 0"))
    m.update_sync_states(rows)
    m._change(lambda f: [f["states"].pop(x) for x in list(f["states"]) if int(x) % 5 == 0])
    return m.sync_states()


@query("""SELECT o_orderpriority AS priority, max(o_totalprice) > 300000 AS fetched, max(o_totalprice) > 300000 AND o_orderpriority <> '5-LOW' AS after_clear FROM orders GROUP BY 1""")
def coverage_lookup(spark, t):
    """Whether each priority was fetched (those with an order over 300000 were), before and after the coverage of one base is cleared."""
    m = metadata(spark)
    dear = {r[0] for r in where(t("orders"), Compare(PRICE, ">", 300_000)).select("o_orderpriority").distinct().collect()}  # five values
    every = sorted(r[0] for r in t("orders").select("o_orderpriority").distinct().collect())
    p = lambda x: Compare("o_orderpriority", "=", x)
    for x in every:
        m.record_fetch("orders", p(x), complete=x in dear, base="low" if x == "5-LOW" else "all")
    before = {x: m.has_fetched("orders", predicate_key(p(x))) for x in every}
    m.clear("orders", "low")
    return spark.createDataFrame([(x, before[x], m.has_fetched("orders", predicate_key(p(x)))) for x in every], "priority string, fetched boolean, after_clear boolean")


def owners(t) -> DataFrame:
    """Orders as rows that up to three shapes own: dear ones, open ones and urgent ones."""
    o = t("orders")
    own = lambda p, shape: where(o, p).select(F.lit("orders").alias("table"), F.col("o_orderkey").cast("string").alias("row_key"), F.lit(shape).alias("shape_id"), F.array(F.lit(shape)).alias("tags"))
    return own(Compare(PRICE, ">", 150_000), "dear").unionByName(own(Compare("o_orderstatus", "=", "O"), "open")).unionByName(own(Compare("o_orderpriority", "=", "1-URGENT"), "urgent"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS row_key FROM orders WHERE o_totalprice > 150000 AND o_orderstatus <> 'O' AND o_orderpriority <> '1-URGENT'")
def ownership_release_all(spark, t):
    m = metadata(spark)
    m.claim(owners(t), 0)
    return m.release_all("orders", "dear")


@query("""SELECT shape_id, count(*)::BIGINT AS n FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 150000 THEN 'dear' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END], lambda x: x IS NOT NULL)) AS shape_id
  FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY 1""")
def ownership_remove_all(spark, t):
    """Every third order is deleted, for all its owners."""
    m = metadata(spark)
    m.claim(owners(t), 0)
    m.remove_rows("orders", t("orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("row_key")))
    return m.owned().groupBy("shape_id").agg(F.count("*").alias("n"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS row_key, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'new' ELSE 'dear' END AS tag FROM orders
  WHERE o_totalprice > 150000 AND (o_orderstatus = 'O' OR o_orderpriority = '1-URGENT') OR o_orderstatus = 'O' AND o_orderkey % 2 = 0""")
def ownership_update(spark, t):
    """A shape's ownership brought to another set of rows: some are claimed, some retagged, some released."""
    m = metadata(spark)
    m.claim(owners(t), 0)
    fresh = where(t("orders"), (Compare(PRICE, ">", 150_000) & (Compare("o_orderstatus", "=", "O") | Compare("o_orderpriority", "=", "1-URGENT"))) | Compare("o_orderstatus", "=", "O"))
    tag = F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0), "new").otherwise("dear")
    fresh = fresh.where((F.col(PRICE) > 150_000) | (F.col("o_orderkey") % 2 == 0)).select(F.col("o_orderkey").cast("string").alias("row_key"), F.array(tag).alias("tags"))
    m.update_ownership("orders", "dear", fresh)
    return m.ownership_tags("orders", "dear").select("row_key", F.col("tags")[0].alias("tag"))


# --- the general fold of membership


def folded(t, spark, legacy):
    """Orders tagged status/priority in two steps, with one move-out between them and one after, and a delete of every seventh."""
    o = t("orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    empty = F.array().cast("array<string>")
    step = lambda df, seq, op, tags, removed: df.select(F.lit(seq).cast("long").alias("seq"), "key", F.lit(op).alias("op"), tags.alias("tags"), removed.alias("removed_tags"), F.array().cast("array<boolean>").alias("active_conditions"))
    one = F.concat_ws("/", "s", F.when(F.col("key") % 4 == 0, "_").otherwise(F.col("p")))
    two = F.concat_ws("/", F.lit("x"), (F.col("key") % 10).cast("string"))
    rows = step(o, 1, "insert", F.array(one, F.lit("a/b/c")), empty).unionByName(step(o.where("key % 2 = 0"), 3, "update", F.array(two), F.when(F.col("key") % 6 == 0, F.array(one)).otherwise(empty))).unionByName(step(o.where("key % 7 = 0"), 4, "delete", empty, empty))
    events = spark.createDataFrame([(2, "move_out", 1, "1-URGENT"), (5, "move_out", 1, "4")], "seq long, kind string, pos int, value string")
    state = spark.createDataFrame([], f"key bigint, {membership.STATE}")
    out = membership.fold(state, rows, events, "key", [[0, 1]], legacy, 2)
    return out.select("key", F.array_join(F.array_sort("tags"), ",").alias("tags"), "evicted_at")


def folded_sql(legacy):
    wild = "OR one_end = '_'" if legacy else ""
    late = "OR one_end = '_'" if legacy else ""
    return f"""
WITH o AS (SELECT o_orderkey AS key, o_orderstatus || '/' || CASE WHEN o_orderkey % 4 = 0 THEN '_' ELSE o_orderpriority END AS one, CASE WHEN o_orderkey % 4 = 0 THEN '_' ELSE o_orderpriority END AS one_end, 'x/' || (o_orderkey % 10) AS two FROM orders),
a AS (SELECT *, NOT (one_end = '1-URGENT' {wild}) AS has1 FROM o),
b AS (SELECT *, has1 AND NOT (key % 6 = 0) AS has1b, key % 2 = 0 AS has2 FROM a),
c AS (SELECT *, has1b AND NOT (one_end = '4' {late}) AS has1c, has2 AND key % 10 <> 4 AS has2c FROM b)
SELECT key, CASE WHEN key % 7 = 0 THEN '' ELSE array_to_string(list_sort(list_filter([CASE WHEN has1c THEN one END, CASE WHEN has2c THEN two END], lambda x: x IS NOT NULL)), ',') END AS tags,
  (CASE WHEN key % 7 = 0 THEN NULL WHEN NOT has1 AND NOT has2 THEN 2 WHEN (has1b OR has2) AND NOT has1c AND NOT has2c THEN 5 END)::BIGINT AS evicted_at FROM c"""


@query(folded_sql(False))
def membership_fold(spark, t):
    return folded(t, spark, False)


@query(folded_sql(True))
def membership_fold_legacy(spark, t):
    return folded(t, spark, True)
