"""Queries of the ordered operators: fills, runs, context, numbering, sampling, budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered as o
from ..operators.survivorship import keep_first
from .registry import query
from .tables import read


@query("SELECT c_custkey AS id, c_mktsegment || CASE WHEN n > 1 THEN '(' || n || ')' ELSE '' END AS label FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer)")
def duplicate_label_numbering(spark, d):
    """Labels told apart by numbers from their second row on."""
    w = o.over(["c_nationkey", "c_mktsegment"], ["c_custkey"])
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id"), o.numbered_label(F.col("c_mktsegment"), w).alias("label"))


_LINES = """lines AS (SELECT doc_id, CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS INTEGER) - 1 AS ln, unnest(string_split(text, chr(10))) AS line FROM documents)"""


def _lines(spark, d):
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))


@query(f"WITH {_LINES}, m AS (SELECT *, max(CASE WHEN line LIKE '%icense%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS k FROM lines) SELECT doc_id, ln, md5(line) AS digest FROM m WHERE k = 1")
def context_lines_pm2(spark, d):
    """Lines within two of one that matches."""
    w = o.over(["doc_id"], ["ln"])
    out = _lines(spark, d).withColumn("k", o.context(F.col("line").contains("icense").cast("int"), w))
    return out.where("k = 1").select("doc_id", "ln", F.md5("line").alias("digest"))


@query(f"WITH {_LINES}, m AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY ln) AS p FROM lines) SELECT doc_id, count(*) AS kept, count(*) FILTER (WHERE length(line) > 200) AS long FROM m WHERE p IS NULL OR p <> line GROUP BY doc_id")
def adjacent_dup_lines(spark, d):
    """Lines left when repeats of the line before go."""
    out = _lines(spark, d).withColumn("again", o.repeats_previous(F.col("line"), o.over(["doc_id"], ["ln"])))
    return out.where(~F.col("again")).groupBy("doc_id").agg(F.count("*").alias("kept"), F.count_if(F.length("line") > 200).alias("long"))


@query(
    """WITH t AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN turn END AS h, CASE WHEN turn % 3 = 2 THEN length(text) END AS v FROM conversations)
SELECT conv_id, turn, role, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header, first_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_value FROM t"""
)
def section_fill(spark, d):
    """The header above each row and the next value below it."""
    w = o.over(["conv_id"], ["turn", "role"])
    c = read(spark, d, "conversations")
    header, value = F.when(F.col("role") == "user", F.col("turn")), F.when(F.col("turn") % 3 == 2, F.length("text").cast("bigint"))
    return c.select("conv_id", "turn", "role", o.forward_fill(header, w).alias("header"), o.back_fill(value, w).alias("next_value"))


@query(
    """WITH x AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
z AS (SELECT user_id, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS run, event_type, event_id FROM (SELECT x.*, ts FROM x JOIN (SELECT event_id, ts FROM events) e USING (event_id)))
SELECT user_id, run, event_type AS kind, count(*) AS n FROM z GROUP BY ALL"""
)
def runs_gaps_islands(spark, d):
    """Runs of equal events of each user."""
    out = read(spark, d, "events").withColumn("run", o.islands(F.col("event_type"), o.over(["user_id"], ["ts", "event_id"])))
    return out.groupBy("user_id", "run", F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT DISTINCT o_custkey AS cust, o_orderkey % 40 + 1 AS k FROM orders), m AS (SELECT cust, unnest(generate_series(1, max(k))) AS k FROM n GROUP BY cust) SELECT cust, k FROM m EXCEPT SELECT cust, k FROM n""")
def missing_sequence(spark, d):
    """Numbers that a list lacks up to its last."""
    n = read(spark, d, "orders").select(F.col("o_custkey").alias("cust"), (F.col("o_orderkey") % 40 + 1).alias("k"))
    return o.missing_numbers(n, ["cust"], "k")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents) WHERE k % 7 = 0 ORDER BY k // 7, source LIMIT 60")
def stratified_round_robin(spark, d):
    """A sample that takes sources in turn (the sample size is the feature)."""
    return o.round_robin(read(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"], 60, 7)


@query("SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 3")
def top_n_per_group(spark, d):
    """The three longest documents of each source; the window group limit prunes before the shuffle."""
    return o.top_n(read(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source"], [F.desc("n_chars"), "doc_id"], 3)


@query(
    """WITH r AS (SELECT doc_id, source, n_chars, 32000 - coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM documents) SELECT doc_id, source, CAST(least(n_chars, room) AS BIGINT) AS taken FROM r WHERE room > 0"""
)
def greedy_budget_fill(spark, d):
    """Documents of each source that fit in its budget, in order."""
    return o.budget(read(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source"], ["doc_id"], "n_chars", 32000).select("doc_id", "source", "taken")


@query("SELECT user_id, event_id, coalesce(string_agg(p, ',' ORDER BY k), '') AS before FROM (SELECT a.user_id, a.event_id, b.p, b.k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) a LEFT JOIN (SELECT user_id, event_type AS p, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) b ON a.user_id = b.user_id AND b.k BETWEEN a.n - 3 AND a.n - 1) GROUP BY ALL")
def trailing_context(spark, d):
    """The three events before each."""
    w = o.over(["user_id"], ["ts", "event_id"])
    return read(spark, d, "events").select("user_id", "event_id", F.array_join(o.trailing(F.col("event_type"), w, 3), ",").alias("before"))


@query("SELECT l_orderkey AS ord, l_partkey AS part, l_linenumber AS line FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1")
def first_per_key(spark, d):
    """The first row of each key."""
    out = keep_first(read(spark, d, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"], ["l_linenumber", "l_partkey"])
    return out.select(F.col("l_orderkey").alias("ord"), F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"))


@query("SELECT user_id, event_id, event_type = 'click' AND lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = 'purchase' AS pair FROM events")
def adjacent_pairs(spark, d):
    """Events that are followed by the one that completes them."""
    following = F.lead("event_type").over(o.over(["user_id"], ["ts", "event_id"]))
    return read(spark, d, "events").select("user_id", "event_id", ((F.col("event_type") == "click") & (following == "purchase")).alias("pair"))
