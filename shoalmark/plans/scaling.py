"""Queries of the operators that keep crowded groups, far neighbours and large dictionaries out of single tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import constrained, cover, gazetteer, grams, resolve, scan, spatial
from ..sources import files, publish
from .registry import query
from .tables import SQL_LAT, SQL_LON, lat_of, lon_of, read

c = F.col

_LEVELS = 7


def _sql_levels() -> str:
    """The clusters after each level: one pair of neighbouring blocks of each customer meets at a time, so a level is one step."""
    out = ["l0 AS (SELECT k, cust, n, src, nm, k AS cl FROM o)"]
    for i in range(1, _LEVELS + 1):
        out.append(
            f"s{i} AS (SELECT cl, list(DISTINCT src) AS srcs, list(DISTINCT nm) AS nms FROM l{i - 1} GROUP BY cl), "
            f"e{i} AS (SELECT a.cl AS x, b.cl AS y, (a.k + b.k) % 2 AS strong FROM l{i - 1} a JOIN l{i - 1} b ON a.cust = b.cust AND a.n % {2**i} = 0 AND b.n = a.n + {2 ** (i - 1)}), "
            f"m{i} AS (SELECT e.x, e.y FROM e{i} e JOIN s{i} p ON p.cl = e.x JOIN s{i} q ON q.cl = e.y WHERE NOT list_has_any(p.srcs, q.srcs) OR strong = 1 AND list_has_any(p.nms, q.nms)), "
            f"l{i} AS (SELECT k, cust, n, src, nm, CASE WHEN mx.x IS NOT NULL THEN least(mx.x, mx.y) WHEN my.x IS NOT NULL THEN least(my.x, my.y) ELSE cl END AS cl FROM l{i - 1} LEFT JOIN m{i} mx ON mx.x = cl LEFT JOIN m{i} my ON my.y = cl)"
        )
    return ", ".join(out)


@query(f"WITH o AS (SELECT o_orderkey AS k, o_custkey AS cust, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n, o_orderpriority AS src, o_orderstatus AS nm FROM orders), {_sql_levels()} SELECT k AS idx, cl AS cluster FROM l{_LEVELS}")
def clusters_in_rounds(spark, d):
    """Orders of a customer in clusters with one order of each priority, unless a strong pair shares its status; neighbours
    first, then pairs, and so on.  All of it merges in rounds."""
    o = read(spark, d, "orders").select(c("o_orderkey").alias("node"), c("o_custkey").alias("cust"), c("o_orderpriority").alias("src"), c("o_orderstatus").alias("nkey"))
    numbered = scan.carried(o, ["cust"], ["node"], {"n": scan.total(F.lit(1))}).withColumn("n", c("n") - 1)
    a, b = numbered.select(c("node").alias("a"), "cust", "n"), numbered.select(c("node").alias("b"), "cust", c("n").alias("m"))
    level = F.explode(F.sequence(F.lit(1), F.lit(_LEVELS)))
    ends = a.withColumn("rule", level).withColumn("half", F.pow(F.lit(2.0), c("rule") - 1).cast("long"))
    met = ends.where("n % (2 * half) = 0").withColumn("m", c("n") + c("half")).join(b, ["cust", "m"])
    edges = met.select("rule", c("cust").alias("key_first"), "a", "b", ((c("a") + c("b")) % 2).cast("int").alias("strength"))
    return constrained.merged_in_rounds(numbered.select("node", "src", "nkey"), edges).select(c("node").alias("idx"), "cluster")


def contacts(spark, d):
    """Customers as records of one list: a name, and a city and a site where they are known."""
    k = c("c_custkey")
    of = lambda seed, n: F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(n))
    return read(spark, d, "customer").select(k.alias("id"), of(1, 900).alias("name"), F.when(k % 3 != 0, of(2, 4)).alias("city"), F.when(k % 2 == 0, of(3, 150)).alias("site"))


def agree(first, second):
    """Edges (a, b) of records that agree: of one name whose cities don't differ, or of one site in one known city.

    Where all records of both tables with one key agree, those of each table have an edge to the first one of the other: they are
    connected as by all their pairs.
    """

    def stars(x, y, *keys):
        known = lambda t: t.dropna(subset=list(keys)).select("id", *keys)
        least = lambda t, n: known(t).groupBy(*keys).agg(F.min("id").alias(n))
        return known(x).withColumnRenamed("id", "a").join(least(y, "b"), list(keys)).select("a", "b").unionByName(known(y).withColumnRenamed("id", "b").join(least(x, "a"), list(keys)).select("a", "b"))

    anywhere = lambda t: t.where("city IS NULL")
    named = stars(first, second, "name", "city").unionByName(stars(anywhere(first), second, "name")).unionByName(stars(first, anywhere(second), "name"))
    return named.unionByName(stars(first, second, "site", "city"))


def first_known(grouped):
    """One record for each root: of each field the first that is known."""
    first = lambda x: F.min_by(x, F.when(c(x).isNotNull(), c("id"))).alias(x)
    return grouped.groupBy("root").agg(first("name"), first("city"), first("site")).withColumnRenamed("root", "id")


@query()
def contacts_until_settled(spark, d):
    """Records of one list merged while any two agree; a merge fills in the city or site by which others agree (rounds that SQL
    can't tell; a test has them in plain Python)."""
    return resolve.agglomerated(contacts(spark, d), agree, first_known).select("id", "name", "city", "site")


_PORTS = f"s AS (SELECT s_suppkey AS sid, {SQL_LAT.format('s_suppkey')} AS la2, {SQL_LON.format('s_suppkey')} AS lo2 FROM supplier WHERE s_suppkey % 5 = 0)"
_AWAY = "10 + (c_custkey * 53 % 5500) / 100.0::DOUBLE AS la, 100 + (c_custkey * 29 % 7000) / 100.0::DOUBLE AS lo"


@query(f"WITH {_PORTS}, p AS (SELECT c_custkey AS pid, {_AWAY} FROM customer), m AS (SELECT pid, sid, sqrt(power((lo2 - lo) * cos(radians(la)) * 111.320, 2) + power((la2 - la) * 110.574, 2)) AS km FROM p, s) SELECT pid, min(round(km, 4)) AS km FROM m GROUP BY pid")
def nearest_port_any_distance(spark, d):
    """The distance of each place to the nearest port, however far."""
    k, s = c("c_custkey"), c("s_suppkey")
    places = read(spark, d, "customer").select(k.alias("pid"), (F.lit(10) + (k * 53 % 5500) / F.lit(100.0)).alias("la"), (F.lit(100) + (k * 29 % 7000) / F.lit(100.0)).alias("lo"))
    ports = read(spark, d, "supplier").where(s % 5 == 0).select(s.alias("sid"), lat_of(s).alias("la1"), lon_of(s).alias("lo1"), lat_of(s).alias("la2"), lon_of(s).alias("lo2"))
    return spatial.nearest_by_rings(places, ports, size=1.0, few=20).select("pid", F.round("km", 4).alias("km"))


@query(
    f"""WITH RECURSIVE p AS (SELECT c_custkey AS id, c_nationkey AS key, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS n, {SQL_LAT.format('c_custkey')} AS la, {SQL_LON.format('c_custkey')} AS lo FROM customer),
w AS (SELECT key, 0::BIGINT AS n, []::STRUCT(id BIGINT, la DOUBLE, lo DOUBLE)[] AS kept FROM (SELECT DISTINCT key FROM p)
 UNION ALL SELECT w.key, p.n, CASE WHEN len(list_filter(kept, lambda x: sqrt(power(radians(p.lo - x.lo) * cos(radians((x.la + p.la) / 2)), 2) + power(radians(p.la - x.la), 2)) * 6371.0 < 150)) > 0 THEN kept
  ELSE list_append(kept, {{'id': p.id, 'la': p.la, 'lo': p.lo}}) END FROM w JOIN p ON p.key = w.key AND p.n = w.n + 1)
SELECT key, unnest(kept).id AS id FROM (SELECT key, arg_max(kept, n) AS kept FROM w GROUP BY key)"""
)
def places_thinned(spark, d):
    """Places of each area, taken by their balance, that aren't within 150 km of one taken before."""
    k = c("c_custkey")
    p = read(spark, d, "customer").select(k.alias("id"), c("c_nationkey").alias("key"), F.struct("c_acctbal", "c_custkey").alias("order"), lat_of(k).alias("la"), lon_of(k).alias("lo"))
    return gazetteer.thinned(p, "key", "order", km=150).select("key", c("order.c_custkey").alias("id"))


_ZOOMS = (6, 5, 4)


def _sql_zooms() -> str:
    """Each zoom as one pass over the clusters of the finer one, in the order of their ids' MD5."""
    y = f"0.5 - 0.25 * ln((1 + sin(radians({SQL_LAT.format('c_custkey')}))) / (1 - sin(radians({SQL_LAT.format('c_custkey')})))) / pi()"
    out = [f"z{_ZOOMS[0] + 1} AS (SELECT c_custkey AS id, {y} AS y, ({SQL_LON.format('c_custkey')}) / 360.0 + 0.5 AS x, 1::BIGINT AS n FROM customer)"]
    for z in _ZOOMS:
        r2 = (44.0 / (512.0 * 2**z)) ** 2
        out.append(
            f"o{z} AS (SELECT *, row_number() OVER (ORDER BY md5(id::VARCHAR)) AS k FROM z{z + 1}), w{z} AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS id, NULL::BIGINT AS centre, []::STRUCT(id BIGINT, y DOUBLE, x DOUBLE)[] AS cs "
            f"UNION ALL SELECT o.k, o.id, coalesce(hit, o.id), CASE WHEN hit IS NULL THEN list_append(cs, {{'id': o.id, 'y': o.y, 'x': o.x}}) ELSE cs END FROM (SELECT o.*, w.cs, list_filter(w.cs, lambda t: power(t.y - o.y, 2) + power(t.x - o.x, 2) <= {r2!r})[1].id AS hit FROM w{z} w JOIN o{z} o ON o.k = w.k + 1) o), "
            f"t{z} AS (SELECT o.*, w.centre FROM o{z} o JOIN w{z} w USING (k)), z{z} AS (SELECT centre AS id, sum(y * n) / sum(n) AS y, sum(x * n) / sum(n) AS x, sum(n)::BIGINT AS n FROM t{z} GROUP BY centre)"
        )
    levels = [f"SELECT {z + 1} AS zoom, id AS cluster, centre AS parent, n, y, x FROM t{z}" for z in _ZOOMS] + [f"SELECT {_ZOOMS[-1]} AS zoom, id, NULL, n, y, x FROM z{_ZOOMS[-1]}"]
    return f"WITH RECURSIVE {', '.join(out)} SELECT zoom::INTEGER AS zoom, cluster, parent, n, round(y, 6) AS y, round(x, 6) AS x FROM ({' UNION ALL '.join(levels)})"


@query(_sql_zooms())
def radius_clusters(spark, d):
    """Clusters of places on the map within 44 pixels, each zoom from the finer one, with weighted centres."""
    k = c("c_custkey")
    y, x = cover.projected(lat_of(k), lon_of(k))
    p = read(spark, d, "customer").select(k.alias("id"), y.alias("y"), x.alias("x"))
    out = cover.zoom_clusters(p, 44.0, _ZOOMS[0], _ZOOMS[-1])
    return out.select("zoom", "cluster", "parent", "n", F.round("y", 6).alias("y"), F.round("x", 6).alias("x"))


@query("SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders o WHERE o.o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity >= 50 AND l_orderkey % 10000 BETWEEN 1200 AND 1500)")
def orders_looked_up(spark, d):
    """Orders by the ids that another table asks for, from a layout by ranges of ids whose folders the ids prune."""
    root = files.scratch(spark) + "/orders"
    publish.write_by_ranges(read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), root, "o_orderkey", 1000)
    asked = read(spark, d, "lineitem").where("l_quantity >= 50 AND l_orderkey % 10000 BETWEEN 1200 AND 1500").select(c("l_orderkey").alias("o_orderkey"))
    return publish.looked_up(asked, root, "o_orderkey", 1000)


@query(
    """SELECT l_orderkey, l_linenumber, l_returnflag, last_value(CASE WHEN l_linenumber = 1 THEN l_shipdate END IGNORE NULLS) OVER w AS opened, first_value(CASE WHEN l_quantity >= 49 THEN l_partkey END IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_large,
CAST(count(*) FILTER (l_linenumber = 1) OVER w AS BIGINT) AS section, lag(l_suppkey) OVER w AS supplier_before FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate)"""
)
def crowded_carries(spark, d):
    """Fills, sections and the row before in three groups that hold the whole table."""
    l = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    first = c("l_linenumber") == 1
    out = scan.carried(
        l, ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"],
        {"opened": scan.forward(F.when(first, c("l_shipdate"))), "next_large": scan.back(F.when(c("l_quantity") >= 49, c("l_partkey"))), "section": scan.total(first.cast("int")), "supplier_before": scan.before(c("l_suppkey"))},
        block_rows=5000,
    )
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "opened", "next_large", "section", "supplier_before")


@query(
    """WITH r AS (SELECT event_id, user_id % 2 AS side, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS begins FROM events WINDOW w AS (PARTITION BY user_id % 2 ORDER BY event_id))
SELECT event_id, side, event_type, CAST(sum(begins) OVER (PARTITION BY side ORDER BY event_id) AS BIGINT) AS run FROM r"""
)
def crowded_runs(spark, d):
    """Runs of equal events in two groups that hold the whole table."""
    e = read(spark, d, "events").select("event_id", (c("user_id") % 2).alias("side"), "event_type")
    return scan.runs(e, ["side"], ["event_id"], "event_type", "run", block_rows=1000)


#: Lines of texts: a short line opens a heading, a long one its body, marks make what follows noise until an empty line.
LINES = scan.Machine(
    ("outside", "heading", "body", "noise"), "outside",
    {("outside", "short"): "heading", ("body", "short"): "heading", ("heading", "long"): "body", ("outside", "long"): "body", ("noise", "short"): "noise", ("noise", "long"): "noise"}, {"marks": "noise", "empty": "outside"},
)
_SYMBOL = "CASE WHEN trim({0}) = '' THEN 'empty' WHEN regexp_matches({0}, '[#$%&*|]') THEN 'marks' WHEN length({0}) < 50 THEN 'short' ELSE 'long' END"
_STEP = "CASE {s} WHEN 'empty' THEN 'outside' WHEN 'marks' THEN 'noise' WHEN 'short' THEN CASE WHEN {b} IN ('outside', 'body') THEN 'heading' ELSE {b} END ELSE CASE WHEN {b} IN ('outside', 'heading') THEN 'body' ELSE {b} END END"


def _symbol(line):
    return F.when(F.trim(line) == "", "empty").when(line.rlike("[#$%&*|]"), "marks").when(F.length(line) < 50, "short").otherwise("long")


@query(
    f"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents), s AS (SELECT doc_id, n, {_SYMBOL.format('line')} AS symbol FROM l),
w AS (SELECT DISTINCT doc_id, 0::BIGINT AS n, 'outside' AS state, NULL::VARCHAR AS state_before FROM s UNION ALL SELECT s.doc_id, s.n, {_STEP.format(s='s.symbol', b='w.state')}, w.state FROM w JOIN s ON s.doc_id = w.doc_id AND s.n = w.n + 1)
SELECT doc_id, CAST(n AS INTEGER) AS n, state, state_before FROM w WHERE n > 0"""
)
def states_of_lines(spark, d):
    """The state of a machine of headings, bodies and noise after each line of each document."""
    lines = read(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).withColumn("n", c("n") + 1)
    return scan.run_machine(lines, ["doc_id"], ["n"], _symbol(c("line")), LINES, block_rows=2000).select("doc_id", "n", "state", "state_before")


#: Speakers of a conversation: who is asked, and whether the last question has its answer.
TALK = scan.Machine(("idle", "asked", "answered"), "idle", {("idle", "question"): "asked", ("answered", "question"): "asked", ("asked", "answer"): "answered"}, {"rules": "idle"})


@query(
    """WITH RECURSIVE s AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' ELSE 'rules' END AS symbol FROM conversations),
w AS (SELECT DISTINCT conv_id, 0::BIGINT AS turn, 0::BIGINT AS n, 'idle' AS state FROM s UNION ALL SELECT s.conv_id, s.turn, s.n, CASE WHEN symbol = 'rules' THEN 'idle' WHEN symbol = 'question' AND state IN ('idle', 'answered') THEN 'asked' WHEN symbol = 'answer' AND state = 'asked' THEN 'answered' ELSE state END FROM w JOIN s ON s.conv_id = w.conv_id AND s.n = w.n + 1)
SELECT state, count(*) AS turns, count(DISTINCT conv_id) AS conversations FROM w WHERE n > 0 GROUP BY state"""
)
def states_of_turns(spark, d):
    """How many turns leave a conversation idle, asked or answered."""
    t = read(spark, d, "conversations").select("conv_id", "turn", "role")
    symbol = F.when(c("role") == "user", "question").when(c("role") == "assistant", "answer").otherwise("rules")
    out = scan.run_machine(t, ["conv_id"], ["turn"], symbol, TALK, block_rows=500)
    return out.groupBy("state").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("conversations"))


@query(
    """WITH w AS (SELECT string_split(text, ' ') AS w FROM benchmark), p AS (SELECT w[i] || ' ' || w[i + 1] AS name FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w) UNION SELECT p_name FROM part), n AS (SELECT DISTINCT name FROM p WHERE length(name) >= 12 OR length(name) BETWEEN 1 AND 2)
SELECT doc_id, name FROM documents, n WHERE contains(text, name)"""
)
def phrases_in_documents(spark, d):
    """Which of a large list of phrases (pairs of words of benchmark texts, names of parts) stand in which documents."""
    words = F.split("text", " ")
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    listed = read(spark, d, "benchmark").select(F.explode(F.when(F.size(words) > 1, pairs)).alias("name")).unionByName(read(spark, d, "part").select(c("p_name").alias("name")))
    return grams.names_in_texts(read(spark, d, "documents").select("doc_id", "text"), listed.where("length(name) >= 12 OR length(name) BETWEEN 1 AND 2"), "doc_id", "text", "name")


@query("SELECT doc_id, lang FROM documents WHERE contains(text, 'tion and') AND contains(text, 'thre') AND contains(text, 'on')")
def keyword_index_search(spark, d):
    """Documents with three keywords: posting lists of their grams from the rarest on, then the texts that are left."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "text")
    index = grams.KeywordIndex(spark, files.scratch(spark) + "/keywords").build(docs, "doc_id", "text")
    return index.search(docs, ["tion and", "thre", "on"], "doc_id", "text").select("doc_id", "lang")
