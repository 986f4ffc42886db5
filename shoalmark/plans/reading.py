"""Queries of page readers, merge policies and small decisions over the tables, with the rules in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, merge, ordered, pages, sites, spatial, survivorship
from ..sources import publish
from .registry import query
from .tables import SQL_LAT, SQL_LON, lat_of, lon_of, read

c = F.col


@query(
    r"""WITH r AS (SELECT c_nationkey AS id, c_mktsegment AS seg, c_name AS name, c_custkey, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS g FROM customer),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY seg, c_custkey) AS INTEGER) AS row FROM r)
SELECT id, 0 AS tbl, row, 0 AS col, 'segment' AS header, seg AS text FROM n UNION ALL SELECT id, 0, row, 1, 'name', name FROM n UNION ALL SELECT id, 0, row, 2, 'name', CASE WHEN c_custkey % 3 = 0 THEN name ELSE CAST(c_custkey AS VARCHAR) END FROM n
UNION ALL SELECT DISTINCT id, 0, 0, 0, 'segment', 'segment' FROM n UNION ALL SELECT DISTINCT id, 0, 0, 1, 'name', 'name' FROM n UNION ALL SELECT DISTINCT id, 0, 0, 2, 'name', 'name' FROM n"""
)
def cells_of_tables(spark, d):
    """Cells of HTML tables with spans: customers of each nation, their segment over several rows, some cells over two columns."""
    k = c("c_custkey")
    rows = read(spark, d, "customer").withColumn("first", k == F.min("c_custkey").over(ordered.Window.partitionBy("c_nationkey", "c_mktsegment"))).withColumn("n", F.count("*").over(ordered.Window.partitionBy("c_nationkey", "c_mktsegment")))
    cells = F.when(k % 3 == 0, F.concat(F.lit("<td colspan=2><b>"), "c_name", F.lit("</b>"))).otherwise(F.concat(F.lit("<td>"), "c_name", F.lit("<td>"), k.cast("string")))
    row = F.concat(F.lit("<tr>"), F.when(c("first"), F.concat(F.lit("<td rowspan="), c("n").cast("string"), F.lit(">"), c("c_mktsegment"))).otherwise(""), cells, F.lit("</tr>"))
    tables = rows.withColumn("row", row).groupBy("c_nationkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_mktsegment", "c_custkey", "row"))), lambda x: x["row"]), "").alias("body"))
    html = tables.select(c("c_nationkey").alias("id"), F.concat(F.lit("<p>x<table><tr><th>segment<th colspan=2>name</tr>"), "body", F.lit("</table>")).alias("html"))
    return pages.table_cells(html, "id", "html")


@query(
    r"""WITH p AS (SELECT page_id, regexp_extract_all(html, '(?s)<h1[^>]*>.*?</h1>|<li[^>]*>.*?</li>|<(?:p|div)[^>]*class="[^"]*"[^>]*>') AS t FROM pages), u AS (SELECT page_id, CAST(unnest(range(1, len(t) + 1)) AS INTEGER) AS n, unnest(t) AS raw FROM p)
SELECT page_id AS id, n, CASE WHEN raw LIKE '<h1%' THEN 'title' WHEN raw LIKE '<li%' THEN 'item' ELSE 'block' END AS kind, trim(regexp_replace(regexp_replace(raw, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM u"""
)
def tokens_of_pages(spark, d):
    """Titles, items and classed blocks of pages in document order."""
    kinds = {"title": "<h1[^>]*>(.*?)</h1>", "item": "<li[^>]*>(.*?)</li>", "block": '<(?:p|div)[^>]*class="[^"]*"[^>]*>'}
    return pages.tokens(read(spark, d, "pages"), "page_id", "html", kinds).select("id", "n", "kind", "text")


@query(
    r"""WITH p AS (SELECT a.page_id, a.url, b.url AS href FROM pages a JOIN pages b ON b.page_id = a.page_id + 1), h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\.', '') AS own, regexp_replace(lower(regexp_extract(href, '^https?://([^/?#]*)', 1)), '^www\.', '') AS host FROM p)
SELECT page_id, CASE WHEN own = host THEN 'site' ELSE 'blog' END AS kind FROM h"""
)
def kinds_of_next_pages(spark, d):
    """Whether the page with the next id is of a page's own site."""
    p = read(spark, d, "pages").select("page_id", "url")
    following = p.join(p.select((c("page_id") - 1).alias("page_id"), c("url").alias("href")), "page_id")
    return following.select("page_id", pages.link_kind(c("href"), c("url")).alias("kind"))


@query(
    r"""WITH a AS (SELECT page_id AS site, regexp_extract_all(html, '(?is)<a\s[^>]*href=["''][^"'']*["''][^>]*>.*?</a>') AS l FROM pages), b AS (SELECT site, CAST(unnest(generate_series(0, len(l) - 1)) AS INTEGER) AS n, unnest(l) AS x FROM a),
x AS (SELECT site, n, regexp_extract(x, '(?i)href=["'']([^"'']*)["'']', 1) AS url, trim(regexp_replace(regexp_replace(x, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS text FROM b),
s AS (SELECT *, length(text) % 7 AS score, length(text) % 2 = 0 AS strict, contains(text, 'o') AS loose, contains(text, 'tion') AS blog FROM x), r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, n) AS rank, count(*) FILTER (blog) OVER (PARTITION BY site) AS blogs FROM s WHERE score > 0),
t AS (SELECT site, url, rank, 1 AS turn, strict AS ok, 's' AS why FROM r WHERE rank <= 5 UNION ALL SELECT site, url, rank, 2, CASE WHEN blogs <= 1 THEN loose ELSE strict END, CASE WHEN blogs <= 1 THEN 'l' ELSE 's' END FROM r WHERE rank <= 5)
SELECT site, arg_min(url, (turn, rank)) AS url, min(turn) AS turn, arg_min(why, (turn, rank)) AS why FROM t WHERE ok GROUP BY site"""
)
def links_chosen(spark, d):
    """The link of each page that a visit in two turns chooses: the best five, strictly first, then loosely."""
    l = pages.links(read(spark, d, "pages"), "page_id", "html")
    of = lambda ok, why: F.struct(ok.alias("ok"), F.lit(why).alias("why"))
    t = c("text")
    cands = l.select(c("id").alias("site"), "n", (F.length(t) % 7).alias("score"), c("href").alias("url"), of(F.length(t) % 2 == 0, "s").alias("strict"), of(t.contains("o"), "l").alias("loose"), t.contains("tion").alias("named_blog"))
    return sites.chosen_links(cands)


@query(
    r"""WITH a AS (SELECT page_id AS id, regexp_extract_all(html, '(?is)<a\s[^>]*href=["''][^"'']*["''][^>]*>.*?</a>') AS l FROM pages), b AS (SELECT id, CAST(unnest(generate_series(0, len(l) - 1)) AS INTEGER) AS n, unnest(l) AS x FROM a)
SELECT id, n, CAST(CASE WHEN regexp_matches(regexp_extract(x, '(?i)href=["'']([^"'']*)["'']', 1), '(?i)price|ryokin|ryoukin|fee|plan|fare') THEN 8 ELSE 0 END AS INTEGER) AS score FROM b WHERE regexp_matches(x, 'plan|price|fee|the')"""
)
def crawl_scores_of_links(spark, d):
    """How close to fares the links of pages lead, by what their address says."""
    l = pages.links(read(spark, d, "pages"), "page_id", "html")
    return l.where(c("href").rlike("plan|price|fee|the") | c("text").rlike("plan|price|fee|the")).select("id", "n", sites.crawl_score(F.lit(""), c("href")).alias("score"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?')) AS numbers, length(text) - length(replace(text, chr(65533), '')) AS broken, len(regexp_extract_all(text, '[à-ÿ]')) AS accents FROM documents WHERE text IS NOT NULL")
def statistics_of_texts(spark, d):
    """Numbers, broken characters and accents of documents."""
    t = c("text")
    return read(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.regexp_count(t, F.lit(r"[0-9]+(?:\.[0-9]+)?")).cast("long").alias("numbers"), F.regexp_count(t, F.lit("�")).cast("long").alias("broken"), F.regexp_count(t, F.lit("[à-ÿ]")).cast("long").alias("accents"))


_SQL_LISTED = "r AS (SELECT o_custkey AS k, o_orderkey AS n, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS website, [o_orderstatus, left(o_orderpriority, 1)] AS types, o_orderstatus = 'F' AS stale, CAST(o_orderdate AS DATE)::VARCHAR AS as_of FROM orders)"


@query(
    f"""WITH {_SQL_LISTED}, u AS (SELECT k, n, i, types[i] AS t FROM r, range(1, 3) x(i)), f AS (SELECT k, t, min((n, i)) AS first FROM u GROUP BY k, t), l AS (SELECT k, list(t ORDER BY first) AS types FROM f GROUP BY k)
SELECT r.k, arg_min(website, n) FILTER (website <> '') AS website, bool_and(stale) AS stale, max(as_of) AS as_of, any_value(l.types) AS types FROM r JOIN l USING (k) GROUP BY r.k"""
)
def policies_of_merging(spark, d):
    """Orders of a customer as one record: what is empty is filled, lists unite in order, stale only if all are, the latest day."""
    k = c("o_orderkey")
    site = F.when(k % 3 == 0, "").when(k % 7 == 0, None).otherwise(c("o_orderpriority"))
    rows = read(spark, d, "orders").select(c("o_custkey").alias("k"), k.alias("n"), site.alias("website"), F.array("o_orderstatus", F.left("o_orderpriority", F.lit(1))).alias("types"), (c("o_orderstatus") == "F").alias("stale"), c("o_orderdate").cast("date").cast("string").alias("as_of"))
    return merge.absorbed(rows, ["k"], ["n"], fill=["website"], union=["types"], every=["stale"], latest=["as_of"])


@query(
    """WITH l AS (SELECT s_suppkey AS k, s_name AS name, CAST(s_nationkey AS VARCHAR) AS tel FROM supplier), t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS tel FROM customer WHERE c_custkey % 5 <> 0)
SELECT coalesce(t.k, l.k) AS k, coalesce(nullif(t.name, ''), l.name) AS name, coalesce(nullif(t.tel, ''), l.tel) AS tel FROM t FULL JOIN l ON t.k = l.k"""
)
def listings_with_details(spark, d):
    """What a detail lacks comes from the listing of its key; listings without a detail stay."""
    k = c("c_custkey")
    listing = read(spark, d, "supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("name"), c("s_nationkey").cast("string").alias("tel"))
    detail = read(spark, d, "customer").where(k % 5 != 0).select(k.alias("k"), F.when(k % 2 == 0, "").otherwise(c("c_name")).alias("name"), F.when(k % 3 != 0, c("c_mktsegment")).alias("tel"))
    return merge.enriched(listing, detail, "k")


@query(
    """WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS office, o_orderpriority AS tel FROM orders WHERE o_orderkey % 4 <> 1), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS office, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS tel FROM orders WHERE o_orderkey % 4 <> 2)
SELECT n.k, n.office, false AS stale, array_to_string(list_filter([CASE WHEN b.office IS NOT NULL AND b.office IS DISTINCT FROM n.office THEN 'office: ' || b.office END, CASE WHEN b.tel IS NOT NULL AND b.tel IS DISTINCT FROM n.tel THEN 'tel: ' || b.tel END], lambda x: x IS NOT NULL), ';') AS notes FROM n LEFT JOIN b USING (k)
UNION ALL SELECT k, office, true, '' FROM b WHERE k NOT IN (SELECT k FROM n)"""
)
def changes_between_seasons(spark, d):
    """Orders of two seasons: what only the earlier one has is stale, what differs is noted."""
    k = c("o_orderkey")
    o = read(spark, d, "orders")
    before = o.where(k % 4 != 1).select(k.alias("k"), c("o_orderstatus").alias("office"), c("o_orderpriority").alias("tel"))
    now = o.where(k % 4 != 2).select(k.alias("k"), F.when(k % 5 == 0, "X").otherwise(c("o_orderstatus")).alias("office"), F.when(k % 6 != 0, c("o_orderpriority")).alias("tel"))
    return merge.season_changes(now, before, "k", ["office", "tel"]).select("k", "office", "stale", F.array_join("notes", ";").alias("notes"))


@query(
    """WITH e AS (SELECT 's' || s_suppkey AS entity, CASE WHEN s_suppkey % 3 = 0 THEN 't' || (s_suppkey % 40) END AS tel, CASE WHEN s_suppkey % 4 = 0 THEN 'h' || (s_suppkey % 60) END AS host, 'boat' || s_suppkey AS nkey, s_nationkey AS pref FROM supplier),
r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 't' || (c_custkey % 40) ELSE '' END AS tel, CASE WHEN c_custkey % 7 = 0 THEN 'h' || (c_custkey % 60) END AS host, CASE WHEN c_custkey % 2 = 0 THEN 'boat' || (c_custkey % 100) || 'x' ELSE 'oat' || (c_custkey % 10) END AS nkey, c_nationkey AS pref FROM customer),
a AS (SELECT r.id, 1 AS n, min(entity) AS hit FROM r JOIN e ON r.tel = e.tel AND r.tel <> '' GROUP BY r.id UNION ALL SELECT r.id, 2, min(entity) FROM r JOIN e ON r.host = e.host GROUP BY r.id UNION ALL SELECT r.id, 3, min(entity) FROM r JOIN e ON r.pref = e.pref AND (contains(e.nkey, r.nkey) OR contains(r.nkey, e.nkey)) GROUP BY r.id)
SELECT r.id, arg_min(a.hit, a.n) AS hit FROM r LEFT JOIN a ON a.id = r.id GROUP BY r.id"""
)
def entities_known(spark, d):
    """Whether a customer is one of the suppliers: by phone, by host, by a name inside the other's in one nation."""
    s, k = c("s_suppkey"), c("c_custkey")
    named = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    entities = read(spark, d, "supplier").select(named("s", s).alias("entity"), F.when(s % 3 == 0, named("t", s % 40)).alias("tel"), F.when(s % 4 == 0, named("h", s % 60)).alias("host"), named("boat", s).alias("nkey"), c("s_nationkey").alias("pref"))
    rows = read(spark, d, "customer").select(k.alias("id"), F.when(k % 5 == 0, named("t", k % 40)).otherwise("").alias("tel"), F.when(k % 7 == 0, named("h", k % 60)).alias("host"), F.when(k % 2 == 0, F.concat(named("boat", k % 100), F.lit("x"))).otherwise(named("oat", k % 10)).alias("nkey"), c("c_nationkey").alias("pref"))
    return merge.known_to(rows, entities)


@query(
    """WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), o AS (SELECT * FROM u QUALIFY n = max(n) OVER (PARTITION BY user_id)),
f AS (SELECT user_id, arg_min(event_type, event_id) AS g FROM events GROUP BY user_id)
SELECT 'owner' AS what, user_id AS value, event_type AS who, NULL::BIGINT AS event_id FROM o UNION ALL SELECT 'kept', CASE WHEN g = event_type THEN e.user_id END, event_type, event_id FROM events e JOIN f USING (user_id)"""
)
def values_and_owners(spark, d):
    """A value belongs to those who use it most; elsewhere it stays with the group that has it first."""
    e = read(spark, d, "events").select("event_id", "user_id", "event_type")
    a = survivorship.owned(e, "user_id", "event_type").select(F.lit("owner").alias("what"), c("user_id").alias("value"), c("event_type").alias("who"), F.lit(None).cast("bigint").alias("event_id"))
    b = survivorship.used_in_one(e, "user_id", "event_type", "event_id").select(F.lit("kept").alias("what"), c("user_id").alias("value"), c("event_type").alias("who"), "event_id")
    return a.unionByName(b)


_CELLS = f"""s AS (SELECT DISTINCT CAST(floor(la) AS INTEGER) AS y, CAST(floor(lo) AS INTEGER) AS x FROM (SELECT {SQL_LAT.format('s_suppkey')} AS la, {SQL_LON.format('s_suppkey')} AS lo FROM supplier)),
p AS (SELECT c_custkey AS pid, {SQL_LAT.format('c_custkey')} + 0.003 AS la, {SQL_LON.format('c_custkey')} + 0.003 AS lo FROM customer), q AS (SELECT *, CAST(floor(la) AS INTEGER) AS y, CAST(floor(lo) AS INTEGER) + CAST(pid % 2 AS INTEGER) AS x FROM p)"""


@query(
    f"""WITH {_CELLS} SELECT pid, pid % 2 = 0 AND s.y IS NOT NULL AS inside, s.y IS NOT NULL AND (pid % 2 = 0 OR (q.x - lo) * cos(radians(la)) * 111.320 <= 20) AS within FROM q LEFT JOIN s ON s.y = q.y AND s.x = q.x"""
)
def points_in_the_area_they_name(spark, d):
    """Customers that name the map cell that they lie in, or its eastern neighbour, among the cells of suppliers: inside, or within 20 km."""
    s, k = c("s_suppkey"), c("c_custkey")
    cells = read(spark, d, "supplier").select(F.floor(lat_of(s)).cast("int").alias("y"), F.floor(lon_of(s)).cast("int").alias("x")).distinct()
    corner = lambda y, x: F.struct((c("y") + y).cast("double").alias("la"), (c("x") + x).cast("double").alias("lo"))
    edges = spatial.ring_edges(cells.select(F.concat_ws(",", "y", "x").alias("area"), F.lit(0).alias("ring"), F.array(corner(0, 0), corner(0, 1), corner(1, 1), corner(1, 0)).alias("points")))
    p = read(spark, d, "customer").select(k.alias("pid"), (lat_of(k) + 0.003).alias("la"), (lon_of(k) + 0.003).alias("lo"))
    named = p.withColumn("area", F.concat_ws(",", F.floor("la").cast("int"), F.floor("lo").cast("int") + (c("pid") % 2).cast("int")))
    return spatial.within_own_area(named, edges, km=20)


@query("""WITH n AS (SELECT p_type, count(*) AS n FROM part GROUP BY p_type) SELECT CAST(row_number() OVER (ORDER BY n DESC, p_type) AS INTEGER) AS place, p_type, n FROM n""")
def types_by_use(spark, d):
    """Types of parts, the most used first."""
    return ordered.by_use(read(spark, d, "part"), "p_type").select("place", "p_type", "n")


@query("""SELECT p_partkey AS id, CAST(row_number() OVER (ORDER BY split_part(p_brand, '#', 1), p_partkey) AS INTEGER) AS place FROM part""")
def parts_in_order(spark, d):
    """Parts in the order of their code's text, then its number."""
    p = read(spark, d, "part").select(c("p_partkey").alias("id"), F.concat(F.substring_index("p_brand", "#", 1), F.lit("/"), c("p_partkey").cast("string")).alias("code"))
    return ordered.by_parts(p, "code", "/").select("id", "place")


@query("""WITH u AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment), v AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS r FROM u)
SELECT CAST(c_nationkey AS VARCHAR) AS metric, CAST(c_nationkey AS VARCHAR) || ': ' || string_agg(c_mktsegment || '=' || n, ', ' ORDER BY r) AS line FROM v WHERE r <= 3 GROUP BY c_nationkey""")
def report_of_segments(spark, d):
    """A report's line for each nation: its three most frequent segments."""
    counts = read(spark, d, "customer").groupBy(c("c_nationkey").cast("string").alias("metric"), c("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))
    return publish.report(counts, 3)


@query(
    """WITH l AS (SELECT l_orderkey AS k, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS f, list(l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey) AS s FROM lineitem GROUP BY l_orderkey),
m AS (SELECT k, f, s, list_distinct(f) AS df, list_transform(list_distinct(f), lambda x: {'n': len(list_filter(f, lambda y: y = x)), 'p': -list_position(f, x), 'v': x}) AS c FROM l)
SELECT k, list_sort(c)[-1].v AS mode, CASE WHEN len(df) = 1 THEN f[1] END AS only, len(list_filter(f, lambda x: x NOT IN ('A', 'N'))) = 0 AS known FROM m"""
)
def decisions_on_arrays(spark, d):
    """The most frequent flag of an order's lines, ties to the first; the flag if there is one only; whether all are known."""
    lines = read(spark, d, "lineitem").groupBy(c("l_orderkey").alias("k")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))), lambda x: x["l_returnflag"]).alias("f"))
    return lines.select("k", classify.mode(c("f")).alias("mode"), classify.only_one(c("f")).alias("only"), classify.within_set(c("f"), ("A", "N")).alias("known"))


@query("""WITH h AS (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderstatus = 'O'), a AS (SELECT count(*) AS n FROM customer)
SELECT c_custkey, (SELECT n FROM h) >= 0.5 * (SELECT n FROM a) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AS stale FROM customer""")
def stale_if_the_list_is_complete(spark, d):
    """Customers without an open order are stale, if half of all customers are listed with one."""
    customers = read(spark, d, "customer").select("c_custkey")
    listed = read(spark, d, "orders").where("o_orderstatus = 'O'").select(c("o_custkey").alias("c_custkey"))
    return classify.gone(customers, listed, customers.groupBy().agg(F.count("*").alias("n")), "c_custkey", 0.5)


@query(
    """WITH t AS (SELECT p_partkey % 50 AS boat, p_partkey AS tour, CAST(p_size % 5 AS VARCHAR) AS name, left(p_type, 1) AS kind, p_size % 20 AS price FROM part),
b AS (SELECT o_custkey % 50 AS boat, o_orderkey AS n, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5000 END AS tour, CAST(o_orderkey % 7 AS VARCHAR) AS name, o_orderstatus AS kind, CAST(o_totalprice AS INTEGER) % 20 AS price FROM orders WHERE o_orderkey % 10 = 3),
own AS (SELECT boat, 1 AS part, n AS place, name, kind, price FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.boat = b.boat AND t.tour = b.tour) AND NOT (b.tour IS NULL AND EXISTS (SELECT 1 FROM t WHERE t.boat = b.boat AND t.name = b.name))),
every AS (SELECT boat, 0 AS part, tour AS place, name, kind, price FROM t UNION ALL SELECT * FROM own), kept AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY boat, name, kind, price ORDER BY part, place) = 1)
SELECT boat, CAST(row_number() OVER (PARTITION BY boat ORDER BY part, place) - 1 AS INTEGER) AS n, name, kind, price FROM kept"""
)
def offers_with_their_tours(spark, d):
    """Offers of boats: those of their tours, then their own that no tour gives, by number or name; equal ones once."""
    t, o = read(spark, d, "part"), read(spark, d, "orders").where("o_orderkey % 10 = 3")
    k = c("o_orderkey")
    tours = t.select((c("p_partkey") % 50).alias("boat"), c("p_partkey").alias("tour"), (c("p_size") % 5).cast("string").alias("name"), F.left("p_type", F.lit(1)).alias("kind"), (c("p_size") % 20).alias("price"))
    boats = o.select((c("o_custkey") % 50).alias("boat"), k.alias("n"), F.when(k % 3 == 0, k % 5000).alias("tour"), (k % 7).cast("string").alias("name"), c("o_orderstatus").alias("kind"), (F.bround("o_totalprice").cast("int") % 20).alias("price"))
    return merge.with_tours(boats, tours)


@query(
    """WITH r AS (SELECT c_custkey AS id, c_nationkey AS pref, c_custkey % 40 AS nkey, c_mktsegment AS kind, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 9 AS VARCHAR) END AS tel, CASE WHEN c_custkey % 4 = 0 THEN 'p' || (c_custkey % 8) ELSE '' END AS port, CASE WHEN c_custkey % 5 = 0 THEN 'u' || (c_custkey % 25) END AS ukey FROM customer)
SELECT a.id, min(b.id) AS partner FROM r a JOIN r b ON a.pref = b.pref AND a.nkey = b.nkey AND a.kind <> b.kind AND b.id < a.id AND (a.tel = b.tel OR a.tel IS NULL AND b.tel IS NULL OR a.port <> '' AND a.port = b.port OR a.ukey = b.ukey) GROUP BY a.id"""
)
def partners_across_lists(spark, d):
    """The first row before a row, of another list and with its key, whose phone, port or site agrees."""
    k = c("c_custkey")
    named = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    rows = read(spark, d, "customer").select(k.alias("id"), c("c_nationkey").alias("pref"), (k % 40).alias("nkey"), c("c_mktsegment").alias("kind"), F.when(k % 3 == 0, (k % 9).cast("string")).alias("tel"), F.when(k % 4 == 0, named("p", k % 8)).otherwise("").alias("port"), F.when(k % 5 == 0, named("u", k % 25)).alias("ukey"))
    return merge.across_lists(rows, ["pref", "nkey"], "kind")


_SQL_KM = "sqrt(power(radians(q.lo - p.lo) * cos(radians((p.la + q.la) / 2)), 2) + power(radians(q.la - p.la), 2)) * 6371.0"


@query(
    f"""WITH p AS (SELECT c_custkey AS id, {SQL_LAT.format('c_custkey')} + 0.004 AS la, {SQL_LON.format('c_custkey')} + 0.004 AS lo FROM customer), q AS (SELECT s_suppkey AS sid, {SQL_LAT.format('s_suppkey * 7')} AS la, {SQL_LON.format('s_suppkey * 7')} AS lo FROM supplier),
b AS (SELECT p.id, min({_SQL_KM}) AS km FROM p JOIN q ON abs(q.la - p.la) < 0.4 AND abs(q.lo - p.lo) < 0.4 GROUP BY p.id), n AS (SELECT p.id, min(sqrt(power((q.lo - p.lo) * cos(radians(p.la)) * 111.320, 2) + power((q.la - p.la) * 110.574, 2))) AS coast FROM p, q WHERE q.sid % 3 = 0 GROUP BY p.id)
SELECT id, round(coast, 4) AS coast_km, round(km, 4) AS port_km FROM n LEFT JOIN b USING (id) WHERE coast >= 30 AND coalesce(km, 1e9) >= 30"""
)
def places_in_doubt(spark, d):
    """Places 30 km or more from the nearest coast, at any distance, without a port as near in a box around them."""
    from ..operators import coordinates, gazetteer

    k, s = c("c_custkey"), c("s_suppkey")
    places = read(spark, d, "customer").select(k.alias("rid"), (lat_of(k) + 0.004).alias("la"), (lon_of(k) + 0.004).alias("lo"))
    ports = read(spark, d, "supplier").select(s.alias("sid"), lat_of(s * 7).alias("la"), lon_of(s * 7).alias("lo"))
    coast = spatial.nearest_by_rings(places.withColumnRenamed("rid", "pid"), ports.where("sid % 3 = 0").select("sid", c("la").alias("la1"), c("lo").alias("lo1"), c("la").alias("la2"), c("lo").alias("lo2")), size=0.5, few=50)
    near = coordinates.nearest_in_box(places, ports, 0.4)
    rows = coast.select(c("pid").alias("id"), c("km").alias("coast_km")).join(near.select(c("rid").alias("id"), c("km").alias("port_km")), "id", "left")
    return gazetteer.doubtful(rows, 30.0).select("id", F.round("coast_km", 4).alias("coast_km"), F.round("port_km", 4).alias("port_km"))


@query(
    """WITH l AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS part, CASE l_returnflag WHEN 'A' THEN '仕立' WHEN 'N' THEN '乗合' ELSE '体験' END AS kind, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS price, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem)
SELECT id, array_to_string(list(kind || coalesce(CAST(price AS VARCHAR), '?') ORDER BY CASE kind WHEN '乗合' THEN 0 WHEN '仕立' THEN 1 ELSE 3 END, coalesce(price, 1000000000), place), ',') AS shown FROM l GROUP BY id"""
)
def offers_in_order(spark, d):
    """An order's lines as offers in the order in which they are shown: by kind, then price, unknown prices last."""
    from ..functions import display

    kind = F.when(c("l_returnflag") == "A", "仕立").when(c("l_returnflag") == "N", "乗合").otherwise("体験")
    price = F.when(c("l_partkey") % 4 != 0, c("l_quantity").cast("int"))
    lines = read(spark, d, "lineitem").groupBy(c("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"), price.alias("price")))).alias("plans"))
    shown = F.transform(display.in_order(c("plans")), lambda p: F.concat(p["kind"], F.coalesce(p["price"].cast("string"), F.lit("?"))))
    return lines.select("id", F.array_join(shown, ",").alias("shown"))


@query("""SELECT c_custkey AS id, CASE WHEN o.p IS NOT TRUE THEN c_name END AS name, CASE WHEN o.n IS NOT TRUE THEN c_acctbal END AS price
FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS p, bool_or(o_totalprice > 100000) AS n FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey""")
def unstated_values_go(spark, d):
    """Fields of customers are blanked where another table says that they were never stated."""
    flagged = read(spark, d, "orders").groupBy(c("o_custkey").alias("id")).agg(F.bool_or(c("o_orderpriority") == "1-URGENT").alias("name_unstated"), F.bool_or(c("o_totalprice") > 100000).alias("price_unstated"))
    rows = read(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_acctbal").alias("price"))
    return publish.blanked(rows, flagged, ["id"], ["name", "price"])


@query("""SELECT id, unnest(members) AS member FROM (SELECT o_custkey AS id, list('o' || o_orderkey) AS members FROM orders GROUP BY o_custkey)""")
def memberships_of_entities(spark, d):
    """The membership table of entities: a row for each member."""
    entities = read(spark, d, "orders").groupBy(c("o_custkey").alias("id")).agg(F.collect_list(F.concat(F.lit("o"), c("o_orderkey").cast("string"))).alias("members"))
    return publish.memberships(entities)


@query("""SELECT c_custkey, 'b' || left(sha1(c_mktsegment || ':' || c_custkey), 9) AS id, TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS number, TRY_CAST(regexp_replace(c_mktsegment, '[^0-9]', '', 'g') AS BIGINT) AS none FROM customer""")
def ids_and_numbers(spark, d):
    """Ids of entities from source and key, and the numbers that the digits of texts make."""
    from ..functions.text import digits_only
    from ..operators.resolve import entity_id

    return read(spark, d, "customer").select("c_custkey", entity_id(c("c_mktsegment"), c("c_custkey").cast("string")).alias("id"), digits_only(c("c_name")).alias("number"), digits_only(c("c_mktsegment")).alias("none"))
