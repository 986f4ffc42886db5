"""Official sites of entities: which to read, in which order, what to keep of them, and what their pages lead to."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dims import CATCH_SITES, SNS_HOSTS, SNS_NAMES
from ..functions.web import clean_url, host_in, host_of, site_key
from .ordered import context, over

# Patterns of labels of links, by how close to fares they lead; in a URL they count two less.
LINK_SCORES = (
    ("料金|料金表|運賃|乗船料|価格|price|fee|charge|ryokin|ryoukin|cost", 10),
    ("乗合|乗り合い|仕立|貸切|チャーター|プラン|plan|course|コース|メニュー|menu", 8),
    ("出船|出航|時間|スケジュール|schedule|time|予定|カレンダー|calendar", 6),
    ("釣り物|釣物|ターゲット|target|案内|ご利用|利用方法|システム|system|guide|info|予約|reserve|faq|よくある", 4),
)
# What a line has to speak of to be kept in a condensed text.
KEY_LINE = (
    r"円|￥|¥|料金|運賃|乗船料|乗合|乗り合い|仕立|貸切|貸し切り|チャーター|出船|出航|沖上がり|沖揚がり|帰港|集合|受付|定休|休業|休み|"
    r"\d{1,2}[:：]\d{2}|\d{1,2}時|名様|お一人|1名|１名|大人|子供|小学生|女性|エサ|餌|氷|シーズン|期間|釣り物|釣物|ターゲット|便|午前|午後|夜|半日|一日|1日"
)
#: Catch sites that buttons name by their host.
UNNAMED = ("gyo.ne.jp", "turi-ba.com")


def to_read(entities: DataFrame, known: DataFrame | None = None, everything: bool = False) -> DataFrame:
    """(key, website, members array<struct<id, name>>) of the sites to read: those of entities (id, name, website, n_plans)
    that have no offers yet (or of all), one row a site, without those whose key is known."""
    rows = entities.where(F.col("website").isNotNull() & (F.lit(everything) | (F.coalesce("n_plans", F.lit(0)) == 0)))
    rows = rows.withColumn("key", F.left(F.sha1(F.coalesce(site_key(F.col("website")), F.col("website"))), F.lit(12)))
    out = rows.groupBy("key").agg(F.min_by("website", "id").alias("website"), F.sort_array(F.collect_set(F.struct("id", "name"))).alias("members"))
    return out.join(known.select("key"), "key", "left_anti") if known is not None else out


def crawl_score(label: Column, url: Column) -> Column:
    """How close to fares a link leads, by its label, else by its URL; 0 for a link of no use."""
    parts = [F.when(label.rlike(f"(?i)(?:{p})"), n).when(url.rlike(f"(?i)(?:{p})"), n - 2).otherwise(0) for p, n in LINK_SCORES]
    return F.greatest(*parts)


def crawl_order(links: DataFrame, most_pages: int = 7, most_tries: int = 25, frame: int = 20) -> DataFrame:
    """(site, visit, url): the order in which a best-first crawl reads the pages of each site.

    links (site, page, n, url, score, found): the scored links of each page in page order; found tells whether a page was
    there.  The first page of a site is the one whose url is the site itself.  What a page of a frame (score `frame` or more)
    leads to joins the queue; equal scores keep the order in which they joined.  A site's queue is worked off in one place:
    it holds what a few pages link to, and the numbers of pages and tries are bounded.
    """

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        site = group["site"].iloc[0]
        by_page = {p: g.sort_values("n") for p, g in group.groupby("page")}
        seen, out, queue, joined = {site.rstrip("/")}, [site], [], 0

        def join(page: str) -> None:
            nonlocal joined
            best: dict[str, tuple] = {}
            for row in by_page[page].itertuples() if page in by_page else ():
                old = best.get(row.url)
                if row.score > 0 and (old is None or old[0] < row.score):
                    best[row.url] = (row.score, old[1] if old else len(best), bool(row.found))
            for url, (score, place, found) in sorted(best.items(), key=lambda x: (-x[1][0], x[1][1])):
                heapq.heappush(queue, (-score, joined, url, found))
                joined += 1

        join(site)
        for _ in range(most_tries):
            if not queue or len(out) >= most_pages:
                break
            score, _, url, found = heapq.heappop(queue)
            if url.rstrip("/") in seen:
                continue
            seen.add(url.rstrip("/"))
            if found:
                out.append(url)
                if -score >= frame:
                    join(url)
        return pd.DataFrame({"site": site, "visit": range(len(out)), "url": out})

    return links.select("site", "page", "n", "url", "score", "found").groupBy("site").applyInPandas(walk, "site string, visit int, url string")


def condensed(pages: DataFrame, about: DataFrame, around: int = 2, most_page: int = 3500, most_site: int = 7000, most_line: int = 300, head: int = 300, least: int = 200) -> DataFrame:
    """(site, text): of each site (site, page, url, title, text of lines) the lines that speak of fares and times with their
    neighbours, gaps marked, cut to a size for each page and each site.

    about (site, website, names) and the first page's beginning stand before the parts and count towards the size; a rest of
    under `least` ends a site.
    """
    lines = pages.select("site", "page", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    w = over(["site", "page"], ["ln"])
    kept = lines.withColumn("_in", context(F.col("line").rlike(KEY_LINE), w, around)).where("_in")
    gap = F.coalesce(F.col("ln") != F.lag("ln").over(w) + 1, F.lit(False))
    cut = F.when(F.length("line") <= most_line, F.col("line")).otherwise(F.concat(F.substring("line", 1, most_line), F.lit("…")))
    kept = kept.withColumn("_text", F.concat(F.when(gap, "…\n").otherwise(""), cut))
    in_order = lambda by, c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(by, c))), lambda x: x[c]), "\n")
    by_page = kept.groupBy("site", "page").agg(in_order("ln", "_text").alias("_body"))
    by_page = by_page.withColumn("_body", F.substring("_body", 1, most_page)).where(F.trim("_body") != "")
    titled = lambda *x: F.concat(F.lit("## "), *x, F.lit("）"))
    blocks = by_page.join(pages.select("site", "page", "url", "title"), ["site", "page"]).withColumn("_block", F.concat(titled("url", F.lit("（"), F.coalesce("title", F.lit(""))), F.lit("\n"), "_body"))
    first = pages.groupBy("site").agg(F.min_by(F.struct("title", "text"), "page").alias("f"))
    parts = F.array(F.concat(F.lit("# key: "), "site"), F.concat(F.lit("# website: "), "website"), F.concat(F.lit("# 船宿: "), "names"), titled(F.lit("冒頭（"), F.coalesce("f.title", F.lit(""))), F.substring("f.text", 1, head))
    starts = first.join(about, "site").select("site", parts.alias("_parts"))
    starts = starts.withColumn("_size", F.aggregate("_parts", F.lit(0), lambda n, p: n + F.length(p)))
    before = F.coalesce(F.sum(F.length("_block")).over(over(["site"], ["page"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = blocks.join(starts, "site").withColumn("_room", F.lit(most_site) - F.col("_size") - before)
    room = room.where((F.length("_block") <= F.col("_room")) | (F.col("_room") >= least)).withColumn("_block", F.substring("_block", F.lit(1), F.greatest(F.lit(0), "_room").cast("int")))
    joined = room.groupBy("site").agg(in_order("page", "_block").alias("_rest"))
    return starts.join(joined, "site", "left").select("site", F.concat_ws("\n", "_parts", "_rest").alias("text"))


def official_listings(read: DataFrame, sites: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """Listings of the source `official` from what was read of sites, and the (key, website) of dead ones.

    read (key, n, usable, dead, plans, schedule_text, holidays, targets, types) in the order n: the first of a key counts.
    sites (key, website, members array<struct<name, pref, port, tel>>): the first member lends its name and place.
    """
    rows = read.join(sites.where(F.col("website").isNotNull() & (F.size("members") > 0)), "key")
    first = rows.withColumn("_n", F.row_number().over(over(["key"], ["n"]))).where("_n = 1").drop("_n")
    filled = (F.size("plans") > 0) | (F.size("targets") > 0) | (F.coalesce("schedule_text", F.lit("")) != "") | (F.coalesce("holidays", F.lit("")) != "")
    usable, m = F.coalesce("usable", F.lit(True)), F.get("members", F.lit(0))
    out = first.where(usable & F.coalesce(filled, F.lit(False))).select(
        F.lit("official").alias("src"), F.col("key").alias("src_id"), F.col("website").alias("src_url"), m["name"].alias("name"), m["pref"].alias("pref"), m["port"].alias("port"), m["tel"].alias("tel"), "website",
        "types", "targets", F.substring("holidays", 1, 80).alias("holidays"), F.substring("schedule_text", 1, 300).alias("schedule_text"), "plans", F.lit(today).alias("fetched"),
    )
    return out, first.where(~usable & F.coalesce("dead", F.lit(False))).select("key", "website")


def site_states(judged: DataFrame) -> DataFrame:
    """(ukey, bad, closed) of sites from judgements (website, verdict): suspect, unusable and dead sites are bad."""
    rows = judged.where(F.col("website").isNotNull()).withColumn("ukey", site_key(F.col("website")))
    return rows.groupBy("ukey").agg(F.bool_or(F.col("verdict").isin("suspect", "unusable", "dead")).alias("bad"), F.bool_or(F.col("verdict") == "closed").alias("closed")).where("bad OR closed")


def without_closed(entities: DataFrame, states: DataFrame, booking: list[str]) -> DataFrame:
    """Entities (website, links array<struct<src, url>>) without those whose site says that they closed; where a booking
    source still lists one, only its website goes."""
    closed = states.where("closed").select(F.col("ukey").alias("_ukey"), F.lit(True).alias("_closed"))
    rows = entities.withColumn("_key", site_key(F.col("website"))).join(closed, F.col("_key") == F.col("_ukey"), "left")
    bookable = F.exists(F.coalesce("links", F.array().cast("array<struct<src:string,url:string>>")), lambda x: x["src"].isin(*booking))
    gone = F.coalesce("_closed", F.lit(False))
    return rows.where(~gone | bookable).withColumn("website", F.when(~gone, F.col("website"))).drop("_key", "_ukey", "_closed")


def catch_button(state: Column, kind: Column, how: Column, url: Column, evidence: Column, links: Column, sns: Column) -> Column:
    """struct<self, url, label> of the button that leads to an entity's catches; null without one.

    A site that is a blog of catches itself gives self.  Pages that another button leads to already give none.
    """
    links = F.coalesce(links, F.array().cast("array<string>"))
    taken = F.exists(F.concat(links, F.coalesce(sns, F.array().cast("array<string>"))), lambda u: clean_url(u) == clean_url(url))
    host = host_of(url)
    listed = (kind == "catchsite") & F.exists(links, lambda u: host_of(u) == host)
    network, report = F.lit("SNS"), host
    for part, name in reversed(SNS_NAMES.items()):
        network = F.when(host.contains(part), name).otherwise(network)
    for site, name in reversed(CATCH_SITES.items()):
        if site not in UNNAMED:
            report = F.when((host == site) | host.endswith("." + site), name).otherwise(report)
    label = (
        F.when(kind == "sns", F.concat(F.lit("釣果（"), network, F.lit("）")))
        .when(kind == "catchsite", F.concat(F.lit("釣果（"), report, F.lit("）")))
        .when((kind == "blog") & (how == "blog_link"), "公式ブログ")
        .when(kind == "blog", "釣果（公式ブログ）")
        .otherwise("公式サイトの釣果")
    )
    of = lambda own, u, text: F.struct(F.lit(own).alias("self"), u.alias("url"), text.alias("label"))
    none = F.lit(None).cast("string")
    itself = F.when((state == "self") & (F.coalesce(evidence, F.lit(0)) >= 3), of(True, none, none))
    good = (state == "ok") & (F.coalesce(url, F.lit("")) != "") & ~taken & ~listed
    return F.coalesce(itself, F.when(good, of(False, url, label)))


def chosen_links(candidates: DataFrame, most: int = 5) -> DataFrame:
    """(site, url, turn, why): of each site's candidates (site, n, score, url, strict, loose: struct<ok, why>, named_blog) the
    first that passes, the best `most` tried by score, then place: strictly first, then, where at most one is merely named
    a blog, loosely."""
    ranked = candidates.where("score > 0").withColumn("_rank", F.row_number().over(over(["site"], [F.desc("score"), "n"])))
    ranked = ranked.withColumn("_blogs", F.count_if("named_blog").over(Window.partitionBy("site")))
    tries = ranked.where(F.col("_rank") <= most).select("site", "url", "_rank", F.explode(F.array(F.struct(F.lit(1).alias("turn"), F.col("strict").alias("v")), F.struct(F.lit(2).alias("turn"), F.when(F.col("_blogs") <= 1, F.col("loose")).otherwise(F.col("strict")).alias("v")))).alias("t"))
    best = tries.where("t.v.ok").groupBy("site").agg(F.min_by(F.struct("url", "t.turn", "t.v.why"), F.struct("t.turn", "_rank")).alias("b"))
    return best.select("site", "b.*")


def redirect_target(location: Column, own: str, portals: list[str]) -> Column:
    """struct<kind, value> of where a listing's redirect leads: a page of the portal's own (its name there), a network, a
    website, or nothing of use (null)."""
    host = host_of(location)
    name = F.regexp_extract(host, r"^([^.]+)\.", 1)
    inside = host.endswith("." + own) & (host != own)
    of = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    return F.when(inside, of("subpage", name)).when(host_in(host, SNS_HOSTS), of("sns", location)).when((host != "") & (host != own) & ~host_in(host, portals), of("website", location))
