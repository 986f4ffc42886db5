"""Adapters: how the cached pages of each source become listings.

A source's pages have one of a few shapes: pages of labels and values, tables with a header, reference arrays and keyed objects
inside scripts, entries below headings.  An adapter names the shape, the pages that hold listings, and what is special to
the source; what labels mean is one table for all.  Corrections that single sites need by hand are not part of it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embedded import iso_date
from ..functions.places import city_of, clean_address, prefecture
from ..functions.ports import plain_port, port_in
from ..functions.text import digits_only, kinds_of, nfkc, reading_of, split_list, summary
from ..functions.times import before_day
from ..functions.web import phone_shown, root_of_form, url_class
from ..operators import extract, pages
from ..operators.classify import gone, rejected_name
from ..operators.ordered import forward_fill, over
from ..schema import PLAN

# What the labels of pages stand for, in the order in which they are tried.
LABELS = (
    (r"船名|船宿名|屋号|店名|名称|遊漁船名|漁船名|施設名|業者名", "name"),
    (r"よみ|ふりがな|フリガナ|かな", "kana"),
    (r"出船形態|営業形態|業態|形態|業種|釣行形態", "type"),
    (r"出港地|出船場所|出港場所|出港|乗船場所|集合場所|港|港名|船着場|係留場所", "port"),
    (r"釣り物|釣物|釣魚|対象魚|対象魚種|魚種|ターゲット|主な釣り物|季節別釣り物", "targets"),
    (r"釣り方|釣法", "methods"),
    (r"住所|所在地", "address"),
    (r"TEL|TEL/FAX|TEL・FAX|TEL&FAX|電話|電話番号|連絡先|問い合わせ|問合せ|お問い合わせ|予約電話", "tel"),
    (r"設備|船内設備|船の設備", "facilities"),
    (r"料金|料金表|乗船料|料金・スペック|料金・連絡先|料金形態", "price"),
    (r"定員|乗船定員|最大定員", "capacity"),
    (r"船長からのコメント|コメント|船長より|船長から一言|ひとこと|一言|PR|紹介|紹介文|備考|その他|注意事項", "comment"),
    (r"ホームページ|HP|URL|公式サイト|WEB|ウェブサイト", "website"),
    (r"定休日|休日|休業日|休船日", "holidays"),
    (r"出船時間|出船時刻|営業時間|出港時間", "time"),
    (r"地図|アクセス|MAP|交通", "access"),
    (r"更新日|最終更新|最終投稿", "updated"),
)
FIELDS = tuple(f for _, f in LABELS)
_KNOWN = [(re.compile(f"^(?:{p})$"), f) for p, f in LABELS]


class SourceAdapter(Protocol):
    """What reads a source: its name, and listings from its cached pages (url, html)."""

    source: str

    def read(self, cached: DataFrame) -> DataFrame: ...


def label_of(text: str) -> str | None:
    """The field that a label stands for; null for what is none."""
    t = re.sub(r"[\s【】\[\]≪≫《》<>■□●○◆◇▼▽★☆:：]", "", unicodedata.normalize("NFKC", text).upper())
    return next((f for p, f in _KNOWN if p.match(t)), None) if 0 < len(t) <= 12 else None


def facts_of(html: str | None) -> list[tuple[str, str]]:
    """(field, value) of a page's labels in page order: rows of tables, lists of terms, lines with a colon or brackets.

    A label alone on a line has the lines below it up to the next label.
    """
    out: list[tuple[str, str]] = []
    now: list | None = None
    for line in pages.lines_of(html):
        cells = [x.strip() for x in line.split(" | ")]
        marked = re.match(r"^[【\[]([^】\]]{1,12})[】\]]\s*(.*)$", line) or re.match(r"^([^:：|]{1,12})[:：]\s*(.*)$", line)
        found = None
        if len(cells) > 1 and label_of(cells[0]):
            found = label_of(cells[0]), " / ".join(x for x in cells[1:] if x)
        elif marked and label_of(marked[1]):
            found = label_of(marked[1]), marked[2]
        elif label_of(line):
            found = label_of(line), ""
        if found:
            now = [found[0], [found[1]] if found[1] else []]
            out.append(now)
        elif now is not None and len(cells) == 1:
            now[1].append(line)
    return [(f, "\n".join(v)) for f, v in out if v]


def facts(cached: DataFrame) -> DataFrame:
    """(url, n, field, value) of the labels of pages, and the first heading as the field `title`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                title = re.search(r"(?is)<h1[^>]*>(.*?)</h1>", html or "")
                found = facts_of(html) + ([("title", " ".join(pages.lines_of(title[1])))] if title else [])
                rows += [(url, n, *x) for n, x in enumerate(found)]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string()))], ["url", "n", "field", "value"])

    return cached.select("url", "html").mapInArrow(run, "url string, n int, field string, value string")


def _field_of(label: Column) -> Column:
    plain = F.regexp_replace(F.upper(label), r"[\s【】\[\]■□●○◆◇▼▽★☆:：]", "")
    out = F.lit(None).cast("string")
    for pattern, name in reversed(LABELS):
        out = F.when(plain.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


@dataclass(frozen=True)
class Adapter:
    """shape: facts, table, nuxt, objects, or headings.  page: pattern of the URLs of pages with listings; its group is the id.

    keys: names of members of objects, or patterns of headings, by field.  stale: how the source shows that a listing is
    past: unlisted (the sitemap has it, the list doesn't), incomplete (unlisted, if the list is complete), report (no report
    since a day), list (the source leaves such listings out or marks lists), none.
    """

    source: str
    page: str
    shape: str = "facts"
    keys: Mapping[str, str] = field(default_factory=dict)
    stale: str = "none"
    types: str = ""

    def read(self, cached: DataFrame) -> DataFrame:
        """Listings with their offers as arrays; names that are no boats' are left out."""
        mine = cached.where(F.col("url").rlike(self.page) & F.col("html").isNotNull())
        return listings(getattr(self, f"_{self.shape}")(mine), self)

    def _facts(self, cached: DataFrame) -> DataFrame:
        return facts(cached).withColumn("key", F.col("url"))

    def _table(self, cached: DataFrame) -> DataFrame:
        cells = pages.table_cells(cached, "url", "html").where("row > 0").withColumn("field", _field_of(nfkc("header")))
        return cells.where("field IS NOT NULL").select(F.col("id").alias("url"), F.concat_ws("#", "id", "tbl", "row").alias("key"), F.col("col").alias("n"), "field", F.col("text").alias("value"))

    def _of_json(self, rows: DataFrame) -> DataFrame:
        """rows (url, key, js): one fact for each named member."""
        return rows.select("url", "key", F.explode(F.array(*[F.struct(F.lit(i).alias("n"), F.lit(f).alias("field"), F.get_json_object("js", f"$.{k}").alias("value")) for i, (f, k) in enumerate(self.keys.items())])).alias("x")).select("url", "key", "x.*").where("value IS NOT NULL")

    def _nuxt(self, cached: DataFrame) -> DataFrame:
        items = F.from_json(F.get_json_object(pages.nuxt("html"), "$.items"), "array<string>")
        rows = cached.select("url", F.posexplode(items).alias("i", "js"))
        return self._of_json(rows.select("url", F.concat_ws("#", "url", F.coalesce(F.get_json_object("js", "$.id"), F.col("i").cast("string"))).alias("key"), "js"))

    def _objects(self, cached: DataFrame) -> DataFrame:
        found = cached.select("url", F.explode(pages.keyed_objects("html", F.lit(self.keys["name"]))).alias("o"))
        return self._of_json(found.select("url", F.concat_ws("#", "url", "o.key").alias("key"), F.col("o.object").alias("js")))

    def _headings(self, cached: DataFrame) -> DataFrame:
        """Headings of the keys' patterns; the lines below a `name` are facts of it, and `area` holds for the names below it."""
        lines = cached.select("url", F.posexplode(F.split(pages.page_text("html"), "\n")).alias("n", "line"))
        w = over(["url"], ["n"])
        name, area = (F.when(F.col("line").rlike(self.keys[k]), F.col("line")) if k in self.keys else F.lit(None).cast("string") for k in ("name", "area"))
        rows = lines.withColumn("_name", name).withColumn("_area", forward_fill(area, w)).withColumn("_at", forward_fill(F.when(F.col("_name").isNotNull(), F.col("n")), w)).where("_at IS NOT NULL")
        rows = rows.withColumn("key", F.concat_ws("#", "url", F.col("_at").cast("string")))
        own = rows.where("_name IS NOT NULL").select("url", "key", "n", F.explode(F.array(F.struct(F.lit("name").alias("field"), F.col("_name").alias("value")), F.struct(F.lit("address").alias("field"), F.col("_area").alias("value")))).alias("x")).select("url", "key", (F.col("n") + 1_000_000).alias("n"), "x.*").where("value IS NOT NULL")
        below = rows.where("_name IS NULL").withColumn("_label", F.regexp_extract("line", r"^([^:：]{1,12})[:：]", 1)).withColumn("field", _field_of(nfkc("_label"))).where("field IS NOT NULL")
        return own.unionByName(below.select("url", "key", "n", "field", F.trim(F.regexp_replace("line", r"^[^:：]{1,12}[:：]", "")).alias("value")))


def _by_source(adapters: tuple[Adapter, ...], value) -> Column:
    """value(adapter) of the first adapter whose pages a URL is one of."""
    out = None
    for a in adapters:
        out = F.when(F.col("url").rlike(a.page), value(a)) if out is None else out.when(F.col("url").rlike(a.page), value(a))
    return out


def listings(found: DataFrame, *adapters: Adapter) -> DataFrame:
    """Listings from facts (url, key, n, field, value) of the adapters' pages: the first value of each field of a key; offers from
    its prices and times."""
    found = found.where(F.coalesce("value", F.lit("")) != "").withColumn("value", nfkc("value"))
    one = found.groupBy("url", "key").agg(*[F.min_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("n"))).alias(f) for f in (*FIELDS, "title")])
    lines = found.where(F.col("field").isin("price", "time")).select("key", "n", F.posexplode(F.split("value", "\n| / ")).alias("i", "line"))
    lines = lines.withColumn("ln", F.col("n") * 1000 + F.col("i")).where("line <> ''")
    offers = extract.plans(lines, "key", "ln", "line")
    blank = lambda kind: F.lit(None).cast(kind)
    plan = F.struct("name", "kind", F.array().cast("array<string>").alias("targets"), "price", blank("string").alias("price_text"), "depart", F.col("back").alias("return"), "meet", *[blank("string").alias(x) for x in ("season", "days", "includes", "url")]).cast(PLAN)
    of_key = offers.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("ln", F.col("n").alias("at"), plan.alias("p")))), lambda x: x["p"]).alias("plans"))
    rows = one.join(of_key, "key", "left").withColumn("_shown", F.coalesce("name", "title"))
    rows = rows.where((F.coalesce("_shown", F.lit("")) != "") & ~rejected_name(F.col("_shown"))).withColumn("_r", reading_of(F.col("_shown")))
    address = F.nullif(clean_address(F.col("address")), F.lit(""))
    site = F.nullif(F.regexp_extract("website", r"(https?://[^\s<>\"'、，）)]+)", 1), F.lit(""))
    number = F.nullif(_by_source(adapters, lambda a: F.regexp_extract("url", a.page, 1)), F.lit(""))
    several = F.col("key").contains("#")  # listings of one page are told apart by their place on it
    kinds = kinds_of(F.concat_ws(" ", "type", "price", _by_source(adapters, lambda a: F.lit(a.types))))
    items = lambda c: split_list(F.coalesce(c, F.lit("")))
    return rows.select(
        _by_source(adapters, lambda a: F.lit(a.source)).alias("src"), F.when(several, F.concat_ws(":", number, F.replace(F.regexp_extract("key", "#(.*)$", 1), F.lit("#"), F.lit("-")))).otherwise(F.coalesce(number, F.left(F.sha1("key"), F.lit(10)))).alias("src_id"), F.col("url").alias("src_url"),
        F.col("_r.name").alias("name"), F.coalesce("kana", "_r.kana").alias("kana"), prefecture(address).alias("pref"), city_of(address).alias("city"), address.alias("address"), plain_port(F.coalesce(port_in(F.col("port")), F.col("port"))).alias("port"), blank("double").alias("lat"), blank("double").alias("lon"),
        phone_shown(F.col("tel")).alias("tel"), F.when(url_class(site) == "official", root_of_form(site)).alias("website"), F.when(url_class(site) == "sns", F.array(site)).otherwise(F.array().cast("array<string>")).alias("sns"), kinds.alias("types"), items(F.col("targets")).alias("targets"), items(F.col("methods")).alias("methods"),
        "holidays", items(F.col("facilities")).alias("facilities"), digits_only(F.regexp_extract("capacity", r"(\d+)", 1)).cast("int").alias("capacity"), "access", summary(F.col("comment")).alias("description"), F.coalesce("plans", F.array().cast(f"array<{PLAN}>")).alias("plans"), F.regexp_replace("time", "\n", " ").alias("schedule_text"),
        blank("string").alias("fetched"), F.lit(False).alias("stale"), iso_date(F.col("updated")).cast("string").alias("last_report"),
    )


def marked_stale(rows: DataFrame, adapter: Adapter, listed: DataFrame | None = None, announced: DataFrame | None = None, since: str = "2025-03-15") -> DataFrame:
    """rows with `stale` by the adapter's rule; listed (src_id) and announced (n) are what the source's list holds and says."""
    if adapter.stale == "report":
        return rows.withColumn("stale", before_day(F.col("last_report"), since))
    if listed is None or adapter.stale not in ("unlisted", "incomplete"):
        return rows
    if adapter.stale == "incomplete":
        return gone(rows.drop("stale"), listed, announced, "src_id")
    there = listed.select("src_id").distinct().withColumn("_there", F.lit(True))
    return rows.join(there, "src_id", "left").withColumn("stale", F.col("_there").isNull()).drop("_there")


# The sources, the pages that hold their listings, their shapes and what shows that a listing is past.
ADAPTERS: dict[str, Adapter] = {
    a.source: a
    for a in (
        Adapter("chowari", r"chowari\.jp/ship/(\d+)/?$"),
        Adapter("castingnet", r"reserve\.castingnet\.jp/.*?(\d+)"),
        Adapter("fishingv", r"fishing-v\.jp/choka/.*?(\d+)", stale="report"),
        Adapter("funaduri", r"funaduri\.jp/(?:.*/)?([^/]+)/?$", stale="list"),
        Adapter("theboat", r"theboat\.jp/boats/([^/?]+)"),
        Adapter("tsuree", r"tsuree\.jp/boats/detail/(\d+)"),
        Adapter("tsurimaru", r"tsurimaru\.jp/boat/(\d+)/", stale="incomplete"),
        Adapter("tsurisoku", r"tsurisoku\.com/f/([^/?]+)", stale="unlisted"),
        Adapter("tsuriyaro", r"fishing-station\.jp/([^/?#]+)/?$"),
        Adapter("point", r"point-i\.jp/boats/(\d+)", stale="unlisted"),
        Adapter("gurenavi", r"gurenavi\.jp/(.+)", shape="table"),
        Adapter("yugyosen", r"yugyosen\.com/boat/[a-z]+/c\d+/b(\d+)", stale="unlisted"),
        Adapter("yugyosennavi", r"yugyosen-navi\.com/(?:.*/)?([^/]+)/?$"),
        Adapter("reserver", r"reserver\.co\.jp/guid/([^/]+)", stale="unlisted", types="ガイド"),
        Adapter("smalltables", r"(nikkansports\.com/leisure/fishing|ishiguro-gr\.com/enjoy/funayado|tsuttarou\.info)", shape="table"),
        Adapter("regalt", r"(iwate-yuugyosen\.net|tokyowan-yugyosen\.or\.jp|ogasawaramura\.com|lake-yamanaka\.net|nojiriko-gyokyo\.com|suo-oshima-kanko\.net|amakusa-web\.jp)", stale="list"),
        Adapter("gap01", r"(?:tsurip\.com|magurop\.com|tsuritaro-fishing\.com)/(?:.*/)?([^/]+)/?$", stale="report"),
        Adapter("gap0205", r"sanook-fishing\.com/([^/]+)", shape="table", stale="report"),
        Adapter("gap030406", r"(prdse\.net/fishing-boat|mankitsuya\.jp|m-kankou\.jp|sakata-kankou\.com|yuugyosen\.com)", shape="table", stale="list"),
        Adapter("gap171615", r"navi(?:toyama|niigata|ishikawa)\.com/(?:.*/)?([^/]+)/?$", stale="list"),
        Adapter("gap222324", r"(?:b\.rgr\.jp/d|soitoshigyokyo|oigawako-gyokyo|j-office\.jp|minamichita-kk|imakey-fishing).*?([a-z]+)(?:\.s?html?|/)?$", shape="table", stale="list"),
        Adapter("gap25", r"(pref\.shiga\.lg\.jp|micbassclub\.com|biwamasu-pro\.com)", shape="table", stale="list"),
        Adapter("gap353432", r"(kankou-hamada|best-fishing-tackle|ononavi|e-oki)", shape="headings", keys={"name": "(丸|号|渡船|遊漁)$", "area": "^.{2,3}[都道府県]"}, stale="list"),
        Adapter("gap404344", r"t-island\.jp/spot/(\d+)", stale="list"),
        Adapter("gap4241", r"(goto\.nagasaki-tabinet\.com|tsushima-net\.org)", shape="nuxt", keys={"name": "title", "address": "address", "tel": "tel", "comment": "body", "website": "url", "price": "price"}),
        Adapter("gap4645", r"(beppu-fishing\.co\.jp|koshikijima\.net|books-nekoya\.jp)", shape="headings", keys={"name": "(丸|号|渡船|遊漁)$", "area": "^.{2,3}[都道府県]"}, stale="list"),
        Adapter("gap47", r"(zamamitourism\.com|oki-raku\.net|okinawastory\.jp)", shape="objects", keys={"name": "title", "tel": "tel", "address": "address", "website": "link", "comment": "body"}, stale="list"),
    )
}


def read_sources(cached: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Listings of all sources (or of those named) from the cached pages (url, html); pages of one shape are read in one pass."""
    groups: dict[tuple, list[Adapter]] = {}
    for name in sources or ADAPTERS:
        a = ADAPTERS[name]
        groups.setdefault((a.shape, *sorted(a.keys.items())), []).append(a)
    out = None
    for (shape, *_), same in groups.items():
        mine = cached.where(F.col("html").isNotNull() & F.col("url").rlike("|".join(f"(?:{a.page})" for a in same)))
        rows = listings(getattr(same[0], f"_{shape}")(mine), *same)
        out = rows if out is None else out.unionByName(rows)
    return out
