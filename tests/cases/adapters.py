"""Cases of the adapters of sources: made pages of each shape, and one page for each source."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shoalmark.sources import adapters
from . import case

c = F.col
_PAGE = "url string, html string"


def _facts(name: str, n: int) -> str:
    return f"<h1>x</h1><dl><dt>船名</dt><dd>{name}</dd><dt>電話番号</dt><dd>03-1234-{n:04d}</dd></dl><table><tr><th>住所</th><td>千葉県いすみ市大原{n}</td></tr></table>"


def _table(name: str, n: int) -> str:
    return f"<table><tr><th>船名<th>電話<th>住所</tr><tr><td>{name}<td>03-1234-{n:04d}<td>千葉県いすみ市大原{n}</tr></table>"


def _headings(name: str, n: int) -> str:
    return f"<h2>千葉県いすみ市大原{n}</h2><h3>{name}</h3><p>電話：03-1234-{n:04d}</p>"


def _nuxt(name: str, n: int) -> str:
    item = {"title": 3, "tel": 4, "address": 5}
    return f'<script type="application/json" id="__NUXT_DATA__">{json.dumps([{"items": 1}, [2], item, name, f"03-1234-{n:04d}", f"千葉県いすみ市大原{n}"], ensure_ascii=False)}</script>'


def _objects(name: str, n: int) -> str:
    return "x=" + json.dumps({f"00000000-0000-0000-0000-{n:012d}": {"title": name, "tel": f"03-1234-{n:04d}", "address": f"千葉県いすみ市大原{n}"}}, ensure_ascii=False, separators=(",", ":"))


# One page of each source, by the source's own addresses, and the id that its listing has.
_PAGES = {
    "chowari": ("https://www.chowari.jp/ship/123/", "123"), "castingnet": ("https://reserve.castingnet.jp/detail.php?p=55", "55"), "fishingv": ("https://www.fishing-v.jp/choka/choka_detail.php?s=77", "77"), "funaduri": ("https://funaduri.jp/boat/umi", "umi"), "theboat": ("https://theboat.jp/boats/umi", "umi"),
    "tsuree": ("https://tsuree.jp/boats/detail/9", "9"), "tsurimaru": ("https://tsurimaru.jp/boat/8/", "8"), "tsurisoku": ("https://www.tsurisoku.com/f/umi", "umi"), "tsuriyaro": ("https://fishing-station.jp/umi/", "umi"), "point": ("https://www.point-i.jp/boats/7", "7"), "gurenavi": ("https://gurenavi.jp/chiba", "chiba:0-1"),
    "yugyosen": ("https://yugyosen.com/boat/chiba/c1/b22", "22"), "yugyosennavi": ("https://yugyosen-navi.com/boats/umi/", "umi"), "reserver": ("https://reserver.co.jp/guid/umi/", "umi"), "smalltables": ("https://tsuttarou.info/", "tsuttarou.info:0-1"), "regalt": ("https://iwate-yuugyosen.net/member/a", "iwate-yuugyosen.net"), "gap01": ("https://tsurip.com/umi/", "umi"),
    "gap0205": ("https://sanook-fishing.com/boat-aomori-buri/", "boat-aomori-buri:0-1"), "gap030406": ("https://prdse.net/fishing-boat/", "prdse.net/fishing-boat:0-1"), "gap171615": ("https://navitoyama.com/tsuribune/umi/", "umi"), "gap222324": ("https://b.rgr.jp/d/sz.shtml", "sz:0-1"), "gap25": ("https://www.micbassclub.com/guide.php", "micbassclub.com:0-1"),
    "gap353432": ("https://kankou-hamada.or.jp/content/fishing/", "kankou-hamada:1"), "gap404344": ("https://www.t-island.jp/spot/31", "31"), "gap4241": ("https://goto.nagasaki-tabinet.com/fishing/", "goto.nagasaki-tabinet.com:0"), "gap4645": ("http://www.koshikijima.net/fishing/fishing-boat.html", "koshikijima.net:1"), "gap47": ("https://www.zamamitourism.com/activities", "zamamitourism.com:00000000-0000-0000-0000-000000000026"),
}
_SHAPES = {"facts": _facts, "table": _table, "headings": _headings, "nuxt": _nuxt, "objects": _objects}


@case(
    (_PAGE, [(_PAGES[s][0], _SHAPES[a.shape](f"第{n}海丸", n)) for n, (s, a) in enumerate(adapters.ADAPTERS.items())]),
    ddl="src string, src_id string, name string, tel string, pref string, city string", expected=[(s, _PAGES[s][1], f"第{n}海丸", f"03-1234-{n:04d}", "千葉県", "いすみ市") for n, s in enumerate(adapters.ADAPTERS)],
)
def every_source_read(cached):
    """A page of each of the 27 sources, read by its adapter alone."""
    return adapters.read_sources(cached).select("src", "src_id", "name", "tel", "pref", "city")


_LABELLED = """<html><head><title>t</title></head><body><h1>海丸（うみまる）</h1><table><tr><th>出港地</th><td>いすみ市 大原漁港</td></tr><tr><th>TEL</th><td>0470(62)1234</td></tr></table>
<dl><dt>住所</dt><dd>〒298-0004 千葉県いすみ市大原1-2</dd><dt>釣り物</dt><dd>マダイ、アジ</dd><dt>定員</dt><dd>最大12名</dd></dl><p>【定休日】火曜</p><p>公式サイト：https://umi.jp/contact/</p>
<div>料金</div><ul><li>乗合 大人 9,000円 5:00~11:30</li><li>レンタル竿 1,000円</li><li>仕立 6名まで 60,000円</li></ul><div>船長より</div><p>釣れます。私がご案内します。</p><div>関係のない見出し | x</div></body></html>"""


@case(
    (_PAGE, [("https://theboat.jp/boats/umi", _LABELLED), ("https://theboat.jp/boats/test", "<h1>テスト船</h1>"), ("https://theboat.jp/about", _LABELLED), ("https://theboat.jp/boats/empty", None)]),
    ddl="src_id string, name string, kana string, port string, tel string, address string, city string, targets string, capacity int, holidays string, website string, types string, description string, plans string",
    expected=[("umi", "海丸", "うみまる", "大原漁港", "0470-62-1234", "千葉県いすみ市大原1-2", "いすみ市", "マダイ,アジ", 12, "火曜", "https://umi.jp/", "乗合,仕立", "釣れます。", "乗合 9000 05:00 11:30,仕立 60000")],
)
def pages_of_labels(cached):
    """Labels in tables, lists, lines and headings, and the offers of the lines below a label."""
    out = adapters.ADAPTERS["theboat"].read(cached)
    plan = F.transform("plans", lambda p: F.concat_ws(" ", p["kind"], p["price"].cast("string"), p["depart"], p["return"]))
    return out.select("src_id", "name", "kana", "port", "tel", "address", "city", F.array_join("targets", ",").alias("targets"), "capacity", "holidays", "website", F.array_join("types", ",").alias("types"), "description", F.array_join(plan, ",").alias("plans"))


@case(
    (_PAGE, [("https://gurenavi.jp/chiba", "<table><tr><th>船名<th>港名<th>電話<th>料金<th>出船時間<th>?</tr><tr><td rowspan=2>海丸<td>大原港<td>03-1111-2222<td>乗合 9,000円/人<td>5:00~12:00<td>x</tr><tr><td>勝浦港<td>なし<td>仕立 60,000円<td><td></tr><tr><td>海釣り公園<td>大原港<td><td><td><td></tr></table>")]),
    ddl="src_id string, name string, port string, tel string, plans string", expected=[("chiba:0-1", "海丸", "大原港", "03-1111-2222", "乗合 9000 05:00"), ("chiba:0-2", "海丸", "勝浦港", None, "仕立 60000")],
)
def tables_by_header(cached):
    """Rows of a table by its header, with spans; names that are no boats' are left out."""
    out = adapters.ADAPTERS["gurenavi"].read(cached)
    return out.select("src_id", "name", "port", "tel", F.array_join(F.transform("plans", lambda p: F.concat_ws(" ", p["kind"], p["price"].cast("string"), p["depart"])), ",").alias("plans"))


@case(
    (_PAGE, [("https://kankou-hamada.or.jp/content/fishing/", "<p>案内</p><h2>島根県浜田市</h2><h3>海丸</h3><p>電話：0855-11-2222</p><p>定員：8名</p><h3>山丸</h3><p>電話：0855-33-4444</p><h2>島根県益田市</h2><h3>第三星丸</h3><p>備考：静か。</p>")]),
    ddl="src_id string, name string, pref string, city string, tel string, capacity int, description string", expected=[("kankou-hamada:2", "海丸", "島根県", "浜田市", "0855-11-2222", 8, None), ("kankou-hamada:5", "山丸", "島根県", "浜田市", "0855-33-4444", None, None), ("kankou-hamada:8", "第三星丸", "島根県", "益田市", None, None, "静か。")],
)
def entries_below_headings(cached):
    """Entries below headings of areas, with the labelled lines below each."""
    return adapters.ADAPTERS["gap353432"].read(cached).select("src_id", "name", "pref", "city", "tel", "capacity", "description")


@case(
    ("src_id string, last_report string", [("1", "2025-04-01"), ("2", "2025-01-01"), ("3", None)]), ("src_id string", [("1",), ("2",)]), ("n int", [(2,)]), ("n int", [(3,)]),
    ddl="rule string, src_id string, stale boolean",
    expected=[("report", "1", False), ("report", "2", True), ("report", "3", True), ("unlisted", "1", False), ("unlisted", "2", False), ("unlisted", "3", True), ("incomplete", "1", False), ("incomplete", "2", False), ("incomplete", "3", True), ("lacking", "1", False), ("lacking", "2", False), ("lacking", "3", False), ("none", "1", False), ("none", "2", False), ("none", "3", False)],
)
def stale_by_source(rows, listed, announced, more):
    """How each source shows that a listing is past."""
    rows = rows.withColumn("stale", F.lit(False))
    of = {"report": ("fishingv", announced), "unlisted": ("point", announced), "incomplete": ("tsurimaru", announced), "lacking": ("tsurimaru", more), "none": ("chowari", announced)}
    parts = [adapters.marked_stale(rows, adapters.ADAPTERS[a], listed, n).select(F.lit(rule).alias("rule"), "src_id", "stale") for rule, (a, n) in of.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
