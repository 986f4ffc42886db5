"""Cases of text, name, URL, time and money functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoalmark.functions import embedded, offers, places, ports, text, times, web
from shoalmark.operators import classify, extract, prepare
from . import case

c = F.col


@case(
    ("i int, c string", [(1, "第十八八竜丸"), (2, "釣船　龍丸（大原港）"), (3, "ﾋﾞｯｸﾞﾎﾞｰｲ"), (4, "有限会社 Sea-Star"), (5, None), (6, "第百二十三髙丸"), (7, "つり船 ヱビス丸"), (8, "渡船 第２１ 海・丸")]),
    ddl="i int, plain string, nkey string, search string",
    expected=[
        (1, "第十八八竜丸", "18八竜丸", "第十八八竜丸"), (2, "釣船 龍丸(大原港)", "竜丸", "釣船龍丸大原港"), (3, "ビッグボーイ", "びっぐぼい", "びっぐぼい"), (4, "有限会社 Sea-Star", "seastar", "有限会社seastar"), (5, "", "", ""),
        (6, "第百二十三髙丸", "123高丸", "第百二十三髙丸"), (7, "つり船 ヱビス丸", "えびす丸", "つり船ゑびす丸"), (8, "渡船 第21 海・丸", "21海丸", "渡船第21海丸"),
    ],
)
def name_keys(rows):
    """Composition, kanji ordinals, generic words, variant letters, kana: what names are compared and searched by."""
    return rows.select("i", text.nfkc("c").alias("plain"), text.name_key(c("c")).alias("nkey"), text.search_key(c("c")).alias("search"))


@case(
    ("i int, c string", [(1, "大原漁港"), (2, "大原港"), (3, "大原"), (4, "ｵｵﾊﾗ マリーナ"), (5, "（仮）三角東港"), (6, "浦・港湾"), (7, None)]),
    ddl="i int, pkey string", expected=[(1, "大原"), (2, "大原"), (3, "大原"), (4, "おおはら"), (5, "仮三角東"), (6, "浦"), (7, "")],
)
def port_keys(rows):
    """One suffix of harbours goes, brackets and spaces do, katakana becomes hiragana."""
    return rows.select("i", text.port_key(c("c")).alias("pkey"))


@case(
    ("i int, c string", [(1, "カイマル"), (2, "ヴォヤージュ"), (3, "かいまる"), (4, "ｶｲﾏﾙＡ１"), (5, "ＡＢＣ１２３")]),
    ddl="i int, hira string, kata string, narrow string", expected=[(1, "かいまる", "カイマル", "カイマル"), (2, "ゔぉやーじゅ", "ヴォヤージュ", "ヴォヤージュ"), (3, "かいまる", "カイマル", "かいまる"), (4, "ｶｲﾏﾙＡ１", "ｶｲﾏﾙＡ１", "カイマルA1"), (5, "ＡＢＣ１２３", "ＡＢＣ１２３", "ABC123")],
)
def kana_folds(rows):
    """Katakana to hiragana and back; wide letters and narrow kana by composition."""
    return rows.select("i", text.to_hiragana(c("c")).alias("hira"), text.to_katakana(c("c")).alias("kata"), text.nfkc("c").alias("narrow"))


@case(
    ("i int, c string", [(1, "https://www.example.com/index.html?utm_source=x#top"), (2, "http://ameblo.jp/Boat/entry.html"), (3, "https://user@a.jp:80/Boats/list"), (4, "mailto:x"), (5, "https://www.fishing-v.jp/choka/123"), (6, "https://peraichi.com/landing_pages/view/x"), (7, "https://hp.gogo.jp/A.b/"), (8, "http://x.jp/a.html"), (9, "https://www.chowari.jp/ship/1"), (10, "https://theboat.jp/boats/1"), (11, "https://www.instagram.com/umi/")]),
    ddl="i int, site string, kind string",
    expected=[(1, "example.com", "official"), (2, "ameblo.jp/boat", "official"), (3, "a.jp/boats", "official"), (4, None, None), (5, "fishing-v.jp/choka", "portal"), (6, "peraichi.com/landing_pages", "official"), (7, "hp.gogo.jp/a.b", "official"), (8, "x.jp", "official"), (9, "chowari.jp/ship", "portal"), (10, "theboat.jp/boats", "portal"), (11, "instagram.com/umi", "sns")],
)
def site_keys_and_classes(rows):
    """Which site a URL belongs to, on shared hosts too, and whether it is a network, a portal or someone's own."""
    return rows.select("i", web.site_key(c("c")).alias("site"), web.url_class(c("c")).alias("kind"))


@case(
    ("i int, website string, sns array<string>", [(1, "https://x.com/umi", ["https://www.instagram.com/umi/", "https://example.com/"]), (2, "https://profile.ameba.jp/ameba/umi-maru", []), (3, "https://www.tsurimaru.jp/boat/1", ["https://lin.ee/a", "https://lin.ee/a"]), (4, "https://umi.jp/contact/form.html", None), (5, "https://www.instagram.com/p/ABC/", None), (6, "https://umi.jp/logo.png", None)]),
    ddl="i int, website string, sns array<string>, root string, asset boolean",
    expected=[
        (1, None, ["https://www.instagram.com/umi/", "https://x.com/umi"], "https://x.com/umi", False), (2, "https://ameblo.jp/umi-maru/", [], "https://profile.ameba.jp/ameba/umi-maru", False), (3, None, ["https://lin.ee/a"], "https://www.tsurimaru.jp/boat/1", False),
        (4, "https://umi.jp/contact/form.html", [], "https://umi.jp/", False), (5, None, ["https://www.instagram.com/p/ABC/"], "https://www.instagram.com/p/ABC/", False), (6, "https://umi.jp/logo.png", [], "https://umi.jp/logo.png", True),
    ],
)
def links_of_listings(rows):
    """Own sites, networks and portals told apart; profiles of blogs become blogs; forms give their site, posts no profile."""
    picked = web.own_links(c("website"), c("sns"))
    return rows.select("i", picked["website"].alias("website"), picked["sns"].alias("sns"), web.root_of_form(c("website")).alias("root"), web.is_asset(c("website")).alias("asset"))


@case(
    ("i int, c string, t string", [(1, "https://www.instagram.com/umi_maru/?hl=ja", "x"), (2, "https://instagram.com/p/XYZ/", "海丸(@umi.maru)の投稿"), (3, "https://www.instagram.com/reel/1/", None), (4, "https://example.com/umi", ""), (5, "https://www.instagram.com/explore/", "")]),
    ddl="i int, profile string", expected=[(1, "https://www.instagram.com/umi_maru/"), (2, "https://www.instagram.com/umi.maru/"), (3, None), (4, None), (5, None)],
)
def instagram_profiles(rows):
    """The profile behind a link to a network; posts and pages of the network have none."""
    return rows.select("i", web.instagram_profile(c("c"), c("t")).alias("profile"))


@case(
    ("i int, c string", [(1, "真鯛、アジ・青物など"), (2, "アコウ(キジハタ) ヒラメ"), (3, "ジギング/タイラバ"), (4, "スルメ、いか、アジ3匹"), (5, "五目釣り 五目"), (6, "タチウオ狙い,タチ"), (7, "シロギス釣り 鱚"), (8, "とてもとてもとても長い名前"), (9, "謎魚(鯛)")]),
    ddl="i int, fish array<string>",
    expected=[(1, ["マダイ", "アジ", "青物"]), (2, ["キジハタ", "ヒラメ"]), (3, []), (4, ["スルメイカ", "イカ"]), (5, ["五目釣り"]), (6, ["タチウオ"]), (7, ["シロギス"]), (8, []), (9, ["マダイ"])],
)
def fish_synonyms(rows):
    """Fish by their canonical names; methods, counts and long phrases go, endings too."""
    return rows.select("i", embedded.fish_list(text.nfkc("c")).alias("fish"))


@case(
    ("i int, c string", [(1, "大人・子供、シニア／幼児"), (2, "アジ（20cm、30cm）、サバ"), (3, "a, b, a"), (4, "この項目はとても長いのでこれは三十文字を超えてしまうのです本当に、短い")]),
    ddl="i int, items array<string>, outside array<string>",
    expected=[(1, ["大人・子供", "シニア", "幼児"], ["大人・子供", "シニア", "幼児"]), (2, ["アジ（20cm", "30cm）", "サバ"], ["アジ（20cm、30cm）", "サバ"]), (3, ["a", "b"], ["a", "b"]), (4, ["短い"], ["短い"])],
)
def lists_in_texts(rows):
    """Items of lists, with and without regard to brackets."""
    return rows.select("i", text.split_list(c("c")).alias("items"), text.split_outside_brackets(c("c")).alias("outside"))


@case(
    ("i int, c string", [(1, "乗合船"), (2, "貸切・乗り合い"), (3, "磯渡しと筏"), (4, "貸ボート"), (5, "バスガイド"), (6, "その他")]),
    ddl="i int, kinds array<string>", expected=[(1, ["乗合"]), (2, ["乗合", "仕立"]), (3, ["渡船"]), (4, ["レンタルボート"]), (5, ["ガイド"]), (6, [])],
)
def kinds_in_texts(rows):
    """The kinds that a text names, in the order of the patterns."""
    return rows.select("i", text.kinds_of(c("c")).alias("kinds"))


@case(
    ("i int, c string", [(1, "海丸（うみまる）"), (2, "山丸"), (3, "星丸 (ほし まる) "), (4, "波丸（なみ3号）")]),
    ddl="i int, name string, kana string", expected=[(1, "海丸", "うみまる"), (2, "山丸", None), (3, "星丸", "ほし まる"), (4, "波丸（なみ3号）", None)],
)
def readings_of_names(rows):
    """A name and the kana that it ends with in brackets."""
    return rows.select("i", text.reading_of(c("c")).alias("r")).select("i", "r.name", "r.kana")


@case(
    ("i int, c string", [(1, "釣れます。私がご案内します。広い船です。"), (2, "一二三四五六七八九十一二三四五六七八九十。"), (3, "")]),
    ddl="i int, s string", expected=[(1, "釣れます。広い船です。"), (2, "一二三四五六七八九十一二三四…"), (3, "")],
)
def summaries(rows):
    """The sentences of a description without those of its owner, cut at a length."""
    return rows.select("i", text.summary(c("c"), 15).alias("s"))


@case(
    ("i int, c string, names array<string>", [(1, "船長 山田太郎 の船", ["山田太郎", "林"]), (2, "林の海", ["山田太郎", "林"]), (3, "山田 太郎", ["山田太郎"]), (4, None, ["山田太郎"])]),
    ddl="i int, v string", expected=[(1, None), (2, "林の海"), (3, None), (4, None)],
)
def personal_names_removed(rows):
    """A text goes if it holds a personal name of three letters or more, white space aside."""
    return rows.select("i", text.without_names(c("c"), c("names")).alias("v"))


@case(
    ("i int, c string", [(1, "千葉県いすみ市大原1"), (2, "神奈川県横浜市中区本町"), (3, "東京都江戸川区西葛西"), (4, "千葉県夷隅郡御宿町1"), (5, "大原"), (6, "北海道古宇郡泊村2"), (7, "東京都八丈町大賀郷"), (8, "千葉県市川市1"), (9, "三重県四日市市富双"), (10, "広島県廿日市市地御前")]),
    ddl="i int, city string", expected=[(1, "いすみ市"), (2, "横浜市中区"), (3, "江戸川区"), (4, "夷隅郡御宿町"), (5, None), (6, "古宇郡泊村"), (7, "八丈町"), (8, "市川市"), (9, "四日市市"), (10, "廿日市市")],
)
def cities_of_addresses(rows):
    """The city, ward, or county town of an address; names that hold the sign of a city are whole."""
    return rows.select("i", places.city_of(c("c")).alias("city"))


@case(
    ("i int, address string, pref string, city string, port string", [(1, "〒298-0004 いすみ市大原123-4", "千葉県", "いすみ市", "大原漁港"), (2, None, "千葉県", "千葉県館山市", None), (3, "千葉県館山市 館山1-2 ビル", "千葉県", None, "x"), (4, None, None, None, "x")]),
    ddl="i int, q array<string>",
    expected=[(1, ["千葉県いすみ市大原123-4", "千葉県いすみ市大原", "千葉県いすみ市大原漁港", "千葉県いすみ市"]), (2, ["千葉県館山市"]), (3, ["千葉県館山市"]), (4, [])],
)
def geocoder_queries(rows):
    """What to look up for a place, the most exact first."""
    return rows.select("i", places.address_queries(c("address"), c("pref"), c("city"), c("port")).alias("q"))


@case(
    ("i int, a string, b string, d string", [(1, None, "千葉県", "千葉県"), (2, "東京都", "千葉県", None), (3, None, None, None)]),
    ddl="i int, area string, conflict boolean", expected=[(1, "千葉県", False), (2, "東京都", True), (3, None, False)],
)
def areas_of_signals(rows):
    """The most trusted of several signals of an area, and whether they differ."""
    return rows.select("i", places.area_of_signals(c("a"), c("b"), c("d")).alias("s")).select("i", "s.area", "s.conflict")


@case(
    ("i int, c string", [(1, "千葉県いすみ市大原漁港 駐車場あり"), (2, "大洗町磯浜町大洗港"), (3, "東京都港区芝浦"), (4, "育波育波漁港"), (5, "北係留場館山港"), (6, "関西空港近く"), (7, "漁港"), (8, "シーサイドマリーナ")]),
    ddl="i int, port string", expected=[(1, "大原漁港"), (2, "大洗港"), (3, None), (4, "育波漁港"), (5, "館山港"), (6, None), (7, None), (8, "シーサイドマリーナ")],
)
def ports_in_texts(rows):
    """The first harbour that a text names, without the towns before it; wards and airports aren't harbours."""
    return rows.select("i", ports.port_in(c("c")).alias("port"))


@case(
    ("i int, areas array<string>, shown string", [(1, ["千葉県", "外房", "勝浦・大原港"], "大原（いすみ）"), (2, ["千葉県"], "港 （仮） "), (3, ["東京湾・横浜"], ""), (4, [], None)]),
    ddl="i int, port string, shown string", expected=[(1, "大原港", "大原"), (2, "", "港"), (3, "東京湾", None), (4, "", None)],
)
def ports_of_areas(rows):
    """The port of a listing's last area, and a port's name without what stands in brackets behind it."""
    return rows.select("i", ports.port_of_areas(c("areas")).alias("port"), ports.plain_port(c("shown")).alias("shown"))


@case(
    ("i int, c string", [(1, "更新 2025年1月2日"), (2, "2025/2/30"), (3, "2024-12-31 まで"), (4, "未定")]),
    ddl="i int, d date", expected=[(1, "2025-01-02"), (2, None), (3, "2024-12-31"), (4, None)],
)
def dates_in_texts(rows):
    """The first date of a text; days that don't exist are none."""
    return rows.select("i", embedded.iso_date(c("c")).alias("d"))


@case(
    ("i int, last string, modified string", [(1, "2025-03-14", "2021-09-15"), (2, "2025-03-15", "2021-09-14"), (3, "", None), (4, None, "2026-01-01")]),
    ddl="i int, stale boolean, old boolean", expected=[(1, True, False), (2, False, True), (3, True, True), (4, True, False)],
)
def stale_by_date(rows):
    """Records without a report since a day, and without a change in five years of another."""
    return rows.select("i", times.before_day(c("last"), "2025-03-15").alias("stale"), times.years_before(c("modified"), "2026-09-15", 5).alias("old"))


@case(
    ("i int, c string", [(1, "午前5時半出船 午後1時帰港"), (2, "所要4時間 6:00~"), (3, "25時集合"), (4, "30:00"), (5, "1/6:00"), (6, "PM3:15"), (7, "6時75分")]),
    ddl="i int, times array<string>", expected=[(1, ["05:30", "13:00"]), (2, ["06:00"]), (3, ["25:00"]), (4, []), (5, []), (6, ["15:15"]), (7, [])],
)
def times_in_texts(rows):
    """Times of day: halves, words of the afternoon, hours beyond midnight; durations and dates are none."""
    return rows.select("i", times.times_in(c("c")).alias("times"))


@case(
    ("i int, c string", [(1, "集合4:30、出船5:00、帰港12:00"), (2, "5:00~11:30"), (3, "5:00~6:00出船"), (4, "23:00~5:00"), (5, "受付は5時から、出港は6時、沖上がりは13時"), (6, "日の出~11:00"), (7, "6:00 13:00"), (8, "定休日")]),
    ddl="i int, depart string, back string, meet string",
    expected=[(1, "05:00", "12:00", "04:30"), (2, "05:00", "11:30", None), (3, "05:00", None, None), (4, "23:00", "05:00", None), (5, "06:00", "13:00", "05:00"), (6, None, "11:00", None), (7, "06:00", None, None), (8, None, None, None)],
)
def departures_and_returns(rows):
    """Which time is when one meets, departs and returns, by the words around it; short ranges are departures, nights wrap."""
    return rows.select("i", times.assigned(c("c")).alias("t")).select("i", "t.depart", "t.back", "t.meet")


@case(
    ("i int, c string", [(1, "集合 5:50 7:00～12:00"), (2, "3:00～6:00"), (3, "午前便 6:00 午後便 13:00"), (4, "春夏 5:00 冬 6:00")]),
    ddl="i int, trips array<string>", expected=[(1, ["07:00-12:00"]), (2, ["03:00-"]), (3, ["06:00-", "13:00-"]), (4, ["05:00-"])],
)
def trips_of_departures(rows):
    """Trips of a column of departures: ranges of four hours or more have a return, and each trip named so is one."""
    return rows.select("i", times.trips(c("c")).alias("trips"))


@case(
    ("i int, c string", [(1, "大人12,000円 女性 9,000円"), (2, "1人/9000~10000円(税込)"), (3, "¥8,000 〜 ¥9,500"), (4, "10号 300g 5,500円"), (5, "1万2千円、仕立6万円"), (6, "料金応談")]),
    ddl="i int, n int, before string, amount int, behind string",
    expected=[(1, 0, "大人", 12000, ""), (1, 1, "女性", 9000, ""), (2, 0, "1人/", 9000, "(税込)"), (3, 0, "", 8000, "〜 ¥9,500"), (4, 0, "10号 300g", 5500, ""), (5, 0, "", 12000, ""), (5, 1, "、仕立", 60000, "")],
)
def amounts_of_lines(rows):
    """Every amount of a line with what stands before and behind it; a range is its lower bound."""
    return extract.segments(rows, "i", "c")


@case(
    ("i int, price int, hhmm string", [(1, 15000, "05:30"), (2, 9000, "13:00"), (3, 20000, "00:00"), (4, 14500, "12:15")]),
    ddl="i int, price_forms array<string>, some_times array<string>",
    expected=[
        (1, ["15000", "15,000", "1万5千", "1.5万", "1万5000", "一万五千"], ["05:30", "29:30", "5:30AM", "5時半"]), (2, ["9000", "9,000", "9千", "九千"], ["13:00", "1時帰港", "PM1:00", "午後1時"]), (3, ["20000", "20,000", "2万", "二万"], ["00:00", "0:00AM", "24時", "午前0時"]),
        (4, ["14500", "14,500", "1万4500"], ["0:15PM", "12:15", "12時15分", "午後0:15"]),
    ],
)
def ways_of_writing(rows):
    """How prices and times may be written; of the times a few that show each way."""
    some = F.array(*map(F.lit, ("05:30", "29:30", "5:30AM", "5時半", "13:00", "1時帰港", "PM1:00", "午後1時", "00:00", "0:00AM", "24時", "午前0時", "0:15PM", "12:15", "12時15分", "午後0:15", "99時")))
    return rows.select("i", offers.price_forms(c("price")).alias("price_forms"), F.array_sort(F.array_intersect(offers.time_forms(c("hhmm")), some)).alias("some_times"))


@case(
    ("key string, n int, price int, depart string", [("s", 1, 9000, "05:30"), ("s", 2, 15000, None), ("s", 3, 7000, None), ("s", 4, None, "13:00"), ("s", 5, 63000, None), ("s", 6, None, "06:00"), ("s", 7, None, "17:00"), ("s", 8, None, "03:00"), ("t", 1, 9000, None)]),
    ("key string, text string", [("s", "乗合 9千円 出船5時半、仕立は1万5千円 午後1時 ¥6,3000 5~6時出港 午後 _ 13~17時"), ("t", "料金 19000円")]),
    ddl="key string, n int, price_unstated boolean, time_unstated boolean", expected=[("s", 3, True, False), ("s", 8, False, True)],
)
def claims_and_texts(claims, texts):
    """Claims that their text doesn't state; misplaced separators and ends of ranges count."""
    return prepare.false_claims(claims, texts, "key")


@case(
    ("i int, name string, price_text string, price int, kind string, ferry boolean", [
        (1, "乗合", "大人 9,000円", 9000, "乗合", False), (2, "プラン", "レンタル竿 3,000円", 3000, None, False), (3, "プラン", "エサ付き 9,000円", 9000, None, False), (4, "プラン", "小学生 6,000円", 6000, "乗合", False), (5, "渡船 磯", "磯 2,000円", 2000, "渡船", False),
        (6, "半日", "1,500円", 1500, None, False), (7, "【仮眠部屋】", "3,000円", 3000, None, False), (8, "波止変え", "1,500円", 1500, None, True), (9, "3名の場合は", "1人12,000円", 12000, None, False), (10, "半日", "1,500円", 1500, None, True), (11, "ジギング", "1,000円", 1000, None, True), (12, "釣り場", "2,000円", 2000, "ガイド", False),
        (13, "筏", "9,000円", 9000, None, False), (14, "磯 利用者は", "4,000円", 4000, "渡船", False),
    ]),
    ddl="i int, junk boolean", expected=[(1, False), (2, True), (3, False), (4, True), (5, False), (6, True), (7, True), (8, True), (9, False), (10, False), (11, True), (12, False), (13, False), (14, True)],
)
def amounts_that_are_no_fares(rows):
    """Gear, options, children, small fees, ferries and sums too small: each branch of the rule."""
    return rows.select("i", offers.junk_offer(c("name"), c("price_text"), c("price"), c("kind"), c("ferry")).alias("junk"))


@case(
    ("i int, raw string", [(1, "【午前便】"), (2, "アジ釣りコース"), (3, "出船は6:00です"), (4, "大人 9,000円"), (5, "料金："), (6, "※雨天中止"), (7, "どなたでも楽しめます。"), (8, "A | B"), (9, "（夜のみ）"), (10, "この行は三十二文字を超える長い行なので見出しにはならないと決められているはずです"), (11, "【釣れます。】")]),
    ddl="i int, header boolean", expected=[(1, True), (2, True), (3, False), (4, False), (5, False), (6, False), (7, False), (8, False), (9, False), (10, False), (11, True)],
)
def headings_in_texts(rows):
    """Which lines of free text are headings."""
    line = text.nfkc("raw")
    plain = rows.withColumn("line", line)
    return plain.select("i", classify.header_line(c("raw"), c("line"), offers.amounts(c("line")), times.times_in(c("line"))).alias("header"))


@case(
    ("i int, label string", [(1, "乗合料金(税込)："), (2, "大人1名の"), (3, "平日・貸切"), (4, "アジ船 利用料金"), (5, "= 割引"), (6, "午前（4名まで")]),
    ddl="i int, plain string, generic boolean", expected=[(1, "乗合", True), (2, "大人1名", True), (3, "平日・貸切", True), (4, "アジ船", False), (5, "", True), (6, "午前（4名まで", False)],
)
def labels_of_amounts(rows):
    """Labels of amounts without what all of them say, and whether they name a kind, people or days only."""
    plain = rows.withColumn("plain", classify.plain_label(c("label")))
    return plain.select("i", "plain", classify.generic_label(c("plain")).alias("generic"))


@case(
    ("i int, c string", [(1, "12,000円"), (2, "３５"), (3, "なし"), (4, None), (5, "12a5")]),
    ddl="i int, n bigint, x double", expected=[(1, 12000, None), (2, 35, 35.0), (3, None, None), (4, None, None), (5, 125, None)],
)
def safe_casts(rows):
    """The number of a text's digits, and texts that are numbers; null otherwise."""
    plain = rows.withColumn("c", F.nullif(text.nfkc("c"), F.lit("")))
    return plain.select("i", text.digits_only(c("c")).alias("n"), c("c").try_cast("double").alias("x"))


@case(
    ("i int, c string", [(1, "ライトアジとアジ、タイラバで真鯛"), (2, "タイとヒラメ"), (3, "イカタコ")]),
    ddl="i int, masked array<string>, whole array<string>", expected=[(1, ["ライトアジ", "アジ", "タイ", "真鯛"], ["ライトアジ", "アジ", "真鯛"]), (2, ["タイ", "ヒラメ"], ["タイ", "ヒラメ"]), (3, ["イカ", "タコ"], [])],
)
def vocabularies_masked_and_whole(rows):
    """Words of a vocabulary by priority, and as whole runs of katakana."""
    words = ["ライトアジ", "アジ", "タイ", "ヒラメ", "イカ", "タコ", "真鯛"]
    return rows.select("i", embedded.vocabulary_masked(c("c"), words).alias("masked"), embedded.vocabulary_whole(c("c"), words).alias("whole"))
