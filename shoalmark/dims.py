"""Dimension tables of the directory: prefectures, regions, kinds, hosts, synonyms.  All are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 47 prefectures in code order (code = place, from 1).
PREFS = (
    "北海道 青森県 岩手県 宮城県 秋田県 山形県 福島県 茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県 新潟県 富山県 石川県 福井県 山梨県 長野県 岐阜県 静岡県 愛知県 三重県 "
    "滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県 鳥取県 島根県 岡山県 広島県 山口県 徳島県 香川県 愛媛県 高知県 福岡県 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県"
).split()

# The kinds of offers, by pattern, in the order in which they are tried.
KINDS = (
    ("乗合|乗り合い|のりあい", "乗合"),
    ("仕立|貸切|貸し切り|チャーター", "仕立"),
    ("渡船|瀬渡|磯渡|筏|いかだ|カセ", "渡船"),
    ("レンタルボート|貸しボート|貸ボート", "レンタルボート"),
    ("ガイド", "ガイド"),
)

# Bits of the published flags.
FLAGS = {"PLANS": 1, "WEB": 2, "BOOK": 4, "NORIAI": 8, "SHITATE": 16, "TOSEN": 32, "REG": 64, "APPROX": 128, "LISTED": 256}

# Words that names of operators share, dropped from name keys.
GENERIC_WORDS = "株式会社 有限会社 合同会社 合資会社 一般社団法人 (株) (有) (同) 釣り船 釣船 つり船 つりぶね 遊漁船 遊漁 船宿 釣宿 渡船 瀬渡し 釣り宿".split()
# Variant characters and the ones that stand for them in name keys.
VARIANTS = ("龍﨑嵜髙濵濱澤嶋嶌邊邉廣冨眞惠榮國ゑゐゖゕ○◯", "竜崎崎高浜浜沢島島辺辺広富真恵栄国えいけか〇〇")

# Hosts of networks, and hosts on which many sites live.
SNS_HOSTS = "facebook.com fb.com instagram.com twitter.com x.com line.me lin.ee youtube.com youtu.be tiktok.com threads.net".split()
SHARED_HOSTS = (
    "ameblo.jp fc2.com blog.goo.ne.jp wixsite.com jimdo.com jimdofree.com jimdosite.com blogspot.com hatenablog.com hatenablog.jp plala.or.jp biglobe.ne.jp ocn.ne.jp sakura.ne.jp select-type.com "
    "livedoor.jp livedoor.blog seesaa.net exblog.jp crayonsite.net goope.jp shopinfo.jp business.site peraichi.com xrea.com nifty.com so-net.ne.jp dion.ne.jp coocan.jp eonet.ne.jp odn.ne.jp "
    "infoseek.co.jp blogs.yahoo.co.jp note.com wordpress.com weebly.com studio.site webnode.jp on.omisenomikata.jp hp.gogo.jp fishing-v.jp rakuten.ne.jp mapion.co.jp"
).split()
# Hosts of listing portals, maps and booking sites, whose pages are no one's own site.
PORTAL_HOSTS = (
    "chowari.jp tsuree.jp theboat.jp castingnet.jp funaduri.jp fishing-v.jp kanpari.jp google.com google.co.jp goo.gl maps.app.goo.gl yahoo.co.jp asoview.com jalan.net rakuten.co.jp airtrip.jp veltra.com tabelog.com "
    "fishing-station.jp tsurimaru.jp yugyosen.com yugyosen-navi.com point-i.jp gurenavi.jp"
).split()
# Sites that report catches, with their names on buttons.
CATCH_SITES = {
    "fishing-v.jp": "釣りビジョン", "funaduri.jp": "船釣り.jp", "theboat.jp": "THE BOAT", "tsurimaru.jp": "つり丸", "anglers.jp": "アングラーズ", "chowari.jp": "釣割", "tsuree.jp": "つりー", "point-i.jp": "釣具のポイント",
    "tsurisoku.com": "つりそく", "gyo.ne.jp": "釣果情報", "turi-ba.com": "釣り場",
}
# Parts of hosts of networks, with their names on buttons, in the order in which they are tried.
SNS_NAMES = {
    "instagram": "Instagram", "facebook": "Facebook", "fb.com": "Facebook", "twitter": "X", "x.com": "X", "youtube": "YouTube", "youtu.be": "YouTube", "tiktok": "TikTok", "threads": "Threads", "line.me": "LINE", "lin.ee": "LINE",
}

# Spellings of fish and their canonical names; methods of fishing are no fish.
FISH = {
    "真鯛": "マダイ", "鯛": "マダイ", "タイ": "マダイ", "まだい": "マダイ", "真だい": "マダイ", "鯵": "アジ", "鰺": "アジ", "あじ": "アジ", "マアジ": "アジ", "真アジ": "アジ", "ライトアジ": "アジ", "太刀魚": "タチウオ", "たちうお": "タチウオ", "タチ": "タチウオ",
    "鰤": "ブリ", "ぶり": "ブリ", "平政": "ヒラマサ", "間八": "カンパチ", "鰆": "サワラ", "鮃": "ヒラメ", "ひらめ": "ヒラメ", "鰈": "カレイ", "かれい": "カレイ", "マコガレイ": "カレイ", "烏賊": "イカ", "いか": "イカ", "スルメ": "スルメイカ", "鯣烏賊": "スルメイカ", "障泥烏賊": "アオリイカ",
    "剣先イカ": "ケンサキイカ", "マルイカ": "ケンサキイカ", "墨イカ": "コウイカ", "スミイカ": "コウイカ", "蛸": "タコ", "たこ": "タコ", "真蛸": "マダコ", "飯蛸": "イイダコ", "鯖": "サバ", "さば": "サバ", "鱚": "シロギス", "キス": "シロギス", "きす": "シロギス", "甘鯛": "アマダイ", "あまだい": "アマダイ",
    "鬼カサゴ": "オニカサゴ", "笠子": "カサゴ", "眼張": "メバル", "鱸": "シーバス", "スズキ": "シーバス", "すずき": "シーバス", "黒鯛": "クロダイ", "チヌ": "クロダイ", "グレ": "メジナ", "石鯛": "イシダイ", "伊佐木": "イサキ", "イサギ": "イサキ", "ノドグロ": "アカムツ", "のどぐろ": "アカムツ", "金目鯛": "キンメダイ",
    "キンメ": "キンメダイ", "鮪": "マグロ", "鰹": "カツオ", "鱪": "シイラ", "皮剥": "カワハギ", "河豚": "フグ", "鯊": "ハゼ", "公魚": "ワカサギ", "アコウ": "キジハタ", "あこう": "キジハタ", "鱈": "マダラ", "タラ": "マダラ", "鮭": "サケ", "秋鮭": "サケ", "ブラックバス": "バス", "ロックフィッシュ": "根魚", "ロック": "根魚",
    "五目": "五目釣り", "沖五目": "五目釣り", "青物": "青物", "ジギング": None, "タイラバ": None, "エギング": None, "ルアー": None, "泳がせ": None,
}

# Precision of a position, best first; ranks of sources by kind.
PRECISION = ("site", "port", "town", "city")
PRICE_CAPS = (7000, 10000, 13000, 16000)


def prefectures(spark: SparkSession) -> DataFrame:
    """(code, name, short) of the prefectures."""
    return spark.createDataFrame([(i + 1, p, p if p == "北海道" else p[:-1]) for i, p in enumerate(PREFS)], "code int, name string, short string")
