"""Times, amounts and offers as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words beside amounts that aren't fares, words that say they are included, fares of children, phrases of
# small extra fees, ferries, and styles of fishing from a boat.
JUNK = (
    "レンタル|貸竿|貸し竿|竿|リール|仕掛|鉛|オモリ|錘|餌|エサ|えさ|氷|仮眠|駐車|破損|水没|紛失|送迎|探検丸|割引|値引|アップ|追加|延長|オプション|キャンセル|保険|手数料|目以降|遠征料|遠征の|燃料|サーチャージ|"
    "お立ち台|シャワー|宿泊|弁当|飲み物|クーラー|ライフジャケット|入漁|協力金|容量|インチク|サイズ"
)
INCLUDED = "付き?|込み?|含む|含み|サービス|無料"
CHILD = r"(小学生|中学生|中高生|中校生|高校生|子供|子ども|こども|女性|幼児|未就学|学生|シニア)\s*[:：]?\s*[¥￥]?\s*$"
SMALL_FEE = "変え|変更|替え|回目|の場合は|利用者は"
FERRY = "渡船|渡し|筏|イカダ|いかだ|カセ|かせ|一文字|波止|堤防|沖堤|磯"
BOAT_STYLE = "ジギング|ジグ|タイラバ|五目|乗合|乗り合い|仕立|貸切|チャーター|コマセ|泳がせ|テンヤ|エギング|ルアー|ティップラン|SLJ"
PERSON = "/人|/1名|/1人|1名様|1人|1名|一人|お一人|おひとり|人あたり"
BOAT = "隻|貸切|貸し切り|仕立|チャーター|名様?まで|人まで|名迄|[0-9一二三四五六七八九十]台"
GROUP = r"[0-9]\s*名様?\s*[~〜～-]\s*[0-9]+\s*名"


def clock(c: Column) -> Column:
    """The first time of day as HH:MM; hours 24 to 29 are those of the next day; null otherwise."""
    h = F.regexp_extract(c, r"(\d{1,2})\s*[:：時]\s*(\d{2})?", 1).try_cast("int")
    m = F.coalesce(F.regexp_extract(c, r"(\d{1,2})\s*[:：時]\s*(\d{2})?", 2).try_cast("int"), F.lit(0))
    return F.when((h <= 29) & (m <= 59), F.format_string("%02d:%02d", F.when(h >= 24, h - 24).otherwise(h), m))


def in_range(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def amounts(c: Column) -> Column:
    """The amounts of money in a text, in yen, in order: 1万5千円, 1.5万円, 12,000円, ¥9000, 9000-."""
    unit = r"(\d+(?:\.\d+)?)万(?:(\d+)千)?円?"
    plain = r"[¥￥]\s*(\d{1,3}(?:,\d{3})+|\d+)|(\d{1,3}(?:,\d{3})+|\d+)\s*(?:円|-(?!\d))"
    found = F.regexp_extract_all(c, F.lit(f"({unit}|{plain})"), F.lit(1))

    def value(x: Column) -> Column:
        man, sen = F.regexp_extract(x, unit, 1).try_cast("double"), F.regexp_extract(x, unit, 2).try_cast("double")
        number = F.regexp_replace(x, r"[^0-9]", "").try_cast("bigint")
        return F.when(man.isNotNull(), (man * 10000 + F.coalesce(sen, F.lit(0.0)) * 1000).cast("bigint")).otherwise(number)

    return F.filter(F.transform(found, value), lambda v: v.isNotNull())


def price_unit(kind: Column, text: Column) -> Column:
    """'person', 'boat' or '' : what an offer's price is for; the kind decides first."""
    return F.when(kind == "仕立", "boat").when(kind == "乗合", "person").when(text.rlike(GROUP), "boat").when(text.rlike(PERSON), "person").when(text.rlike(BOAT), "boat").otherwise("")


def before_amount(text: Column, price: Column, size: int = 18) -> Column:
    """The characters before the first place of the amount, without white space; empty if it isn't in the text."""
    comma, bare = F.instr(text, F.format_number(price, 0)), F.instr(text, price.cast("string"))
    at = F.when((comma > 0) & (bare > 0), F.least(comma, bare)).otherwise(F.greatest(comma, bare))
    start = F.greatest(F.lit(1), at - size)
    return F.when(at > 0, F.regexp_replace(F.substring(text, start, at - start), r"\s+", "")).otherwise("")


def with_fare_words(rows: DataFrame, name: Column, text: Column, price: Column) -> DataFrame:
    """rows with `_before` (what stands before the amount) and `_label` (the name without white space), found once for each row:
    the rule below reads them several times.

    A filter by the rule would find them again at each place that reads them; it doesn't go through the explode of one element.
    """
    found = rows.withColumn("_before", before_amount(text, price)).withColumn("_label", F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", ""))
    once = found.select(*[F.col(f"`{c}`") for c in found.columns if c not in ("_before", "_label")], F.explode(F.array(F.struct("_before", "_label"))).alias("_words"))
    return once.withColumn("_before", F.col("_words._before")).withColumn("_label", F.col("_words._label")).drop("_words")


def junk_offer(name: Column, text: Column, price: Column, kind: Column, ferry: Column, words: bool = False) -> Column:
    """The amount isn't a fare: gear, options, children's fares, small fees, or too small for what it is.

    words: the rows have the columns of with_fare_words, so that name and text aren't read.
    """
    before = F.col("_before") if words else before_amount(text, price)
    label = F.col("_label") if words else F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", "")
    kind = F.coalesce(kind, F.lit(""))
    junk_at = F.regexp_instr(before, F.lit(JUNK))
    junk_len = F.length(F.regexp_extract(before, f"({JUNK})", 1))
    behind = F.substring(before, junk_at + junk_len, F.lit(4))
    style = kind.isin("乗合", "仕立") | F.concat(label, before).rlike(BOAT_STYLE)
    is_ferry = (kind == "渡船") | F.concat(label, before).rlike(FERRY) | (ferry & ~style)
    return (
        ((junk_at > 0) & ~behind.rlike(INCLUDED))
        | F.regexp_replace(label, r"^[【\[（(「『<＜※*＊]+", "").rlike(f"^({JUNK})")
        | before.rlike(CHILD)
        | ((is_ferry | (price < 3000)) & (before.rlike(SMALL_FEE) | label.rlike(SMALL_FEE)))
        | ((price < 2500) & ~is_ferry & (kind != "ガイド"))
    )


def price_forms(price: Column) -> Column:
    """Ways in which a price may be written: 15000, 15,000, 1万5千, 1.5万, 9千, 1万4000, 一万五千."""
    man, rest = F.floor(price / 10000).cast("int"), (price % 10000).cast("int")
    sen = F.floor(rest / 1000).cast("int")
    whole = rest % 1000 == 0
    s = lambda c: c.cast("string")
    kanji = lambda n: F.substring(F.lit("〇一二三四五六七八九"), n + 1, F.lit(1))
    long = F.when((man > 0) & (rest == 0), F.concat(s(man), F.lit("万"))).when((man > 0) & whole, F.concat(s(man), F.lit("万"), s(sen), F.lit("千")))
    point = F.when((man > 0) & (sen > 0) & whole, F.concat(s(man), F.lit("."), s(sen), F.lit("万")))
    short = F.when((man == 0) & (sen > 0) & whole, F.concat(s(sen), F.lit("千")))
    mixed = F.when((man > 0) & (rest > 0), F.concat(s(man), F.lit("万"), s(rest)))
    signs = F.when(whole & (man < 10) & (price > 0), F.concat(F.when(man > 0, F.concat(kanji(man), F.lit("万"))).otherwise(""), F.when(sen > 0, F.concat(kanji(sen), F.lit("千"))).otherwise("")))
    return F.array_compact(F.array(s(price), F.format_number(price, 0), long, point, short, mixed, signs))


# Words beside which a time of the afternoon may be written without saying so.
CLOCK_WORDS = "沖上がり 沖揚がり 沖あがり 帰港 納竿 上がり 出船 出航 集合".split()


def time_forms(hhmm: Column) -> Column:
    """Ways in which HH:MM may be written: 24 and 12 hours, kanji, AM and PM, late hours beyond 24, and a bare hour of the
    afternoon beside a word like return to port."""
    h, m = F.substring(hhmm, 1, 2).cast("int"), F.substring(hhmm, 4, 2)
    full, half = m == "00", m == "30"
    minute = m.cast("int").cast("string")
    join = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])

    def plain(n: Column) -> list[Column]:
        return [join(n, ":", m), join(n, "時", m, "分"), F.when(~full, join(n, "時", m)), F.when(half, join(n, "時半")), F.when(full, join(n, "時"))]

    twelve = F.when(h > 12, h - 12).otherwise(h)
    after = [F.when(h.between(12, 23), x) for n in (twelve, F.when(h == 12, 0)) for x in (join("午後", n, "時"), join("午後", n, ":", m), join("PM", n, "時"), join("PM", n, ":", m), join(n, ":", m, "PM"), join("夕方", n, "時"), join("夜", n, "時"), join("夜中", n, "時"))]
    before = [F.when(h < 12, x) for x in (join("午前", h, "時"), join("午前", h, ":", m), join("AM", h, "時"), join("AM", h, ":", m), join(h, ":", m, "AM"))]
    late = [F.when(h < 6, x) for x in (join(h + 24, ":", m), join(h + 24, "時"))] + [F.when(h == 24, F.lit(x)) for x in ("夜中12時", "午前0時", "深夜0時", "24時")] + [F.when(h == 24, join("0:", m))]
    bare = [join(h - 12, ":", m), F.when(full, join(h - 12, "時")).otherwise(join(h - 12, "時", m, "分")), F.when(~full, join(h - 12, "時", m)), F.when(half, join(h - 12, "時半"))]
    beside = [F.when(h >= 13, x) for c in bare for w in CLOCK_WORDS for x in (join(w, c), join(c, w), join(c, "頃", w), join(w, c, "頃"))]
    return F.array_distinct(F.array_compact(F.array(hhmm, *plain(h), join(h, "時", minute, "分"), *after, *before, *late, *beside)))


def claim_text(c: Column) -> Column:
    """A composed text as claims are looked up in it: no thousands separators or white space, 7;30 as 7:30, upper case."""
    c = F.regexp_replace(F.regexp_replace(c, r"(?<=\d)[ \t]*[,.，．、][ \t]*(?=\d{3}(?!\d))", ""), r"[\s_]+", "")
    return F.upper(F.regexp_replace(c, r"(?<=\d);(?=\d{2})", ":"))


def time_stated(hhmm: Column, text: Column) -> Column:
    """A time occurs in a text in one of its forms, as noon, or as an end of a range of full hours."""
    h, full = F.substring(hhmm, 1, 2).cast("int"), F.substring(hhmm, 4, 2) == "00"
    span = lambda n, lead: F.regexp_like(text, F.concat(F.lit(f"{lead}(?<!\\d)("), n, F.lit("[~〜～-]\\d{1,2}|\\d{1,2}[~〜～-]"), n, F.lit(")時")))
    late = span((h - 12).cast("string"), "(?:(?:午後|PM).{0,4}|[夜夕].{0,5})")
    return F.exists(time_forms(hhmm), lambda f: text.contains(f)) | (full & ((h == 12) & text.contains("正午") | span(h.cast("string"), "") | ((h >= 13) & late)))


def stated(forms: Column, text: Column) -> Column:
    """One of the forms occurs in the text, not inside a longer number."""
    return F.exists(forms, lambda f: F.regexp_like(text, F.concat(F.lit(r"(?<!\d)\Q"), f, F.lit(r"\E(?!\d)"))))
