"""Values inside pages and texts: coordinates of map links, JSON-LD, label lists, id ranges, dates, months, vocabularies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import FISH

_NUMBER = r"(-?\d{1,3}\.\d+)"
#: Ways in which map links and scripts state a position, and the groups of latitude and longitude, in order of trust.
POSITIONS = (
    (rf"!3d{_NUMBER}!4d{_NUMBER}", 1, 2),
    (rf"!2d{_NUMBER}!3d{_NUMBER}", 2, 1),
    (rf"[?&](?:ll|q|center|query|daddr)={_NUMBER}(?:,|%2C)\s*{_NUMBER}", 1, 2),
    (rf"@{_NUMBER},{_NUMBER}", 1, 2),
    (rf"LatLng\(\s*{_NUMBER}\s*,\s*{_NUMBER}\s*\)", 1, 2),
    (rf"data-lat=[\"']{_NUMBER}[\"'][^>]*data-l(?:ng|on)=[\"']{_NUMBER}[\"']", 1, 2),
)


def map_position(html: Column) -> Column:
    """struct<la, lo> of the first stated position inside the country, by order of trust; null without one."""
    found = []
    for pattern, la, lo in POSITIONS:
        y, x = F.regexp_extract(html, pattern, la).try_cast("double"), F.regexp_extract(html, pattern, lo).try_cast("double")
        found.append(F.when(y.between(20, 46.5) & x.between(122, 154.5), F.struct(y.alias("la"), x.alias("lo"))))
    return F.coalesce(*found)


def json_ld(html: Column, field: str) -> Column:
    """A field of the first JSON-LD block of a page, inside @graph or not."""
    block = F.regexp_extract(html, r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1)
    return F.coalesce(F.get_json_object(block, f"$.{field}"), F.get_json_object(block, f"$['@graph'][0].{field}"))


def labelled(html: Column, synonyms: Mapping[str, str]) -> Column:
    """map of canonical labels to values of the dt/dd and th/td pairs of a page; the first value of a label counts."""
    pair = r"(?is)(<(?:dt|th)[^>]*>.*?</(?:dt|th)>\s*<(?:dd|td)[^>]*>.*?</(?:dd|td)>)"
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]*>", " "), r"\s+", " "))
    names = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
    pairs = F.transform(F.regexp_extract_all(html, F.lit(pair), F.lit(1)), lambda p: F.struct(F.try_element_at(names, plain(F.regexp_extract(p, r"(?is)^(.*?</(?:dt|th)>)", 1))).alias("k"), plain(F.regexp_replace(p, r"(?is)^.*?</(?:dt|th)>", "")).alias("v")))
    known = F.filter(pairs, lambda p: p["k"].isNotNull())
    firsts = F.aggregate(known, F.array().cast("array<struct<k:string,v:string>>"), lambda a, p: F.when(F.exists(a, lambda x: x["k"] == p["k"]), a).otherwise(F.concat(a, F.array(p))))
    return F.map_from_entries(firsts)


def id_ranges(spec: str) -> list[int]:
    """'3,7-9' as 3, 7, 8, 9."""
    out: list[int] = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        low, _, high = part.partition("-")
        out += range(int(low), int(high or low) + 1)
    return out


def iso_date(c: Column) -> Column:
    """The first date like 2025年1月2日, 2025/1/2 or 2025-01-02; null if there is no such day."""
    pattern = r"(\d{4})\s*[年/.-]\s*(\d{1,2})\s*[月/.-]\s*(\d{1,2})"
    parts = [F.lpad(F.regexp_extract(c, pattern, i), n, "0") for i, n in ((1, 4), (2, 2), (3, 2))]
    return F.concat_ws("-", *parts).try_cast("date")


def season(months: Column) -> Column:
    """Months 1 to 12 as text: 通年 for all, else ranges; one that runs over the turn of the year is one range."""
    has = lambda m: F.array_contains(months, m)
    before = lambda m: F.when(m == 1, 12).otherwise(m - 1)
    starts = F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: has(m) & ~has(before(m)))

    def span(m: Column) -> Column:
        run = F.aggregate(F.sequence(F.lit(1), F.lit(11)), F.struct(m.alias("last"), F.lit(True).alias("on")), lambda a, i: _next(a, m, i, months))["last"]
        last = F.when(run > 12, run - 12).otherwise(run)
        return F.when(last == m, F.concat(m.cast("string"), F.lit("月"))).otherwise(F.concat(m.cast("string"), F.lit("月~"), last.cast("string"), F.lit("月")))

    return F.when(F.size(F.array_distinct(months)) >= 12, "通年").otherwise(F.array_join(F.transform(starts, span), "、"))


def _next(a: Column, m: Column, i: Column, months: Column) -> Column:
    month = (m + i - 1) % 12 + 1
    goes_on = a["on"] & F.array_contains(months, month)
    return F.struct(F.when(goes_on, m + i).otherwise(a["last"]).alias("last"), goes_on.alias("on"))


def vocabulary(c: Column, words: Iterable[str]) -> Column:
    """The words of a vocabulary in a text, each once, in order; of overlapping ones the leftmost, then longest."""
    pattern = "|".join(f"\\Q{w}\\E" for w in sorted(set(words), key=lambda w: (-len(w), w)))
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)))


def canonical(items: Column, synonyms: Mapping[str, str | None]) -> Column:
    """Items by their canonical names, each once, in order; `A(B)` is A's or B's canonical name, or A; words that map to
    nothing, that hold digits or more than 12 letters go, and endings that say no more than "and so on"."""
    known = {k: v for k, v in synonyms.items() if v}
    dropped = [k for k, v in synonyms.items() if not v]
    names = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])

    def one(x: Column) -> Column:
        a, b = F.regexp_extract(x, r"^(.+?)\((.+?)\)$", 1), F.regexp_extract(x, r"^(.+?)\((.+?)\)$", 2)
        x = F.when(a == "", x).otherwise(F.coalesce(F.try_element_at(names, a), F.try_element_at(names, b), a))
        return F.when(x == "五目釣り", x).otherwise(F.regexp_replace(x, "(など|等|ほか|他|各種|狙い|釣り)$", ""))

    # The filter looks at the spelling: a long canonical name stays.
    kept = F.filter(F.transform(items, one), lambda x: (x != "") & (F.length(x) <= 12) & ~x.rlike("[0-9]"))
    if dropped:
        kept = F.filter(kept, lambda x: ~x.isin(*dropped))
    return F.array_distinct(F.transform(kept, lambda x: F.coalesce(F.try_element_at(names, x), x)))


def fish_list(c: Column) -> Column:
    """The fish that a list in a composed text names, by their canonical names."""
    items = F.transform(F.split(c, r"[、,，/／・\s]+"), lambda x: F.regexp_replace(x, r"^[　 .。]+|[　 .。]+$", ""))
    return canonical(F.filter(items, lambda x: x != ""), FISH)


def allowed(path: Column, rules: Column) -> Column:
    """Whether the longest matching rule of rules array<struct<allow, prefix>> allows a path; without one, yes."""
    fits = F.filter(rules, lambda r: path.startswith(r["prefix"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["prefix"]).alias("n"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))


def robots(text: Column) -> Column:
    """array<struct<allow, prefix>> of the rules that a robots.txt has for all agents, in order; none without a text.

    An empty prefix forbids nothing.
    """
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda l: F.trim(F.regexp_replace(l, "#.*$", "")))
    start = F.struct(F.lit("").alias("agents"), F.lit(True).alias("open"), F.array().cast("array<struct<allow:boolean,prefix:string>>").alias("rules"))

    def step(a: Column, line: Column) -> Column:
        field, value = F.lower(F.trim(F.substring_index(line, ":", 1))), F.trim(F.regexp_extract(line, r":(.*)$", 1))
        agent, rule = field == "user-agent", field.isin("allow", "disallow")
        # Agents one after the other share the rules behind them.
        agents = F.when(agent, F.concat(F.when(a["open"], a["agents"]).otherwise(""), F.lit(" "), value, F.lit(" "))).otherwise(a["agents"])
        mine = rule & agents.contains(" * ")
        added = F.concat(a["rules"], F.array(F.struct(((field == "allow") | (value == "")).alias("allow"), value.alias("prefix"))))
        return F.struct(agents.alias("agents"), F.when(agent, True).when(rule, False).otherwise(a["open"]).alias("open"), F.when(mine, added).otherwise(a["rules"]).alias("rules"))

    return F.aggregate(lines, start, step)["rules"]


def may_fetch(path: Column, rules: Column) -> Column:
    """Whether the first rule that a path begins with allows it; without one, yes."""
    return F.coalesce(F.get(F.filter(rules, lambda r: path.startswith(r["prefix"])), F.lit(0))["allow"], F.lit(True))


def total_of(text: Column) -> Column:
    """The number of entries that a composed text of a list announces: the last one counted in 件."""
    return F.regexp_replace(F.element_at(F.filter(F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(r"(\d[\d,]*)\s*件"), F.lit(1))), lambda x: x.isNotNull()), -1), ",", "").try_cast("int")


def pages_of(total: Column, each: int) -> Column:
    """The page numbers of a list of so many entries."""
    return F.when(total > 0, F.sequence(F.lit(1), F.ceil(total / each).cast("int"))).otherwise(F.array().cast("array<int>"))


def vocabulary_masked(c: Column, words: Iterable[str]) -> Column:
    """The words of a vocabulary in a text in the order of the vocabulary: what a word covers is hidden from those after it."""
    hits, left = [], c
    for w in dict.fromkeys(words):
        hits.append(F.when(left.contains(w), F.lit(w)))
        left = F.replace(left, F.lit(w), F.lit("\u0001"))
    return F.array_compact(F.array(*hits))


def vocabulary_whole(c: Column, words: Iterable[str]) -> Column:
    """The words of a vocabulary that stand in a text as whole runs of katakana, each once, in order; words in other signs count
    anywhere."""
    kana = "[ァ-ヶー]"
    pattern = "|".join(f"(?<!{kana})\\Q{w}\\E(?!{kana})" if "ァ" <= w[0] <= "ヶ" else f"\\Q{w}\\E" for w in sorted(set(words), key=lambda w: (-len(w), w)))
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)))
