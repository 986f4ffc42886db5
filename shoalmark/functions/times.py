"""Times of day in texts, and which of them are departures, returns and meeting times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a time is written, and the words around it that say what it is.
TIME = r"(?<![\d,.:/])(?:(?:午前|午後|AM|PM|am|pm|朝|夕方|夜|深夜|昼)\s*)?\d{1,2}\s*(?::\s*\d{1,2}|時(?!間)\s*(?:\d{1,2}\s*分?|半)?)(?!\d)"
AFTERNOON = "午後|PM|pm|夕方|夜"
MEET_BEFORE, MEET_BEHIND = "集合|受付|集まり|受け付け", r"^\s*(?:集合|受付)"
RETURN_BEFORE, RETURN_BEHIND = "帰港|入港|帰着|終了|沖上が?り|沖揚が?り|着岸|戻り|帰り", r"^\s*(?:頃)?\s*(?:まで|迄|帰港|入港|頃?帰|終了|沖上|着)"
DEPART_BEFORE, DEPART_BEHIND = "出船|出港|出航|出発|スタート|開始", r"^\s*(?:頃)?\s*(?:出船|出港|出航|発|スタート|から|より)"
SUNRISE = "日の出|夜明け|日出|薄明"
BETWEEN = r"^\s*(?:頃|ごろ)?\s*(?:出船|出港|出航)?\s*[~〜\-ー−]\s*(?:帰港|入港)?\s*:?\s*$"
BETWEEN_TRIP = r"^\s*(?:頃|ごろ|位|くらい)?\s*[～〜~\-ー−]\s*(?:帰港)?\s*$"

_MARK = "\u0001"


def _none() -> Column:
    return F.lit(None).cast("string")


def tokens(text: Column) -> Column:
    """array<struct<t, before, between, behind>> of the times of a text in order: HH:MM (hours up to 29), the 7 characters
    before, all since the time before, and the 5 characters behind."""
    parts = F.split(F.regexp_replace(text, f"({TIME})", f"{_MARK}$1{_MARK}"), _MARK)

    def one(i: Column) -> Column:
        written = F.get(parts, i)
        hour, minute = F.regexp_extract(written, r"(\d{1,2})\s*[:時]", 1).cast("int"), F.regexp_extract(written, r"[:時]\s*(\d{1,2})", 1).try_cast("int")
        hour = F.when(written.rlike(AFTERNOON) & (hour < 12), hour + 12).otherwise(hour)
        minute = F.when(written.endswith("半"), 30).otherwise(F.coalesce(minute, F.lit(0)))
        head, tail = F.array_join(F.slice(parts, 1, i), ""), F.array_join(F.slice(parts, i + 2, F.size(parts)), "")
        return F.struct(F.when((hour <= 29) & (minute <= 59), F.format_string("%02d:%02d", hour, minute)).alias("t"), F.substring(head, F.greatest(F.lit(1), F.length(head) - 6), F.lit(7)).alias("before"), F.get(parts, i - 1).alias("between"), F.substring(tail, F.lit(1), F.lit(5)).alias("behind"))

    places = F.when(F.size(parts) > 2, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(places, one), lambda x: x["t"].isNotNull())


def times_in(text: Column) -> Column:
    """The times of a composed text in order."""
    return F.transform(tokens(text), lambda x: x["t"])


def minutes(hhmm: Column) -> Column:
    return F.substring(hhmm, 1, 2).cast("int") * 60 + F.substring(hhmm, 4, 2).cast("int")


def assigned(text: Column) -> Column:
    """struct<depart, back, meet> of a composed text.

    Each time goes by the words before and behind it; without any, the first is the departure (or, after a sunrise, the
    return) and one behind a dash the return.  A departure and a return under two hours apart are a range of departures.
    """
    start = F.struct(_none().alias("depart"), _none().alias("back"), _none().alias("meet"))
    sunrise = text.rlike(SUNRISE)

    def step(a: Column, x: Column) -> Column:
        meets = x["before"].rlike(MEET_BEFORE) | x["behind"].rlike(MEET_BEHIND)
        returns = x["before"].rlike(RETURN_BEFORE) | x["behind"].rlike(RETURN_BEHIND)
        departs = (x["before"].rlike(DEPART_BEFORE) | x["behind"].rlike(DEPART_BEHIND)) & a["depart"].isNull()
        fresh = a["depart"].isNull() & a["back"].isNull()
        after_sun = sunrise & x["before"].rlike(r"[~〜\-ー]\s*$")
        ranged = a["back"].isNull() & a["depart"].isNotNull() & x["between"].rlike(BETWEEN)
        role = F.when(meets, "meet").when(returns, "back").when(departs, "depart").when(fresh & after_sun, "back").when(fresh, "depart").when(ranged, "back")
        put = lambda name: F.when((role == name) & a[name].isNull(), x["t"]).otherwise(a[name]).alias(name)
        return F.struct(put("depart"), put("back"), put("meet"))

    def finish(a: Column) -> Column:
        short = F.pmod(minutes(a["back"]) - minutes(a["depart"]), F.lit(1440)) < 120
        return F.struct(a["depart"].alias("depart"), F.when(~F.coalesce(short, F.lit(False)), a["back"]).alias("back"), a["meet"].alias("meet"))

    return F.aggregate(tokens(text), start, step, finish)


def trips(text: Column) -> Column:
    """The trips of a column of departures as 'HH:MM-HH:MM': the return is missing where the range is under four hours.

    Where the text names several trips, each is one; else the first counts.
    """
    pair = lambda d, b: F.struct(d.alias("d"), b.alias("b"))
    start = F.struct(F.array().cast("array<struct<d:string,b:string>>").alias("list"), F.lit(False).alias("open"))

    def step(a: Column, x: Column) -> Column:
        ends = a["open"] & x["between"].rlike(BETWEEN_TRIP)
        last = F.element_at(a["list"], -1)
        back = F.when(minutes(x["t"]) - minutes(last["d"]) >= 240, x["t"])
        closed = F.concat(F.slice(a["list"], F.lit(1), F.size(a["list"]) - 1), F.array(pair(last["d"], back)))
        return F.struct(F.when(ends, closed).otherwise(F.concat(a["list"], F.array(pair(x["t"], _none())))).alias("list"), (~ends).alias("open"))

    own = F.filter(tokens(text), lambda x: ~x["before"].rlike(r"(集合|受付)\s*$"))
    found = F.array_distinct(F.aggregate(own, start, step)["list"])
    kept = F.when(text.contains("便"), found).otherwise(F.slice(found, 1, 1))
    return F.transform(kept, lambda p: F.concat(p["d"], F.lit("-"), F.coalesce(p["b"], F.lit(""))))


def before_day(day: Column, limit: str) -> Column:
    """A day written as ISO text lies before another, or isn't known."""
    return (F.coalesce(day, F.lit("")) == "") | (day < limit)


def years_before(day: Column, today: str, years: int) -> Column:
    """A day written as ISO text lies so many years or more before today, or isn't known."""
    return (F.coalesce(day, F.lit("")) == "") | (day.try_cast("date") < F.add_months(F.to_date(F.lit(today)), -12 * years))
