"""Normalisation of listings and their nested offers, and claims checked against the text they were read from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import offers as f
from ..functions.embedded import fish_list
from ..functions.places import clean_address, prefecture
from ..functions.text import cut, kinds_of, name_key, nfkc, port_key, split_list
from ..functions.web import blog_of_profile, clean_url, exact_url, phone_key, phone_shown, site_key, url_class

#: Sources whose offers were checked or come structured; their amounts are fares.
VERIFIED = ("official", "chowari", "castingnet", "reserver")


def offers(listings: DataFrame, ident: tuple[str, ...] = ("src", "src_id")) -> DataFrame:
    """One row for each offer that survives cleaning: ident, pos and the cleaned fields.

    Prices outside 300 to 600,000 yen are unknown; offers of sources that aren't verified go if their amount isn't a fare;
    so do offers with neither name, price, price text nor departure.
    """
    ferry = F.exists(F.coalesce("types", F.array().cast("array<string>")), lambda t: t.rlike("渡船|瀬渡|磯渡|筏")) | F.coalesce(F.col("name").rlike("渡船|筏|イカダ|いかだ|カセ"), F.lit(False))
    rows = listings.select(*ident, ferry.alias("_ferry"), F.posexplode("plans").alias("pos", "p")).withColumn("t_targets", nfkc(F.array_join("p.targets", "、")))
    text = {c: nfkc(f"p.{c}") for c in ("name", "kind", "price_text", "depart", "return", "meet", "season", "days", "includes")}
    rows = rows.select(*ident, "_ferry", "pos", *[v.alias(f"t_{k}") for k, v in text.items()], F.col("p.price").alias("t_price"), fish_list(F.col("t_targets")).alias("targets"), F.col("p.url").alias("t_url"))
    blank = lambda c: F.nullif(c, F.lit(""))
    kind = F.coalesce(F.get(kinds_of(F.col("t_kind")), F.lit(0)), blank(cut(F.col("t_kind"), 10)))
    rows = rows.withColumn("kind", kind).withColumn("price", f.in_range(F.col("t_price"), 300, 600000))
    rows = f.with_fare_words(rows, F.col("t_name"), F.col("t_price_text"), F.col("price"))
    junk = F.col("price").isNotNull() & ~F.col("src").isin(*VERIFIED) & f.junk_offer(F.col("t_name"), F.col("t_price_text"), F.col("price"), F.col("kind"), F.col("_ferry"), words=True)
    rows = rows.where(~F.coalesce(junk, F.lit(False)))
    name = blank(F.regexp_replace(cut(F.col("t_name"), 90), r"^[、。，,.)）\]】」』\s※*＊・:：]+", ""))
    out = rows.select(
        *ident, "pos", name.alias("name"), "kind", "targets", "price", blank(cut(F.col("t_price_text"), 80)).alias("price_text"), f.clock(F.col("t_depart")).alias("depart"),
        f.clock(F.col("t_return")).alias("return"), *[blank(cut(F.col(f"t_{c}"), n)).alias(c) for c, n in (("meet", 40), ("season", 60), ("days", 60), ("includes", 80))], clean_url(F.col("t_url")).alias("url"),
    )
    return out.where("name IS NOT NULL OR price IS NOT NULL OR price_text IS NOT NULL OR depart IS NOT NULL")


def listings(raw: DataFrame, today: str) -> DataFrame:
    """Listings with clean fields and the keys by which they are compared."""
    blank = lambda c: F.nullif(c, F.lit(""))
    # Texts are composed first: what comes after stays in the JVM, and higher-order functions take no Python.
    composed = ("src_id", "src_url", "name", "kana", "pref", "city", "port", "address", "tel", "website", "holidays", "access", "description", "schedule_text", "fetched")
    raw = raw.withColumn("_targets", nfkc(F.array_join("targets", "、"))).withColumn("_ident", nfkc(F.coalesce("src_url", "name"))).withColumn("_nkey", name_key(F.col("name"))).withColumns({c: nfkc(c) for c in composed})
    one = lambda c, n: blank(cut(F.col(c), n))
    address = blank(clean_address(F.col("address")))
    pref = F.coalesce(prefecture(F.col("pref")), prefecture(address), prefecture(F.col("city")))
    web = blog_of_profile(clean_url(F.col("website")))
    kind = url_class(web)
    sns = F.filter(F.transform(F.coalesce("sns", F.array().cast("array<string>")), clean_url), lambda u: url_class(u) == "sns")
    inside = F.col("lat").between(20, 46.5) & F.col("lon").between(122, 154.5)
    out = raw.withColumn("_pref", pref).withColumn("_address", address).withColumn("_web", F.when(kind == "official", web)).withColumn("_sns", F.when(kind == "sns", F.concat(sns, F.array(web))).otherwise(sns))
    name = F.regexp_replace("name", r"\s+", " ")
    return out.select(
        "src", F.coalesce(blank(F.col("src_id")), F.left(F.sha1("_ident"), F.lit(10))).alias("src_id"), clean_url(F.col("src_url")).alias("src_url"), cut(name, 60).alias("name"), one("kana", 60).alias("kana"),
        F.when(F.col("_address").isNotNull() & F.col("_pref").isNotNull() & prefecture(F.col("_address")).isNull(), F.concat("_pref", "_address")).otherwise(F.col("_address")).alias("address"), F.col("_pref").alias("pref"),
        blank(F.col("city")).alias("city"), blank(F.col("port")).alias("port"), phone_key(F.col("tel")).alias("tel"), phone_shown(F.col("tel")).alias("tel_shown"), F.col("_web").alias("website"), F.array_distinct("_sns").alias("sns"),
        F.when(inside, F.col("lat")).alias("lat"), F.when(inside, F.col("lon")).alias("lon"), F.when(inside, "site").alias("geo"), kinds_of(F.array_join("types", " ")).alias("types"), fish_list(F.col("_targets")).alias("targets"),
        F.slice(split_list(F.array_join("methods", "、")), 1, 12).alias("methods"), F.slice(split_list(F.array_join("facilities", "、")), 1, 20).alias("facilities"), one("holidays", 80).alias("holidays"), f.in_range(F.col("capacity"), 1, 300).alias("capacity"),
        one("access", 160).alias("access"), one("description", 160).alias("description"), one("schedule_text", 300).alias("schedule_text"), F.coalesce(blank(F.col("fetched")), F.lit(today)).alias("fetched"), F.coalesce("stale", F.lit(False)).alias("stale"),
        F.col("_nkey").alias("nkey"), port_key(F.coalesce("port", F.lit("")), plain=True).alias("pkey"), site_key(F.col("_web")).alias("ukey"), exact_url(F.col("_web")).alias("page"),
    )


def false_claims(claims: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Claims (key, n, price, depart) that the text of their site (key, text) doesn't state in any way of writing.

    Prices are also looked for in the text without any separator between digits, as sites misplace them.
    """
    both = claims.join(texts, key).withColumn("_plain", f.claim_text(nfkc("text")))
    loose = F.regexp_replace("_plain", r"(?<=\d)[,.，．、](?=\d)", "")
    forms = f.price_forms(F.col("price"))
    price = F.col("price").isNotNull() & ~F.exists(forms, lambda x: F.col("_plain").contains(x) | loose.contains(x))
    time = F.col("depart").rlike(r"^\d{2}:\d{2}$") & ~f.time_stated(F.col("depart"), F.col("_plain"))
    return both.select(key, "n", F.coalesce(price, F.lit(False)).alias("price_unstated"), F.coalesce(time, F.lit(False)).alias("time_unstated")).where("price_unstated OR time_unstated")


def place_label(city: Column, port: Column, address: Column, pref: Column, town: Column) -> Column:
    """City and port, else the town without its prefecture; 30 letters at most."""
    label = F.concat_ws(" ", F.nullif(city, F.lit("")), F.nullif(port, F.lit("")))
    return cut(F.when(label != "", label).otherwise(F.coalesce(F.substring(town, F.length(pref) + 1, F.length(town)), F.lit(""))), 30)
