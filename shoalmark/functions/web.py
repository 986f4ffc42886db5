"""URLs, hosts and phone numbers as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import PORTAL_HOSTS, SHARED_HOSTS, SNS_HOSTS

INDEX_PAGE = r"(?i)/(index|default|top|home)\.(html?|php|asp)$"


def host_of(u: Column) -> Column:
    """Lower-cased host without user, port and www.; empty where there is none."""
    h = F.lower(F.regexp_extract(F.coalesce(u, F.lit("")), r"(?i)^https?://([^/?#]+)", 1))
    h = F.regexp_replace(F.regexp_replace(h, "^.*@", ""), ":.*$", "")
    return F.regexp_replace(h, r"^www\.", "")


def host_in(host: Column, hosts: Sequence[str]) -> Column:
    """The host is one of the hosts or below one."""
    return host.rlike(f"(^|\\.)({'|'.join(h.replace('.', chr(92) + '.') for h in hosts)})$")


def clean_url(u: Column) -> Column:
    """Without fragment and tracking parameters; null if it isn't http."""
    u = F.trim(u)
    plain = F.regexp_replace(F.regexp_replace(u, "#.*$", ""), "[?&](utm_[a-z]+|fbclid|gclid)=[^&]*", "")
    return F.when(u.rlike("(?i)^https?://"), plain)


def _path(u: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(u, "(?i)^https?://[^/]+", ""), r"\?.*$", "")
    return F.regexp_replace(F.regexp_replace(path, INDEX_PAGE, "/"), "/+$", "")


def site_key(u: Column, shared: Sequence[str] = SHARED_HOSTS) -> Column:
    """Which site a URL belongs to: the host, and the first folder unless that is a page."""
    c = clean_url(u)
    host = host_of(c)
    first = F.coalesce(F.get(F.filter(F.split(_path(c), "/"), lambda s: s != ""), F.lit(0)), F.lit(""))
    bare = (first == "") | (~host_in(host, shared) & first.contains("."))
    return F.when(c.isNotNull(), F.when(bare, host).otherwise(F.concat_ws("/", host, F.lower(first))))


def exact_url(u: Column) -> Column:
    """The page without scheme, www., index page and slashes at the end, lower-cased; empty without a URL."""
    c = F.regexp_replace(F.coalesce(clean_url(u), F.lit("")), r"(?i)^https?://(www\.)?", "")
    return F.lower(F.regexp_replace(F.regexp_replace(c, INDEX_PAGE, ""), "/+$", ""))


def url_class(u: Column) -> Column:
    """'sns', 'portal', 'official', or null without a host."""
    h = host_of(u)
    return F.when(h == "", None).when(host_in(h, SNS_HOSTS), "sns").when(host_in(h, PORTAL_HOSTS), "portal").otherwise("official")


# Profiles whose blog is meant, pages of a network that are no profile, forms, and files that are no pages.
BLOG_PROFILE = r"^https?://(?:profile\.ameba\.jp/ameba|(?:www\.)?ameba\.jp/profile/general)/([\w-]+)"
NO_PROFILE = ("p", "reel", "tv", "explore", "stories")
FORM = "(?i)contact|inquiry|form|reserve|yoyaku|toiawase"
ASSET = r"(?i)\.(pdf|jpe?g|png|gif|webp|mp4|mov|zip|docx?|xlsx?)(\?|$)"


def blog_of_profile(u: Column) -> Column:
    """The blog of a profile page of its host; other URLs as they are."""
    who = F.regexp_extract(u, BLOG_PROFILE, 1)
    return F.when(who != "", F.concat(F.lit("https://ameblo.jp/"), who, F.lit("/"))).otherwise(u)


def own_links(website: Column, sns: Column) -> Column:
    """struct<website, sns>: the site if it is someone's own, and the networks, among them a site that is one."""
    site = blog_of_profile(clean_url(website))
    kind = url_class(site)
    networks = F.filter(F.transform(F.coalesce(sns, F.array().cast("array<string>")), clean_url), lambda u: url_class(u) == "sns")
    return F.struct(F.when(kind == "official", site).alias("website"), F.array_distinct(F.when(kind == "sns", F.concat(networks, F.array(site))).otherwise(networks)).alias("sns"))


def instagram_profile(u: Column, text: Column | None = None) -> Column:
    """The profile that a link to the network leads to, else that of the handle that a text of an embedded post names."""
    name = F.regexp_extract(F.coalesce(u, F.lit("")), r"^https?://(?:www\.)?instagram\.com/([A-Za-z0-9._]{1,30})/?(?:[?#].*)?$", 1)
    name = F.when(~name.isin("", *NO_PROFILE), name)
    if text is not None:
        name = F.coalesce(name, F.nullif(F.regexp_extract(text, r"\(@([A-Za-z0-9._]{1,30})\)", 1), F.lit("")))
    return F.concat(F.lit("https://www.instagram.com/"), name, F.lit("/"))


def root_of_form(u: Column) -> Column:
    """The site of a form for questions or bookings; other URLs as they are."""
    path = F.regexp_extract(u, r"^https?://[^/?#]+(/[^?#]*)", 1)
    return F.when(path.rlike(FORM), F.concat(F.regexp_extract(u, r"^(https?://[^/?#]+)", 1), F.lit("/"))).otherwise(u)


def is_asset(u: Column) -> Column:
    return u.rlike(ASSET)


def _phones(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, r"[()\s.・]", "-"), "[‐‑–—―ー−]", "-")
    found = F.regexp_extract_all(c, F.lit(r"((?<!\d)0\d{1,4}-*\d{1,4}-*\d{3,4}(?!\d))"), F.lit(1))

    def valid(x: Column) -> Column:
        d = F.regexp_replace(x, "-", "")
        return F.length(d).isin(10, 11) & (F.substring(d, 2, 1) != "0")

    return F.filter(found, valid)


def phone_key(c: Column) -> Column:
    """The digits of the first phone number in a text; null without one."""
    return F.regexp_replace(F.get(_phones(c), F.lit(0)), "-", "")


def phone_shown(c: Column) -> Column:
    """The first phone number as it is divided in the text."""
    return F.regexp_replace(F.get(_phones(c), F.lit(0)), "-+", "-")
