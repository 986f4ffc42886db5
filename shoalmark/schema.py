"""Schemas of the directory's tables."""

from __future__ import annotations

PLAN = "struct<name:string,kind:string,targets:array<string>,price:int,price_text:string,depart:string,`return`:string,meet:string,season:string,days:string,includes:string,url:string>"
LISTING = (
    "src string, src_id string, src_url string, name string, kana string, pref string, city string, address string, port string, lat double, lon double, tel string, website string, sns array<string>, "
    "types array<string>, targets array<string>, methods array<string>, holidays string, facilities array<string>, capacity int, access string, description string, "
    f"plans array<{PLAN}>, schedule_text string, fetched string, stale boolean, last_report string"
)
REGISTRY = (
    "src string, pref string, reg_no string, operator string, office_name string, postal string, address string, tel string, boats array<string>, area string, registered string, valid_until string, src_url string, as_of string"
)
SITE = "url string, final string, status string, html string"
SOURCES = "src string, label string, kind string, prio int"
