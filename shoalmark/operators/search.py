"""The query layer: query states, predicates, facet counts, viewport pages."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dims import FLAGS, PRICE_CAPS

KINDS = {"n": FLAGS["NORIAI"], "s": FLAGS["SHITATE"], "t": FLAGS["TOSEN"]}


@dataclass(frozen=True)
class QuerySpec:
    """A search.  words: all must occur; targets and kinds: any of them; the rest narrows."""

    words: tuple[str, ...] = ()
    targets: frozenset[str] = frozenset()
    kinds: frozenset[str] = frozenset()
    cap: int | None = None
    pref: int | None = None
    region: str | None = None
    plans: bool = False
    web: bool = False
    registry: bool = True
    selected: str | None = None

    @classmethod
    def parse(cls, text: str) -> QuerySpec:
        """From the URL form; unknown values are dropped."""
        q = {k: v[0] for k, v in parse_qs(text.lstrip("#?")).items()}
        number = lambda k: int(q[k]) if q.get(k, "").isdigit() else None
        cap, pref = number("p"), number("pf")
        pref = pref if pref and 1 <= pref <= 47 else None
        return cls(
            tuple(q.get("q", "").split()),
            frozenset(filter(None, q.get("f", "").split(","))),
            frozenset(q.get("k", "")) & frozenset(KINDS),
            cap if cap in PRICE_CAPS else None,
            pref,
            None if pref else q.get("g"),
            q.get("pl") == "1",
            q.get("w") == "1",
            q.get("r") != "0",
            q.get("b"),
        )

    def url(self) -> str:
        parts = {
            "b": self.selected, "q": " ".join(self.words), "f": ",".join(sorted(self.targets)), "k": "".join(k for k in KINDS if k in self.kinds), "p": self.cap, "pf": self.pref,
            "g": None if self.pref else self.region, "pl": "1" if self.plans else None, "w": "1" if self.web else None, "r": None if self.registry else "0",
        }
        return urlencode({k: v for k, v in parts.items() if v not in (None, "")})

    def predicates(self) -> dict[str, Column]:
        """A condition for each facet group that is in use, over (text, targets, flags, price, pref, region, cat)."""
        out = {}
        if self.words:
            out["words"] = reduce(and_, [F.col("text").contains(w) for w in self.words])
        if self.targets:
            out["targets"] = F.arrays_overlap("targets", F.array(*map(F.lit, sorted(self.targets))))
        if self.kinds:
            out["kinds"] = F.col("flags").bitwiseAND(sum(KINDS[k] for k in self.kinds)) != 0
        if self.cap:
            out["cap"] = (F.col("price") > 0) & (F.col("price") <= self.cap)
        if self.pref:
            out["area"] = F.col("pref") == self.pref
        elif self.region:
            out["area"] = F.col("region") == self.region
        if self.plans:
            out["plans"] = F.col("flags").bitwiseAND(FLAGS["PLANS"]) != 0
        if self.web:
            out["web"] = F.col("flags").bitwiseAND(FLAGS["WEB"]) != 0
        if not self.registry:
            out["registry"] = F.col("cat") < 2
        return out

    def matches(self, ignore: Iterable[str] = ()) -> Column:
        """The whole condition without the groups to ignore."""
        return reduce(and_, [c for k, c in self.predicates().items() if k not in set(ignore)], F.lit(True))


def search(index: DataFrame, spec: QuerySpec, most: int | None = None) -> DataFrame:
    out = index.where(spec.matches()).orderBy("cat", "idx")
    return out.limit(most) if most else out


def facet_counts(index: DataFrame, spec: QuerySpec, targets: Iterable[str], caps: Iterable[int] = PRICE_CAPS) -> DataFrame:
    """(facet, value, n): what each value would give with its own group left out; one pass over the index."""
    base = {g: spec.matches([g]) for g in ("kinds", "cap", "area", "targets")}
    counts = [("kinds", k, F.count_if(base["kinds"] & (F.col("flags").bitwiseAND(bit) != 0))) for k, bit in KINDS.items()]
    counts += [("cap", str(c), F.count_if(base["cap"] & (F.col("price") > 0) & (F.col("price") <= c))) for c in caps]
    counts += [("targets", t, F.count_if(base["targets"] & F.array_contains("targets", t))) for t in targets]
    one = index.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(counts)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.lit(v).alias("value"), F.col(f"c{i}").alias("n")) for i, (f, v, _) in enumerate(counts)])).alias("x")).select("x.*")


def what_if(index: DataFrame, spec: QuerySpec, values: Iterable[str]) -> DataFrame:
    """(value, pressed, n): how many rows match if the target is pressed too; for pressed ones those that match now."""
    base, chosen = spec.matches(["targets"]), sorted(spec.targets)
    has = F.arrays_overlap("targets", F.array(*map(F.lit, chosen))) if chosen else F.lit(False)
    values = list(values)
    aggs = [F.count_if(base & has).alias("now"), *[F.count_if(base & ~has & F.array_contains("targets", v)).alias(f"c{i}") for i, v in enumerate(values)]]
    one = index.agg(*aggs)
    rows = [F.struct(F.lit(v).alias("value"), F.lit(v in chosen).alias("pressed"), (F.col("now") if v in chosen else F.col("now") + F.col(f"c{i}")).alias("n")) for i, v in enumerate(values)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def viewport(index: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    return index.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def chips(values: DataFrame, most: int = 18) -> DataFrame:
    """(place, value, pressed, n) of the chips that are shown of a facet folded up: the first `most` by what pressing one adds,
    then by how often it occurs at all, and all pressed ones.  values (value, number, pressed, gain, total, n)."""
    ranked = values.where("total > 0").withColumn("_place", F.row_number().over(Window.orderBy(F.desc("gain"), F.desc("total"), "number")))  # a vocabulary's values
    return ranked.where((F.col("_place") <= most) | F.col("pressed")).select(F.col("_place").alias("place"), "value", "pressed", "n")


def chip_values(index: DataFrame, spec: QuerySpec, values: Iterable[str]) -> DataFrame:
    """What `chips` takes, from one pass over the index: for each value what pressing it would add, how often it occurs, and
    the count on it."""
    values = list(values)
    base, chosen = spec.matches(["targets"]), sorted(spec.targets)
    has = F.arrays_overlap("targets", F.array(*map(F.lit, chosen))) if chosen else F.lit(False)
    aggs = [F.count_if(base & has).alias("now")]
    for i, v in enumerate(values):
        aggs += [F.count_if(base & ~has & F.array_contains("targets", v)).alias(f"g{i}"), F.count_if(F.array_contains("targets", v)).alias(f"t{i}")]
    one = index.agg(*aggs)
    count = lambda i, v: F.col("now") if v in chosen else F.col("now") + F.col(f"g{i}")
    rows = [F.struct(F.lit(v).alias("value"), F.lit(i).alias("number"), F.lit(v in chosen).alias("pressed"), F.col(f"g{i}").alias("gain"), F.col(f"t{i}").alias("total"), count(i, v).alias("n")) for i, v in enumerate(values)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def fits_map(asked: Column, auto: Column, words: Column, before: Column, now: Column, most: int = 500) -> Column:
    """Whether the map moves to what is found: when asked, or by itself when words made the result smaller and small."""
    return asked | (auto & (words > 0) & now.between(1, most) & (now < before))


def decoded_index(rows: DataFrame, targets: list[str], row: str = "row") -> DataFrame:
    """The columns of positional rows (JSON arrays of id, name, kana, lat, lon, pref, place, flags, price, targets), with the
    names of the targets and the text that keywords are looked up in."""
    from ..functions.text import search_key

    at = F.from_json(row, "array<string>")
    names = F.array(*map(F.lit, targets))
    fields = rows.select(F.get(at, F.lit(0)).alias("id"), *[F.get(at, F.lit(i)).alias(n) for i, n in ((1, "name"), (2, "kana"), (6, "place"))], *[F.get(at, F.lit(i)).cast(t).alias(n) for i, n, t in ((3, "lat", "double"), (4, "lon", "double"), (5, "pref", "int"), (7, "flags", "int"), (8, "price", "int"))], F.transform(F.from_json(F.get(at, F.lit(9)), "array<int>"), lambda i: F.get(names, i)).alias("targets"))
    return fields.withColumn("text", search_key(F.concat_ws(" ", "name", "kana", "place", F.array_join("targets", " "))))
