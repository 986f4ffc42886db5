"""Listings from JSON files: an array of records, or an object that holds one; explicit schemas, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..dims import PREFS
from ..functions.places import prefecture
from ..functions.text import nfkc
from ..schema import LISTING, REGISTRY

#: Names of the member that holds the records of an object.
WRAPPERS = ("records", "boats")


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str, column: str = "file", position: bool = False) -> DataFrame:
    """The records of JSON files, with the name of the file without its ending (and their place `pos` in it); a file that
    isn't JSON gives none.

    Each file is one document, so that arrays and wrapped arrays are both read; missing paths give no rows.
    """
    kind = StructType.fromDDL(schema)
    try:
        files = spark.read.text(path if isinstance(path, str) else list(path), wholetext=True).select("value", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias(column))
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], StructType.fromDDL(f"{column} string, {schema}{', pos int' if position else ''}"))
    wrapped = F.coalesce(*[F.get_json_object("value", f"$.{w}") for w in WRAPPERS])
    # Element by element, so that one which isn't a record spoils no other.
    elements = F.from_json(F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(wrapped), ArrayType(StringType()))
    rows = files.select(column, F.posexplode(elements).alias("pos", "e")).where(F.ltrim("e").startswith("{"))
    return rows.select(column, "pos", F.from_json("e", kind).alias("r")).select(column, "r.*", *(["pos"] if position else []))


def listings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Listings with a name; the source is the record's, else the file's; files whose name begins with _ are left out."""
    rows = read_json(spark, path, LISTING).where(~F.col("file").startswith("_") & ~F.col("file").endswith("_closed"))
    return rows.withColumn("src", F.coalesce("src", "file")).where(F.length(nfkc("name")) > 0).drop("file")


def source_files(files: Sequence[str], samples: bool = False) -> list[str]:
    """Of the names of files those that hold listings of a source: none that begin with _ or end in _closed, no side files
    (an _ in the source's name), and samples only where they are asked for and the whole file isn't there."""
    found = [f for f in files if f.endswith(".json") and not f.startswith("_") and not f.endswith("_closed.json") and "_" not in f.split(".")[0]]
    return preferred(found) if samples else [f for f in found if ".sample" not in f]


def source_listings(spark: SparkSession, folder: str, samples: bool = False) -> DataFrame:
    """The named listings of all source files of a folder; the source is the file's name up to its first point."""
    from .files import names

    found = source_files(names(spark, folder), samples)
    if not found:
        return spark.createDataFrame([], StructType.fromDDL(LISTING))
    rows = read_json(spark, [f"{folder}/{f}" for f in found], LISTING)
    return rows.withColumn("src", F.substring_index("file", ".", 1)).where(F.length(nfkc("name")) > 0).drop("file")


def display_name(office: Column, operator: Column, boats: Column) -> Column:
    """What a licence row is shown as: the office unless it is the operator, else a boat named like one, else what there is."""
    blank = lambda c: F.nullif(c, F.lit(""))
    boat = F.get(F.filter(boats, lambda b: b.rlike("丸|号|マリン|フィッシング")), F.lit(0))
    return F.when((F.coalesce(office, F.lit("")) != "") & ~office.eqNullSafe(operator), office).otherwise(F.coalesce(boat, blank(office), blank(operator), F.get(F.filter(boats, lambda b: b != ""), F.lit(0)), F.lit("")))


def registry(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Licence rows as listings of the source `registry`; their id is the file, the number, and the place among the named rows."""
    rows = read_json(spark, path, REGISTRY, position=True)
    rows = rows.withColumn("_office", nfkc("office_name")).withColumn("_operator", nfkc("operator")).withColumn("_no", nfkc("reg_no"))
    rows = rows.withColumn("name", display_name(F.col("_office"), F.col("_operator"), F.coalesce("boats", F.array().cast("array<string>")))).where("name <> ''")
    place = F.row_number().over(Window.partitionBy("file").orderBy("pos")) - 1
    blank = lambda c: F.nullif(c, F.lit(""))
    area = F.coalesce(prefecture(F.col("pref")), F.get(F.array(*map(F.lit, PREFS)), F.col("file").try_cast("int") - 1))
    rows = rows.withColumn("_place", place).withColumn("_pref", area)
    licence = F.struct(F.col("_pref").alias("pref"), blank(F.col("_no")).alias("reg_no"), blank(F.col("valid_until")).alias("valid_until"), blank(F.col("as_of")).alias("as_of"), "src_url")
    return rows.select(
        F.lit("registry").alias("src"), F.concat_ws(":", "file", "_no", F.col("_place").cast("string")).alias("src_id"), "name", F.col("_pref").alias("pref"), "address", "tel", "src_url", F.col("as_of").alias("fetched"), F.coalesce("boats", F.array().cast("array<string>")).alias("boats"), licence.alias("registry")
    )


def counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"))


def todo(rows: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Keys that a cache of hits and known misses hasn't seen."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(cache.select(key), key, "left_anti")


def preferred(paths: Sequence[str], mark: str = ".sample") -> list[str]:
    """The paths without those of samples whose full file is there too."""
    full = {p.rsplit("/", 1)[-1].split(".")[0] for p in paths if mark not in p}
    return [p for p in paths if mark not in p or p.rsplit("/", 1)[-1].split(mark)[0] not in full]


def with_labels(rows: DataFrame, sources: DataFrame, kind: str = "directory", prio: int = 40) -> DataFrame:
    """rows with label, kind and priority of their source from sources (src, label, kind, prio); unknown ones get defaults.

    sources is a dimension of a few rows; it is broadcast only if it has at most 10,000.
    """
    few = sources.limit(10_001).count() <= 10_000
    out = rows.join(F.broadcast(sources) if few else sources, "src", "left")
    return out.withColumns({"label": F.coalesce("label", "src"), "kind": F.coalesce("kind", F.lit(kind)), "prio": F.coalesce("prio", F.lit(prio))})


def selected(rows: DataFrame, id_col: str, ids: str | None = None, groups: tuple | None = None, pages: tuple | None = None, only: tuple | None = None, without: tuple | None = None, limit: int | None = None) -> DataFrame:
    """The rows that a run is asked for: ids as ranges ('3,7-9'), and (column, values) of groups, pages, values to take and to
    leave; limit: so many of them, in the order of their ids."""
    from ..functions.embedded import id_ranges

    out = rows
    if ids:
        out = out.where(F.col(id_col).isin(*id_ranges(ids)))
    for choice in (groups, pages, only):
        if choice:
            out = out.where(F.col(choice[0]).isin(*choice[1]))
    if without:
        out = out.where(~F.col(without[0]).isin(*without[1]))
    return out.orderBy(id_col).limit(limit) if limit is not None else out


def enumerated(found: DataFrame, announced: int, again: DataFrame, key: str = "id") -> DataFrame:
    """The distinct ids of a list; where they are fewer than the list announces, with those of a second enumeration (by area)."""
    once = found.select(key).distinct()
    return once if once.count() >= announced else once.unionByName(again.select(key)).distinct()
