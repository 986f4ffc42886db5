"""Offers from lines of free text: sections and amounts as windows over the lines of a document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import KINDS
from ..functions import offers as f
from ..functions.text import kinds_of, nfkc
from ..functions.times import TIME, assigned
from .classify import generic_label, header_line, plain_label
from .graph import checkpoint_dir, written
from .ordered import back_fill, forward_fill, islands, over, section


def offers(lines: DataFrame, doc: str, ln: str, line: str) -> DataFrame:
    """(doc, ln, kind, name, price, unit, depart, return_at) of the lines that state a fare.

    A line that names a kind and no amount is a heading for those below it; a time range gives departure and return; an
    amount that isn't a fare, or has no place for one, is left out.
    """
    rows = lines.join(_read_once(lines, line), F.col(line) == F.col("_line"), "left")
    heading = F.when(F.col("_price").isNull(), F.col("_own"))
    rows = rows.withColumn("kind", F.coalesce("_own", forward_fill(heading, over([doc], [ln])))).where(F.col("_price").between(300, 600000))
    kind = F.coalesce("kind", F.lit(""))
    junk = reduce(lambda x, y: x | y, [(kind == k) & (F.col("_junk").bitwiseAND(F.lit(1 << i)) != 0) for i, k in enumerate(_KINDS)])
    of_kind = f.price_unit(F.col("kind"), F.lit(""))
    return rows.where(~junk).select(doc, ln, "kind", F.col("_name").alias("name"), F.col("_fare").alias("price"), F.when(of_kind != "", of_kind).otherwise(F.col("_unit")).alias("unit"), F.col("_depart").alias("depart"), F.col("_back").alias("return_at"))


#: The kinds that a line can be under, and none.
_KINDS = (*dict.fromkeys(k for _, k in KINDS), "")


def _read_once(lines: DataFrame, line: str) -> DataFrame:
    """What each distinct line says by itself, as a table: lines that stand in many documents are read once.

    _junk has a bit for each kind under which its amount is no fare; _unit is what the line says where the kind doesn't.
    """
    t = F.col("_line")
    clock = r"(\d{1,2}[:：時]\d{0,2})"
    span = F.regexp_extract(t, clock + r"\s*[~〜～-]\s*" + clock, 2)
    name = F.trim(F.regexp_replace(F.regexp_extract(t, r"^([^\d¥￥]*)", 1), r"^[◆●■・\s]+", ""))
    rows = lines.select(F.col(line).alias("_line")).where(t.isNotNull()).distinct().withColumn("_price", F.get(f.amounts(t), F.lit(0)))
    fare = F.when(F.col("_price").between(300, 600000), F.col("_price")).cast("int")
    rows = rows.select(
        "_line", "_price", F.get(kinds_of(t), F.lit(0)).alias("_own"), name.alias("_name"), fare.alias("_fare"), f.price_unit(F.lit(None).cast("string"), t).alias("_unit"), f.clock(t).alias("_depart"), f.clock(span).alias("_back")
    )
    rows = f.with_fare_words(rows, F.col("_name"), t, F.col("_fare"))
    junk = [F.when(f.junk_offer(F.col("_name"), t, F.col("_fare"), F.lit(k), F.lit(False), words=True), 1 << i).otherwise(0) for i, k in enumerate(_KINDS)]
    return written(rows.withColumn("_junk", F.when(F.col("_fare").isNotNull(), reduce(lambda x, y: x + y, junk))).drop("_before", "_label"))


# How amounts are written, what isn't one, and what belongs to one behind it.
AMOUNT = (
    r"(?:\d+(?:\.\d+)?\s*万\s*(?:\d\s*千)?\s*(?:\d{1,4})?\s*円|\d{1,3}\s*千\s*円|[¥\\]\s*(?:\d{1,3}(?:,\d{3})+|\d{3,7})(?![\d,])\s*円?|(?:\d{1,3}(?:,\d{3})+|\d{3,7})\s*円"
    r"|(?<![\d,.])(?:\d{1,3}(?:,\d{3})+(?![\d,])(?:\s*-(?!\s*\d))?|\d{4,6}\s*-(?!\s*\d))(?!\s*(?:m|M|号|匹|本|kg|g|cm|mm|名|人|時|分|%|馬力|t|トン)))"
)
BEHIND = r"(?:\s*(?:円|~|〜|-|。|税込み?|税別|税抜き?|程度|前後|/\s*[^\s/()]{1,10}|\([^()]{0,30}\)))*"


def yen(written: str) -> int:
    """The number of yen of an amount as it is written."""
    import re

    text = written.replace(",", "").replace(" ", "")
    m = re.match(r"(\d+(?:\.\d+)?)万(?:(\d)千)?(\d{1,4})?", text)
    if m:
        return round(float(m[1]) * 10000) + int(m[2] or 0) * 1000 + int(m[3] or 0)
    number = int(re.search(r"\d+", text)[0])
    return number * 1000 if "千" in text else number


def line_amounts(line: str | None) -> list[tuple[str, int, str]]:
    """(before, amount, behind) of each amount of a composed line: what stands before it since the amount before, and what
    belongs to it behind.  A range is its lower bound, also where only its upper one says that it is money."""
    import re

    low = r"(?:(?<![\d,.])(?P<low>\d{1,3}(?:,\d{3})+|\d{3,7})\s*[~〜]\s*)?"
    found, out, at = re.compile(rf"{low}(?P<amount>{AMOUNT})(?P<behind>(?:\s*[~〜\-ー]\s*{AMOUNT})?{BEHIND})"), [], 0
    for m in found.finditer(line or ""):
        value, begin = yen(m["amount"]), m.start()
        if m["low"] and 500 <= int(m["low"].replace(",", "")) < value:
            value = int(m["low"].replace(",", ""))
        elif m["low"]:
            begin = m.start("amount")
        out.append((line[at:begin].strip(), value, m["behind"].strip()))
        at = m.end() - (len(m[0]) - len(re.sub(r"[~〜\-]\s*$", "", m[0])))
    return out


def segments(lines: DataFrame, id_col: str, line: str) -> DataFrame:
    """(id_col, n, before, amount, behind) of the amounts of each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, n, *found) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for n, found in enumerate(line_amounts(text))]
            kinds = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.int32(), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds)], ["id", "n", "before", "amount", "behind"])

    rows = lines.select(F.col(id_col).alias("id"), F.col(line).alias("line"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n int, before string, amount int, behind string").withColumnRenamed("id", id_col)


def named_blocks(lines: DataFrame, known: DataFrame, page: str, end: str) -> DataFrame:
    """(page, name, body): the lines (page, ln, line) between a known name and the next one, or a line like `end`; of a name's
    blocks on a page the first counts."""
    names = known.select(F.col("name").alias("line"), F.lit(True).alias("_named")).distinct()
    rows = lines.join(names, "line", "left").withColumn("_ends", F.col("_named").isNotNull() | F.col("line").rlike(end))
    w = over([page], ["ln"])
    rows = rows.withColumn("_block", section(F.col("_ends"), w)).withColumn("_name", F.first(F.when(F.col("_named"), F.col("line"))).over(over([page, "_block"], ["ln"])))
    inside = rows.where(F.col("_name").isNotNull() & F.col("_named").isNull())
    blocks = inside.groupBy(page, "_name", "_block").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ln", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return blocks.groupBy(page, F.col("_name").alias("name")).agg(F.min_by("body", "_block").alias("body"))


def guarded(rows: DataFrame, texts: DataFrame, page: str, text: str, must: str) -> DataFrame:
    """Records written by hand, without those whose page is missing or lacks one of the texts that they must find there."""
    both = rows.join(texts.select(page, F.col(text).alias("_text")), page)
    return both.where(F.forall(must, lambda m: F.col("_text").contains(m))).drop("_text", must)


def line_fields(lines: DataFrame, line: str, pattern: str, names: list[str]) -> DataFrame:
    """lines that match a pattern, with its groups as columns; others are left out."""
    return lines.where(F.col(line).rlike(pattern)).withColumns({n: F.regexp_extract(line, pattern, i + 1) for i, n in enumerate(names)})


def rolled_up(rows: DataFrame, doc: str, most: int = 80, boat: int = 20000) -> DataFrame:
    """(doc, first, name, kind, price_text): price lists for different numbers of people, neighbouring rows (doc, n, header, text,
    value) of one header as one offer; it is for a boat if one of the prices is `boat` or more."""
    w = over([doc], ["n"])
    runs = rows.withColumn("_run", islands(F.col("header"), w)).groupBy(doc, "_run").agg(
        F.min("n").alias("first"), F.first("header").alias("_header"), F.max("value").alias("_top"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), " / ").alias("_text")
    )
    name = F.concat(F.when(F.coalesce("_header", F.lit("")) != "", F.concat("_header", F.lit(" "))).otherwise(""), F.lit("人数別料金"))
    return runs.select(doc, "first", name.alias("name"), F.when(F.col("_top") >= boat, "仕立").otherwise("").alias("kind"), F.substring("_text", 1, most).alias("price_text"))


def plans(lines: DataFrame, doc: str, ln: str, line: str) -> DataFrame:
    """(doc, ln, n, kind, name, price, unit, depart, back, meet) of the fares that lines of free text state.

    Headings name a kind or an offer for the lines below, up to the next one of their sort.  Times on a line of an amount
    are that offer's alone; others are its section's, above or below it.  Every amount of a line is an offer of its own: its
    label is what stands before it, or the heading.  Amounts that are no fares go.
    """
    checkpoint_dir(lines.sparkSession)
    rows = lines.select(F.col(doc).alias("doc"), F.col(ln).alias("ln"), nfkc(line).alias("line")).checkpoint()  # read by each step
    w = over(["doc"], ["ln"])
    amounts = segments(rows.withColumn("_id", F.concat_ws("|", "doc", F.col("ln").cast("string"))), "_id", "line")
    rows = rows.withColumn("_id", F.concat_ws("|", "doc", F.col("ln").cast("string")))
    priced = amounts.select("_id").distinct().withColumn("_priced", F.lit(True))
    rows = rows.join(priced, "_id", "left").withColumn("_priced", F.coalesce("_priced", F.lit(False)))
    rows = rows.withColumn("_t", assigned(F.col("line"))).withColumn("_timed", F.coalesce("_t.depart", "_t.back", "_t.meet").isNotNull())
    rows = rows.withColumn("_own", F.get(kinds_of(F.col("line")), F.lit(0)))
    head = ~F.col("_priced") & header_line(F.col("line"), F.col("line"), F.array().cast("array<bigint>"), F.when(F.col("_timed"), F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_head", head).withColumn("_kind", forward_fill(F.when(F.col("_head"), F.col("_own")), w))
    rows = rows.withColumn("_title", forward_fill(F.when(F.col("_head"), F.regexp_replace("line", r"^[【『\[(（◆●■・\s]+|[】』\])）\s]+$", "")), w)).withColumn("_section", section(F.col("_head"), w))
    inside = over(["doc", "_section"], ["ln"])
    alone = F.when(F.col("_timed") & ~F.col("_priced"), F.col("_t"))
    rows = rows.withColumn("_time", F.coalesce(F.when(F.col("_timed"), F.col("_t")), forward_fill(alone, inside), back_fill(alone, inside)))
    both = rows.where("_priced").join(amounts.withColumnRenamed("_id", "_key"), F.col("_id") == F.col("_key"))
    label = F.trim(F.regexp_replace(F.regexp_replace("before", TIME, ""), r"^[、,・◆●■~〜\-\s/]+|[:：~〜\-\s/]+$", ""))
    out = both.withColumn("_label", plain_label(label)).where(F.col("amount").between(300, 600000))
    generic = (F.col("_label") == "") | generic_label(F.col("_label"))
    name = F.when(generic, F.coalesce("_title", "_label")).otherwise(F.col("_label"))
    kind = F.coalesce(F.get(kinds_of(F.col("before")), F.lit(0)), "_kind", "_own")
    words = F.concat_ws("", "before", F.format_number("amount", 0), F.lit("円"), "behind")
    out = out.withColumn("kind", kind).withColumn("name", name).where(~f.junk_offer(F.col("name"), words, F.col("amount"), F.col("kind"), F.lit(False)))
    return out.select(F.col("doc").alias(doc), F.col("ln").alias(ln), "n", "kind", "name", F.col("amount").alias("price"), f.price_unit(F.coalesce("kind", F.lit("")), words).alias("unit"), "_time.depart", "_time.back", "_time.meet")
