"""Rule-based schema extraction.

The reference sends each page to an LLM with a schema. Model calls are
external, so here every field of the schema comes with a user regex; typed
values come from ``try_cast``. All of it is a projection over the pages.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from corpusflow.functions.elements import elements, matching, outer_html
from corpusflow.plans.strategy import dense_position

# Fixed values.
FIELD_TYPES = {"string": StringType(), "number": DoubleType(), "boolean": BooleanType()}
TRUE_WORDS = ["true", "yes", "y", "1"]
FALSE_WORDS = ["false", "no", "n", "0"]
STANDARD_MODEL_MARKERS = ["mini", "flash", "haiku", "lite", "nano"]
STANDARD_WINDOW, ADVANCED_WINDOW = 8_000, 30_000
SPEC = re.compile(r"^\s*(string|number|boolean)\b\s*(?:[—–-]+\s*(.*))?$", re.S | re.I)


def parse_schema(spec: dict[str, str]) -> tuple[StructType, list[tuple[str, str, str]]]:
    """G1: ``{"price": "number — the price"}`` -> (StructType, [(field, type, description)]).
    A value without a known type word is a string field described by the whole value."""
    rows = []
    for field, value in spec.items():
        m = SPEC.match(value or "")
        if m:
            rows.append((field, m.group(1).lower(), (m.group(2) or "").strip()))
        else:
            rows.append((field, "string", (value or "").strip()))
    struct = StructType([StructField(f, FIELD_TYPES[t], True) for f, t, _ in rows])
    return struct, rows


def schema_frame(spark, spec: dict[str, str]) -> DataFrame:
    """G1 as a DataFrame: field, type, description, plus field_count."""
    _, rows = parse_schema(spec)
    df = spark.createDataFrame(rows, "field string, type string, description string")
    return df.withColumn("field_count", F.lit(len(rows)).cast("long"))


def _typed(v: Column, t: str) -> Column:
    v = F.nullif(F.trim(v), F.lit(""))
    if t == "number":
        return v.try_cast("double")
    if t == "boolean":
        lv = F.lower(v)
        return F.when(lv.isin(TRUE_WORDS), F.lit(True)).when(lv.isin(FALSE_WORDS), F.lit(False)).when(v.isNotNull(), F.lit(True))
    return v


def extract_fields(pages: DataFrame, spec: dict[str, str], rules: dict[str, str], text_col: str = "html") -> DataFrame:
    """One typed struct per page; a field without a match is null."""
    _, rows = parse_schema(spec)
    vals = [_typed(F.regexp_extract(F.col(text_col), rules[f], 1), t).alias(f) for f, t, _ in rows]
    return pages.withColumn("extracted", F.struct(*vals)).withColumn("field_count", F.lit(len(rows)).cast("long"))


def extract_list(pages: DataFrame, spec: dict[str, str], rules: dict[str, str], text_col: str = "html",
                 id_col: str = "page_id", record: str | None = None) -> DataFrame:
    """The items of every page, each field's first match inside the item; a
    field that an item lacks is null there and moves to no other item.

    An item is an element that the CSS selector ``record`` matches, or, without
    one, what stands from one match of the first field of ``spec`` to the next.
    Items without any field are left out. Output: id, item_index, one column
    per field, item_count."""
    _, rows = parse_schema(spec)
    text = F.col(text_col)
    if record is None:
        mark = "\ufdd0"
        cut = F.split(F.regexp_replace(F.replace(text, F.lit(mark), F.lit("")), rules[rows[0][0]], mark + "$0"), mark)
        parts = F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0)))
        z = pages.select(id_col, F.coalesce(parts, F.array().cast("array<string>")).alias("_parts"))
    else:
        tree = pages.select(id_col, text_col, elements(text_col).alias("_tree"))
        z = tree.select(id_col, F.transform(matching(F.col("_tree"), record), lambda e: outer_html(text, e)).alias("_parts"))

    def item(part: Column) -> Column:
        return F.struct(*[_typed(F.regexp_extract(part, rules[f], 1), t).alias(f) for f, t, _ in rows])

    items = F.filter(F.transform("_parts", item), lambda x: _any_field(x, rows))
    z = z.select(id_col, items.alias("_items"))
    z = z.select(id_col, F.size("_items").cast("long").alias("item_count"), F.posexplode("_items").alias("item_index", "_it"))
    return z.select(id_col, "item_index", *[F.col(f"_it.{f}").alias(f) for f, _, _ in rows], "item_count")


def _any_field(item: Column, rows: list[tuple[str, str, str]]) -> Column:
    found = F.lit(False)
    for f, _, _ in rows:
        found = found | item[f].isNotNull()
    return found


def page_status(extracted: DataFrame, spec: dict[str, str], url_col: str = "url") -> DataFrame:
    """G4 per page: ok when some field was found, else error (never aborts)."""
    _, rows = parse_schema(spec)
    found = F.greatest(*[F.col(f"extracted.{f}").isNotNull().cast("int") for f, _, _ in rows]) if len(rows) > 1 else F.col(f"extracted.{rows[0][0]}").isNotNull().cast("int")
    return extracted.withColumn("status", F.when(found == 1, F.lit("ok")).otherwise(F.lit("error"))).withColumn(
        "error", F.when(F.col("status") == "error", F.lit("no field found"))
    )


def extract_report(statuses: DataFrame, discovered: DataFrame | None = None) -> DataFrame:
    """Attempted / extracted / failed / discovered; a missing status is an error."""
    st = F.coalesce(F.col("status"), F.lit("error"))
    rep = statuses.agg(
        F.count(F.lit(1)).alias("pages_attempted"),
        F.count_if(st == "ok").alias("pages_extracted"),
        F.count_if(st != "ok").alias("pages_failed"),
    )
    if discovered is None:
        return rep.withColumn("pages_discovered", F.col("pages_attempted"))
    d = discovered.agg(F.count(F.lit(1)).alias("pages_discovered")).first()["pages_discovered"]
    return rep.withColumn("pages_discovered", F.lit(int(d)).cast("long"))


def ok_results(statuses: DataFrame) -> DataFrame:
    return statuses.where(F.col("status") == "ok")


def failed_results(statuses: DataFrame) -> DataFrame:
    return statuses.where(F.coalesce(F.col("status"), F.lit("error")) != "ok")


def window_chars(model: Column) -> Column:
    pat = "(?i)(" + "|".join(STANDARD_MODEL_MARKERS) + ")"
    return F.when(model.rlike(pat), F.lit(STANDARD_WINDOW)).otherwise(F.lit(ADVANCED_WINDOW))


def model_window(pages: DataFrame, model: str | Column, text_col: str = "text") -> DataFrame:
    """The text a model gets: 8,000 chars for standard tiers, else 30,000."""
    m = F.lit(model) if isinstance(model, str) else model
    w = window_chars(m)
    return pages.withColumn("window_chars", w).withColumn("text_sent", F.expr("substring(" + text_col + ", 1, window_chars)"))


def rate_slots(pages: DataFrame, rpm: int, part: list[str], order: list[str]) -> DataFrame:
    """The minute in which each call may run under ``rpm`` calls per minute.
    Positions come from ``dense_position``, so a hot group is spread."""
    if rpm < 1:
        raise ValueError("rpm must be >= 1")
    p = dense_position(pages, part, order, "_pos")
    return p.withColumn("minute_slot", F.floor((F.col("_pos") - 1) / F.lit(rpm)).cast("long")).drop("_pos")
