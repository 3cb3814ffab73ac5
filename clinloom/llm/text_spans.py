"""Positions of pattern matches, with built-in functions only.

``split`` gives the text between the matches and ``regexp_extract_all`` the matches;
running lengths of the two (code points) are the positions.  Patterns never match the
empty string.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,rank:int,start:int,end:int,value:string>>"


def find_spans(text: Column, kind: str, rank: int, pattern: str, may: Column, ok: Callable[[Column], Column]) -> Column:
    """All leftmost non-overlapping matches whose text passes ``ok``, as SPAN.
    ``may`` is a cheap test that every text with a match passes."""
    whole = F.lit(pattern)
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, whole, F.lit(0)),
                       lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), start.alias("start"),
                        (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))
        keep = x["value"].isNotNull() & ok(x["value"])
        return F.struct((start + F.coalesce(F.length(x["value"]), F.lit(0))).alias("at"),
                        F.when(F.coalesce(keep, F.lit(False)), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    empty = F.array().cast(SPAN)
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda s: s["out"])
    return F.when(may, found).otherwise(empty)


def written(spans: Column, order: Callable[[Column], Column]) -> Column:
    """kind:start:end, joined by commas in the order of ``order(span)``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(order(s).alias("o"), F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("t"))))
    return F.array_join(F.transform(ordered, lambda s: s["t"]), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by [KIND]; overlapping spans become one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def put(state: Column, s: Column) -> Column:
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        new = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], -s["back"]).alias("at"), F.when(new, F.concat(
            state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), tag)).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, start, put, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))))
