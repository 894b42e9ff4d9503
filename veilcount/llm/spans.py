"""Places of regex matches in whole texts, with built-in functions only. Places count code points, ends are exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BEFORE, _AFTER, _OTHER = "\u0001", "\u0002", "\u0003"
SPANS = "array<struct<start:bigint,stop:bigint,hit:string>>"
TAGGED = "array<struct<rank:int,start:bigint,stop:bigint,kind:string,hit:string>>"


def prepared(text: Column) -> Column:
    """The text with the two marks of `find` replaced, place by place, by a third sign; null becomes empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    marked = F.contains(whole, F.lit(_BEFORE)) | F.contains(whole, F.lit(_AFTER))
    return F.when(marked, F.translate(whole, _BEFORE + _AFTER, _OTHER * 2)).otherwise(whole)


def find(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of `pattern` in a prepared text, as an array of start, stop and hit.

    One regex pass puts a mark before and after every match. The text is split at the first mark, and the lengths of the
    pieces are summed up from left to right. The pattern must not match empty text nor the marks.
    """
    marked = F.concat(F.lit(_AFTER), F.regexp_replace(text, F.lit(pattern), F.lit(_BEFORE + "$0" + _AFTER)))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPANS).alias("found"))

    def step(state: Column, piece: Column) -> Column:
        hit = F.substring_index(piece, _AFTER, 1)
        stop = state["at"] + F.char_length(hit)
        span = F.struct(state["at"].alias("start"), stop.alias("stop"), hit.alias("hit"))
        return F.struct(
            (state["at"] + F.char_length(piece) - 1).cast("bigint").alias("at"),
            F.when(hit == "", state["found"]).otherwise(F.array_append(state["found"], span)).cast(SPANS).alias("found"),
        )

    return F.aggregate(F.split(marked, _BEFORE), start, step, lambda state: state["found"])


def tagged(spans: Column, kind: str, rank: int) -> Column:
    """The spans with a kind and its rank among the kinds."""
    return F.transform(
        spans,
        lambda span: F.struct(
            F.lit(rank).alias("rank"),
            span["start"].alias("start"),
            span["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            span["hit"].alias("hit"),
        ),
    ).cast(TAGGED)


def listed(spans: Column) -> Column:
    """kind:start:end of the spans in their order, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["stop"].cast("string"))
        ),
    )


def digest(listing: Column) -> Column:
    return F.sha2(listing, 256)
