"""Line protocol text by column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _escape(text: Column, *specials: str) -> Column:
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(shown))
    for char in specials:
        text = F.replace(text, F.lit(char), F.lit("\\" + char))
    return text


def escape_measurement(text: Column) -> Column:
    return _escape(text, ",", " ")


def escape_key(text: Column) -> Column:
    """Tag keys, tag values and field keys."""
    return _escape(text, ",", " ", "=")


def _by_key(entries: Column) -> Column:
    return F.array_sort(F.map_entries(entries))


def line(
    measurement: Column, tags: Column, fields: Column, int_fields: Column, time_ms: Column
) -> Column:
    """One point as text, tags and fields in key order."""
    tag_texts = F.transform(
        _by_key(tags), lambda e: F.concat(escape_key(e["key"]), F.lit("="), escape_key(e["value"]))
    )

    def texts(entries: Column, ending: str) -> Column:
        return F.transform(
            F.map_entries(entries),
            lambda e: F.struct(
                e["key"].alias("key"), F.concat(e["value"].cast("string"), F.lit(ending)).alias("text")
            ),
        )

    both = F.array_sort(F.concat(texts(fields, ""), texts(int_fields, "i")))
    field_texts = F.transform(both, lambda e: F.concat(escape_key(e["key"]), F.lit("="), e["text"]))
    series = F.array_join(
        F.concat(F.array(escape_measurement(measurement)), F.coalesce(tag_texts, F.array())), ","
    )
    return F.concat_ws(" ", series, F.array_join(field_texts, ","), time_ms.cast("string"))
