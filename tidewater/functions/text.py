"""String helpers expressed as Spark column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_true(col) -> Column:
    """"true" text (any case) -> True; anything else, NULL included -> False."""
    return F.coalesce(F.lower(_c(col)) == F.lit("true"), F.lit(False))


def ends_with_any_case(col, suffix: str) -> Column:
    return F.lower(_c(col)).endswith(suffix.lower())


def base_name(col) -> Column:
    """Last path segment of an object key."""
    return F.substring_index(_c(col), "/", -1)


def title_from_file(col) -> Column:
    """File name -> display title: base name, extension dropped, '_' -> ' ',
    first letter of every word upper-cased (``initcap``: words split on
    whitespace only)."""
    stem = F.regexp_replace(base_name(col), r"\.[^.]*$", "")
    return F.initcap(F.regexp_replace(stem, "_", " "))


def two_decimals(col) -> Column:
    """A number as text with two decimals and thousands separators."""
    return F.format_number(_c(col), 2)


def new_id() -> Column:
    """A random id per row (UUID text): drawn again whenever the plan runs again, so write it before it is used twice."""
    return F.uuid()


def html_escape(col) -> Column:
    """Escape '&' first, then '<' and '>'."""
    c = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def mqtt_filter(topic, pattern: str) -> Column:
    """Topic filter with MQTT wildcards: '+' one level, trailing '#' any
    number of levels (including none). Plain prefix filters become
    ``startswith`` so Parquet can prune on them."""
    t = _c(topic)
    levels = pattern.split("/")
    if "#" in levels[:-1]:
        raise ValueError("'#' is only allowed as the last level")
    if pattern == "#":
        return t.isNotNull()
    if levels[-1] == "#" and "+" not in levels:
        prefix = "/".join(levels[:-1])
        return (t == F.lit(prefix)) | t.startswith(prefix + "/")
    if "+" not in levels and "#" not in levels:
        return t == F.lit(pattern)
    parts = []
    for lv in levels:
        if lv == "+":
            parts.append("[^/]*")
        elif lv == "#":
            parts.append(None)
        else:
            parts.append(re.escape(lv))
    if parts[-1] is None:
        rx = "^" + "/".join(parts[:-1]) + "(/.*)?$"
    else:
        rx = "^" + "/".join(parts) + "$"
    return t.rlike(rx)
