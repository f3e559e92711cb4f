"""Text to number and date, with bad text becoming NULL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number form. Guards the cast, which alone would take '12d' and 'nan'.
NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"

# Each function mentions its input as few times as it can: an input that is itself a long expression is
# evaluated once per mention.


def once(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(c)`` with ``c`` evaluated once.

    A higher-order function also keeps its operator out of the one generated method of a stage. That method, with a
    row's parsing and a filter on it, grows past the size that the JVM compiles and then runs several times slower.
    """
    return F.transform(F.array(c), fn)[0]


def to_number(c: Column) -> Column:
    """Decimal text to double; anything else, thousands separators included, is NULL."""
    return F.regexp_extract(c, rf"^\s*({NUMBER})\s*$", 1).try_cast("double")


def volume_to_number(c: Column) -> Column:
    """``'2,300.1m'`` to 2300100000.0; empty or NULL is 0, other bad text NULL."""
    text = F.upper(F.replace(c, F.lit(","), F.lit("")))
    body = F.regexp_extract(text, rf"^\s*({NUMBER})\s*[KMB]?\s*$", 1).try_cast("double")
    scales = F.create_map(F.lit(""), F.lit(1.0), F.lit("K"), F.lit(1e3), F.lit("M"), F.lit(1e6), F.lit("B"), F.lit(1e9))
    scale = F.element_at(scales, F.regexp_extract(text, r"([KMB])\s*$", 1))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0.0)).otherwise(body * scale)


def percent_to_number(c: Column) -> Column:
    """``'-1,2.5%'`` to -12.5."""
    return to_number(F.replace(F.replace(c, F.lit("%"), F.lit("")), F.lit(","), F.lit("")))


_PARTS = {"yyyy": "[0-9]{4}", "MM": "[0-9]{2}", "dd": "[0-9]{2}"}


def _digits(fmt: str) -> tuple[str, str] | None:
    """Pattern of a year-month-day format in digits and the replacement that puts it in ISO order."""
    tokens = re.findall("yyyy|MM|dd", fmt)
    if sorted(tokens) != ["MM", "dd", "yyyy"] or re.search("[A-Za-z]", re.sub("yyyy|MM|dd", "", fmt)):
        return None
    shape = re.sub("yyyy|MM|dd", lambda m: f"({_PARTS[m.group()]})", re.escape(fmt))
    return f"^{shape}$", "-".join(f"${tokens.index(t) + 1}" for t in ("yyyy", "MM", "dd"))


def to_date(c: Column, formats: tuple[str, ...]) -> Column:
    """First format of the ordered list that parses wins; no match is NULL.

    Formats in digits are put in ISO order and cast, all in one expression as long as their shapes differ;
    the cast does not raise on bad text, which a parser does at a cost. Other formats go to the parser.
    """
    return once(c, lambda x: _first_date(x, formats))


def _first_date(c: Column, formats: tuple[str, ...]) -> Column:
    layers: list[dict[str, str]] = []
    worded = []
    for f in formats:
        form = _digits(f)
        if form is None:
            worded.append(F.try_to_date(c, f))
            continue
        for layer in layers:
            if form[0] not in layer:
                layer[form[0]] = form[1]
                break
        else:
            layers.append(dict([form]))
    out = []
    for layer in layers:
        iso = c
        for shape, order in layer.items():
            if order != "$1-$2-$3" or "\\-" not in shape:
                iso = F.regexp_replace(iso, shape, order)
        out.append(F.regexp_extract(iso, "^[0-9]{4}-[0-9]{2}-[0-9]{2}$", 0).try_cast("date"))
    return F.coalesce(*out, *worded)


def parse_history(c: Column) -> Column:
    """Comma text to an array of doubles, dropping blanks and words."""
    return F.filter(F.transform(F.split(c, ","), to_number), lambda x: x.isNotNull())
