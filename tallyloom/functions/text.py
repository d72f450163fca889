"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(column: Column) -> Column:
    """Trimmed, capital after every non-letter, other letters lower.

    ``initcap`` capitalises after white space only, so the text is cut behind
    each non-letter first: north-eastern becomes North-Eastern.
    """
    pieces = F.split(F.lower(F.trim(column)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def join_name(column: Column) -> Column:
    """Form of a name used as a join key: trimmed, upper case."""
    return F.upper(F.trim(column))


def first_non_empty(*columns: Column) -> Column:
    """First value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in columns])


def record_id(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def value_map(column: Column, mapping: Mapping, default=None) -> Column:
    """Code to label, with a default for unknown codes."""
    if not mapping:
        return F.lit(default)
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, column), F.lit(default))


def rain_flag(forecast: Column) -> Column:
    """1 when the forecast text speaks of rain, showers or thunder."""
    return F.when(forecast.rlike("(?i)rain|shower|thunder"), 1).otherwise(0)


def category_id(column: Column, categories: Sequence[str]) -> Column:
    """Position in a fixed list of categories, -1 for others."""
    position = F.array_position(F.array(*[F.lit(c) for c in categories]), column)
    return F.coalesce(position - 1, F.lit(-1)).cast("long")


# Upper bounds in mm per hour of the rainfall intensity classes.
INTENSITY_CUTS = ((0.5, "none"), (2.0, "light"), (10.0, "moderate"), (30.0, "heavy"))


def intensity_class(five_minute_mm: Column) -> Column:
    """Class of a five-minute total, as a rate per hour; missing means none."""
    rate = F.coalesce(five_minute_mm, F.lit(0.0)) * 12
    return _first_below(rate, INTENSITY_CUTS, "violent")


# Upper bounds of the share-of-maximum classes.
SHARE_CUTS = ((0.15, "very low"), (0.35, "low"), (0.60, "medium"), (0.85, "high"))


def share_class(value: Column, largest: Column) -> Column:
    """Class of a value as a share of the largest one; zero or less is empty."""
    share = value / F.greatest(largest.cast("double"), F.lit(1.0))
    return F.when(value <= 0, "empty").otherwise(_first_below(share, SHARE_CUTS, "top"))


def _first_below(value: Column, cuts, last: str) -> Column:
    out = F.lit(last)
    for limit, name in reversed(cuts):
        out = F.when(value < F.lit(limit), F.lit(name)).otherwise(out)
    return out
