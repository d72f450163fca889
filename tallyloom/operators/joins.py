"""Join forms beyond the built-in ones.

Equi joins carry no strategy hint: Spark broadcasts a side only below its size
threshold and otherwise AQE splits skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_with_default(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join, then fill the given right columns where no row matched."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fold_pages(
    df: DataFrame, keys: Sequence[str], position: str, page_size: int, arrays: Mapping[str, str]
) -> DataFrame:
    """One document per (keys, page) with arrays in ``position`` order.

    Positions are cut into pages, so a long key yields many bounded documents.
    """
    page = F.floor(F.col(position) / F.lit(page_size)).cast("long")
    folded = df.groupBy(*keys, page.alias("page")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(F.col(position).alias("__p"), *[F.col(c).alias(a) for a, c in arrays.items()])
            )
        ).alias("__rows")
    )
    return folded.select(
        *keys, "page", *[F.col(f"__rows.{a}").alias(a) for a in arrays]
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def map_of_last(entries: Column) -> Column:
    """Map from an array of (k, v): null keys are left out, and of equal keys the last one counts.

    Places are sorted by key, so a document of n entries takes n log n steps.
    """
    def build(given: Column) -> Column:
        places = F.transform(given, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i")))
        places = F.sort_array(F.filter(places, lambda p: p["k"].isNotNull()))
        return bound(places, lambda sorted_: F.map_from_entries(F.transform(
            F.filter(sorted_, lambda p, j: ~p["k"].eqNullSafe(F.get(sorted_, j + 1)["k"])), lambda p: F.get(given, p["i"]))))

    return bound(entries, build)


def lookup_in_document(
    docs: DataFrame,
    readings: str,
    reading_key: str,
    stations: str,
    station_key: str,
    attributes: Mapping[str, str],
) -> DataFrame:
    """Explode ``readings`` and attach attributes of the station each names.

    The lookup table lives in the same document, so a map inside the row
    replaces a join. Unknown stations give null attributes.
    """
    lookup = map_of_last(F.transform(F.col(stations), lambda s: F.named_struct(F.lit("k"), s[station_key], F.lit("v"), s)))
    rest = [c for c in docs.columns if c not in (readings, stations)]
    rows = docs.withColumn("__map", lookup).select(
        *rest, "__map", F.explode(readings).alias("reading")
    )
    station = F.try_element_at(F.col("__map"), F.col("reading")[reading_key])
    return rows.select(
        *rest, "reading", *[station[a].alias(out) for a, out in attributes.items()]
    )


def dense_grid(
    df: DataFrame, time: str, area: str, counts: DataFrame, defaults: Mapping[str, object]
) -> DataFrame:
    """Every (time, area) that can occur, with defaults where no count exists.

    Distinct times are dealt over parts and each distinct area goes to every
    part, so that the grid, which is the output itself, is made part by part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    times = df.select(time).filter(F.col(time).isNotNull()).distinct().withColumn("__part", F.pmod(F.xxhash64(time), F.lit(parts)))
    areas = df.select(area).filter(F.col(area).isNotNull()).distinct()
    areas = areas.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    grid = times.join(areas, "__part").select(time, area)
    return merge_with_default(grid, counts, [time, area], defaults)
