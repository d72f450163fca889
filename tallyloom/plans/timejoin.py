"""Time-based joins and windows that never list pairs within a key.

All of them place both sides in one ordered stream per (key, time slice) and
read the answer from a running maximum. A hot key is cut by time, so no task
holds more than one slice of it, and no result row depends on how many rows of
the other side are near it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(column: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    col = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(col.cast("timestamp"))


def _floor_div(column: Column, width: int | Column) -> Column:
    step = F.lit(width) if isinstance(width, int) else width
    return ((column - F.pmod(column, step)) / step).cast("long")


def _scattered(keys: Sequence[str], part: Column, by: Sequence[str]) -> Column:
    """``part``; rows with a null key never match, so they are spread by a hash of ``by`` instead of meeting in one task."""
    return F.when(_all([F.col(k).isNotNull() for k in keys]), part).otherwise(F.xxhash64(*by))


def point_in_time_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    at: str,
    event_time: str,
    values: Sequence[str],
    created: str | None = None,
    tie: str | None = None,
    ttl_seconds: int | None = None,
    slice_seconds: int = 86_400,
    prefix: str = "",
) -> DataFrame:
    """Attach to every entity row the newest feature row known at its time.

    Known means event time <= ``at`` and, with ``created``, created <= ``at``.
    Newest is the latest event time, then created, then ``tie``. Two levels: a
    running maximum inside a slice, and a carry from earlier slices.
    """
    width = slice_seconds * MICROS
    known = micros(event_time) if created is None else F.greatest(micros(event_time), micros(created))
    order = [micros(event_time).alias("__event")]
    if created is not None:
        order.append(micros(created).alias("__created"))
    if tie is not None:
        order.append(F.col(tie).alias("__tie"))
    payload = F.struct(*order, *[F.col(v).alias(f"__v_{v}") for v in values])
    valid = [F.col(k).isNotNull() for k in keys] + [F.col(event_time).isNotNull()]
    if created is not None:
        valid.append(F.col(created).isNotNull())
    right = features.filter(_all(valid)).select(
        *keys, known.alias("__t"), F.lit(0).alias("__side"), payload.alias("__f")
    )
    kept = [c for c in entities.columns if c not in keys]
    left = entities.select(
        *keys,
        micros(at).alias("__t"),
        F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in kept]).alias("__l"),
    )
    stream = left.unionByName(right, allowMissingColumns=True).withColumn(
        "__slice", _scattered(keys, _floor_div(F.col("__t"), width), ["__t"])
    )
    inside = (
        Window.partitionBy(*keys, "__slice")
        .orderBy("__t", "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Rows with a null key need no carry: nothing on the right can match them.
    carry = (
        stream.filter(_all([F.col(k).isNotNull() for k in keys])).groupBy(*keys, "__slice")
        .agg(F.max("__f").alias("__best"))
        .select(*keys, "__slice", F.max("__best").over(earlier).alias("__carry"))
    )
    local = stream.withColumn("__now", F.max("__f").over(inside)).filter(F.col("__side") == 1)
    joined = local.join(carry, [*keys, "__slice"], "left")
    found = joined.withColumn("__got", F.greatest("__now", "__carry"))
    if ttl_seconds is not None:
        fresh = F.col("__t") - F.col("__got.__event") <= F.lit(ttl_seconds * MICROS)
        found = found.withColumn("__got", F.when(fresh, F.col("__got")))
    return found.select(
        *keys,
        *[F.col("__l")[c].alias(c) for c in kept],
        *[F.col("__got")[f"__v_{v}"].alias(f"{prefix}{v}") for v in values],
    )


def interval_latest_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: Sequence[str],
    at: str,
    start: str,
    end: str,
    update: str,
    tie: str,
    values: Sequence[str],
) -> DataFrame:
    """Left join to the newest of the intervals that hold at ``at``.

    A right row holds when start <= at < end and update <= at; the newest
    update wins, then the lowest ``tie``. Each interval gets the power-of-two
    slice width just below its own length, so it touches at most three slices:
    it runs to the end of the first ones (a running maximum from its start) and
    ends inside the last one (a running maximum backwards from its end).
    """
    opens = F.greatest(micros(start), micros(update))
    usable = right.select(
        *keys,
        opens.alias("__s"),
        micros(end).alias("__e"),
        F.struct(
            micros(update).alias("__u"),
            (-F.col(tie)).alias("__tie"),
            *[F.col(v).alias(f"__v_{v}") for v in values],
        ).alias("__f"),
    ).filter(_all([F.col(k).isNotNull() for k in keys]) & (F.col("__e") > F.col("__s")))
    usable = usable.withColumn("__w", F.expr("shiftleft(1L, length(bin(__e - __s)) - 1)"))
    widths = sorted(r[0] for r in usable.select("__w").distinct().collect())  # at most 63 values
    if not widths:
        widths = [MICROS]
    first, last = _floor_div(F.col("__s"), F.col("__w")), _floor_div(F.col("__e") - 1, F.col("__w"))
    pieces = usable.withColumn("__slice", F.explode(F.sequence(first, last)))
    slice_from = F.col("__slice") * F.col("__w")
    runs_out = F.col("__e") >= slice_from + F.col("__w")
    pieces = pieces.select(
        *keys,
        "__w",
        "__slice",
        F.when(runs_out, F.greatest(F.col("__s"), slice_from)).otherwise(F.col("__e")).alias("__t"),
        F.when(runs_out, F.col("__f")).alias("__head"),
        F.when(~runs_out, F.col("__f")).alias("__tail"),
        F.lit(0).alias("__side"),
    )
    kept = [c for c in left.columns if c not in keys and c not in left_id]
    points = left.select(
        *keys,
        *[F.col(c).alias(f"__id_{c}") for c in left_id],
        F.struct(*[F.col(c) for c in kept]).alias("__l"),
        micros(at).alias("__t"),
        F.lit(1).alias("__side"),
        F.explode(F.array(*[F.lit(w) for w in widths])).alias("__w"),
    ).withColumn("__slice", _scattered(keys, _floor_div(F.col("__t"), F.col("__w")), [f"__id_{c}" for c in left_id]))
    stream = points.unionByName(pieces, allowMissingColumns=True)
    where = [*keys, "__w", "__slice"]
    running = (Window.unboundedPreceding, Window.currentRow)
    forward = Window.partitionBy(*where).orderBy("__t", "__side").rowsBetween(*running)
    backward = (
        Window.partitionBy(*where)
        .orderBy(F.col("__t").desc(), F.col("__side").desc())
        .rowsBetween(*running)
    )
    found = stream.select(
        "*", F.max("__head").over(forward).alias("__h"), F.max("__tail").over(backward).alias("__k")
    ).filter(F.col("__side") == 1)
    found = found.withColumn("__got", F.greatest("__h", "__k"))
    if len(widths) > 1:
        # Equal left rows meet in one group and get the same answer; each is given back as often as it came.
        ids = [f"__id_{c}" for c in left_id]
        copies = (F.count(F.lit(1)) / F.lit(len(widths))).cast("int")
        found = found.groupBy(*keys, *ids, "__l").agg(F.max("__got").alias("__got"), copies.alias("__copies"))
        found = found.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies")))
    return found.select(
        *keys,
        *[F.col(f"__id_{c}").alias(c) for c in left_id],
        *[F.col("__l")[c].alias(c) for c in kept],
        *[F.col("__got")[f"__v_{v}"].alias(v) for v in values],
    )


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    time: str,
    tie: str,
    values: Sequence[str],
    offset_seconds: int,
    tolerance_seconds: int,
) -> DataFrame:
    """Attach the right row nearest to ``at`` + offset, within a tolerance.

    The earlier row wins when two are equally near. Slices are as wide as the
    tolerance and right rows are seen by the neighbouring slices too.
    """
    width = tolerance_seconds * MICROS
    kept = [c for c in left.columns if c not in keys]
    points = left.select(
        *keys,
        F.struct(*[F.col(c) for c in kept]).alias("__l"),
        (micros(at) + F.lit(offset_seconds * MICROS)).alias("__t"),
        F.lit(1).alias("__side"),
    ).withColumn("__slice", _scattered(keys, _floor_div(F.col("__t"), width), ["__t"]))
    body = [F.col(v).alias(f"__v_{v}") for v in values]
    targets = right.filter(_all([F.col(k).isNotNull() for k in keys])).select(
        *keys,
        micros(time).alias("__t"),
        F.struct(micros(time).alias("__rt"), (-F.col(tie)).alias("__tie"), *body).alias("__back"),
        F.struct(micros(time).alias("__rt"), F.col(tie).alias("__tie"), *body).alias("__ahead"),
        F.lit(0).alias("__side"),
    )
    base = _floor_div(F.col("__t"), width)
    targets = targets.withColumn("__slice", F.explode(F.sequence(base - 1, base + 1)))
    stream = points.unionByName(targets, allowMissingColumns=True)
    running = (Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys, "__slice").orderBy("__t", "__side").rowsBetween(*running)
    after = (
        Window.partitionBy(*keys, "__slice")
        .orderBy(F.col("__t").desc(), F.col("__side"))
        .rowsBetween(*running)
    )
    found = stream.select(
        "*", F.max("__back").over(before).alias("__p"), F.min("__ahead").over(after).alias("__n")
    ).filter(F.col("__side") == 1)
    gap_p = F.col("__t") - F.col("__p.__rt")
    gap_n = F.col("__n.__rt") - F.col("__t")
    near_p = gap_p <= F.lit(width)
    near_n = gap_n <= F.lit(width)
    use_p = near_p & (~F.coalesce(near_n, F.lit(False)) | (gap_p <= gap_n))
    return found.select(
        *keys,
        *[F.col("__l")[c].alias(c) for c in kept],
        *[
            F.when(use_p, F.col("__p")[f"__v_{v}"])
            .when(near_n, F.col("__n")[f"__v_{v}"])
            .alias(v)
            for v in values
        ],
    )


def trailing_window(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    lookback_seconds: int,
    measures: Callable[[Callable[[int], WindowSpec]], Mapping[str, Column]],
) -> DataFrame:
    """Aggregates over [t - s, t] per key for s up to the look-back.

    ``measures`` gets a function from seconds to the window of that length.
    Slices are as wide as the look-back, and every row is also context for the
    next slice, so each frame lies inside one window partition.
    """
    width = lookback_seconds * MICROS
    base = _floor_div(F.col("__t"), width)
    places = F.array(
        F.struct(base.alias("__slice"), F.lit(True).alias("__live")),
        F.struct((base + 1).alias("__slice"), F.lit(False).alias("__live")),
    )
    seen = df.withColumn("__t", micros(time)).select("*", F.inline(places))

    def frame(seconds: int) -> WindowSpec:
        ordered = Window.partitionBy(*keys, "__slice").orderBy("__t")
        if seconds > lookback_seconds:
            raise ValueError(f"a frame of {seconds} s is longer than the look-back of {lookback_seconds} s")
        return ordered.rangeBetween(-seconds * MICROS, 0)

    columns = [c.alias(n) for n, c in measures(frame).items()]
    return seen.select("*", *columns).filter("__live").drop("__t", "__slice", "__live")


def with_neighbours(
    df: DataFrame, keys: Sequence[str], time: str, column: str, slice_seconds: int = 86_400
) -> DataFrame:
    """Add ``before`` and ``after``: the nearest non-null (t, v) of the key at or
    before and at or after each row. Same two levels as the as-of join."""
    width = slice_seconds * MICROS
    known = F.when(F.col(column).isNotNull(), F.struct(F.col("__t").alias("t"), F.col(column).alias("v")))
    rows = df.withColumn("__t", micros(time)).withColumn("__slice", _floor_div(F.col("__t"), width))
    rows = rows.withColumn("__k", known)
    place = Window.partitionBy(*keys, "__slice")
    back = place.orderBy("__t").rangeBetween(Window.unboundedPreceding, 0)
    ahead = place.orderBy(F.col("__t").desc()).rangeBetween(Window.unboundedPreceding, 0)
    over_slices = Window.partitionBy(*keys).orderBy("__slice")
    carried = (
        rows.groupBy(*keys, "__slice")
        .agg(F.max("__k").alias("__last"), F.min("__k").alias("__first"))
        .select(
            *keys,
            "__slice",
            F.max("__last").over(over_slices.rowsBetween(Window.unboundedPreceding, -1)).alias("__b"),
            F.min("__first").over(over_slices.rowsBetween(1, Window.unboundedFollowing)).alias("__a"),
        )
    )
    local = rows.select("*", F.max("__k").over(back).alias("__lb"), F.min("__k").over(ahead).alias("__la"))
    return (
        local.join(carried, [*keys, "__slice"], "left")
        .withColumn("before", F.coalesce("__lb", "__b"))
        .withColumn("after", F.coalesce("__la", "__a"))
        .drop("__slice", "__k", "__b", "__a", "__lb", "__la")
    )


def interpolate(df: DataFrame, keys: Sequence[str], time: str, column: str, out: str) -> DataFrame:
    """Fill gaps on the straight line between the neighbouring known values;
    before the first and after the last known value the gap stays."""
    around = with_neighbours(df, keys, time, column)
    share = (F.col("__t") - F.col("before.t")) / (F.col("after.t") - F.col("before.t")).cast("double")
    line = F.col("before.v") + (F.col("after.v") - F.col("before.v")) * share
    filled = F.when(F.col(column).isNotNull(), F.col(column)).when(
        F.col("before").isNotNull() & F.col("after").isNotNull(), line
    )
    return around.withColumn(out, filled).drop("__t", "before", "after")


def sessions(
    df: DataFrame, keys: Sequence[str], time: str, gap_seconds: int, slice_seconds: int = 3_600
) -> DataFrame:
    """Session start, end and row count per key; a gap longer than
    ``gap_seconds`` starts a new session.

    Islands are found per (key, slice) first. Only islands, at most one per gap
    and slice, go on to the window over the whole key.
    """
    gap, width = gap_seconds * MICROS, slice_seconds * MICROS
    rows = df.select(*keys, micros(time).alias("__t")).withColumn(
        "__slice", _floor_div(F.col("__t"), width)
    )
    islands = _islands(
        rows.select(*keys, "__slice", F.col("__t").alias("__from"), F.col("__t").alias("__to"), F.lit(1).alias("__n")),
        [*keys, "__slice"],
        gap,
    )
    merged = _islands(islands.drop("__slice"), keys, gap)
    return merged.select(
        *keys,
        F.timestamp_micros("__from").cast("timestamp_ntz").alias("session_start"),
        F.timestamp_micros("__to").cast("timestamp_ntz").alias("session_end"),
        F.col("__n").cast("long").alias("n"),
    )


def _islands(spans: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy("__from", "__to")
    fresh = F.col("__from") - F.lag("__to").over(ordered) > F.lit(gap)
    marked = spans.withColumn("__new", F.when(fresh, 1).otherwise(0))
    numbered = marked.withColumn(
        "__island",
        F.sum("__new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    return (
        numbered.groupBy(*keys, "__island")
        .agg(F.min("__from").alias("__from"), F.max("__to").alias("__to"), F.sum("__n").alias("__n"))
        .drop("__island")
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out
