"""Per-key order operators that no hot key can push into one task.

A plain `lag` partitions by the key alone, so one product or handler
holding a third of the rows would be sorted by a single task. Here a count per key comes
first. Keys with few rows take the plain way. The rows of a hot key are cut into calendar
chunks that are ordered on their own, and one summary row per chunk carries values over the
chunk borders. Both ways run in the same window over (key, chunk): an ordinary key simply
has a single chunk.

Bounds: a hot key holds more than 1 / `MAX_HOT_KEYS` of all rows, so there are fewer than
`MAX_HOT_KEYS` of them whatever the data, and their list is broadcast. Within a key times
are unique, so a one-minute chunk has at most as many rows as a minute has microseconds,
and a key has one summary row per minute in which it was seen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.columns import sortable

HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 100_000
CHUNK_MINUTES = 1

# Sort before every real chunk and time, as null times do in a plain sort.
_NO_CHUNK = -(1 << 62)
_NO_TIME = "0001-01-01 00:00:00"
CHUNK = "__chunk"
KEY_GROUPS = 1 << 16
_HOT = "__hot"

Prepare = Callable[[DataFrame], DataFrame]


def keep_first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first `n` rows per key.

    Spark turns this filter into a group limit that runs before the shuffle as well, so a
    key with billions of copies sends at most `n` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def drop_repeats(
    df: DataFrame, keys: list[str], tie_break: list[Column] | None = None
) -> DataFrame:
    """One row per key. The survivor is the first by `tie_break`, which defaults to all
    other sortable columns so that reruns pick the same row."""
    order = tie_break or [F.col(c).asc_nulls_first() for c in sortable(df, exclude=keys)]
    return keep_first(df, keys, order or [F.lit(0)])


def repeated_keys(df: DataFrame, keys: list[str], counts: str | None = None) -> DataFrame:
    """Keys that more than one row has, with their rows as `counts` if it is named. Only the
    keys are shuffled."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return found.select(*keys, *([F.col("__n").alias(counts)] if counts else []))


def drop_listed_repeats(
    df: DataFrame, keys: list[str], repeated: DataFrame, tie_break: list[Column] | None = None
) -> DataFrame:
    """As `drop_repeats`, where `repeated` lists the keys that repeat, few enough to broadcast.

    Rows of other keys are neither sorted nor shuffled; those of listed keys are ordered as ever.
    """
    listed = F.broadcast(repeated)
    again = drop_repeats(join_null_safe(df, listed, keys, "left_semi"), keys, tie_break)
    return join_null_safe(df, listed, keys, "left_anti").unionByName(again)


def _hot_keys(rows: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows and more than their share of all rows."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    crowded = (F.col("__n") > hot_rows) & (F.col("__n") > total / MAX_HOT_KEYS)
    return counts.filter(crowded).select(*keys, F.lit(True).alias(_HOT))


def any_hot(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether `previous_values` has to cut a key into chunks; counts the rows of every key."""
    return not _hot_keys(rows, keys, hot_rows).isEmpty()


def most_rows(rows: DataFrame, keys: list[str]) -> tuple[int, int]:
    """The number of rows, and a bound on the rows of any key: those of the largest of
    `KEY_GROUPS` groups of keys. Only a count for each group and task is shuffled."""
    group = F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))
    counts = rows.groupBy(group.alias("__group")).agg(F.count(F.lit(1)).alias("__n"))
    found = counts.agg(F.sum("__n"), F.max("__n")).first()
    return found[0] or 0, found[1] or 0


def _chunk_number(df: DataFrame, time: str, minutes: int) -> Column:
    """Number of the time's chunk, never decreasing in time. Times without a zone count by
    the clock, so that the session zone's clock changes cannot reorder them."""
    at = F.col(time)
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        days = F.datediff(at, F.lit("1970-01-01").cast("date")).cast("bigint")
        clock = days * 1440 + F.hour(at) * 60 + F.minute(at)
    else:
        clock = F.floor(F.unix_seconds(at.cast("timestamp")) / 60)
    return F.coalesce(F.floor(clock / minutes).cast("bigint"), F.lit(_NO_CHUNK))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys of which null equals null; the keys come from the left."""
    named = right.select(*[
        F.col(c).alias(f"__same_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(Column.__and__, [left[k].eqNullSafe(named[f"__same_{k}"]) for k in keys])
    return left.join(named, same, how).drop(*[f"__same_{k}" for k in keys])


def split_hot(
    source: DataFrame, keys: list[str], time: str, prepare: Prepare, hot_rows: int,
    minutes: int,
) -> tuple[DataFrame, DataFrame]:
    """All prepared rows with their chunk and a mark on hot keys, and those of hot keys
    alone. The latter are picked before `prepare`, so only they run through it again."""
    hot = F.broadcast(_hot_keys(source, keys, hot_rows))
    rows = prepare(source)
    number = _chunk_number(rows, time, minutes)
    marked = join_null_safe(rows, hot, keys, "left").withColumn(
        CHUNK, F.when(F.col(_HOT), number).otherwise(F.lit(_NO_CHUNK))
    )
    only_hot = prepare(join_null_safe(source, hot, keys, "left_semi")).withColumn(CHUNK, number)
    return marked, only_hot


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def _without_repeats(rows: DataFrame, time: str, inside) -> DataFrame:
    """The first row of each time in a window that is ordered by time."""
    same_time = F.lag(time).over(inside).eqNullSafe(F.col(time))
    repeat = same_time & (F.row_number().over(inside) > 1)
    return rows.withColumn("__repeat", repeat).filter(~F.col("__repeat")).drop("__repeat")


def previous_values(
    source: DataFrame,
    keys: list[str],
    time: str,
    values: dict[str, str],
    prepare: Prepare = _as_is,
    hot_rows: int | None = HOT_ROWS,
    minutes: int = CHUNK_MINUTES,
    repeat_order: list[Column] | None = None,
) -> DataFrame:
    """Add, for each `new: column` in `values`, the column of the key's preceding row.

    `prepare` turns the source into the rows to order; it must treat each key by itself and
    add no rows. A null key is a key like any other. A key must have one row per time. With
    `repeat_order` there may be a few: all but the first in that order are dropped, in the
    same pass over the sorted rows. Without `hot_rows` no key is hot (see `any_hot`): one window
    by key does it, which rows that are dealt by ranges of the key need not be shuffled for.
    """
    if hot_rows is None:
        rows = prepare(source)
        inside = Window.partitionBy(*keys).orderBy(
            F.col(time).asc_nulls_first(), *(repeat_order or []))
        rows = _without_repeats(rows, time, inside) if repeat_order else rows
        return rows.withColumns({n: F.lag(c).over(inside) for n, c in values.items()})
    marked, only_hot = split_hot(source, keys, time, prepare, hot_rows, minutes)
    order = [F.col(time).asc_nulls_first(), *(repeat_order or [])]
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    if repeat_order:
        marked = _without_repeats(marked, time, inside)
        only_hot = keep_first(only_hot, [*keys, time], repeat_order)
    local = marked.withColumns({
        **{new: F.lag(column).over(inside) for new, column in values.items()},
        "__head": F.col(_HOT) & (F.row_number().over(inside) == 1),
    })

    at = F.coalesce(F.col(time), F.lit(_NO_TIME).cast(marked.schema[time].dataType))
    tails = only_hot.groupBy(*keys, CHUNK).agg(
        *[F.max_by(F.col(column), at).alias(f"__tail_{new}") for new, column in values.items()]
    )
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = tails.select(
        *keys, CHUNK,
        *[F.lag(f"__tail_{new}").over(across).alias(f"__carry_{new}") for new in values],
    )
    joined = join_null_safe(local, carried, [*keys, CHUNK], "left")
    own = [c for c in marked.columns if c not in (CHUNK, _HOT)]
    return joined.select(
        *own,
        *[
            F.when(F.col("__head"), F.col(f"__carry_{new}")).otherwise(F.col(new)).alias(new)
            for new in values
        ],
    )
