"""Ordered work over groups that may be too large for one task.

Spark runs a window group in one task. With a handful of keys (services, languages, or no key at
all) that task would hold a large share of the table, so every operator here first looks at the
largest group. Up to ``limit`` rows the ordinary window is used: one shuffle, one sort. Beyond it
the rows get an exact position in the total order and are cut by position into chunks of ``limit``
rows, so a hot key is spread over as many tasks as it needs and the results stay exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.session import stored

MAX_GROUP_ROWS = 4_000_000

_CHUNK, _COPY, _AT = "_chunk", "_copy", "_at"
_PLACED, _SLICE = "_placed", "_slice"


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group (all rows without keys); partial counts run before the shuffle."""
    if not keys:
        return df.count()
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def fits(df: DataFrame, keys: Sequence[str], limit: int, group_rows: int | None = None) -> bool:
    """Whether every group is small enough for one task. ``group_rows`` is an upper bound the caller
    knows, such as the largest group of the base table; it decides without another counting pass,
    which for a derived frame would compute it twice. The chunked form is right either way."""
    if group_rows is not None:
        return group_rows <= limit
    return largest_group(df, keys) <= limit


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Zero-based position of each row in the total order ``order``.

    The range sort balances slices whatever the skew of the leading column. The sorted rows are
    stored once: slice numbers must not move if a lost executor makes Spark sort again.
    """
    placed = stored(df.orderBy(*order).withColumn(_PLACED, F.monotonically_increasing_id()), "sorted")
    slices = placed.groupBy(F.shiftright(_PLACED, 33).alias(_SLICE)).agg(F.count("*").alias("_n"))
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per sort partition
    offsets = slices.select(_SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.col(_PLACED) - F.shiftleft(F.col(_SLICE), 33)
    return (
        placed.withColumn(_SLICE, F.shiftright(_PLACED, 33))
        .join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col("_first") + within)
        .drop(_SLICE, _PLACED, "_first")
    )


def global_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "row_index",
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """``with_row_index``, or a plain ``row_number`` while the whole table fits one task."""
    if fits(df, [], limit, group_rows):
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    return with_row_index(df, order, name)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Window expressions that look at most ``before`` rows back within ``keys``.

    ``compute`` gets the frame and an ordered window. In the chunked form the last ``before`` rows
    of a chunk are also handed to the next chunk as context and dropped again afterwards.
    """
    if fits(df, keys, limit, group_rows):
        return compute(df, Window.partitionBy(*keys).orderBy(*order))
    chunked = _chunks(df, [*keys, *order], max(limit, before + 1))
    return _over_chunks(chunked, keys, before, compute, max(limit, before + 1)).drop(_CHUNK, _AT)


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, Column],
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Inclusive running totals per key, added as the columns named in ``sums``."""
    if fits(df, keys, limit, group_rows):
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.sum(value).over(window) for name, value in sums.items()})
    return _sum_chunks(_chunks(df, [*keys, *order], limit), keys, sums).drop(_CHUNK, _AT)


def over_rows_then_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    sums: Mapping[str, Column],
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """``over_rows`` followed by ``running_sums`` of its results, in one order."""
    if fits(df, keys, limit, group_rows):
        window = Window.partitionBy(*keys).orderBy(*order)
        running = window.rowsBetween(Window.unboundedPreceding, 0)
        return compute(df, window).withColumns({name: F.sum(v).over(running) for name, v in sums.items()})
    size = max(limit, before + 1)
    done = _over_chunks(_chunks(df, [*keys, *order], size), keys, before, compute, size)
    return _sum_chunks(done, keys, sums).drop(_CHUNK, _AT)


def _chunks(df: DataFrame, order: Sequence[str | Column], size: int) -> DataFrame:
    return with_row_index(df, order, _AT).withColumn(_CHUNK, F.floor(F.col(_AT) / size))


def _over_chunks(chunked: DataFrame, keys: Sequence[str], before: int, compute, size: int) -> DataFrame:
    own = F.struct(F.col(_CHUNK).alias("c"), F.lit(False).alias("copy"))
    context = F.struct((F.col(_CHUNK) + 1).alias("c"), F.lit(True).alias("copy"))
    places = F.when(F.col(_AT) % size >= size - before, F.array(own, context)).otherwise(F.array(own))
    dealt = (
        chunked.withColumn("_place", F.explode(places))
        .withColumns({_CHUNK: F.col("_place.c"), _COPY: F.col("_place.copy")})
        .drop("_place")
    )
    done = compute(dealt, Window.partitionBy(_CHUNK, *keys).orderBy(_AT))
    return done.filter(~F.col(_COPY)).drop(_COPY)


def _sum_chunks(chunked: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Running totals within each chunk plus the totals of the key's earlier chunks."""
    window = Window.partitionBy(_CHUNK, *keys).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumns({name: F.sum(value).over(window) for name, value in sums.items()})
    totals = chunked.groupBy(_CHUNK, *keys).agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()]
    )
    # one row per (chunk, key): a hot key has its rows / limit of them
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(_CHUNK).alias("_sum_chunk_"),
        *[F.col(k).alias(f"_sum_key_{i}") for i, k in enumerate(keys)],
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_sum_{name}") for name in sums],
    )
    same = F.col(_CHUNK) == F.col("_sum_chunk_")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_sum_key_{i}"))
    joined = local.join(carried, same).withColumns(
        {name: F.col(name) + F.coalesce(F.col(f"_sum_{name}"), F.lit(0)) for name in sums}
    )
    made = [f"_sum_key_{i}" for i in range(len(keys))] + [f"_sum_{name}" for name in sums]
    return joined.drop("_sum_chunk_", *made)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Sequence[float],
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles per key: one row per key with ``q0, q1, …``.

    ``percentile`` keeps every distinct value of a group in one buffer; past ``limit`` the values
    are counted first, the counts are accumulated in order, and the ranks are read off.
    """
    known = df.filter(F.col(value).isNotNull())
    if fits(known, keys, limit, group_rows):
        wanted = F.array(*[F.lit(float(f)) for f in fractions])
        together = known.groupBy(*keys).agg(F.percentile(value, wanted).alias("_q"))
        return together.select(*keys, *[F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(fractions))])
    counted = known.groupBy(*keys, value).agg(F.count("*").alias("_c"))
    ranked = running_sums(counted, keys, [value], {"_upto": F.col("_c")}, limit=limit)
    totals = known.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        F.col("_n"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)]
    )
    if keys:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_t{i}"))
        placed = ranked.join(totals, same)
    else:
        placed = ranked.withColumn("_n", F.lit(known.count()))
    picks = []
    for i, fraction in enumerate(fractions):
        at = F.lit(float(fraction)) * (F.col("_n") - 1)
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (position >= F.col("_upto") - F.col("_c")) & (position < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{side}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_f{i}"))
        picks.append(F.max(F.ceil(at) - at).alias(f"_g{i}"))
    read = placed.groupBy(*keys).agg(*picks)
    # the formula of ``percentile``, so that both forms agree in every digit
    between = lambda i: F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}").cast("double")).otherwise(
        F.col(f"_g{i}") * F.col(f"_lo{i}") + F.col(f"_f{i}") * F.col(f"_hi{i}")
    )
    return read.select(*keys, *[between(i).alias(f"q{i}") for i in range(len(fractions))])
