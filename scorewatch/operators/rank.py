"""Exact running counts, quantiles and ranks without a one-task window.

A window ordered over a whole feature puts all its values in one task. Here rows are first pre-aggregated to
distinct values, then every key with many rows is cut into value buckets; windows run inside a bucket and the
totals of earlier buckets are added on top. Bucket borders come from a small sample: they only decide how the
work is spread, the result is the same for any borders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import lerp_sql
from ..session import BROADCAST_ROWS, keyed_join, pin

ROWS_PER_BUCKET = 1_000_000
SAMPLE_PER_BUCKET = 24


@dataclass(frozen=True)
class Spread:
    """How the keys of one ranking are laid out."""

    few_keys: bool  # the number of keys was counted and is at most BROADCAST_ROWS
    borders: DataFrame | None  # keys + sorted border array of the cut keys; None when no key needs cutting
    few_buckets: bool = True  # the buckets of all cut keys were counted and are at most BROADCAST_ROWS


def measure(
    rows: DataFrame,
    keys,
    value: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    source: DataFrame | None = None,
    source_keys=(),
    fan_out: int = 1,
    counts: DataFrame | None = None,
) -> Spread:
    """Count rows per group and sample bucket borders for every group with more than `rows_per_bucket` rows.

    `source` is the frame the rows were unpivoted from, with `fan_out` keys per group of `source_keys`: its row
    counts bound those of every key and need no feature column. Without it the rows themselves are counted. `counts` are
    such counts taken before (source keys, n; one row without keys).
    Counts and borders stay tables, with a row per group and per cut key; the driver sees their totals only.
    """
    if source is None:
        source, source_keys, fan_out = rows, keys, 1
    source_keys = list(source_keys)
    if counts is not None:
        groups = counts.select(*source_keys, "n")
    elif source_keys:
        groups = pin(source.groupBy(*source_keys).agg(F.count(F.lit(1)).alias("n")))  # looked at twice
    else:
        groups = rows.sparkSession.createDataFrame([(source.count(),)], "n long")
    buckets = F.ceil(F.col("n") / rows_per_bucket).cast("int")
    large = groups.where(F.col("n") > rows_per_bucket).withColumn("buckets", buckets).drop("n")
    found, hot_rows, hot, cut = groups.agg(
        F.count("*"),
        F.sum(F.when(F.col("n") > rows_per_bucket, F.col("n"))),
        F.count_if(F.col("n") > rows_per_bucket),
        F.sum(F.when(F.col("n") > rows_per_bucket, buckets)),
    ).first()
    few = found * fan_out <= BROADCAST_ROWS
    if not hot:
        return Spread(few, None)
    fraction = min(1.0, SAMPLE_PER_BUCKET * cut / hot_rows)
    narrow = rows.select(*keys, F.col(value).alias("v"))
    if source_keys:
        sampled = keyed_join(narrow, large, source_keys, broadcast=hot <= BROADCAST_ROWS)
    else:
        sampled = narrow.withColumn("buckets", F.lit(cut))
    # about SAMPLE_PER_BUCKET values per bucket of a key
    picked = sampled.sample(fraction, seed=17).groupBy(*keys).agg(
        F.expr("array_sort(collect_list(v)) AS s"), F.expr("first(buckets) AS buckets")
    )
    cuts = "element_at(s, greatest(1, int(i * size(s) / buckets)))"
    borders = picked.selectExpr(
        *[f"`{k}`" for k in keys],
        f"array_distinct(transform(sequence(1, greatest(1, buckets - 1)), i -> {cuts})) AS cuts",
    )
    # halving steps of the search: powers of two from the largest within the array down to 1
    steps = "transform(sequence(int(length(bin(size(cuts))) - 1), 0, -1), e -> shiftleft(1, e)) AS steps"
    return Spread(few, pin(borders.selectExpr("*", steps)), cut * fan_out <= BROADCAST_ROWS)


def with_bucket(rows: DataFrame, keys, value: str, spread: Spread) -> DataFrame:
    """Add the value bucket: the number of borders at or below the value, by binary search. Uncut keys use bucket 0.

    The borders are broadcast where their number was counted and is small; else they are joined by key, and adaptive
    execution splits the rows of a hot key.
    """
    if spread.borders is None:
        return rows.withColumn("bucket", F.lit(0))
    joined = keyed_join(rows, spread.borders, keys, "left", broadcast=spread.few_buckets)
    search = f"aggregate(steps, 0, (at, step) -> IF(get(cuts, at + step - 1) <= `{value}`, at + step, at))"
    return joined.withColumn("bucket", F.expr(f"coalesce({search}, 0)")).drop("cuts", "steps")


def value_counts(rows: DataFrame, keys, value: str, counts: dict[str, str]) -> DataFrame:
    """One row per distinct value and key with its summed counts; heavy values collapse map-side."""
    return rows.groupBy(*keys, F.col(value).alias("value")).agg(*[F.expr(f"sum({c}) AS {n}") for n, c in counts.items()])


def _partition(keys) -> str:
    return "PARTITION BY " + ", ".join(f"`{k}`" for k in keys)


def running_counts(distinct: DataFrame, keys, names, spread: Spread, carry=()) -> DataFrame:
    """Per distinct value: `<name>_upto` (running, inclusive), `<name>_all` (key total) and `next_value`.

    `carry` lists further columns to keep.
    """
    within = _partition([*keys, "bucket"])
    bucketed = with_bucket(distinct, keys, "value", spread)
    local = bucketed.selectExpr(
        "*",
        *[
            f"sum({n}) OVER ({within} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {n}_upto"
            for n in names
        ],
        f"lead(value) OVER ({within} ORDER BY value) AS next_value",
    )
    if spread.borders is None:
        return local.selectExpr("*", *[f"sum({n}) OVER ({within}) AS {n}_all" for n in names]).drop("bucket")

    totals = bucketed.groupBy(*keys, "bucket").agg(
        *[F.expr(f"sum({n}) AS {n}") for n in names], F.expr("min(value) AS first_value")
    )
    along = _partition(keys)
    before = f"({along} ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(
        *[f"`{k}`" for k in keys],
        "bucket",
        *[f"coalesce(sum({n}) OVER {before}, 0) AS {n}_before" for n in names],
        *[f"sum({n}) OVER ({along}) AS {n}_all" for n in names],
        f"lead(first_value) OVER ({along} ORDER BY bucket) AS following",
    )
    # a row per bucket: broadcast where keys and buckets were counted and are few, else it shuffles like the big side
    joined = keyed_join(local, offsets, [*keys, "bucket"], "inner", broadcast=spread.few_keys and spread.few_buckets)
    return joined.selectExpr(
        *[f"`{k}`" for k in keys],
        "value",
        *names,
        *carry,
        *[f"{n}_upto + {n}_before AS {n}_upto" for n in names],
        "coalesce(next_value, following) AS next_value",
        *[f"{n}_all" for n in names],
    )


def position(n: str, i, of) -> str:
    """SQL text: fractional 0-based position of the quantile i / of among n values."""
    return f"(({n} - 1) * {i} / double({of}))"


def order_statistics(name: str, positions: dict[str, str]) -> list[Column]:
    """Aggregates `<alias>_lo` and `<alias>_hi`: the values at the ranks around each fractional position.

    The value at 0-based rank r is the first one whose running count exceeds r.
    """
    return [
        F.expr(f"min(CASE WHEN {name}_upto > {side}({at}) THEN value END) AS {alias}_{end}")
        for alias, at in positions.items()
        for side, end in (("floor", "lo"), ("ceil", "hi"))
    ]


def interpolated(alias: str, at: str) -> str:
    return lerp_sql(f"{alias}_lo", f"{alias}_hi", f"({at} - floor({at}))")


def exact_quantiles(rows: DataFrame, keys, value: str, probs: dict[str, tuple[int, int]], spread: Spread) -> DataFrame:
    """Linear-interpolated quantiles per key; `probs` maps output name to the fraction (i, of)."""
    running = running_counts(value_counts(rows, keys, value, {"n": "1L"}), keys, ["n"], spread)
    at = {a: position("n_all", i, of) for a, (i, of) in probs.items()}
    picked = running.groupBy(*keys).agg(F.expr("max(n_all) AS n_all"), *order_statistics("n", at))
    return picked.selectExpr(
        *[f"`{k}`" for k in keys], "n_all AS n", *[f"{interpolated(a, p)} AS `{a}`" for a, p in at.items()]
    )
