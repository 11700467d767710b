"""Rank-based operators that never put a whole group into one task.

Exact medians, seeded samples and rolling windows all need the rank of a row inside its
group. A plain window partitioned by the group would sort the whole group in one task;
here the group is cut into small consecutive buckets first, the bucket counts give the rank
of each bucket's first row, and only rows inside one bucket are ever sorted together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkit.session import saved


def _over(by: list[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def _matches(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on null-safe equality, keeping the left copy of the keys."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in names})
    condition = [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in names]
    return left.join(renamed, condition, "inner").drop(*[f"_r_{name}" for name in names])


SORTED_ROWS = 1_000_000  # rows of one group that a median may sort in one task
_COARSE, _FINE = 2**6, 4096  # buckets per power of e in the first pass, buckets of a range in later ones
_SMALL_TABLE = 100_000  # rows below which a counted table is broadcast


def _middle_buckets(histogram: DataFrame, by: list[str]) -> DataFrame:
    """Where the middle ranks of each group lie, from counts, minimum and maximum per bucket ``_b``.

    ``_value`` is the median if the buckets already tell it: the two middle ranks lie in two buckets, so they are the end of one
    and the begin of the next, or the bucket holds a single value. Else ``_lo`` and ``_hi`` bound the bucket that holds both,
    ``_rows`` is its size and ``_first``, ``_second`` are the ranks inside. A bucket holds about as many entries per group as the first
    pass has buckets, whatever the number of rows.
    """
    group = _over(by)
    ranked = (
        histogram.withColumn("_upto", F.sum("_n").over(group.orderBy("_b")))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .withColumn("_one", F.coalesce("_first", F.expr("(sum(_n) over (%s) + 1) div 2" % _partition(by))))
        .withColumn("_two", F.coalesce("_second", F.expr("sum(_n) over (%s) div 2 + 1" % _partition(by))))
        .where((F.col("_upto") >= F.col("_one")) & (F.col("_before") < F.col("_two")))
    )
    split = F.count(F.lit(1)) == 2
    value = F.when(split, (F.min("_high") + F.max("_low")) / 2).when(F.min("_low") == F.max("_high"), F.min("_low"))
    return ranked.groupBy(*by).agg(
        value.alias("_value"), F.min("_low").alias("_lo"), F.max("_high").alias("_hi"), F.sum("_n").alias("_rows"),
        F.min(F.col("_one") - F.col("_before")).alias("_first"), F.min(F.col("_two") - F.col("_before")).alias("_second"),
    )


def _partition(by: list[str]) -> str:
    return "partition by " + (", ".join(f"`{name}`" for name in by) or "0")


def _histogram(rows: DataFrame, by: list[str], bucket: Column, ranks: list[Column]) -> DataFrame:
    """Rows counted per group and bucket straight where they are read; only buckets are shuffled."""
    return rows.groupBy(*by, bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *ranks
    )


def exact_median(df: DataFrame, value: str, by: list[str] | None = None, *, name: str, sorted_rows: int | None = None, stored: bool = False) -> DataFrame:
    """Interpolated median per group, exact at any size; null and NaN are ignored.

    Groups and values are saved first, as every pass reads them, unless ``df`` only reads what is ``stored`` already.

    A histogram that narrows: the first pass over the rows counts buckets of equal relative width per group, which is
    combined before the shuffle. The bucket with the middle ranks is cut into equal parts and counted again, in passes over the
    rows inside it, until it holds at most ``sorted_rows`` rows or one value. Only those rows are sorted, and a group needs a
    pass as long as its bucket is larger: each pass makes a bucket a few thousand times narrower. The bounds of buckets, a row
    per group, are saved between passes, so a lost executor costs no more than a pass.
    """
    by = list(by or [])
    spark, limit = df.sparkSession, sorted_rows or SORTED_ROWS
    v = F.col(value).cast("double")
    rows = df.select(*by, (v + 0.0).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not stored:
        rows = saved(spark, rows, "median-rows")
    none = [F.lit(None).cast("bigint").alias(rank) for rank in ("_first", "_second")]
    relative = F.floor(F.signum("_v") * F.ln(F.abs(F.col("_v")) + 1.0) * F.lit(float(_COARSE))).cast("bigint")
    unbounded = F.when(F.col("_v") == float("inf"), 2**40).when(F.col("_v") == float("-inf"), -(2**40)).otherwise(relative)
    bounds = saved(spark, _middle_buckets(_histogram(rows, by, unbounded, none), by), "median-bounds")
    groups, largest = _open_groups(bounds)
    while largest > limit:
        inside = _inside(rows, bounds.where(F.col("_value").isNull() & (F.col("_rows") > limit)), by, groups)
        width = (F.col("_hi") - F.col("_lo")) / F.lit(float(_FINE))
        linear = F.least(F.floor((F.col("_v") - F.col("_lo")) / width).cast("bigint"), F.lit(_FINE - 1))
        # A range too narrow or too wide to be divided is cut at its middle and ends.
        halves = F.when(F.col("_v") >= F.col("_hi"), 2).when(F.col("_v") > F.col("_lo"), 1).otherwise(0).cast("bigint")
        bucket = F.when((width > 0) & (width < float("inf")), linear).otherwise(halves)
        narrowed = _middle_buckets(_histogram(inside, by, bucket, [F.first(r).alias(r) for r in ("_first", "_second")]), by)
        done = bounds.where(F.col("_value").isNotNull() | (F.col("_rows") <= limit))
        bounds = saved(spark, done.unionByName(narrowed), "median-bounds")
        before, (groups, largest) = largest, _open_groups(bounds)
        if largest >= before:
            break  # neighbouring floating-point numbers: few values, which the last step counts before it sorts
    solved = bounds.where(F.col("_value").isNotNull()).select(*by, F.col("_value").alias(name))
    if not largest:
        return solved if by else solved.agg(F.max(name).alias(name))
    inside = _inside(rows, bounds.where(F.col("_value").isNull()), by, groups)
    equal = inside.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first"), F.first("_second").alias("_second"))
    upto = F.sum("_n").over(_over(by).orderBy("_v"))
    middle = equal.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_first")) & (F.col("_upto") - F.col("_n") < F.col("_second")))
    sorted_out = middle.groupBy(*by).agg(((F.min("_v") + F.max("_v")) / 2).alias(name))
    both = solved.unionByName(sorted_out)
    return both if by else both.agg(F.max(name).alias(name))


def _open_groups(bounds: DataFrame) -> tuple[int, int]:
    """Number of groups, and the most rows a group still has to look at."""
    rows = F.when(F.col("_value").isNull(), F.col("_rows"))
    return tuple(bounds.agg(F.count(F.lit(1)), F.coalesce(F.max(rows), F.lit(0))).first())


def _inside(rows: DataFrame, bounds: DataFrame, by: list[str], groups: int) -> DataFrame:
    """Rows between the bounds of their group, with these."""
    held = bounds.select(*[F.col(k).alias(f"_r_{k}") for k in by], "_lo", "_hi", "_first", "_second")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in by], F.col("_v").between(F.col("_lo"), F.col("_hi")))
    return rows.join(F.broadcast(held) if groups <= _SMALL_TABLE else held, match).drop(*[f"_r_{k}" for k in by])


def exact_medians(df: DataFrame, measures: dict[str, Column], by: list[str], *, stored: bool = False) -> DataFrame:
    """Several medians per group from the same scans; a row counts for a measure where it is not null.

    The measures are stacked into one long column, so they share every pass. A group appears if any of its measures has a value.
    They are saved before that, unless ``df`` only reads what is ``stored`` already.
    """
    if not stored:
        df = saved(df.sparkSession, df.select(*by, *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(measures.values())]), "median-rows")
        measures = {name: F.col(f"_x{i}") for i, name in enumerate(measures)}
    entries = F.array(*[F.struct(F.lit(name).alias("_m"), c.cast("double").alias("_x")) for name, c in measures.items()])
    stacked = df.select(*by, F.inline(entries)).where(F.col("_x").isNotNull())
    medians = exact_median(stacked, "_x", [*by, "_m"], name="_median", stored=True)
    return medians.groupBy(*by).agg(
        *[F.max(F.when(F.col("_m") == name, F.col("_median"))).alias(name) for name in measures]
    )


def approximate_median(
    df: DataFrame, value: str, by: list[str] | None = None, *, name: str, accuracy: int = 10000
) -> DataFrame:
    """Sketch-based median: one scan, bounded memory, rank error below 1 / accuracy."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return df.groupBy(*(by or [])).agg(F.percentile_approx(v, 0.5, accuracy).alias(name))


def top_k(df: DataFrame, k: int, count: str, keys: list[str]) -> DataFrame:
    """The k rows with the largest count; ties go to the smaller key."""
    return df.orderBy(F.col(count).desc(), *[F.col(key).asc_nulls_last() for key in keys]).limit(k)


def top_k_per_group(df: DataFrame, k: int, by: list[str], count: str, keys: list[str]) -> DataFrame:
    """Top-k inside each group of an already aggregated frame, with ``rank``.

    The literal bound lets Spark cut each task's share to k rows before the shuffle.
    """
    order = Window.partitionBy(*by).orderBy(F.col(count).desc(), *[F.col(key).asc_nulls_last() for key in keys])
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def seeded_order(*ids: str, seed: int = 42) -> Column:
    """Reproducible pseudo-random order in [0, 2**32)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(i) for i in ids]), F.lit(2**32))


SLICE_ROWS = 500_000  # rows of one group that a rank may sort in one task


def _ranked(rows: DataFrame, counts: DataFrame, by: list[str], part: str, order: list[str | Column], name: str, slice_rows: int) -> DataFrame:
    """Rank of each row inside its group, from counts per (group, slice).

    ``part`` numbers slices that follow ``order``; ``counts`` has ``by``, ``part``, ``_c`` (rows) and ``_before`` (rows in earlier slices), and only rows of
    its slices are returned. A slice of more than ``slice_rows`` rows, as when most rows share a time stamp, is cut at quantiles of
    the whole order, tie-breaks included: its rows are ranged over as many parts as its size needs and saved, so that the parts stay
    as they are counted.
    """
    keys = [*by, part]
    most, crowd = counts.agg(F.max("_c"), F.sum(F.when(F.col("_c") > slice_rows, F.col("_c")))).first()
    plain = counts.withColumn("_sub", F.lit(0))
    if (most or 0) <= slice_rows:
        cut = _matches(rows, plain.drop("_c"), keys)
    else:
        crowded = counts.where(F.col("_c") > slice_rows).select(*keys, F.col("_before").alias("_base"))
        ordered = _matches(rows, crowded, keys).withColumns({f"_k{i}": c if isinstance(c, Column) else F.col(c) for i, c in enumerate(order)})
        parts = -(-2 * crowd // slice_rows)
        ranged = ordered.repartitionByRange(parts, *keys, *[f"_k{i}" for i in range(len(order))]).withColumn("_sub", F.spark_partition_id())
        ranged = saved(rows.sparkSession, ranged.drop(*[f"_k{i}" for i in range(len(order))]), "crowded-slices")
        sizes = ranged.groupBy(*keys, "_sub").agg(F.count(F.lit(1)).alias("_n"), F.first("_base").alias("_base"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_sub"))
        starts = sizes.select(*keys, "_sub", (F.col("_base") + upto - F.col("_n")).alias("_before"))
        extra = [c for c in counts.columns if c not in (*keys, "_c", "_before")]
        starts = _matches(starts, counts.select(*keys, *extra), keys)
        sorted_out = _matches(ranged.drop("_base"), starts, [*keys, "_sub"])
        cut = _matches(rows, plain.where(F.col("_c") <= slice_rows).drop("_c"), keys).unionByName(sorted_out)
    rank = F.row_number().over(Window.partitionBy(*keys, "_sub").orderBy(*order))
    return cut.withColumn(name, (rank + F.col("_before")).cast("bigint")).drop("_sub", "_before")


def _slice_counts(rows: DataFrame, by: list[str], part: str) -> DataFrame:
    """Saved rows per slice, and rows in earlier slices of the group: one entry per slice, whatever the number of rows."""
    sizes = rows.groupBy(*by, part).agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*by).orderBy(part)) - F.col("_c")
    return saved(rows.sparkSession, sizes.withColumn("_before", before), "slices")


def sample_per_group(
    df: DataFrame,
    by: list[str],
    quota: int | DataFrame,
    *,
    order: Column,
    tie: list[str],
    buckets: int = 4096,
    slice_rows: int | None = None,
) -> DataFrame:
    """Keep the ``quota`` rows of each group with the smallest ``order`` in [0, 2**32).

    ``quota`` is a number, or a frame of the group keys plus a ``quota`` column. Rows are
    counted per (group, slice of the order range); later slices are dropped before any shuffle of rows,
    and a slice in which very many rows share their order is cut by ``tie`` as well.
    """
    width = 2**32 // buckets
    ordered = df.withColumn("_o", order.cast("bigint")).withColumn("_b", F.expr(f"_o div {width}").cast("int"))
    slices = _slice_counts(ordered, by, "_b")
    if isinstance(quota, DataFrame):
        slices = _matches(slices, quota.withColumnRenamed("quota", "_q"), by)
    else:
        slices = slices.withColumn("_q", F.lit(quota).cast("bigint"))
    needed = slices.where(F.col("_before") < F.col("_q"))
    ranked = _ranked(ordered, needed, by, "_b", ["_o", *tie], "_rank", slice_rows or SLICE_ROWS)
    return ranked.where(F.col("_rank") <= F.col("_q")).drop("_o", "_b", "_q", "_rank")


def balanced_quota(df: DataFrame, batch: list[str], label: str, classes: list[str], cap: int | None = None) -> DataFrame:
    """Rows each class may give per batch: the smallest class size (at most ``cap``).

    Batches that lack a class are left out.
    """
    sizes = df.where(F.col(label).isin(*classes)).groupBy(*batch, label).agg(F.count(F.lit(1)).alias("_n"))
    size = F.least(F.col("_n"), F.lit(cap)) if cap else F.col("_n")
    quota = (
        sizes.groupBy(*batch)
        .agg(F.min(size).alias("quota"), F.count(F.lit(1)).alias("_classes"))
        .where(F.col("_classes") == len(classes))
        .drop("_classes")
    )
    return quota.withColumn(label, F.explode(F.array(*[F.lit(c) for c in classes])))


def balanced_sample(
    df: DataFrame,
    batch: list[str],
    label: str,
    classes: list[str],
    *,
    order: Column,
    tie: list[str],
    cap: int | None = None,
) -> DataFrame:
    """Downsample every class of a batch to the smallest class."""
    quota = balanced_quota(df, batch, label, classes, cap)
    return sample_per_group(df, [*batch, label], quota, order=order, tie=tie)


def shuffle_rows(df: DataFrame, *ids: str, seed: int = 42) -> DataFrame:
    return df.orderBy(seeded_order(*ids, seed=seed), *ids)


def numbered(df: DataFrame, key: str, order: list[str], bucket: Column, *, name: str = "seq", slice_rows: int | None = None) -> DataFrame:
    """Running number of each row inside its key, starting at 1.

    ``bucket`` must be monotone in the first order column (say, its day). Ranks are taken
    inside (key, bucket) and shifted by the count of the key's earlier buckets; a crowded bucket is
    cut further, down to single rows of one time stamp.
    """
    cut = df.withColumn("_bkt", bucket)
    return _ranked(cut, _slice_counts(cut, [key], "_bkt"), [key], "_bkt", order, name, slice_rows or SLICE_ROWS).drop("_bkt")


def rolling_last_n(
    numbered_rows: DataFrame,
    key: str,
    n: int,
    aggregates: dict[str, callable],
    *,
    seq: str = "seq",
    block: int | None = None,
) -> DataFrame:
    """Aggregates over each row and the n-1 rows before it, per key.

    ``aggregates`` maps a new column to a function that takes the window. A key is cut into
    blocks of ``block`` rows (20 n unless given); the last n-1 rows of a block are also copied to the next block,
    so each block is complete on its own and a large key spreads over many tasks.
    """
    block = max(block or 20 * n, n)
    own = F.expr(f"({seq} - 1) div {block}")
    tail = F.col(seq) - own * block > block - (n - 1)
    copies = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered_rows.withColumn("_blk", F.explode(copies))
    frame = Window.partitionBy(key, "_blk").orderBy(seq).rowsBetween(-(n - 1), Window.currentRow)
    return (
        spread.withColumns({name: make(frame) for name, make in aggregates.items()})
        .where(F.col("_blk") == own)
        .drop("_blk")
    )
