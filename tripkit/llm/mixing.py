"""Mix the sources of a corpus to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import WORD, row_key, running_total, saved, slices_for

PASSES = 2  # a document may be taken at most this often


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """One row per source: its size and the words the mix wants from it.

    Sources in code point order (null last) get ``weights``, repeating. They share ``share`` times all words; no target
    passes ``PASSES`` times its source's size, and what is cut off is shared again by weight. In order of the ratio
    of cap to weight, a source is cut when its cap is at most its share of what the earlier ones left.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = totals.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(rank) - 1) % len(weights) + 1)
    )
    cap = F.col("source_size") * PASSES
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (left - F.coalesce(F.sum(cap).over(earlier), F.lit(0))) / F.sum("weight").over(from_here)
    levelled = weighed.withColumn("level", level).withColumn("capped", cap <= F.col("level") * F.col("weight"))
    # The first source that is not cut has the level of all that follow; later ones only compute lower values.
    common = F.max(F.when(~F.col("capped"), F.col("level"))).over(Window.partitionBy())
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(common * F.col("weight"))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def mix_sources(
    spark: SparkSession, docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The mix as one row per taken piece of a document, and one row per document with its size and target.

    The documents of a source are shuffled by a seeded hash and laid end to end, ``PASSES`` times. A piece's virtual
    finish time is its end divided by the source's target; a document that crosses the target is cut there. All
    pieces are put in the order of their finish times, slice by slice of that range, and what lies past the total
    budget is left out. ``mixed_before`` is a piece's place in the mix, counted in words.

    Columns in: ``doc_id``, ``text``, ``source``; others only count in ``row_key``, the hash of the whole row. Null or
    blank texts have size 0 and are never taken; a null source is a source; every row is a document of its own, also
    when it repeats (``row`` numbers them). Without any word nothing is taken and all targets are 0.
    """
    sizes = _sized(spark, docs)
    targets = saved(spark, source_targets(sizes, weights, share).withColumn("goal", F.floor("target").cast("long")), "mix-targets")
    matched = F.col("source").eqNullSafe(F.col("__source"))
    listed = sizes.join(targets.withColumnRenamed("source", "__source"), matched, "left").drop("__source")
    return _schedule(listed, sizes.count(), targets.agg(F.sum("goal")).first()[0] or 0, seed), listed


def _sized(spark: SparkSession, docs: DataFrame) -> DataFrame:
    words = F.split(F.col("text"), r"[\x20\x09-\x0D]+")
    blank = F.when(F.element_at(words, 1) == "", 1).otherwise(0) + F.when(F.element_at(words, -1) == "", 1).otherwise(0)
    size = F.when(F.col("text").isNull(), 0).otherwise(F.greatest(F.size(words) - blank, F.lit(0))).cast("long")
    return saved(
        spark,
        docs.select(
            "doc_id", "source", size.alias("size"), row_key(docs).alias("row_key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )


def _schedule(listed: DataFrame, rows: int, budget: int, seed: int) -> DataFrame:
    n = slices_for(rows)
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed))))
    shuffled = (
        listed.filter("size > 0").withColumn("key", key)
        .withColumn("part", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * n / 2**32))
    )
    queued = running_total(shuffled, ["source"], "part", [F.col("key"), F.col("doc_id"), F.col("row")], "size", "before")
    start = F.col("pass") * F.col("source_size") + F.col("before")
    passes = queued.withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES))))).withColumn("start", start)
    edge = F.least(F.greatest(F.col("goal") - F.col("start"), F.lit(0)), F.col("size"))
    parts = F.array(
        F.struct(F.lit(0).cast("long").alias("a"), edge.alias("b")), F.struct(edge.alias("a"), F.col("size").alias("b"))
    )
    pieces = (
        passes.withColumn("cut", F.explode(parts)).filter("cut.a < cut.b and goal > 0")
        .withColumn("from_word", F.col("cut.a")).withColumn("to_word", F.col("cut.b"))
        .withColumn("finish", F.try_divide(F.col("start") + F.col("to_word"), F.col("goal")))
        .withColumn("words", F.col("to_word") - F.col("from_word"))
        .withColumn("part", F.least(F.floor(F.col("finish") * n), F.lit(4 * n)).cast("long"))
    )
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("start"), F.col("from_word"), F.col("row")]
    mixed = running_total(pieces, [], "part", order, "words", "mixed_before")
    return (
        mixed.filter(F.col("mixed_before") < budget)
        .withColumn("to_word", F.least(F.col("to_word"), F.col("from_word") + budget - F.col("mixed_before")))
        .select("doc_id", "source", "size", "row", "row_key", "pass", "from_word", "to_word", "finish", "mixed_before")
    )


def mixed_texts(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The documents of a mix: a row of ``docs`` for each piece, its text cut to the piece's words where it isn't whole."""
    piece = pieces.select(*(F.col(c).alias(f"__{c}") for c in ("row_key", "size", "pass", "from_word", "to_word")))
    keyed = docs.withColumn("__row_key", row_key(docs)).dropDuplicates(["__row_key"])
    first, last = F.col("__from_word").cast("int"), F.col("__to_word").cast("int")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), first + 1, last - first)
    whole = (first == 0) & (last == F.col("__size"))
    joined = keyed.join(piece, "__row_key")
    out = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(words, " ")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
