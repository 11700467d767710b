"""Quality rules whose cutoffs come from labelled documents with a guaranteed limit on false rejections."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import SPACE, chunks, hash_words, ngram_hashes, saved

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
EXCITED = np.zeros(256, bool)
EXCITED[[ord("!"), ord("?")]] = True

# Ratios in thousandths, so that counts per value form a bounded histogram; larger ones count as CEILING.
METRICS = ["symbol_rate", "excited_rate", "upper_rate", "dup_line_rate", "repeat_rate", "word_length"]
CEILING = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _dup_lines(text: bytes | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    if not text:
        return 0, 0
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\v\f")]
    return len(lines), len(lines) - len(set(lines))


def _measure(texts: list) -> pd.DataFrame:
    words = hash_words(texts)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[words.offsets])
    n_words = np.diff(words.first)
    solid = ~SPACE[words.buffer]
    chars = per_text(solid & ((words.buffer & 0xC0) != 0x80))
    symbols, letters = per_text(SYMBOLS[words.buffer]), per_text(LETTER[words.buffer])
    windows, text_of = ngram_hashes(words, 3)
    first = words.first[:-1]
    # Windows inside texts start at the words of each text but its last two.
    starts = np.arange(len(windows)) - np.searchsorted(text_of, np.arange(len(first)))[text_of] + first[text_of] if len(windows) else np.zeros(0, int)
    order = np.lexsort((windows, text_of))
    w, t = windows[order], text_of[order]
    same = (w[1:] == w[:-1]) & (t[1:] == t[:-1])
    repeated = starts[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(w) else starts
    marked = np.zeros(len(words.hashes) + 2, bool)
    for k in range(3):
        marked[repeated + k] = True
    repeats = np.diff(np.concatenate([[0], np.cumsum(marked)])[words.first])
    lines = np.array([_dup_lines(t) for t in texts], np.int64).reshape(-1, 2)
    rate = lambda a, b: np.minimum(1000 * a // np.maximum(b, 1), CEILING)
    return pd.DataFrame({
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines[:, 1], "n_repeat_words": repeats,
        "symbol_rate": rate(symbols, n_words), "excited_rate": rate(per_text(EXCITED[words.buffer]), n_words),
        "upper_rate": rate(per_text(UPPER[words.buffer]), letters), "dup_line_rate": rate(lines[:, 1], lines[:, 0]),
        "repeat_rate": rate(repeats, n_words), "word_length": rate(chars, n_words),
    })


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, counts and rates of each whole text (null: empty), and ``base_failed``."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames, "text"):
            out = _measure(list(frame["text"]))
            out.insert(0, "lang", frame["lang"].array)
            out.insert(0, "doc_id", frame["doc_id"].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, " + ", ".join(f"{c} long" for c in _COUNTS + METRICS)
    measured = docs.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("binary").alias("text")).mapInPandas(run, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(X <= x) for X binomial; exact but for rounding, summed from the largest terms on."""
    if x >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    width = 200 + int(12 * math.sqrt(n * p * (1 - p)))
    if x > n * p:  # one minus the other tail
        k = np.arange(x + 1, min(n, x + width) + 1, dtype=float)
    else:
        k = np.arange(max(0, x - width), x + 1, dtype=float)
    log_n = math.lgamma(n + 1)
    logs = np.array([log_n - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in k])
    total = float(np.exp(logs - logs.max()).sum() * math.exp(logs.max())) if len(logs) else 0.0
    return max(0.0, min(1.0, 1 - total if x > n * p else total))


def choose_cutoff(values: np.ndarray, good: np.ndarray, bad: np.ndarray, limit: float, error: float) -> int | None:
    """The cutoff for one rule: texts above it go. ``good`` and ``bad`` count labelled texts at each rising value.

    Cutoffs are tested from the mildest down. Each tests "more than ``limit`` of good texts lie above" by the exact
    binomial tail at level ``error``, and the first that can't be refuted ends the search; in a fixed order no further
    correction is needed. Of the proven ones that with the most bad less good texts above is taken, the mildest of
    equals; None if no cutoff removes more bad than good.
    """
    n = int(good.sum())
    best, gain = None, 0
    above_good = above_bad = 0
    for i in range(len(values) - 1, -1, -1):
        above_good += int(good[i])
        above_bad += int(bad[i])
        if values[i] <= 0 or n == 0 or binomial_tail(above_good, n, limit) > error:
            break
        if above_bad - above_good > gain:
            best, gain = int(values[i]) - 1, above_bad - above_good
    return best


def cutoffs(
    spark: SparkSession, measured: DataFrame, labels: DataFrame, max_false_rejection: float = 0.03, error: float = 0.05
) -> DataFrame:
    """``lang`` and, per metric, the largest value that is kept (null: no cutoff was proven).

    With probability 1 - ``error`` at most ``max_false_rejection`` of the good texts of every language pass no rule:
    the limit is shared by the rules, the error by rules and languages (Bonferroni). Only counts per language, rule
    and value reach a task, at most CEILING + 1 each.
    """
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = measured.filter("NOT base_failed").join(marks, "doc_id")
    stacked = known.select("lang", "quality", F.explode(F.create_map(*(x for m in METRICS for x in (F.lit(m), F.col(m))))).alias("metric", "value"))
    good = F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good")
    counts = saved(
        spark, stacked.groupBy("lang", "metric", "value").agg(good, F.sum(F.when(F.col("quality") > 0, 0).otherwise(1)).alias("bad")), "rule-counts"
    )
    tests = max(1, counts.select("lang", "metric").distinct().count())
    limit, level = max_false_rejection / len(METRICS), error / tests

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("value")
        cut = choose_cutoff(frame["value"].to_numpy(), frame["good"].to_numpy(), frame["bad"].to_numpy(), limit, level)
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "metric": frame["metric"].iloc[:1], "cut": pd.array([cut], "Int64")})

    chosen = counts.groupBy("lang", "metric").applyInPandas(choose, "lang string, metric string, cut long")
    return chosen.groupBy("lang").agg(*(F.max(F.when(F.col("metric") == m, F.col("cut"))).alias(f"{m}_cut") for m in METRICS))


def judge_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Counts, ``base_failed``, ``rejected_by`` and ``kept`` for every row of ``docs`` (``doc_id``, ``text``, ``lang``).

    A text is kept unless it fails the base rules or lies above a cutoff of its language. Null languages form one of
    their own; a language without enough labelled good texts gets no cutoffs. ``labels``: ``doc_id``, ``quality``
    (0 or 1, null ignored; of several the worst counts). Repeated rows are judged each; no labels: base rules only.
    """
    measured = saved(spark, measure(docs), "quality")
    cuts = cutoffs(spark, measured, labels, **options).withColumnRenamed("lang", "__lang")
    judged = measured.join(cuts, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    over = F.filter(F.array(*(F.when(F.col(m) > F.col(f"{m}_cut"), m) for m in METRICS)), lambda x: x.isNotNull())
    return judged.select(
        "doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & (F.size(over) == 0)).alias("kept"),
        F.array_join(over, ",").alias("rejected_by"),
    )
