"""Collocations of two and three words per language, from count streams in prefix and in suffix order.

Words get numbers from a dictionary in shards. N-grams of numbers are counted in the order of their first words: each part of that
order holds whole prefixes, so a merge of its sorted runs with the words in the same order gives every n-gram, the counts of its
beginnings and of its extensions to the right. The frequent ones, in the order of their last words, meet the counts of their
endings and extensions to the left in the same way. Ends of parts follow from the counts of words, so a frequent word is spread over
many of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.coded import code_texts, pack_numbers, pack_tokens, unpack_numbers, unpack_tokens
from tripkit.llm.common import saved

BATCH_BYTES = 6 << 20  # text whose n-grams a task counts at a time
PART_TOKENS = 2_000_000  # words of the corpus whose n-grams one part of an order holds
FINENESS = 4  # quantiles of words per part, from which the ends of parts are taken
GAP = b"."
_FOLD = bytes(ord(".") if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_COUNTED = "kind string, batch long, shard int, tokens binary, numbers binary, size long, mass long"
_RUN = "part int, pairs binary, thirds binary, counts binary"
_SPAN = "part int, ids binary, counts binary"
_GRAM = "first long, second long, third long, a long, l1 long, l2 long, longer long"
_CANDIDATE = "first long, second long, third long, a long, l1 long, r1 long, l2 long, r2 long"


def phrase_words(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and GAP where a piece ends."""
    return text.translate(_FOLD).replace(GAP, b" . ").split()


class Order(NamedTuple):
    """Parts of the order of pairs of words: ``marks`` are the words at even distances in the running count of words."""

    marks: np.ndarray
    parts: int

    def _span(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.searchsorted(self.marks, words, "left")
        return np.minimum(low, len(self.marks) - 1), np.maximum(np.searchsorted(self.marks, words, "right") - low, 1)

    def part(self, words: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Part of each pair; it never falls while pairs rise."""
        low, width = self._span(words)
        share = np.minimum(np.searchsorted(self.marks, others, "right"), len(self.marks) - 1)
        return (low + width * share // len(self.marks)) * self.parts // len(self.marks)

    def parts_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last part with pairs of each word."""
        low, width = self._span(words)
        return low * self.parts // len(self.marks), (low + width - 1) * self.parts // len(self.marks)


def _count_words(asked: pd.DataFrame, least: int) -> pd.DataFrame:
    """Counts of the words of a shard: frequent ones in byte order, totals per language, and each batch's words as places among
    the frequent ones (from 1; 0: a rare word)."""
    parts, counts = [unpack_tokens(t) for t in asked["tokens"]], [unpack_numbers(c).astype(np.int64) for c in asked["counts"]]
    place: dict[bytes, int] = {}
    places = [np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words)) for words in parts]
    sums = np.bincount(np.concatenate(places), np.concatenate(counts), len(place)).astype(np.int64)
    words = list(place)
    frequent = sorted((k for k in range(len(words)) if sums[k] >= least), key=words.__getitem__)
    rank = np.zeros(len(words), np.int64)
    rank[frequent] = np.arange(1, len(frequent) + 1)
    totals: dict[bytes, int] = {}
    for w, n in zip(words, sums.tolist()):
        space = w[w.index(b" ") + 1 :]
        totals[space] = totals.get(space, 0) + n
    shard = int(asked["shard"].iloc[0])
    rows = [("answer", b, shard, None, pack_numbers(rank[p]), None, None) for b, p in zip(asked["batch"], places)]
    rows += [("total", None, shard, space, None, None, n) for space, n in totals.items()]
    if frequent:
        found = sums[frequent]
        rows.append(("words", None, shard, pack_tokens([words[k] for k in frequent]), pack_numbers(found), len(frequent), int(found.sum())))
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _COUNTED.split(", ")])
    return frame.astype({"batch": "Int64", "size": "Int64", "mass": "Int64"})


def _runs(begin: np.ndarray, total: int) -> np.ndarray:
    """Lengths of runs from where they begin."""
    return np.diff(np.append(begin, total))


def count_runs(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (first and second word, third word or 0) of streams in which 0 separates, with counts.

    A pair is counted once at each of its places, whatever stands behind it.
    """
    stream = np.concatenate([np.zeros(0, np.uint32), *(part for x in ids for part in (x, np.zeros(2, np.uint32)))]).astype(np.uint32, copy=False)
    first, second, third = stream[:-2], stream[1:-1], stream[2:]
    whole = np.flatnonzero((first > 0) & (second > 0))
    pairs = first[whole].astype(np.uint64)
    pairs <<= np.uint64(32)
    pairs |= second[whole]
    return merge_runs(pairs, third[whole])


def merge_runs(pairs: np.ndarray, thirds: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal n-grams in order, with their counts (1 each unless given) added."""
    order = np.lexsort((thirds, pairs))
    pairs, thirds = pairs[order], thirds[order]
    begin = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (thirds[1:] != thirds[:-1]))[: len(pairs)])
    if counts is None:
        sums = _runs(begin, len(pairs))
    else:
        sums = np.add.reduceat(counts[order], begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
    return pairs[begin], thirds[begin], sums


def _words_of_part(spans: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers in order and their counts."""
    ids = np.concatenate([np.zeros(0, np.uint64), *(unpack_numbers(x) for x in spans["ids"])])
    counts = np.concatenate([np.zeros(0, np.uint64), *(unpack_numbers(x) for x in spans["counts"])]).astype(np.int64)
    order = np.argsort(ids)
    return ids[order], counts[order]


def prefix_order(runs: pd.DataFrame, spans: pd.DataFrame, least: int) -> pd.DataFrame:
    """Frequent n-grams of a part, with the counts of what they begin with and of their most frequent extension to the right."""
    columns = [c.split()[0] for c in _GRAM.split(", ")]
    if not len(runs):
        return pd.DataFrame({c: [] for c in columns})
    narrow = [np.concatenate([unpack_numbers(x).astype(np.uint32) for x in runs[c]]) for c in ("thirds", "counts")]
    pairs = np.concatenate([np.cumsum(unpack_numbers(x), dtype=np.uint64) for x in runs["pairs"]])
    pairs, thirds, counts = merge_runs(pairs, *narrow)
    words, occurrences = _words_of_part(spans)
    begin = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    pair_counts = np.add.reduceat(counts, begin)
    extended = np.maximum.reduceat(np.where((thirds > 0) & (counts >= least), counts, 0), begin)
    pair_first = occurrences[np.searchsorted(words, pairs[begin] >> np.uint64(32))]
    group = np.repeat(np.arange(len(begin)), _runs(begin, len(pairs)))
    three = np.flatnonzero((thirds > 0) & (counts >= least))
    two = np.flatnonzero(pair_counts >= least)
    low = np.uint64(0xFFFFFFFF)
    half = lambda p: ((p >> np.uint64(32)).astype(np.int64), (p & low).astype(np.int64))
    zero = np.zeros(len(two), np.int64)
    frames = [
        (*half(pairs[begin][two]), zero, pair_counts[two], pair_first[two], zero, extended[two]),
        (*half(pairs[three]), thirds[three].astype(np.int64), counts[three], pair_first[group[three]], pair_counts[group[three]], np.zeros(len(three), np.int64)),
    ]
    return pd.DataFrame({c: np.concatenate([f[i] for f in frames]) for i, c in enumerate(columns)})


def suffix_order(grams: pd.DataFrame, spans: pd.DataFrame, part_of_longer: int) -> pd.DataFrame:
    """Candidates of a part of the order of last words, with the counts of what they end with; pairs that mostly occur inside a
    frequent triple are dropped."""
    columns = [c.split()[0] for c in _CANDIDATE.split(", ")]
    if not len(grams):
        return pd.DataFrame({c: [] for c in columns})
    first, second, third, a, l1, l2, longer = (grams[c.split()[0]].to_numpy(np.int64) for c in _GRAM.split(", "))
    triple = third > 0
    last, before, outer = np.where(triple, third, second), np.where(triple, second, first), np.where(triple, first, 0)
    order = np.lexsort((outer, before, last))
    first, second, third, a, l1, l2, longer, triple, last, before = (x[order] for x in (first, second, third, a, l1, l2, longer, triple, last, before))
    words, occurrences = _words_of_part(spans)
    ending = occurrences[np.searchsorted(words, last.astype(np.uint64))]
    begin = np.flatnonzero(np.append(True, (last[1:] != last[:-1]) | (before[1:] != before[:-1])))  # the pair leads its triples
    sizes = _runs(begin, len(a))
    pair_count = np.repeat(a[begin], sizes)
    longer = np.maximum(longer, np.repeat(np.maximum.reduceat(np.where(triple, a, 0), begin), sizes))
    r1, r2 = np.where(triple, pair_count, ending), np.where(triple, ending, 0)
    keep = triple | (100 * longer < part_of_longer * a)
    return pd.DataFrame({c: x[keep] for c, x in zip(columns, (first, second, third, a, l1, r1, l2, r2))})


class Mined(NamedTuple):
    """``candidates``: n-grams of word numbers with counts; ``vocabulary``: ``id``, ``word``, ``lang``; ``totals``: ``lang``, ``n``."""

    candidates: DataFrame
    vocabulary: DataFrame
    totals: DataFrame


def mine_candidates(spark: SparkSession, docs: DataFrame, least: int = 10, inside_percent: int = 50) -> Mined:
    """All candidates of ``docs`` (``text``, null: empty; ``lang``, null: ``und``) that are left after the rule of longer phrases.

    A phrase with a rare word is rare, so rare words only separate; all their occurrences count in ``totals``. Other columns are
    ignored, repeated rows count each, no rows give no candidates. One number per shard and the marks (some per part) reach
    the driver.
    """
    named = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    coded = code_texts(spark, named, phrase_words, "phrase-words", space="lang", counted=True, gap=GAP, batch_bytes=BATCH_BYTES)
    counted = saved(spark, coded.entries.groupBy("shard").applyInPandas(lambda asked: _count_words(asked, least), _COUNTED), "phrase-counts")
    listed = counted.filter("kind = 'words'")
    sizes, masses = np.zeros(coded.shards + 1, np.int64), np.zeros(coded.shards + 1, np.int64)
    for shard, size, mass in listed.select("shard", "size", "mass").collect():  # a row per shard
        sizes[shard + 1], masses[shard + 1] = size, mass
    bases, begins = np.cumsum(sizes), np.cumsum(masses)
    total = int(begins[-1])
    if bases[-1] >= 1 << 32:
        raise ValueError("more than 2 ** 32 frequent words")
    parts = max(1, -(-total // PART_TOKENS))
    marks = parts * FINENESS

    def mark(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, numbers in zip(frame["shard"], frame["numbers"]):
                ends = begins[shard] + np.cumsum(unpack_numbers(numbers).astype(np.int64))
                own = np.arange(-(-int(begins[shard]) * marks // total), -(-int(ends[-1]) * marks // total))
                at = np.searchsorted(ends, own * total // marks, "right")
                yield pd.DataFrame({"mark": own, "word": bases[shard] + 1 + at})

    marked = [r[1] for r in sorted(listed.select("shard", "numbers").mapInPandas(mark, "mark long, word long").collect())]
    order = Order(np.array(marked or [0], np.uint64), parts)

    def spread(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, numbers in zip(frame["shard"], frame["numbers"]):
                counts = unpack_numbers(numbers)
                ids = np.arange(bases[shard] + 1, bases[shard] + 1 + len(counts)).astype(np.uint64)
                low, high = order.parts_of(ids)
                repeated = np.repeat(np.arange(len(ids)), high - low + 1)
                part = low[repeated] + np.arange(len(repeated)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                yield pd.DataFrame([(part[a], pack_numbers(ids[repeated[a:b]]), pack_numbers(counts[repeated[a:b]])) for a, b in zip(cuts, cuts[1:])],
                                   columns=["part", "ids", "counts"])

    spans = listed.select("shard", "numbers").mapInPandas(spread, _SPAN)

    def count(streams: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("shard")
        known = [np.zeros(1, np.uint32)]
        for shard, numbers in zip(answers["shard"], answers["numbers"]):
            rank = unpack_numbers(numbers)
            known.append(np.where(rank > 0, rank + np.uint64(bases[shard]), np.uint64(0)).astype(np.uint32))
        ids = np.concatenate(known)
        pairs, thirds, counts = count_runs([ids[unpack_numbers(c).astype(np.uint32)] for c in streams["codes"]])
        part = order.part(pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF))
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        steps = lambda x: np.diff(x, prepend=np.zeros(1, np.uint64))
        return pd.DataFrame([(part[a], pack_numbers(steps(pairs[a:b])), pack_numbers(thirds[a:b]), pack_numbers(counts[a:b])) for a, b in zip(cuts, cuts[1:]) if b > a],
                            columns=["part", "pairs", "thirds", "counts"])

    answers = counted.filter("kind = 'answer'").select("batch", "shard", "numbers")
    runs = coded.streams.select("batch", "codes").groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(count, _RUN)
    grams = runs.groupBy("part").cogroup(spans.groupBy("part")).applyInPandas(lambda r, s: prefix_order(r, s, least), _GRAM)

    def ends(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            second, third = frame["second"].to_numpy(np.uint64), frame["third"].to_numpy(np.uint64)
            last, before = np.where(third > 0, third, second), np.where(third > 0, second, frame["first"].to_numpy(np.uint64))
            yield frame.assign(part=order.part(last, before).astype(np.int32))

    by_end = grams.mapInPandas(ends, f"{_GRAM}, part int")
    candidates = by_end.groupBy("part").cogroup(spans.groupBy("part")).applyInPandas(lambda g, s: suffix_order(g.drop(columns="part"), s, inside_percent), _CANDIDATE)

    def name(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, tokens in zip(frame["shard"], frame["tokens"]):
                words = [t.decode().split(" ", 1) for t in unpack_tokens(tokens)]
                ids = np.arange(bases[shard] + 1, bases[shard] + 1 + len(words))
                yield pd.DataFrame({"id": ids, "word": [w for w, _ in words], "lang": [s for _, s in words]})

    vocabulary = listed.select("shard", "tokens").mapInPandas(name, "id long, word string, lang string")
    totals = counted.filter("kind = 'total'").groupBy(F.col("tokens").cast("string").alias("lang")).agg(F.sum("mass").alias("n"))
    return Mined(candidates, vocabulary, totals)


def collocations(spark: SparkSession, docs: DataFrame, least: int = 10, best: int = 2000, inside_percent: int = 50) -> DataFrame:
    """Each language's ``best`` phrases: ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the two sides of its weakest
    cut), ``n`` (words of the language), ``score`` (a million times a * a / (l * r), rounded down).

    Ties of score go to the higher count, then to the phrase by bytes; ties of cuts to the earlier one. See `mine_candidates`.
    """
    mined = mine_candidates(spark, docs, least, inside_percent)
    score = lambda l, r: F.expr(f"(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")  # noqa: E731, E741
    scored = mined.candidates.withColumns({"s1": score("l1", "r1"), "s2": F.when(F.col("third") > 0, score("l2", "r2"))})
    later = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    cut = scored.select(
        "first", "second", "third", "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(later, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    words = lambda k: mined.vocabulary.select(F.col("id").alias(k), F.col("word").alias(f"{k}_word"))
    named = cut.join(mined.vocabulary.select(F.col("id").alias("first"), F.col("word").alias("first_word"), "lang"), "first")
    leading = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = named.withColumn("place", F.rank().over(leading)).filter(F.col("place") <= best).drop("place")  # all ties at the edge
    spelled = near.join(words("second"), "second").join(words("third"), "third", "left")
    phrase = F.concat_ws(" ", "first_word", "second_word", "third_word")
    ranked = spelled.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(leading.orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.filter(F.col("rank") <= best).join(mined.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
