"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.batches import (
    ANSWERS, SHARDED, answer_rows, answers_of, collected, merge_entries, pack_counts, pack_keys, save_batched, save_bucketed,
    to_shards, unpack_counts, unpack_keys,
)
from tripkit.llm.common import WORD, hash_words, mix, ngram_hashes, row_key, saved

SHINGLE = 5
BANDS, BAND_ROWS = 12, 3
IDF_STRENGTH = 0.25
SAMPLES = 96  # the first BANDS * BAND_ROWS make the bands, all make the sketch
BLOCK = 2048
BUCKET = ["band", "value"]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Sets(NamedTuple):
    """Shingle sets of a batch: text, key and count of each, by text and key; first entry and two digests of each text."""

    text: np.ndarray
    key: np.ndarray
    count: np.ndarray
    first: np.ndarray
    digests: np.ndarray


def shingle_sets(texts: list, bits: int) -> Sets:
    """Distinct SHINGLE-word shingles of each text with their counts; a shorter text with a word is one shingle."""
    words = hash_words(texts)
    keys, owners = [], []
    h, t = ngram_hashes(words, SHINGLE)
    keys.append(h)
    owners.append(t)
    lengths = np.diff(words.first)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(lengths == n)
        whole = np.full(len(short), np.uint64(n))
        for k in range(n):
            whole = mix(whole * _FACTOR + words.hashes[words.first[short] + k])
        keys.append(whole)
        owners.append(short)
    key, text = np.concatenate(keys) >> np.uint64(64 - bits), np.concatenate(owners)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])[: len(key)]
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(key)]]))
    place = (np.arange(len(words.hashes)) - np.repeat(words.first[:-1], lengths)).astype(np.uint64)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(words.hashes ^ mix(place * _FACTOR + np.uint64(s))))]) for s in (1, 2)]
    digests = np.stack([x[words.first[1:]] - x[words.first[:-1]] + lengths.astype(np.uint64) for x in sums], axis=1)
    return Sets(text[at], key[at], count, np.searchsorted(text[at], np.arange(len(texts) + 1)), digests)


def idf(frequency: np.ndarray, documents: int, strength: float) -> np.ndarray:
    """1 for a shingle of every document, rising with its rarity to 1 + ``strength`` at most.

    With the usual unbounded logarithm the shared text of a large group of copies would weigh so little that one changed
    word split it.
    """
    return 1 + strength * np.log(documents / np.minimum(frequency, documents)) / np.log(documents + 1)


def weighted_samples(key: np.ndarray, weight: np.ndarray, first: np.ndarray, samples: int) -> np.ndarray:
    """Consistent weighted samples of each set (the slices between ``first``, none empty): equal with a chance of the
    weighted Jaccard similarity.

    Per sample and key r and c are Gamma(2, 1), b uniform, all from hashes of the key; t = floor(ln w / r + b) and
    ln a = ln c - r (t - b + 1). The key with the least a and its t make the sample.
    """
    out = np.empty((len(first) - 1, samples), np.uint64)
    log_weight = np.log(weight)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    uniform = lambda x: ((x >> np.uint64(32)).astype(float) + 0.5) / 2**32
    low = lambda x: ((x & np.uint64(0xFFFFFFFF)).astype(float) + 0.5) / 2**32
    for k in range(samples):
        x, y, z = (mix(key * _FACTOR + np.uint64(3 * k + j + 1)) for j in range(3))
        r = -np.log(uniform(x) * low(x))
        t = np.floor(log_weight / r + uniform(z))
        a = np.log(-np.log(uniform(y) * low(y))) - r * (t - uniform(z) + 1)
        best = np.flatnonzero(a == np.minimum.reduceat(a, first[:-1])[text])
        best = best[np.unique(text[best], return_index=True)[1]]
        out[:, k] = mix(key[best] ^ mix(t[best].astype(np.int64).astype(np.uint64)))
    return out


def weighted_jaccard(a_keys, a_weights, b_keys, b_weights) -> float:
    _, i, j = np.intersect1d(a_keys, b_keys, assume_unique=True, return_indices=True)
    both = float(np.minimum(a_weights[i], b_weights[j]).sum())
    total = float(a_weights.sum() + b_weights.sum()) - both
    return both / total if total > 0 else 0.0


def pack_weights(weights: np.ndarray) -> bytes:
    """32-bit floats byte plane by byte plane: most differ in few bits, which compresses."""
    return pack_counts(weights.view(np.uint32)[:, None])


def unpack_weights(data: bytes) -> np.ndarray:
    return unpack_counts(data, 1)[:, 0].astype(np.uint32).view(np.float32)


def _signed(spark: SparkSession, docs: DataFrame, threshold: float, strength: float) -> DataFrame:
    """Each document with its digests and, where it may have a near copy, its bands and weighted shingles, bucketed by batch.

    Shingles of all documents are counted in shards, and each batch learns the frequencies of its own. A text whose shingles
    of other texts don't carry ``threshold`` of its weight can't be that similar to any and gets no bands.
    """
    batched = save_batched(spark, docs, "dedup-batches")
    bits, shards, documents = batched.bits, batched.shards, batched.rows
    carried = [f for f in batched.docs.schema if f.name != "text"]
    groups = batched.docs.groupBy("batch")

    def emit(frame: pd.DataFrame) -> pd.DataFrame:
        keys, counts = np.unique(shingle_sets(list(frame["text"]), bits).key, return_counts=True)
        return to_shards(int(frame["batch"].iloc[0]), keys, counts[:, None], bits, shards)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        m = merge_entries(frame, 1)
        return answer_rows(frame, m.sums[m.place], m.sizes)

    def sign(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        s = shingle_sets(list(frame["text"]), bits)
        place = np.unique(s.key, return_inverse=True)[1]
        frequency = answers_of(found, 1)[:, 0][place] if len(s.key) else np.zeros(0, np.int64)
        weight = (s.count * idf(frequency, documents, strength)).astype(np.float32)
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=float)])[s.first])
        sizes = np.diff(s.first)
        # The slack covers rounding of the sums.
        maybe = (sizes > 0) & (sums(np.where(frequency > 1, weight, 0)) >= (threshold - 1e-6) * sums(weight))
        inside = np.repeat(maybe, sizes)
        key, kept = s.key[inside], weight[inside]
        first = np.concatenate([[0], np.cumsum(sizes[maybe])]).astype(np.int64)
        bands, sketches, keys, weights = ([None] * len(frame) for _ in range(4))
        if maybe.any():
            samples = weighted_samples(key, kept.astype(float), first, SAMPLES)
            hashed = np.zeros((len(samples), BANDS), np.uint64)
            for k in range(BAND_ROWS):
                hashed = mix(hashed * _FACTOR + samples[:, k : BANDS * BAND_ROWS : BAND_ROWS])
            for n, i in enumerate(np.flatnonzero(maybe)):
                bands[i], sketches[i] = hashed[n].view(np.int64), (samples[n] & np.uint64(255)).astype(np.uint8).tobytes()
                keys[i], weights[i] = pack_keys(key[first[n] : first[n + 1]]), pack_weights(kept[first[n] : first[n + 1]])
        out = frame[[f.name for f in carried]].reset_index(drop=True)
        return out.assign(d1=s.digests[:, 0].view(np.int64), d2=s.digests[:, 1].view(np.int64), bands=bands, sketch=sketches, keys=keys, weights=weights) if len(out) else out

    answers = groups.applyInPandas(emit, SHARDED).groupBy("shard").applyInPandas(merge, ANSWERS)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    schema = f"{fields}, d1 long, d2 long, bands array<long>, sketch binary, keys binary, weights binary"
    signed = save_bucketed(spark, groups.cogroup(answers.groupBy("batch")).applyInPandas(sign, schema), batched.buckets, "dedup-signed")
    collected(spark)
    return signed


def _sets(signed: DataFrame):
    """Bands, sketch, shingles and weights of the rows by batch."""
    return signed.filter("bands IS NOT NULL").select("batch", "row", "bands", "sketch", "keys", "weights").groupBy("batch")


def _looked_up(rows: pd.Series, sets: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """``columns`` of ``sets`` for each of ``rows``, all of which are there."""
    order = np.argsort(sets["row"].to_numpy())
    at = order[np.searchsorted(sets["row"].to_numpy()[order], rows.to_numpy())]
    return sets[columns].iloc[at].reset_index(drop=True)


def _judged(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """``pairs`` (``row``, ``batch``, ``leader``, ``leader_batch``) of rows with their weighted Jaccard similarity.

    Shingles stay with their batches: only those of leaders move, once to each batch that has rows to compare with them.
    """
    heavy = ["keys", "weights"]

    def give(asked: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        return _looked_up(asked["leader"], sets, heavy).assign(batch=asked["batch"].to_numpy(), leader=asked["leader"].to_numpy())

    def judge(f: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        given, met = f[f["keys"].notna()], f[f["keys"].isna()]
        leaders = {r.leader: (unpack_keys(r.keys), unpack_weights(r.weights)) for r in given.itertuples()}
        own = _looked_up(met["row"], sets, heavy)
        similarity = [
            weighted_jaccard(unpack_keys(k), unpack_weights(w), *leaders[leader])
            for k, w, leader in zip(own["keys"], own["weights"], met["leader"])
        ]
        return met[["row", "leader"]].assign(similarity=np.array(similarity, float))

    asked = pairs.select("leader_batch", "leader", "batch").distinct()
    given = asked.groupBy("leader_batch").cogroup(_sets(signed)).applyInPandas(give, "batch long, leader long, keys binary, weights binary")
    met = pairs.select("batch", "row", "leader").unionByName(given.withColumn("row", F.col("leader")), allowMissingColumns=True)
    return met.groupBy("batch").cogroup(_sets(signed)).applyInPandas(judge, "row long, leader long, similarity double")


def _links(spark: SparkSession, chosen: DataFrame, signed: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (``a``, ``b``) between rows of ``chosen`` that are similar to the leader of a bucket, and all pairs of rows that
    were compared with one: ``band``, ``value``, ``row``, ``leader``, ``far`` (the distance).

    A bucket's leader is the row whose buckets are the largest: in a group of copies that is the text most like their
    common origin. So a group gives as many pairs as rows.
    """
    at = saved(spark, chosen.select("row", "batch", F.posexplode("bands").alias("band", "value")), "dedup-buckets")
    sizes = at.groupBy(*BUCKET).agg(F.count("*").alias("n")).filter("n > 1")
    shared = saved(spark, at.join(sizes, BUCKET).select("row", "batch", *BUCKET, "n"), "dedup-buckets")
    weight = shared.groupBy("row").agg(F.sum("n").alias("popular"))
    first = F.struct(-F.col("popular"), F.col("row"))
    leaders = shared.join(weight, "row").groupBy(*BUCKET).agg(F.min_by(F.struct("row", "batch"), first).alias("first"))
    met = saved(spark, shared.join(leaders, BUCKET).filter("row <> first.row").select(
        *BUCKET, "row", "batch", F.col("first.row").alias("leader"), F.col("first.batch").alias("leader_batch"),
        F.least("row", "first.row").alias("a"), F.greatest("row", "first.row").alias("b"),
    ), "dedup-met")
    pairs = met.groupBy("a", "b").agg(F.min(F.struct("row", "batch", "leader", "leader_batch")).alias("pair")).select("pair.*")
    least = [F.least("row", "leader").alias("a"), F.greatest("row", "leader").alias("b")]
    judged = saved(spark, _judged(pairs, signed).select(*least, "similarity"), "dedup-judged")
    far = met.join(judged, ["a", "b"]).select(*BUCKET, "row", "leader", (1 - F.col("similarity")).alias("far"))
    return judged.filter(F.col("similarity") >= threshold).select("a", "b"), saved(spark, far, "dedup-far")


def _label_links(spark: SparkSession, chosen: DataFrame, signed: DataFrame, far: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Links (``a``, ``b``) between labels: every two rows of a bucket that have different labels after the first links are
    compared unless they can't be similar or their labels have been joined by another pair of the same task.

    The distance is a metric, so two rows can only be similar if their distances to the bucket's leader differ by at most
    1 - ``threshold``. Rows with the leader's label meet the other rows of the bucket, and these each other. Both sides are cut
    into blocks of about BLOCK rows, and each pair of blocks is a task of its own.
    """
    reach = 1 - threshold + 1e-6
    open_ = far.groupBy(*BUCKET).agg(F.count("*").alias("n"), F.max("far").alias("most")).filter((F.col("n") > 1) & (F.col("most") > 1 - threshold))
    named = lambda c: labels.select(F.col("row").alias(c), F.col("label").alias(f"{c}_label"))
    rows = far.join(open_.select(*BUCKET), BUCKET, "left_semi").join(named("row"), "row", "left").join(named("leader"), "leader", "left")
    label = F.coalesce("row_label", "row")
    rows = saved(spark, rows.select(*BUCKET, "row", "far", label.alias("label"), (label != F.coalesce("leader_label", "leader")).alias("other")), "dedup-open")
    others = [F.when(F.col("other"), F.col(c)) for c in ("far", "label")]
    sizes = rows.groupBy(*BUCKET).agg(
        F.count_if("other").alias("outside"), F.count_if(~F.col("other")).alias("inside"), F.min(others[0]).alias("low"),
        F.max(others[0]).alias("high"), (F.min(others[1]) != F.max(others[1])).alias("several"),
    ).filter((F.col("outside") > 0) & ((F.col("inside") > 0) | F.col("several")))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    block = lambda c: F.pmod(F.xxhash64("row"), F.greatest(blocks(c), F.lit(1))).cast("int")
    task = lambda kind, left, right, side: F.struct(
        F.lit(kind).alias("kind"), left.alias("left"), right.alias("right"), side.alias("side")
    )
    upto = lambda n: F.filter(F.sequence(F.lit(0), n), lambda k: k < n)
    within = F.transform(upto(blocks("inside")), lambda i: task(1, i, block("outside"), F.lit(1)))
    among = F.when(F.col("several"), F.transform(upto(blocks("outside")), lambda i: task(
        0, F.least(i, block("outside")), F.greatest(i, block("outside")), (block("outside") > i).cast("int")
    ))).otherwise(F.array().cast("array<struct<kind:int,left:int,right:int,side:int>>"))
    met = F.transform(upto(blocks("outside")), lambda j: task(1, block("inside"), j, F.lit(0)))
    near = F.col("other") | F.col("far").between(F.col("low") - reach, F.col("high") + reach)
    tasks = rows.join(sizes, BUCKET).filter(near).select(
        *BUCKET, "row", "label", "far", F.explode(F.when(F.col("other"), F.concat(within, among)).otherwise(met)).alias("task")
    ).select(*BUCKET, "task.*", "row", "label", "far")
    group = [*BUCKET, "kind", "left", "right"]
    columns = [*group, "side", "row", "label", "far"]
    needed = _least_agreement(threshold)

    def candidates(f: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """A row's place, the places of rows that it may be similar to and how many samples they share."""
        band, apart = int(f["band"].iloc[0]), bool(f["kind"].iloc[0] == 1 or f["left"].iloc[0] != f["right"].iloc[0])
        side, label, distance = (f[c].to_numpy() for c in ("side", "label", "far"))
        sketch = np.frombuffer(b"".join(f["sketch"]), np.uint8).reshape(len(f), SAMPLES)
        bands = np.stack(f["bands"].to_numpy())[:, :band]
        lefts = np.flatnonzero(side == 0) if apart else np.arange(len(f))
        rights = np.flatnonzero(side == 1) if apart else lefts
        for i in lefts:
            them = rights if apart else rights[i + 1 :]
            them = them[(label[them] != label[i]) & (np.abs(distance[them] - distance[i]) <= reach)]
            same = (sketch[them] == sketch[i]).sum(axis=1)
            likely = same >= needed
            them, same = them[likely], same[likely]
            new = (bands[them] != bands[i]).all(axis=1)  # pairs that share an earlier band meet there
            if new.any():
                yield i, them[new], same[new]

    def wanted(f: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(f), bool)
        for i, them, _ in candidates(f):
            hit[i] = hit[them] = True
        return f[hit][columns]

    def verify(f: pd.DataFrame) -> pd.DataFrame:
        found = list(candidates(f))
        i = np.concatenate([np.full(len(them), k) for k, them, _ in found]) if found else np.zeros(0, int)
        j = np.concatenate([them for _, them, _ in found]) if found else i
        best = np.argsort(-np.concatenate([same for *_, same in found]), kind="stable") if found else i
        keys, weights = [unpack_keys(k) for k in f["keys"]], [unpack_weights(w) for w in f["weights"]]
        label, joined, links = f["label"].tolist(), {}, []

        def root(x):
            while x in joined:
                x = joined[x]
            return x

        for x, y in zip(i[best], j[best]):
            a, b = root(label[x]), root(label[y])
            if a != b and weighted_jaccard(keys[x], weights[x], keys[y], weights[y]) >= threshold:
                joined[max(a, b)] = min(a, b)
                links.append((label[x], label[y]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    def whole(f: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        heavy = ["bands", "sketch", "keys", "weights"]
        return pd.concat([f[columns].reset_index(drop=True), _looked_up(f["row"], sets, heavy)], axis=1)

    schema = "band int, value long, kind int, left int, right int, side int, row long, label long, far double"
    pending = tasks.join(chosen.select("row", "bands", "sketch"), "row").groupBy(*group).applyInPandas(wanted, schema)
    pending = saved(spark, pending, "dedup-pending").join(chosen.select("row", "batch"), "row")
    full = pending.groupBy("batch").cogroup(_sets(signed)).applyInPandas(whole, f"{schema}, bands array<long>, sketch binary, keys binary, weights binary")
    return full.groupBy(*group).applyInPandas(verify, "a long, b long")


def _least_agreement(similarity: float) -> int:
    """Samples that two texts of at least this similarity share but for one pair in some million."""
    return int(SAMPLES * similarity - 5 * (SAMPLES * similarity * (1 - similarity)) ** 0.5)


def linked_labels(spark: SparkSession, chosen: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """``row`` and ``label`` of every row of ``chosen`` (``row``, ``batch``, ``bands``, ``sketch``) that is linked to another;
    ``signed`` holds their shingles."""
    links, far = _links(spark, chosen, signed, threshold)
    labels = components(spark, links)
    wider = components(spark, _label_links(spark, chosen, signed, far, labels, threshold)).withColumnRenamed("label", "wider").withColumnRenamed("row", "label")
    single = wider.join(labels, wider["label"] == labels["row"], "left_anti").select(F.col("label").alias("row"), F.col("wider").alias("label"))
    return labels.join(wider, "label", "left").select("row", F.coalesce("wider", "label").alias("label")).unionByName(single)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``row`` and ``label``, the least row of its component, for every row of ``links`` (``a``, ``b``)."""
    both = saved(spark, links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "dedup-links")
    labels = saved(spark, both.groupBy(F.col("a").alias("row")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "dedup-labels")
    while True:
        seen = both.join(labels.withColumnRenamed("row", "b"), "b").groupBy(F.col("a").alias("row")).agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "row").select("row", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("row").alias("next"), F.col("label").alias("further"))
        moved = saved(spark, nearer.join(jump, "next").select("row", F.least("next", "further").alias("label"), (F.least("next", "further") < F.col("label")).alias("moved")), "dedup-labels")
        labels = moved.select("row", "label")
        if moved.filter("moved").isEmpty():
            return labels


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = 0.8, strength: float = IDF_STRENGTH) -> DataFrame:
    """``doc_id``, ``row_key``, ``class_id``, ``class_size`` and ``kept`` for every row of ``docs`` (``doc_id``, ``text``).

    Two texts are linked when the weighted Jaccard similarity of their word shingles (count times IDF over all rows) is
    ``threshold`` or more; classes are the connected components, ``class_id`` the least ``doc_id`` in it, and one row per class
    is ``kept``. Texts with the same words are one class. Texts without words (null, blank) have no shingles and stay
    alone, also those in different rows. Repeated rows are copies; a null id counts as the largest. ``row_key`` is the hash
    of the whole input row.
    """
    signed = _signed(spark, docs.select("doc_id", "text", row_key(docs).alias("row_key")), threshold, strength)
    alone = signed.filter("bands IS NULL").select("doc_id", "row_key", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    rows = signed.filter("bands IS NOT NULL")
    texts = saved(spark, rows.groupBy("d1", "d2").agg(F.min("row").alias("text_row")), "dedup-texts")
    chosen = rows.select("row", "batch", "bands", "sketch").join(texts.select(F.col("text_row").alias("row")), "row", "left_semi")
    labels = linked_labels(spark, saved(spark, chosen, "dedup-chosen"), signed, threshold)
    placed = (
        rows.select("doc_id", "row_key", "row", "d1", "d2").join(texts, ["d1", "d2"])
        .join(labels.select(F.col("row").alias("text_row"), "label"), "text_row", "left")
        .select("doc_id", "row_key", "row", F.coalesce("label", "text_row").alias("label"))
    )
    placed = saved(spark, placed, "dedup-placed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    classes = placed.groupBy("label").agg(least, F.count("*").alias("class_size"))
    grouped = placed.join(classes, "label").select(
        "doc_id", "row_key", F.col("least.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("least.row")).alias("kept")
    )
    return grouped.unionByName(alone)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of near copies; of equal rows one stays if any does."""
    kept = near_duplicates(spark, docs, **options).filter("kept").select(F.col("row_key").alias("__row_key"))
    keyed = docs.withColumn("__row_key", row_key(docs))
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    first = keyed.filter(words).dropDuplicates(["__row_key"])
    return first.join(kept, "__row_key", "left_semi").unionByName(keyed.filter(~words)).select(*docs.columns)
