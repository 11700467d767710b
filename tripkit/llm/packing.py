"""Pack tokenised documents into training sequences of several context sizes."""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import chunks, saved

WINDOW = 2048
TIERS = [1024, 512, 256]  # the smallest that holds a document's remainder is its tier
GAP_SHARE = 0.5  # at most this share of the shorter tiers' ids fills gaps of long windows
END = 1  # the id after each document
CLASSES = 32  # classes of remainders over half a window, by length
FULL, LONG, SHORT = "full", "long", "short"
_BLOCK = 1 << 17  # positions of the fill stream that one group lays out
_CACHED_WORDS = 500_000
_BATCH = 2000
_PARTS = (
    "part int, kind string, class int, doc_id {id}, start long, length long, ids_crc32 long, head_crc32 long, doc_tokens long, "
    "number long, gap_before long, fill_before long, ids binary"
)
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def public_tokenizer() -> str:
    """Path of the byte-level vocabulary that is installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of whole texts as little-endian 32-bit bytes.

    A pretokeniser never joins a non-space character with what follows its space, so text is cut at single blanks between
    non-space characters and the ids of ``" word"`` are remembered, up to a bounded number of words. Texts with other
    white space around a blank, or with a special token, go through the tokeniser whole. Where the vocabulary also
    lies beside it as ranks, new words are encoded by these, many at a time: the ids are the same, in less time.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.ranked = None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.begins = np.zeros(max(table.values()) + 1, bool)  # ids that begin with a blank
            self.begins[[i for token, i in table.items() if token.startswith(b" ")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of ``" word"`` for words without a blank; only their first id begins with one."""
        if self.ranked is None:
            return self._encode([f" {w}" for w in words])
        ids = np.array(self.ranked.encode_ordinary("".join(f" {w}" for w in words)), "<u4")
        cuts = (np.flatnonzero(self.begins[ids]) * 4).tolist() + [4 * len(ids)]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHED_WORDS:
            self.known.clear()
        split = [t.split(" ") for t in texts]
        new = list(set().union(*(w[1:] for w in split)).difference(self.known))
        safe = [w for w in new if w and not w[0].isspace() and not w[-1].isspace() and not any(t in w for t in self.special)]
        for at in range(0, len(safe), _BATCH):
            some = safe[at : at + _BATCH]
            self.known.update(zip(some, self._encode_words(some), strict=True))
        heads = self._encode([w[0] for w in split])
        out = []
        for text, words, head in zip(texts, split, heads):
            first = words[0]
            if len(words) > 1 and (not first or first[-1].isspace()):
                out.append(self._encode([text])[0])
                continue
            try:
                out.append(head + b"".join(map(self.known.__getitem__, words[1:])))
            except KeyError:
                out.append(self._encode([text])[0])
        return out


@lru_cache(1)
def _tokens(path: str) -> Tokens:
    """One per Python worker, so that words stay known from task to task."""
    return Tokens(path)


def _tier(length: int) -> int:
    return sum(length <= t for t in TIERS) - 1


def tokenised_parts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each document as its full windows and a remainder, with running numbers inside each input partition.

    The remainder keeps those ids at which it might still be cut. ``number``, ``gap_before`` and ``fill_before`` count the
    rows, the gaps they would leave in a window and the ids they bring to the fill stream, per class, within the partition.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, part = _tokens(tokenizer), TaskContext.get().partitionId()
        numbers: dict[int, int] = {}
        gaps: dict[int, int] = {}
        fills: dict[int, int] = {}
        end = np.array([END], "<u4").tobytes()
        for frame in chunks(frames, "text"):
            rows = []
            for doc, ids in zip(frame["doc_id"], tokens.encode([t or "" for t in frame["text"]])):
                ids += end
                count = len(ids) // 4
                whole = count // WINDOW
                for w in range(whole):
                    crc = zlib.crc32(ids[w * WINDOW * 4 : (w + 1) * WINDOW * 4])
                    rows.append((part, FULL, -1, doc, w * WINDOW, WINDOW, crc, None, count, numbers.get(-1, 0), 0, 0, None))
                    numbers[-1] = numbers.get(-1, 0) + 1
                start, rest = whole * WINDOW, ids[whole * WINDOW * 4 :]
                length = len(rest) // 4
                if not length:
                    continue
                half = WINDOW // 2
                if length > half:
                    what, cls, fill, gap, head = LONG, (length - half - 1) * CLASSES // half, length - half, WINDOW - length, zlib.crc32(rest[: half * 4])
                    cut = rest[half * 4 :]
                else:
                    what, cls, fill, gap, head, cut = SHORT, CLASSES + _tier(length), length, 0, None, rest
                rows.append((part, what, cls, doc, start, length, zlib.crc32(rest), head, count,
                             numbers.get(cls, 0), gaps.get(cls, 0), fills.get(cls, 0), cut))
                numbers[cls] = numbers.get(cls, 0) + 1
                gaps[cls] = gaps.get(cls, 0) + gap
                fills[cls] = fills.get(cls, 0) + fill
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _PARTS.split(", ")])
            yield out.astype({"head_crc32": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, _PARTS.format(id=kind))


def _powers(count: int) -> list[int]:
    """``count`` as falling powers of two."""
    return [1 << b for b in range(count.bit_length() - 1, -1, -1) if count >> b & 1]


class Run(NamedTuple):
    """Windows of one ``size`` that follow each other in the fill stream from ``begin``, numbered from ``sequence``."""

    begin: int
    size: int
    sequence: int


class Layout(NamedTuple):
    """Where the rows of each class go (a row per class), the ids that fill gaps, the runs of windows behind these, and the
    first sequence and the context size of each kind of sequence."""

    classes: pd.DataFrame
    gaps: int
    runs: list[Run]
    kinds: list[tuple[int, int]]
    sequences: int


def lay_out_tiers(total: dict[int, tuple[int, int, int]]) -> Layout:
    """``total``: rows, gaps and ids for the fill stream of each class.

    The rests of windows that stay closed join the tier that holds them. Of each tier the same share of ids fills gaps; the
    others are packed in whole windows of the tier's size, and what is too little for these makes falling powers of two.
    """
    of = lambda c: total.get(c, (0, 0, 0))
    opened = _opened_classes(total)
    split = [c for c in range(CLASSES) if c not in opened]
    row_base, sequence = {-1: 0}, of(-1)[0]
    kinds = [(0, WINDOW)]
    for some, size in ((opened, WINDOW), (split, WINDOW // 2)):
        kinds.append((sequence, size))
        for c in some:
            row_base[c], sequence = sequence, sequence + of(c)[0]
    gap_base, gaps = {}, 0
    for c in opened:
        gap_base[c], gaps = gaps, gaps + of(c)[1]
    tiers = {CLASSES + t: t for t in range(len(TIERS))} | {c: _tier((c + 1) * (WINDOW // 2) // CLASSES) for c in split}
    fill_base, ids = {}, [0] * len(TIERS)
    for c, t in tiers.items():
        fill_base[c], ids[t] = ids[t], ids[t] + of(c)[2]
    supply = sum(ids)
    beyond = supply - gaps
    own = [n * beyond // max(supply, 1) // size * size for n, size in zip(ids, TIERS)]
    runs, position, own_at = [], supply - sum(own), []
    for n, size in zip(own, TIERS):
        kinds.append((sequence, size))
        own_at.append(position)
        runs.append(Run(position, size, sequence))
        position, sequence = position + n, sequence + n // size
    tail = []
    for size in _powers(beyond - sum(own)):
        kinds.append((sequence, size))
        tail.append(Run(gaps + sum(r.size for r in tail), size, sequence))
        sequence += 1
    rest_at = [sum(ids[:t]) - sum(own[:t]) for t in range(len(TIERS))]
    rows = [
        (c, row_base.get(c, 0), gap_base.get(c, 0), fill_base.get(c, 0), c in opened, *((own[t], own_at[t], rest_at[t]) if (t := tiers.get(c)) is not None else (0, 0, 0)))
        for c in range(-1, CLASSES + len(TIERS))
    ]
    columns = ["class", "rows_base", "gaps_base", "fills_base", "opened", "own", "own_at", "rest_at"]
    return Layout(pd.DataFrame(rows, columns=columns), gaps, tail + runs, kinds, sequence)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, group_size: int = 64) -> DataFrame:
    """One row per piece of a document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``context`` (tokens of the sequence) and ``step_group``.

    Full windows of a document are sequences of their own. A remainder over half a window belongs to the longest tier: it
    opens a window, and the gap behind it is filled with ids of the shorter tiers. As many windows are opened, longest
    remainders first, as GAP_SHARE of the shorter tiers' ids can fill; other long remainders give their first half as a
    sequence of that context size and the rest joins the tier that holds it. Each tier packs the ids that fill no gap in
    windows of its own size, documents cut where a window ends. Less than a window of each tier is left, which makes
    falling powers of two. So every sequence has a power of two as length and none is padded. Step groups take equal
    shares of each kind of sequence, and among opened windows, which stand in order of length, of each length.

    ``docs``: ``doc_id``, ``text`` (null: empty); other columns are ignored; repeated rows are packed each. Positions come from
    running numbers of saved rows and sums per partition and class, so no task sorts or gathers a class.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = saved(spark, tokenised_parts(docs, tokenizer), "packing-parts")
    fill_ids = F.when(F.col("kind") == LONG, F.col("length") - WINDOW // 2).otherwise(F.col("length"))
    per_part = saved(spark, parts.groupBy("class", "part").agg(
        F.count("*").alias("rows"), F.sum(F.when(F.col("kind") == LONG, WINDOW - F.col("length")).otherwise(0)).alias("gaps"),
        F.sum(fill_ids).alias("fills"),
    ), "packing-sums")
    # A row per class: full windows, CLASSES lengths, three tiers.
    total = {r["class"]: (r["rows"], r["gaps"], r["fills"]) for r in per_part.groupBy("class").agg(*(F.sum(c).alias(c) for c in ("rows", "gaps", "fills"))).collect()}
    layout = lay_out_tiers(total)
    gap_total, runs, begins_of_runs = layout.gaps, layout.runs, [r.begin for r in layout.runs]
    bases = spark.createDataFrame(
        layout.classes, "class int, rows_base long, gaps_base long, fills_base long, opened boolean, own long, own_at long, rest_at long"
    )
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) + F.col(f"{c}_base")
    offsets = per_part.join(F.broadcast(bases), "class").select(  # a row per class
        "class", "part", "opened", "own", "own_at", "rest_at", before("rows").alias("rows_at"), before("gaps").alias("gaps_at"), before("fills").alias("fills_at")
    )
    placed = parts.join(offsets, ["class", "part"])
    number = F.col("rows_at") + F.col("number")
    crc = F.when((F.col("kind") == LONG) & ~F.col("opened"), F.col("head_crc32")).otherwise(F.col("ids_crc32"))
    length = F.when((F.col("kind") == LONG) & ~F.col("opened"), WINDOW // 2).otherwise(F.col("length"))
    leading = placed.filter(F.col("kind") != SHORT).select(
        "doc_id", "start", length.cast("long").alias("length"), crc.alias("ids_crc32"), "doc_tokens", number.alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    half = WINDOW // 2
    place = F.col("fills_at") + F.col("fill_before")
    inside = F.greatest(F.lit(0), F.least(fill_ids, F.col("own") - place))  # ids that stay in windows of their tier
    part = lambda skip, length, at: F.struct(skip.cast("long").alias("skip"), length.cast("long").alias("length"), at.alias("at"))
    in_stream = F.filter(F.array(
        part(F.lit(0), inside, F.col("own_at") + place), part(inside, fill_ids - inside, F.col("rest_at") + place + inside - F.col("own")),
    ), lambda p: p["length"] > 0)
    fill = placed.filter((F.col("kind") == SHORT) | ((F.col("kind") == LONG) & ~F.col("opened"))).select(
        "doc_id", F.when(F.col("kind") == LONG, F.col("start") + half).otherwise(F.col("start")).alias("start"), "doc_tokens", "ids", F.inline(in_stream)
    )
    gaps = placed.filter((F.col("kind") == LONG) & F.col("opened")).select(
        (F.col("gaps_at") + F.col("gap_before")).alias("at"), (WINDOW - F.col("length")).alias("length"), number.alias("sequence_id"), F.col("length").alias("offset")
    )
    blocked = lambda df: df.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / _BLOCK), F.floor((F.col("at") + F.col("length") - 1) / _BLOCK))))

    def lay_out(fills: pd.DataFrame, gaps: pd.DataFrame) -> pd.DataFrame:
        rows = []
        fills, gaps = fills.sort_values("at"), gaps.sort_values("at")
        if len(fills):
            low = int(fills["block"].iloc[0]) * _BLOCK
            begins = gaps["at"].to_numpy(np.int64)
            ends = begins + gaps["length"].to_numpy(np.int64)
            sequences, behind = gaps["sequence_id"].to_numpy(np.int64), gaps["offset"].to_numpy(np.int64)
            for doc, start, skip, size, total_ids, at, ids in zip(*(fills[c] for c in ("doc_id", "start", "skip", "length", "doc_tokens", "at", "ids"))):
                here, stop = max(at, low), min(at + size, low + _BLOCK)
                while here < stop:
                    if here < gap_total:
                        g = int(np.searchsorted(begins, here, "right")) - 1
                        edge, sequence, offset = int(ends[g]), int(sequences[g]), int(behind[g] + here - begins[g])
                    else:
                        run = runs[bisect_right(begins_of_runs, here) - 1]
                        window, offset = divmod(here - run.begin, run.size)
                        edge, sequence = run.begin + (window + 1) * run.size, run.sequence + window
                    until, shift = min(edge, stop), skip - at
                    crc = zlib.crc32(ids[(here + shift) * 4 : (until + shift) * 4])
                    rows.append((doc, start + here + shift, until - here, crc, total_ids, sequence, offset))
                    here = until
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
        return out

    filled = blocked(fill).groupBy("block").cogroup(blocked(gaps).groupBy("block")).applyInPandas(lay_out, PIECES.format(id=kind))
    pieces = leading.unionByName(filled)
    groups = max(1, -(-layout.sequences // group_size))
    sequence = F.col("sequence_id")
    context = F.lit(WINDOW)
    for first, size in layout.kinds[1:]:
        context = F.when(sequence >= first, size).otherwise(context)
    return pieces.withColumns({"context": context, "step_group": (sequence % groups).cast("long")})


def _opened_classes(total: dict[int, tuple[int, int, int]]) -> list[int]:
    """Classes of long remainders, longest first, whose gaps GAP_SHARE of the shorter tiers and of the other classes' rests can fill."""
    zero = (0, 0, 0)
    fill = sum(total.get(c, zero)[2] for c in range(CLASSES, CLASSES + len(TIERS)))
    rests = sum(total.get(c, zero)[2] for c in range(CLASSES))
    opened, gaps = [], 0
    for c in range(CLASSES - 1, -1, -1):
        _, gap, rest = total.get(c, zero)
        if gaps + gap > GAP_SHARE * (fill + rests - rest):
            break
        opened, gaps, rests = [*opened, c], gaps + gap, rests - rest
    return opened

