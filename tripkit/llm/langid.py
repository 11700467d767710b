"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.llm.common import chunks

DIMENSIONS, ORDER = 2048, 3
UNKNOWN = "und"
_POINTS = 0x110000
_CELLS, _GRAMS = 4 << 20, 1024  # counts and n-gram vectors held at once
_BYTES, _ROWS = 1 << 20, 512  # of the texts whose n-grams and sums are held at once
_SCALE = float(1 << 24)


@lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(_POINTS)), bool, _POINTS)


@lru_cache(4096)
def letter_vector(point: int, dimensions: int) -> np.ndarray:
    """The random +1/-1 vector of a code point; the same everywhere. 0 is the gap between words."""
    return (np.random.default_rng([dimensions, point]).integers(0, 2, dimensions) * 2 - 1).astype(np.int8)


class Grams:
    """Counts of the letter n-grams of some texts, and the vectors of the n-grams that occur."""

    def __init__(self, texts: list[str | None], order: int, dimensions: int):
        self.dimensions = dimensions
        lowered = [(t or "").lower() for t in texts]
        padded = "".join(f"\0{t}\0" for t in lowered)
        points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        text = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lowered])
        points[~_is_letter()[points]] = 0
        kept = (points != 0) | (np.concatenate([[1], points[:-1]]) != 0)  # gaps of one, and one at each end
        kept[np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))[: len(text)]] = True
        points, text = points[kept], text[kept]
        present = np.zeros(_POINTS, bool)
        present[points] = present[0] = True
        self.letters = np.flatnonzero(present)
        place = np.zeros(_POINTS, np.int32)
        place[self.letters] = np.arange(len(self.letters))
        digits, base = place[points].astype(np.int64), len(self.letters)
        count = max(0, len(digits) - order + 1)
        code = np.zeros(count, np.int64)
        for k in range(order):
            code = code * base + digits[k : k + count]
        whole = text[:count] == text[order - 1 : order - 1 + count]
        code, self.text = code[whole], text[:count][whole]
        if base**order <= 1 << 24:
            seen = np.zeros(base**order, bool)
            seen[code] = True
            self.codes = np.flatnonzero(seen)
            index = np.zeros(base**order, np.int32)
            index[self.codes] = np.arange(len(self.codes))
            self.gram = index[code]
        else:
            self.codes, self.gram = np.unique(code, return_inverse=True)
        self.order, self.base, self.texts, self.table = order, base, len(texts), None
        self.has_letter = np.array([bool(t) and any(map(str.isalpha, t)) for t in lowered], bool)

    def vectors(self, a: int, b: int) -> np.ndarray:
        """Bound vectors of the n-grams a..b: the product of the letters' vectors, each turned by its place."""
        if self.table is None:
            self.table = np.stack([letter_vector(int(p), self.dimensions) for p in self.letters])
        out, rest = None, self.codes[a:b].copy()
        for k in range(self.order):
            turned = np.roll(self.table, k, axis=1)[rest % self.base]
            out, rest = turned if out is None else out * turned, rest // self.base
        return out.astype(np.float32)

    def bundles(self, weights: np.ndarray | None = None, groups: np.ndarray | None = None, n: int | None = None) -> np.ndarray:
        """Sums of n-gram vectors per text, or per group of texts with the texts weighted."""
        n = self.texts if n is None else n
        row = self.text if groups is None else groups[self.text]
        weight = None if weights is None else weights[self.text]
        out = np.zeros((n, self.dimensions), np.float32 if weights is None else np.float64)
        width = max(1, min(_GRAMS, _CELLS // max(1, n)))
        for a in range(0, len(self.codes), width):
            b = min(a + width, len(self.codes))
            inside = slice(None) if b - a == len(self.codes) else (self.gram >= a) & (self.gram < b)
            cells = np.bincount(
                row[inside] * (b - a) + self.gram[inside] - a, None if weight is None else weight[inside], n * (b - a)
            ).reshape(n, b - a)
            out += cells.astype(out.dtype) @ self.vectors(a, b).astype(out.dtype)
        return out


def learn_prototypes(docs: DataFrame, order: int = ORDER, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """One vector per language: the mean over its texts of the mean vector of a text's n-grams.

    ``docs`` holds ``text`` and ``lang``; nulls in either are left out. Each task adds up its texts; the sums are whole
    numbers, so they do not depend on order. What reaches the driver is languages times dimensions. Texts without n-grams
    do not count.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in chunks(frames, "text", _BYTES, _ROWS):
            names, groups = np.unique(frame["lang"].to_numpy(str), return_inverse=True)
            grams = Grams([t.decode() for t in frame["text"]], order, dimensions)
            sizes = np.bincount(grams.text, minlength=len(frame))
            bundle = np.rint(grams.bundles(1 / np.maximum(sizes, 1), groups, len(names)) * _SCALE).astype(np.int64)
            bundle = np.column_stack([bundle, np.bincount(groups, sizes > 0, len(names)).astype(np.int64)])
            for name, vector in zip(names, bundle):
                sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": [name], "vector": [vector]})

    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("binary").alias("text"))
    parts = known.mapInPandas(run, "lang string, vector array<long>")
    total = parts.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for row in total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).collect():
        *vector, texts = [x["value"] for x in row["v"]]
        out[row["lang"]] = np.array(vector, float) / (max(texts, 1) * _SCALE)
    return {k: out[k] for k in sorted(out)}


def predict_language(
    docs: DataFrame, prototypes: dict[str, np.ndarray], order: int = ORDER, columns: list[str | Column] = ("doc_id",),
    expected: bool = False,
) -> DataFrame:
    """``columns`` of ``docs`` with ``lang_pred`` and ``score``, the cosine with the nearest prototype (0 at least).

    ``und`` with score 0 for texts that are null or hold no letter, and when no language was learned. Equal scores go
    to the first language by name. Only ``text`` is read for the prediction.

    ``expected`` adds the cosine that a text of the predicted language with as many and as often repeated n-grams has on
    average: with n n-grams, counts c and probabilities p in the language, c.p is n |p|^2 on average, so the cosine is
    |p| n / |c|, at most 1. ``prototypes`` must be those of ``learn_prototypes`` then, whose lengths tell |p|.
    """
    judge = _judge(prototypes, order, expected)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop(columns="__text").join(judge(frame["__text"]))

    selected = docs.select(*columns, F.col("text").cast("binary").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in selected.schema if f.name != "__text")
    return selected.mapInPandas(run, f"{fields}, {_JUDGED}" + (", expected double" if expected else ""))


_JUDGED = "lang_pred string, score double"


def _judge(prototypes: dict[str, np.ndarray], order: int, expected: bool) -> Callable[[pd.Series], pd.DataFrame]:
    """The function that judges UTF-8 texts, some at a time, with the prototypes packed for the workers."""
    names = list(prototypes)
    dimensions = len(next(iter(prototypes.values()))) if names else DIMENSIONS
    table = np.array([prototypes[n] for n in names]).reshape(len(names), dimensions)
    norms = np.linalg.norm(table, axis=1)
    packed = pickle.dumps((table / np.maximum(norms, 1e-300)[:, None], norms))

    def judge(texts: pd.Series) -> pd.DataFrame:
        parts = [judge_part(part["text"]) for part in chunks([texts.to_frame("text")], "text", _BYTES, _ROWS)]
        return pd.concat(parts) if parts else judge_part(texts)

    def judge_part(texts: pd.Series) -> pd.DataFrame:
        unit, norms = pickle.loads(packed)
        if not names:
            return pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, **({"expected": 0.0} if expected else {})}, index=texts.index)
        grams = Grams([None if t is None else bytes(t).decode() for t in texts], order, dimensions)
        vectors = grams.bundles().astype(float)
        lengths = np.linalg.norm(vectors, axis=1)
        cosine = (vectors @ unit.T) / np.maximum(lengths, 1e-300)[:, None]
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0, 1)
        out = {
            "lang_pred": np.where(grams.has_letter, np.array(names, object)[best], UNKNOWN), "score": np.where(grams.has_letter, score, 0.0)
        }
        if expected:
            usual = norms[best] * np.bincount(grams.text, minlength=len(best)) / np.maximum(lengths, 1e-300)
            out["expected"] = np.where(grams.has_letter, np.minimum(usual, 1), 0.0)
        return pd.DataFrame(out, index=texts.index)

    return judge


def language_column(text: Column, prototypes: dict[str, np.ndarray], order: int = ORDER) -> Column:
    """``lang_pred``, ``score`` and ``expected`` of a text as a struct, as ``predict_language`` gives them.

    Only the text goes to the workers, and only the answer comes back: other columns of the row stay where they are.
    """
    judge = _judge(prototypes, order, True)

    @F.pandas_udf(f"{_JUDGED}, expected double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield judge(texts)

    return judged(text.cast("binary"))
