"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound by multiplying its letters' vectors, the
first rotated twice, the second once; a text or language is the bundle (sum) of its trigrams. A language's
prototype is the bundle of all its training texts; a text goes to the prototype of highest cosine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 1024
SEED = 20240501
UNKNOWN = "und"
DOCS_PER_BLOCK = 256
CHARS_PER_BLOCK = 1 << 21
GRAMS_PER_SLICE = 1 << 14
SHARPNESS = 16.0  # of the score: a softmax over cosines
GAP = 32  # stands for any run without letters
LEAST_SHARE, FEWEST = 0.5, 0.001  # of the cosine that all but these texts of like length reach
LEAST_TEXTS = 100  # of like length, to learn a least cosine from


def _letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """The vectors of code points, each from its own seed: equal in every task."""
    rows = [np.random.default_rng([SEED, int(c)]).integers(0, 2, dimensions) for c in letters]
    return (2 * np.array(rows, np.int8).reshape(len(letters), dimensions) - 1).astype(np.int8)


def trigram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of trigrams, given as code points in three fields of 21 bits."""
    first, second, third = (grams >> 42) & 0x1FFFFF, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF
    letters = np.unique(np.concatenate([first, second, third]))
    vectors = _letter_vectors(letters, dimensions)
    pick = lambda x, turn: np.roll(vectors, turn, axis=1)[np.searchsorted(letters, x)]
    return pick(first, 2) * pick(second, 1) * pick(third, 0)


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, runs without letters as one gap, a gap around each text; and their rows."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    text = "".join(" " + t + " " for t in lowered.to_pylist())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    sizes = pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    rows = np.repeat(np.arange(len(sizes)), sizes)
    present = np.unique(codes)
    other = present[[not chr(c).isalpha() for c in present]]
    codes[np.isin(codes, other)] = GAP
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != GAP) | (codes[:-1] != GAP) | (rows[1:] != rows[:-1])
    return codes[kept], rows[kept]


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams, the row and the place among them of every occurrence, and which texts have letters."""
    codes, rows = _letters(texts)
    lettered = np.bincount(rows, weights=codes != GAP, minlength=len(texts)) > 0
    grams = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    inside = (rows[:-2] == rows[2:]) & (codes[1:-1] != GAP)
    index, distinct = pd.factorize(grams[inside])
    return distinct, rows[:-2][inside], index, lettered


def _bundled(distinct: np.ndarray, rows: np.ndarray, index: np.ndarray, n_rows: int, dimensions: int) -> np.ndarray:
    """Bundle of each row, a bounded slice of the trigrams at a time. Whole numbers, exact below 2^53."""
    out = np.zeros((n_rows, dimensions))
    order = np.argsort(index, kind="stable") if len(distinct) > GRAMS_PER_SLICE else slice(None)
    index, rows = index[order], rows[order]
    for start in range(0, len(distinct), GRAMS_PER_SLICE):
        vectors = trigram_vectors(distinct[start : start + GRAMS_PER_SLICE], dimensions).astype(np.float32)
        part = slice(*np.searchsorted(index, [start, start + len(vectors)])) if len(distinct) > GRAMS_PER_SLICE else slice(None)
        flat = np.bincount(rows[part] * len(vectors) + index[part] - start, minlength=n_rows * len(vectors))
        out += flat.reshape(n_rows, -1).astype(np.float32) @ vectors
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of bounded text volume; a single text may exceed it."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            fit = int(np.searchsorted(np.cumsum(sizes[start : start + DOCS_PER_BLOCK]), CHARS_PER_BLOCK, side="right"))
            yield batch.slice(start, max(1, fit))
            start += max(1, fit)


def _bundles(dimensions: int):
    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for block in _blocks(batches):
            distinct, rows, index, _ = _trigrams(block.column(0))
            names = block.column(1).dictionary_encode()
            lang = names.indices.to_numpy(zero_copy_only=False)
            names = names.dictionary.to_pylist()
            out = _bundled(distinct, lang[rows], index, len(names), dimensions)
            for name, row in zip(names, out, strict=True):
                sums[name] = sums.get(name, 0) + row
        if sums:
            # Sums of whole numbers below 2^53: exact, so their order does not matter.
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([s.astype(np.int64).tolist() for s in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "bundle"],
            )

    return bundles


def prototypes(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", dimensions: int = DIMENSIONS) -> DataFrame:
    """(lang, prototype): the bundle of all texts of each non-null language; one row per language."""
    sums = (
        docs.filter(F.col(lang_column).isNotNull())
        .select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
        .mapInArrow(_bundles(dimensions), "lang string, bundle array<bigint>")
    )
    parts = sums.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("total"))
    rows = parts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "total"))).alias("cells"))
    return rows.select("lang", F.transform("cells", lambda c: c["total"]).alias("prototype"))


def _compare(names: list[str], matrix: np.ndarray, dimensions: int):
    """Adds prediction, score and best cosine to (text, ...) blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            distinct, rows, index, lettered = _trigrams(block.column(0))
            bundle = _bundled(distinct, rows, index, block.num_rows, dimensions)
            norm = np.sqrt((bundle**2).sum(1))
            cosine = np.zeros((block.num_rows, max(1, len(names))))
            if names:
                cosine = (bundle @ matrix.T) / np.where(norm > 0, norm, 1)[:, None]
            best = cosine.argmax(1)
            weight = np.exp(SHARPNESS * (cosine - cosine.max(1, keepdims=True)))
            sure = 1 / weight.sum(1)
            known = lettered & bool(names)
            picked = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(i) for i in range(1, block.num_columns)),
                    pa.array(picked, pa.string()),
                    pa.array(np.where(known, np.clip(sure, 0, 1), 0.0).astype(np.float64)),
                    pa.array(np.where(known, cosine.max(1), 0.0).astype(np.float64)),
                ],
                names=[*block.schema.names[1:], "lang_pred", "score", "cosine"],
            )

    return compare


def predict_language(docs: DataFrame, profiles: DataFrame, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with lang_pred, score (0 to 1) and the best cosine.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no profile was
    learned. Equal cosines go to the language first in code-point order. Whole texts are read.
    """
    rows = sorted(((r["lang"], r["prototype"]) for r in profiles.collect()), key=lambda r: r[0])  # one row per language
    matrix = np.array([p for _, p in rows], np.float64)
    if len(rows):
        matrix /= np.maximum(np.sqrt((matrix**2).sum(1)), 1e-12)[:, None]
    keep = keep or ["doc_id"]
    chosen = docs.select(F.col(text_column).alias("__text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    dimensions = matrix.shape[1] if len(rows) else DIMENSIONS
    return chosen.mapInArrow(
        _compare([n for n, _ in rows], matrix, dimensions), f"{schema}, lang_pred string, score double, cosine double"
    )


def learn_and_predict(docs: DataFrame, learn: Column, text_column: str = "text", lang_column: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Prototypes from the rows where ``learn`` holds, predictions for all rows."""
    return predict_language(docs, prototypes(docs.filter(learn), text_column, lang_column), text_column, keep)


def least_cosines(docs: DataFrame, profiles: DataFrame, text_column: str = "text", lang_column: str = "lang") -> dict[int, float]:
    """By length class (powers of two), the cosine below which a text is like no language, from texts that go to their own."""
    size = _length_class(F.col(text_column))
    known = docs.filter(F.col(lang_column).isNotNull()).select(F.col(text_column).alias("text"), F.col(lang_column).alias("own"), size.alias("size"))
    own = predict_language(known, profiles, keep=["own", "size"]).filter("own = lang_pred")
    found = own.groupBy("size").agg(F.count("*").alias("n"), F.percentile_approx("cosine", FEWEST).alias("reached")).filter(F.col("n") >= LEAST_TEXTS)
    return {r["size"]: LEAST_SHARE * r["reached"] for r in found.collect()}


def _length_class(text: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.lit(1), F.coalesce(F.char_length(text), F.lit(0))))).cast("int")


def identified(docs: DataFrame, learn: Column, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is like a language learned from the rows where ``learn`` holds, with their columns.

    Texts without letters go, and those whose best cosine is below the least of their length class. If nothing
    was learned, all texts with letters stay.
    """
    profiles = written(prototypes(docs.filter(learn), text_column, lang_column), "profiles")
    if not profiles.limit(1).count():
        return docs.filter(F.col(text_column).rlike("\\p{L}"))
    least = least_cosines(docs.filter(learn), profiles, text_column, lang_column)
    rows = docs.select(F.struct("*").alias("__doc"), F.col(text_column).alias("__t"), _length_class(F.col(text_column)).alias("__size"))
    found = predict_language(rows, profiles, "__t", ["__doc", "__size"]).filter(F.col("lang_pred") != UNKNOWN)
    for size, cosine in least.items():
        found = found.filter((F.col("__size") != size) | (F.col("cosine") >= cosine))
    return found.select("__doc.*")
