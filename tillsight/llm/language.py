"""Language identification by nearest centroid.

A text is the TF-IDF vector of its letter n-grams (one to three letters, hashed
to a fixed number of columns), scaled to length one. Each language has several
centroids, found by spherical k-means over a bounded sample. The language of the
nearest centroid by cosine wins; a text farther off than texts of its length
were in training is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import fresh, remembered, tidy


COLUMNS = 8192
NO_LANGUAGE = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def _letters() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter, or 0 for what is no letter."""
    table = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


class Grams:
    """Counts hashed letter n-grams of texts; runs of other characters count as one border."""

    def __init__(self, columns: int = COLUMNS):
        self.columns, self.table = columns, _letters()

    def counts(self, text: str | None) -> np.ndarray | None:
        """Occurrences per column, None for a text without letters."""
        if not text:
            return None
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        if int(points.max(initial=0)) < 1 << 16:
            codes = self.table[points]
        else:  # letters of higher planes stand for themselves
            codes = self.table[np.minimum(points, 0xFFFF)]
            high = np.flatnonzero(points >= 1 << 16)
            codes[high] = [p if chr(p).isalpha() else 0 for p in points[high].tolist()]
        if not codes.any():
            return None
        codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        codes = codes[keep]
        one = codes * _MIX[0]
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + codes[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[2] + codes[2:]
        hashed = np.concatenate([one[codes != 0] + np.uint32(1), two * _MIX[0] + np.uint32(2), three * _MIX[0] + np.uint32(3)])
        hashed = (hashed ^ (hashed >> np.uint32(16))) * _MIX[1]
        return np.bincount((hashed >> np.uint32(8)) % np.uint32(self.columns), minlength=self.columns)


def length_class(count: float) -> int:
    """Texts compare with texts of about as many n-grams: one class for each doubling."""
    return min(31, int(np.log2(max(count, 1))))


@dataclass
class Model:
    languages: list[str]
    centroids: np.ndarray  # rows of length one
    owner: np.ndarray  # language of each centroid
    idf: np.ndarray
    radius: np.ndarray  # smallest cosine that is not rejected, per length class; a model without centroids rejects all

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts).astype(np.float32) * self.idf
        return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and cosine, 0 to 1, of each row of counts; of equal cosines the first language wins."""
        if not len(self.centroids):
            return np.full(len(counts), -1), np.zeros(len(counts))
        cosine = self.vectors(counts) @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        return self.owner[best], np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)


def _sparse(counts: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes(), counts[at].astype(np.uint32).tobytes()


def _spherical_means(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k centroids of length one: starts far from each other, then rounds of assignment by cosine."""
    mean = vectors.mean(axis=0)
    starts = [int(np.argmax(vectors @ mean))]
    near = vectors @ vectors[starts[0]]
    while len(starts) < min(k, len(vectors)):
        starts.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[starts[-1]])
    centers = vectors[starts].copy()
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, axis=1)
        moved = np.array([vectors[own == c].sum(axis=0) if (own == c).any() else centers[c] for c in range(len(centers))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centers, atol=1e-6):
            break
        centers = moved
    return centers


def document_frequencies(texts: DataFrame, columns: int = COLUMNS) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram column occurs, over all rows; a task hands on one row of sums."""
    @tidy
    def sums(batches):
        grams, total, n = remembered(f"grams {columns}", lambda: Grams(columns)), np.zeros(columns, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = grams.counts(text.as_py())
                if counts is not None:
                    total += counts > 0
                    n += 1
        yield pa.RecordBatch.from_pydict({"n": [n], "df": [total.tolist()]})

    parts = texts.mapInArrow(sums, "n long, df array<long>").select("n", F.posexplode("df").alias("column", "df"))
    found = parts.groupBy("column").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect()  # one row per column
    out = np.zeros(columns)
    for row in found:
        out[row["column"]] = row["df"]
    return out, (found[0]["n"] if found else 0)


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_per_language: int = 600,
        centroids: int = 3, columns: int = COLUMNS, rounds: int = 20, slack: float = 0.5, lowest: float = 0.01) -> Model:
    """Fit on labelled rows (NULL languages are left out).

    Document frequencies cover every row. Centroids and radii come from a sample
    of at most ``sample_per_language`` rows of each language, drawn by a hash of
    id and text. The radius of a length class is ``slack`` times the ``lowest``
    quantile of the cosines seen there (or in the nearest class seen), so that a
    few wrong labels do not set it. Without a labelled row that has a letter, the
    model knows no language and rejects every text.
    """
    rows = train.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = rows.groupBy("lang").count().collect()  # a row per language
    languages = sorted(r["lang"] for r in sizes)
    df, n = document_frequencies(rows.select("text"), columns)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1

    none = Model([], np.zeros((0, columns), np.float32), np.zeros(0, np.int64), idf, np.ones(32))
    if not sizes:
        return none
    # twice the wanted share by the draw, then the first of each language: what is sorted stays small
    space = 1 << 30
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.coalesce("text", F.lit("")), F.lit(17)), F.lit(space))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(space, space * 2 * sample_per_language // r["count"] + 1))])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id"))
    sample = rows.withColumn("draw", draw).filter(F.col("draw") < F.try_element_at(share, F.col("lang")))
    sample = sample.withColumn("place", place).filter(F.col("place") <= sample_per_language).select("lang", "text")

    @tidy
    def sparse(batches):
        grams = remembered(f"grams {columns}", lambda: Grams(columns))
        for batch in batches:
            found = [(lang, grams.counts(text.as_py())) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            pairs = [(lang, *_sparse(c)) for lang, c in found if c is not None]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], t) for k, t in enumerate((pa.string(), pa.binary(), pa.binary()))], names=["lang", "at", "n"])

    drawn = sorted(map(tuple, sample.mapInArrow(sparse, "lang string, at binary, n binary").collect()))
    if not drawn:
        return none
    counts = np.zeros((len(drawn), columns), np.float32)
    for k, (_, at, many) in enumerate(drawn):
        counts[k, np.frombuffer(at, np.uint16)] = np.frombuffer(many, np.uint32)
    label = np.array([languages.index(r[0]) for r in drawn])
    model = Model(languages, np.zeros((0, columns), np.float32), np.zeros(0, np.int64), idf, np.zeros(32))
    vectors = model.vectors(counts)
    found = [(code, _spherical_means(vectors[label == code], centroids, rounds)) for code in range(len(languages)) if (label == code).any()]
    model.centroids = np.concatenate([c for _, c in found]).astype(np.float32)
    model.owner = np.concatenate([np.full(len(c), code) for code, c in found])

    _, cosine = model.nearest(counts)
    classes = np.array([length_class(c) for c in counts.sum(axis=1)])
    seen = {c: float(np.quantile(cosine[classes == c], lowest, method="lower")) for c in set(classes.tolist())}
    model.radius = np.array([slack * seen[min(seen, key=lambda c: (abs(c - k), c))] for k in range(32)])
    return model


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and lang_pred, score, rejected (with an underscore behind a name that ``df`` has).

    ``score`` is the cosine to the nearest centroid. A NULL text or one without
    a letter is ``und`` with score 0, and rejected.
    """
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    shared = df.sparkSession.sparkContext.broadcast(model)  # columns x centroids, bounded by the parameters of fit()
    kept = df.columns
    place = kept.index(text_col)
    added = fresh(df, "lang_pred", "score", "rejected")
    names = [*kept, *added]

    @tidy
    def classify(batches):
        m = shared.value
        columns = m.centroids.shape[1]
        grams = remembered(f"grams {columns}", lambda: Grams(columns))
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                found = [grams.counts(t.as_py()) for t in batch.column(place)]
                lang, score, out = [NO_LANGUAGE] * len(found), [0.0] * len(found), [True] * len(found)
                at = [i for i, c in enumerate(found) if c is not None]
                if at:
                    counts = np.array([found[i] for i in at], np.float32)
                    codes, cosine = m.nearest(counts)
                    for i, code, c, n in zip(at, codes.tolist(), cosine.tolist(), counts.sum(axis=1).tolist(), strict=True):
                        if code >= 0:
                            lang[i], score[i], out[i] = m.languages[code], c, c < m.radius[length_class(n)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())], names=names)

    rows = df.select(*kept)
    fields = [StructField(n, t) for n, t in zip(added, (StringType(), DoubleType(), BooleanType()), strict=True)]
    return rows.mapInArrow(classify, StructType([*rows.schema.fields, *fields]))


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    """Rows that no model is fitted on: crc32 of the id as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
