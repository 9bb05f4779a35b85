"""Language ID by the nearest of several centroids per language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared

#: Labelled texts per language that the classifier is fitted on at most: the bound of the sample.
PER_LANGUAGE = 400
#: Numbers of a text vector, centroids per language.
DIMENSIONS, CENTROIDS = 4096, 4
#: A text is rejected if it is less like its nearest centroid than this part of what all but 1 in 100 fitted texts of its length are.
REJECT = 0.5
#: Lengths for which that is fitted: 1, 2, 4 .. trigrams; and texts of a language that are cut to each.
LENGTHS, CUT = 15, 100
UNDETERMINED = "und"

_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 32 for c in range(256))


def _trigram_counts(text: str) -> np.ndarray | None:
    """Hashed byte trigrams of a text in lower case, letters only; None if it has no letter."""
    raw = b" " + text.lower().encode().translate(_LETTERS) + b" "
    if not raw.strip() or (raw.isascii() is False and not any(map(str.isalpha, text))):
        return None
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    blank = (a[1:-1] == 32) & ((a[:-2] == 32) | (a[2:] == 32))  # runs of what isn't a letter
    code = code[~blank]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # similarity under which a text is rejected, by length (1, 2, 4 .. trigrams) and centroid

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.sqrt((x**2).sum(1)), 1e-12)[:, None]

    def floor(self, trigrams: int) -> np.ndarray:
        """Per centroid; between two fitted lengths in proportion to the logarithm of the length."""
        at = min(float(np.log2(max(trigrams, 1))), LENGTHS - 1.0)
        low = min(int(at), LENGTHS - 2)
        return self.least[low] + (at - low) * (self.least[low + 1] - self.least[low])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, similarity (0 to 1) and whether the text is rejected, of each text."""
        language, score, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        for start in range(0, len(texts), 256):
            found = [(i, c) for i in range(start, min(start + 256, len(texts))) if texts[i] and (c := _trigram_counts(texts[i])) is not None]
            if not found or not self.languages:
                continue
            like = self.vectors(np.array([c for _, c in found], np.float64)) @ self.centroids.T
            best = like.argmax(1)
            for (i, x), j, value in zip(found, best.tolist(), like[np.arange(len(found)), best].tolist(), strict=True):
                language[i], score[i], rejected[i] = self.languages[j], min(1.0, max(0.0, value)), value < self.floor(int(x.sum()))[j]
        return language, score, rejected


def _cluster(x: np.ndarray, n: int) -> np.ndarray:
    """Spherical k-means, begun farthest first."""
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(n, len(x)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen].copy()
    for _ in range(10):
        cell = (x @ centres.T).argmax(1)
        for j in range(len(centres)):
            if (cell == j).any():
                mean = x[cell == j].mean(0)
                centres[j] = mean / max(np.sqrt((mean**2).sum()), 1e-12)
    return centres


def _shortened(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Counts of ``n`` trigrams of each text, drawn without replacement; a text with fewer stays whole."""
    out = np.zeros_like(counts)
    for i, row in enumerate(counts):
        every = np.repeat(np.arange(len(row)), row.astype(np.int64))
        out[i] = np.bincount(every if len(every) <= n else rng.choice(every, n, replace=False), minlength=len(row))
    return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most ``per_language`` labelled texts of each language, picked by a hash of id and text.

    Counts per language come from all rows. The texts of the sample are counted where they are, as a whole; their
    trigram counts alone come to the driver. Null languages, null texts and texts without letters teach nothing;
    repeated rows teach once.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = {r[0]: min(1.0, 1.3 * per_language / r[1]) for r in known.groupBy(lang_col).count().collect()}
    if not share:
        return Model([], np.zeros((0, DIMENSIONS)), np.ones(DIMENSIONS), np.zeros((LENGTHS, 0)))
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col(lang_col))
    picked = known.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(shared.numbered(id_col), F.col(text_col)).alias("h"), F.col(text_col).cast("string").alias("text"), limit.alias("share"))
    picked = picked.where(F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("share")).select("lang", "h", "text")

    def counted(batches):
        for batch in batches:
            kept, where, many = [], [], []
            for i in range(batch.num_rows):
                if (c := _trigram_counts(batch.column(2)[i].as_py())) is not None:
                    kept.append(i)
                    where.append(np.flatnonzero(c).astype(np.uint16).tobytes())
                    many.append(c[c > 0].astype(np.uint32).tobytes())
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(where, pa.binary()), pa.array(many, pa.binary())], ["lang", "h", "at", "n"])

    rows = picked.mapInArrow(shared.lean(counted), "lang string, h long, at binary, n binary").dropDuplicates(["lang", "h"]).collect()
    by: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        mine = by.setdefault(r["lang"], [])
        if len(mine) < per_language:
            c = np.zeros(DIMENSIONS)
            c[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], np.uint32)
            mine.append(c)
    del rows
    counts = {k: np.array(by.pop(k), np.float64) for k in list(by)}  # the sample is held once: it is the driver's memory
    many, seen = sum(map(len, counts.values())), sum(((c > 0).sum(0) for c in counts.values()), np.zeros(DIMENSIONS, np.int64))
    model = Model([], np.zeros((0, DIMENSIONS)), np.log((1 + many) / (1 + seen)) + 1, np.zeros((LENGTHS, 0)))
    centroids, least = [], []
    for language in sorted(counts):
        x = model.vectors(counts[language])
        centres = _cluster(x, CENTROIDS)
        rng, some = np.random.default_rng(0), counts[language][:CUT]
        floors = [float(np.quantile((model.vectors(_shortened(some, 2**j, rng)) @ centres.T).max(1), 0.01)) for j in range(LENGTHS - 1)]
        floors = np.maximum.accumulate([*floors, max(floors[-1], float(np.quantile((x @ centres.T).max(1), 0.01)))])
        centroids.append(centres)
        model.languages += [language] * len(centres)
        least += [REJECT * floors] * len(centres)
    if centroids:
        model.centroids, model.least = np.concatenate(centroids), np.array(least).T
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model isn't fitted on: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``_lang_pred``, ``_score`` and ``_rejected``; no row travels.

    The vector of a text is the normalised TF-IDF of the byte trigrams of its letters in lower case; the whole text
    counts. Null texts and texts without letters are ``und``, score 0, rejected; so are all if the model is empty. A
    text whose nearest centroid is too far for its length is rejected but keeps the prediction. How far that is was fitted
    on texts of the sample cut to 1, 2, 4 .. trigrams, so the same rule holds for texts of every length.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts, out = batch.column(batch.num_columns - 1), ([], [], [])
            for a, b in shared.steps(texts):
                for have, new in zip(out, sent.value.predict(texts.slice(a, b - a).to_pylist()), strict=True):
                    have.extend(new)
            more = [pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=names)

    keep = shared.others(docs.columns if keep is None else keep, ["_lang_pred", "_score", "_rejected"])
    schema = docs.select(*[f"`{c}`" for c in keep]).schema.add("_lang_pred", "string").add("_score", "double").add("_rejected", "boolean")
    names = schema.names
    return docs.select(*shared.carried(keep), F.col(text_col).cast("string").alias("_input")).mapInArrow(shared.lean(run), schema)


def op7_language_id(spark, sf_dir):
    docs = shared.documents(spark, sf_dir)
    model = fit(docs.where(~held_out()))
    found = identify(docs.withColumn("held_out", held_out()), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected"))
