"""Language ID: blended-spectrum presence kernels, Nyström landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of byte n-grams (two to four bytes, lower case) present in both. Some
texts of each language are landmarks; a text is described by its kernel values with them, mapped by the
inverse root of the landmarks' own kernel matrix and scaled to length one (Nyström features). One ridge
regression per language is fitted on those features. Kernel values of many texts at once are one matrix
product of presence rows with the landmarks' presence columns.

Fitting uses a bounded sample: at most FIT_ROWS labelled rows of each language (the least hashes of the id, one
row for each id), of which LANDMARKS are landmarks. Prediction reads the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolytics.llm.batches import bounded
from odolytics.llm import tokens

ORDERS = (2, 3, 4)
LANDMARKS = 24              # per language
FIT_ROWS = 400              # per language
RIDGE = 1e-2
TABLE_BITS = 20
BLOCK = 64                  # texts per matrix product
UNKNOWN = "und"

_U = np.uint64


@dataclass
class Landmarks:
    """The n-grams of the landmarks, in order, a table to find them, and the map from kernel values to features."""

    codes: np.ndarray           # order and bytes of each n-gram, as one number
    table: np.ndarray           # slot -> first of the n-grams that fall on it, -1 for none
    after: np.ndarray           # n-gram -> the next one on its slot, -1 for none
    presence: np.ndarray        # n-grams x landmarks, zeros and ones
    mapping: np.ndarray         # landmarks x features


@dataclass
class Model:
    landmarks: Landmarks | None
    weights: np.ndarray         # features and a constant x languages
    languages: list[str]


def _codes(raw: np.ndarray, order: int) -> np.ndarray:
    out = np.full(max(0, len(raw) - order + 1), order, dtype=_U)
    for k in range(order):
        out = (out << _U(8)) | raw[k : len(raw) - order + 1 + k].astype(_U)
    return out


def _slots(codes: np.ndarray) -> np.ndarray:
    return ((codes * _U(0x9E3779B97F4A7C15)) >> _U(64 - TABLE_BITS)).astype(np.int64)


def _ngrams(raw: np.ndarray) -> np.ndarray:
    parts = [_codes(raw[at : at + tokens.PIECE_BYTES + n - 1], n) for n in ORDERS for at in range(0, max(1, len(raw) - n + 1), tokens.PIECE_BYTES)]
    return np.unique(np.concatenate([np.unique(p) for p in parts]))


def make_landmarks(texts: list[bytes]) -> Landmarks:
    sets = [_ngrams(np.frombuffer(t, np.uint8)) for t in texts]
    codes = np.unique(np.concatenate(sets)) if sets else np.zeros(0, _U)
    # N-grams that fall on one slot of the table are a chain.
    slots = _slots(codes)
    order = np.argsort(slots, kind="stable")
    first = np.ones(len(codes), dtype=bool)
    first[1:] = slots[order][1:] != slots[order][:-1]
    table, after = np.full(1 << TABLE_BITS, -1, dtype=np.int32), np.full(len(codes), -1, dtype=np.int32)
    table[slots[order][first]] = order[first]
    after[order[:-1][~first[1:]]] = order[1:][~first[1:]]
    presence = np.stack([np.isin(codes, s) for s in sets], axis=1).astype(np.float32)
    kernel = (presence.T @ presence).astype(np.float64)
    size = np.sqrt(np.maximum(np.diag(kernel), 1.0))
    values, vectors = np.linalg.eigh(kernel / size[:, None] / size[None, :])
    good = values > 1e-6 * values.max()
    mapping = (vectors[:, good] / np.sqrt(values[good])) / size[:, None]
    return Landmarks(codes, table, after, presence, mapping.astype(np.float32))


def features(landmarks: Landmarks, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Nyström features of texts, one row each; a text without known n-grams has zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, landmarks.mapping.shape[1]), dtype=np.float32)
    for top in range(0, n, BLOCK):
        rows = range(top, min(n, top + BLOCK))
        x = np.zeros((len(rows), len(landmarks.codes)), dtype=np.float32)
        for i, row in enumerate(rows):
            body = raw[offsets[row] : offsets[row + 1]]
            for at in range(0, len(body), tokens.PIECE_BYTES):
                for order in ORDERS:
                    codes = _codes(body[at : at + tokens.PIECE_BYTES + order - 1], order)
                    number = landmarks.table[_slots(codes)]
                    while (open_ := number >= 0).any():
                        codes, number = codes[open_], number[open_]
                        same = landmarks.codes[number] == codes
                        x[i, number[same]] = 1.0
                        codes, number = codes[~same], landmarks.after[number[~same]]
        z = (x @ landmarks.presence) @ landmarks.mapping
        length = np.linalg.norm(z, axis=1, keepdims=True)
        out[top : top + len(rows)] = z / np.where(length > 0, length, 1.0)
    return out


def _with_constant(phi: np.ndarray) -> np.ndarray:
    return np.hstack((phi, np.ones((len(phi), 1), dtype=phi.dtype)))


def _gram(landmarks, languages: list[str]):
    """Per task the sums that the ridge regressions need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = landmarks.value
        d = known.mapping.shape[1] + 1
        left, right = np.zeros((d, d)), np.zeros((d, len(languages)))
        for batch in batches:
            phi = _with_constant(features(known, *tokens.text_bytes(batch.column("text")))).astype(np.float64)
            label = batch.column("label").to_pylist()
            y = np.where(np.array([[a == b for b in languages] for a in label]).reshape(len(label), len(languages)), 1.0, -1.0)
            left += phi.T @ phi
            right += phi.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array([left.tobytes()], pa.binary()), pa.array([right.tobytes()], pa.binary())], names=["left", "right"]
        )

    return run


def fit(labelled: DataFrame) -> Model:
    """A model from rows (key, label, text); rows with a NULL label or text teach nothing."""
    spark = labelled.sparkSession
    rows = labelled.where("label IS NOT NULL AND text IS NOT NULL AND key IS NOT NULL").withColumn("h", F.xxhash64("key"))
    # The least hashes of each language: every task keeps its own least ones before the shuffle. A key counts once.
    place = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    least = rows.select("label", "h").distinct().withColumn("place", place).where(F.col("place") <= FIT_ROWS)
    cuts = least.groupBy("label").agg(F.max("h").alias("last"), F.max(F.when(F.col("place") <= LANDMARKS, F.col("h"))).alias("landmark")).collect()
    if not cuts:
        return Model(None, np.zeros((0, 0)), [])
    table = spark.createDataFrame([(c["label"], c["last"], c["landmark"]) for c in cuts], "label string, last long, landmark long")
    chosen = rows.join(F.broadcast(table), "label").where("h <= last")
    # Of rows that repeat a key one is read, the one with the least hash of the text.
    one = chosen.groupBy("label", "h", "landmark").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = one.select("label", F.lower("text").alias("text"), (F.col("h") <= F.col("landmark")).alias("is_landmark"), "h")
    texts = sample.where("is_landmark").orderBy("label", "h", "text").collect()
    landmarks = make_landmarks([r["text"].encode() for r in texts])
    languages = sorted(c["label"] for c in cuts)
    sums = sample.select("label", "text").mapInArrow(
        _gram(spark.sparkContext.broadcast(landmarks), languages), "left binary, right binary"
    ).collect()
    d = landmarks.mapping.shape[1] + 1
    left = sum(np.frombuffer(s["left"]).reshape(d, d) for s in sums)
    right = sum(np.frombuffer(s["right"]).reshape(d, len(languages)) for s in sums)
    return Model(landmarks, np.linalg.solve(left + RIDGE * np.eye(d), right).astype(np.float32), languages)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lettered = np.array(batch.column("letters").to_pylist(), dtype=bool)
            lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model.languages:
                margin = _with_constant(features(model.landmarks, *tokens.text_bytes(batch.column("lower")))) @ model.weights
                best = margin.argmax(axis=1)
                score = np.clip((margin[np.arange(len(best)), best] + 1) / 2, 0.0, 1.0).astype(np.float64)
                lang = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            score = np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["row", "lang", "score"],
            )

    return run


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row, lang, score`` for every row of ``docs``: the whole row, the language with the largest regression value,
    and that value brought from [-1, 1] to [0, 1].

    NULL text and text without a letter get ``und`` and 0, as does everything if nothing was learned. Equal texts
    get equal answers. The row is a struct, so its columns may have any names.
    """
    prepared = bounded(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.lower(F.col(text)).alias("lower"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    schema = T.StructType([prepared.schema["row"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return prepared.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, learned from the rows that are not held out.

    A row without an id is not held out and teaches nothing.
    """
    rest = fold(F.col("doc_id"), 3)
    model = fit(docs.where(rest != 1).select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(rest == 1, F.lit(False)).alias("held_out"))
    return identify(read, model).select("row.doc_id", "row.held_out", F.col("lang").alias("lang_pred"), "score")
