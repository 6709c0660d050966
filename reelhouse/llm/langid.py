"""Language ID by string-kernel classification (operator 8).

Kernel: blended-spectrum presence kernel.  A text is the set of its 1- to
3-grams over case-folded code points (runs of non-letters count as one blank),
hashed to ``DIM`` features; k(x, y) = |x & y| / sqrt(|x| |y|).  Nystroem: up to
``landmarks`` training texts span the feature space, so the one-versus-rest
kernel ridge regression solves a system of that size.  Scoring multiplies
batches of presence rows by the landmark matrix times the dual weights.

The classifier is fitted on a documented bounded sample: for each label the
``per_label`` training texts with the smallest xxhash64 of the id.  Each sampled
text reaches the driver as a bitmap of DIM / 8 bytes.  Prediction covers every
row and whole texts.

Edge cases: null texts and texts without a letter get ``und`` with score 0;
rows with null labels never train; without any training row every text is
``und``.  Ties go to the label that sorts first.  Repeated rows give equal rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from reelhouse.llm.util import add_columns

DIM = 1 << 16
PER_LABEL = 300
LANDMARKS = 384
RIDGE = 1e-3
UND = "und"
BLOCK = 128  # texts of one matrix product


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Folded code point of every letter, 0 for anything else."""
    fold = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            fold[c] = ord(low[0])
    return fold


def features(text: str | None) -> np.ndarray | None:
    """Hashed 1- to 3-grams of a text (with repeats), or None without a letter."""
    if not text:
        return None
    c = letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not c.any():
        return None
    blank = c == 0
    c = c[~(blank & np.concatenate(([True], blank[:-1])))]  # runs of others: one blank; none at the start
    c = np.concatenate((np.zeros(1, np.uint32), c, np.zeros(1, np.uint32)))
    one = c * np.uint32(0x9E3779B1)
    two = one[1:] + c[:-1] * np.uint32(0x85EBCA77) + np.uint32(1)
    three = two[1:] + c[:-2] * np.uint32(0xC2B2AE3D) + np.uint32(7)
    grams = np.concatenate((one, two, three))
    grams ^= grams >> np.uint32(15)
    grams *= np.uint32(0x2C1B3C6D)
    return (grams >> np.uint32(16)).astype(np.int64)  # 16 bits: DIM


@dataclass
class Classifier:
    labels: list[str]
    columns: np.ndarray  # feature -> column of the presence rows (the last one is unused)
    weights: np.ndarray  # columns x labels: landmark rows times dual weights

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Decision values of a block of texts, one batched matrix product."""
        width = len(self.weights)
        present = np.zeros((len(rows), width + 1), np.float32)
        for i, grams in enumerate(rows):
            present[i, self.columns[grams]] = 1
        present = present[:, :width]
        norm = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return (present @ self.weights) / norm

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [UND] * len(texts), [0.0] * len(texts)
        if not self.labels:
            return labels, scores
        for at in range(0, len(texts), BLOCK):
            found = [(i, g) for i, t in enumerate(texts[at:at + BLOCK], at) if (g := features(t)) is not None]
            if not found:
                continue
            f = self.scores([g for _, g in found]).astype(np.float64)
            e = np.exp(4 * (f - f.max(axis=1, keepdims=True)))
            e /= e.sum(axis=1, keepdims=True)
            for (i, _), best, p in zip(found, f.argmax(axis=1), e):
                labels[i], scores[i] = self.labels[best], float(min(1.0, p[best]))
        return labels, scores


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang and presence bitmap of every sampled text with a letter."""
    for b in batches:
        langs, bits = [], []
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            grams = features(text)
            if grams is not None:
                row = np.zeros(DIM, bool)
                row[grams] = True
                langs.append(lang), bits.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bits, pa.binary())], names=["lang", "bits"])


def fit(train: DataFrame, per_label: int = PER_LABEL, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Classifier:
    """Kernel ridge regression on the sampled rows of ``train`` (doc_id, text, lang)."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (train.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
           .select("doc_id", "lang", "text")
           .withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= per_label))
    rows = ids.select("lang", "text").mapInArrow(bitmaps, "lang string, bits binary").collect()
    if not rows:
        return Classifier([], np.zeros(DIM, np.int64), np.zeros((0, 0), np.float32))
    rows.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    labels = sorted({r["lang"] for r in rows})
    used = np.zeros(DIM // 8, np.uint8)
    packed = [np.frombuffer(r["bits"], np.uint8) for r in rows]
    for p in packed:
        used |= p
    used = np.flatnonzero(np.unpackbits(used))
    x = np.zeros((len(rows), len(used)), np.float32)
    for i, p in enumerate(packed):
        x[i] = np.unpackbits(p)[used]
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    pick = np.unique(np.linspace(0, len(rows) - 1, min(landmarks, len(rows))).astype(int))  # all labels in turn
    marks = x[pick]
    k_nm = (x @ marks.T).astype(np.float64)
    k_mm = (marks @ marks.T).astype(np.float64)
    y = np.array([[1.0 if r["lang"] == c else -1.0 for c in labels] for r in rows])
    a = k_nm.T @ k_nm + ridge * len(rows) * (k_mm + 1e-6 * np.eye(len(pick)))
    dual = np.linalg.solve(a, k_nm.T @ y)
    columns = np.full(DIM, len(used), np.int64)
    columns[used] = np.arange(len(used))
    return Classifier(labels, columns, (marks.T @ dual).astype(np.float32))


def classify(docs: DataFrame, model: Classifier, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted label and its score (0 to 1) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most DIM x labels weights

    def run(b: pa.RecordBatch) -> list:
        labels, scores = sent.value.predict(b.column(b.schema.get_field_index("text")).to_pylist())
        return [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, run, [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])


def language_id(docs: DataFrame, held_out: Column, **fitting) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the other rows only."""
    model = fit(docs.filter(~held_out), **fitting)
    return classify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
