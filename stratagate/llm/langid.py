"""Language identification by string kernels.

Kernel: blended spectrum of presence bits. A text becomes the set of its letter
1-, 2- and 3-grams over a fixed alphabet; k(x, y) is the number of n-grams two
texts share, divided by the root of the product of their set sizes.

Nyström: a few landmark texts L of every language span the feature map
phi(x) = K(x, L) K(L, L)^(-1/2). Classifier: one-versus-rest kernel ridge
regression in that space. Scoring: a batch of texts is a presence matrix, whose
product with the landmarks' presence matrix gives all kernel values at once, and
a second product gives all class values.

Alphabet: a-z, then other letters by their code point modulo 36, so that Latin-1
letters stay apart; anything else separates words. The set of a text has at most
64 + 64**2 + 64**3 members, whatever its length, which bounds the model too.

Defined cases: NULL text and text without a letter get ``und`` and score 0; so
does every text when no labelled row can be learned from; repeated rows get equal
answers; an empty table gives no rows; other columns are never looked at.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate.llm.tables import slices

UNKNOWN = "und"
#: Bounds of the fit: labelled texts per language (about), fewer when languages are
#: many, so that all together stay near a total; landmarks, more when languages are
#: many. Every label is learned: the model grows with their number, not with rows.
SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL, LEAST_SAMPLE = 300, 19_200, 20
LANDMARKS, LANDMARKS_PER_LANGUAGE = 128, 2
RIDGE = 1e-2
ORDERS = 3
SIZE = 64 + 64**2 + 64**3
_BATCH = 64


def _alphabet() -> np.ndarray:
    """Symbol of every code point: 0 separates, 1-26 a-z, 27-62 other letters."""
    symbols = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    for code in range(sys.maxunicode + 1):
        if chr(code).isalpha():
            symbols[code] = 27 + code % 36
    for code in range(26):
        symbols[ord("a") + code] = symbols[ord("A") + code] = 1 + code
    return symbols


_SYMBOLS: list[np.ndarray] = []


def grams(text: str | None) -> np.ndarray:
    """Sorted codes of the n-grams present in a text, n from 1 to 3."""
    if not _SYMBOLS:
        _SYMBOLS.append(_alphabet())
    codes = (text or "").lower().encode("utf-32-le", "surrogatepass")
    symbols = _SYMBOLS[0][np.frombuffer(codes, "<u4")]
    if not symbols.any():
        return np.zeros(0, dtype=np.int32)
    # separators in a row count once
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    one = np.concatenate([[0], symbols[keep], [0]])
    present = np.zeros(SIZE, dtype=bool)
    present[one] = True
    two = one[:-1] * 64 + one[1:]
    present[64 + two] = True
    present[64 + 64**2 + (two[:-1] * 64 + one[2:])] = True
    return np.flatnonzero(present).astype(np.int32)


@dataclass
class Model:
    """Landmarks as presence rows over the n-grams they use, and class weights."""

    languages: list[str]
    column: np.ndarray  # n-gram -> column of ``landmarks``, -1 where unused
    landmarks: np.ndarray  # columns x landmarks, 0 or 1
    roots: np.ndarray  # root of each landmark's set size
    weights: np.ndarray  # landmarks x languages

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        presence = np.zeros((len(sets), len(self.landmarks)), dtype=np.float32)
        for row, found in enumerate(sets):
            at = self.column[found]
            presence[row, at[at >= 0]] = 1.0
        own = np.sqrt([max(len(s), 1) for s in sets]).astype(np.float32)
        return (presence @ self.landmarks) / (own[:, None] * self.roots[None, :])

    def predict(self, sets: list[np.ndarray]) -> tuple[list[str], list[float]]:
        values = self.kernel(sets) @ self.weights
        share = np.clip((values + 1) / 2, 0.0, 1.0)
        best = values.argmax(axis=1)
        top = share[np.arange(len(sets)), best]
        score = top / np.maximum(share.sum(axis=1), 1e-9)
        known = [len(s) > 0 for s in sets]
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, [float(x) if k else 0.0 for x, k in zip(score, known, strict=True)]


def train(sets: list[np.ndarray], names: list[str]) -> Model | None:
    """Fit on texts given as n-gram sets; None when there is nothing to learn from."""
    rows = [(s, n) for s, n in zip(sets, names, strict=True) if len(s)]
    if not rows:
        return None
    languages = sorted({n for _, n in rows})
    # landmarks take turns among the languages
    by_name: dict[str, list[np.ndarray]] = {name: [] for name in languages}
    for found, name in rows:
        by_name[name].append(found)
    queues = list(by_name.values())
    chosen, turn = [], 0
    wanted = max(LANDMARKS, LANDMARKS_PER_LANGUAGE * len(languages))
    while len(chosen) < min(wanted, len(rows)):
        for queue in queues:
            if turn < len(queue) and len(chosen) < wanted:
                chosen.append(queue[turn])
        turn += 1
    used = np.unique(np.concatenate(chosen))
    column = np.full(SIZE, -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    landmarks = np.zeros((len(used), len(chosen)), dtype=np.float32)
    for j, found in enumerate(chosen):
        landmarks[column[found], j] = 1.0
    roots = np.sqrt([len(s) for s in chosen]).astype(np.float32)
    model = Model(languages, column, landmarks, roots, np.zeros(0))
    among = model.kernel(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    kept = values > 1e-8 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    at = range(0, len(rows), _BATCH)
    gram = np.concatenate([model.kernel([s for s, _ in rows[i : i + _BATCH]]) for i in at])
    phi = gram.astype(np.float64) @ whiten
    target = np.array([[1.0 if n == name else -1.0 for name in languages] for _, n in rows])
    # every language weighs the same
    weight = np.array([1.0 / len(by_name[n]) for _, n in rows]) * len(rows) / len(languages)
    left = phi.T @ (phi * weight[:, None]) + RIDGE * len(rows) * np.eye(phi.shape[1]) / phi.shape[1]
    ridge = np.linalg.solve(left, phi.T @ (target * weight[:, None]))
    model.weights = (whiten @ ridge).astype(np.float32)
    return model


def held_out() -> Column:
    """Rows nothing is learned from: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> Model | None:
    """Model from a bounded sample of labelled rows, spread by a hash of the id."""
    learn = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per class of the model
    counted = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    most = min(SAMPLE_PER_LANGUAGE, max(LEAST_SAMPLE, SAMPLE_TOTAL // max(1, len(counted))))
    at = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 30))
    cut = {n: (1 << 30) * min(1.0, most / count) for n, count in counted.items()}
    below = F.from_json(F.lit(json.dumps({n: int(x) for n, x in cut.items()})), "map<string,bigint>")
    wanted = F.coalesce(at < F.element_at(below, F.col("lang")), F.lit(False))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = [grams(t).tobytes() for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(found, pa.binary())], ["lang", "grams"]
            )

    sample = learn.where(wanted).select("lang", "text").mapInArrow(extract, "lang string, grams binary")
    rows = sorted((r["lang"], bytes(r["grams"])) for r in sample.toLocalIterator())
    return train([np.frombuffer(g, np.int32) for _, g in rows], [name for name, _ in rows])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, _BATCH):
            texts = rows.column(2).to_pylist()
            if model is None:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            else:
                names, scores = model.predict([grams(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def languages(docs: DataFrame) -> DataFrame:
    """Fit on ``docs`` and identify every row of it."""
    return identify(docs, fit(docs))


def accepted(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """``docs`` without texts of no language: no letter, or a lower score.

    By default every text with a letter stays: one-word texts score near chance,
    and are no less clean for it.
    """
    model = fit(docs)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, _BATCH):
            sets = [grams(t) for t in rows.column(at).to_pylist()]
            names, scores = model.predict(sets)
            fine = [n != UNKNOWN and x >= least_score for n, x in zip(names, scores, strict=True)]
            yield rows.filter(pa.array(fine, pa.bool_()))

    # without labels nothing is known about any language, and nothing is rejected
    return docs if model is None else docs.mapInArrow(keep, docs.schema)
