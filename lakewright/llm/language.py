"""Language identification by the nearest of several centroids per language.

A text is a vector of letter trigrams: bytes of the lower-cased text, everything but letters
replaced by spaces, hashed into ``DIMENSIONS`` places, weighted by TF-IDF and normalised. Each
language has several centroids from spherical k-means. A text gets the language of the centroid
with the highest cosine and is rejected where that cosine is below what texts of that language
reach.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import filtered, is_held_out, mapped, picked, table

UNDECIDED = "und"

DIMENSIONS = 8192

#: About this many texts of each language are gathered to fit centroids. Document frequencies come
#: from all learning rows.
FIT_TEXTS = 400
CENTROIDS = 4

#: Of the gathered texts of a language one in so many is kept from the centroids and sets the floor.
CALIBRATION = 4

#: A text is rejected below this share of the lowest cosine among the calibration texts of its language.
REJECTION_SHARE = 0.5

_SPACES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigram_places(text: str) -> np.ndarray:
    """The place of every trigram of the text; trigrams of nothing but spaces are left out."""
    words = text.lower().encode("utf-8", "replace").translate(_SPACES).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if not words:
        return np.zeros(0, np.uint32)
    mixed = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    return (mixed ^ (mixed >> np.uint32(15))) & np.uint32(DIMENSIONS - 1)


def trigram_counts(text: str) -> np.ndarray:
    return np.bincount(trigram_places(text), minlength=DIMENSIONS)


@dataclass
class LanguageModel:
    weights: np.ndarray  # inverse document frequency of each place
    centroids: np.ndarray  # one row each, of length 1
    languages: list[str]  # of each centroid
    floors: np.ndarray  # of each centroid: the cosine below which a text is rejected

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine and whether the text is rejected. Ties go to the first language."""
        out = []
        for text in texts:
            if not text or not any(map(str.isalpha, text)) or not self.languages:
                out.append((UNDECIDED, 0.0, True))
                continue
            vector = trigram_counts(text) * self.weights
            length = np.sqrt(vector @ vector)
            cosines = self.centroids @ (vector / length if length else vector)
            best = int(np.argmax(cosines))
            score = float(min(1.0, max(0.0, cosines[best])))
            out.append((self.languages[best], score, bool(score < self.floors[best])))
        return out


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts at the vector nearest the mean, then at the farthest ones."""
    mean = vectors.mean(axis=0)
    starts = [int(np.argmax(vectors @ mean))]
    while len(starts) < min(k, len(vectors)):
        nearest = (vectors @ vectors[starts].T).max(axis=1)
        nearest[starts] = 2.0
        starts.append(int(np.argmin(nearest)))
    centres = vectors[starts]
    for _ in range(20):
        mine = (vectors @ centres.T).argmax(axis=1)
        moved = np.array([vectors[mine == j].mean(axis=0) if (mine == j).any() else centres[j] for j in range(len(centres))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def fit_languages(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    fit_texts: int = FIT_TEXTS,
    centroids: int = CENTROIDS,
    rejection_share: float = REJECTION_SHARE,
) -> LanguageModel:
    """Learns from all rows given that have a text with a letter and a language.

    Document frequencies cover all of them. Centroids are fitted on the rows with the lowest hashes
    of their ids, about ``fit_texts`` a language: the driver holds that many vectors. One in
    ``CALIBRATION`` of them takes no part in the centroids: how near unseen texts of the language come to
    them sets the floor for rejection. Without any learning row the model decides nothing.
    """
    spark = df.sparkSession
    rows = picked(df, doc_id=id_column, text=text_column, lang=language_column).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )

    def seen(columns: list[list]) -> list[tuple[int, int]]:
        present = np.zeros(DIMENSIONS, np.int64)
        for text in columns[0]:
            present[np.unique(trigram_places(text))] += 1
        return [*((int(p), int(present[p])) for p in np.flatnonzero(present)), (-1, len(columns[0]))]

    found = mapped(rows.select("text"), seen, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    total = next((r["n"] for r in found if r["place"] < 0), 0)
    frequency = np.zeros(DIMENSIONS)
    for r in found:
        if r["place"] >= 0:
            frequency[r["place"]] = r["n"]
    weights = np.log((1 + total) / (1 + frequency)) + 1

    per_language = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for name, n in per_language.items():
        chosen |= (F.col("lang") == name) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, fit_texts / n))))

    def vector(columns: list[list]) -> list[tuple[str, list[int], list[int]]]:
        out = []
        for name, text in zip(*columns):
            places, counts = np.unique(trigram_places(text), return_counts=True)
            out.append((name, places.tolist(), counts.tolist()))
        return out

    gathered: dict[str, list[np.ndarray]] = {}
    sample = mapped(rows.filter(chosen).select("lang", "text"), vector, "lang string, places array<int>, counts array<int>")
    for r in sample.collect():
        v = np.zeros(DIMENSIONS, np.float32)
        v[r["places"]] = r["counts"]
        v *= weights
        gathered.setdefault(r["lang"], []).append(v / max(float(np.linalg.norm(v)), 1e-12))
    names, rows_, floors = [], [], []
    for name in sorted(gathered):
        vectors = np.array(gathered[name])
        unseen = np.arange(len(vectors)) % CALIBRATION == CALIBRATION - 1
        centres = _clusters(vectors[~unseen], centroids)
        judged = vectors[unseen] if unseen.any() else vectors
        floor = rejection_share * float((judged @ centres.T).max(axis=1).min())
        names += [name] * len(centres)
        rows_.append(centres)
        floors += [floor] * len(centres)
    stacked = np.concatenate(rows_) if rows_ else np.zeros((0, DIMENSIONS))
    return LanguageModel(weights, stacked, names, np.array(floors))


def identified(df: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every row, whole texts.

    A text that is null or has no letter is ``und``, with score 0, and rejected. A rejected text
    with letters keeps its nearest language in ``lang_pred``. Rows with the same id stay separate.
    The model (some 100 kB a language) goes to the executors with the task.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = picked(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return mapped(
        rows,
        lambda columns: [(i, *p) for i, p in zip(columns[0], shared.value.predict(columns[1]))],
        f"doc_id {kind}, lang_pred string, score double, rejected boolean",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_languages(documents.filter(~is_held_out(F.col("doc_id"))))
    found = identified(documents, model)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those that the classifier rejects go."""
    model = fit_languages(docs.filter(~is_held_out(F.col("doc_id"))))
    return with_language(docs, model)


def with_language(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, text_column, lambda texts: [not rejected for _, _, rejected in shared.value.predict(texts)])


QUERIES = {"op3_language_id": (op3_language_id, None)}
