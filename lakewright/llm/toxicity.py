"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on words of ordinary texts, and one that adds words of
toxic texts. A text is cut into windows of one word with its white space; a window's gain is what
the toxic dictionary saves of its compressed length. The numbers of windows that reach each of a
few calibrated gains, their shares and the largest gain give the score by logistic regression.

A dictionary match costs about three bytes whatever its length, which hides short words. So every
byte is written as three before compression, the last two being fixed substitutions of the first:
what no dictionary holds weighs three times as much, and a text still never matches itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import is_held_out, mapped, picked, table

THRESHOLD = 0.3

#: The fit uses about so many toxic and ordinary documents, by the hash of their ids.
FIT_TOXIC = 600
FIT_ORDINARY = 2400

DICTIONARY_BYTES = 16_384

#: Bytes saved, from which a window counts; the regression weighs them.
GAINS = (1, 3, 5, 7, 9)

#: A window that has no run of so many bytes in common with the toxic words is not compressed:
#: they cannot shorten it.
LEAST_COMMON = 5

#: Windows whose gain a worker remembers before it starts anew.
REMEMBERED = 400_000

_SECOND = bytes((i * 7 + 13) % 256 for i in range(256))
_THIRD = bytes((i * 11 + 101) % 256 for i in range(256))


def _tripled(text: bytes) -> bytes:
    out = np.empty(3 * len(text), np.uint8)
    for at, table_ in enumerate((None, _SECOND, _THIRD)):
        out[at::3] = np.frombuffer(text.translate(table_), np.uint8)
    return out.tobytes()


def _runs(window: bytes) -> Iterator[bytes]:
    return (window[i:i + LEAST_COMMON] for i in range(len(window) - LEAST_COMMON + 1))


def windows_of(text: str | None) -> list[bytes]:
    return [b" " + w + b" " for w in text.lower().encode("utf-8", "replace").split()] if text else []


@dataclass
class ToxicityModel:
    ordinary: bytes  # dictionaries; empty where there was too little to learn from
    toxic_words: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        self._gains: dict[bytes, int] = {}
        self._tools = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_gains": {}, "_tools": None}

    def _compressor(self, dictionary: bytes):
        import zstandard as z

        params = z.ZstdCompressionParameters.from_level(
            16, source_size=128, dict_size=len(dictionary), min_match=6, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        return z.ZstdCompressor(compression_params=params, dict_data=z.ZstdCompressionDict(dictionary))

    def learn(self, windows: Iterable[bytes]) -> None:
        """Compresses the windows that have no gain yet, all in one call of the library."""
        if not self.toxic_words or not self.ordinary:
            return
        if self._tools is None:
            self._tools = (
                self._compressor(self.ordinary), self._compressor(self.ordinary + _tripled(self.toxic_words)),
                set(_runs(self.toxic_words)),
            )
        one, other, common = self._tools
        wanted = set(windows)
        new = [w for w in wanted if w not in self._gains]
        if len(self._gains) + len(new) > REMEMBERED:
            self._gains.clear()
            new = list(wanted)
        open_ = [w for w in new if not common.isdisjoint(_runs(w))]
        self._gains.update(dict.fromkeys(new, 0))
        if open_:
            sources = [_tripled(w) for w in open_]
            a, b = (c.multi_compress_to_buffer(sources, threads=1) for c in (one, other))
            self._gains.update((w, len(a[i]) - len(b[i])) for i, w in enumerate(open_))

    def features(self, windows: list[bytes], counts: list[int] | None = None) -> np.ndarray:
        """Of a text whose windows have been learned; without dictionaries no window gains."""
        g = np.array(list(map(self._gains.__getitem__, windows)) if self._gains else [0] * len(windows))
        g = g if len(g) else np.zeros(1, int)  # a text without words counts as one window without gain
        n = np.array(counts or [1] * len(g))
        reached = np.array([n[g >= least].sum() for least in GAINS])
        total = n.sum()
        return np.array([*np.log1p(reached), *np.clip(20 * reached / total, 0, 3), np.log1p(total), g.max(), 5 * (g * n).sum() / total])

    def score(self, windows: list[bytes], counts: list[int] | None = None) -> float:
        x = np.append((self.features(windows, counts) - self.centre) / self.scale, 1.0)
        return float(1 / (1 + math.exp(-float(np.clip(x @ self.weights, -30, 30)))))


_N_FEATURES = 2 * len(GAINS) + 3


def _without_copies(texts: list[list[bytes]]) -> list[set[bytes]]:
    """Sets of windows, without those that share more than half of a set kept before."""
    kept: list[set[bytes]] = []
    for words in map(set, texts):
        least = min(len(words), 20)
        if not any(len(k) >= 20 <= least and 2 * len(words & k) > min(len(words), len(k)) for k in kept):
            kept.append(words)
    return kept


def toxic_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """The words whose document frequency is significantly higher in toxic texts, rarest first:
    a compressor reaches what stands at the end of its dictionary at the least cost. Copies of one
    text count once, as else all its words would stand out."""
    sets = _without_copies(toxic)
    in_toxic, in_ordinary = Counter(), Counter()
    for words in sets:
        in_toxic.update(words)
    for words in ordinary:
        in_ordinary.update(set(words))
    a, b = len(sets), len(ordinary)
    found = []
    for word, n in in_toxic.items():
        share = (n + in_ordinary[word]) / (a + b)
        if n >= max(3, a / 100) and n - a * share > 4 * math.sqrt(a * share * (1 - share)):
            found.append((n, word))
    return b" " + b" ".join(w.strip() for _, w in sorted(found)) + b" " if found else b""


def fit_toxicity(sample: list[tuple[int, list[bytes], list[int]]]) -> ToxicityModel:
    """``sample``: label, distinct windows and their counts of each text."""
    import zstandard

    toxic = [w for label, w, _ in sample if label == 1]
    ordinary = [w for label, w, _ in sample if label == 0]
    model = ToxicityModel(b"", b"", np.zeros(_N_FEATURES), np.ones(_N_FEATURES), np.zeros(_N_FEATURES + 1))
    if not toxic or not ordinary:
        model.weights[-1] = -3.0 if not toxic else 0.0
        return model
    parts = [_tripled(b"".join(w[i:i + 16])) for w in ordinary for i in range(0, len(w), 16)]
    try:
        model.ordinary = zstandard.train_dictionary(DICTIONARY_BYTES, parts[:: max(1, len(parts) // 20_000)]).as_bytes()
        model.toxic_words = toxic_words(toxic, ordinary)
    except zstandard.ZstdError:  # too little text to train on
        pass
    model.learn(w for _, words, _ in sample for w in words)
    x = np.array([model.features(w, n) for _, w, n in sample])
    y = np.array([float(label == 1) for label, _, _ in sample])
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - model.centre) / model.scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(30):  # Newton steps of a regression with a small penalty
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(len(w)), a.T @ (y - p) - 0.5 * w)
    model.weights = w
    return model


def gathered_sample(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", fit_toxic: int = FIT_TOXIC, fit_ordinary: int = FIT_ORDINARY,
) -> list[tuple[int, list[bytes], list[int]]]:
    """Distinct words of about ``fit_toxic`` and ``fit_ordinary`` labelled texts, for the driver."""
    known = picked(labels, doc_id=id_column, label=label_column).dropna().distinct()
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for label, wanted in ((1, fit_toxic), (0, fit_ordinary)):
        below = int((1 << 30) * min(1.0, wanted / n.get(label, 1)))
        chosen |= (F.col("label") == label) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(below))
    sample = F.broadcast(known.filter(chosen))  # some thousand rows
    rows = picked(documents, doc_id=id_column, text=text_column).join(sample, "doc_id").select("doc_id", "label", "text")

    def words(columns: list[list]) -> Iterator[tuple]:
        for i, label, text in zip(*columns):
            found = Counter(windows_of(text))  # in the order of the text
            yield str(i), int(label), list(found), list(found.values())

    found = mapped(rows, words, "id string, label int, words array<binary>, counts array<int>").collect()
    return [(r["label"], [bytes(w) for w in r["words"]], r["counts"]) for r in sorted(found, key=lambda r: (r["id"], r["counts"]))]


def toxicity(df: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row, whole texts. Null and empty texts have the
    score of a text without windows; repeated rows stay separate; no rows give no rows."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = picked(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(columns: list[list]) -> list[tuple]:
        texts = [windows_of(text) for text in columns[1]]
        shared.value.learn(w for windows in texts for w in windows)
        return [(i, shared.value.score(windows)) for i, windows in zip(columns[0], texts)]

    return mapped(rows, run, f"doc_id {kind}, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(gathered_sample(documents, labels.filter(~is_held_out(F.col("doc_id")))))
    scored = toxicity(documents, model)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op4_toxicity": (op4_toxicity, None)}
