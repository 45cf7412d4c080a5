"""Quality rules: counts of words, symbols and repetition, and a conditional random field over lines.

A linear-chain CRF with two states marks each line as content or boilerplate; Viterbi decoding
gives the likeliest sequence, and the share of words in content lines decides about the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import mapped, picked, table

#: Fixed values of the base rules.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_WHITE = " \t\n\x0b\f\r"

#: A text is kept when at least this share of its words is in content lines.
CONTENT_SHARE = 0.5

#: The CRF is fitted on about this many labelled documents.
FIT_DOCUMENTS = 1200
FIT_STEPS = 200

FEATURES = (
    "always", "one_word", "few_words", "some_words", "long", "ends_sentence", "some_symbols", "many_symbols",
    "bars", "upper_case", "digits", "repeats_words", "mostly_one_word", "seen_before", "exclaims", "no_word",
)

CONTENT, BOILERPLATE = 0, 1


def line_features(line: str, seen: set[str]) -> int:
    """The features of a line as bits; ``seen`` holds the lines before it."""
    words = line.split()
    n = len(words)
    bits = 1
    if n == 0:
        return bits | 1 << 15
    size = len(line)
    bits |= 1 << (1 if n == 1 else 2 if n < 4 else 3 if n < 12 else 4)
    if line.rstrip()[-1:] in ".?!:;\"'":
        bits |= 1 << 5
    symbols = len(_SYMBOLS.findall(line))
    if symbols * 50 > size:
        bits |= 1 << 6
    if symbols * 10 > size:
        bits |= 1 << 7
    if line.count("|") * 3 > n:
        bits |= 1 << 8
    if n > 2 and line.isupper():
        bits |= 1 << 9
    if sum(map(line.count, "0123456789")) * 4 > size:
        bits |= 1 << 10
    distinct = len(set(words))
    if distinct * 2 < n:
        bits |= 1 << 11
    if distinct * 8 < n:
        bits |= 1 << 12
    if line in seen:
        bits |= 1 << 13
    if line.count("!") * 3 > n:
        bits |= 1 << 14
    return bits


def features_of(text: str) -> tuple[list[int], list[int]]:
    """Feature bits and number of words of every line."""
    seen: set[str] = set()
    bits, words = [], []
    for line in text.split("\n"):
        bits.append(line_features(line, seen))
        words.append(len(line.encode("utf-8", "replace").split()))
        seen.add(line)
    return bits, words


def _matrix(bits: np.ndarray) -> np.ndarray:
    return ((bits[..., None] >> np.arange(len(FEATURES))) & 1).astype(float)


@dataclass
class LineModel:
    """Weights of the boilerplate state against the content state, and of the moves between states."""

    weights: np.ndarray  # one for each feature
    moves: np.ndarray  # 2 x 2, from state to state

    def decode(self, bits: list[int]) -> list[int]:
        """The likeliest states of a text's lines by Viterbi; ties go to content."""
        if not bits:
            return []
        scores = (_matrix(np.array(bits)) @ self.weights).tolist()
        (cc, cb), (bc, bb) = self.moves.tolist()
        content, boiler = 0.0, scores[0]
        back = []
        for s in scores[1:]:
            to_content, to_boiler = (content + cc, boiler + bc), (content + cb, boiler + bb)
            back.append((to_content[1] > to_content[0], to_boiler[1] > to_boiler[0]))
            content, boiler = max(to_content), max(to_boiler) + s
        state = BOILERPLATE if boiler > content else CONTENT
        states = [state]
        for step in reversed(back):
            state = int(step[state])
            states.append(state)
        return states[::-1]


def fit_lines(sequences: list[tuple[list[int], int]], steps: int = FIT_STEPS) -> LineModel:
    """Maximum likelihood by gradient ascent. ``sequences``: feature bits of a text's lines and the
    state that all of them are taken to be in, from the label of the text."""
    weights, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    if not sequences:
        return LineModel(weights, moves)
    longest = max(len(b) for b, _ in sequences)
    bits = np.zeros((len(sequences), longest), np.int64)
    mask = np.zeros((len(sequences), longest))
    for i, (b, _) in enumerate(sequences):
        bits[i, :len(b)] = b
        mask[i, :len(b)] = 1
    state = np.array([s for _, s in sequences])
    x = _matrix(bits) * mask[..., None]
    # Texts count alike however many lines they have.
    share = 1 / mask.sum(axis=1)
    wanted = np.einsum("nlf,n,n->f", x, share, state == BOILERPLATE) / len(sequences)
    wanted_moves = np.diag([((mask.sum(1) - 1) * share)[state == s].sum() for s in (CONTENT, BOILERPLATE)]) / len(sequences)
    for _ in range(steps):
        score = np.stack([np.zeros(mask.shape), x @ weights], axis=-1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None] > 0, new, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None])[..., BOILERPLATE] * mask
        pair = np.exp(
            forward[:, :-1, :, None] + moves + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * mask[:, 1:, None, None]
        got = np.einsum("nlf,n,nl->f", x, share, marginal) / len(sequences)
        got_moves = np.einsum("n,nlab->ab", share, pair) / len(sequences)
        weights += 2.0 * (wanted - got) - 0.002 * weights
        moves += 2.0 * (wanted_moves - got_moves) - 0.002 * moves
    return LineModel(weights, moves)


def fit_quality(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", fit_documents: int = FIT_DOCUMENTS,
) -> LineModel:
    """A model fitted on documents with a label (1 good, 0 not), about ``fit_documents`` of them by
    the hash of their ids, as many of either label where there are. The driver gets their feature
    bits. Lines of good documents count as content, those of others as boilerplate."""
    known = picked(labels, doc_id=id_column, label=label_column).dropna().distinct()
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for label, count in n.items():
        below = int((1 << 30) * min(1.0, fit_documents / 2 / count))
        chosen |= (F.col("label") == label) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(below))
    sample = F.broadcast(known.filter(chosen))  # some fit_documents rows
    rows = picked(documents, doc_id=id_column, text=text_column).join(sample, "doc_id").select("doc_id", "label", "text")
    found = mapped(
        rows.select("label", "text"),
        lambda columns: [(int(label == 0), features_of(text)[0]) for label, text in zip(*columns) if text],
        "state int, bits array<int>",
    ).collect()
    return fit_lines(sorted(((r["bits"], r["state"]) for r in found), key=repr))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more, first occurrences included.
    Windows are compared by 64-bit hashes of their words."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    w = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = w[:n].copy()
    for j in range(1, WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:j + n]
    _, place, count = np.unique(h, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[WINDOW:WINDOW + n] -= twice
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "replace").split()
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(_WHITE):
            duplicates += line in seen
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, _WHITE)), len(_SYMBOLS.findall(text)), duplicates, repeated_words(words),
    )


def quality(df: DataFrame, model: LineModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``content_share`` and ``kept`` of every row, whole texts.

    Null texts count as empty: no words, base failed, content share 0. Repeated rows stay separate;
    an empty table gives no rows. The model of some twenty numbers goes out with the task.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(columns: list[list]) -> Iterator[tuple]:
        for i, text in zip(*columns):
            text = text or ""
            counts = base_counts(text)
            failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
            bits, words = features_of(text)
            content = sum(n for n, state in zip(words, model.decode(bits)) if state == CONTENT)
            share = content / counts[0] if counts[0] else 0.0
            yield i, *counts, failed, share, not failed and share >= CONTENT_SHARE

    return mapped(
        rows, run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean",
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality(documents, fit_quality(documents, table(spark, sf_dir, "labels")))


QUERIES = {"op7_quality_rules": (op7_quality_rules, None)}
