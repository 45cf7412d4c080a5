"""Secrets in texts: fixed patterns, and strings that resist compression.

A candidate is a run of token characters near a word like *key* or *password*. Its novelty is what
it adds to the compressed size of its surroundings: the size of surroundings plus candidate less
the size of the surroundings, under a zstandard dictionary of the phrases that stand near such words
in all documents of the corpus. Names and words are cheap then, random strings cost about their entropy.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import mapped, picked, table

#: The patterns every report must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LENGTH = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

_CONTEXT = re.compile(r"passw|pwd|secret|token|key|credential|auth|bearer|private|akia", re.IGNORECASE | re.ASCII)
_HINTS = ("passw", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "private", "akia")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Code points before a candidate in which a sensitive word must stand, and around it that count as
#: its surroundings.
CONTEXT_BEFORE = 48
SURROUNDINGS = 160

#: Compressed bytes a code point from which a candidate counts as incompressible.
NOVELTY = 0.7

#: The dictionary holds phrases of this many words up to this size; a phrase costs about MATCH_BYTES
#: where it is found in the dictionary.
PHRASE_WORDS = 3
DICTIONARY_BYTES = 16_384
MATCH_BYTES = 4
_WORD = re.compile(r"\S{1,16}")

_PLAIN_ASSIGN = ("passw", "secret", "token", "api")


def base_spans(text: str, lower: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches of each kind, short ones dropped; code points, end exclusive."""
    out = []
    if any(hint in lower for hint in _PLAIN_ASSIGN):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def candidates(text: str, lower: str) -> Iterator[tuple[int, int]]:
    """Runs of token characters, with a digit and a letter, soon after a sensitive word."""
    if not any(hint in lower for hint in _HINTS):
        return
    for m in _CANDIDATE.finditer(text):
        run = m[0]
        if not re.search("[0-9]", run) or not re.search("[A-Za-z]", run):
            continue
        if _CONTEXT.search(text, max(0, m.start() - CONTEXT_BEFORE), m.start()):
            yield m.start(), m.end()




class Novelty:
    """Marginal compressed bytes under a dictionary; an empty dictionary is none."""

    def __init__(self, dictionary: bytes):
        import zstandard

        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
        self._compressor = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)

    def _size(self, text: str) -> int:
        return len(self._compressor.compress(text.encode("utf-8", "replace")))

    def marginal_bytes(self, text: str, start: int, end: int) -> int:
        before, after = text[max(0, start - SURROUNDINGS):start], text[end:end + SURROUNDINGS]
        return self._size(before + after + text[start:end]) - self._size(before + after)


def _near_phrases(text: str) -> set[str]:
    """Runs of words in the surroundings of all sensitive words of a text, candidates left out."""
    spans: list[list[int]] = []
    for m in _CONTEXT.finditer(text):
        start, end = max(0, m.start() - SURROUNDINGS), m.end() + SURROUNDINGS
        if spans and start <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    out = set()
    for start, end in spans:
        words = _WORD.findall(_CANDIDATE.sub(" ", text[start:end]))  # what may be secret is not learned
        out.update(" ".join(words[i:i + PHRASE_WORDS]) for i in range(max(1, len(words) - PHRASE_WORDS + 1)))
    return out


def fit_dictionary(df: DataFrame, text_column: str = "text") -> bytes:
    """A zstandard dictionary of the phrases near sensitive words, counted over all documents.

    Phrases are counted once a document and ranked by the bytes they save in all documents; the first
    ones that fill the dictionary go to the driver, the best at its end. No phrase that two documents
    share: an empty dictionary.
    """
    rows = picked(df, text=text_column).filter(F.lower("text").rlike("|".join(_HINTS)))

    def phrases(columns: list[list]) -> list[tuple[str, int]]:
        return list(Counter(p for text in columns[0] for p in _near_phrases(text)).items())

    saved = F.col("n") * (F.octet_length("phrase") - MATCH_BYTES)
    best = (
        mapped(rows, phrases, "phrase string, n long").groupBy("phrase").agg(F.sum("n").alias("n"))
        .filter((F.col("n") > 1) & (F.octet_length("phrase") > MATCH_BYTES))
        .orderBy(saved.desc(), "phrase").limit(DICTIONARY_BYTES // MATCH_BYTES)
    )
    chosen, size = [], 0
    for row in best.select("phrase").collect():
        data = row[0].encode("utf-8", "replace")
        if size + len(data) < DICTIONARY_BYTES:
            chosen.append(data)
            size += len(data) + 1
    return b"\n".join(reversed(chosen))


def spans_of(text: str, novelty: Novelty, threshold: float) -> tuple[list, list]:
    """Base spans, and the further ones that novelty adds; those never overlap a base span."""
    lower = text.lower()
    base = base_spans(text, lower)
    added = []
    for start, end in candidates(text, lower):
        if any(s < end and start < e for s, e, _ in base):
            continue
        if novelty.marginal_bytes(text, start, end) >= threshold * (end - start):
            added.append((start, end, "novel"))
    return base, added


_built: dict[bytes, Novelty] = {}


def secret_spans(
    df: DataFrame, dictionary: bytes, id_column: str = "doc_id", text_column: str = "text", threshold: float = NOVELTY
) -> DataFrame:
    """``doc_id`` and ``spans``, an array of (start, end, kind), of every row, whole texts.

    A null text is empty and has no spans; an empty table gives no rows; rows with the same id stay
    separate. Kinds are assign, access, hex (fixed patterns) and novel.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(columns: list[list]) -> Iterator[tuple]:
        if dictionary not in _built:
            _built[dictionary] = Novelty(dictionary)
        for i, text in zip(*columns):
            base, added = spans_of(text or "", _built[dictionary], threshold)
            found = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            yield i, [{"start": s, "end": e, "kind": k} for s, e, k in found]

    return mapped(rows, run, f"doc_id {kind}, spans array<struct<start:int,end:int,kind:string>>")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secret_spans(documents, fit_dictionary(documents))

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    def count_of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count_of("assign"), count_of("access"), count_of("hex"),
        F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"), count_of("novel"),
    )


QUERIES = {"op9_secret_scan": (op9_secret_scan, None)}
