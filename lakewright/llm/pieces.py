"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into words wherever two characters meet that stand side by side in no piece: nothing
can be merged across such a place. Each distinct word is encoded once: its substrings of bounded
length are exploded and joined with the piece table, the matches are the edges of the word's lattice,
grouped by word, and a fold over its positions picks one path.

The model merges pieces by rank, so the path with the highest sum of scores is not what the library
returns. The fold, a higher-order ``aggregate``, merges by rank over the lattice instead: whatever
merging can form is one of the word's edges, so the edges with their ranks are all it needs.

Texts meet the words' pieces in packed form. The most frequent words, a bounded number, go to every
task as Arrow arrays; a text becomes their packed ids with gaps, and each occurrence of any other word a
row that is joined with the word table. Gaps are then filled, text by text, and the ids decoded again.
Packed are places in an order of the ids, the most frequent piece first, as the code points of UTF-8: what
is frequent takes a byte, and any order gives the same ids.
Inside tasks, texts are cut and words counted and looked up by Arrow, some MB of text at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import mapped, picked, release_memory, table
from lakewright.session import finer_shuffles, shuffles_removed, smaller_batches, written

SPACE = "▁"

#: Words of at most so many bytes that are sent to every task, the most frequent ones.
FREQUENT_WORDS = 500_000
FREQUENT_BYTES = 64

#: Rows of word counts that a task gathers before it merges them and passes them on.
COUNTED = 400_000

#: Bytes of text that a task cuts at a time; a longer text is cut alone.
CUT_BYTES = 1 << 18

#: Words are looked up for so many parts at once, as each lookup indexes the frequent words anew.
LOOKED_UP = 32

#: Pairs whose merging a worker remembers before it starts anew.
REMEMBERED = 50_000

#: The piece table is broadcast; more pieces than this are refused.
MOST_PIECES = 1_000_000

#: Longer words, runs of characters without any place to cut, are not exploded: their rows would
#: grow with the square of their length, and the fold's state is one bit a character. The task that
#: meets one takes it through ``Pieces.path_of``, in proportion to its length.
LONG_WORD = 60

#: Shuffled bytes of words that a task makes the lattice of: the rows of their substrings are sorted by word, some
#: 100 times the bytes.
LATTICE_BYTES = "1m"

#: Where rank, start and size begin in an edge's long; the id is below them.
RANK_BIT, START_BIT, SIZE_BIT = 36, 30, 24


@dataclass
class Pieces:
    """The pieces of a model with merges by rank and byte fallback."""

    path: str
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    longest: int
    _apart: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        sides = {ab for piece in self.scores for ab in zip(piece, piece[1:])}
        places = {c: i for i, c in enumerate(sorted({c for ab in sides for c in ab}), 1)}
        self._place = np.zeros(0x110000, np.uint16)  # of each character; 0 where it is in no pair
        for c, i in places.items():
            self._place[ord(c)] = i
        self._meet = np.zeros((len(places) + 1, len(places) + 1), bool)
        for a, b in sides:
            self._meet[places[a], places[b]] = True

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        return {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}

    @cached_property
    def all_ids(self) -> np.ndarray:
        return np.unique([*self.ids.values(), *self.byte_ids]).astype(np.int32)

    def words_of(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words of texts, which no piece spans, each one's characters, and where each text's words
        begin, with their number last. The words of a text, joined, are the text with a space in front."""
        whole = pc.if_else(pc.equal(texts, ""), "", pc.replace_substring(pc.binary_join_element_wise(SPACE, texts, ""), " ", SPACE))
        ends = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1]
        data = whole.buffers()[2].slice(ends[0], ends[-1] - ends[0]) if len(whole) and ends[-1] > ends[0] else pa.py_buffer(b"")
        code = np.frombuffer(data.to_pybytes().decode().encode("utf-32-le"), "<u4")
        at = np.zeros(len(code) + 1, np.int32)  # the byte at which each character begins
        width = np.ones(len(code), np.uint8)
        for more in (0x80, 0x800, 0x10000):
            width += code >= more
        np.cumsum(width, dtype=np.int32, out=at[1:])
        first = np.searchsorted(at, ends - ends[0])
        place = self._place[code]
        bound = np.zeros(len(code) + 1, bool)
        bound[1:-1] = ~self._meet[place[:-1], place[1:]]
        bound[first] = True
        bounds = np.flatnonzero(bound)
        words = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(at[bounds]), data)
        return words, np.diff(bounds), np.searchsorted(bounds, first)

    def edges_of(self, word: str) -> list[tuple[int, int]]:
        ends = ((i, range(i + 1, min(len(word), i + self.longest) + 1)) for i in range(len(word)))
        return [(i, j) for i, js in ends for j in js if word[i:j] in self.ids]

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best pair is merged, the leftmost of equals, till none is left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, a: str, b: str) -> bool:
        known = self._apart.get((a, b))
        if known is None:
            if len(self._apart) > REMEMBERED:
                self._apart.clear()
            known = self._apart[a, b] = self.merged(a + b) == [a, b]
        return known

    def path_of(self, word: str, edges: list[tuple[int, int]]) -> list[str]:
        """The word's pieces from its edges (start, end); a character without an edge stands alone."""
        starts: list[list[int]] = [[] for _ in range(len(word) + 1)]
        for start, end in edges:
            starts[end].append(start)
        last: list[str | None] = [None] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for start in sorted(starts[end]):
                piece = word[start:end]
                before = last[start]
                if start == 0 or before is not None and self.stay_apart(before, piece):
                    last[end] = piece
                    break
            else:
                last[end] = word[end - 1]
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def ids_of(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out += [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return out


_loaded: dict[str, Pieces] = {}


def load_pieces(path: str) -> Pieces:
    """Of a model file, once in each process."""
    if path in _loaded:
        return _loaded[path]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    ids = {model.id_to_piece(i): i for i in plain}
    if len(ids) > MOST_PIECES or max(ids.values()) >> SIZE_BIT:
        raise ValueError(f"more than {MOST_PIECES} pieces")
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    scores = {p: model.get_score(i) for p, i in ids.items()}
    found = Pieces(path, ids, scores, byte_ids, max(map(len, ids)))
    unreachable = {p for p in ids if len(p) > 1 and found.merged(p) != [p]}
    found.ids = {p: i for p, i in ids.items() if p not in unreachable}
    _loaded[path] = found
    return found


def _cut(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``CUT_BYTES`` of text each; at least a row each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + CUT_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_counts(texts: DataFrame, path: str) -> DataFrame:
    """``word``, ``n`` of the distinct words of (text) but long ones, counted in tasks before the shuffle."""
    def run(batches):
        own, held, rows = load_pieces(path), [], 0

        def merged() -> pa.RecordBatch:
            found = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
            return pa.RecordBatch.from_arrays([found["word"].combine_chunks(), found["n_sum"].combine_chunks()], names=["word", "n"])

        for batch in batches:
            for part in _cut(batch, 0):
                words, sizes, _ = own.words_of(pc.fill_null(part.column(0), ""))
                if (sizes > LONG_WORD).any():
                    words = words.filter(pa.array(sizes <= LONG_WORD))
                word, n = words.value_counts().flatten()
                held.append(pa.table({"word": word, "n": n}))
                rows += len(word)
                if rows > COUNTED:
                    yield merged()
                    held, rows = [], 0
        if rows:
            yield merged()
        held.clear()
        release_memory()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word``, ``n`` and ``edges``, a long each, best ranks first: rank, start, size and id of a piece, from the
    high bits down. A character that is no piece has the edge -1 - start. Words have up to ``LONG_WORD`` characters.

    Words keep their partitioning: the explode and the join with the small piece table do not
    move them, so grouping the edges by word needs no further shuffle.
    """
    spark = words.sparkSession
    ranks = {p: r for r, p in enumerate(sorted(pieces.ids, key=lambda p: -pieces.scores[p]))}
    known = F.broadcast(spark.createDataFrame([(p, ranks[p], i) for p, i in pieces.ids.items()], "piece string, rank int, id int"))
    starts = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    window = F.substring(F.col("word"), F.col("start"), F.lit(pieces.longest))
    ends = starts.select("word", "n", "start", window.alias("window")).select(
        "word", "n", "start", "window", F.explode(F.sequence(F.lit(1), F.length("window"))).alias("size")
    )
    parts = ends.select("word", "n", "start", "size", F.substring(F.col("window"), F.lit(1), F.col("size")).alias("piece"))
    # A left join keeps characters, and so words, that have no edge at all.
    found = parts.join(known, "piece", "left").filter(F.col("id").isNotNull() | (F.col("size") == 1))
    start = (F.col("start") - 1).cast("long")
    edge = F.coalesce(
        F.shiftleft(F.col("rank").cast("long"), RANK_BIT) + F.shiftleft(start, START_BIT) + F.shiftleft(F.col("size").cast("long"), SIZE_BIT) + F.col("id"),
        -1 - start,
    )
    return found.groupBy("word", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def folded_ids(word: Column, edges: Column, pieces: Pieces) -> Column:
    """The ids of a word from its edges, by a fold over its positions.

    The state is the set of places between characters where pieces still meet, a bit each. A step merges
    the best-ranked edge, the leftmost of equals, that spans two neighbouring pieces; what merging can
    form is always an edge of the lattice, so a step needs no other table.
    """
    def field(e: Column, at: int, bits: int) -> Column:
        return F.shiftright(e, at).bitwiseAND((1 << bits) - 1).cast("int")

    def placed(e: Column) -> Column:
        start = F.when(e < 0, (-1 - e).cast("int")).otherwise(field(e, START_BIT, 6))
        return F.struct(
            start.alias("start"), (start + F.when(e < 0, 1).otherwise(field(e, SIZE_BIT, 6))).alias("end"), F.when(e >= 0, field(e, 0, SIZE_BIT)).alias("id"))

    masked = F.transform(F.transform(edges, placed), lambda e: F.struct(
        _bit(e["start"]).bitwiseOR(_bit(e["end"])).alias("ends"), (_bit(e["end"]) - _bit(e["start"] + 1)).alias("inner"),
        e["start"].alias("start"), e["id"].alias("id"),
    ))

    def merged_places(long_edges: Column) -> Column:
        def merged(state: Column, _: Column) -> Column:
            best = F.get(F.filter(
                long_edges, lambda e: (state.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(state.bitwiseAND(e["inner"])) == 1)
            ), F.lit(0))
            return F.coalesce(state.bitwiseAND(F.bitwise_not(best["inner"])), state)

        steps = F.when(F.length(word) > 1, F.sequence(F.lit(2), F.length(word))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, _bit(F.length(word) + 1) - 1, merged)

    def path_of(all_edges: Column) -> Column:
        places = _bound(F.filter(all_edges, lambda e: e["inner"] != 0), merged_places)
        return _bound(places, lambda state: F.filter(
            all_edges, lambda e: (state.bitwiseAND(e["ends"]) == e["ends"]) & (state.bitwiseAND(e["inner"]) == 0)))

    path = F.sort_array(F.transform(_bound(masked, path_of), lambda e: F.struct(e["start"].alias("start"), e["id"].alias("id"))))
    byte_ids = F.array(*map(F.lit, pieces.byte_ids))

    def bytes_at(start: Column) -> Column:
        digits = F.hex(F.encode(F.substring(word, start + 1, F.lit(1)), "utf-8"))
        return F.transform(F.sequence(F.lit(0), (F.length(digits) / 2 - 1).cast("int")), lambda i: F.get(
            byte_ids, F.conv(F.substring(digits, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")))

    return F.flatten(F.transform(path, lambda e: F.when(e["id"].isNull(), bytes_at(e["start"])).otherwise(F.array(e["id"]))))


def encoded_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word``, ``n``, ``ids`` of every distinct word."""
    return lattice(words, pieces).select("word", "n", folded_ids(F.col("word"), F.col("edges"), pieces).alias("ids"))


def word_table(df: DataFrame, model_path: str, text_column: str = "text") -> DataFrame:
    """``word``, ``n`` and ``ids`` of every distinct word of the texts, written once."""
    spark = df.sparkSession
    texts = picked(df, text=text_column).select(F.coalesce("text", F.lit("")).alias("text"))
    with smaller_batches(spark), finer_shuffles(spark, LATTICE_BYTES), shuffles_removed(spark):
        return written(encoded_words(word_counts(texts, model_path), load_pieces(model_path)))


def piece_order(words: DataFrame, pieces: Pieces) -> np.ndarray:
    """All ids of the model, those that stand most often in the texts first."""
    found = words.select("n", F.explode("ids").alias("id")).groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = dict.fromkeys(pieces.all_ids.tolist(), 0) | {r["id"]: r["n"] for r in found}
    return np.array(sorted(n, key=lambda i: (-n[i], i)), np.int32)


def _codes(order: np.ndarray) -> np.ndarray:
    """The code of each id: its place in ``order``, from 1; 0 is a gap, for a word whose ids come from the word table."""
    codes = np.zeros(order.max() + 1, np.uint16 if len(order) < 1 << 16 else np.uint32)
    codes[order] = np.arange(1, len(order) + 1)
    return codes


def _frequent(words: DataFrame, limit: int, codes: np.ndarray) -> tuple[int, pa.Array, np.ndarray, np.ndarray]:
    """The count from which words are sent to every task, those words, the codes of all their ids, and where
    each word's codes begin, with their number."""
    short = words.filter(F.octet_length("word") <= FREQUENT_BYTES)
    step = F.floor(F.log2("n") * 8).cast("int")
    held, least = 0, None
    for r in sorted(short.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).collect(), key=lambda r: -r["step"]):
        held += r["words"]
        if held > limit:
            break
        least = r["n"]
    if least is None:
        return 1 << 62, pa.array([], pa.string()), codes[:0], np.zeros(1, np.int32)
    found = short.filter(F.col("n") >= least).select("word", "ids").toArrow()
    begin = np.concatenate([[0], np.cumsum(pc.list_value_length(found["ids"]).to_numpy())]).astype(np.int32)
    flat = codes[pc.list_flatten(found["ids"]).to_numpy()]
    return least, pa.concat_arrays(found["word"].cast(pa.string()).chunks), flat, begin


@dataclass
class _Known:
    """The words of some texts, once each, with what a task knows of them."""

    of_text: np.ndarray  # where each text's words begin, and their number
    entry: np.ndarray  # of each word, the place in ``words``
    words: pa.Array
    found: np.ndarray  # of each entry, its place among the frequent words, or -1
    is_long: np.ndarray  # of each entry

    @property
    def is_rare(self) -> np.ndarray:
        return (self.found < 0) & ~self.is_long


def _known(own: Pieces, batch: pa.RecordBatch, text: int, frequent: pa.Array) -> Iterator[tuple[pa.RecordBatch, _Known]]:
    """A batch in parts, with their words."""
    parts = _cut(batch, text)
    while some := list(islice(parts, LOOKED_UP)):
        coded = []
        for part in some:
            words, sizes, of_text = own.words_of(part.column(text))
            code = words.dictionary_encode()
            coded.append((of_text, code.indices.to_numpy(), code.dictionary, sizes > LONG_WORD))
        found = pc.fill_null(pc.index_in(pa.chunked_array([c[2] for c in coded]), value_set=frequent), -1).to_numpy()
        at = 0
        for part, (of_text, entry, words, too_long) in zip(some, coded):
            is_long = np.zeros(len(words), bool)
            is_long[entry[too_long]] = True
            yield part, _Known(of_text, entry, words, found[at:at + len(words)], is_long)
            at += len(words)
        del coded, found
        release_memory()


def _with_gaps(own: Pieces, known: _Known, flat: np.ndarray, begin: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all words, a gap for each rare one, and where each text's codes begin, with their number."""
    long = {int(e): codes[own.ids_of(own.path_of(w, own.edges_of(w)))] for e in np.flatnonzero(known.is_long) for w in [known.words[int(e)].as_py()]}
    # The table of codes: those of the frequent words, one gap, those of the long words met here.
    table = np.concatenate([flat, np.zeros(1, codes.dtype), *long.values()])
    start, size = np.full(len(known.words), len(flat)), np.ones(len(known.words), np.int64)
    short = known.found >= 0
    start[short], size[short] = begin[known.found[short]], begin[known.found[short] + 1] - begin[known.found[short]]
    at = len(flat) + 1
    for e, own_codes in long.items():
        start[e], size[e] = at, len(own_codes)
        at += len(own_codes)
    sizes = size[known.entry]
    total = np.concatenate([[0], np.cumsum(sizes)])
    return table[np.repeat(start[known.entry] - total[:-1], sizes) + np.arange(total[-1])], total[known.of_text]


def encoded(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", frequent_words: int = FREQUENT_WORDS,
    words: DataFrame | None = None, order: np.ndarray | None = None,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``copies``, ``packed`` and ``rare``: every distinct text of an id, encoded.

    ``packed`` holds the ids of the frequent words, with a gap at each other word; ``rare`` has the places
    of the gaps with their ids. ``decoded`` puts both together; it has to get the same ``order``, the model's by
    default. ``words`` is the texts' word table where the caller has it already. ``copies`` is how many rows of the input had
    that id and text; ``text_key`` tells texts apart that share an id. Null and empty texts have no
    ids. No rows give no rows.
    """
    spark = df.sparkSession
    pieces = load_pieces(model_path)
    rows = picked(df, doc_id=id_column, text=text_column).select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    words = word_table(rows, model_path) if words is None else words
    codes = _codes(pieces.all_ids if order is None else order)
    least, *frequent = _frequent(words, frequent_words, codes)
    # Compressed, as the driver and each executor keep it on disk.
    shared = spark.sparkContext.broadcast(zstandard.compress(pickle.dumps(frequent)))

    def known_words(batches):
        own, (frequent, flat, begin) = load_pieces(model_path), pickle.loads(zstandard.decompress(shared.value))
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part, known in _known(own, batch, 2, frequent):
                found, bounds = _with_gaps(own, known, flat, begin, codes)
                text = found.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                packed = [compress(text[a:b].encode("utf-8", "surrogatepass")) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], names=["doc_id", "text_key", "packed"])

    def other_words(batches):
        own, (frequent, _, _) = load_pieces(model_path), pickle.loads(zstandard.decompress(shared.value))
        for batch in batches:
            for part, known in _known(own, batch, 2, frequent):
                rare = np.flatnonzero(known.is_rare[known.entry])
                bounds = np.searchsorted(rare, known.of_text)
                text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)),
                    pa.array((np.arange(len(rare)) - bounds[text]).astype(np.int32)), known.words.take(pa.array(known.entry[rare])),
                ], names=["doc_id", "text_key", "at", "word"])

    # Wrapped, a null id equals itself in a plain join, which keeps the partitioning of both sides.
    key = [F.struct("doc_id").alias("of"), "text_key"]
    texts = rows.mapInArrow(known_words, f"doc_id {kind}, text_key long, packed binary").groupBy(*key).agg(
        F.first("packed").alias("packed"), F.count("*").alias("copies")
    )
    others = rows.mapInArrow(other_words, f"doc_id {kind}, text_key long, at int, word string")
    rare = words.filter((F.col("n") < least) | (F.octet_length("word") > FREQUENT_BYTES)).select("word", "ids")
    # Rows that share id and text have the same gaps: once each. Their words lie apart, so grouping before the
    # shuffle would only make the rows wider.
    placed = others.join(rare, "word").select(*key, "at", "ids").repartition("of", "text_key")
    gaps = placed.groupBy("of", "text_key").agg(F.collect_set(F.struct("at", "ids")).alias("rare"))
    return texts.join(gaps, ["of", "text_key"], "left").select("of.doc_id", "text_key", "copies", "packed", "rare")


def _filled(packed: bytes, rare: list | None, order: np.ndarray) -> np.ndarray:
    """All ids of a text, in order."""
    text = zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<i4")
    whole = order[codes - 1]
    if not rare:
        return whole
    places = np.flatnonzero(codes == 0)
    found = sorted((r["at"], r["ids"]) for r in rare)
    parts, start = [], 0
    for place, (_, own) in zip(places.tolist(), found, strict=True):
        parts += [whole[start:place], np.array(own, "<i4")]
        start = place + 1
    return np.concatenate([*parts, whole[start:]])


def decoded(texts: DataFrame, model_path: str, order: np.ndarray | None = None) -> DataFrame:
    """``doc_id``, ``text_key``, ``copies``, all ``ids`` of each text and ``text``, decoded from them. Bytes
    that are no UTF-8 become U+FFFD; the space in front that encoding adds is taken off again."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(columns: list[list]) -> Iterator[tuple]:
        own = load_pieces(model_path)
        packed_in = own.all_ids if order is None else order
        for i, key, copies, packed, rare in zip(*columns):
            ids = _filled(packed, rare, packed_in)
            text = b"".join(map(own.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")
            yield i, key, copies, ids, text

    return mapped(texts, run, f"doc_id {kind}, text_key long, copies long, ids array<int>, text string")


def round_trips(df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``text_key``, ``copy`` (which numbers rows that share
    both), ``ids`` of the whole text, ``n_pieces``, the ``text`` decoded from them and ``same_text``, whether
    that is the text that was encoded, by its hash."""
    words = word_table(df, model_path, text_column)
    order = piece_order(words, load_pieces(model_path))
    found = decoded(encoded(df, model_path, id_column, text_column, words=words, order=order, **options), model_path, order)
    return found.select(
        "doc_id", "text_key", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"), "ids",
        F.size("ids").cast("long").alias("n_pieces"), "text", (F.xxhash64("text") == F.col("text_key")).alias("same_text"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a document: its pieces and the text decoded from them."""
    import public_tokenizers

    return round_trips(docs, public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op6_sentencepiece": (op6_sentencepiece, None)}
