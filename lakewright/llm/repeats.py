"""Removal of long repeated strings by longest previous factors.

A byte goes when a string of ``LEAST`` bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Whether a string starts earlier is read from a longest-previous-
factor array: the strings that start at every place are put in suffix order; the next places before and
after it in that order that lie earlier in the corpus hold the longest earlier matches.

One suffix array over a corpus would be a sort of all its suffixes. Only strings of ``LEAST`` bytes count, so
suffixes are dealt to buckets first and each task builds arrays of whole buckets:

1. Equal texts are one node, known by the row with the smallest id. All other copies go entirely.
2. Every string of ``LEAST`` bytes belongs to the least hash among its ``GRAM``-byte grams. Equal strings have
   the same one, and neighbouring strings mostly share theirs, so a text is a row of short runs of strings.
3. Runs whose gram stands in one place of the corpus repeat nothing, and of runs with the same bytes (by
   digest) all but the first are copies: found inside each task first, then over the corpus, so that a
   frequent run is one short row a task. Where different runs share a gram they carry their bytes to its
   bucket. Of a gram with ``HOT`` places or more the strings go one by one, each to a bucket of its own, so no
   bucket holds more than ``HOT`` runs or the copies of one string that different tasks found first.
4. The buckets' arrays give the places with an earlier match; what they cover is cut from the texts.

* Null texts count as empty. Texts under ``LEAST`` bytes stay whole. Null ids come after all others; of equal
  ids the text with the smaller SHA-256 comes first; of identical rows one stays.
* Texts are cut between bytes, so what is kept is binary. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.llm.common import picked, table
from lakewright.llm.shingles import mixed
from lakewright.session import written

LEAST = 100
GRAM = 32

#: Places of one gram from which its strings are dealt one by one.
HOT = 4096

#: Strings of a text that are hashed at a time, and bytes of the runs whose strings are sorted at a time.
PIECE = 1 << 17
SORTED_BYTES = 1 << 19

#: Runs that a task remembers to tell copies; beyond that it starts anew and more go to the buckets.
REMEMBERED = 300_000

#: Size of the batches that tasks give back: rows, or bytes of texts.
BATCH_ROWS = 20_000
BATCH_BYTES = 1 << 22

_BYTE = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = _powers[base] = np.cumprod(np.full(n, base, np.uint64))
    return known[:n]


def runs_of(data: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of the runs of places whose ``least``-byte strings have their least gram (the first of equals) in
    common: the gram's hash, a digest of all bytes of the run's strings, the first place, the length."""
    found = []
    for begin in range(0, len(data) - least + 1, PIECE):
        piece = data[begin:begin + PIECE + least - 1]
        n = len(piece)
        sums, inverse = np.zeros(n + 1, np.uint64), _power(pow(_BASE, -1, 1 << 64), n)
        np.cumsum(_BYTE[piece] * _power(_BASE, n), out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
        at, width = np.arange(len(grams)), 1
        while width < least - gram + 1:
            step = min(width, least - gram + 1 - width)
            a, b = at[:-step], at[step:]
            at = np.where(grams[a] <= grams[b], a, b)
            width += step
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        lengths = np.diff(np.r_[first, len(at)])
        bytes_ = (sums[first + lengths + least - 1] - sums[first]) * inverse[first] + lengths.astype(np.uint64)
        found.append((grams[at[first]].view(np.int64), mixed(bytes_).view(np.int64), first + begin, lengths))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def _earlier(rank: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """For each place of the suffix order the common prefix with the nearest place before it whose rank is
    smaller. ``common`` is the common prefix with the place just before; ways on which it falls below
    ``least`` are not followed further."""
    before, low = np.arange(len(rank)) - 1, common.copy()
    while True:
        open_ = np.flatnonzero((before >= 0) & (low >= least) & (rank[before] > rank))
        if not len(open_):
            return np.where((before >= 0) & (rank[before] < rank), low, 0)
        over = before[open_]
        low[open_], before[open_] = np.minimum(low[open_], low[over]), before[over]


def longest_previous_factors(strings: np.ndarray, least: int | None = None) -> np.ndarray:
    """``strings`` is a matrix of bytes, one string a row, in corpus order. For each of them the length of the
    longest beginning that an earlier one shares. Lengths under ``least`` may be given too small."""
    m, width = strings.shape
    least = 0 if least is None else least
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    same = strings[order[1:]] == strings[order[:-1]]
    common = np.zeros(m, np.int64)
    common[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    previous = _earlier(order, common, least)
    following = _earlier(order[::-1], np.r_[0, common[:0:-1]], least)[::-1]
    found = np.zeros(m, np.int64)
    found[order] = np.maximum(previous, following)
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (node, text, ...) as bytes and further columns, one at a time; rows come sorted by node, and
    of repeated nodes only the first is given."""
    last = None
    for batch in batches:
        for i in range(batch.num_rows):
            node = batch.column(0)[i].as_py()
            if node != last:
                last = node
                yield node, np.frombuffer(batch.column(1)[i].as_py(), np.uint8), *(c[i] for c in batch.columns[2:])


#: A run's place and length in one number.
LENGTHS = 1 << 8

_RUNS = pa.schema([("h", pa.int64()), ("d", pa.int64()), ("node", pa.int64()), ("at", pa.int64())])


def _runs(least: int, gram: int):
    """Gram hash ``h``, digest ``d``, node and place of every run. Copies of a run that the task has seen have no
    digest, and no gram: they are dealt evenly."""
    def batch_of(found):
        columns = [np.concatenate(c) for c in zip(*found)]
        arrays = [pa.array(c) for c in columns[:-1]]
        arrays[1] = pa.array(columns[1], mask=columns[-1])
        return pa.RecordBatch.from_arrays(arrays, schema=_RUNS)

    def run(batches):
        found, held, seen = [], 0, set()
        for node, data, *_ in _texts(batches):
            h, d, start, length = runs_of(data, least, gram)
            nodes, at = np.full(len(h), node, np.int64), start * LENGTHS + length
            if len(seen) >= REMEMBERED:
                seen.clear()
            known = np.array([x in seen or bool(seen.add(x)) for x in d.tolist()], bool)
            h = np.where(known, mixed((nodes + at * 0x9E3779B1).view(np.uint64)).view(np.int64), h)
            found.append((h, d, nodes, at, known))
            held += len(h)
            if held >= BATCH_ROWS:
                yield batch_of(found)
                found, held = [], 0
        if found:
            yield batch_of(found)

    return run


_CONTEXTS = pa.schema([("b", pa.int64()), ("node", pa.int64()), ("start", pa.int32()), ("length", pa.int32()), ("bytes", pa.binary())])


def _contexts(least: int):
    """Runs to be judged with their bytes, strings of hot grams one by one; copies without bytes, neighbouring
    ones as one. A string that the task has seen is a copy, too."""
    def run(batches):
        seen: set[bytes] = set()
        rows: list[tuple] = []

        def copy(node, start, length):
            b = xxhash.xxh3_64_intdigest(b"%d:%d" % (node, start)) - (1 << 63)
            rows.append((b, node, start, length, None))

        def batch_of():
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _CONTEXTS)], schema=_CONTEXTS)

        for node, data, places in _texts(batches):
            text = data.tobytes()
            ats, hashes, hot = (places.values.field(k).to_pylist() for k in range(3))
            waiting: tuple[int, int] | None = None
            for at, h, is_hot in sorted(zip(ats, hashes, hot), key=lambda p: p[0]):
                start, length = divmod(at, LENGTHS)
                if h is None:
                    if waiting and sum(waiting) == start:
                        waiting = (waiting[0], waiting[1] + length)
                    else:
                        if waiting:
                            copy(node, *waiting)
                        waiting = (start, length)
                elif not is_hot:
                    rows.append((h, node, start, length, text[start:start + length + least - 1]))
                else:
                    for one in range(start, start + length):
                        string = text[one:one + least]
                        mark = xxhash.xxh3_128_digest(string)
                        if mark in seen:
                            copy(node, one, 1)
                            continue
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(mark)
                        rows.append((int.from_bytes(mark[:8], "little", signed=True), node, one, 1, string))
                if len(rows) >= BATCH_ROWS:
                    yield batch_of()
            if waiting:
                copy(node, *waiting)
        if rows:
            yield batch_of()

    return run


_SPANS = pa.schema([("node", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _spans_of(node: np.ndarray, start: np.ndarray, run: np.ndarray, repeated: np.ndarray, least: int) -> pa.RecordBatch:
    """Neighbouring repeated strings of one run as one span."""
    at = np.flatnonzero(repeated)
    breaks = (np.diff(at) != 1) | (run[at[1:]] != run[at[:-1]])
    first, last = at[np.r_[True, breaks]], at[np.r_[breaks, True]]
    return pa.RecordBatch.from_arrays(
        [pa.array(node[first]), pa.array(start[first].astype(np.int32)), pa.array((start[last] + least).astype(np.int32))], schema=_SPANS)


def _judged(least: int):
    """Spans of the strings that have an earlier match, from runs sorted by bucket, node and place."""
    def judge(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([r[3] for r in rows])
        text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        offsets = np.cumsum(np.r_[0, [len(r[4]) for r in rows[:-1]]])
        run = np.repeat(np.arange(len(rows)), sizes)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node, start = np.array([r[1] for r in rows], np.int64)[run], np.array([r[2] for r in rows], np.int64)[run] + inside
        corpus = np.lexsort((start, node))
        views = np.lib.stride_tricks.sliding_window_view(text, least)
        lengths = longest_previous_factors(views[(offsets[run] + inside)[corpus]], least)
        repeated = np.zeros(len(run), bool)
        repeated[corpus] = lengths >= least
        if repeated.any():
            yield _spans_of(node, start, run, repeated, least)

    def run(batches):
        rows, held, bucket = [], 0, None
        for batch in batches:
            copies = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[4] is None:
                    copies.append((row[1], row[2], row[2] + row[3] - 1 + least))
                    continue
                if held >= SORTED_BYTES and row[0] != bucket:
                    yield from judge(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
                bucket = row[0]
            if copies:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*copies), _SPANS)], schema=_SPANS)
        if rows:
            yield from judge(rows)

    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for i in np.argsort(starts, kind="stable").tolist():
        if out and starts[i] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(ends[i]))
        else:
            out.append([int(starts[i]), int(ends[i])])
    return [(s, e) for s, e in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("node", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])
    rows: list[tuple] = []
    held = 0

    def batch_of():
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for node, data, spans in _texts(batches):
        found = merged(*(spans.values.field(k).to_numpy(zero_copy_only=False) for k in range(2)))
        left, at = [], 0
        for start, end in found:
            left.append(data[at:start].tobytes())
            at = end
        left.append(data[at:].tobytes())
        rows.append((node, [dict(start=s, end=e) for s, e in found], b"".join(left)))
        held += len(data)
        if held >= BATCH_BYTES:
            yield batch_of()
            rows, held = [], 0
    if rows:
        yield batch_of()


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``digest`` (SHA-256 of the text), ``spans`` (what goes, in bytes,
    end exclusive) and ``kept``, the bytes that stay, null where that is the whole text."""
    if not 0 < gram <= least or least - gram + 1 >= LENGTHS:
        raise ValueError("gram must be between 1 and least, and near enough to it")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = picked(docs, doc_id=id_column, text=text_column).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"),
    )
    facts = written(rows.drop("text").withColumn("row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "id_text"))
    firsts = facts.where(F.col("n_bytes") >= least).groupBy("digest").agg(first.alias("f"))
    # Nodes are numbered in corpus order.
    order = [F.col("f.none"), F.col("f.doc_id"), F.col("digest")]
    nodes = written(
        firsts.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("node"), F.col("f.row").alias("row"), F.col("f.id_text").alias("id_text"), "digest")
    )
    # The one shuffle of the texts; the three joins below share it.
    texts = rows.where(F.col("n_bytes") >= least).select("id_text", "digest", "text")
    keys = ["id_text", "digest"]

    def with_text(by_node: DataFrame, *more: str) -> DataFrame:
        joined = texts.join(by_node, keys).select("node", F.col("text").cast("binary").alias("text"), *more)
        return joined.sortWithinPartitions("node")

    runs = with_text(nodes.drop("row")).mapInArrow(_runs(least, gram), "h long, d long, node long, at long")
    gram_places = Window.partitionBy("h")
    same = F.lag("d").over(gram_places.orderBy("d", "node", "at")) == F.col("d")
    places = runs.select(
        "*", (F.col("d").isNull() | F.coalesce(same, F.lit(False))).alias("copy"),
        (F.min("d").over(gram_places) != F.max("d").over(gram_places)).alias("several"),
        (F.count(F.lit(1)).over(gram_places) >= hot).alias("hot"),
    ).where("copy OR several")
    wanted = places.groupBy("node").agg(F.collect_list(F.struct("at", F.when(~F.col("copy"), F.col("h")).alias("h"), "hot")).alias("runs"))
    contexts = with_text(wanted.join(nodes, "node"), "runs").mapInArrow(
        _contexts(least), "b long, node long, start int, length int, bytes binary"
    )
    spans = contexts.repartition("b").sortWithinPartitions("b", "node", "start").mapInArrow(
        _judged(least), "node long, start int, end int"
    )
    by_node = spans.groupBy("node").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = with_text(by_node.join(nodes, "node"), "spans").mapInArrow(
        _cut, "node long, spans array<struct<start:int,end:int>>, kept binary"
    )
    results = nodes.select("row", "node").join(cut, "node", "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    copy = F.col("node").isNull() & (F.col("n_bytes") >= least)
    return facts.join(results, "row", "left").select(
        "doc_id", "n_bytes", "digest",
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    removed: Column = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), F.lower(F.hex("digest"))).alias("kept_sha256"),
    )


QUERIES = {"op12_suffix_dedup": (op12_suffix_dedup, None)}
