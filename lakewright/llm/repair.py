"""Conversation structure repair: the cheapest edits that give a conversation legal turns.

A conversation's rows, in order, are the layers of an edit lattice; its states are what stands last in
the repaired conversation (nothing, system, user, assistant). Edges keep, rerole or delete a row, or
insert an empty turn. A bidirectional Dijkstra search finds the least cost: a forward heap from the first
layer and a reverse heap from the accepted ends meet, all crossings of that cost are finished, and the
least concatenated audit of them is taken.

Rows reach the search as short facts, without their text, in chunks of at most ``CHUNK`` rows. A
conversation of several chunks, which may be spread over many tasks, has each chunk searched between its
possible states; the chunks are then the edges of a lattice of the same kind. Texts move once, for the
digest of the repaired conversation, and stream past the audit in order.

* Null roles, texts, ids and turns in ``conv_id:turn`` are one space; null ``conv_id`` is a conversation of its own.
* Rows of one turn stand in the order of role, then of the text's SHA-256.
* Repeated rows are duplicates. An empty table gives no rows. Other columns are ignored.
* The audit and the digest of one conversation are single values: they take memory for the audit (one
  byte an edit, sixteen while chunks are joined) and one task's time for the hash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import SLICE_ROWS, mapped, picked, table
from lakewright.session import written

CHUNK = 256

#: What stands last in the repaired conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (NOTHING, ASSISTANT)

DELETE, INSERT, KEEP, REROLE = "DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
ROLES = {USER: "user", ASSISTANT: "assistant"}

#: Faults of a row, as the chunks carry them.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)

FANOUT = 16


def turn_after(state: int) -> int:
    """The role that may follow, other than a system turn at the start."""
    return ASSISTANT if state == USER else USER


def row_edges(initial: str, fault: int) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, letter) of one row."""
    edges = [(q, q, COSTS[DELETE], DELETE) for q in STATES]
    if fault in (BLANK, DUPLICATE):
        return edges
    extra = fault == TRUNCATED
    for q in STATES:
        follower = turn_after(q)
        edges.append((q, follower, COSTS[REROLE] + extra, REROLE))
        if initial == "ua"[follower == ASSISTANT]:
            edges.append((q, follower, COSTS[KEEP] + extra, KEEP))
        elif initial == "s" and q == NOTHING:
            edges.append((q, SYSTEM, COSTS[KEEP] + extra, KEEP))
    return edges


#: Insertions stay in their layer; they are never free.
INSERTIONS = [(q, turn_after(q), COSTS[INSERT], INSERT) for q in STATES]


def cheapest(layers: list[list[tuple[int, int, int, str]]], start: int, ends, insertions=INSERTIONS) -> tuple[int, str] | None:
    """Least cost and, of the paths of that cost, the least audit, from ``start`` before the first layer to
    one of ``ends`` after the last one. Each layer is a list of edges to the next. ``None`` without a path.

    Free edges only lead from a layer to the next one. So among equal costs each side settles the layer
    nearer to its start first, and an audit is final when its node is settled. Of equally cheap audits to
    one node none is the beginning (or end) of another, since that would need free insertions; so the
    least whole audit is made of least parts.
    """
    last = len(layers)
    out: list[dict] = [{} for _ in range(last + 1)]
    back: list[dict] = [{} for _ in range(last + 1)]

    def link(i, q, j, r, cost, letters):
        out[i].setdefault(q, []).append((j, r, cost, letters))
        back[j].setdefault(r, []).append((i, q, cost, letters))

    for i, edges in enumerate(layers):
        for q, r, cost, letters in edges:
            link(i, q, i + 1, r, cost, letters)
    for i in range(last + 1):
        for q, r, cost, letters in insertions:
            link(i, q, i, r, cost, letters)

    # One side each: the best known (cost, audit) of a node, its settled nodes, its heap.
    ahead, behind = {(0, start): (0, "")}, {(last, q): (0, "") for q in ends}
    done_ahead, done_behind = set(), set()
    heap_ahead = [(0, 0, start)]
    heap_behind = [(0, 0, q) for q in ends]
    best = None

    def settle(known, done, heap, links, other, forward):
        nonlocal best
        cost, near, q = heapq.heappop(heap)
        i = near if forward else last - near
        if (i, q) in done:
            return
        done.add((i, q))
        audit = known[i, q][1]
        for j, r, step, letters in links[i].get(q, ()):
            new = (cost + step, audit + letters if forward else letters + audit)
            old = known.get((j, r))
            if (j, r) in done:
                continue
            if old is None or new < old:
                known[j, r] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(heap, (new[0], j if forward else last - j, r))
            if (j, r) in other and (best is None or new[0] + other[j, r][0] < best):
                best = new[0] + other[j, r][0]
        if (i, q) in other and (best is None or cost + other[i, q][0] < best):
            best = cost + other[i, q][0]

    # Costs beyond the best sum of both heaps cannot be on a path that is as cheap.
    while heap_ahead and heap_behind and (best is None or heap_ahead[0][0] + heap_behind[0][0] <= best):
        if heap_ahead[0][0] <= heap_behind[0][0]:
            settle(ahead, done_ahead, heap_ahead, out, behind, True)
        else:
            settle(behind, done_behind, heap_behind, back, ahead, False)
    if best is None:
        return None
    # Both starts are settled at no cost; a side that ran out has settled all that it can reach.
    done_ahead.add((0, start))
    done_behind |= {(last, q) for q in ends}
    found = [ahead[n][1] + behind[n][1] for n in done_ahead & done_behind if ahead[n][0] + behind[n][0] == best]
    for i, q in done_ahead:
        cost, audit = ahead[i, q]
        for j, r, step, letters in out[i].get(q, ()):
            if (j, r) in done_behind and cost + step + behind[j, r][0] == best:
                found.append(audit + letters + behind[j, r][1])
    return best, min(found)


def between(layers, starts=STATES, ends=STATES, insertions=INSERTIONS) -> list[tuple[int, int, int, str]]:
    """The layers as edges of one layer."""
    found = ((q, r, cheapest(layers, q, [r], insertions)) for q in starts for r in ends)
    return [(q, r, *hit) for q, r, hit in found if hit]


def joined_chunks(chunks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """The cheapest way through chunks that are edges already, ``FANOUT`` at a time."""
    while len(chunks) > FANOUT:
        chunks = [between(chunks[i:i + FANOUT], insertions=[]) for i in range(0, len(chunks), FANOUT)]
    return cheapest(chunks, NOTHING, ENDS, [])


def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """``role:text`` of the turns that the audit leaves of the rows."""
    state = NOTHING
    for letter in audit:
        role, text = ("", "") if letter == INSERT else next(rows)
        if letter == DELETE:
            continue
        state = SYSTEM if letter == KEEP and role[:1] == "s" else turn_after(state)
        yield (role if letter == KEEP else ROLES[state]) + ":" + text


def conversation_rows(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """``grp``, ``conv_id``, ``turn``, ``role``, ``text``, ``content`` (SHA-256 of the text) and ``dropped``. With
    ``damaged``, the rows after damage by the CRC-32 of ``conv_id:turn``; dropped rows stay, marked."""
    rows = picked(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    blank = F.lit(" ")

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    rows = rows.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("grp"),
        "conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
        (F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20).alias("damage"),
    )
    if damaged:
        kind = F.col("damage")
        text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
        copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = rows.select(
            "grp", "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"), (kind == 0).alias("dropped"), F.explode(copies).alias("copy"),
        ).drop("copy")
    else:
        rows = rows.drop("damage").withColumn("dropped", F.lit(False))
    return rows.withColumn("content", F.unhex(F.sha2("text", 256)))


def _order() -> list:
    return [F.col("grp"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("content")]


_CHUNKS = pa.schema([
    ("grp", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("initials", pa.string()), ("faults", pa.binary()),
    ("keys", pa.list_(pa.binary())), ("low", pa.decimal128(38, 0)), ("high", pa.decimal128(38, 0)), ("turns", pa.int64()),
])
_CHUNK_SQL = (
    "grp string, part long, seq long, initials string, faults binary, keys array<binary>, "
    "low decimal(38,0), high decimal(38,0), turns long"
)


def _chunked(chunk: int):
    """Sorted facts as rows of at most ``chunk`` facts of one conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        now: list | None = None
        done: list[tuple] = []

        def close():
            nonlocal seq
            grp, initials, faults, keys, turns, distinct = now
            # An initial of no letter is a mark of its own: no role, or a role that begins with a line end.
            done.append((grp, part, seq, "".join(initials), bytes(faults), keys, turns[0], turns[1], distinct))
            seq += 1

        def batch_of():
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _CHUNKS)], schema=_CHUNKS)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part_rows = batch.slice(at, SLICE_ROWS)
                for grp, turn, dropped, initial, fault, key in zip(*(c.to_pylist() for c in part_rows.columns)):
                    if now is None or now[0] != grp or len(now[1]) >= chunk:
                        if now is not None:
                            close()
                        now = [grp, [], bytearray(), [], [None, None], 0]
                    if dropped:
                        continue
                    now[1].append(initial)
                    now[2].append(fault)
                    now[3].append(key)
                    if turn is not None:
                        low, high = now[4]
                        now[5] += high is None or turn != high
                        now[4] = [turn if low is None else low, turn]
                if len(done) >= SLICE_ROWS:
                    yield batch_of()
        if now is not None:
            close()
        if done:
            yield batch_of()

    return run


def chunks_of(rows: DataFrame) -> DataFrame:
    """The facts of all rows in chunks, written: conversations in order, wherever their rows lie."""
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    facts = written(rows.select(
        "grp", "turn", "role", "content", "dropped",
        F.when(F.length("role") > 0, F.substring("role", 1, 1)).otherwise("\u0000").alias("initial"),
        F.when(trimmed == "", BLANK).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
        .cast("int").alias("fault"),
        F.unhex(F.sha2(F.concat("role", F.lit("\u0000"), F.hex("content")), 256)).alias("key"),
    ))
    # The row's own number comes last, so that many equal rows can still be dealt to several tasks.
    ranged = facts.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*_order(), "tie")
    sorted_rows = ranged.sortWithinPartitions(*_order(), "tie").select(
        "grp", F.col("turn").cast("decimal(38,0)").alias("turn"), "dropped", "initial", "fault", "key"
    )
    return written(sorted_rows.mapInArrow(_chunked(CHUNK), _CHUNK_SQL))


def _seen_before(chunks: DataFrame) -> DataFrame:
    """``seen``, the rows' keys of a chunk that stand in an earlier chunk of the same conversation. Only
    conversations of several chunks have any; a key counts once a chunk."""
    place = F.struct("part", "seq")
    several = chunks.groupBy("grp").agg(F.count(F.lit(1)).alias("chunks")).where("chunks > 1").select("grp")
    keys = chunks.join(several, "grp", "left_semi").select(
        "grp", place.alias("place"), F.explode(F.array_distinct("keys")).alias("key")
    )
    first = keys.groupBy("grp", "key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        keys.join(first, ["grp", "key"]).where(F.col("place") > F.col("first"))
        .groupBy("grp", "place").agg(F.collect_list("key").alias("seen"))
        .select("grp", "place.part", "place.seq", "seen")
    )


_SEARCHED = (
    "grp string, part long, seq long, rows long, blank long, duplicate long, truncated long, illegal long, head string, "
    "tail string, low decimal(38,0), high decimal(38,0), turns long, edges array<struct<q:int,r:int,cost:long,audit:string>>"
)


def _search(columns: list[list]) -> Iterator[tuple]:
    for grp, part, seq, initials, faults, keys, low, high, turns, seen, is_first, is_last in zip(*columns):
        known = set(seen or ())
        layers, counts = [], [0, 0, 0, 0]
        for initial, fault, key in zip(initials, faults, keys):
            if key in known and fault != BLANK:
                fault = DUPLICATE
            known.add(key)
            counts[fault] += 1
            layers.append(row_edges(initial, fault))
        starts, ends = ([NOTHING] if is_first else STATES), (ENDS if is_last else STATES)
        if is_first and is_last:
            cost, audit = cheapest(layers, NOTHING, ENDS)
            edges = [(NOTHING, ENDS[0], cost, audit)]
        else:
            edges = between(layers, starts, ends)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        yield (
            grp, part, seq, len(initials), counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal,
            initials[:1], initials[-1:], low, high, turns, [dict(zip(("q", "r", "cost", "audit"), e)) for e in edges],
        )


_JOINED = "grp string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"


def _join(columns: list[list]) -> Iterator[tuple]:
    for grp, chunks in zip(*columns):
        chunks = [c for c in sorted(chunks, key=lambda c: (c["part"], c["seq"])) if c["rows"]]
        if not chunks:
            yield grp, 0, 0, 0, 0, 0, 0, ""
            continue
        total = {k: sum(c[k] for c in chunks) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
        total["illegal"] += sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(chunks, chunks[1:]))
        numbered = [c for c in chunks if c["low"] is not None]
        distinct = total["turns"] - sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:]))
        gaps = int(numbered[-1]["high"] - numbered[0]["low"]) + 1 - distinct if numbered else 0
        if len(chunks) == 1 and len(chunks[0]["edges"]) == 1:
            edge = chunks[0]["edges"][0]
            cost, audit = edge["cost"], edge["audit"]
        else:
            cost, audit = joined_chunks([[(e["q"], e["r"], e["cost"], e["audit"]) for e in c["edges"]] for c in chunks])
        yield grp, total["blank"], total["duplicate"], total["truncated"], total["illegal"], gaps, cost, audit


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation's audit first: the digest of every repaired conversation. Only one
    batch of texts is held at a time."""
    schema = pa.schema([("grp", pa.string()), ("repaired_sha256", pa.string())])

    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield from zip(*(c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns))

    stream = rows()
    ahead = next(stream, None)
    done: list[tuple[str, str]] = []

    def own_rows(grp):
        nonlocal ahead
        while ahead is not None and ahead[0] == grp:
            row, ahead = ahead, next(stream, None)
            yield row[2], row[3]

    while ahead is not None:
        grp, audit = ahead[0], ahead[1]
        ahead = next(stream, None)
        mine, total, first = own_rows(grp), hashlib.sha256(), True
        for turn in repaired_turns(audit, mine):
            total.update(("" if first else "\n").encode() + turn.encode("utf-8", "surrogatepass"))
            first = False
        for _ in mine:  # the deleted rest
            pass
        done.append((grp, total.hexdigest()))
        if len(done) >= SLICE_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*done))], schema=schema)
            done = []
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*done))], schema=schema)


def audits(rows: DataFrame) -> DataFrame:
    """``grp``, the counts, ``cost`` and ``audit`` of every conversation of ``conversation_rows``; written."""
    chunks = chunks_of(rows)
    bounds = chunks.groupBy("grp").agg(
        F.min(F.struct("part", "seq")).alias("first"), F.max(F.struct("part", "seq")).alias("last")
    )
    place = F.struct("part", "seq")
    ready = (
        chunks.join(_seen_before(chunks), ["grp", "part", "seq"], "left").join(bounds, "grp")
        .select(*chunks.columns, "seen", (place == F.col("first")).alias("is_first"), (place == F.col("last")).alias("is_last"))
    )
    searched = mapped(ready, _search, _SEARCHED)
    whole = searched.groupBy("grp").agg(F.collect_list(F.struct(*[c for c in searched.columns if c != "grp"])).alias("chunks"))
    return written(mapped(whole, _join, _JOINED))


def repaired(conversations: DataFrame, damaged: bool = False) -> tuple[DataFrame, DataFrame]:
    """The audits of all conversations, and the repaired turns' digests by ``grp``."""
    rows = conversation_rows(conversations, damaged)
    found = audits(rows)
    none = F.lit(None)
    stream = found.select("grp", "audit", none.cast("string").alias("role"), none.cast("string").alias("text"),
                          none.cast("decimal(38,0)").alias("turn"), none.cast("binary").alias("content"), F.lit(0).alias("kind"))
    texts = rows.where(~F.col("dropped")).select(
        "grp", none.cast("string").alias("audit"), "role", "text", F.col("turn").cast("decimal(38,0)").alias("turn"), "content",
        F.lit(1).alias("kind"))
    together = stream.unionByName(texts).repartition("grp").sortWithinPartitions(
        "grp", "kind", F.col("turn").asc_nulls_first(), "role", "content")
    return found, together.select("grp", "audit", "role", "text").mapInArrow(_digests, "grp string, repaired_sha256 string")


def repaired_texts(conversations: DataFrame) -> DataFrame:
    """``grp`` and the repaired conversations' ``turns`` (``role:text``) in order. One array a conversation:
    for conversations that fit a row."""
    rows = conversation_rows(conversations)
    turn = F.struct(F.col("turn"), "role", "content", "text")
    texts = rows.groupBy("grp").agg(F.array_sort(F.collect_list(turn)).alias("rows"))

    def apply(columns):
        for grp, audit, turns in zip(*columns):
            # Nulls come first, as everywhere here; array_sort puts them last.
            ordered = sorted(turns, key=lambda t: t["turn"] is not None)
            yield grp, list(repaired_turns(audit, iter([(t["role"], t["text"]) for t in ordered])))

    return mapped(texts.join(audits(rows), "grp").select("grp", "audit", "rows"), apply, "grp string, turns array<string>")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found, digests = repaired(conversations, damaged=True)
    ids = conversation_rows(conversations).groupBy("grp").agg(F.first("conv_id").alias("conv_id"))
    return ids.join(found, "grp").join(digests, "grp").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


QUERIES = {"op11_conversation_repair": (op11_conversation_repair, None)}
