"""Conversation repair, repeated strings and the manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.llm import manifest, repair, repeats

SF = "/root/testdata/sf0.01"

# Repeated strings


def _repeats_by_hand(rows, least):
    """rows: (id, text) by id; the result of each by a dictionary of all strings."""
    first, out = {}, []
    ordered = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], hashlib.sha256(rows[i][1]).digest()))
    for i in ordered:
        text, gone = rows[i][1], np.zeros(len(rows[i][1]), bool)
        for p in range(len(text) - least + 1):
            s = text[p:p + least]
            if s in first:
                gone[p:p + least] = True
            else:
                first[s] = i
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((rows[i][0], len(text), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _repeats(df, **options):
    rows = repeats.without_repeats(df, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                    hashlib.sha256(r["kept"]).hexdigest() if r["kept"] is not None else r["digest"].hex()) for r in rows), key=repr)


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats_against_brute_force(spark, documents, hot):
    random.seed(3)
    words = ["ab", "c", "déf", "漢字", "ggg", "\x00"]
    texts = ["".join(random.choice(words) for _ in range(random.choice([0, 5, 30, 200]))) for _ in range(60)]
    for _ in range(40):
        a, b = random.choice(texts), random.choice(texts)
        texts.append(a[random.randrange(len(a) + 1):] + b[: random.randrange(len(b) + 1)])
    texts += ["x" * 300, "x" * 70, "ab" * 100, texts[3], texts[3], ""]
    rows = [(i // 2 if i < 20 else i, t) for i, t in enumerate(texts)] + [(None, "".join(texts[:4])), (None, None), (3, texts[7]), (3, texts[7])]
    random.shuffle(rows)
    got = _repeats(documents(*rows).repartition(5), least=20, gram=6, hot=hot)
    assert got == _repeats_by_hand([(i, (t or "").encode()) for i, t in rows], 20)


def test_repeats_in_one_long_text(documents, monkeypatch):
    random.seed(4)
    base = "".join(random.choice("abcdefgh ") for _ in range(180_000))
    text = base + base[500:1500] + "-" + base[170_000:]
    got = _repeats(documents((1, text), (2, base[:50] + base[60_000:60_400])))
    assert got == _repeats_by_hand([(1, text.encode()), (2, (base[:50] + base[60_000:60_400]).encode())], 100)


def test_repeats_of_the_query(spark):
    got = sorted((tuple(r) for r in repeats.op12_suffix_dedup(spark, SF).collect()), key=repr)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == _repeats_by_hand(rows, 100)


def test_longest_previous_factors():
    random.seed(5)
    for _ in range(50):
        m, width = random.randrange(1, 40), random.choice([3, 8])
        strings = np.array([[random.choice([0, 97, 98]) for _ in range(width)] for _ in range(m)], np.uint8)

        def common(i, j):
            return next((k for k in range(width) if strings[i][k] != strings[j][k]), width)

        assert repeats.longest_previous_factors(strings).tolist() == [max((common(i, j) for j in range(i)), default=0) for i in range(m)]


# Conversations


def _cheapest_by_hand(rows):
    """rows: (initial, fault). Least (cost, audit) over all nodes by relaxing every edge until nothing changes."""
    n = len(rows)
    best = {(0, 0): (0, "")}
    while True:
        before = dict(best)
        for (i, q), (cost, audit) in list(best.items()):
            follower = 3 if q == 2 else 2
            steps = [((i, follower), 2, "I")]
            if i < n:
                initial, fault = rows[i]
                extra = fault == repair.TRUNCATED
                steps.append(((i + 1, q), 3, "D"))
                if fault not in (repair.BLANK, repair.DUPLICATE):
                    steps.append(((i + 1, follower), 2 + extra, "R"))
                    if initial == ("a" if follower == 3 else "u"):
                        steps.append(((i + 1, follower), extra, "K"))
                    if initial == "s" and q == 0:
                        steps.append(((i + 1, 1), extra, "K"))
            for node, more, letter in steps:
                new = (cost + more, audit + letter)
                if new[0] <= 3 * n + 4 and (node not in best or new < best[node]):
                    best[node] = new
        if best == before:
            return min(best[n, q] for q in (0, 3) if (n, q) in best)


def test_search_against_relaxation():
    for n in range(4):
        for rows in product(product("suax", range(3)), repeat=n):
            layers = [repair.row_edges(*r) for r in rows]
            assert repair.cheapest(layers, 0, repair.ENDS) == _cheapest_by_hand(rows), rows
    random.seed(6)
    for _ in range(300):
        rows = [(random.choice("suuaat"), random.choice([0, 0, 0, 1, 2, 3])) for _ in range(random.randrange(4, 14))]
        layers = [repair.row_edges(*r) for r in rows]
        want = _cheapest_by_hand(rows)
        assert repair.cheapest(layers, 0, repair.ENDS) == want
        cut = [repair.between(layers[i:i + 2]) for i in range(0, len(layers), 2)]
        assert repair.joined_chunks(cut) == want


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        spell = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(spell).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _repair_by_hand(rows, damage):
    after = _damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, facts = set(), []
        for _, role, text in mine:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = 2 if not bare else 3 if (role, text) in seen else 1 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            facts.append((role[:1], fault))
        cost, audit = _cheapest_by_hand(facts) if facts else (0, "")
        turns, rest, state = [], iter(mine), 0
        for letter in audit:
            _, role, text = (None, "", "") if letter == "I" else next(rest)
            if letter == "D":
                continue
            state = 1 if letter == "K" and role[:1] == "s" else 3 if state == 2 else 2
            turns.append((role if letter == "K" else {2: "user", 3: "assistant"}[state]) + ":" + text)
        numbers = [t for t, _, _ in mine if t is not None]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(f == k for _, f in facts) for k in (2, 3, 1)),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:])),
            cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest(),
        )
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def _conversations():
    random.seed(7)
    rows = []
    for conv in range(40):
        for turn in range(random.choice([1, 2, 5, 9, 40])):
            role = random.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = random.choice(["Yes.", "no", "Why?", "", " \n", "ok!\n", None, "a longer answer " * 50 + "."])
            rows.append((conv, random.choice([turn, turn, 3, None]), role, text))
    return rows + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (77, 4, "user", "x")]


def _by_conversation(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("chunk", [256, 3])
def test_repair_against_brute_force(spark, tmp_path, monkeypatch, chunk):
    rows = _conversations()
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(path)
    # Tasks run in other processes: the size of chunks is passed on by the function itself.
    monkeypatch.setattr(repair, "CHUNK", chunk)
    got = _by_conversation(repair.op11_conversation_repair(spark, str(tmp_path)))
    assert got == _repair_by_hand(rows, True)


def test_repair_of_the_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert _by_conversation(repair.op11_conversation_repair(spark, SF)) == _repair_by_hand(rows, True)


def test_repaired_texts_match_the_digest(spark):
    rows = _conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("grp", F.lit("clash")).withColumn("audit", F.lit(1))
    want = {("" if c is None else f"c{c}"): v[-1] for c, v in _repair_by_hand(rows, False).items()}
    assert {r["grp"]: hashlib.sha256("\n".join(r["turns"]).encode()).hexdigest() for r in repair.repaired_texts(df).collect()} == want


def test_repair_of_nothing(spark, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert repair.op11_conversation_repair(spark, str(tmp_path)).count() == 0


# Manifest


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """All levels, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_hash(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 16 * 16
        out.append((level[run:at], level[at + 1:run + 16]))
        at //= 16
    return out


@pytest.mark.parametrize("sizes", [[1], [16, 17], [300, 1, 256, 257], [4200, 5], [2] * 40])
def test_manifest_against_brute_force(spark, sizes):
    rows = [(f"s{k:03}", i, _hash(str(k), str(i // 2))) for k, n in enumerate(sizes) for i in range(n)]
    random.seed(8)
    shuffled = random.sample(rows, len(rows))
    got = {(r["grp"], r["id"]): r for r in manifest.manifest(spark.createDataFrame(shuffled, "grp string, id long, leaf string")).collect()}
    groups = {g: _tree([r[2] for r in rows if r[0] == g]) for g in sorted({r[0] for r in rows})}
    top = _tree([t[-1][0] for t in groups.values()])
    assert len(got) == len(rows)
    for (g, i), r in got.items():
        want = _siblings(groups[g], i) + _siblings(top, list(groups).index(g))
        assert [(s["left"], s["right"]) for s in r["proof"]] == [("".join(a), "".join(b)) for a, b in want]
        assert (r["subroot"], r["root"]) == (groups[g][-1][0], top[-1][0])


def test_manifest_of_odd_rows(spark, tmp_path, odd_documents, clashing):
    clashing(odd_documents).drop("at", "leaf").withColumn("grp", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    rows = manifest.op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(rows) == odd_documents.count() and len({r["root"] for r in rows}) == 1
    first = next(r for r in rows if r["doc_id"] == 2)
    assert first["leaf"] == _hash("1:2", "-", "-", "1:0", "0:")
    # Tampering changes the root where a capital letter changes.
    assert all(r["verified"] for r in rows)
    spark.createDataFrame([(i, "Text", "en", "s", 4) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "b" / "documents.parquet"))
    again = manifest.op13_merkle_manifest(spark, str(tmp_path / "b")).collect()
    assert {r["doc_id"] for r in again if not r["verified"]} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_manifest_of_nothing(spark, tmp_path, documents):
    documents((1, "x")).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert manifest.op13_merkle_manifest(spark, str(tmp_path)).count() == 0
