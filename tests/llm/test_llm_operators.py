"""Operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from samples import PROSE
from pyspark.sql import functions as F

from lakewright.llm import contamination, language, lines, neardup, pieces, quality, secrets, shingles, tokens, toxicity, urls
from lakewright.llm.common import may_be_in
from lakewright.llm.common import may_be_in

SF = "/root/testdata/sf0.01"


def _texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


# Token counts


def _library_counts(name, texts):
    import public_tokenizers

    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name, by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False), ("piece_bpe_32k.model", False)])
def test_token_counts_equal_the_library(spark, documents, tmp_path, name, by_word):
    import public_tokenizers

    texts = [
        "Hello  World\n\tit's  <|endoftext|>done <|startoftext|>", "<|ENDOFTEXT|>", "ΣΑΣ Σ, ÉÈ don't stop now\x1cthen\x85end",
        "é ́x", "123 45.6 漢字 🎉", "", " ", "same text", " same \n text ", "same text",
    ]
    docs = documents(*enumerate(texts))
    got = tokens.token_counts(docs, public_tokenizers.path(name), str(tmp_path / "cache"), by_word=by_word)
    assert {r[0]: r[2] for r in got.collect()} == dict(enumerate(_library_counts(name, texts)))


def test_token_cache_is_used_and_appended(spark, documents, tmp_path):
    import public_tokenizers

    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    tokens.token_counts(documents((1, "a b"), (2, " a  b ")), path, cache, by_word=True).collect()
    assert tokens.read_cache(spark, cache).count() == 1
    # A stored count is taken as it is: nothing is encoded again.
    row = tokens.read_cache(spark, cache).first()
    other = str(tmp_path / "other")
    spark.createDataFrame([(bytes(row["content"]), 77, row["tokenizer"])], tokens.CACHE_SCHEMA).write.partitionBy("tokenizer").parquet(other)
    got = tokens.token_counts(documents((5, "a b"), (6, "c d e")), path, other, by_word=True)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {5: 77, 6: 3}
    assert tokens.read_cache(spark, other).count() == 2


# Language


def test_language_by_nearest_centroid(spark, documents):
    random.seed(1)
    rows = [
        (4 * n + k, " ".join(random.sample(text.split(), 12)), name) for n in range(40) for k, (name, text) in enumerate(PROSE.items())
    ]
    model = language.fit_languages(documents(*rows[:120]))
    got = {r["doc_id"]: r for r in language.identified(documents(*rows[120:], (900, "123 ###"), (901, "漢字")), model).collect()}
    assert all(got[i]["lang_pred"] == name for i, _, name in rows[120:])
    assert (got[900]["lang_pred"], got[900]["score"], got[900]["rejected"]) == ("und", 0.0, True)
    assert got[901]["lang_pred"] in PROSE and got[901]["rejected"]
    assert len(model.languages) == 4 * language.CENTROIDS


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in language.op3_language_id(spark, SF).collect() if r["held_out"]]
    assert len(rows) > 150
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.99 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


# Toxicity


def test_toxicity_ranks_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in toxicity.op4_toxicity(spark, "/root/testdata/sf0.1").collect() if r["held_out"] and r["doc_id"] in labels]
    y, s = np.array([labels[r["doc_id"]] for r in rows]), np.array([r["score"] for r in rows])
    above = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert above > 0.93
    assert ((s >= 0.3) == (y == 1)).mean() > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


# Lines


def _lines_by_hand(rows, ratio, least):
    held, total = Counter(), Counter()
    for site, text in rows:
        if site is not None and text is not None:
            held.update({(site, line.strip(" \t\n\x0b\f\r")) for line in text.split("\n")})
        total[site] += site is not None
    out = []
    for site, text in rows:
        if text is None:
            out.append(None)
            continue
        gone = [
            site is not None and line.strip(" \t\n\x0b\f\r") != ""
            and held[site, line.strip(" \t\n\x0b\f\r")] >= least and held[site, line.strip(" \t\n\x0b\f\r")] > ratio * total[site]
            for line in text.split("\n")
        ]
        out.append("\n".join(line for line, g in zip(text.split("\n"), gone) if not g))
    return out


def test_lines_by_site_against_brute_force(spark, documents):
    random.seed(2)
    pool = [f"line {i}" for i in range(40)] + ["", "  line 3 ", "menu", "menu "]
    rows = []
    for i in range(300):
        site = random.choice(["hot", "hot", "b", "c", None])
        text = None if i % 50 == 0 else "\n".join(random.choice(pool[: 4 + i % 40]) for _ in range(random.randint(1, 9)))
        rows.append((i, text, None, site))
    found = lines.without_boilerplate(documents(*rows), F.col("source"), F.col("text"))
    got = {r["id"]: r["text"] for r in found.select(F.col("row.doc_id").alias("id"), "text").collect()}
    assert [got[i] for i in range(300)] == _lines_by_hand([(r[3], r[1]) for r in rows], lines.RATIO, lines.LEAST_PAGES)


# Near duplicates


def _components_by_hand(docs):
    sets = {i: shingles.shingle_texts(shingles.words_of(t)) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_of_rejected_variants(spark, documents):
    """A group whose members are partly below the limit, some of those linked with each other only."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]

    def changed(words, times):
        out = list(words)
        for _ in range(times):
            out[rng.randrange(len(out))] = f"x{rng.randrange(900)}"
        return out

    rows = [changed(base, rng.choice((1, 2, 3, 5, 6, 8, 9))) for _ in range(110)]
    rows += [changed(rows[rng.randrange(110)], rng.choice((1, 3))) for _ in range(50)]
    rng.shuffle(rows)
    sets = [shingles.shingle_texts([w.encode() for w in words]) for words in rows]
    least = list(range(len(rows)))
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    for _ in rows:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    assert 5 < len(set(least)) < 100
    docs = documents(*((i, " ".join(words)) for i, words in enumerate(rows)))
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == dict(enumerate(least))


def test_near_duplicates_against_all_pairs(spark, documents):
    random.seed(4)
    docs, n = {}, 0
    for group in range(12):
        base = [f"w{group}x{random.randint(0, 400)}" for _ in range(random.choice([4, 30, 80, 200]))]
        # Copies drift from the one before, so that ends of a chain are not linked themselves.
        for _ in range(random.choice([1, 3, 12])):
            base = [w if random.random() > 0.015 else f"new{random.randint(0, 999)}" for w in base]
            docs[n] = " ".join(base)
            n += 1
    for text in ("", "A b c", "a  B c", "a b", None, docs[3].upper()):
        docs[n] = text
        n += 1
    items = list(docs.items())
    random.shuffle(items)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(documents(*items)).collect()}
    component, size = _components_by_hand(docs)
    assert {i: r["component_id"] for i, r in got.items()} == component
    assert {i: r["n_shingles"] for i, r in got.items()} == size
    assert all(r["kept"] == (i == component[i]) for i, r in got.items())


def test_buckets_of_one_pivot_are_one_group(spark, documents, monkeypatch):
    """Near copies meet in many buckets; they travel once for their pivot, not once for each bucket."""
    frames = []
    monkeypatch.setattr(neardup, "written", lambda df, write=neardup.written: frames.append(write(df)) or frames[-1])
    base = [f"w{i}" for i in range(120)]
    rows = [" ".join([*base[:at], "x", *base[at + 1:]]) for at in range(0, 120, 8)]
    got = neardup.near_duplicates(documents(*enumerate(rows))).collect()
    assert {r["component_id"] for r in got} == {0}
    moved = [f for f in frames if {"pivot", "node"} <= set(f.columns)]
    assert moved and all(f.count() == f.select("pivot", "node").distinct().count() for f in moved)


def test_rejected_variants_make_no_pairs(spark, documents, monkeypatch):
    """Variants of a long text, each with many shingles of its own, beside two that are linked with each other
    only: no pair is made of the others, whatever the size of the group, and none meets by the pivot alone."""
    frames, joins = [], []

    def write(df, write=neardup.written):
        if df.columns == ["a", "b"]:
            joins.extend(re.findall(r"Join Inner, (.*)", df._jdf.queryExecution().optimizedPlan().toString()))
        frames.append(write(df))
        return frames[-1]

    monkeypatch.setattr(neardup, "written", write)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(6_000)]
    docs = {}
    for i in range(24):
        words = list(base)
        for at in rng.sample(range(6_000), 360):
            words[at] = f"own{i}x{at}"
        docs[i] = " ".join(words)
    docs[30] = docs[7] + " and more"
    docs[31] = " ".join(base)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(*docs.items())).collect()}
    assert got == {i: i for i in docs} | {30: 7}
    pairs = {tuple(r) for f in frames if f.columns == ["a", "b"] for r in f.collect()}
    assert {(min(p), max(p)) for p in pairs} == {(7, 30)}
    in_groups = [j for j in joins if "pivot" in j]
    assert in_groups and all("shingle" in j for j in in_groups)


@pytest.mark.parametrize("step", [0, 1, 7, 40])
def test_early_shingles_find_every_link_of_a_group(spark, documents, step):
    """Members of many sizes, some inside others, with words of the pivot, of each other and of their own."""
    rng = random.Random(step)
    base = [f"w{i}" for i in range(260)]
    docs = {}
    for i in range(90):
        start = rng.randrange(0, step + 1)
        words = base[start:start + rng.randrange(150, 230)]
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = rng.choice((f"x{rng.randrange(6)}", f"own{i}"))
        docs[i] = " ".join(words)
    docs[90] = " ".join(base)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(*docs.items())).collect()}
    assert got == _components_by_hand(docs)[0]


def test_texts_that_meet_nothing_stay_where_they_are(spark, documents, monkeypatch):
    """Also with too many candidates for a broadcast join, the scan that picks their texts shuffles no text."""
    plans = {}

    def write(df, write=neardup.written):
        out = write(df)
        if set(df.columns) in ({"node", "text"}, {"node", "n_shingles", "registers"}):
            plans[tuple(df.columns)] = df._jdf.queryExecution().executedPlan().toString(), out.count()
        return out

    monkeypatch.setattr(neardup, "written", write)
    docs = {i: " ".join(f"w{i}x{j}" for j in range(30)) for i in range(400)}
    docs |= {1000: docs[7] + " more", 1001: docs[9] + " more"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(*docs.items())).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: i for i in docs} | {1000: 7, 1001: 9}
    assert len(plans) == 2
    for plan, n in plans.values():
        assert "SortMergeJoin" not in plan and 4 <= n < 50


def test_bitmap_keeps_all_keys(spark):
    rows = spark.range(20_000).selectExpr("cast(id as string) AS `a.b`", "id").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    keys = rows.filter("id % 50 = 3").select(F.col("`a.b`").alias("key"))
    found = [r["id"] for r in may_be_in(rows, "a.b", keys).collect()]
    assert len(found) == len(set(found)) and {i for i in range(20_000) if i % 50 == 3} <= set(found) and len(found) < 1_500
    assert may_be_in(rows, "a.b", keys.filter("false")).isEmpty()


def test_workers_remember_few_words():
    """What a stage leaves in a worker stands beside the memory of the next one."""
    shingles._word_hashes.clear()
    tracemalloc.start()
    for at in range(0, 300_000, 1_000):
        shingles.shingle_hashes([b"some-word-%d" % i for i in range(at, at + 1_000)])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 15_000_000


def test_group_that_one_pivot_does_not_reach(spark, documents):
    """A chain in which only neighbours are linked, and a star around a middle document."""
    words = [f"w{i}" for i in range(400)]
    docs = {10 * i: " ".join(words[5 * i: 5 * i + 100]) for i in range(40)}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(*docs.items())).collect()}
    assert got == _components_by_hand(docs)[0]
    assert set(got.values()) == {0}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 1 << 62, 3000).astype(np.uint64), rng.integers(0, 1 << 62, 2000).astype(np.uint64)
    b[:1500] = a[:1500]
    x, y = neardup.registers_of(a), neardup.registers_of(b)
    assert (np.maximum(x, y) == neardup.registers_of(np.union1d(a, b))).all()
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    found = neardup.estimates(np.array([3000.0]), np.array([2000.0]), np.array([(x > y).sum()]), np.array([(x < y).sum()]))
    assert abs(found[0] - truth) < 0.15


# Contamination


def test_contamination_against_brute_force(spark, documents):
    random.seed(6)
    items = {i: " ".join(f"v{random.randint(0, 3000)}" for _ in range(n)) for i, n in enumerate([1, 3, 5, 8, 20, 60, 400])}
    items[50], items[51] = "  ", None
    docs = {}
    for i in range(60):
        words = [f"v{random.randint(0, 3000)}" for _ in range(random.choice([3, 200, 3000]))]
        if i % 2:
            part = items[i % 7].split()
            cut = part[: max(1, int(len(part) * random.choice([0.5, 0.8, 1])))]
            at = random.randint(0, len(words))
            words[at:at] = [w.upper() for w in cut]
        docs[i] = "\n".join(words)
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = set()
    for i, text in docs.items():
        for k, item in items.items():
            w = shingles.words_of(item)
            own = shingles.shingle_texts(w)
            if own and 4 * len(own & shingles.shingle_texts(shingles.words_of(text), min(5, len(w)))) >= 3 * len(own):
                if len(shingles.words_of(text)) >= min(5, len(w)):
                    want.add((i, k))
    for block in (contamination.BLOCK_SHINGLES, 50):
        got = contamination.contaminated(documents(*docs.items()), table, block_shingles=block)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    clean = contamination.without_contaminated(documents(*docs.items()), table)
    assert {r["doc_id"] for r in clean.collect()} == set(docs) - {i for i, _ in want}


# Pieces


def _pieces_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library_and_decode(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=_pieces_path())
    random.seed(7)
    texts = [" ".join(random.choice(["the", "Geschwindigkeit", "é", "①", "x=1;", "", "", "\n", "aaaaaaa"]) for _ in range(random.randint(0, 30))) for _ in range(80)]
    texts += ["", " ", "   ", "\n\n", "\ta\t", "z" * 3000, " lead", "trail ", "漢字①" * 50]
    docs = documents(*enumerate(texts))
    for frequent in (pieces.FREQUENT_WORDS, 5, 0):
        whole = pieces.decoded(pieces.encoded(docs, _pieces_path(), frequent_words=frequent), _pieces_path()).collect()
        assert {r["doc_id"]: r["ids"] for r in whole} == {i: model.encode(t) for i, t in enumerate(texts)}
        assert {r["doc_id"]: r["text"] for r in whole} == dict(enumerate(texts))


def test_one_row_a_document_with_the_decoded_text(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=_pieces_path())
    rows = [(1, "the words of a text the"), (1, "the words of a text the"), (1, "another"), (2, ""), (3, None), (4, "a \u2581 b"), (5, "\u6f22 the \u2460 end ")]
    docs = documents(*rows)
    for frequent in (pieces.FREQUENT_WORDS, 2, 0):
        found = pieces.round_trips(docs, _pieces_path(), frequent_words=frequent).collect()
        assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted((i, model.encode(t or "")) for i, t in rows)
        assert sorted(r["copy"] for r in found if r["doc_id"] == 1) == [1, 1, 2]
        assert all(r["n_pieces"] == len(r["ids"]) for r in found)
        want = sorted((i, (t or "").replace("\u2581", " "), i != 4) for i, t in rows)
        assert sorted((r["doc_id"], r["text"], r["same_text"]) for r in found) == want
    by_query = pieces.stage(spark, docs, "")
    assert by_query.count() == len(rows) and "same_text" in by_query.columns


def test_packed_texts_are_shuffled_once(spark, documents):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = pieces.encoded(documents((1, "some words here"), (None, "no id")), _pieces_path(), frequent_words=1)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    # Texts, rare words, word table, gaps: one exchange each.
    assert plan.count("Exchange hashpartitioning") == 4


def test_packed_in_the_order_of_frequency_is_smaller_and_the_same(spark, documents):
    own = pieces.load_pieces(_pieces_path())
    random.seed(10)
    rare_ids = ["漢", "字", "é", "ñ", "!!", "zw", "q", "①", "the"]
    docs = documents(*((i, " ".join(random.choice(rare_ids) for _ in range(400))) for i in range(40)))
    words = pieces.word_table(docs, _pieces_path())
    order = pieces.piece_order(words, own)
    assert sorted(order.tolist()) == own.all_ids.tolist()
    found = []
    for by in (None, order):
        for frequent in (pieces.FREQUENT_WORDS, 3):
            packed = pieces.encoded(docs, _pieces_path(), frequent_words=frequent, words=words, order=by)
            size = packed.agg(F.sum(F.octet_length("packed"))).first()[0]
            found.append((size, {r["doc_id"]: r["ids"] for r in pieces.decoded(packed, _pieces_path(), by).collect()}))
    assert all(ids == found[0][1] for _, ids in found)
    assert found[2][0] < 0.85 * found[0][0] and found[3][0] < found[1][0]


def test_word_table_is_made_in_small_parts_and_leaves_no_shuffle_files(spark, documents, monkeypatch):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    monkeypatch.setattr(pieces, "LATTICE_BYTES", "16k")
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    settings = [spark.conf.get(key) for key in keys]
    random.seed(11)
    docs = documents(*((i, " ".join("".join(random.choice("abcdefg") for _ in range(5)) for _ in range(200))) for i in range(100)))
    before, least = shuffled(), "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    usual = spark.conf.get(least)
    spark.conf.set(least, "16k")
    try:
        words = pieces.word_table(docs, _pieces_path())
    finally:
        spark.conf.set(least, usual)
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert [spark.conf.get(key) for key in keys] == settings
    assert words.select(F.input_file_name()).distinct().count() > 4  # the session's shuffle partitions


def test_texts_are_cut_in_bounded_parts():
    import pyarrow as pa

    texts = ["the end", "", None, "x" * 3 * pieces.CUT_BYTES, "é of ① " * 50_000, "a", ""]
    parts = list(pieces._cut(pa.record_batch({"text": texts}), 0))
    assert [t for part in parts for t in part.column(0).to_pylist()] == texts
    assert all(part.num_rows == 1 or sum(len((t or "").encode()) for t in part.column(0).to_pylist()) <= pieces.CUT_BYTES for part in parts)


def test_fold_equals_merging():
    own = pieces.load_pieces(_pieces_path())
    random.seed(8)
    for _ in range(3000):
        word = "".join(random.choice("abcdethinosr▁éü01.,①") for _ in range(random.randint(1, 24)))
        edges = [(i, j) for i in range(len(word)) for j in range(i + 1, min(len(word), i + own.longest) + 1) if word[i:j] in own.ids]
        assert own.path_of(word, edges) == own.merged(word)


def test_higher_order_fold_equals_merging(spark):
    own = pieces.load_pieces(_pieces_path())
    random.seed(9)
    letters = ["abcdethinosr▁éü01.,①", "ab", "the▁", "漢①é"]
    words = {"".join(random.choice(kind) for _ in range(random.randint(1, pieces.LONG_WORD))) for kind in letters for _ in range(300)}
    words |= {"a" * pieces.LONG_WORD, "▁", "①", "\u0001", "😀"}
    found = pieces.encoded_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), own).collect()
    assert {r["word"]: r["ids"] for r in found} == {w: own.ids_of(own.merged(w)) for w in words}


def test_hosts_of_either_case_are_one_site(spark):
    rows = [(f"http://{'Shop' if n % 2 else 'shop'}.Example/{n}", f"menu\npage {n}") for n in range(8)] + [("none", "menu"), (None, "menu")]
    df = spark.createDataFrame(rows, "url string, text string")
    found = lines.without_boilerplate(df, lines.host_of(F.col("url")), F.col("text")).collect()
    assert {(r["site"], r["text"]) for r in found} == {("shop.example", f"page {n}") for n in range(8)} | {(None, "menu")}


# Quality


def _quality_by_hand(text):
    words = [(m.start(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    w = [x for _, x in words]
    spots = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {i + j for i in range(len(w) - 7) if spots[tuple(w[i:i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_quality_counts_against_brute_force(spark, documents):
    random.seed(9)
    texts = ["", "a\nb\na\n\n\n \n ", "x " * 100, "a b c d e f g h " * 2, "\x1c \x85   é"]
    texts += ["".join(random.choice(["a ", "b ", "c\n", "#", "| ", "\t", "dé "]) for _ in range(random.randint(1, 120))) for _ in range(60)]
    got = quality.quality(documents(*enumerate(texts)), quality.fit_lines([])).collect()
    for r in got:
        want = _quality_by_hand(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(10)
    for _ in range(50):
        model = quality.LineModel(rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2)))
        bits = rng.integers(0, 1 << len(quality.FEATURES), 7).tolist()
        scores = quality._matrix(np.array(bits)) @ model.weights

        def value(path):
            states = [(path >> i) & 1 for i in range(7)]
            return sum(scores[i] for i, s in enumerate(states) if s) + sum(model.moves[a, b] for a, b in zip(states, states[1:]))

        best = max(range(128), key=value)
        assert model.decode(bits) == [(best >> i) & 1 for i in range(7)]


def test_quality_keeps_good_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in quality.op7_quality_rules(spark, SF).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.5 * len(bad)


# Secrets


def test_secret_spans(spark, documents):
    token = "q7Zk2Wm9Xr4Tb8Lc1Vd6Hs3Pj5Nf0Gy"
    texts = [
        'API_KEY = "abcdefgh1" and Password:short', f"AKIA{'A' * 12} AKIAB {'f0' * 16} {'f0' * 15}", "", None,
        f"the private credential {token} follows", f"nothing near {token} here", f"key {'the_cat_sat_1_' * 3}", 'tokenſ="abcdefghij"',
    ]
    dictionary = secrets.fit_dictionary(documents(*enumerate(texts)))
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.secret_spans(documents(*enumerate(texts)), dictionary).collect()}
    assert got[0] == [("assign", 0, 20)]
    assert got[1] == [("access", 0, 16), ("hex", 23, 55)]
    assert got[2] == got[3] == got[5] == []
    assert got[4] == [("novel", 23, 23 + len(token))]
    assert got[6] == []
    assert got[7] == []


def test_secret_dictionary_is_counted_over_all_documents(spark, documents):
    late = " ".join(["key"] * 6) + " filler word" * 40 + " the password of the green harbour gate"
    texts = [f"number {i} has a key of oak" for i in range(2600)] + [late, late]
    fitted = secrets.fit_dictionary(documents(*enumerate(texts)))
    assert b"key of oak" in fitted and b"green harbour gate" in fitted and len(fitted) <= secrets.DICTIONARY_BYTES
    assert fitted == secrets.fit_dictionary(documents(*((i + 10**6, t) for i, t in enumerate(texts))))  # ids choose nothing
    once = secrets.fit_dictionary(documents((1, "a key under the mat"), (2, None), (3, "")))
    assert once == b""


# URL filter


def test_rules():
    ordered = [r[1] + r[2] for r in urls._ordered(urls.RULES)]
    # Rules of equal length cannot both fit one url's path, so their order is free.
    assert [ordered[:2], sorted(ordered[2:4]), ordered[4:]] == [["www.example.com/en/", "example.com/en/"], ["net/es/", "net/fr/"], ["com/"]]


def test_trust_and_distrust_against_brute_force(spark):
    random.seed(11)
    hosts = [f"h{i}.{random.choice(['com', 'net', 'org'])}" for i in range(25)]
    pages = []
    for n in range(150):
        src = random.choice(hosts[:12])
        links = "".join(f'<a href="{random.choice(["http://", "//", "HTTPS://"])}{random.choice(hosts).upper()}/x">' for _ in range(3)) + '<a href="/y">'
        pages.append((n, f"http://{src}/{random.choice(['es', 'en', 'fr'])}/{n}", links))
    pages += [(900, None, None), (901, "no url", "<a href=''>"), (902, "http://lonely.org?x", None)]
    rules = (("allow", "com", "/"), ("block", "net", "/"))
    got = {r["page_id"]: r for r in urls.judged_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), rules=rules).collect()}
    edges = Counter()
    for _, url, html in pages:
        src = re.match(r"http://([^/]*)", url or "")
        for link in re.findall(r'href="([^"]*)"', html or ""):
            dst = re.match(r"(?i)(?:https?:)?//([^/]*)", link)
            if src and dst and dst[1].lower() != src[1]:
                edges[src[1], dst[1].lower()] += 1
    pages_of = Counter(re.match(r"http://([^/?]*)", u)[1] for _, u, _ in pages if u and "://" in u)

    def spread(seeds, moves):
        total = Counter()
        for (a, _), n in moves.items():
            total[a] += n
        rank = dict(seeds)
        for _ in range(urls.ITERATIONS):
            new = dict(seeds)
            for (a, b), n in moves.items():
                if a in rank:
                    new[b] = new.get(b, 0) + urls.DAMPING * rank[a] * n / total[a]
            rank = new
        return rank

    trust = spread({h: 0.15 for h in pages_of if h.endswith(".com")}, edges)
    distrust = spread({h: 0.15 for h in pages_of if h.endswith(".net")}, Counter({(b, a): n for (a, b), n in edges.items()}))
    for n, url, _ in pages:
        host = got[n]["host"]
        assert got[n]["trust"] == pytest.approx(trust.get(host, 0)) and got[n]["distrust"] == pytest.approx(distrust.get(host, 0))
        t, d = trust.get(host, 0), distrust.get(host, 0)
        want = "allow" if host.endswith(".com") else "block" if host.endswith(".net") else "block" if d >= urls.DISTRUST and d > t else "allow"
        assert got[n]["verdict"] == want
    assert {r["verdict"] for r in got.values() if r["rule"] is None} == {"allow", "block"}
    assert (got[900]["host"], got[900]["path"], got[902]["path"]) == ("", "", "")
