"""Merkle manifest of a dataset, with proofs acquired by a butterfly exchange.

The rows of each group (a source) are the leaves of a tree in which every ``FANOUT`` consecutive nodes
become one; the groups' roots are the leaves of a second tree of the same kind. Rows are dealt to aligned
blocks of ``FANOUT ** 2`` leaves, the partitions of the exchange. A block hashes its own subtree, then
aligned groups of ``FANOUT`` blocks swap their subtree roots, then groups of ``FANOUT`` such groups, and
so on. Every block hashes the ancestors of its group itself, so after the last round each one holds its
upper siblings and the root, and nothing is passed down again.

DataFrame functions only. Text is read once, for the leaf; only digests move.

Rows with equal ids stand in the order of their leaf digests, null ids first. Null and empty groups are
groups of their own. An empty table gives no rows. All other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.llm.common import ascii_lower, picked, table
from lakewright.session import written

FANOUT = 16

#: Levels of the tree that a block holds itself.
BLOCK_LEVELS = 2
BLOCK = FANOUT**BLOCK_LEVELS

#: Blocks of a group that share one copy of what the group's root brings.
SPAN = 4096


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``grp``, ``id``, ``leaf`` and more) with ``at``, the place in the group, and ``n``, the
    group's size. Rows are sorted over all partitions, so a group may be spread over many."""
    order = [F.col("grp"), F.col("id").asc_nulls_first(), F.col("leaf")]
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("tie"))
    stored = written(ranged.withColumn("part", F.spark_partition_id()).drop("tie"))
    sizes = stored.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"))
    by_part = Window.partitionBy("grp").orderBy("part")
    sizes = sizes.select(
        "grp", "part",
        (F.sum("here").over(by_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")).alias("before"),
        F.sum("here").over(Window.partitionBy("grp")).alias("n"),
    )
    within = Window.partitionBy("grp", "part").orderBy(*order[1:])
    return (
        stored.join(sizes, ["grp", "part"])
        .withColumn("at", F.col("before") + F.row_number().over(within) - 1)
        .drop("part", "before")
    )


def butterfly(nodes: DataFrame, most: int) -> DataFrame:
    """``grp``, ``i``, ``n``, ``root`` and ``proof`` of every node (``grp``, ``i``, ``n``, ``d``): ``proof`` has per
    level the digests left and right of the own one in its run, ``root`` is the group's.

    In a round each node swaps with the nodes of its aligned group that stand at the same place of their
    subgroups. Where the last subgroup is short, its nodes stand in for the missing ones by turns.
    ``most`` is the size of the largest group.
    """
    state = nodes.select(
        "grp", "i", "n", "d", F.array().cast("array<struct<left:string,right:string>>").alias("proof")
    )
    size = 1
    while size < most:
        wide = size * FANOUT
        low, start = F.col("i") % size, F.col("i") - F.col("i") % wide
        held = F.least(F.lit(size).cast("long"), F.col("n") - (F.col("i") - low))
        state = state.withColumns({"low": low, "start": start, "held": held})
        places = F.expr(f"sequence(low, {size - 1}L, held)")
        to = F.flatten(F.transform(
            F.sequence(F.lit(0), F.lit(FANOUT - 1)),
            lambda e: F.transform(places, lambda p: F.col("start") + e * F.lit(size).cast("long") + p),
        ))
        sent = state.select(
            "grp", "n", F.explode(to).alias("to"), "i",
            ((F.col("i") - F.col("start")) / size).cast("int").alias("sub"), "d", "proof",
        ).where(F.col("to") < F.col("n"))
        own = F.col("to") == F.col("i")
        run = F.transform(F.array_sort(F.collect_list(F.struct("sub", "d"))), lambda m: m["d"])
        got = sent.groupBy("grp", "to").agg(
            F.max("n").alias("n"), run.alias("run"), F.max(F.when(own, F.col("sub"))).alias("sub"),
            F.first(F.when(own, F.col("proof")), ignorenulls=True).alias("proof"),
        )
        sides = F.struct(
            joined(F.slice("run", F.lit(1), F.col("sub"))).alias("left"),
            joined(F.slice("run", F.col("sub") + 2, F.lit(FANOUT))).alias("right"),
        )
        grown = F.col("n") > size  # a group of one node at this level is done
        state = got.select(
            "grp", F.col("to").alias("i"), "n",
            F.when(grown, F.sha2(joined(F.col("run")), 256)).otherwise(F.col("run")[0]).alias("d"),
            F.when(grown, F.concat("proof", F.array(sides))).otherwise(F.col("proof")).alias("proof"),
        )
        size = wide
    return state.withColumnRenamed("d", "root")


def _blocks(leaves: DataFrame) -> tuple[DataFrame, int]:
    """One written row per block of placed leaves: its members in order, the nodes of its first level and
    its digest; and the number of blocks of the largest group."""
    members = F.array_sort(F.collect_list(F.struct("at", *[c for c in leaves.columns if c not in ("grp", "at", "n")])))
    grouped = leaves.groupBy("grp", F.floor(F.col("at") / BLOCK).alias("i")).agg(
        F.max("n").alias("leaves"), members.alias("members")
    )
    runs = F.sequence(F.lit(0), F.floor((F.size("members") - 1) / FANOUT).cast("int"))
    mids = F.transform(runs, lambda j: F.sha2(joined(F.transform(
        F.slice("members", j * FANOUT + 1, F.lit(FANOUT)), lambda m: m["leaf"])), 256))
    stored = written(grouped.withColumn("mids", mids).withColumns({
        "n": F.ceil(F.col("leaves") / BLOCK),
        "d": F.when(F.col("leaves") == 1, F.col("members")[0]["leaf"])
        .when(F.col("leaves") <= FANOUT, F.col("mids")[0])
        .otherwise(F.sha2(joined(F.col("mids")), 256)),
    }))
    return stored, stored.agg(F.max("n")).first()[0] or 0


def _proved(leaves: DataFrame) -> DataFrame:
    """Every leaf with the proof up to its group's ``root``: ``grp``, ``leaf`` and the other columns of the
    leaves, ``i`` of its block, and ``proof`` as pairs of left and right digests."""
    blocks, most = _blocks(placed(leaves))
    upper = written(butterfly(blocks.select("grp", "i", "n", "d"), most)).select("grp", "i", "root", "proof")
    rows = blocks.join(upper, ["grp", "i"]).select(
        "grp", "i", "n", "leaves", "root", "proof", "mids", "members", F.posexplode("members").alias("o", "m")
    )
    run = F.floor(F.col("o") / FANOUT).cast("int")
    inside = F.col("o") % FANOUT

    def leaf_digests(start: Column, length: Column) -> Column:
        return joined(F.transform(F.slice("members", start, length), lambda m: m["leaf"]))

    first = F.struct(
        leaf_digests(run * FANOUT + 1, inside).alias("left"),
        leaf_digests(F.col("o") + 2, F.lit(FANOUT - 1) - inside).alias("right"),
    )
    second = F.struct(
        joined(F.slice("mids", F.lit(1), run)).alias("left"),
        joined(F.slice("mids", run + 2, F.lit(FANOUT))).alias("right"),
    )
    none = F.array().cast("array<struct<left:string,right:string>>")
    local = F.when(F.col("leaves") == 1, none).when(F.col("leaves") <= FANOUT, F.array(first)).otherwise(F.array(first, second))
    return rows.select("grp", "i", "n", "root", F.concat(local, "proof").alias("proof"), "m.*")


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` has ``grp``, ``id``, ``leaf`` and any further columns; adds ``subroot``, ``root`` and ``proof``, the
    pairs of digests left and right of the own node from the leaf's level up to the root."""
    proved = written(_proved(leaves))
    groups = proved.where(F.col("at") == 0).select(
        F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("root").alias("leaf"), F.col("n").alias("blocks")
    )
    tops = _proved(groups).select(
        F.col("id").alias("grp"), F.col("root").alias("top"), F.col("proof").alias("above"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / SPAN))).alias("span"),
    )
    # What a group's root brings is joined by (group, span of blocks), so no group is one key.
    return (
        proved.withColumn("span", F.floor(F.col("i") / SPAN)).join(tops, ["grp", "span"])
        .withColumn("proof", F.concat("proof", "above"))
        .withColumnsRenamed({"root": "subroot", "top": "root"})
        .drop("above", "span", "i", "n", "at")
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "source", "lang", "n_chars", "text")
    docs = picked(table(spark, sf_dir, "documents"), **{n: n for n in names})
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaves = written(docs.select(
        # Null before every source, the empty one included.
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("grp"),
        F.col("doc_id").alias("id"),
        digest(*[field(F.col(n)) for n in names]).alias("leaf"),
        F.when(tampered, digest(*[field(F.col(n)) for n in names[:-1]], field(text))).alias("changed"),
    ))
    both = F.flatten(F.transform("proof", lambda s: F.array(s["left"], s["right"])))
    return manifest(leaves).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(joined(both), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The unsigned CRC-32 of a decimal number, bit by bit over its digits.
_CRC = """xor(list_reduce([4294967295::UBIGINT] || list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::BIGINT, 1))::UBIGINT),
    lambda c, b: list_reduce([xor(c, b)] || [x::UBIGINT FOR x IN range(8)], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END)), 4294967295::UBIGINT)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(_field_sql(n) for n in ("doc_id", "source", "lang", "n_chars"))

#: Trees of both kinds share the recursion: groups are 's' and the source (or '' for null), and the tree
#: of the groups' roots, whose group is 'top'.
ORACLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('s' || source, '') AS source, sha256({_HEAD} || {_field_sql('text')}) AS leaf,
        CASE WHEN {_CRC} % 5 = 0 THEN sha256({_HEAD} || {_field_sql(_LOWER)}) END AS changed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n
    FROM leaves),
nodes AS (
    SELECT source, 0 AS level, pos AS idx, n, leaf AS d FROM placed
    UNION ALL
    SELECT source, level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(d, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16),
subroots AS (
    SELECT source, d AS subroot, row_number() OVER (ORDER BY encode(source)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS level, pos AS idx, n, subroot AS d FROM subroots
    UNION ALL
    SELECT level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(d, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 16),
runs AS (
    SELECT source, level, idx // 16 AS parent, list(d ORDER BY idx) AS run FROM nodes GROUP BY ALL),
top_runs AS (
    SELECT level, idx // 16 AS parent, list(d ORDER BY idx) AS run FROM tops GROUP BY ALL),
walks AS (
    SELECT source, pos, 0 AS level, pos AS idx, n, coalesce(changed, leaf) AS d, '' AS proof FROM placed
    UNION ALL
    SELECT w.source, w.pos, w.level + 1, w.idx // 16, (w.n + 15) // 16,
        sha256(array_to_string(r.run[1:w.idx % 16], '') || w.d || array_to_string(r.run[w.idx % 16 + 2:], '')),
        w.proof || array_to_string(r.run[1:w.idx % 16], '') || array_to_string(r.run[w.idx % 16 + 2:], '')
    FROM walks w JOIN runs r ON r.source = w.source AND r.level = w.level AND r.parent = w.idx // 16 WHERE w.n > 1),
climbs AS (
    SELECT w.source, w.pos, 0 AS level, s.pos AS idx, s.n, w.d, w.proof FROM walks w JOIN subroots s ON s.source = w.source WHERE w.n = 1
    UNION ALL
    SELECT w.source, w.pos, w.level + 1, w.idx // 16, (w.n + 15) // 16,
        sha256(array_to_string(r.run[1:w.idx % 16], '') || w.d || array_to_string(r.run[w.idx % 16 + 2:], '')),
        w.proof || array_to_string(r.run[1:w.idx % 16], '') || array_to_string(r.run[w.idx % 16 + 2:], '')
    FROM climbs w JOIN top_runs r ON r.level = w.level AND r.parent = w.idx // 16 WHERE w.n > 1)
SELECT p.doc_id, p.leaf, s.subroot, t.d AS root, sha256(c.proof) AS proof_sha256, c.d AS folded_root, c.d = t.d AS verified
FROM placed p JOIN subroots s USING (source) JOIN climbs c ON c.source = p.source AND c.pos = p.pos AND c.n = 1
CROSS JOIN (SELECT d FROM tops WHERE n = 1) t
"""

QUERIES = {"op13_merkle_manifest": (op13_merkle_manifest, ORACLE)}
