"""Near-duplicate documents by SetSketch registers.

A sketch holds, for each of its registers, the minimum of a hash over the document's shingles,
turned into an exponential variate and truncated to a power of ``BASE``: registers of a union are
the larger ones of two sketches, and two sketches agree in a register with about the probability
that is the similarity of the sets. Documents that agree in all registers of a band meet in a
bucket; the likelihood of the registers, given the sizes of both sets, estimates their similarity,
and pairs near the limit or above are compared shingle by shingle.

No bucket is expanded into all its pairs. Exact copies are one node. Of each bucket all members are
compared with its pivot first, the node that meets most others over all buckets. A pivot and a band
name a bucket, so the buckets of one pivot are kept as one group, in which a member is one row with a
bit for each band. Members that are left outside the pivot's component are then compared with those they
share a bucket with, once for all these buckets, in rounds, and only across components: within one,
nothing is to be won. In a group the shingles have one order: first those beyond the pivot, the
rarest of the group foremost, then the pivot's. Two members that may be linked share one so early
that enough of both sets is still to come, so members meet by the early shingles that they share, and
by nothing else: rejected variants of a text, whose first shingles are their own, make no pairs, and a
large group is spread over its shingles.

Texts and sketches are shuffled only for nodes that share a bucket, and in a round only for those of its
pairs: a bitmap of their ids picks them where they lie.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.llm.common import mapped, may_be_in, picked, quoted, table
from lakewright.llm.shingles import shingle_hashes, shingle_texts, words_of
from lakewright.session import written

#: Link where 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75

#: Forty bands of four registers: two sets at the limit share no bucket once in four million times.
BANDS = 40
BAND_REGISTERS = 4
REGISTERS = BANDS * BAND_REGISTERS

#: Base and scale of the registers, which fit in 16 bits.
BASE = 1.001
SCALE = 20.0

#: Pairs whose estimate is this far below the limit are not compared; the estimate's standard
#: deviation is below 0.04.
MARGIN = 0.2

#: Sizes of sets in one class differ by less than this factor.
SIZE_STEP = 1.06

#: In round n the members of ranks below this to the power of n are compared with their group.
ROUND_GROWTH = 16

_random = np.random.default_rng(20_240_229)
_FACTORS = _random.integers(0, 1 << 63, REGISTERS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, REGISTERS, np.int64).astype(np.uint64)


def registers_of(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):
        part = hashes[at:at + 256, None]
        np.minimum(least, ((part + _OFFSETS) * _FACTORS).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16))
    values = np.floor(1 - np.log(exponential / SCALE) / math.log(BASE))
    return np.clip(values, 0, 65_535).astype(np.uint16)


def estimates(n_a: np.ndarray, n_b: np.ndarray, more: np.ndarray, fewer: np.ndarray) -> np.ndarray:
    """The likeliest similarities. ``more`` and ``fewer``: registers in which a is above, below b."""
    grid = np.linspace(0, 1, 101)[None, :]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u

    def above(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    a, b = above(u - v * grid), above(v - u * grid)
    equal = np.clip(1 - a - b, 1e-12, 1)
    same = REGISTERS - more - fewer
    score = more[:, None] * np.log(a) + fewer[:, None] * np.log(b) + same[:, None] * np.log(equal)
    possible = grid <= np.minimum(u / v, v / u) + 1e-9
    return grid[0][np.argmax(np.where(possible, score, -np.inf), axis=1)]


def sketches(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set and ``registers``, null without shingles."""
    import xxhash

    rows = picked(df, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(columns: list[list]) -> list[tuple]:
        out = []
        for i, text in zip(*columns):
            h = np.unique(shingle_hashes(words_of(text)))
            if len(h):
                out.append((i, len(h), xxhash.xxh3_128_digest(h.tobytes()), registers_of(h).tobytes()))
            else:
                out.append((i, 0, None, None))
        return out

    return mapped(rows, run, f"doc_id {kind}, n_shingles long, digest binary, registers binary")


def _band_keys(registers: Column) -> Column:
    width = 2 * BAND_REGISTERS
    return F.array(*(F.xxhash64(F.lit(band), F.substring(registers, band * width + 1, width)) for band in range(BANDS)))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _likely(pairs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and whose estimated similarity is high enough."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a").filter(
        100 * F.least("n_a", "n_b") >= SIMILARITY * F.greatest("n_a", "n_b")
    ).select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(columns: list[list]) -> list[tuple]:
        a, b, n_a, n_b, r_a, r_b = columns
        x, y = (np.frombuffer(b"".join(r), np.uint16).reshape(-1, REGISTERS) for r in (r_a, r_b))
        found = estimates(np.array(n_a, float), np.array(n_b, float), (x > y).sum(axis=1), (x < y).sum(axis=1))
        return [(i, j) for i, j, e in zip(a, b, found) if e >= SIMILARITY / 100 - MARGIN]

    return mapped(both, run, f"a {kind}, b {kind}")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("t_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("t_a")), "a").select("a", "b", "t_a", "t_b")
    )


def _linked(shared: int, n_a: int, n_b: int) -> bool:
    return 100 * shared >= SIMILARITY * (n_a + n_b - shared)


def _verified(pairs: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """Pairs whose shingle sets are similar enough, compared as texts."""
    def run(columns: list[list]) -> list[tuple]:
        out, last, set_a = [], None, set()
        for a, b, t_a, t_b in zip(*columns):
            if last is None or t_a != last:  # rows come sorted by a
                last, set_a = t_a, shingle_texts(words_of(t_a))
            set_b = shingle_texts(words_of(t_b))
            if _linked(len(set_a & set_b), len(set_a), len(set_b)):
                out.append((a, b))
        return out

    return mapped(_with_texts(pairs, texts), run, f"a {kind}, b {kind}").distinct()


def _against_pivot(pairs: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """Each pair of a pivot (a) and a member (b), for each text of both: ``linked``, a key of the pivot's text
    (``of``), the member's size and the hashes of its shingles ``beyond`` the pivot's and ``within`` them, as
    many of these as can still be early ones."""
    import xxhash

    def run(columns: list[list]) -> list[tuple]:
        out, last, of, hashes_a, set_a = [], None, 0, None, None
        for a, b, t_a, t_b in zip(*columns):
            if last is None or t_a != last:  # rows come sorted by a
                hashes_a, set_a, last = np.unique(shingle_hashes(words_of(t_a))), None, t_a
                of = xxhash.xxh3_64_intdigest(hashes_a.tobytes()) >> 1
            words = words_of(t_b)
            hashes = np.unique(shingle_hashes(words))
            n = len(hashes)
            known = np.isin(hashes, hashes_a, assume_unique=True)
            beyond, within = hashes[~known], hashes[known]
            linked = _linked(len(within), len(hashes_a), n)
            if linked:  # confirmed on the shingles themselves
                set_a, set_b = set_a or shingle_texts(words_of(t_a)), shingle_texts(words)
                linked = _linked(len(set_a & set_b), len(set_a), len(set_b))
            within = within[:max(0, n - math.ceil(SIMILARITY * n / 100) + 1 - len(beyond))]
            out.append((a, b, linked, of, n, beyond.view(np.int64), within.view(np.int64)))
        return out

    found = mapped(
        _with_texts(pairs, texts), run, f"a {kind}, b {kind}, linked boolean, of long, n long, beyond array<bigint>, within array<bigint>"
    )
    return found.withColumn("entry", F.monotonically_increasing_id())


def _early_shingles(entries: DataFrame) -> DataFrame:
    """``pivot``, ``node``, ``n`` and ``early``: the shingles by which a member (one entry for each of its texts)
    meets others of its group, with the number of its shingles that come from there on (``rest``). Shingles
    that no other entry of the group has only take their places, as the first ones."""
    spread = entries.select("pivot", "entry", F.explode("beyond").alias("shingle"))
    met = spread.groupBy("pivot", "shingle").agg(F.count("*").alias("held")).filter("held > 1")
    ordered = spread.join(met, ["pivot", "shingle"]).groupBy("entry").agg(F.sort_array(F.collect_list(F.struct("held", "shingle")))["shingle"].alias("met"))
    rows = entries.join(ordered, "entry", "left").withColumn("met", F.coalesce("met", F.expr("array()"))).select(
        "pivot", "node", "n", (F.col("n") - F.size("beyond") + F.size("met")).alias("rest"), F.concat("met", "within").alias("shingles")
    )
    early = F.filter(
        F.transform("shingles", lambda shingle, i: F.struct((F.col("rest") - i).alias("rest"), shingle.alias("shingle"))),
        lambda x: 100 * x["rest"] >= SIMILARITY * F.col("n"),
    )
    return rows.select("pivot", "node", "n", early.alias("early")).filter(F.size("early") > 0)


def _enough(rest: Column, sizes: Column) -> Column:
    """Whether ``rest`` shared shingles suffice for two sets of these sizes, added."""
    return (100 + SIMILARITY) * rest >= SIMILARITY * sizes


def _listed(members: DataFrame, last: int) -> DataFrame:
    """``members`` by each of their ``early`` shingles and each class of sizes that a smaller or equal member
    linked with them may have; ``small`` where they are that member themselves. Left out is what meets nobody,
    or only ranks beyond ``last``."""
    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / math.log(SIZE_STEP))

    n, key = F.col("n"), ["pivot", "size", "shingle"]
    least = F.floor(F.pow(F.lit(SIZE_STEP), F.col("size")) * (1 - 1e-9))
    listed = (
        members.withColumn("size", F.explode(F.sequence(size_class(F.ceil(SIMILARITY * n / 100)), size_class(n))))
        .select("pivot", "node", "n", "bands", "rank", "size", F.inline("early"))
        .filter(_enough(F.col("rest"), n + least))
        .withColumn("small", (F.col("size") == size_class(n)) & _enough(F.col("rest"), 2 * n))
    )
    met = listed.groupBy(*key).agg(F.max("small").alias("small"), F.min("node").alias("x"), F.max("node").alias("y"), F.min("rank").alias("rank"))
    return listed.join(met.filter((F.col("rank") <= last) & F.col("small") & (F.col("x") != F.col("y"))), key, "left_semi")


def _meetings(small: DataFrame, large: DataFrame, first: str) -> DataFrame:
    """Pairs of a ``small`` member (a) and a ``large`` one (b) of a group, not smaller, that may be linked: of
    different labels, in a common bucket and with a common early shingle. ``first``, a or b, is the one of the
    lower rank."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        own = (F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "label", "bands", "rank", "rest")))
        return rows.select("pivot", "size", "shingle", *own)

    later = "b" if first == "a" else "a"
    return side(small.filter("small"), "a").join(side(large, "b"), ["pivot", "size", "shingle"]).filter(
        (F.col("n_a") <= F.col("n_b")) & (F.col(f"rank_{first}") < F.col(f"rank_{later}")) & (F.col("label_a") != F.col("label_b"))
        & _enough(F.least("rest_a", "rest_b"), F.col("n_a") + F.col("n_b")) & (F.col("bands_a").bitwiseAND(F.col("bands_b")) != 0)
    ).select("a", "b")


def component_labels(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, of all nodes in ``links`` (a, b).

    Each round takes the smallest label around a node and then that label's own label, so that
    distances about halve; every round is written, which cuts the lineage.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = written(nearer.join(of_label, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels


def _joined_labels(labels: DataFrame, new: DataFrame) -> DataFrame:
    """``labels`` after more links: only the components that these touch are walked again."""
    ends = _ends(new).distinct()
    known = written(labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))))

    def side(name: str) -> DataFrame:
        return known.select(F.col("node").alias(name), F.col("label").alias(f"of_{name}"))

    between = new.join(side("a"), "a").join(side("b"), "b").filter("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    moved = component_labels(between.distinct()).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return written(known.join(moved, "label", "left").select("node", F.coalesce("least", "label").alias("label")))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row.

    Sets are of five-word shingles, A-Z lower-cased; fewer words are one shingle. Null texts and
    texts without words have no shingles and are linked with nothing. Rows that share an id are one
    document with all their texts. Rows without an id take no part: their component is null and
    they are kept. An empty table gives no rows.
    """
    found = written(sketches(df, id_column, text_column))
    kind = found.schema["doc_id"].dataType.simpleString()
    known = found.filter(F.col("doc_id").isNotNull())
    # One node for each distinct set; its smallest document stands for it.
    sets = written(known.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    ))
    nodes = sets.select("node", "n_shingles", "registers")
    placed = nodes.select("node", F.posexplode(_band_keys(F.col("registers"))).alias("band", "bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = written(placed.join(sizes, "bucket"))
    crowds = met.groupBy("node").agg(F.sum("size").alias("crowd"))
    pivots = met.join(crowds, "node").groupBy("bucket").agg(F.max(F.struct("crowd", "node"))["node"].alias("pivot"))
    # Two members that share one of the pivot's buckets share a bit: it has one bucket in each band, for each of its texts.
    band = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("band"))
    members = written(met.join(pivots, "bucket").groupBy("pivot", "node").agg(F.bit_or(band).alias("bands")))
    candidates = written(members.select("node").distinct())
    near = written(may_be_in(nodes, "node", candidates))
    texts = written(may_be_in(picked(df, node=id_column, text=text_column), "node", candidates))
    of_pivot = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    compared = written(_against_pivot(of_pivot, texts, kind))
    tried = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    labels = component_labels(compared.filter("linked").select("a", "b"))

    def labelled(rows: DataFrame) -> DataFrame:
        of_node = labels.select(F.col("node").alias("n_"), "label")
        return rows.join(of_node, rows["node"] == F.col("n_"), "left").drop("n_").withColumn("label", F.coalesce("label", "node"))

    # Members outside the component of their pivot take turns, where their group has more members.
    first = labels.select(F.col("node").alias("pivot"), F.col("label").alias("first"))
    group = labelled(members.filter("node <> pivot")).join(first, "pivot", "left").withColumn("apart", F.col("label") != F.coalesce("first", "pivot"))
    group = written(group.select("pivot", "node", "bands", "apart"))
    unsettled = group.groupBy("pivot").agg(F.count("*").alias("size"), F.max("apart").alias("apart")).filter("apart AND size > 1")
    # Of a pivot with several texts, one orders the shingles.
    of_text = compared.groupBy(F.col("a").alias("pivot")).agg(F.min("of").alias("of"))
    entries = compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "entry", "of", "n", "beyond", "within")
    met = written(_early_shingles(entries.join(unsettled.join(of_text, "pivot").select("pivot", "of"), ["pivot", "of"])))
    turns = met.select("pivot", "node").distinct().join(group.filter("apart"), ["pivot", "node"])
    ranks = written(turns.select("pivot", "node", F.row_number().over(Window.partitionBy("pivot").orderBy("node")).alias("rank")))
    deepest = ranks.agg(F.max("rank")).first()[0] or 0
    ranked = met.join(group.select("pivot", "node", "bands"), ["pivot", "node"]).join(ranks, ["pivot", "node"], "left")
    listed = written(_listed(ranked.withColumn("rank", F.coalesce("rank", F.lit(deepest + 1))), deepest))
    done = 0
    while done < deepest:
        upto = max(ROUND_GROWTH, done * ROUND_GROWTH)
        # A lower rank has had its turn with all of the group.
        rows = written(labelled(listed.filter(F.col("rank") > done)))
        turn = rows.filter(F.col("rank") <= min(upto, deepest))
        across = _meetings(turn, rows, "a").union(_meetings(rows, turn, "b"))
        pairs = written(
            across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        )
        done = upto
        if pairs.isEmpty():
            continue
        tried = tried.union(pairs)
        likely = written(_likely(pairs, may_be_in(near, "node", _ends(pairs)), kind))
        if likely.isEmpty():
            continue
        new = written(_verified(likely, may_be_in(texts, "node", _ends(likely)), kind))
        if not new.isEmpty():
            labels = _joined_labels(labels, new)
    of_set = sets.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("component_id"))
    out = found.join(of_set, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(quoted(c)) for c in docs.columns))


_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \\t\\n\\x0b\\f\\r]+') AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM words WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON other = a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) m USING (doc_id) LEFT JOIN size USING (doc_id)"""

QUERIES = {"op8_minhash_near_dedup": (op8_minhash_near_dedup, _SQL)}
