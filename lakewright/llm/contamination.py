"""Benchmark decontamination: test items found inside documents by MinHash containment.

Items are split by size. Of each item a bottom-k MinHash sketch of its shingles is kept, the whole
set where it is small. A document holds a sketched shingle of an item with the probability that
equals the item's containment, however long the document, so the share of the sketch found in the
document estimates containment; documents where it is high enough are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import filtered, mapped, picked, table
from lakewright.llm.shingles import WIDTH, shingle_hashes, shingle_texts, words_of

CONTAINMENT = 0.75

#: Shingles in a sketch; smaller items are sketched whole.
SKETCH = 24

#: A part of the items is sent to the executors at a time, of about this many shingles and words;
#: with more items there are more passes over the documents.
BLOCK_SHINGLES = 1_000_000


@dataclass
class SizeClass:
    """Items of 2**n up to 2**(n+1) - 1 shingles, and what a document needs to be a candidate."""

    least_shared: int  # of the smallest item: documents with fewer shingles hold none of the class
    needed: dict[int, int] = field(default_factory=dict)  # item -> hits in its sketch


@dataclass
class Block:
    """Sketches and words of some items, as the executors get them."""

    ids: list
    words: list[list[bytes]]
    sketch_hashes: np.ndarray  # sorted
    sketch_items: np.ndarray  # the item each of them belongs to
    widths: np.ndarray  # shingle width of each of them
    classes: dict[int, SizeClass]
    class_of: list[int]
    sizes: list[int]
    filter: np.ndarray  # marks the low bits of sketched hashes, to pass over most shingles quickly

    def leaks(self, text: str | None) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the text holds."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        hits = np.zeros(0, np.int64)
        size = 0
        for width in np.unique(self.widths):
            if len(words) < width:
                continue
            h = shingle_hashes(words, int(width))
            size = max(size, len(h))
            h = np.unique(h[self.filter[h & np.uint64(len(self.filter) - 1)]])
            left, right = np.searchsorted(self.sketch_hashes, h), np.searchsorted(self.sketch_hashes, h, "right")
            for a, b in zip(left[left < right], right[left < right]):
                hits = np.concatenate([hits, self.sketch_items[a:b][self.widths[a:b] == width]])
        if not len(hits):
            return []
        items, found = np.unique(hits, return_counts=True)
        out, own = [], {}
        for item, n in zip(items.tolist(), found.tolist()):
            group = self.classes[self.class_of[item]]
            if size < group.least_shared or n < group.needed[item]:
                continue
            width = min(WIDTH, len(self.words[item]))
            if width not in own:
                own[width] = shingle_texts(words, width)
            shared = len(shingle_texts(self.words[item], width) & own[width])
            if shared >= CONTAINMENT * self.sizes[item]:
                out.append((item, shared))
        return out


def block_of(items: list[tuple]) -> Block:
    ids, words, hashes, owners, widths, class_of, sizes = [], [], [], [], [], [], []
    classes: dict[int, SizeClass] = {}
    for i, text in items:
        w = words_of(text)
        if not w:
            continue  # nothing to find
        k = len(ids)
        h = np.unique(shingle_hashes(w))
        sketch = h[:SKETCH]  # the lowest hashes: a bottom-k sketch
        size = len(h)
        name = size.bit_length() - 1
        least = math.ceil(CONTAINMENT * size)
        group = classes.setdefault(name, SizeClass(least))
        group.least_shared = min(group.least_shared, least)
        # A small set is its own sketch. Else a third of the expected hits is enough: an item with
        # the least containment misses it less than once in a million times.
        group.needed[k] = least if size <= SKETCH else math.ceil(SKETCH * CONTAINMENT / 3)
        ids.append(i)
        words.append(w)
        class_of.append(name)
        sizes.append(size)
        hashes.append(sketch)
        owners.append(np.full(len(sketch), k))
        widths.append(np.full(len(sketch), min(WIDTH, len(w))))
    all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(all_hashes)
    marks = np.zeros(1 << max(16, (16 * len(all_hashes)).bit_length()), bool)
    marks[all_hashes & np.uint64(len(marks) - 1)] = True
    return Block(
        ids, words, all_hashes[order], np.concatenate(owners)[order] if owners else np.zeros(0, np.int64),
        np.concatenate(widths)[order] if widths else np.zeros(0, np.int64), classes, class_of, sizes, marks,
    )


def item_blocks(items: DataFrame, id_column: str = "item_id", text_column: str = "text", block_shingles: int = BLOCK_SHINGLES) -> Iterator[Block]:
    """The items in parts of bounded size, one after the other; each part passes the driver."""
    rows = picked(items, item_id=id_column, text=text_column).filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.size(F.split("text", r"[ \t\n\x0b\f\r]+")))).first()[0] or 0
    parts = max(1, math.ceil(total / block_shingles))
    for part in range(parts):
        found = rows.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        yield block_of(sorted(((r["item_id"], r["text"]) for r in found), key=repr))


def contaminated(
    df: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shingles``, ``n_shared``, ``containment``: the items of which a
    document holds three quarters of the distinct five-word shingles or more.

    Items of fewer words count as one shingle of that many. Null texts and texts without words hold
    nothing and are in nothing. Repeated rows, of documents or of items, give repeated results.
    """
    spark = df.sparkSession
    rows = picked(df, doc_id=id_column, text=text_column)
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema[item_column].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, n_shingles long, n_shared long, containment double"
    out = None
    for block in item_blocks(items, item_column, item_text_column, block_shingles):
        shared = spark.sparkContext.broadcast(block)

        def run(columns: list[list], shared=shared) -> Iterator[tuple]:
            b = shared.value
            for i, text in zip(*columns):
                for item, n in b.leaks(text):
                    yield i, b.ids[item], b.sizes[item], n, n / b.sizes[item]

        found = mapped(rows, run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no item."""
    spark = docs.sparkSession
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)
        docs = filtered(docs, text_column, lambda texts, shared=shared: [not shared.value.leaks(t) for t in texts])
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _shingles_sql(source: str, key: str) -> str:
    """Distinct shingles of up to five words, with their width, in DuckDB SQL."""
    return f"""
    SELECT DISTINCT {key}, least(5, len(w)) AS width, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
    FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - least(5, len(w)) + 2, 1))) AS i
          FROM (SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^ \\t\\n\\x0b\\f\\r]+') AS w FROM {source})
          WHERE len(w) > 0)"""


_SQL = f"""
WITH item AS ({_shingles_sql('benchmark', 'item_id')}),
     size AS (SELECT item_id, count(*) AS n FROM item GROUP BY item_id),
     doc AS ({_shingles_sql('documents', 'doc_id')}),
     held AS (SELECT doc_id, item_id, count(*) AS shared FROM doc JOIN item USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, shared AS n_shared, shared / n AS containment
FROM held JOIN size USING (item_id) WHERE 4 * shared >= 3 * n"""

QUERIES = {"op10_decontamination": (op10_decontamination, _SQL)}
