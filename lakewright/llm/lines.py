"""Line deduplication by site: lines that a large share of a site's pages hold are boilerplate.

DataFrame functions only. Lines are compared without white space at their ends, by two 64-bit
hashes. A site has at most (lines a page) / ``ratio`` boilerplate lines, so their hashes fit in one
array a site; each row is joined with that array and filtered in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import UPPER, ascii_lower, quoted, table
from lakewright.session import written

#: A line goes when it is on more than this share of the pages of its site ...
RATIO = 0.1
#: ... and on at least this many of them.
LEAST_PAGES = 5

_WHITE = " \t\n\x0b\f\r"

#: Parts of a page that are not text, and tags that end a line.
_NOT_TEXT = r"(?is)<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|<!--.*?-->"
_LINE_TAGS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|"
    r"li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
_TAGS = r"<[^>]*>"
_BREAKS = r"[ \t\x0b\f\r]*\n[ \t\n\x0b\f\r]*"


def page_text(html: Column) -> Column:
    """The text of a page: a line for each block, without empty lines."""
    text = F.regexp_replace(html, _NOT_TEXT, "")
    text = F.regexp_replace(F.regexp_replace(text, _LINE_TAGS, "\n"), _TAGS, "")
    return F.btrim(F.regexp_replace(text, _BREAKS, "\n"), F.lit(_WHITE))


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_WHITE))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b")))


def boilerplate_lines(rows: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``site`` and ``boilerplate``, the hashes of its boilerplate lines, from (site, text) rows.
    Rows without a site take no part. A page counts once for a line, repeated rows count each."""
    rows = rows.filter(F.col("site").isNotNull())
    keys = F.array_distinct(F.transform(F.split("text", "\n"), _key))
    held = (
        rows.select("site", F.explode(keys).alias("line")).filter(F.col("line").isNotNull())
        .groupBy("site", "line").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    )
    totals = rows.groupBy("site").agg(F.count("*").alias("total"))
    return (
        held.join(totals, "site").filter(F.col("pages") > F.lit(ratio) * F.col("total"))
        .groupBy("site").agg(F.collect_list("line").alias("boilerplate"))
    )


def without_boilerplate(
    df: DataFrame, site: Column, text: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """All columns of ``df`` in ``row``, a struct, and ``site``, ``text`` without boilerplate,
    ``n_lines`` (lines with anything on them) and ``n_dropped``.

    Null texts stay null with no lines; rows without a site stay as they are; a text may become
    empty; empty tables give no rows.
    """
    whole = F.struct(*(F.col(quoted(c)) for c in df.columns)).alias("row")
    rows = df.select(whole, site.alias("site"), text.alias("text"))
    found = boilerplate_lines(rows.select("site", "text"), ratio, least_pages)
    lines = F.split("text", "\n")
    joined = rows.join(found, "site", "left").select("row", "site", lines.alias("lines"), "boilerplate")
    clean = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.coalesce(F.array_contains(F.col("boilerplate"), _key(line)), F.lit(False)))
    )

    def filled(lines: Column) -> Column:
        return F.coalesce(F.size(F.filter(lines, lambda line: F.btrim(line, F.lit(_WHITE)) != "")), F.lit(0))

    kept = joined.select("row", "site", "lines", clean.alias("kept"))
    return kept.select(
        "row", "site", F.array_join("kept", "\n").alias("text"),
        F.greatest(filled(F.col("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(filled(F.col("lines")) - filled(F.col("kept")), F.lit(0)).cast("long").alias("n_dropped"),
    )


def host_of(url: Column) -> Column:
    """A-Z lower-cased; null where there is none."""
    return F.nullif(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written, so that the text is taken out of the html once for both uses.
    pages = written(table(spark, sf_dir, "pages").select("page_id", "url", page_text(F.col("html")).alias("text")))
    found = without_boilerplate(pages, host_of(F.col("url")), F.col("text"))
    return found.select(F.col("row.page_id").alias("page_id"), F.col("site").alias("host"), "n_lines", "n_dropped", "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat over their source, which stands for the site."""
    found = without_boilerplate(docs, F.col("source"), F.col("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*(changed.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns))



_SQL = f"""
WITH p AS (
  SELECT page_id, nullif(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}'), '') AS host,
         trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '{_NOT_TEXT}', '', 'g'),
           '{_LINE_TAGS}', chr(10), 'g'), '{_TAGS}', '', 'g'), '{_BREAKS}', chr(10), 'g'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text
  FROM pages),
l AS (SELECT page_id, host, string_split(text, chr(10)) AS lines FROM p),
held AS (SELECT host, line, count(*) AS n
         FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM l WHERE host IS NOT NULL) WHERE line <> '' GROUP BY ALL),
total AS (SELECT host, count(*) AS t FROM l WHERE host IS NOT NULL GROUP BY host),
boiler AS (SELECT host, list(line) AS b FROM held JOIN total USING (host)
           WHERE n >= {LEAST_PAGES} AND n > {RATIO}::DOUBLE * t GROUP BY host),
k AS (SELECT page_id, host, lines, CASE WHEN b IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(b, x)) END AS kept
      FROM l LEFT JOIN boiler USING (host))
SELECT page_id, host, len(list_filter(lines, lambda x: x <> '')) AS n_lines,
       len(list_filter(lines, lambda x: x <> '')) - len(list_filter(kept, lambda x: x <> '')) AS n_dropped,
       array_to_string(kept, chr(10)) AS text
FROM k"""

QUERIES = {"op5_line_dedup": (op5_line_dedup, _SQL)}
