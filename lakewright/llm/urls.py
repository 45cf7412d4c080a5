"""URL filter: rules, and trust and distrust propagated over links between hosts.

DataFrame functions only. Where no rule fits a url, its host decides: personalised PageRank from
trusted seeds along the links gives trust, the same from blocked seeds against the links gives
distrust, and a host whose distrust is high enough and above its trust is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import ascii_lower, picked, table
from lakewright.session import written

#: Verdict, host and path of the rules of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

DAMPING = 0.85
ITERATIONS = 12

#: A host is a seed when rules give this share of its pages one verdict.
SEED_SHARE = 0.5

#: Distrust from which a host is blocked, if it is also above its trust. A blocked seed has 0.15.
DISTRUST = 0.05

#: Iterations between two written results, which cut the lineage.
WRITE_EVERY = 4

_LINK = r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ordered(rules) -> list[tuple[str, str, str]]:
    """The longest rule first; among equally long ones the one with the longer host, then block."""
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r[1:]))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits, as text, and its verdict; nulls where none fits. The list of rules is
    part of the plan, so it should stay within some thousand."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(_ordered(rules)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``links``: links between different hosts, from (url, html). Relative links
    stay on their host and make no edge."""
    links = F.regexp_extract_all("html", F.lit(_LINK), 1)
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("link"))
        .select("src", host_of(target).alias("dst"))
        .filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def propagated(seeds: DataFrame, edges: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING) -> DataFrame:
    """``host``, ``trust``, ``distrust`` of every host that some mass reaches.

    ``seeds``: host, trust, distrust (1 where the host is such a seed). Trust runs from a host to
    those it links to, distrust from a host to those that link to it, each in proportion to the
    links; mass of a host without further links ends there. Both run in one frame, told apart by
    ``kind``. What an edge or a rank adds is summed before it is shuffled.
    """
    out_total = edges.groupBy("src").agg(F.sum("links").alias("total"))
    in_total = edges.groupBy("dst").agg(F.sum("links").alias("total"))
    forward = edges.join(out_total, "src").select(
        F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("links") / F.col("total")).alias("share")
    )
    backward = edges.join(in_total, "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), (F.col("links") / F.col("total")).alias("share")
    )
    moves = written(forward.unionByName(backward))
    restart = written(
        seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "mass"))
        .filter("mass > 0").select("kind", "host", (F.lit(1 - damping) * F.col("mass")).alias("mass"))
    )
    ranks = restart
    for step in range(1, iterations + 1):
        sent = ranks.join(moves, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.lit(damping) * F.col("mass") * F.col("share")).alias("mass")
        )
        ranks = sent.unionByName(restart).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if step % WRITE_EVERY == 0:
            ranks = written(ranks)
    of = {kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0)).alias(kind) for kind in ("trust", "distrust")}
    return ranks.groupBy("host").agg(of["trust"], of["distrust"])


def judged_urls(
    df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", rules=RULES,
    iterations: int = ITERATIONS, seed_share: float = SEED_SHARE, distrust: float = DISTRUST,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust`` of every row.

    A null url or one without ``://`` has empty host and path, fits no rule and is allowed. Null
    pages have no links. Repeated rows stay separate and count each as a page.
    """
    pages = picked(df, page_id=id_column, url=url_column, html=html_column)
    host, path = F.col("host"), F.col("path")
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_for(host, path, rules)
    judged = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    n = F.count("*")
    share = {kind: F.count(F.when(F.col("ruled") == kind, 1)) / n for kind in ("allow", "block")}
    seeds = judged.filter(host != "").groupBy("host").agg(
        (share["allow"] >= seed_share).cast("double").alias("trust"), (share["block"] >= seed_share).cast("double").alias("distrust")
    )
    # A host half allowed and half blocked is no seed of either.
    both = (F.col("trust") > 0) & (F.col("distrust") > 0)
    seeds = seeds.select("host", *(F.when(both, 0.0).otherwise(F.col(c)).alias(c) for c in ("trust", "distrust")))
    scores = propagated(seeds, host_edges(pages), iterations)
    method = F.when((F.col("distrust") >= distrust) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    joined = judged.join(scores, "host", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust")})
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    link = _LINK.replace("'", "''")
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", k, h + p) for k, h, p in _ordered(RULES)]
    rule = " ".join(f"WHEN {f} THEN '{text}'" for f, _, text in fits)
    ruled = " ".join(f"WHEN {f} THEN '{kind}'" for f, kind, _ in fits)
    steps = "".join(
        f""",
r{i} AS MATERIALIZED (SELECT kind, host, sum(mass) AS mass FROM (
  SELECT kind, "to" AS host, {DAMPING} * mass * share AS mass FROM r{i - 1} JOIN moves USING (kind, host)
  UNION ALL SELECT * FROM r0) GROUP BY ALL)"""
        for i in range(1, ITERATIONS + 1)
    )
    return f"""
WITH parts AS (SELECT page_id, html, coalesce({lower("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
                      coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM parts),
share AS (SELECT host, count(*) FILTER (ruled = 'allow') / count(*) >= {SEED_SHARE} AS a,
                 count(*) FILTER (ruled = 'block') / count(*) >= {SEED_SHARE} AS b FROM judged WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM parts),
ends AS (SELECT src, coalesce({lower("regexp_extract(CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END, '://([^/?#]*)', 1)")}, '') AS dst FROM links),
edges AS (SELECT src, dst, count(*) AS links FROM ends WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
moves AS MATERIALIZED (
  SELECT 'trust' AS kind, src AS host, dst AS "to", links / sum(links) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL SELECT 'distrust', dst, src, links / sum(links) OVER (PARTITION BY dst) FROM edges),
r0 AS MATERIALIZED (
  SELECT 'trust' AS kind, host, {1 - DAMPING} AS mass FROM share WHERE a AND NOT b
  UNION ALL SELECT 'distrust', host, {1 - DAMPING} FROM share WHERE b AND NOT a){steps},
score AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS d
          FROM r{ITERATIONS} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN d >= {DISTRUST} AND d > t THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN score s ON j.host = s.host"""


QUERIES = {"op1_url_filter": (op1_url_filter, _sql())}
