"""Column profiles of one or many tables.

All statistics come from one frequency table: every cell of every table becomes a
(column, value) row and the rows are counted, values in their own types. The count combines
inside each input partition before it shuffles, so a value or a NULL that fills a third of a
table is one row per partition. Long texts travel as a digest. What is derived per column
afterwards is as small as the schema.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import text as tx
from lakewright.operators.quantiles import exact_quantiles
from lakewright.operators.settings import profiling_settings
from lakewright.session import finer_shuffles, written

# A text of more bytes than this is counted by digest; its first characters stay with it. Both
# only size the frequency table: results are those of whole texts.
LONG_TEXT_BYTES = 128
HEAD_CHARS = 64
# Up to this many distinct numbers a column's quantiles are read from one in-memory map.
SMALL_DISTINCT = 50_000
QUANTILES = [0.25, 0.5, 0.75]

PROFILE_COLUMNS = [
    "total_count", "valid_count", "na_count", "empty_count", "whitespace_count",
    "sentinel_count", "na_pct", "empty_pct", "whitespace_pct", "sentinel_pct",
    "total_missing_count", "total_missing_pct", "valid_pct", "unique_count", "unique_pct",
]


def column_catalog(tables: dict[str, DataFrame], settings: dict) -> list[dict]:
    """One entry per column over all tables; identifiers are known by name alone."""
    exact = {c.lower() for c in settings["identifier_columns"]}
    patterns = [re.compile(p, re.IGNORECASE) for p in settings["identifier_patterns"]]
    out = []
    for table, df in tables.items():
        for ordinal, field in enumerate(df.schema.fields):
            low = field.name.lower()
            out.append({
                "col_id": len(out),
                "table_name": table,
                "variable_name": field.name,
                "ordinal": ordinal,
                "is_identifier": low in exact or any(p.search(low) for p in patterns),
                "is_text": isinstance(field.dataType, T.StringType),
            })
    return out


CATALOG_SCHEMA = (
    "col_id int, table_name string, variable_name string, ordinal int, "
    "is_identifier boolean, is_text boolean"
)


def _catalog_frame(spark: SparkSession, catalog: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(c.values()) for c in catalog], CATALOG_SCHEMA
    )


def cells_by_type(
    tables: dict[str, DataFrame], catalog: list[dict]
) -> dict[str, tuple[T.DataType, DataFrame]]:
    """(col_id, value) rows of all cells, one frame per column type. Values keep their type,
    so each column is read once and only distinct values are ever turned into text."""
    ids = {(c["table_name"], c["variable_name"]): c["col_id"] for c in catalog}
    parts: dict[str, tuple[T.DataType, list[DataFrame]]] = {}
    for table, df in tables.items():
        fields: dict[str, list[T.StructField]] = {}
        for f in df.schema.fields:
            fields.setdefault(_family(f.dataType), []).append(f)
        for family, group in fields.items():
            entries = F.array(*[_cell(f.name, f.dataType) for f in group])
            col_ids = F.array(*[F.lit(ids[table, f.name]) for f in group])
            cells = df.select(F.posexplode(entries).alias("position", "value")).select(
                F.element_at(col_ids, F.col("position") + 1).alias("col_id"), "value"
            )
            kind = group[0].dataType if family != "string" else T.StringType()
            parts.setdefault(family, (kind, []))[1].append(cells)
    return {
        family: (kind, reduce(DataFrame.unionByName, frames))
        for family, (kind, frames) in parts.items()
    }


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(data_type, (T.StringType, T.ArrayType, T.MapType, T.StructType)):
        return "string"
    return data_type.simpleString()


def _cell(name: str, data_type: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    family = _family(data_type)
    if family == "bigint":
        return c.cast("bigint")
    return tx.as_text(c, data_type) if family == "string" else c


def is_long_text(c: Column) -> Column:
    return (
        (F.octet_length(c) > LONG_TEXT_BYTES)
        & (F.octet_length(tx.trim_blanks(c)) > LONG_TEXT_BYTES)
        & ~tx.is_number(c)
    )


def frequencies(cells: dict[str, tuple[T.DataType, DataFrame]], settings: dict) -> DataFrame:
    """How often each column holds each value, with what later steps ask of a distinct value.

    ``value`` is the text of the value; a long text is known by its SHA-256 ``digest``, with
    the start of the text as value and the rest derived from the whole text. ``kind`` is the missingness class, ``number`` the number
    the text spells, ``key`` the upper-cased text of a possible placeholder and ``layouts``
    the date layouts the text fits, one bit each.
    """
    return reduce(
        DataFrame.unionByName,
        [_typed_frequencies(kind, frame, settings) for kind, frame in cells.values()],
    )


def _finite(number: Column) -> Column:
    return F.when(F.abs(number) < float("inf"), number)


def _layout_bits(trimmed: Column) -> Column:
    return F.when(
        trimmed.rlike(tx.MAY_BE_DATE),
        reduce(lambda a, b: a + b, [
            tx.date_layout_match(trimmed, layout).cast("int") * (1 << i)
            for i, layout in enumerate(tx.DATE_LAYOUTS)
        ]),
    ).otherwise(0)


def _typed_frequencies(data_type: T.DataType, cells: DataFrame, settings: dict) -> DataFrame:
    v = F.col("value")
    count = F.count(F.lit(1)).alias("n")
    numeric, strings = _sentinel_lists(settings)
    is_long = F.col("digest").isNotNull()
    if isinstance(data_type, T.StringType):
        # What is asked of a long text is taken from the whole text, before it is cut. It is the
        # same for all texts of a digest, so it is no part of the key.
        facts = {
            "long_white": v.rlike(tx.WHITESPACE_ONLY), "long_layouts": _layout_bits(tx.trim_blanks(v)),
        }
        # Upper case shortens no text to less than a third of its bytes.
        long_keys = [k for k in (*numeric, *strings) if 3 * len(k.encode()) > LONG_TEXT_BYTES]
        if long_keys:
            spelled = F.upper(tx.trim_blanks(v))
            facts["long_key"] = F.when(spelled.isin(*long_keys), spelled)
        counted = cells.withColumn("is_long", is_long_text(v)).select(
            "col_id",
            F.when(F.col("is_long"), F.substring(v, 1, HEAD_CHARS)).otherwise(v).alias("value"),
            F.when(F.col("is_long"), F.sha2(v, 256)).alias("digest"),
            *[F.when(F.col("is_long"), c).alias(name) for name, c in facts.items()],
        ).groupBy("col_id", "value", "digest").agg(
            count, *[F.max(name).alias(name) for name in facts]
        )
        if not long_keys:
            counted = counted.withColumn("long_key", F.lit(None).cast("string"))
        counted = counted.withColumn("trimmed", tx.trim_blanks(v))
    else:
        counted = cells.groupBy("col_id", "value").agg(count).withColumns({
            "native": v,
            "value": tx.as_text(v, data_type),
            "digest": F.lit(None).cast("string"),
        }).withColumn("trimmed", F.col("value"))
    trimmed = F.col("trimmed")
    filled = F.when(v.isNull(), "na").otherwise("filled")
    if isinstance(data_type, T.NumericType):
        kind, layouts = filled, F.lit(0)
        number = _finite(F.col("native").cast("double"))
        repeated = (number == F.floor(number)) & trimmed.rlike(tx.REPEATED_DIGIT)
    elif isinstance(data_type, T.StringType):
        white = F.when(is_long, F.col("long_white")).otherwise(v.rlike(tx.WHITESPACE_ONLY))
        kind = (
            F.when(v.isNull(), "na").when(v == "", "empty")
            .when(white, "whitespace").otherwise("filled")
        )
        # A number is never a long text.
        number = _finite(F.when(~is_long & trimmed.rlike(tx.NUMBER), trimmed.try_cast("double")))
        repeated = trimmed.rlike(tx.REPEATED_DIGIT)
        layouts = F.when(is_long, F.col("long_layouts")).otherwise(_layout_bits(trimmed))
    else:
        kind, number, repeated = filled, F.lit(None).cast("double"), F.lit(False)
        # Texts of dates and timestamps start with year-month-day, the first layout.
        layouts = tx.date_layout_match(trimmed, tx.DATE_LAYOUTS[0]).cast("int")
    candidate = F.upper(trimmed).isin(*numeric, *strings) | repeated
    key = F.when(candidate & ~is_long, F.upper(trimmed))
    if isinstance(data_type, T.StringType):
        key = F.coalesce("long_key", key)
    return counted.select(
        "col_id", "value", "digest", "n",
        kind.alias("kind"),
        number.alias("number"),
        key.alias("key"),
        layouts.alias("layouts"),
    )


def _sentinel_lists(settings: dict) -> tuple[dict[str, str], dict[str, str]]:
    """Placeholder spellings by upper-cased text: numeric ones, string ones."""
    found = settings["sentinel_detection"]
    numeric: dict[str, str] = {}
    for value in found["numeric_sentinels"]:
        spelled = str(int(value)) if float(value).is_integer() else str(value)
        numeric.setdefault(spelled.upper(), spelled)
    strings: dict[str, str] = {}
    for value in found["string_sentinels"]:
        strings.setdefault(value.upper(), value)
    return numeric, strings


def _spelling(key: Column, spellings: dict[str, str]) -> Column:
    if not spellings:
        return F.lit(None).cast("string")
    lookup = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
    return F.try_element_at(lookup, key)


def value_groups(freq: DataFrame, catalog: DataFrame, settings: dict) -> DataFrame:
    """Frequencies reduced to one row per column for ordinary values and one per
    placeholder candidate, with the column's totals, its inferred type and, for candidates,
    whether they are sentinels. ``freq`` is read twice and should be a written table.

    No distinct texts are counted here, so a task holds as many groups as there are columns and
    candidates: a value that equals its trimmed text stands for itself, and only columns with
    few of those have their trimmed texts counted, by ``trimmed_texts``."""
    numeric, _ = _sentinel_lists(settings)
    n, kind = F.col("n"), F.col("kind")
    layouts = range(len(tx.DATE_LAYOUTS))

    def rows_if(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    has_text = F.col("has_text")
    has_number = F.col("number").isNotNull()
    trimmed = tx.trim_blanks(F.col("value"))
    prepared = freq.join(
        F.broadcast(catalog.select("col_id", "is_identifier")), "col_id"
    ).select(
        "col_id", "is_identifier", "key", "n", "kind", "number", "layouts",
        F.when(kind == "filled", F.col("digest").isNotNull() | (trimmed != "")).otherwise(False)
        .alias("has_text"),
        (F.col("digest").isNull() & (trimmed == F.col("value"))).alias("is_bare"),
    )
    groups = prepared.groupBy("col_id", "is_identifier", "key").agg(
        F.sum(n).alias("rows"),
        rows_if(kind == "na").alias("na_rows"),
        rows_if(kind == "empty").alias("empty_rows"),
        rows_if(kind == "whitespace").alias("white_rows"),
        rows_if(has_text).alias("text_rows"),
        rows_if(has_number).alias("number_rows"),
        rows_if(F.col("key").isin(*numeric)).alias("listed_number_rows"),
        *[
            rows_if(F.col("layouts").bitwiseAND(1 << i) != 0).alias(f"date_{i}") for i in layouts
        ],
        F.count_if(kind == "filled").alias("filled_values"),
        F.count_if(has_text & F.col("is_bare")).alias("bare_values"),
        F.count_if(has_number).alias("number_values"),
        F.sum(n * F.col("number")).alias("number_sum"),
    )
    column = Window.partitionBy("col_id")
    totals = [
        "rows", "na_rows", "empty_rows", "white_rows", "text_rows", "number_rows",
        "filled_values", "bare_values", "number_values", "number_sum",
    ]
    groups = groups.withColumns(
        {f"all_{t}": F.sum(t).over(column) for t in totals}
    ).withColumns(
        {f"all_date_{i}": F.sum(f"date_{i}").over(column) for i in range(len(tx.DATE_LAYOUTS))}
    )
    filled = F.col("all_text_rows")
    best_date = F.greatest(*[F.col(f"all_date_{i}") for i in range(len(tx.DATE_LAYOUTS))])
    inferred = (
        F.when(F.col("is_identifier"), "identifier")
        .when(filled == 0, "categorical")
        .when(F.col("all_number_rows") / filled > 0.90, "numeric")
        .when(best_date / filled > 0.80, "date")
        .otherwise("categorical")
    )
    groups = written(groups.withColumn("inferred_type", inferred))
    return mark_sentinels(groups, trimmed_texts(freq, groups, settings), settings)


def trimmed_texts(freq: DataFrame, groups: DataFrame, settings: dict) -> DataFrame:
    """How many trimmed texts the numeric columns hold (``col_id``, ``texts``) that are not known to
    hold too many for frequent sentinels. A long text counts as it is."""
    limit = settings["sentinel_detection"]["max_unique_for_detection"]
    open_columns = groups.where(
        (F.col("inferred_type") == "numeric") & (F.col("all_bare_values") <= limit)
    ).select("col_id").distinct()
    trimmed = tx.trim_blanks(F.col("value"))
    return (
        freq.where((F.col("kind") == "filled") & (F.col("digest").isNotNull() | (trimmed != "")))
        .join(F.broadcast(open_columns), "col_id", "left_semi")
        .select("col_id", F.coalesce("digest", trimmed).alias("text")).distinct()
        .groupBy("col_id").agg(F.count(F.lit(1)).alias("texts"))
    )


def mark_sentinels(groups: DataFrame, texts: DataFrame, settings: dict) -> DataFrame:
    """Decide which placeholder candidates are sentinels of their column: listed ones, and in
    numeric columns of few values (a number of ``texts`` within the limit) frequent ones made of
    one repeated digit."""
    numeric, strings = _sentinel_lists(settings)
    rules = settings["sentinel_detection"]
    key = F.col("key")
    is_numeric = F.col("inferred_type") == "numeric"
    share = F.col("rows") / F.col("all_rows") * 100
    few = F.coalesce(F.col("texts") <= rules["max_unique_for_detection"], F.lit(False))
    listed_number = is_numeric & (F.col("listed_number_rows") > 0)
    listed_text = key.isin(*strings)
    frequent = (
        is_numeric & few & key.rlike(tx.REPEATED_DIGIT) & (share >= rules["min_frequency_pct"])
    )
    count = F.when(listed_number, F.col("listed_number_rows")).otherwise(F.col("rows"))
    return groups.join(F.broadcast(texts), "col_id", "left").withColumns({
        "detection_method": F.when(listed_number | listed_text, "config_list")
        .when(frequent, "frequency_analysis"),
        "confidence": F.when(listed_number | listed_text, "high").when(frequent, "medium"),
        "sentinel_value": F.when(listed_number, _spelling(key, numeric))
        .when(listed_text, _spelling(key, strings)).when(frequent, key),
        "sentinel_count": count,
        "sentinel_pct": tx.percent(count, F.col("all_rows")),
    })


def found_sentinels(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("detection_method").isNotNull())


def column_profiles(groups: DataFrame) -> DataFrame:
    """Missingness classes, shares and distinct counts, one row per column."""
    hit = F.col("detection_method").isNotNull()
    zero = F.lit(0)
    per_column = groups.groupBy("col_id").agg(
        F.first("inferred_type").alias("inferred_type"),
        F.sum("rows").alias("total_count"),
        F.sum("na_rows").alias("na_count"),
        F.sum("empty_rows").alias("empty_count"),
        F.sum("white_rows").alias("whitespace_count"),
        F.coalesce(F.sum(F.when(hit, F.col("rows"))), zero).alias("sentinel_count"),
        F.coalesce(F.sum(F.when(~hit, F.col("filled_values"))), zero).alias("unique_count"),
    )
    total = F.col("total_count")
    missing = (
        F.col("na_count") + F.col("empty_count") + F.col("whitespace_count")
        + F.col("sentinel_count")
    )
    return (
        per_column.withColumn("total_missing_count", missing)
        .withColumn("valid_count", total - missing)
        .withColumns({
            f"{name}_pct": tx.percent(F.col(f"{name}_count"), total)
            for name in ("na", "empty", "whitespace", "sentinel", "total_missing", "valid")
        })
        .withColumn("unique_pct", tx.percent(F.col("unique_count"), F.col("valid_count")))
    )


def issues_found(settings: dict) -> Column:
    """Array of the quality issues of a profiled column, from ``variable_name,
    total_missing_pct, column_type, unique_count, total_count``."""
    limits = settings["missingness_thresholds"]
    name, pct = F.col("variable_name"), F.col("total_missing_pct")
    unique, total = F.col("unique_count"), F.col("total_count")
    other = F.col("column_type") != "identifier"
    share = F.bround(unique / total * 100, 2)

    def issue(cond: Column, kind: str, severity: str, text: Column, value: Column, advice: str):
        made = F.struct(
            F.lit(kind).alias("issue_type"),
            F.lit(severity).alias("severity"),
            text.alias("description"),
            value.cast("double").alias("value"),
            F.lit(advice).alias("recommendation"),
        )
        return F.when(cond, made)

    def say(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    shown = tx.plain_number(pct)
    # Issue wording.
    return F.array_compact(F.array(
        issue(
            ~other & (pct > limits["critical"]), "identifier_missing", "critical",
            say("Identifier column ", name, " has ", shown, "% missing values"), pct,
            "Investigate source data -- identifier fields must be complete.",
        ),
        issue(
            other & (pct > limits["high"]), "high_missingness", "warning",
            say(name, " has ", shown, f"% missing values (threshold: {limits['high']}%)"), pct,
            "Review data source; consider imputation or exclusion.",
        ),
        issue(
            other & (pct > limits["moderate"]) & (pct <= limits["high"]),
            "moderate_missingness", "info",
            say(name, " has ", shown, "% missing values"), pct,
            "Monitor; may need review before use.",
        ),
        issue(
            (unique == 1) & (total > 0), "constant_value", "info",
            say(name, " has only one unique value across ", total.cast("string"), " rows"),
            F.lit(1.0), "Column provides no discriminating information.",
        ),
        issue(
            other & (total > 10) & (unique > 0) & (unique / total > 0.90),
            "high_cardinality", "info",
            say(name, " has ", tx.plain_number(share), "% unique values (",
                unique.cast("string"), " of ", total.cast("string"), ")"),
            share, "Verify this is expected; high cardinality may indicate free-text.",
        ),
    ))

def column_issues(profiles: DataFrame, settings: dict) -> DataFrame:
    """One row per quality issue of the profiled columns."""
    return (
        profiles.withColumn("issue", F.explode(issues_found(settings)))
        .select("*", "issue.*").drop("issue")
    )


def quality_score(max_missing_pct: Column, critical_count: Column, settings: dict) -> Column:
    """Label of a table from its worst column and its critical issues; first match wins."""
    pct = F.coalesce(max_missing_pct, F.lit(100))
    critical = F.coalesce(critical_count, F.lit(999))
    limits = settings["quality_score_thresholds"]

    def within(level: str) -> Column:
        bound = limits[level]
        return (pct <= bound["max_missing_pct"]) & (critical <= bound["max_critical_issues"])

    return (
        F.when(within("excellent"), "Excellent")
        .when(within("good"), "Good")
        .when(within("fair"), "Fair")
        .otherwise("Needs Review")
    )


def overall_score(scores: DataFrame) -> DataFrame:
    """The worst of the labels in ``quality_score``."""
    levels = F.array(*[F.lit(s) for s in ("Excellent", "Good", "Fair", "Needs Review")])
    worst = F.max(F.array_position(levels, F.col("quality_score")))
    return scores.agg(F.try_element_at(levels, worst.cast("int")).alias("overall_score"))


def _valid_values(freq: DataFrame, groups: DataFrame) -> DataFrame:
    """Frequencies of values that are neither blank nor a sentinel of their column, with the
    column's type and the mean used to centre its deviations. Both broadcast sides are as
    small as the schema: one row per column, and per column at most one sentinel per listed
    placeholder or, where frequent digits count, per one of its few values."""
    sentinels = found_sentinels(groups).select("col_id", "key")
    kinds = groups.groupBy("col_id").agg(
        F.max("inferred_type").alias("inferred_type"),
        F.max(F.try_divide("all_number_sum", "all_number_rows")).alias("centre"),
    )
    return (
        freq.where(F.col("kind") == "filled")
        .join(F.broadcast(sentinels), ["col_id", "key"], "left_anti")
        .join(F.broadcast(kinds), "col_id")
    )


def numeric_statistics(
    freq: DataFrame, groups: DataFrame, settings: dict, small_distinct: int = SMALL_DISTINCT
) -> DataFrame:
    """Minimum, maximum, mean, median, deviation and quartiles of numeric columns. ``freq``
    is read several times and should be a written table."""
    spark = freq.sparkSession
    digits = settings["display"]["decimal_places"]
    values = (
        _valid_values(freq, groups)
        .where((F.col("inferred_type") == "numeric") & F.col("number").isNotNull())
        .select("col_id", "number", "n", "centre")
    )
    sizes = (
        groups.where(F.col("inferred_type") == "numeric")
        .groupBy("col_id").agg(F.first("all_number_values").alias("distinct")).collect()
    )
    large = [r["col_id"] for r in sizes if r["distinct"] > small_distinct]
    n, x = F.col("n"), F.col("number")
    off = x - F.col("centre")
    stats = values.groupBy("col_id").agg(
        F.sum(n).alias("count"),
        F.min(x).alias("stat_min"),
        F.max(x).alias("stat_max"),
        (F.sum(n * x) / F.sum(n)).alias("stat_mean"),
        F.sum(n * off).alias("off_sum"),
        F.sum(n * off * off).alias("off_squares"),
    )
    middle = F.col("off_squares") - F.col("off_sum") * F.col("off_sum") / F.col("count")
    spread = F.sqrt(F.greatest(middle, F.lit(0.0)) / (F.col("count") - 1))
    stats = stats.withColumn("stat_sd", F.when(F.col("count") > 1, spread))

    is_large = F.col("col_id").isin(large) if large else F.lit(False)
    at = [F.lit(q) for q in QUANTILES]
    quartiles = (
        values.where(~is_large).groupBy("col_id")
        .agg(F.percentile(x, F.array(*at), n).alias("q"))
        .select("col_id", *[F.col("q")[i].alias(f"q{i}") for i in range(3)])
    )
    if large:
        exact = exact_quantiles(values.where(is_large), "col_id", "number", "n", QUANTILES)
        quartiles = quartiles.unionByName(
            exact.groupBy("col_id").agg(*[
                F.max(F.when(F.col("fraction") == q, F.col("quantile"))).alias(f"q{i}")
                for i, q in enumerate(QUANTILES)
            ])
        )

    def shown(c: Column) -> Column:
        return F.bround(c, digits)

    return stats.join(F.broadcast(quartiles), "col_id").select(
        "col_id",
        *[shown(F.col(c)).alias(c) for c in ("stat_min", "stat_max", "stat_mean")],
        shown(F.col("q1")).alias("stat_median"),
        shown(F.col("stat_sd")).alias("stat_sd"),
        shown(F.col("q0")).alias("stat_q25"),
        shown(F.col("q2")).alias("stat_q75"),
        shown(F.col("q2") - F.col("q0")).alias("stat_iqr"),
    )


def top_values(
    freq: DataFrame, groups: DataFrame, settings: dict,
    cells: dict[str, tuple[T.DataType, DataFrame]],
) -> DataFrame:
    """The most frequent valid values of each column: most frequent first, ties in binary order
    of the whole values. Counts and the first characters settle most ranks; only long texts
    that may still be among the first are read again, from the text cells. Both rankings keep
    only the first rows of each column before they shuffle."""
    limit = settings["display"]["top_n_categories"]
    digits = settings["display"]["decimal_places"]
    column = Window.partitionBy("col_id")
    head = F.substring("value", 1, HEAD_CHARS)
    possible = (
        _valid_values(freq, groups)
        .select("col_id", "value", "digest", "n")
        .withColumn("value_rank", F.rank().over(column.orderBy(F.desc("n"), head)))
        .where(F.col("value_rank") <= limit)
    )
    ranked = (
        with_whole_texts(possible, cells)
        .withColumn("value_rank", F.row_number().over(column.orderBy(F.desc("n"), "value")))
        .where(F.col("value_rank") <= limit)
    )
    valid = column_profiles(groups).select("col_id", "inferred_type", "valid_count")
    return ranked.join(F.broadcast(valid), "col_id").withColumn(
        "pct", F.bround(F.col("n") / F.col("valid_count") * 100, digits)
    )


def with_whole_texts(
    tops: DataFrame, cells: dict[str, tuple[T.DataType, DataFrame]]
) -> DataFrame:
    """Replace the start of long texts among ``tops`` by the whole text, read again from the
    text cells. Nothing is read when no long text is among them."""
    if "string" not in cells:
        return tops
    wanted = tops.where(F.col("digest").isNotNull()).select("col_id", "digest").distinct()
    c = F.col("value")
    whole = (
        cells["string"][1].where(is_long_text(c))
        .select("col_id", F.sha2(c, 256).alias("digest"), c.alias("whole"))
        .join(wanted, ["col_id", "digest"])
        .groupBy("col_id", "digest")
        .agg(F.any_value("whole").alias("whole"))
    )
    return (
        tops.join(whole, ["col_id", "digest"], "left")
        .withColumn("value", F.coalesce("whole", "value"))
        .drop("whole")
    )


@dataclass
class TableProfile:
    """The five result tables of a profiling run."""

    profile: DataFrame
    distributions: DataFrame
    sentinels: DataFrame
    issues: DataFrame
    summary: DataFrame


class Profiler:
    """Profiles a set of named tables in one pass over their cells."""

    def __init__(
        self,
        tables: dict[str, DataFrame],
        settings: dict | str | None = None,
        ingest_id: str | None = None,
        schema_name: str = "raw",
        small_distinct: int = SMALL_DISTINCT,
        freq: DataFrame | None = None,
    ):
        """``freq`` are frequencies of the cells that are known already; the tables' cells are then
        only read for whole texts."""
        first = next(iter(tables.values()))
        self.spark = first.sparkSession
        self.settings = profiling_settings(settings)
        self.small_distinct = small_distinct
        self.columns = column_catalog(tables, self.settings)
        self.catalog = _catalog_frame(self.spark, self.columns)
        self.cells = cells_by_type(tables, self.columns)
        self.freq = frequencies(self.cells, self.settings) if freq is None else freq
        self.stamp = {"ingest_id": F.lit(ingest_id), "schema_name": F.lit(schema_name)}
        self._groups: DataFrame | None = None

    @property
    def groups(self) -> DataFrame:
        return self.store()._groups

    def store(self) -> "Profiler":
        """Write the frequency table and its per-column reduction once; all results are taken from
        them. The counts are merged in many small partitions, so that the distinct values one task
        holds do not grow with the tables."""
        if self._groups is None:
            with finer_shuffles(self.spark):
                self.freq = written(self.freq)
            self._groups = written(value_groups(self.freq, self.catalog, self.settings))
        return self

    def _named(self, df: DataFrame, how: str = "inner") -> DataFrame:
        names = F.broadcast(self.catalog.select("col_id", "table_name", "variable_name", "ordinal"))
        joined = df.join(names, "col_id", how)
        return joined.select(
            *[v.cast("string").alias(k) for k, v in self.stamp.items()],
            "table_name", "variable_name",
            *[c for c in joined.columns if c not in ("table_name", "variable_name")],
        )

    def _profiles(self) -> DataFrame:
        return self._named(column_profiles(self.groups))

    def types(self) -> DataFrame:
        kinds = self.groups.groupBy("col_id").agg(
            F.first("inferred_type").alias("inferred_type")
        )
        return self._named(kinds).drop("col_id", "ordinal")

    def profile(self) -> DataFrame:
        rows = self._profiles().select(
            "ingest_id", "schema_name", "table_name", "variable_name", "inferred_type",
            *PROFILE_COLUMNS,
        )
        return rows.withColumn("profiled_at", F.current_timestamp())

    def sentinels(self) -> DataFrame:
        found = found_sentinels(self.groups).select(
            "col_id", "sentinel_value", "sentinel_count", "sentinel_pct",
            "detection_method", "confidence",
        )
        return self._named(found).drop("col_id", "ordinal")

    def issues(self) -> DataFrame:
        rows = self._profiles().withColumn("column_type", F.col("inferred_type"))
        return column_issues(rows, self.settings).select(
            "ingest_id", "schema_name", "table_name", "variable_name", "issue_type",
            "severity", "description", "value", "recommendation",
        )

    def summary(self) -> DataFrame:
        """One row per table, also for tables without rows."""
        rows = self._profiles().withColumn("column_type", F.col("inferred_type"))
        rows = rows.withColumn("found", issues_found(self.settings))

        def issues_of(severity: str) -> Column:
            return F.sum(F.size(F.filter("found", lambda i: i["severity"] == severity)))

        pct = F.col("total_missing_pct")
        worst = F.max_by(F.struct("variable_name", pct), F.struct(pct, -F.col("ordinal")))
        per_table = rows.groupBy("table_name").agg(
            F.max("total_count").alias("row_count"),
            # The mean is taken of decimals, so that ties round the same way on every run.
            F.bround(
                F.sum(F.col("valid_pct").cast("decimal(5,2)"))
                / F.count("valid_pct").cast("decimal(20,0)"), 2
            ).cast("double").alias("avg_valid_pct"),
            F.bround(F.min("valid_pct"), 2).alias("min_valid_pct"),
            F.bround(F.max(pct), 2).alias("max_missing_pct"),
            worst.alias("worst"),
            *[issues_of(s).alias(f"{s}_issue_count") for s in ("critical", "warning", "info")],
        )
        widths = self.catalog.groupBy("table_name").agg(F.count(F.lit(1)).alias("variable_count"))
        joined = widths.join(F.broadcast(per_table), "table_name", "left")
        no_rows = F.col("row_count").isNull()
        counts = {
            c: F.coalesce(F.col(c), F.lit(0)).alias(c)
            for c in ("critical_issue_count", "warning_issue_count", "info_issue_count")
        }
        score = F.when(no_rows, "Excellent").otherwise(
            quality_score(
                F.col("max_missing_pct"),
                F.coalesce(F.col("critical_issue_count"), F.lit(0)),
                self.settings,
            )
        )
        return joined.select(
            *[v.cast("string").alias(k) for k, v in self.stamp.items()],
            "table_name",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            "variable_count", "avg_valid_pct", "min_valid_pct", "max_missing_pct",
            *counts.values(),
            score.alias("quality_score"),
            F.col("worst.variable_name").alias("worst_variable"),
            F.col("worst.total_missing_pct").alias("worst_variable_missing_pct"),
        )

    def numeric(self) -> DataFrame:
        self.store()
        stats = numeric_statistics(
            self.freq, self.groups, self.settings, self.small_distinct
        )
        return self._named(stats).drop("col_id", "ordinal")

    def tops(self) -> DataFrame:
        self.store()
        return self._named(top_values(self.freq, self.groups, self.settings, self.cells))

    def distributions(self) -> DataFrame:
        self.store()
        groups = self.groups
        stats = numeric_statistics(self.freq, groups, self.settings, self.small_distinct)
        tops = top_values(self.freq, groups, self.settings, self.cells)
        entry = F.struct(
            F.col("value_rank").alias("r"),
            F.struct("value", F.col("n").alias("count"), "pct").alias("e"),
        )
        listed = F.sort_array(F.collect_list(entry))
        modes = tops.groupBy("col_id").agg(
            F.to_json(F.transform(listed, lambda e: e["e"])).alias("all_tops"),
            F.first("inferred_type").alias("inferred_type"),
            *[
                F.max(F.when(F.col("value_rank") == 1, F.col(c))).alias(f"top_{c}")
                for c in ("value", "n", "pct")
            ],
        )
        present = groups.select("col_id").distinct()
        joined = (
            present.join(modes, "col_id", "left").join(F.broadcast(stats), "col_id", "left")
        )
        numeric = F.col("inferred_type") == "numeric"
        described = ~numeric | F.col("stat_min").isNotNull()
        rows = joined.select(
            "col_id",
            F.when(numeric & described, "numeric").when(~numeric, "categorical")
            .alias("distribution_type"),
            *[c for c in stats.columns if c != "col_id"],
            F.when(~numeric, F.col("all_tops")).alias("top_values_json"),
            *[
                F.when(described, F.col(f"top_{c}")).alias(alias)
                for c, alias in (("value", "mode_value"), ("n", "mode_count"), ("pct", "mode_pct"))
            ],
        )
        return self._named(rows).drop("col_id", "ordinal")

    def run(self) -> TableProfile:
        """All five results over one stored frequency table."""
        self.store()
        return TableProfile(
            self.profile(), self.distributions(), self.sentinels(), self.issues(), self.summary()
        )


def profile_table(df: DataFrame, table_name: str, **options) -> TableProfile:
    return Profiler({table_name: df}, **options).run()
