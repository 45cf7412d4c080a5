"""Deterministic de-identification of identifiers, birth dates and names."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.hashing import pseudonym, weighted_hash, weighted_hash_of
from lakewright.functions.text import as_text, to_number, trim_blanks
from lakewright.sources.files import rewrite_files


@dataclass
class DeidRules:
    """Which columns are replaced and how. Column names are compared without punctuation or
    case. ``strong`` uses SHA-256 instead of the weak position-weighted hash. With ``exact_ids``
    numeric identifiers are added as whole numbers of any size and come out as text; else they
    come out as doubles, unless a column holds numbers that doubles cannot tell apart."""

    salt: str = "LAKE_DEID"
    # Names of the columns concerned.
    id_columns: list[str] = field(default_factory=lambda: [
        "Cisir Id", "MRN", "Trauma No.", "Account Number", "MEDRECNO"])
    name_columns: list[str] = field(default_factory=lambda: ["FNAME", "LNAME"])
    birth_columns: list[str] = field(default_factory=lambda: [
        "DOB", "DATE_OF_BIRTH", "BIRTH_DATE", "BIRTHDATE"])
    stable_keys: list[str] = field(default_factory=lambda: [
        "MRN", "MEDRECNO", "ACCOUNT_NUMBER", "ACCOUNT NUMBER", "TRAUMA NO.", "TRAUMA_NO"])
    id_offsets: dict[str, int] | None = None
    shift_days: tuple[int, int] = (-3650, 3650)
    name_length: int = 10
    strong: bool = False
    exact_ids: bool = False

    def offset(self, name: str) -> int:
        if self.id_offsets is not None:
            return self.id_offsets[name]
        return 100000 + weighted_hash_of(name, self.salt, 900000)


def plain_name(name: str) -> str:
    return re.sub(r"[^A-Z0-9]+", "", name.upper())


def _find(df: DataFrame, wanted: str) -> str | None:
    return next((c for c in df.columns if plain_name(c) == plain_name(wanted)), None)


def _hash(value: Column, salt: str, size: int, strong: bool) -> Column:
    if not strong:
        return weighted_hash(value, salt, size)
    text = F.concat(F.lit(salt + "||"), F.coalesce(value, F.lit("NA")))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint"), F.lit(size))


# Where a birth date's year stands and how it is parsed; a year of four digits anywhere goes
# before a shorter one at the start.
_BIRTH_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}", "y-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}", "y/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}", "M/d/y"), (r"^\d{1,2}-\d{1,2}-\d{4}", "M-d-y"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}", "d-MMM-y"), (r"^\d{8}", "yyyyMMdd"),
    (r"^\d{1,3}-\d{1,2}-\d{1,2}", "y-M-d"), (r"^\d{1,3}/\d{1,2}/\d{1,2}", "y/M/d"),
]


def birth_date(c: Column) -> Column:
    """The date a text starts with; NULL without one."""
    def start(pattern: str, fmt: str) -> Column:
        found = F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 0))
        if "MMM" in fmt:
            found = F.initcap(F.regexp_replace(found, "-", " "))
            fmt = fmt.replace("-", " ")
        return F.try_to_timestamp(found, F.lit(fmt))

    return F.coalesce(*[start(p, f) for p, f in _BIRTH_LAYOUTS]).cast("date")


# Doubles tell all whole numbers up to here apart.
MOST_EXACT = float(2**53)


def _added(text: Column, offset: int) -> Column:
    """The number a text spells plus an offset, as text; whole numbers exactly."""
    whole = F.regexp_extract(trim_blanks(text), r"^([+-]?[0-9]{1,37})(\.0*)?$", 1)
    exact = (whole.try_cast("decimal(38,0)") + F.lit(offset)).cast("string")
    return F.coalesce(exact, as_text(to_number(text) + F.lit(float(offset)), T.DoubleType()))


def shifted_date(day: Column, key: Column, rules: DeidRules) -> Column:
    """A date moved by a number of days that depends on the key alone."""
    low, high = rules.shift_days
    moved = _hash(key, rules.salt, high - low + 1, rules.strong) + F.lit(low)
    return F.date_add(day, moved.cast("int"))


def deidentify(df: DataFrame, rules: DeidRules | None = None) -> DataFrame:
    """Identifiers get an offset per column (added where the column holds numbers, appended
    where it holds none), birth dates move by days fixed per stable key, names become
    pseudonyms. Without a stable key the whole row is the key. A birth date that no layout
    fits becomes NULL: nothing of it is kept as it was.

    Whether an identifier column holds numbers at all is one aggregation over those columns.
    """
    rules = rules or DeidRules()
    types = {f.name: f.dataType for f in df.schema.fields}
    targets = {n: _find(df, n) for n in rules.id_columns}
    targets = {n: c for n, c in targets.items() if c is not None}
    birth = next((c for c in df.columns
                  if plain_name(c) in {plain_name(n) for n in rules.birth_columns}), None)
    text = {c: as_text(F.col(f"`{c}`"), types[c]) for c in df.columns}
    probes = [
        p for i, c in enumerate(targets.values()) for p in (
            F.bool_or(to_number(text[c]).isNotNull()).alias(f"n{i}"),
            F.bool_or(F.abs(to_number(text[c])) > MOST_EXACT).alias(f"big{i}"),
        )
    ]
    seen = df.agg(*probes).first() if probes else None
    as_texts: set[str] = set()

    changed: dict[str, Column] = {}
    for i, (name, c) in enumerate(targets.items()):
        offset = rules.offset(name)
        if seen[f"n{i}"] and (rules.exact_ids or seen[f"big{i}"]):
            as_texts.add(c)
            changed[c] = _added(text[c], offset)
        elif seen[f"n{i}"]:
            changed[c] = to_number(text[c]) + F.lit(float(offset))
        else:
            changed[c] = F.concat(text[c], F.lit(str(offset)))
    if birth:
        keys = {plain_name(k) for k in rules.stable_keys}
        stable = next((c for c in df.columns if plain_name(c) in keys), None)
        if stable is None:
            key = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        elif stable in changed and stable not in as_texts and seen[f"n{list(targets.values()).index(stable)}"]:
            whole = changed[stable] == F.floor(changed[stable])
            key = F.when(whole, changed[stable].cast("bigint").cast("string")).otherwise(
                changed[stable].cast("string"))
        else:
            key = changed.get(stable, text[stable])
        changed[birth] = shifted_date(birth_date(text[birth]), key, rules)
    for name in rules.name_columns:
        c = _find(df, name)
        if c is not None:
            changed[c] = pseudonym(text[c], f"{rules.salt}||{name}", rules.name_length)
    return df.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def deidentify_files(
    spark: SparkSession, roots: list[str], out_root: str, rules: DeidRules | None = None,
    n_max_rows: int | None = None, include_archive: bool = True,
) -> DataFrame:
    """De-identify every file under the roots; returns the manifest. Delimited files are read as
    text, so that what is not changed stays as it is written."""
    rules = replace(rules or DeidRules(), exact_ids=True)

    def change(df: DataFrame) -> DataFrame:
        return deidentify(df if n_max_rows is None else df.limit(n_max_rows), rules)

    return rewrite_files(spark, roots, out_root, "deid", change, include_archive)
