"""The zones of a lake as catalog databases, with the write patterns the operators need."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The zones of the lake.
ZONES = ("reference", "raw", "staging", "validated", "governance")

# Name under which a table stands while another takes its place.
ASIDE = "aside_"


class Lake:
    """Named tables in zones. ``prefix`` separates several lakes in one catalog."""

    def __init__(self, spark: SparkSession, prefix: str = "", location: str | None = None):
        self.spark = spark
        self.prefix = prefix
        for zone in ZONES:
            where = f" LOCATION '{location}/{zone}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{zone}`{where}")

    def name(self, zone: str, table: str) -> str:
        return f"`{self.prefix}{zone}`.`{table}`"

    def exists(self, zone: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(zone, table))

    def tables(self, zone: str) -> list[str]:
        listed = self.spark.catalog.listTables(f"`{self.prefix}{zone}`")
        return sorted(t.name for t in listed if not t.isTemporary)

    def read(self, zone: str, table: str) -> DataFrame:
        """A whole table, or with ``where`` on it the rows wanted."""
        return self.spark.table(self.name(zone, table))

    def drop(self, zone: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(zone, table)}")

    def append(self, zone: str, table: str, df: DataFrame, keys: tuple[str, ...] = ()) -> None:
        """Add rows; new columns are added to the table, absent ones are NULL. A table without
        slices or rows, made from its description, takes on the keys of the first rows."""
        if not self.exists(zone, table):
            self._create(zone, table, df, keys)
            return
        if keys and not self._keys(zone, table) and self.read(zone, table).isEmpty():
            self.replace(zone, table, self._fitted(zone, table, df), keys)
            return
        self._fitted(zone, table, df).write.mode("append").insertInto(self.name(zone, table))

    def replace(
        self, zone: str, table: str, df: DataFrame, keys: tuple[str, ...] = (),
        facts: dict[str, str] | None = None,
    ) -> None:
        """Build the table in a place of its own and swap it in: a failing job leaves the old
        table, ``df`` may read the table it replaces, and no data moves. With the columns
        unchanged the swap is one change of the table's location; else two renames, between
        which the old table stands under another name (see ``recover``)."""
        beside = f"swap_{table}_{uuid.uuid4().hex[:8]}"
        path = f"{self._folder(zone)}/{table}__{uuid.uuid4().hex}"
        try:
            self._create(zone, beside, df, keys, path)
            if facts:
                self.note(zone, beside, facts)
        except Exception:
            self.drop(zone, beside)
            self._remove(path)
            raise
        if not self.exists(zone, table):
            self._rename(zone, beside, table)
            return
        old = self._location(zone, table)
        same = self.read(zone, table).schema == self.read(zone, beside).schema
        if same and not keys and not self._keys(zone, table):
            new = self._location(zone, beside)
            self.spark.sql(f"ALTER TABLE {self.name(zone, table)} SET LOCATION '{_quoted(new)}'")
            if facts:
                self.note(zone, table, facts)
            self.drop(zone, beside)
        else:
            aside = f"{ASIDE}{table}_{uuid.uuid4().hex[:8]}"
            slices = [self._location(zone, table, v) for v in self.slices(zone, table)]
            self._rename(zone, table, aside)
            try:
                self._rename(zone, beside, table)
            except Exception:
                self._rename(zone, aside, table)
                raise
            old = self._location(zone, aside)
            self.drop(zone, aside)
            for place in slices:
                self._remove(place)
        self._remove(old)

    def recover(self, zone: str) -> list[str]:
        """After a crash: tables set aside by a swap that did not end get their name back;
        the remains of swaps that did are dropped. Not to be run beside a swap."""
        back = []
        for name in self.tables(zone):
            if name.startswith("swap_"):
                self.drop(zone, name)
            elif name.startswith(ASIDE):
                table = name[len(ASIDE):].rsplit("_", 1)[0]
                if self.exists(zone, table):
                    self.drop(zone, name)
                else:
                    self._rename(zone, name, table)
                    back.append(table)
        return back

    def note(self, zone: str, table: str, facts: dict[str, str]) -> None:
        """Keep short facts with the table's catalog entry."""
        listed = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in facts.items())
        self.spark.sql(f"ALTER TABLE {self.name(zone, table)} SET TBLPROPERTIES ({listed})")

    def noted(self, zone: str, table: str, fact: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(zone, table)}").collect()
        return {r["key"]: r["value"] for r in rows}.get(fact)

    def _rename(self, zone: str, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(zone, old)} RENAME TO {self.name(zone, new)}")

    def _folder(self, zone: str) -> str:
        return self.spark.catalog.getDatabase(f"{self.prefix}{zone}").locationUri.rstrip("/")

    def _location(self, zone: str, table: str, values: dict[str, str] | None = None) -> str:
        """Where a table or one of its slices keeps its data."""
        spec = f" PARTITION ({_spec(values)})" if values else ""
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(zone, table)}{spec}").collect()
        # Columns come before the details; a slice's details before those of its table.
        details = next(i for i, r in enumerate(about) if r["col_name"].startswith("# Detailed"))
        return next(r["data_type"] for r in about[details:] if r["col_name"] == "Location")

    def _keys(self, zone: str, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(zone, table)) if c.isPartition]

    def slices(self, zone: str, table: str) -> list[dict[str, str]]:
        """The key values of the slices of a table; data is not read."""
        if not self.exists(zone, table) or not self._keys(zone, table):
            return []
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(zone, table)}").collect()
        # Names are written as in paths.
        return [
            {k: unquote(v) for k, v in (part.split("=", 1) for part in r[0].split("/"))}
            for r in listed
        ]

    def _filesystem(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _remove(self, path: str) -> None:
        system, hadoop = self._filesystem(path)
        system.delete(hadoop, True)

    def replace_slice(
        self, zone: str, table: str, df: DataFrame, values: dict[str, str]
    ) -> None:
        """Replace the rows whose key columns equal ``values`` by ``df``; other rows are not
        read. The rows are written to a place of their own first; then one change in the
        catalog points the slice to it. A failing job leaves the earlier rows, and ``df`` may
        read them. A ``df`` without rows leaves an empty slice. ``values`` are all the keys that
        partition the table, which ``append`` or this call made."""
        keys = tuple(values)
        self._prepare(zone, table, df.withColumns({k: F.lit(v) for k, v in values.items()}), keys)
        place = self._write_beside(zone, table, self._fitted(zone, table, df, keys))
        self._point(zone, table, values, place)

    def replace_slices(
        self, zone: str, table: str, df: DataFrame, values: dict[str, str], key: str,
        listed: list[str],
    ) -> None:
        """``replace_slice`` for each of the ``listed`` values of the further column ``key``, with one
        write for all. Of those without rows in ``df`` empty slices are left."""
        keys = (*values, key)
        typed = df.withColumns({k: F.lit(v) for k, v in values.items()})
        self._prepare(zone, table, typed, keys)
        rows = self._fitted(zone, table, df, tuple(values))
        place = self._write_beside(zone, table, rows, key)
        for value in listed:
            own = f"{place}/{key}={value}"
            self._filesystem(own)[0].mkdirs(self._filesystem(own)[1])
            self._point(zone, table, {**values, key: value}, own)

    def _prepare(self, zone: str, table: str, df: DataFrame, keys: tuple[str, ...]) -> None:
        if not self.exists(zone, table):
            self._create(zone, table, self.spark.createDataFrame([], df.schema), keys)

    def _write_beside(self, zone: str, table: str, df: DataFrame, *keys: str) -> str:
        place = f"{self._folder(zone)}/{table}__slices/{uuid.uuid4().hex}"
        try:
            df.write.partitionBy(*keys).parquet(place)
        except Exception:
            self._remove(place)
            raise
        return place

    def _point(self, zone: str, table: str, values: dict[str, str], place: str) -> None:
        target, spec = self.name(zone, table), _spec(values)
        if self.has_slice(zone, table, values):
            old = self._location(zone, table, values)
            self.spark.sql(
                f"ALTER TABLE {target} PARTITION ({spec}) SET LOCATION '{_quoted(place)}'"
            )
            self._remove(old)
        else:
            self.spark.sql(f"ALTER TABLE {target} ADD PARTITION ({spec}) LOCATION '{_quoted(place)}'")

    def has_slice(self, zone: str, table: str, values: dict[str, str]) -> bool:
        if not self.exists(zone, table):
            return False
        found = self.spark.sql(f"SHOW PARTITIONS {self.name(zone, table)} PARTITION ({_spec(values)})")
        return not found.isEmpty()

    def drop_slice(self, zone: str, table: str, values: dict[str, str]) -> None:
        if self.has_slice(zone, table, values):
            place = self._location(zone, table, values)
            self.spark.sql(
                f"ALTER TABLE {self.name(zone, table)} DROP IF EXISTS PARTITION ({_spec(values)})"
            )
            self._remove(place)

    def _create(
        self, zone: str, table: str, df: DataFrame, keys: tuple[str, ...],
        path: str | None = None,
    ) -> None:
        rest = [c for c in df.columns if c not in keys]
        writer = df.select(*[f"`{c}`" for c in rest], *keys).write.format("parquet")
        if keys:
            writer = writer.partitionBy(*keys)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(self.name(zone, table))

    def _fitted(
        self, zone: str, table: str, df: DataFrame, leave: tuple[str, ...] = ()
    ) -> DataFrame:
        """``df`` with the columns of the table, but for those in ``leave``; columns the table
        lacks are added to it."""
        known = self.read(zone, table).schema
        names = {f.name.lower() for f in known.fields}
        extra = [f for f in df.schema.fields if f.name.lower() not in names]
        if extra:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
            self.spark.sql(f"ALTER TABLE {self.name(zone, table)} ADD COLUMNS ({added})")
            known = self.read(zone, table).schema
        have = {c.lower(): c for c in df.columns}
        return df.select(*[
            F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in known.fields if f.name not in leave
        ])


def _spec(values: dict[str, str]) -> str:
    return ", ".join(f"`{k}` = '{_quoted(v)}'" for k, v in values.items())


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
