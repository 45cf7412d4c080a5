"""Delimited files: discovery, facts, all-text scans and scans that recover a header."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.names import normalize_name

FACTS_SCHEMA = (
    "path string, found boolean, file_size_bytes bigint, checksum string, "
    "header array<string>, problem string"
)
# multiLine keeps line ends inside quotes, at the price of one task per file; files known to
# have none can be read in splits by passing quoted_newlines=False.
CHUNK_BYTES = 1 << 22
CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": True}


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files directly under ``folder`` matching ``pattern``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "false")
        .load(folder)
        .select("path", F.col("length").alias("file_size_bytes"), "modificationTime")
    )


def base_name(path) -> "F.Column":
    """Lower-cased file name without its extension, from a path column."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.regexp_replace(name, r"\.[^.]*$", ""))


def file_stem(path: str) -> str:
    return re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1]).lower()


def _open_input(path: str):
    """A stream over ``path`` whatever file system it names."""
    from pyarrow import fs

    location = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path))
    if "://" in location:
        system, inner = fs.FileSystem.from_uri(location.replace(" ", "%20"))
    else:
        system, inner = fs.LocalFileSystem(), location
    return system.open_input_stream(inner, compression=None)


class _Hashed(io.RawIOBase):
    """A stream that hashes and counts the bytes read through it."""

    def __init__(self, stream):
        import hashlib

        self.stream, self.digest, self.size = stream, hashlib.md5(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        chunk = self.stream.read(len(buffer))
        buffer[: len(chunk)] = chunk
        self.digest.update(chunk)
        self.size += len(chunk)
        return len(chunk)


def _facts_of(path: str) -> dict:
    try:
        with _open_input(path) as stream:
            hashed = _Hashed(stream)
            whole = io.BufferedReader(hashed, CHUNK_BYTES)
            text = io.TextIOWrapper(whole, "utf-8-sig", "replace", newline="\n")
            header = next(csv.reader(text), [])
            while whole.read(CHUNK_BYTES):
                pass
        return dict(path=path, found=True, file_size_bytes=hashed.size,
                    checksum=hashed.digest.hexdigest(), header=header, problem=None)
    except FileNotFoundError:
        problem, found = "file does not exist", False
    except Exception as error:  # whatever is wrong with one file is that file's problem
        problem, found = str(error), False
    return dict(path=path, found=found, file_size_bytes=None, checksum=None,
                header=None, problem=problem)


def _facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([_facts_of(p) for p in batch["path"]]).astype(
            {"file_size_bytes": "Int64"}
        )


def file_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Size, MD5 and header of each file, streamed in one task per file; a file that cannot
    be read is a row with ``found`` false."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    slots = max(1, min(len(paths), 4096))
    return listed.repartition(slots, "path").mapInPandas(_facts, FACTS_SCHEMA)


def header_fields(text: str, delimiter: str = ",") -> list[str]:
    """Fields of the first record of a text."""
    return next(csv.reader(io.StringIO(text), delimiter=delimiter), [])


def _text_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def read_text_csv(
    spark: SparkSession,
    paths: list[str],
    header: list[str],
    delimiter: str = ",",
    na_values: tuple[str, ...] = (),
    quoted_newlines: bool = True,
) -> DataFrame:
    """Files that share one header, all columns text. Columns come in file order under the
    normalized names (the first of equal names wins) next to ``_source_file``. A field with
    nothing between its commas is NULL; other text is kept as written, blanks included, unless
    ``na_values`` names texts to read as NULL."""
    reader = spark.read.options(
        header=True, sep=delimiter, nullValue="\u0000", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        **{**CSV_OPTIONS, "multiLine": quoted_newlines},
    )
    df = reader.schema(_text_schema(len(header))).csv(paths)
    kept: dict[str, int] = {}
    for position, name in enumerate(header):
        kept.setdefault(normalize_name(name), position)

    def cell(position: int):
        c = F.col(f"c{position}")
        return F.when(~F.trim(c).isin(*na_values), c) if na_values else c

    return df.select(
        *[cell(i).alias(name) for name, i in kept.items()],
        F.col("_metadata.file_path").alias("_source_file"),
    )


def too_wide_lines(
    spark: SparkSession, paths: list[str], width: int, delimiter: str = ",",
    quoted_newlines: bool = True, **_,
) -> DataFrame:
    """``_source_file`` and ``lines``, how many of its records hold more fields than ``width``.
    Such records load without the fields beyond it. Files without any give no row."""
    schema = T.StructType([*_text_schema(width).fields, T.StructField("_line", T.StringType())])
    lines = spark.read.options(
        header=True, sep=delimiter, columnNameOfCorruptRecord="_line", nullValue="\u0000",
        **{**CSV_OPTIONS, "multiLine": quoted_newlines},
    ).schema(schema).csv(paths)
    # A record of another width is given as it was written; quoted fields are taken out of it
    # before its delimiters are counted.
    mark = re.escape(delimiter)
    bare = F.regexp_replace("_line", f'(?s)(^|{mark})"(?:[^"]|"")*+"', "$1")
    return (
        # Spark does not read the record without another column.
        lines.where(F.col("_line").isNotNull() & (F.coalesce(F.length("c0"), F.lit(0)) >= 0))
        .select(F.col("_metadata.file_path").alias("_source_file"), bare.alias("bare"))
        .where(F.size(F.split("bare", mark)) > width)
        .groupBy("_source_file").agg(F.count(F.lit(1)).alias("lines"))
    )


def read_csv_strict(
    spark: SparkSession, path: str, expected: list[str], max_skip: int = 10
) -> DataFrame | None:
    """A file whose header may be missing or preceded by title lines. With an expected name in
    the header the header is used. Otherwise the first line number up to ``max_skip`` whose
    width equals the expected one starts the data, under the expected names; without such a
    line there is no result."""
    facts = file_facts(spark, [path]).first()
    if not facts["found"]:
        return None
    header = facts["header"]
    if set(expected) & {normalize_name(h) for h in header}:
        return read_text_csv(spark, [path], header).drop("_source_file")
    lines = [r["value"] for r in spark.read.text(path).limit(max_skip + 1).collect()]
    widths = [len(header_fields(line)) if line.strip() else 0 for line in lines]
    start = next((i for i, w in enumerate(widths[: max_skip + 1]) if w == len(expected)), None)
    if start is None:
        return None
    above = sum(1 for line in lines[:start] if line.strip())
    rows = (
        spark.read.options(header=False, nullValue="\u0000", emptyValue="", **CSV_OPTIONS)
        .schema(_text_schema(len(expected))).csv(path)
    )
    names = [F.col(f"c{i}").alias(n) for i, n in enumerate(expected)]
    if above == 0:
        return rows.select(*names)
    # Title lines are the first rows of the first block; row numbers only grow in a block.
    placed = rows.select(
        "*",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = placed.where("block = 0").agg(F.min("row").alias("row")).first()["row"]
    data = placed.where((F.col("block") != 0) | (F.col("row") >= first + above))
    return data.select(*names)


def scan(spark: SparkSession, path: str, as_text: bool = False) -> DataFrame:
    """csv, tsv, txt (comma, else tab) or parquet, chosen by extension. ``as_text`` leaves the
    fields of delimited files as they are written and saves the pass that infers types."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    separators = {"csv": ",", "tsv": "\t", "txt": ","}
    if kind not in separators:
        raise ValueError(f"unsupported file type: {path}")
    options = dict(header=True, inferSchema=not as_text, nullValue="\u0000" if as_text else "NA", **CSV_OPTIONS)
    df = spark.read.options(sep=separators[kind], **options).csv(path)
    if kind == "txt" and len(df.columns) == 1 and "\t" in df.columns[0]:
        df = spark.read.options(sep="\t", **options).csv(path)
    return df


def write_like(df: DataFrame, path: str, kind: str) -> str:
    """Write ``df`` in the format of the file it came from."""
    kind = kind.lower()
    if kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif kind in ("csv", "txt"):
        df.write.mode("overwrite").options(header=True, escape='"').csv(path)
    elif kind == "tsv":
        df.write.mode("overwrite").options(header=True, sep="\t", escape='"').csv(path)
    else:
        raise ValueError(f"unsupported output type: {kind}")
    return path


def list_inputs(spark: SparkSession, roots: list[str], include_archive: bool = True) -> list[dict]:
    """Supported files anywhere under the roots, with the root they belong to."""
    found = []
    for root in roots:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(root).select("path").collect()
        )
        for row in files:
            kind = row["path"].rsplit(".", 1)[-1].lower()
            archived = "/archive/" in row["path"]
            if kind in ("csv", "tsv", "txt", "parquet") and (include_archive or not archived):
                found.append({"path": row["path"], "root": root, "kind": kind})
    return sorted(found, key=lambda f: f["path"])


MANIFEST_SCHEMA = (
    "input_path string, output_path string, status string, n_rows_written bigint, notes string"
)


def rewrite_files(
    spark: SparkSession, roots: list[str], out_root: str, suffix: str, change,
    include_archive: bool = True,
) -> DataFrame:
    """Read every file under the roots, apply ``change`` and write the result to the same
    relative place under ``out_root``. Returns a manifest; a failing file is a skipped row."""
    from pyspark.sql import Observation

    rows = []
    for item in list_inputs(spark, roots, include_archive):
        plain = re.sub(r"^file:/+", "/", item["path"])
        relative = plain[len(re.sub(r"^file:/+", "/", item["root"]).rstrip("/")) + 1:]
        stem = relative.rsplit(".", 1)[0]
        target = f"{out_root.rstrip('/')}/{stem}__{suffix}.{item['kind']}"
        try:
            counted = Observation()
            changed = change(scan(spark, item["path"], as_text=True))
            write_like(
                changed.observe(counted, F.count(F.lit(1)).alias("n")), target, item["kind"]
            )
            rows.append((item["path"], target, "wrote", counted.get["n"], ""))
        except Exception as error:
            rows.append((item["path"], "", "skipped", 0, f"ERROR: {error}"))
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def toy_extracts(
    spark: SparkSession, roots: list[str], out_root: str, n_rows: int = 25,
    include_archive: bool = True,
) -> DataFrame:
    """The first rows of every file, written beside a manifest of what was done."""
    return rewrite_files(
        spark, roots, out_root, f"toy{n_rows}", lambda df: df.limit(n_rows), include_archive
    )
