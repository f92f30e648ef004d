"""CSV, zipped CSV and JSON files."""

from __future__ import annotations

import shutil
import sys
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch.storage import fresh_path, settle

# the tasks below travel by value, so that executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# FIXED VALUES: texts that mean "no value" in a source CSV file
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
#: Holds the text of a record that does not fit the file's header, in rows read leniently.
CORRUPT = "_corrupt_record"
_COPY_BYTES = 1 << 20


def _locate(uri: str):
    """The file system a path belongs to, and the path within it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def plain_csv(spark: SparkSession, path: str) -> list[str]:
    """The plain files of a CSV source: those of ``<path>.zip``, unpacked, if there is one."""
    return unzip(spark, f"{path}.zip") if _exists(spark, f"{path}.zip") else [path]


def csv_columns(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False
                ) -> list[str]:
    """The column names in the header of plain CSV files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.options(header=True, escape='"', multiLine=multiline).csv(paths).columns


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = False,
             strict: bool = True) -> DataFrame:
    """The named columns of a CSV file with a header, as text.

    Reads ``<path>.zip`` when there is one, else ``path`` itself (plain, gz or bz2,
    one file or a folder). ``multiline`` allows line breaks inside quoted fields, at
    the price of reading each file in one piece.
    """
    return scan_plain_csv(spark, plain_csv(spark, path), columns, multiline, strict)


def scan_plain_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                   multiline: bool = False, strict: bool = True) -> DataFrame:
    """The named columns of plain CSV files that all have the same header, as text.

    A file with another header fails, whatever ``strict`` says: no row of it could be told right
    from wrong. A record with more or fewer fields than the header fails if ``strict``; otherwise
    the column ``_corrupt_record`` holds it, and is null in all other rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = csv_columns(spark, paths, multiline)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if not strict:
        schema = schema.add(CORRUPT, T.StringType())
    raw = spark.read.schema(schema).options(
        header=True, escape='"', multiLine=multiline, enforceSchema=False, columnPruning=False,
        mode="FAILFAST" if strict else "PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
    ).csv(paths)
    found = [F.when(F.col(f"`{c}`").isin(list(MISSING_TEXTS)), None).otherwise(F.col(f"`{c}`"))
             .alias(c) for c in columns]
    return raw.select(*found) if strict else raw.select(*found, CORRUPT)


def unzip(spark: SparkSession, path: str) -> list[str]:
    """Unpack zip archives (a file, folder or pattern) to the shared folder; list the files.

    An archive gives its member that is named as the archive is, without ``.zip``, or else its
    only ``.csv`` member; other members are ignored. Spark has no zip codec, and an archive cannot
    be split: tasks unpack one archive each, as a stream. What comes after can be split.
    """
    target = fresh_path(spark, "unzipped")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                name = uri.rsplit("/", 1)[-1].removesuffix(".zip")
                system, place = _locate(uri)
                out_system, folder = _locate(target)
                out_system.create_dir(folder, recursive=True)
                with system.open_input_file(place) as stored, zipfile.ZipFile(stored) as archive:
                    members = [m for m in archive.namelist() if not m.endswith("/")]
                    named = [m for m in members if m.rsplit("/", 1)[-1] == name]
                    found = named or [m for m in members if m.lower().endswith(".csv")]
                    if len(found) != 1:
                        raise ValueError(f"{uri}: which of {members} is the table?")
                    # a task that runs twice writes two files and reports one
                    file = f"{uuid.uuid4().hex}.csv"
                    with archive.open(found[0]) as text, \
                            out_system.open_output_stream(f"{folder}/{file}") as out:
                        shutil.copyfileobj(text, out, _COPY_BYTES)
                yield pd.DataFrame({"archive": [uri], "file": [f"{target}/{file}"]})

    archives = spark.read.format("binaryFile").load(path).select("path")
    done = settle(archives.repartition(spark.sparkContext.defaultParallelism, "path")
                  .mapInPandas(unpack, "archive string, file string"), "archives")
    return [row["file"] for row in done.orderBy("archive").collect()]


def zip_files(spark: SparkSession, pattern: str, target: str) -> None:
    """Pack each matching file into an archive of its own below the folder ``target``."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                name = uri.rsplit("/", 1)[-1]
                system, place = _locate(uri)
                out_system, folder = _locate(target)
                out_system.create_dir(folder, recursive=True)
                with (
                    system.open_input_stream(place) as plain,
                    out_system.open_output_stream(f"{folder}/{name}.zip") as out,
                    zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
                    archive.open(name, "w", force_zip64=True) as member,
                ):
                    shutil.copyfileobj(plain, member, _COPY_BYTES)
                yield pd.DataFrame({"name": [name]})

    found = spark.read.format("binaryFile").load(pattern).select("path")
    found.mapInPandas(pack, "name string").write.format("noop").mode("overwrite").save()


def scan_json(spark: SparkSession, path: str, schema: T.StructType,
              array: bool = True, strict: bool = True) -> DataFrame:
    """Records of a JSON file: one array per file, or one record per line.

    An array file is read in one piece; large data should come as lines. A record that cannot be
    read fails if ``strict``, else the column ``_corrupt_record`` holds it.
    """
    if strict:
        return spark.read.schema(schema).options(multiLine=array, mode="FAILFAST").json(path)
    lenient = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(lenient).options(
        multiLine=array, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """The named columns as CSV with a header, one file per task."""
    df.select(*columns).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, UTF-8, one file per task."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
