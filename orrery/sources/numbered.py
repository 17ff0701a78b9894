"""Numbered per-record CSV files (S1-S4, E7) and their export.

The reference keeps one record per file ``<dir>/<id>.csv``.  Reading them is
a schema'd CSV scan; the record id comes from ``_metadata.file_name``, which
Spark can prune on: a filter on the id range opens only the matching files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..operators.split import slice_records

ID_PATTERN = r"^(\d+)\.csv$"


#: A number as it may be written in a file: no suffixes, no names of special values.
NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"


def _schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(width)])


def strict_csv(reader, width: int, header: bool = False, glob: str = "*.csv"):
    """Options of ``spark.read`` or ``spark.readStream``: fields as they are written; a row with another number fails."""
    return (reader.schema(_schema(width))
            .option("mode", "FAILFAST")
            .option("header", header)
            .option("enforceSchema", True)
            .option("pathGlobFilter", glob))


def _is_number(i: int) -> Column:
    return F.coalesce(F.col(f"c{i}").rlike(NUMBER), F.lit(False))


def _number(i: int) -> Column:
    return F.trim(F.translate(F.col(f"c{i}"), "\t", " ")).cast("double")


def numbers(width: int) -> Column:
    """All fields as one array; fails if any field is empty or not a number, whichever of them is used."""
    bad = F.array_compact(F.array(*[F.when(~_is_number(i), F.concat(F.lit(f"field {i}: "), F.coalesce(f"c{i}", F.lit(""))))
                                    for i in range(width)]))
    return F.when(F.size(bad) == 0, F.array(*[_number(i) for i in range(width)])).otherwise(
        F.raise_error(F.concat(F.lit("not a number, "), bad[0])))


def _file_number() -> Column:
    """The number in ``<id>.csv``, NULL for another name (safe under ANSI casts)."""
    digits = F.regexp_extract(F.col("_metadata.file_name"), ID_PATTERN, 1)
    return F.when(digits != "", digits.cast("long"))


def record_id_col() -> Column:
    """The record id from ``<id>.csv``; a row of a file not named by a number fails the query."""
    return F.coalesce(_file_number(), F.raise_error(F.concat(F.lit("no record number in the name of "),
                                                             F.col("_metadata.file_path"))).cast("long"))


def read_numbered_csv(spark: SparkSession, path: str, width: int, lo: int | None = None,
                      hi: int | None = None, name: str = "features") -> DataFrame:
    """``(record_id, <name> ARRAY<DOUBLE>)`` for files ``lo..hi`` (inclusive) of ``path``.

    Parsing is strict (E7): an empty or non-numeric field in any column, a short row, or a file not named by a number
    fails the scan.
    """
    df = strict_csv(spark.read, width).csv(path)
    # The bounds prune files by name; a file without a number passes them, so that it fails and does not vanish.
    number = _file_number()
    if lo is not None:
        df = df.where(number.isNull() | (number >= lo))
    if hi is not None:
        df = df.where(number.isNull() | (number <= hi))
    return df.select(record_id_col().alias("record_id"), numbers(width).alias(name))


def read_csv_dir(spark: SparkSession, path: str, width: int, name: str = "features") -> DataFrame:
    """Every ``*.csv`` of a folder stacked row-wise, with its file's record id (NULL for another name)."""
    return strict_csv(spark.read, width).csv(path).select(_file_number().alias("record_id"), numbers(width).alias(name))


def read_sequences(spark: SparkSession, path: str, width: int, header_rows: int = 1,
                   name: str = "x") -> DataFrame:
    """S3: ``(record_id, step, x)``; one header row per file, file row order is the time axis.

    Rows are numbered in place: a task counts the rows of each split of a file
    while they stream through, so neither fields nor ids are shuffled or
    checkpointed.  Splits of one file are joined by offsets, the prefix sums of
    their line counts.  Only files larger than the least split can have several,
    so that counting reads those files alone and yields one row for each of
    their splits: at most one for every ``spark.sql.files.openCostInBytes`` bytes.
    """
    if header_rows not in (0, 1):
        raise ValueError("only 0 or 1 header rows are supported")
    df = strict_csv(spark.read, width, header=header_rows == 1).csv(path)
    rows = _numbered_rows(df.select(record_id_col().alias("record_id"),
                                    F.col("_metadata.file_block_start").alias("block"), numbers(width).alias(name)), name)
    least = int(spark._jsparkSession.sessionState().conf().filesOpenCostInBytes())
    large = df.where(F.col("_metadata.file_size") > least)
    counts = large.groupBy(_file_number().alias("record_id"), F.col("_metadata.file_block_start").alias("block")).agg(
        F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("record_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("record_id", "block", F.sum("n").over(before).alias("before")).where("before > 0")
    out = rows.join(F.broadcast(offsets), ["record_id", "block"], "left")
    return out.select("record_id", (F.col("row") + F.coalesce("before", F.lit(0))).cast("int").alias("step"), name)


def _numbered_rows(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (record_id, block, x) with their position in the block; a task reads a block in order and whole."""
    ship_package(rows.sparkSession)

    def run(batches):
        last, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)])
            starts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            at = np.arange(b.num_rows)
            row = at - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [b.num_rows]])))
            head = starts[0] if len(starts) else b.num_rows
            if last is not None and (keys[0] == last).all():
                row[:head] += n
            last, n = keys[-1], int(row[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(row)], ["record_id", "block", name, "row"])

    return rows.mapInArrow(run, f"record_id long, block long, `{name}` array<double>, row long")


def read_dataset(spark: SparkSession, features_dir: str, width: int,
                 targets: str | Sequence[str] | None = None, target_widths: int | Sequence[int] = 1,
                 start: int | None = None, end: int | None = None,
                 target_names: Sequence[str] | None = None, sequence: bool = False) -> DataFrame:
    """Features plus one or many label folders, aligned by record id, optionally sliced.

    All folders are listed and scanned as one, the role of a line comes from
    its folder, and one shuffle by record id brings a record's lines together;
    records without a line in every folder are left out.  A file not named by a
    number, a second line, or a line that is not exactly as many numbers as its
    role has fails the query.

    ``start``/``end`` follow P1 (half-open on the record id, 0 means unset).
    ``sequence=True`` reads ``features_dir`` as sequence files (one header row,
    S3) and returns the long ``(record_id, step, x, labels...)`` table.
    """
    tlist = [] if targets is None else [targets] if isinstance(targets, str) else list(targets)
    widths = [target_widths] * len(tlist) if isinstance(target_widths, int) else list(target_widths)
    names = list(target_names) if target_names else [f"y{i}" for i in range(len(tlist))]
    roles = list(zip(names, tlist, widths))
    if not sequence:
        roles.insert(0, ("features", features_dir, width))
    out = read_sequences(spark, features_dir, width) if sequence else None
    if roles:
        records = _read_roles(spark, roles)
        for nm, _, w in roles:
            if w == 1 and nm != "features":
                records = records.withColumn(nm, F.col(nm)[0])  # a label folder of width 1 becomes a scalar column
        out = records if out is None else out.join(records, "record_id")
    return slice_records(out, start, end)


def _read_roles(spark: SparkSession, roles: Sequence[tuple[str, str, int]]) -> DataFrame:
    """(record_id, one array per role) of the records with one line in every folder of ``roles`` (name, folder, width)."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text([folder for _, folder, _ in roles])
    folder = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///"), "/[^/]*$", "")
    role, size = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, (_, path, w) in enumerate(roles):
        here = folder == qualified(spark, path)
        role, size = F.when(here, i).otherwise(role), F.when(here, w).otherwise(size)
    rows = lines.where(F.trim("value") != "").select(
        record_id_col().alias("record_id"), role.alias("role"), size.alias("size"), F.split("value", ",").alias("f"),
        F.col("_metadata.file_path").alias("path"))
    wrong = F.filter("f", lambda x: ~x.rlike(NUMBER))
    values = F.when((F.size("f") == F.col("size")) & (F.size(wrong) == 0), F.transform(
        "f", lambda x: F.trim(F.translate(x, "\t", " ")).cast("double"))).otherwise(F.raise_error(
            F.concat(F.lit("not a line of "), F.col("size").cast("string"), F.lit(" numbers, "), F.col("path"))))
    rows = rows.select("record_id", "role", values.alias("x"))
    once = rows.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.max(F.when(F.col("role") == i, F.col("x"))).alias(nm) for i, (nm, _, _) in enumerate(roles)])
    found = F.size(F.array_compact(F.array(*[F.when(F.col(nm).isNotNull(), 1) for nm, _, _ in roles])))
    twice = F.when(F.col("n") > found, F.raise_error(F.concat(
        F.lit("several lines in a file of record "), F.col("record_id").cast("string"))).cast("long"))
    once = once.select(F.coalesce(twice, F.col("record_id")).alias("record_id"), found.alias("found"),
                       *[nm for nm, _, _ in roles])
    return once.where(F.col("found") == len(roles)).drop("found")


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Hadoop names it, with its file system (``file:///`` for local ones)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root)
    uri = root.toUri().toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def validate_numeric(spark: SparkSession, path: str, width: int, glob: str = "*.csv") -> DataFrame:
    """One row on all fields of all files: rows, rows of numbers only, empty fields, other bad fields, and the
    sum of the good rows.  ``read_numbered_csv`` fails on what this counts; a short row fails here too."""
    df = strict_csv(spark.read, width, glob=glob).csv(path)

    def fields(test):
        return F.size(F.array_compact(F.array(*[F.when(test(i), 1) for i in range(width)]))).cast("long")

    empty = fields(lambda i: F.coalesce(F.trim(f"c{i}"), F.lit("")) == "")
    bad = fields(lambda i: ~_is_number(i)) - empty
    total = F.lit(0.0)
    for i in range(width):
        total = total + F.when(_is_number(i), _number(i))
    rows = df.select(empty.alias("empty"), bad.alias("bad"), total.alias("total"))
    good = (F.col("empty") == 0) & (F.col("bad") == 0)
    return rows.agg(F.count("*").alias("n_rows"), F.count(F.when(good, 1)).alias("n_good_rows"),
                    F.sum("empty").alias("n_empty_fields"), F.sum("bad").alias("n_bad_fields"),
                    F.round(F.sum(F.when(good, F.col("total"))), 4).alias("good_total"))


# ------------------------------------------------------------------ export

def write_numbered_csv(df: DataFrame, path: str, id_col: str, array_col: str,
                       header: str | None = None, order_col: str | None = None) -> int:
    """Write one ``<id>.csv`` per record id under ``path`` (inverse of S1/S3).

    With ``order_col`` each id may own many rows (a sequence): rows are
    clustered by id and sorted, and every file is streamed out batch by batch,
    so a task holds one Arrow batch, never a whole record (a file is written by
    one task: the format has one file per record).  Each file is written under
    a hidden temporary name and renamed into place, so readers only see whole
    files and a retried or speculative task attempt is harmless.  Returns the
    number of files.
    """
    from pyarrow import fs as pafs

    ship_package(df.sparkSession)
    fields = F.transform(F.col(array_col), lambda v: F.coalesce(v.cast("double").cast("string"), F.lit("")))
    line = F.concat(F.array_join(fields, ","), F.lit("\n")).cast("binary").alias("__line")
    if order_col is None:
        twice = df.groupBy(F.col(id_col).cast("long")).count().where("count > 1").limit(1)
        if not twice.isEmpty():
            raise ValueError(f"record id {twice.first()[0]} has several rows; name their order with order_col")
        data = df.select(F.col(id_col).cast("long").alias("__id"), line)
    else:
        data = (df.select(F.col(id_col).cast("long").alias("__id"), line, F.col(order_col).alias("__o"))
                .repartition("__id").sortWithinPartitions("__id", "__o"))

    base = qualified(df.sparkSession, path.rstrip("/"))

    def write(batches):
        import uuid
        filesystem, root = pafs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex
        n_files = 0
        cur_id, stream = None, None

        def finish():
            stream.close()
            filesystem.move(f"{root}/.{cur_id}.csv.{attempt}", f"{root}/{cur_id}.csv")

        for b in batches:
            for i, line in zip(b.column("__id").to_pylist(), b.column("__line")):
                if i != cur_id:
                    if stream is not None:
                        finish()
                    cur_id = i
                    stream = filesystem.open_output_stream(f"{root}/.{i}.csv.{attempt}")
                    if header is not None:
                        stream.write((header + "\n").encode())
                    n_files += 1
                stream.write(line.as_buffer())
        if stream is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"n": [n_files]}, schema=pa.schema([("n", pa.int64())]))

    res = data.mapInArrow(write, "n long").agg(F.sum("n").alias("n")).first()
    return int(res["n"] or 0)
