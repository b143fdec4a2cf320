"""Vendor archive and text-file sources.

Archives are read by a Spark data source (``ZipLines``): it looks up each archive's
directory of members and makes partitions of them, a large member being one of its
own, so an archive of many members is read by many tasks.  A task opens the archive
where it lies, reads its members' ranges only, and streams them line by line in
chunks: neither an archive nor a member is ever held whole.  Fields are put in order
by each member's own header, so members whose column order differs are read by name;
then typed with ``try_cast``.  The driver only lists files and members.
"""

from __future__ import annotations

import io
import itertools
import json
import time
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from panelforge.functions.numeric import finite_or_null
from panelforge.operators.cleaning import TRAILER
from panelforge.sources.tables import glob_paths
from panelforge.sources.vendor import RAW_STRING_COLUMNS

@dataclass(frozen=True)
class ArchiveSpec:
    """A5: naming rules of one vendor dataset.

    history archives: ``{history_prefix}_{year}*.zip`` with members starting
    with ``member_prefix``; daily archives ``{daily_prefix}_{yymmdd}.zip`` with
    member ``{daily_member}.{yyyymmdd}``."""

    history_prefix: str | None
    member_prefix: str
    daily_prefix: str
    daily_member: str
    skip: int = 1
    sep: str = "|"
    history_folder: str = ""
    daily_folder: str = ""

    @staticmethod
    def _join(root: str, folder: str) -> str:
        return root.rstrip("/") + (f"/{folder.strip('/')}" if folder else "")

    def history_glob(self, root: str, year: int | None = None) -> str:
        if self.history_prefix is None:
            raise ValueError("dataset has no history archives")
        base = self._join(root, self.history_folder)
        return f"{base}/{self.history_prefix}_{'' if year is None else year}*.zip"

    def daily_path(self, root: str, d: date) -> str:
        return f"{self._join(root, self.daily_folder)}/{self.daily_prefix}_{d:%y%m%d}.zip"

    def daily_member_name(self, d: date) -> str:
        return f"{self.daily_member}.{d:%Y%m%d}"


# lines that a task holds before it hands them on, and compressed bytes of members that share a partition
CHUNK, PACKED = 20_000, 16_000_000


def _lines(zf: zipfile.ZipFile, name: str, skip: int, sep: str, columns: Sequence[str]) -> Iterator[list]:
    """A member's data lines, fields in the order of ``columns`` by its own header (short
    lines are padded, the end-of-file line is dropped wherever the key column stands)."""
    with zf.open(name) as fh:
        places = None
        for i, raw in enumerate(io.TextIOWrapper(fh, encoding="utf-8")):
            line = raw.rstrip("\r\n")
            if i < skip or not line:
                continue
            fields = line.split(sep)
            if places is None:
                at = {c: k for k, c in enumerate(fields)}
                places = [at.get(c, len(fields) + 1) for c in columns]
            elif len(fields) > 1 or fields[0].strip() != TRAILER:
                yield [fields[k] if k < len(fields) and fields[k] != "" else None for k in places]


@contextmanager
def _archive(path: str):
    store, target = _store(path)
    with store.open_input_file(target) as fh, zipfile.ZipFile(fh) as zf:
        yield zf


@dataclass
class Members(InputPartition):
    """Members (archive, name) that one task reads."""

    found: list[tuple[str, str]]


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.columns, self.names = (json.loads(options[k]) for k in ("paths", "columns", "names"))
        self.prefix, self.skip, self.sep = options["prefix"], int(options["skip"]), options["sep"]

    def listed(self, path: str) -> list[tuple[str, str, int]]:
        """(archive, member, compressed bytes) of the members to read, from the directory
        at the archive's end."""
        with _archive(path) as zf:
            infos = sorted(zf.infolist(), key=lambda i: i.filename)
        if self.names is not None:
            infos = [i for i in infos if i.filename == self.names.get(path.rsplit("/", 1)[-1])]
        return [(path, i.filename, i.compress_size) for i in infos if i.filename.startswith(self.prefix)]

    def partitions(self) -> list[Members]:
        with ThreadPoolExecutor(16) as pool:
            every = list(itertools.chain.from_iterable(pool.map(self.listed, self.paths)))
        out, room = [], 0
        for path, name, size in every:
            if not out or size > room:
                out.append(Members([]))
                room = PACKED
            out[-1].found.append((path, name))
            room -= size
        return out or [Members([])]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        for path, members in itertools.groupby(partition.found, key=lambda m: m[0]):
            with _archive(path) as zf:
                rows = itertools.chain.from_iterable(_lines(zf, name, self.skip, self.sep, self.columns) for _, name in members)
                while chunk := list(itertools.islice(rows, CHUNK)):
                    yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.list_(pa.string()))], ["values"])


class ZipLines(DataSource):
    """Spark data source of the data lines of zip archives; options ``paths``, ``columns``
    and ``names`` (member by archive, or null) as JSON, ``prefix``, ``skip``, ``sep``."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return "values array<string>"

    def reader(self, schema: T.StructType) -> ZipReader:
        return ZipReader(self.options)


def read_lines(spark: SparkSession, paths: Sequence[str] | str, member_prefix: str | None, skip: int,
               raw_columns: Sequence[str], sep: str = "|", members: dict | None = None) -> DataFrame:
    """One row per data line of the archives: ``values``, the raw columns' texts
    in order (empty and absent: NULL); ``members`` maps an archive's file name to
    the one member to read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], "values array<string>")
    spark.dataSource.register(ZipLines)
    options = {"paths": json.dumps(paths), "columns": json.dumps(list(raw_columns)), "names": json.dumps(members)}
    return spark.read.format(ZipLines.name()).options(**options, prefix=member_prefix or "", skip=str(skip), sep=sep).load()


def typed(lines: DataFrame, raw_columns: Sequence[str], numeric: Sequence[str] | None = None) -> DataFrame:
    """The raw columns: text columns stay strings, the rest are numbers; a text
    that is no finite number gives NULL."""
    cols = []
    for i, c in enumerate(raw_columns):
        v = F.col("values")[i]
        is_text = c in RAW_STRING_COLUMNS if numeric is None else c not in numeric
        cols.append((v if is_text else finite_or_null(v.try_cast("double"))).alias(c))
    return lines.select(*cols)


def read_history(spark: SparkSession, root: str, spec: ArchiveSpec, raw_columns: Sequence[str],
                 years: Sequence[int] | None = None) -> DataFrame:
    """A1/A2: every history archive of the given years (all when None)."""
    pats = [spec.history_glob(root, y) for y in years] if years else [spec.history_glob(root)]
    paths = sorted({p for pat in pats for p in glob_paths(spark, pat)})
    return typed(read_lines(spark, paths, spec.member_prefix, spec.skip, raw_columns, spec.sep), raw_columns)


def read_daily(spark: SparkSession, root: str, spec: ArchiveSpec, raw_columns: Sequence[str],
               sessions: Sequence[date], latest_only: bool = False) -> DataFrame:
    """A3: the daily archives of the given sessions that exist (missing days are
    simply absent); A4 with ``latest_only``: only the newest existing one.
    ``sessions`` is a short list (e.g. the last 60 sessions)."""
    existing = []
    for d in sorted(sessions):
        found = glob_paths(spark, spec.daily_path(root, d))
        if found:
            existing.append((d, found[0]))
    if latest_only:
        existing = existing[-1:]
    members = {p.rsplit("/", 1)[-1]: spec.daily_member_name(d) for d, p in existing}
    lines = read_lines(spark, [p for _, p in existing], None, spec.skip, raw_columns, spec.sep, members)
    return typed(lines, raw_columns)


# ------------------------------------------------------------------ writers (fixtures / export)
def _store(path: str):
    """The file system of a URI (a shared folder, HDFS, an object store) and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return FileSystem.from_uri(path)


def _zip_writer(root: str, name_of, member_of, header_lines: Sequence[str], columns: Sequence[str], sep: str):
    """mapInPandas body over partitions sorted by archive key: an archive is open while
    the rows of its key pass, and every piece of a batch goes into its member as it
    comes, so a task holds one batch of rows, however large the archives are."""

    @contextmanager
    def member(key):
        path = f"{root.rstrip('/')}/{name_of(key)}"
        store, target = _store(path)
        # write under a private name, then rename: a retried or speculative
        # task attempt never leaves a half-written archive behind
        tmp = f"{target}.part-{uuid.uuid4().hex[:12]}"
        store.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(tmp) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            info = zipfile.ZipInfo(member_of(key), time.localtime()[:6])
            info.compress_type = zipfile.ZIP_DEFLATED
            with zf.open(info, "w", force_zip64=True) as fh:  # its size is not known before
                yield path, lambda lines: fh.write("".join(f"{x}\n" for x in lines).encode())
        store.move(tmp, target)

    def pieces(batches):
        """(key, rows) of every stretch of one key in a batch."""
        for pdf in batches:
            if pdf.empty:
                continue
            body = pdf[list(columns)].astype(object).where(pdf[list(columns)].notna(), None)
            keys = pdf["_archive"].to_numpy()
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
            for b, e in itertools.pairwise(starts):
                yield keys[b], body.iloc[b:e]

    def run(batches):
        out = {"archive": [], "rows": []}
        for key, parts in itertools.groupby(pieces(batches), key=lambda p: p[0]):
            rows = 0
            with member(key) as (path, write):
                write([*header_lines, sep.join(columns)])
                for _, body in parts:
                    write(sep.join("" if v is None else (repr(v) if isinstance(v, float) else str(v)) for v in row)
                          for row in body.itertuples(index=False))
                    rows += len(body)
                write(["[End of File]"])
            out["archive"].append(path)
            out["rows"].append(rows)
        yield pd.DataFrame(out, columns=["archive", "rows"])

    return run


def write_archives(df: DataFrame, root: str, archive_key, name_of, member_of, columns: Sequence[str],
                   header_lines: Sequence[str] = ("!generated",), sep: str = "|") -> DataFrame:
    """Write ``df`` as zip archives, one per value of ``archive_key`` (e.g. a
    year-month); returns (archive, rows).  Rows are hash-partitioned and sorted
    by the key, so each archive is written by exactly one task.  Rows without a key
    have an archive of their own, with the key ""."""
    d = df.withColumn("_archive", F.coalesce(archive_key, F.lit(""))).repartition("_archive").sortWithinPartitions("_archive")
    return d.select("_archive", *columns).mapInPandas(
        _zip_writer(root, name_of, member_of, header_lines, columns, sep), "archive string, rows long")


# ------------------------------------------------------------------ A7
def read_sectioned_csv(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date",
                       percent: bool = True) -> DataFrame:
    """Keep the first data block of a multi-section text file: the block
    starts after the header line (first line beginning with ``,``) and stops at
    the first blank line or a line starting with "Annual".  Values are trimmed,
    percent -> decimal, ``YYYYMMDD`` -> date.  One row per file (whole text),
    lines exploded with their positions."""
    txt = spark.read.text(path, wholetext=True).select(F.col("value").alias("t"), F.input_file_name().alias("f"))
    lines = txt.select("f", F.posexplode(F.split("t", "\r?\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.trim("line"))
    head = lines.filter(F.col("line").startswith(",")).groupBy("f").agg(F.min("pos").alias("h"))
    stop = lines.join(head, "f").filter((F.col("pos") > F.col("h")) & (
        (F.col("line") == "") | F.col("line").startswith("Annual"))).groupBy("f").agg(F.min("pos").alias("s"))
    body = lines.join(head, "f").join(stop, "f", "left").filter(
        (F.col("pos") > F.col("h")) & (F.col("s").isNull() | (F.col("pos") < F.col("s"))))
    ddl = ", ".join(f"{f.name} STRING" for f in schema.fields)
    parsed = body.select(F.from_csv("line", ddl, {"sep": ","}).alias("r")).select("r.*")
    out = []
    for f in schema.fields:
        c = F.trim(F.col(f.name))
        if f.name == date_col:
            out.append(F.to_date(c, "yyyyMMdd").alias(f.name))
        else:
            v = c.try_cast("double")
            out.append((v / 100 if percent else v).cast(f.dataType).alias(f.name))
    return parsed.select(*out)
