"""Table store (A8, A9, B1-B11): keyed tables of year-partitioned parquet.

Layout: ``{root}/{env}/{name}/year=YYYY/part-*.parquet`` for yearly tables,
``{root}/{env}/{name}/part-*.parquet`` for snapshot ("id file") tables.

Writes only touch the years present in the incoming rows (dynamic partition
overwrite).  Merged rows are first written as a reliable checkpoint in the
session's shared checkpoint folder, so the overwrite never reads the files it
replaces and a lost executor can recompute from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.cleaning import distinct_years
from panelforge.operators.joins import asof_join
from panelforge.session import reliable_checkpoint


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    ids: tuple
    yearly: bool = True
    date_col: str = "date"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """File-system glob (listing only; no file contents pass the driver)."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return [] if st is None else [s.getPath().toString() for s in st]


def _checkpointed(df: DataFrame) -> DataFrame:
    return reliable_checkpoint(df)


class Table:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.name}"

    # ------------------------------------------------------------ read
    def exists(self, year: int | None = None) -> bool:
        if year is None or not self.spec.yearly:
            return path_exists(self.spark, self.path)
        return path_exists(self.spark, f"{self.path}/year={year}")

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.spec.schema)

    def read(self, start=None, end=None, years: Sequence[int] | None = None, keep_year: bool = False) -> DataFrame:
        """Whole table, a date range (adds the ``year`` predicate so partitions
        are pruned) or given years.  A missing table reads as empty."""
        if not self.exists():
            return self.empty()
        schema = self.spec.schema
        if self.spec.yearly:
            schema = T.StructType(list(schema.fields) + [T.StructField("year", T.IntegerType())])
        df = self.spark.read.schema(schema).parquet(self.path)
        if self.spec.yearly:
            d = F.col(self.spec.date_col)
            if start is not None:
                df = df.filter((F.col("year") >= int(str(start)[:4])) & (d >= F.lit(str(start)).cast("date")))
            if end is not None:
                df = df.filter((F.col("year") <= int(str(end)[:4])) & (d <= F.lit(str(end)).cast("date")))
            if years is not None:
                df = df.filter(F.col("year").isin([int(y) for y in years]))
            if not keep_year:
                df = df.drop("year")
        return df

    # ------------------------------------------------------------ writes
    def _conform(self, df: DataFrame, *kept: str) -> DataFrame:
        """Target columns in catalogue order and types; extra columns dropped but those
        ``kept``, missing ones NULL."""
        cols = []
        for f in self.spec.schema.fields:
            c = F.col(f.name) if f.name in df.columns else F.lit(None)
            cols.append(c.cast(f.dataType).alias(f.name))
        return df.select(*cols, *kept)

    def _write(self, df: DataFrame, mode: str = "overwrite") -> None:
        """Rows meet by year in partitions of the advisory size (AQE splits the
        large years and joins the small ones), so a write leaves a few files a
        year and not one for each task and year."""
        if self.spec.yearly:
            out = df.withColumn("year", F.year(self.spec.date_col)).hint("rebalance", "year")
            (out.sortWithinPartitions("year", *self.spec.ids).write.mode(mode)
             .option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(self.path))
        else:
            df.write.mode(mode).parquet(self.path)

    def _laid(self, df: DataFrame) -> None:
        """Rows are written where they lie, sorted by year: not moved once more.  For
        rows that lie in partitions of some size, as those of an exchange or of a
        checkpoint do."""
        if self.spec.yearly:
            out = df.withColumn("year", F.year(self.spec.date_col)).sortWithinPartitions("year", *self.spec.ids)
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(self.path)
        else:
            df.write.mode("overwrite").parquet(self.path)

    def overwrite(self, df: DataFrame, apart: bool = False) -> None:
        """Replace the snapshot, or the years present in ``df`` (which may
        come from the stored rows: it is then written aside first; not where they are
        rows of other tables only, ``apart``)."""
        df = self._conform(df)
        self._laid(_checkpointed(df) if self.exists() and not apart else df)

    def create_partition(self, year: int | None = None) -> None:
        """B2: a typed empty year (or snapshot), unless it exists."""
        if not self.exists(year):
            target = f"{self.path}/year={int(year)}" if self.spec.yearly else self.path
            self.empty().write.parquet(target)

    def _unique(self, rows: DataFrame, on: Sequence[str]) -> None:
        from panelforge.operators.quality import duplicate_keys

        if not duplicate_keys(rows, list(on)).isEmpty():
            raise ValueError(f"{self.spec.name}: new rows are not unique on {', '.join(on)}")

    def _touched(self, rows: DataFrame, on: Sequence[str]) -> DataFrame:
        """Existing rows that ``rows`` may meet: of the years present in it (a list as
        long as the calendar, so that no other year is read or moved), or all where
        the key holds no date."""
        if not self.spec.yearly or not self.exists() or self.spec.date_col not in on:
            return self.read()
        years = [r["year"] for r in distinct_years(rows, self.spec.date_col).filter("year is not null").collect()]
        return self.read(years=years)

    def _counted(self, rows: DataFrame, on: Sequence[str]) -> DataFrame:
        """``rows`` with ``_same``, how many of them share their key; the exchange and
        sort are those of the merge that follows."""
        return rows.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy(*on)))

    def _sole(self, rows: DataFrame, on: Sequence[str]) -> DataFrame:
        """A row whose key others share raises while the plan that writes runs."""
        refused = F.raise_error(F.lit(self._refusal(on))).cast("boolean")
        return rows.filter(F.when(F.col("_same") > 1, refused).otherwise(F.lit(True))).drop("_same")

    def _refusal(self, on: Sequence[str]) -> str:
        return f"{self.spec.name}: new rows are not unique on {', '.join(on)}"

    def _staged(self, rows: DataFrame, on: Sequence[str]) -> DataFrame:
        try:
            return _checkpointed(rows)
        except Exception as e:
            if self._refusal(on) in str(e):
                raise ValueError(self._refusal(on)) from e
            raise

    def _first(self, rows: DataFrame, on: Sequence[str]) -> None:
        """A table's first rows replace nothing that they could read, so they are written
        where the count of their keys has dealt them out: not staged, moved once.  The
        job commits all files or none; a failed one leaves no folder."""
        try:
            self._laid(rows)
        except Exception as e:
            fs, p = _fs(self.spark, self.path)
            if fs.exists(p) and not fs.listStatus(p):
                fs.delete(p, False)
            if self._refusal(on) in str(e):
                raise ValueError(self._refusal(on)) from e
            raise

    def _merge(self, rows: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        target = [f.name for f in self.spec.schema.fields]
        fixed = {self.spec.date_col} - set(on) if self.spec.yearly else set()  # a row stays in its year
        new = rows.select(*[c for c in rows.columns if (c in target and c not in fixed) or c == "_same"])
        old = self._touched(rows, on)
        n = new.select(*[F.col(c).alias(f"_n_{c}") if c not in on and c != "_same" else F.col(c) for c in new.columns])
        j = old.join(n, list(on), "full_outer" if how == "full" else "left")
        if "_same" in new.columns:
            j = self._sole(j, on)
        out = []
        for c in target:
            if c in on:
                out.append(F.col(c))
            elif c in new.columns:
                out.append(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c))
            else:
                out.append(F.col(c))
        return j.select(*out)

    def upsert(self, rows: DataFrame, counted: bool = False) -> None:
        """Full outer merge on the ids; non-null new values win, NULLs in
        the new rows keep the old value, unmatched new rows are appended, new
        columns outside the schema are dropped.  Only touched years are
        rewritten; rows that are not unique on the ids are refused by the job that
        merges, before the table is touched.  ``counted``: the rows have ``_same``, how
        many share their key, from a plan in which they lay by a part of it; the first
        ones are then not moved for that."""
        ids = self.spec.ids
        if not self.exists():  # first write: nothing to merge with, nothing read back
            target = [f.name for f in self.spec.schema.fields]
            if counted:
                first = self._conform(rows, "_same")
            else:
                first = self._counted(self._conform(rows.select(*[c for c in rows.columns if c in target])), ids)
            self._first(self._sole(first, ids), ids)
            return
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read for the year list and the merge
        try:
            new = rows if counted else self._counted(rows, ids)
            self._write(self._staged(self._conform(self._merge(new, ids, "full")), ids))
        finally:
            rows.unpersist()

    def update(self, rows: DataFrame, on: Sequence[str] | None = None) -> None:
        """Like upsert but rows without a match are not inserted.  ``on`` may
        be any key (a row may then change stored rows of many years); the stored
        date stays where it is no part of the key."""
        if not self.exists():  # nothing to update
            return
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._unique(rows, on or self.spec.ids)
            self._write(_checkpointed(self._conform(self._merge(rows, on or self.spec.ids, "left"))))
        finally:
            rows.unpersist()

    def delete(self, year: int) -> None:
        """Drop one year partition (or the snapshot)."""
        target = f"{self.path}/year={int(year)}" if self.spec.yearly else self.path
        fs, p = _fs(self.spark, target)
        if fs.exists(p):
            fs.delete(p, True)

    def update_asof(self, right: DataFrame, left_on: str, right_on: str, by, strategy: str = "backward",
                    drop_right_cols: Sequence[str] = (), year: int | None = None,
                    tie_break: Sequence[str] = ()) -> DataFrame:
        """The stored rows (one year or all) brought up to date from the
        matching row of ``right``.  A column known to both takes the matched
        value where there is one, all other columns are kept; ``right_on`` only
        serves the match.  Key and time come first, the rest by name.
        ``store_asof`` writes the result."""
        by = [by] if isinstance(by, str) else list(by)
        stored = self.read(years=None if year is None else [year])
        fixed = [*by, left_on]
        news = [c for c in right.columns if c not in {*fixed, right_on, *drop_right_cols}]
        row = F.struct(*news) if news else F.lit(None).cast("string")
        ties = [F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_break)]
        matched = asof_join(stored, right.select(*by, F.col(right_on).alias("_from"), row.alias("_row"), *ties), left_on,
                            "_from", by, strategy, [f"_tie{i}" for i in range(len(ties))])

        def resolved(c: str):
            if c not in news:
                return F.col(c)
            return F.coalesce(F.col("_row")[c], F.col(c)) if c in stored.columns else F.col("_row")[c]

        names = sorted({*stored.columns, *news}.difference(fixed))
        return matched.select(*fixed, *[resolved(c).alias(c) for c in names])

    def store_asof(self, *args, **kwargs) -> Table:
        """``update_asof``, written: the years present are replaced, and the
        returned table has the result's columns."""
        df = self.update_asof(*args, **kwargs)
        spec = TableSpec(self.spec.name, df.schema, self.spec.ids, self.spec.yearly, self.spec.date_col)
        out = Table(self.spark, self.path.rsplit("/", 1)[0], spec)
        out.overwrite(df)
        return out


def replace(spark: SparkSession, root: str, name: str, df: DataFrame, yearly: bool = True, date_col: str = "date") -> Table:
    """Write ``df`` as table ``name`` with its own schema (years present are replaced)."""
    spec = TableSpec(name, df.schema, tuple(), yearly, date_col)
    t = Table(spark, root, spec)
    t._write(_checkpointed(df))
    return t


def merge_with_evolution(table: Table, rows: DataFrame, on: Sequence[str], how: str = "full") -> Table:
    """Add columns of ``rows`` missing from the table as typed NULLs (schema
    evolution), then merge with ``how`` ("full" = upsert, "left" = update)."""
    have = {f.name for f in table.spec.schema.fields}
    extra = [f for f in rows.schema.fields if f.name not in have]
    spec = TableSpec(table.spec.name, T.StructType(list(table.spec.schema.fields) + extra), tuple(on),
                     table.spec.yearly, table.spec.date_col)
    evolved = Table(table.spark, table.path.rsplit("/", 1)[0], spec)
    if how == "full":
        evolved.upsert(rows)
    elif how == "left":
        evolved.update(rows, on)
    else:
        raise ValueError(f"unknown merge {how!r}: full or left")
    return evolved
