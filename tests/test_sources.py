"""Sources and streaming on hand-made files: archive members read by header
name, trailers dropped, sectioned text, idempotent streaming replay."""

import datetime as dt
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import shared_dir
from panelforge.sources import archives as AR
from panelforge.sources import extracts as EX
from panelforge.sources import tables as TB
from panelforge.sources import vendor as V
from panelforge.streaming.ingest import accept_recent, ingest_folder


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_history_archives_by_header_name(spark):
    root = shared_dir(spark, "t_arch")
    d = _local(root)
    with zipfile.ZipFile(os.path.join(d, "RET_HIST_2024a.zip"), "w") as zf:
        zf.writestr("RET_2024_1.txt", "!title\n!Barrid|Price|Capt|PriceSource|Currency|DlyReturn%|DataDate\n"
                    "USA0001|10.5|1000.0|X|USD|1.25|20240102\nUSA0002||||USD||20240102\n[End of File]\n")
        zf.writestr("OTHER.txt", "!t\n!Barrid|Price\nZZ|1\n")
    with zipfile.ZipFile(os.path.join(d, "RET_HIST_2024b.zip"), "w") as zf:  # columns in another order
        zf.writestr("RET_2024_2.txt", "!title\nDataDate|!Barrid|DlyReturn%|Price|Capt|PriceSource|Currency\n"
                    "20240103|USA0001|-2.0|11.0|1100.0|X|USD\n[End of File]\n")
    spec = AR.ArchiveSpec("RET_HIST", "RET_", "RET_DAILY", "RET", skip=1)
    raw = ["!Barrid", "Price", "Capt", "PriceSource", "Currency", "DlyReturn%", "DataDate"]
    rows = sorted((tuple(r) for r in V.RETURNS.clean(AR.read_history(spark, root, spec, raw, years=[2024])).collect()),
                  key=repr)
    assert rows == sorted([
        ("USA0001", 10.5, 1000.0, "X", "USD", 1.25, dt.date(2024, 1, 2)),
        ("USA0001", 11.0, 1100.0, "X", "USD", -2.0, dt.date(2024, 1, 3)),
        ("USA0002", None, None, None, "USD", None, dt.date(2024, 1, 2)),
    ], key=repr)


def test_sectioned_text(spark):
    root = _local(shared_dir(spark, "t_ff"))
    with open(os.path.join(root, "ff.csv"), "w") as fh:
        fh.write("This file was created\nby a tool\n\n,Mkt-RF,SMB,HML,RMW,CMA,RF\n"
                 "20240102,   1.00,  -0.50,0.25,0.10,0.00,0.02\n20240103,2.00,0.50,-0.25,0.00,0.10,0.02\n"
                 "\n Annual Factors: January-December \n,Mkt-RF,SMB,HML,RMW,CMA,RF\n  2024,  10.0,1,2,3,4,5\n")
    schema = T.StructType([T.StructField(n, T.DateType() if n == "date" else T.DoubleType())
                           for n in ["date", "mkt_rf", "smb", "hml", "rmw", "cma", "rf"]])
    out = sorted(map(tuple, AR.read_sectioned_csv(spark, os.path.join(root, "ff.csv"), schema).collect()))
    assert out == [(dt.date(2024, 1, 2), 0.01, -0.005, 0.0025, 0.001, 0.0, 0.0002),
                   (dt.date(2024, 1, 3), 0.02, 0.005, -0.0025, 0.0, 0.001, 0.0002)]


def test_stream_ingest_is_idempotent_and_incremental(spark):
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("id", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    base = shared_dir(spark, "t_stream")
    drop = base + "/drop"
    spec = TB.TableSpec("s", schema, ("date", "id"))
    t = TB.Table(spark, base + "/table", spec)
    spark.createDataFrame([(dt.date(2024, 1, 2), "a", 1.0), (dt.date(2024, 1, 3), "b", 2.0)], schema) \
        .write.mode("append").parquet(drop)
    ingest_folder(spark, drop, schema, t, base + "/_cp")
    first = sorted(map(tuple, t.read().collect()))
    ingest_folder(spark, drop, schema, t, base + "/_cp")        # replay: nothing new
    assert sorted(map(tuple, t.read().collect())) == first
    spark.createDataFrame([(dt.date(2024, 1, 3), "b", None), (dt.date(2024, 1, 4), "c", 3.0)], schema) \
        .write.mode("append").parquet(drop)
    ingest_folder(spark, drop, schema, t, base + "/_cp")
    assert sorted(map(tuple, t.read().collect())) == [
        (dt.date(2024, 1, 2), "a", 1.0), (dt.date(2024, 1, 3), "b", 2.0), (dt.date(2024, 1, 4), "c", 3.0)]


def test_an_archive_of_many_members_is_read_by_many_tasks(spark, monkeypatch):
    root = _local(shared_dir(spark, "t_zip"))
    rows = {f"m{k}.txt": [(f"a{k}_{i}", i * 1.5) for i in range(k * 30)] for k in range(9)}
    with zipfile.ZipFile(os.path.join(root, "big file_1.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("other.txt", "!\n!x|v\nno|1\n")
        for k, (name, lines) in enumerate(rows.items()):
            head = ("!id|v", "{0}|{1}") if k % 2 else ("v|unknown|!id", "{1}|?|{0}")  # columns in either order
            z.writestr(name, "\n".join(["!generated", head[0], *(head[1].format(*r) for r in lines), "[End of File]", ""]))
    spec = AR.ArchiveSpec("big file", "m", "d", "d")
    monkeypatch.setattr(AR, "CHUNK", 7)
    every = sorted(r for lines in rows.values() for r in lines)
    for packed, tasks in ((1, 9), (10**9, 1)):
        options = {"paths": json.dumps([f"{root}/big file_1.zip"]), "columns": '["!id", "v"]', "names": "null", "prefix": "m", "skip": "1", "sep": "|"}
        monkeypatch.setattr(AR, "PACKED", packed)
        reader = AR.ZipReader(options)
        assert len(reader.partitions()) == tasks
        batches = [b for p in reader.partitions() for b in reader.read(p)]
        assert max(b.num_rows for b in batches) <= 7 and sum(b.num_rows for b in batches) == len(every)
    lines = AR.read_lines(spark, f"{root}/big file_1.zip", "m", 1, ["!id", "v"])
    got = AR.typed(lines, ["!id", "v"], ["v"])
    assert sorted(map(tuple, got.collect())) == every
    assert "BatchScan" in got._jdf.queryExecution().executedPlan().toString()
    assert AR.read_history(spark, root, spec, ["!id", "v"], [2]).count() == 0


STREAM = "date date, id string, v double, w string"


def _dropped(spark, files):
    """A folder with a file for each list of rows, in this order of time."""
    drop = shared_dir(spark, "t_drop")
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, STREAM).coalesce(1).write.parquet(f"{drop}/{n} x")
    return drop + "/*"


def _streamed(spark, drop, files_at_once, calendar=None, sessions=None):
    base = shared_dir(spark, "t_stream")
    schema = spark.createDataFrame([], STREAM).schema
    t = TB.Table(spark, base + "/table", TB.TableSpec("s", schema, ("date", "id")))
    ingest_folder(spark, drop, schema, t, base + "/_cp", files_at_once, calendar, sessions)
    return sorted(map(tuple, t.read().collect()))


def test_a_stream_is_the_same_however_it_is_cut(spark):
    d = lambda n: dt.date(2024, 1, n)
    files = [
        [(d(2), "a", 1.0, "x"), (d(3), "a", 1.0, "x")],
        [(d(9), "a", 2.0, None), (d(3), "a", None, "y")],    # mark Jan 9: Jan 3 is too old from here on
        [(d(2), "a", 9.0, "z"), (d(8), "b", 3.0, "x")],
        [(d(5), "a", 4.0, "x"), (d(9), "a", None, "w"), (d(9), "a", None, "w")],  # the same row twice is one
        [(d(4), "a", 5.0, "x")],                              # too old by the mark, though its file holds nothing newer
    ]
    cal = spark.createDataFrame([(d(n),) for n in (2, 3, 4, 5, 8, 9)], "date date")
    drop = _dropped(spark, files)
    want = [(d(2), "a", 1.0, "x"), (d(3), "a", 1.0, "x"), (d(5), "a", 4.0, "x"), (d(8), "b", 3.0, "x"), (d(9), "a", 2.0, "w")]
    for k in (1, 2, 3, 9):
        assert _streamed(spark, drop, k, cal, 3) == want
    every = [(d(2), "a", 9.0, "z"), (d(3), "a", 1.0, "y"), (d(4), "a", 5.0, "x"), *want[2:]]
    for k in (1, 3):
        assert _streamed(spark, drop, k) == every


def test_conflicting_rows_raise(spark):
    rows = [(dt.date(2024, 1, 2), "a", 1.0, "x"), (dt.date(2024, 1, 2), "a", 1.0, "y")]
    with pytest.raises(Exception, match="conflicting rows"):
        _streamed(spark, _dropped(spark, [rows]), 1)
    t = TB.Table(spark, shared_dir(spark, "t_dup"), TB.TableSpec("s", spark.createDataFrame([], STREAM).schema, ("date", "id")))
    for _ in range(2):  # the first write, and a merge
        with pytest.raises(ValueError, match="not unique"):
            t.upsert(spark.createDataFrame(rows, STREAM))
        t.upsert(spark.createDataFrame(rows[:1], STREAM))
        assert t.read().count() == 1


def test_accept_recent(spark):
    cal = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (2, 3, 4, 5, 8, 9)], "date date")
    batch = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in (2, 4, 8, 9)], "date date, v double")
    kept = sorted(r.date.day for r in accept_recent(batch, cal, 3).collect())
    assert kept == [8, 9]           # the last 3 sessions up to Jan 9 are Jan 5, 8, 9


def test_year_predicates_part_the_rows(spark):
    rows = [(dt.date(y, m, d),) for y in (2019, 2020, 2021) for m, d in ((1, 1), (2, 28), (12, 31))]
    df = spark.createDataFrame(rows, "day date")
    parts = [sorted(r["day"] for r in df.filter(p).collect()) for p in EX.jdbc_year_predicates("day", [2019, 2020, 2021])]
    assert parts == [[r[0] for r in rows if r[0].year == y] for y in (2019, 2020, 2021)]


def test_files_are_listed(spark):
    root = shared_dir(spark, "t_list")
    EX.write_csv(spark.range(3).coalesce(1), root + "/a")
    files = EX.list_files(spark, root + "/a", "*.csv").collect()
    assert len(files) == 1 and files[0]["length"] > 0 and files[0]["path"].endswith(".csv")


def test_an_archive_is_written_as_its_rows_come(spark, monkeypatch):
    import pandas as pd

    root = _local(shared_dir(spark, "t_zip_out"))
    opened, plain = [], zipfile.ZipFile.open

    def spy(self, name, mode="r", **kwargs):
        if mode == "w":
            opened.append(name if isinstance(name, str) else name.filename)
        return plain(self, name, mode, **kwargs)

    monkeypatch.setattr(zipfile.ZipFile, "open", spy)
    taken = []

    def batches():  # the archive is open before its second batch is asked for, and closed before the next one's
        for k, rows in enumerate([[("a", 1.5), ("a", None)], [("a", 2.0), ("b", 0.1)], [("b", 3.0)]]):
            taken.append(list(opened))
            yield pd.DataFrame({"_archive": [r[0] for r in rows], "!id": [f"i{k}"] * len(rows), "v": [r[1] for r in rows]})

    run = AR._zip_writer(root, lambda k: f"H_{k}.zip", lambda k: f"m{k}", ["!generated"], ["!id", "v"], "|")
    got = [r for pdf in run(batches()) for r in pdf.itertuples(index=False)]
    assert taken == [[], ["ma"], ["ma", "mb"]]
    assert [(p.rsplit("/", 1)[-1], n) for p, n in got] == [("H_a.zip", 3), ("H_b.zip", 2)]
    with zipfile.ZipFile(f"{root}/H_a.zip") as zf:
        assert zf.namelist() == ["ma"] and zf.read("ma").decode() == "!generated\n!id|v\ni0|1.5\ni0|\ni1|2.0\n[End of File]\n"
    with zipfile.ZipFile(f"{root}/H_b.zip") as zf:
        assert zf.read("mb").decode().splitlines()[2:-1] == ["i1|0.1", "i2|3.0"]
    assert sorted(os.listdir(root)) == ["H_a.zip", "H_b.zip"]


def test_rows_without_an_archive_key_are_kept(spark):
    root = shared_dir(spark, "t_zip_null")
    df = spark.createDataFrame([(None, "x", 1.0), ("2024", "y", 2.0), (None, "z", 3.0)], "k string, `!id` string, v double")
    AR.write_archives(df.repartition(3), root, F.col("k"), lambda k: f"H_{k}.zip", lambda k: f"m{k}", ["!id", "v"]).count()
    spec = AR.ArchiveSpec("H", "m", "d", "d")
    lines = AR.read_lines(spark, sorted(TB.glob_paths(spark, spec.history_glob(root))), "m", 1, ["!id", "v"])
    assert sorted(map(tuple, AR.typed(lines, ["!id", "v"], ["v"]).collect())) == [("x", 1.0), ("y", 2.0), ("z", 3.0)]
