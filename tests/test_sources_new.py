"""CSV by splits, landing by tasks, quarantine, Z-order."""

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.zorder import curve
from ledgerline.plans.jobs import job_load_csv
from ledgerline.plans.tables import Warehouse, in_layout
from ledgerline.sources import landing
from ledgerline.sources.csv_records import read_csv_split, read_records
from ledgerline.sources.quarantine import REASONS, judged
from tests.conftest import SF_SMALL
from tests.fixtures import HEADERS, write_files


def write_odd_csv(path, seed, rows, sep="\n"):
    rng = random.Random(seed)
    words = ["x", "a b", "line\nbreak", 'quo"te', "com,ma", "\n\n", '"', "", "é\nü", "tail\r"]
    with open(path, "w", newline="") as fh:
        fh.write(f" k, v ,w{sep}")
        for i in range(rows):
            cells = [str(i)] + ["".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(2)]
            fh.write(",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n\r') else c for c in cells) + sep)
            if rng.random() < 0.05:
                fh.write(sep)


@pytest.mark.parametrize("sep", ["\n", "\r\n"])
def test_csv_with_quoted_line_breaks_is_read_by_many_tasks(spark, tmpdir_path, sep):
    folder = os.path.join(tmpdir_path, "csv")
    os.makedirs(folder)
    for i, rows in enumerate((400, 3, 0)):
        write_odd_csv(f"{folder}/f{i}.csv", i, rows, sep)
    whole = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
             .option("mode", "FAILFAST").csv(folder).toDF("k", "v", "w"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("64", "500", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = read_csv_split(spark, folder)
            assert got.columns == ["k", "v", "w"]
            # in files with CRLF the whole-file reader also rewrites CRLF inside fields
            plain = lambda rows: sorted(str(tuple(c and c.replace("\r\n", "\n") for c in r)) for r in rows)
            assert plain(got.collect()) == plain(whole.collect())
            if size == "64":
                assert spark.read.text(folder).rdd.getNumPartitions() > 50
            kept = read_records(spark, f"{folder}/f0.csv").orderBy("record").collect()
            assert [r["record"] for r in kept] == list(range(len(kept)))
            with open(f"{folder}/f0.csv", newline="") as fh:
                assert "\n".join(r["text"] for r in kept) + "\n" == fh.read()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_split_csv_rejects_short_rows(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "short.csv")
    with open(path, "w") as fh:
        fh.write('a,b\n1,"x\ny"\n2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_split(spark, path).collect()


def test_landing_is_done_by_tasks(spark, tmpdir_path, monkeypatch):
    """No byte passes the driver; a killed task leaves no half file."""
    import pyarrow as pa
    folder, root = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "landing")
    os.makedirs(folder)
    for i in range(5):
        with open(f"{folder}/p{i}.csv", "wb") as fh:
            fh.write(bytes(random.Random(i).choices(range(256), k=5000 * i)))
    monkeypatch.setattr(landing, "CHUNK", 1000)
    out = landing.land_files(spark, {"t": folder}, root, "20240313030000")
    for i in range(5):
        with open(f"{folder}/p{i}.csv", "rb") as a, open(f"{out['t']}/p{i}.csv", "rb") as b:
            assert a.read() == b.read()
    assert sorted(os.listdir(out["t"])) == [f"p{i}.csv" for i in range(5)]

    def stop(src, dst, n):
        dst.write(src.read(10))
        raise OSError("killed")
    target = os.path.join(root, "later")
    with monkeypatch.context() as m:
        m.setattr(landing.shutil, "copyfileobj", stop)
        with pytest.raises(OSError):
            list(landing._copy(iter([pa.RecordBatch.from_pydict({"source": [f"{folder}/p1.csv"], "folder": [target], "name": ["p1.csv"]})])))
    assert all(n.startswith("_") for n in os.listdir(target))
    assert spark.read.text(target).count() == 0


def test_quarantine_keeps_bad_rows_beside_the_table(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="qu_")
    made = "2024-03-04 08:15:00"
    files = write_files(os.path.join(tmpdir_path, "in"), {"stores": f'{HEADERS["stores"]}\n3,Dock,x,{made},{made}\nseven,Pier,y,{made},soon\n'})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|seven"):
        job_load_csv(spark, wh, {"stores": files["stores"]})
    assert job_load_csv(spark, wh, {"stores": files["stores"]}, quarantine=True) == {"stores": 1}
    bad = wh.read("public.stores__rejected").collect()
    assert [(r.store_id, r[REASONS]) for r in bad] == [("seven", ["store_id: not smallint", "updated_at: not timestamp_ntz"])]
    fine = judged(spark.sql("SELECT '1' AS a"), T.StructType([T.StructField("a", T.StringType())]))
    assert fine.first()[REASONS] == []


def row_groups_hit(folder, col, value):
    hit = total = 0
    for f in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(col)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s.min <= value <= s.max
    return hit, total


def test_every_key_skips_row_groups_along_the_curve(spark, tmpdir_path):
    keys = ["a", "b", "c", "d"]
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.xxhash64("id") % 5000).alias("b"), F.md5(F.col("id").cast("string")).alias("c"),
                                    (F.xxhash64("id", F.lit(1)) % 700).cast("double").alias("d"))
    folders = {}
    for name, by in (("curve", [curve(df, keys)]), ("lexical", [F.col(k) for k in keys])):
        folders[name] = os.path.join(tmpdir_path, name)
        df.repartitionByRange(256, *by).sortWithinPartitions(*by).write.parquet(folders[name])
    value = df.where("a = 777").first()
    assert spark.read.parquet(folders["curve"]).count() == 20_000
    share = []
    for k in keys:
        hit, total = row_groups_hit(folders["curve"], k, value[k])
        assert total > 200 and hit
        share.append(hit / total)
    assert max(share) < 0.55 and sum(share) / 4 < 0.4, share
    assert row_groups_hit(folders["lexical"], "b", value["b"])[0] > 200  # all but the first key read nearly everything


def test_curve_of_nulls_and_constants(spark):
    df = spark.createDataFrame([(None, 1), (2, 1), (3, 1)], "a int, b int")
    z = [r[0] for r in df.select(curve(df, ["a", "b"])).collect()]
    assert all(v is not None for v in z) and z[0] <= z[1] <= z[2]
    empty = df.where("false")
    assert empty.select(curve(empty, ["a", "b"])).count() == 0


def test_positions_are_computed_once_per_row_not_per_comparison(spark):
    df = spark.createDataFrame([(f"{i * 37 % 50:032x}", i) for i in range(50)], "a string, b long")
    laid = in_layout(df, 4, "b", curve(df, ["a", "b"]), "b", "a")
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Sort [" in line or "RepartitionByExpression" in line:
            assert "aggregate(" not in line and "transform(" not in line, line
    assert plan.count("conv(") == 1  # the text key's number, not again at each step of the search
    assert laid.columns == df.columns and sorted(laid.collect()) == sorted(df.collect())
