"""Landing and raw zone: typing rejects, stamps, header order, replay, pruning, streaming."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terrace.functions.casts import typed_projection
from terrace.schema import CUSTOMERS, ORDER_ITEMS
from terrace.session import scratch_path
from terrace.sources import landing
from terrace.streaming.ingest import batch_rows, ingest_available
from tests.conftest import rows


def test_bad_cast_becomes_null_and_counts(spark):
    df = spark.createDataFrame(
        [("o1", "1", "p", "s", "", "abc", "1.50"), ("o2", "x", "p", "s", "2020-01-01 00:00:00", "2.00", "")],
        ",".join(f"{c} string" for c in ORDER_ITEMS.landing))
    out = typed_projection(df, ORDER_ITEMS, reject_col="nu_rejects")
    got = {r.order_id: r for r in out.collect()}
    assert got["o1"].nu_price is None and got["o1"].ts_shipping_limit is None
    assert got["o1"].nu_rejects == 1          # "abc"; the empty timestamp is absent, not rejected
    assert got["o2"].order_item_id is None and got["o2"].nu_rejects == 1


def test_file_stamp_and_bad_name(spark):
    names = spark.createDataFrame([("s3://b/t/t_20240101093000.csv",), ("/x/t/t_20240101093000.csv/part-0.csv",),
                                   ("/x/t/x.csv",), ("/x/t/t_2024.csv",)], "p string")
    got = [r[0] for r in names.select(landing.file_stamp(F.col("p"))).collect()]
    assert got == [20240101093000, 20240101093000, None, None]


def _drop(spark, root, stamp, data, header):
    path = landing.drop_path(root, CUSTOMERS.folder, stamp)
    spark.createDataFrame(data, ",".join(f"{c} string" for c in header)).coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(path)


def test_reordered_header_fails_instead_of_swapping(spark):
    # D21
    root = scratch_path(spark, "hdr")
    cols = list(CUSTOMERS.landing)
    _drop(spark, root, 20240101000000, [("1", "u", "z", "c", "s")], cols)
    swapped = [cols[1], cols[0]] + cols[2:]
    _drop(spark, root, 20240102000000, [("u", "2", "z", "c", "s")], swapped)
    with pytest.raises((PySparkException, Py4JJavaError)):
        landing.read_landing(spark, f"{root}/{CUSTOMERS.folder}", CUSTOMERS.landing).collect()


def test_replay_adds_no_duplicates_and_batch_read_prunes(spark):
    # D16 + S5
    root = scratch_path(spark, "replay")
    raw_path = f"{root}/raw"
    _drop(spark, root, 20240101000000, [("1", "u", "z", "c", "s"), ("2", "u", "z", "c", "s")],
          CUSTOMERS.landing)
    scanned = landing.read_landing(spark, f"{root}/{CUSTOMERS.folder}", CUSTOMERS.landing)
    for _ in range(2):
        landing.write_raw(landing.to_raw(scanned, CUSTOMERS.landing, 20240111), raw_path)
    assert landing.read_raw(spark, raw_path).count() == 2
    other = scanned.withColumn("ref_file_extraction", F.lit(20240102000000).cast("bigint"))
    landing.write_raw(landing.to_raw(other, CUSTOMERS.landing, 20240112), raw_path)
    assert landing.read_raw(spark, raw_path).count() == 4
    batch = landing.read_batch(spark, raw_path, 20240112)
    assert batch.count() == 2
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref_day_partition" in plan


def test_stream_ingest_reads_only_new_drops(spark):
    root = scratch_path(spark, "stream")
    folder = f"{root}/{CUSTOMERS.folder}"
    raw_path, ckpt = f"{root}/raw", f"{root}/_ckpt"
    _drop(spark, root, 20240101000000, [("1", "u", "z", "c", "s")], CUSTOMERS.landing)
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240111)
    _drop(spark, root, 20240102000000, [("2", "u", "z", "c", "s")], CUSTOMERS.landing)
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240112)
    got = rows(landing.read_raw(spark, raw_path), "customer_id", "ref_day_partition", "ref_file_extraction")
    assert got == [("1", 20240111, 20240101000000), ("2", 20240112, 20240102000000)]


def test_reconcile_flags_missing_stamp(spark):
    from terrace.operators.control import reconcile
    land = spark.createDataFrame([(1,), (1,), (2,)], "ref_file_extraction bigint")
    raw = spark.createDataFrame([(1,), (1,), (3,)], "ref_file_extraction bigint")
    got = rows(reconcile(land, raw))
    assert got == [(1, 2, 2, True), (2, 1, 0, False), (3, 0, 1, False)]


def _parts(spark, root, stamp, keys, mode="append"):
    data = [(str(k), "u", "z", "c", "s") for k in keys]
    df = spark.createDataFrame(data, ",".join(f"{c} string" for c in CUSTOMERS.landing)).repartition(len(data))
    landing.write_drop(df, root, CUSTOMERS.folder, stamp, CUSTOMERS.landing, mode=mode)


def test_drop_of_many_part_files_over_several_epochs_and_runs(spark):
    root = scratch_path(spark, "parts")
    folder, raw_path, ckpt = f"{root}/{CUSTOMERS.folder}", f"{root}/raw", f"{root}/_ckpt"
    _parts(spark, root, 20240101000000, range(40))
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240111, max_files=7)
    assert landing.read_raw(spark, raw_path).count() == 40
    _parts(spark, root, 20240101000000, range(40, 47))
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240112, max_files=7)
    got = landing.read_raw(spark, raw_path)
    assert sorted(int(r.customer_id) for r in got.collect()) == list(range(47))
    assert rows(got.groupBy("ref_day").count()) == [(20240111, 40), (20240112, 7)]


def test_replayed_epoch_keeps_its_rows_and_day(spark):
    import os
    root = scratch_path(spark, "epoch")
    folder, raw_path, ckpt = f"{root}/{CUSTOMERS.folder}", f"{root}/raw", f"{root}/_ckpt"
    _parts(spark, root, 20240101000000, range(5))
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240111, batch_id="b1")
    commits = f"{ckpt.removeprefix('file:')}/commits"
    for f in os.listdir(commits):                   # as after a crash before the commit
        os.remove(f"{commits}/{f}")
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240112, batch_id="b2")
    raw = landing.read_raw(spark, raw_path)
    assert rows(raw.groupBy("ref_day").count()) == [(20240111, 5)]
    whole = landing.read_raw(spark, raw_path, with_ingest=True)
    assert batch_rows(spark, whole, raw_path, "b1").count() == 5 and batch_rows(spark, whole, raw_path, "b2").count() == 0


def test_unstamped_files_are_stored_and_a_missing_folder_is_no_drop(spark):
    root = scratch_path(spark, "odd")
    folder, raw_path, ckpt = f"{root}/{CUSTOMERS.folder}", f"{root}/raw", f"{root}/_ckpt"
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240111)
    assert landing.read_raw(spark, raw_path, CUSTOMERS.landing).count() == 0
    spark.createDataFrame([("1", "u", "z", "c", "s")], ",".join(f"{c} string" for c in CUSTOMERS.landing)) \
        .write.option("header", True).csv(f"{folder}/{CUSTOMERS.folder}_latest.csv")
    ingest_available(spark, folder, CUSTOMERS.landing, raw_path, ckpt, 20240111)
    assert landing.read_raw(spark, raw_path, CUSTOMERS.landing).count() == 0
    assert spark.read.parquet(f"{raw_path}_rejected").select("customer_id").collect()[0][0] == "1"


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_malformed_lines_are_kept_as_text_and_rejected(spark):
    root = scratch_path(spark, "lines")
    folder, cols = f"{root}/{CUSTOMERS.folder}", list(CUSTOMERS.landing)
    lines = ["u1,a,z,c,s", "u2,10", "u3,a,z,c,s,more", '"u4,a,z,c,s', '"u5, x",a,"z ""q""",c,', "u6,,,,", "u7"]
    _lines(spark, landing.drop_path(root, CUSTOMERS.folder, 20240101000000), [",".join(cols), *lines])
    scanned = landing.read_landing(spark, folder, cols)
    assert rows(landing.accepted(scanned, cols), "customer_id", "customer_zip_code_prefix") == [
        ("u1", "z"), ("u5, x", 'z "q"'), ("u6", None)]
    bad = landing.rejected(scanned, cols)
    assert rows(bad, "reason", landing.LANDING_LINE) == sorted(
        ("malformed_line", x) for x in ("u2,10", "u3,a,z,c,s,more", '"u4,a,z,c,s', "u7"))
    raw_path = f"{root}/raw"
    ingest_available(spark, folder, cols, raw_path, f"{root}/_ckpt", 20240111)
    assert landing.read_raw(spark, raw_path).count() == 3
    assert spark.read.parquet(f"{raw_path}_rejected").count() == 4


def test_a_drop_with_another_header_is_set_aside_and_the_stream_goes_on(spark):
    root = scratch_path(spark, "drift")
    folder, raw_path, ckpt, cols = f"{root}/{CUSTOMERS.folder}", f"{root}/raw", f"{root}/_ckpt", list(CUSTOMERS.landing)
    good = [("1", "u", "z", "c", "s")]
    _drop(spark, root, 20240101000000, good, cols)
    _drop(spark, root, 20240102000000, [("u", "2", "z", "c", "s")], [cols[1], cols[0], *cols[2:]])
    _drop(spark, root, 20240103000000, [("3", "u", "z", "c", "s", "x")], [*cols, "extra"])
    _lines(spark, landing.drop_path(root, CUSTOMERS.folder, 20240104000000),
           ["\ufeff" + ",".join(f'"{c}"' for c in cols), "4,u,z,c,s"])
    _lines(spark, landing.drop_path(root, CUSTOMERS.folder, 20240105000000), ["5,u,z,c,s", "6,u,z,c,s"])   # no header
    ingest_available(spark, folder, cols, raw_path, ckpt, 20240111)
    assert rows(landing.read_raw(spark, raw_path), "customer_id") == [("1",), ("4",)]
    bad = spark.read.parquet(f"{raw_path}_rejected")
    assert {r[0] for r in bad.select("reason").distinct().collect()} == {"header_drift"} and bad.count() == 3
    _drop(spark, root, 20240106000000, [("7", "u", "z", "c", "s")], cols)
    ingest_available(spark, folder, cols, raw_path, ckpt, 20240112)
    assert rows(landing.read_raw(spark, raw_path), "customer_id") == [("1",), ("4",), ("7",)]


def _part_files(path):
    import os
    top = path.removeprefix("file:")
    return [f"{d}/{f}" for d, _, fs in os.walk(top) for f in fs if f.startswith("part-")]


def test_raw_files_are_sized_and_small_epochs_compact_under_their_identity(spark):
    root = scratch_path(spark, "sized")
    folder, raw_path, ckpt = f"{root}/{CUSTOMERS.folder}", f"{root}/raw", f"{root}/_ckpt"
    _parts(spark, root, 20240101000000, range(30))
    _parts(spark, root, 20240102000000, range(30, 60))
    scanned = landing.read_landing(spark, folder, CUSTOMERS.landing)
    landing.write_raw(landing.to_raw(scanned.repartition(12), CUSTOMERS.landing, 20240111), raw_path)
    assert len(_part_files(raw_path)) == 2                 # 12 tasks x 2 stamps, one file a partition
    streamed = f"{root}/streamed"
    ingest_available(spark, folder, CUSTOMERS.landing, streamed, ckpt, 20240111, max_files=6)
    before = rows(landing.read_raw(spark, streamed, CUSTOMERS.landing, with_ingest=True))
    units = sorted({r[-1] for r in before})
    landing.compact_raw(spark, streamed, units[:3], CUSTOMERS.landing, scratch_path(spark, "compact"))
    assert rows(landing.read_raw(spark, streamed, CUSTOMERS.landing, with_ingest=True)) == before
    of = [f for f in _part_files(streamed) if any(f"={u}/" in f for u in units[:3])]
    dirs = {f.rsplit("/", 1)[0] for f in of}
    assert len(of) == len(dirs)


def test_header_check_shuffles_no_rows(spark):
    root = scratch_path(spark, "drift")
    _parts(spark, root, 20240101000000, range(3))
    rows_ = landing.read_landing(spark, landing.drop_path(root, CUSTOMERS.folder, 20240101000000), CUSTOMERS.landing)
    for columns, drift in ((CUSTOMERS.landing, False), (["other", *CUSTOMERS.landing[1:]], True)):
        checked = landing.with_header_check(rows_, columns)
        assert [r[0] for r in checked.select(landing.DRIFT).collect()] == [drift] * 3
        assert landing.header_checked(rows_, columns)[1] is drift
        assert "Join" not in checked._jdf.queryExecution().executedPlan().toString()
