"""Streaming trigger over landed batches: each batch loads once, in order."""

import os

from ledgerline.plans.tables import Warehouse
from ledgerline.sources.landing import land_files
from ledgerline.streaming.landing_stream import start_landing_stream
from tests.fixtures import changed, write_files


def test_landed_batches_load_once(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="st_")
    landing = os.path.join(tmpdir_path, "landing")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    land_files(spark, write_files(os.path.join(tmpdir_path, "a")), landing, "20240101030000")
    pier = changed("stores", "3", location="Pier")
    land_files(spark, write_files(os.path.join(tmpdir_path, "b"), pier), landing,
               "20240102030000")
    q = start_landing_stream(spark, wh, landing, ckpt)
    q.awaitTermination(300)
    assert q.loaded_stamps == ["20240101030000", "20240102030000"]
    stores = wh.read("dwh.dim_store")
    assert stores.count() == 3 and stores.filter("is_active").count() == 2
    # nothing new: a second run processes no batch
    q2 = start_landing_stream(spark, wh, landing, ckpt)
    q2.awaitTermination(300)
    assert q2.loaded_stamps == []
    assert wh.read("dwh.dim_store").count() == 3
