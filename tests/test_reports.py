"""The demo's layers over test tables: built once, and anew when a table is rewritten."""

import shutil

from stratalake.plans import reports as R
from stratalake.plans.registry import Tables


def test_layers_follow_the_files(spark, tmp_path):
    for name in R._SOURCES:
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    t = Tables(spark, str(tmp_path))
    first = R.demo(t)
    n_orders = t.orders.count()
    assert first.visits.count() == n_orders and first.visits is first.visits
    assert R.demo(Tables(spark, f"{tmp_path}/")) is first
    few = t.orders.limit(40).toPandas()
    few["o_orderdate"] = few["o_orderdate"].astype("datetime64[us]")
    few.to_parquet(tmp_path / "orders.parquet")
    again = R.demo(Tables(spark, str(tmp_path)))
    assert again is not first and again.visits.count() == 40
    assert first.visits.count() == n_orders  # what was read before stays whole
