import importlib.util
import os

from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_driver_contract(spark):
    E = _entry_module()
    df = E.entry(spark)
    assert isinstance(df, DataFrame)
    assert [f.name for f in df.schema.fields][:2] == ["series_id", "n_bars"]
    assert df.count() == 5
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 70
    for name in ("bars_daily", "describe", "acf30", "holt_grid"):
        assert isinstance(q[name](spark, "/root/testdata/sf0.001"), DataFrame)
