from types import SimpleNamespace

import pytest

from daybook.scratch import scratch_dir, stored


@pytest.mark.parametrize("shared", ["s3a://shared/folder/", "", None])
def test_scratch_is_below_a_shared_folder(shared):
    """spark.checkpoint.dir, else the warehouse; never the machine's temporary folder."""
    settings = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": "hdfs:///warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))
    first, second = scratch_dir(session), scratch_dir(session)
    assert first != second
    expected = "s3a://shared/folder" if shared else "hdfs:///warehouse/_scratch"
    assert {p.rsplit("/", 1)[0] for p in (first, second)} == {expected}


@pytest.mark.parametrize("rows", [0, 5])
def test_stored_rows_come_back(spark, rows):
    df = spark.range(rows).selectExpr("id", "CAST(id % 2 AS INT) AS kind", "CAST(NULL AS STRING) AS text")
    for back in (stored(df), stored(df, "kind", compression="zstd")):
        assert sorted(r["id"] for r in back.collect()) == list(range(rows))
        assert set(back.columns) == set(df.columns)
        assert back.where("kind = 1").count() == rows // 2
        assert "Range" not in back._jdf.queryExecution().toString()
