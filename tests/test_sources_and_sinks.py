import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from monthmill.session import durable, scratch_path, shared_folder
from monthmill.sinks import files
from monthmill.sources import jdbc, tables

DB = jdbc.Database("jdbc:example://host/base", "reader", "secret", {"database": "base"})


def test_jdbc_table_options_split_the_scan():
    options = jdbc.table_options(DB, "users", jdbc.Split("id", 1, 1000, 8))
    assert options["dbtable"] == "users" and options["database"] == "base"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "1000", "8")


def test_jdbc_query_loses_its_semicolon():
    assert jdbc.query_options(DB, "SELECT * from users ; ")["query"] == "SELECT * from users"
    assert "dbtable" not in jdbc.query_options(DB, "SELECT 1")


def test_jdbc_checks_and_hides_the_password():
    with pytest.raises(ValueError):
        jdbc.Database("host.example").options()
    with pytest.raises(ValueError):
        jdbc.Split("id", 0, 1, 0).options()
    assert "secret" not in repr(DB)
    assert "user" not in jdbc.Database("jdbc:x:y").options()


def test_a_failing_database_read_is_raised(spark):
    with pytest.raises(Exception, match="No suitable driver"):
        jdbc.read_query(spark, DB, "SELECT * FROM users")
    with pytest.raises(Exception, match="No suitable driver"):
        jdbc.read_table(spark, DB, "users")


def test_query_text_in_any_case_with_and_without_semicolon(spark):
    users = spark.createDataFrame([(1, "ok")], "user_id long, status string")
    for text in ("SELECT * FROM {users};", "Select * from {users}"):
        assert rows(tables.query_rows(spark, text, {"users": users})) == [(1, "ok")]
    users.createOrReplaceTempView("usersKyc")
    assert rows(tables.query_rows(spark, "Select * from usersKyc;")) == [(1, "ok")]


def test_csv_lists(spark, tmp_path):
    (tmp_path / "apps.csv").write_text("app\nx\ny\n")
    (tmp_path / "weights.csv").write_text("market,class,target_share\nMY,a,0.75\n")
    assert rows(tables.csv_table(spark, str(tmp_path / "apps.csv"), tables.VALID_APPS)) == [("x",), ("y",)]
    assert rows(tables.csv_table(spark, str(tmp_path / "weights.csv"), tables.CLASS_TARGETS)) == [("MY", "a", 0.75)]
    (tmp_path / "weights.csv").write_text("market,class,target_share\nMY,a,much\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.csv_table(spark, str(tmp_path / "weights.csv"), tables.CLASS_TARGETS).collect()


def test_scoring_lines(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text('1,"a,b",0.5\n2,c,\n')
    assert rows(tables.record_lines(spark, str(tmp_path), "id long, name string, x double")) == [(1, "a,b", 0.5), (2, "c", None)]


def test_avro_needs_its_module(spark, tmp_path):
    try:
        tables.avro_table(spark, str(tmp_path)).schema
    except Exception as error:
        assert "avro" in str(error).lower()


def test_stamp_is_safe_in_a_path():
    stamp = files.stamp(datetime.datetime(2022, 9, 18, 1, 2, 3))
    assert stamp == "20220918T010203"
    assert not set(": ") & set(files.stamp())


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id long, name string")
    path = files.export_csv(df, str(tmp_path), datetime.datetime(2022, 9, 18))
    assert path.endswith("/run_ts=20220918T000000")
    assert rows(tables.csv_table(spark, path, df.schema)) == [(1, "a,b"), (2, None)]


def test_put_never_overwrites_unless_told(spark, tmp_path):
    df = spark.range(3)
    path = files.put(df, str(tmp_path), "/a/b")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="(?i)exists"):
        files.put(df, str(tmp_path), "a/b")
    files.put(spark.range(5), str(tmp_path), "a/b", "orc", "overwrite")
    assert spark.read.orc(path).count() == 5


def month_rows(spark, data):
    return spark.createDataFrame(data, "id long, market string, data_month string")


@pytest.mark.parametrize("gather", [True, False])
def test_a_rerun_replaces_one_month_only(spark, tmp_path, gather):
    base = str(tmp_path / "out")
    files.write_months(month_rows(spark, [(1, "MY", "202206"), (2, "MY", "202207"), (3, "TH", "202207")]), base, gather)
    files.write_months(month_rows(spark, [(9, "MY", "202207")]), base, gather)
    everything = tables.market_months(spark, base, month_rows(spark, []).schema.fields[:1])
    assert rows(everything) == [(1, "MY", "202206"), (3, "TH", "202207"), (9, "MY", "202207")]
    assert rows(tables.market_month(spark, base, "MY", "202207")) == [(9, "MY", "202207")]
    pruned = plan(everything.where("market = 'TH' AND data_month = '202207'"))
    assert "PartitionFilters: [isnotnull(market" in pruned


@pytest.mark.parametrize("market, month", [("MY", "2022-07"), ("MY", "202213"), ("../x", "202207")])
def test_bad_partition_names_are_refused(spark, market, month):
    with pytest.raises(ValueError):
        tables.market_month(spark, "/nowhere", market, month)


def test_named_table(spark, tmp_path):
    for n in (2, 3):
        files.write_named(spark.range(n), "shelf", "things", str(tmp_path / "things"))
    assert spark.table("shelf.things").count() == 3
    spark.sql("DROP TABLE shelf.things")


def test_show(spark, capsys):
    files.show(spark.createDataFrame([(1236.7,)], "total_order_value double"))
    assert "1236.7" in capsys.readouterr().out


def test_lineage_ends_in_the_shared_folder(spark):
    kept = durable(spark.range(5).withColumn("x", F.rand()))
    assert rows(kept) == rows(kept)
    assert "Range" not in plan(kept)
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.startswith(shared_folder(spark))
    assert not os.path.exists(first)
