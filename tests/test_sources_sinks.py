import datetime as dt
import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake import schemas, shared
from commerce_lake.operators.days import of_days
from commerce_lake.plans import csv_entry
from commerce_lake.plans.bronze import ingest_static_bronze, ingest_stream_bronze
from commerce_lake.sinks import files as out
from commerce_lake.sinks import folders, key_filter, pointer, publish, versions
from commerce_lake.sources import files, tables
from frames import event, frame, item, order, review, values, write_array


@pytest.fixture()
def database(spark, tmp_path):
    name = "db_" + os.path.basename(str(tmp_path)).replace("-", "_")
    versions.create_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


# --- shared folder


def test_shared_folder_is_the_clusters(spark):
    assert shared.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def bare_session(master):
    """A session without spark.checkpoint.dir."""
    return SimpleNamespace(conf={"spark.master": master})


def test_cluster_sessions_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(bare_session("yarn"))


def test_local_sessions_may_go_without():
    folder = shared.shared_folder(bare_session("local[2]"))
    assert os.path.isdir(folder)
    assert folder == shared.shared_folder(bare_session("local[4]"))


# --- files


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path), schemas.columns("a string, b string")).collect()


def test_csv_headers_are_trimmed_and_columns_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(" b ,a, extra\n1.5,7,x\nbad,seven,y\n")
    schema = schemas.columns("a int, b double")
    assert values(files.read_csv(spark, str(path), schema)) == [(None, None), (7, 1.5)]
    assert files.read_csv(spark, str(path)).columns == ["b", "a", "extra"]
    missing = str(tmp_path / "none.csv")
    assert files.read_csv(spark, missing, schema, missing_ok=True).isEmpty()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_csv(spark, missing, schema)


def test_envelope_array_files(spark, tmp_path):
    odd = item("i1", "o1", "2024-01-01 00:00:00", quantity=2.0, surprise=1)
    write_array(tmp_path, "batch_1.json", [odd, event("e1", "2024-01-01 00:00:01")])
    (tmp_path / "batch_2.json").write_text("{not json")
    df = files.read_envelopes(spark, str(tmp_path))
    assert df.columns == [*schemas.BRONZE_STREAM.names, files.CORRUPT]
    assert values(df, "stream_type", "quantity", "event_id", files.CORRUPT) == [
        (None, None, None, "{not json"),
        ("events", None, "e1", None),
        ("order_items", 2, None, None),
    ]


def test_only_a_missing_path_counts_as_empty(spark, tmp_path):
    schema = schemas.columns("a int")
    assert files.read_or_empty(spark, str(tmp_path / "none"), schema).isEmpty()
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception):
        files.read_or_empty(spark, str(bad), schema).collect()


def test_json_sink_is_read_back(spark, tmp_path):
    df = frame(spark, "product_id string, price double", ["p1", 1.0], ["p2", None])
    out.write_json(df, str(tmp_path / "j"))
    back = files.read_json_table(spark, str(tmp_path / "j"), schemas.PRODUCTS, multi_line=False)
    assert values(back, "product_id", "price", "brand") == [("p1", 1.0, None), ("p2", None, None)]


def test_json_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(out, "PACKED_ROWS", 3)
    path = str(tmp_path / "packed")
    out.write_json(spark.range(10).selectExpr("CAST(id AS STRING) AS product_id").coalesce(1), path)
    written = glob.glob(f"{path}/part-*")
    assert len(written) == 4 and all(f.endswith(".json.gz") for f in written)
    back = files.read_json_table(spark, path, schemas.PRODUCTS, multi_line=False)
    assert values(back, "product_id") == [(str(n),) for n in range(10)]


def test_packed_csv_files_are_read_by_their_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(out, "PACKED_ROWS", 2)
    users = frame(spark, "user_id string, name string", *[(f"u{n}", f"n{n}") for n in range(5)])
    for k, half in enumerate((users, users.select("name", "user_id"))):
        out.packed(half.coalesce(1).write).csv(str(tmp_path / "users" / str(k)), header=True)
    written = glob.glob(f"{tmp_path}/users/*/part-*")
    assert len(written) == 6 and all(f.endswith(".csv.gz") for f in written)
    back = files.read_csv_by_name(spark, str(tmp_path / "users"), schemas.columns("user_id string, name string"))
    assert values(back) == sorted([(f"u{n}", f"n{n}") for n in range(5)] * 2)


# --- Bronze


def test_bronze_keeps_rejected_records_apart(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    write_array(landing, "a.json", [event("e1", "2024-01-01 00:00:00"), order("o1", "2024-01-01 00:00:00")])
    (landing / "b.json").write_text("{not json")
    counts = ingest_stream_bronze(spark, str(landing), bronze)
    assert values(counts) == [("_rejected", 1), ("events", 1), ("orders", 1)]
    assert values(files.read_bronze(spark, bronze), "stream_type") == [("events",), ("orders",)]
    assert files.read_rejected(spark, bronze).first()[0] == "{not json"


def test_bronze_is_packed(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    write_array(landing, "a.json", [event("e1", "2024-01-01 00:00:00"), order("o1", "2024-01-01 00:00:00")])
    ingest_stream_bronze(spark, str(landing), bronze)
    found = glob.glob(f"{bronze}/*/*.parquet")
    assert found and all(f.endswith(".zstd.parquet") for f in found)


def test_empty_landing_leaves_bronze_as_it_is(spark, tmp_path):
    landing, empty, bronze = tmp_path / "landing", tmp_path / "empty", str(tmp_path / "bronze")
    write_array(landing, "a.json", [event("e1", "2024-01-01 00:00:00")])
    write_array(empty, "a.json", [])
    assert ingest_stream_bronze(spark, str(landing), bronze) is not None
    assert ingest_stream_bronze(spark, str(empty), bronze) is None
    assert files.read_bronze(spark, bronze).count() == 1
    with pytest.raises(AnalysisException):
        ingest_stream_bronze(spark, str(tmp_path / "nowhere"), bronze)


def test_bronze_by_day_reads_single_days(spark, tmp_path, capsys):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    records = [event(f"e{d}", f"2024-01-0{d} 10:00:00") for d in range(1, 6)] + [event("bad", "junk")]
    write_array(landing, "a.json", records)
    ingest_stream_bronze(spark, str(landing), bronze, by_date=True)
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 4)]
    df = files.read_bronze(spark, bronze, "events", by_date=True, dates=days)
    assert values(df, "event_id") == [("e2",), ("e4",)]
    df.explain()
    plan = capsys.readouterr().out
    filters = plan[plan.index("PartitionFilters"):]
    assert "event_date" in filters and "stream_type" in filters
    assert files.read_bronze(spark, bronze, "events", by_date=True).count() == 6
    with pytest.raises(ValueError):
        files.read_bronze(spark, bronze, dates=days)


def test_partition_values_keep_their_type(spark, tmp_path):
    df = frame(spark, "event_id string, stream_type string", ["a", "01"], ["b", "1"])
    df.write.partitionBy("stream_type").parquet(str(tmp_path / "b"))
    found = files.read_bronze(spark, str(tmp_path / "b"))
    assert values(found, "stream_type") == [("01",), ("1",)]


def test_static_bronze(spark, tmp_path):
    path = write_array(tmp_path, "users.json", [{"user_id": "u1", "signup_date": "x"}])
    target = str(tmp_path / "users")
    assert ingest_static_bronze(spark, path, schemas.USERS, target) == 1
    assert ingest_static_bronze(
        spark, write_array(tmp_path, "none.json", []), schemas.USERS, target
    ) == 0
    assert spark.read.parquet(target).first()["user_id"] == "u1"


# --- partitioned writes

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_dynamic_and_static_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    out.write_partitioned(frame(spark, "v int, d date", [1, D1], [2, D2]), path, ["d"])
    out.write_partitioned(frame(spark, "v int, d date", [5, D2], [6, D3]), path, ["d"])
    assert values(spark.read.parquet(path)) == [(1, D1), (5, D2), (6, D3)]
    out.write_partitioned(frame(spark, "v int, d date", [9, D1]), path, ["d"], replace="static")
    assert values(spark.read.parquet(path)) == [(9, D1)]
    out.write_partitioned(frame(spark, "v int, d date", [8, D1]), path, ["d"], replace="append")
    assert values(spark.read.parquet(path)) == [(8, D1), (9, D1)]


def test_null_partition_values_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    out.write_partitioned(frame(spark, "v int, d date", [1, D1]), path, ["d"])
    with pytest.raises(Exception, match="null in partition column d"):
        out.write_partitioned(frame(spark, "v int, d date", [2, D1], [3, None]), path, ["d"])
    assert values(spark.read.parquet(path)) == [(1, D1)]


def test_files_per_partition_are_bounded(spark, tmp_path):
    df = spark.range(2000, numPartitions=16).select(
        "id", F.when(F.col("id") % 3 == 0, D1).otherwise(F.date_add(F.lit(D2), (F.col("id") % 2).cast("int"))).alias("d")
    )
    for limit in (1, 3, None):
        path = str(tmp_path / f"t{limit}")
        out.write_partitioned(df, path, ["d"], files_per_partition=limit)
        for folder in glob.glob(f"{path}/d=*"):
            assert len(glob.glob(f"{folder}/*.parquet")) <= (limit or 1)
        assert spark.read.parquet(path).count() == 2000


def test_sorted_write(spark, tmp_path):
    path = str(tmp_path / "t")
    out.write_sorted(spark.range(100).repartition(5), path, "id")
    parts = [[r["id"] for r in spark.read.parquet(f).collect()] for f in sorted(glob.glob(f"{path}/*.parquet"))]
    assert sum(parts, []) == list(range(100))


# --- versioned tables


def test_versions_replace_and_old_ones_go(spark, database):
    name = f"{database}.dim"
    for n in range(1, 5):
        assert versions.write_version(spark.range(n), name) == n
        assert spark.table(name).count() == n
    assert [v.split("__v")[1][:6] for v in versions.versions(spark, name)] == ["000003", "000004"]


def test_a_table_may_replace_itself(spark, database):
    name = f"{database}.dim"
    versions.write_version(spark.range(3), name)
    for _ in range(3):
        merged = spark.table(name).union(spark.range(100, 101)).distinct()
        versions.write_version(merged.orderBy("id"), name)
    assert values(spark.table(name)) == [(0,), (1,), (2,), (100,)]


def test_failed_refresh_keeps_the_old_version(spark, database):
    name = f"{database}.dim"
    versions.write_version(spark.range(3), name)
    failing = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.write_version(failing, name)
    assert spark.table(name).count() == 3
    assert versions.write_version(spark.range(5), name) == 5


def test_empty_dimension_replaces_nothing(spark, database):
    assert publish.publish_dimension(spark.range(3), database, "dim_x") == 3
    assert publish.publish_dimension(spark.range(0), database, "dim_x") is None
    assert spark.table(f"{database}.DIM_X").count() == 3
    assert len(versions.versions(spark, f"{database}.DIM_X")) == 1


def test_skip_if_exists(spark, database):
    assert publish.publish_dimension(spark.range(3), database, "d", skip_if_exists=True) == 3
    assert publish.publish_dimension(spark.range(4), database, "d", skip_if_exists=True) is None
    assert spark.table(f"{database}.d").count() == 3


def test_similar_names_do_not_mix(spark, database):
    versions.write_version(spark.range(1), f"{database}.dim")
    versions.write_version(spark.range(2), f"{database}.dim_date")
    assert len(versions.versions(spark, f"{database}.dim")) == 1
    assert tables.table_exists(spark, f"{database}.dim_date")
    assert not tables.table_exists(spark, f"{database}.other")


# --- fact appends


def test_append_adds_each_key_once(spark, database):
    table = f"{database}.fact"
    first = frame(spark, "k string, v int", ["1", 0])
    batch = frame(spark, "k string, v int", ["1", 1], ["2", 2], ["2", 2], ["3", 3])
    assert publish.append_fact(first, table, "k") == 1
    assert publish.append_fact(batch, table, "k") == 2
    assert publish.append_fact(batch, table, "k") == 0
    assert publish.append_fact(batch.where("false"), table, "k") == 0
    assert values(spark.table(table)) == [("1", 0), ("2", 2), ("3", 3)]


def test_append_refuses_null_keys_before_writing(spark, database):
    table = f"{database}.fact"
    publish.append_fact(frame(spark, "k string, v int", ["1", 0]), table, "k")
    batch = frame(spark, "k string, v int", ["1", 1], [None, 2], ["2", 2], ["2", 2], ["3", 3])
    with pytest.raises(Exception, match="null k in a batch"):
        publish.append_fact(batch, table, "k")
    assert values(spark.table(table)) == [("1", 0)]


def test_append_reads_only_the_days_of_the_batch(spark, database):
    table = f"{database}.fact"
    options = {"date_column": "d", "key_implies_date": True}
    publish.append_fact(frame(spark, "k string, d date", ["1", D1], ["2", D2]), table, "k", **options)
    again = frame(spark, "d date, k string", [D2, "2"], [D3, "3"])
    assert publish.append_fact(again, table, "k", **options) == 1
    assert values(spark.table(table), "k", "d") == [("1", D1), ("2", D2), ("3", D3)]
    assert values(tables.target_keys(spark, table, "k", "d", [D1, D3])) == [("1",), ("3",)]


def test_days_may_be_a_table_of_any_length(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, "v int, d date", [1, D1], [2, D2], [3, None])
    out.write_partitioned(rows, path, ["d"], allow_null=True)
    written = spark.read.schema(rows.schema).parquet(path)
    many = spark.sql("SELECT explode(sequence(DATE'0001-01-01', DATE'2024-01-01', INTERVAL 1 DAY)) AS day")
    assert values(of_days(written, many, "d"), "v") == [(1,)]
    assert values(of_days(written, frame(spark, "day date", [D2], [None], [D2]), "d"), "v") == [(2,), (3,)]
    assert values(of_days(written, [D2, None], "d"), "v") == [(2,), (3,)]
    assert of_days(written, many.limit(0), "d").isEmpty()
    plan = of_days(written, many, "d")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_key_filters_find_all_keys_and_few_others(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.date_add(F.lit(D1), (F.col("id") % 10).cast("int")).alias("d")
    )
    kept = key_filter.KeyFilter(str(tmp_path / "filter"))
    assert not kept.exists(spark)
    kept.build(rows.where("id < 15000"), "k", "d")
    kept.add(rows.where("id >= 15000"), "k", "d")
    assert kept.exists(spark) and kept.days_of(rows, "k").count() == 10
    for n in (0, 7, 19_999):
        assert D1 + dt.timedelta(n % 10) in {r[0] for r in kept.days_of(rows.where(f"id = {n}"), "k").collect()}
    others = spark.range(200).select(F.concat(F.lit("x"), "id").alias("k"))
    assert sum(kept.days_of(others.where(F.col("k") == f"x{n}"), "k").count() for n in range(5)) <= 1
    assert kept.days_of(rows.where("false"), "k").isEmpty()
    kept.add(frame(spark, "k string, d date", [None, D1]), "k", "d")
    empty = key_filter.KeyFilter(str(tmp_path / "empty"))
    empty.build(rows.where("false"), "k", "d")
    assert empty.exists(spark) and empty.days_of(rows, "k").isEmpty()


def test_an_append_with_a_filter_reads_touched_days_only(spark, database, tmp_path):
    table, kept = f"{database}.t", key_filter.KeyFilter(str(tmp_path / "filter"))
    options = {"date_column": "d", "key_filter": kept}
    days = [D1 + dt.timedelta(n) for n in range(4)]
    rows = frame(spark, "k string, d date", *[[f"{n}", d] for n, d in enumerate(days)])
    assert publish.append_fact(rows, table, "k", **options) == 4
    assert publish.append_fact(rows, table, "k", **options) == 0  # builds the filter
    moved = frame(spark, "k string, d date", ["1", days[3]], ["9", days[3]])
    assert publish.append_fact(moved, table, "k", **options) == 1  # "1" is there, on another day
    location = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()[1].removeprefix("file:")
    for part in glob.glob(f"{location}/d={days[0]}/*.parquet"):
        with open(part, "wb") as file:  # a day that cannot be read
            file.write(b"nothing")
    spark.catalog.refreshTable(table)
    again = frame(spark, "k string, d date", ["2", days[1]], ["10", days[2]], ["9", days[2]])
    assert publish.append_fact(again, table, "k", **options) == 1
    with pytest.raises(Exception):
        publish.append_fact(frame(spark, "k string, d date", ["0", days[1]]), table, "k", **options)


def test_false_positives_change_nothing(spark, database, tmp_path, monkeypatch):
    rows = frame(spark, "k string, d date", *[[f"{n}", D1 if n % 3 else D2] for n in range(30)])
    more = frame(spark, "k string, d date", *[[f"{n}", D2 if n % 2 else D1] for n in range(20, 50)])
    appended = []
    for name in ("plain", "filtered", "full"):
        if name == "full":  # each key sets and asks for the same bits of one block
            monkeypatch.setattr(key_filter, "key_bits", lambda key: F.lit(1).cast("bigint"))
            monkeypatch.setattr(key_filter, "key_block", lambda key, size: F.lit(0).cast("bigint"))
        table, kept = f"{database}.{name}", key_filter.KeyFilter(str(tmp_path / name))
        options = {"date_column": "d", "key_filter": None if name == "plain" else kept}
        counts = [publish.append_fact(df, table, "k", **options) for df in (rows, more, rows)]
        appended.append((counts, values(spark.table(table), "k", "d")))
    assert appended[0] == appended[1] == appended[2] and appended[0][0] == [30, 20, 0]


FACT = publish.Fact("fact", "k", "d")


def test_a_new_version_has_a_filter_of_its_own(spark, database, tmp_path):
    filters = str(tmp_path / "filters")
    rows = frame(spark, "k string, d date", ["1", D1], ["2", D2])
    for df in (rows, rows.withColumn("v", F.lit(1))):
        assert publish.publish_fact(df, database, FACT, filters=filters) == 2
        assert publish.publish_fact(df, database, FACT, filters=filters) == 0
    assert len(glob.glob(f"{filters}/*/_complete")) == 2


def test_changed_columns_refill_without_a_gap(spark, database):
    name = f"{database}.FACT"
    rows = frame(spark, "k string, v int, d date", ["1", 0, D1], ["2", 0, D2])
    assert publish.publish_fact(rows, database, FACT) == 2
    wider = rows.withColumn("w", F.lit(1)).union(frame(spark, "k string, v int, d date, w int", ["3", 0, D2, 2]))
    broken = wider.withColumn("w", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish.publish_fact(broken, database, FACT)
    assert values(spark.table(name), "k", "v") == [("1", 0), ("2", 0)]
    assert publish.publish_fact(wider.where("false"), database, FACT) == 0
    assert values(spark.table(name), "k") == [("1",), ("2",)]
    assert publish.publish_fact(wider, database, FACT, [D2]) == 3  # all days, as the table is new
    assert values(spark.table(name), "k", "w") == [("1", 1), ("2", 1), ("3", 2)]
    more = wider.union(frame(spark, "k string, v int, d date, w int", ["4", 0, D1, 2], ["5", 0, D2, 2]))
    assert publish.publish_fact(more, database, FACT, [D1]) == 1
    assert publish.publish_fact(more, database, FACT, frame(spark, "day date", [D2])) == 1
    assert publish.publish_fact(more, database, FACT) == 0


def test_rows_that_refer_to_nothing_stop_publishing(spark, database):
    name = f"{database}.FACT"
    fact = publish.Fact("fact", "k", "d", references=(publish.Reference("s", "dim_s", "id"),))
    dims = {"dim_s": frame(spark, "id int, name string", [1, "a"], [2, "b"])}
    rows = frame(spark, "k string, s int, d date", ["1", 1, D1], ["2", None, D2])
    orphan = frame(spark, "k string, s int, d date", ["3", 7, D2])
    with pytest.raises(Exception, match="s without a row: 7"):  # at first, nothing is there
        publish.publish_all(dims, [(fact, rows.union(orphan))], database)
    assert not spark.catalog.tableExists(name)
    assert publish.publish_all(dims, [(fact, rows)], database)["fact"] == 2
    with pytest.raises(Exception, match="s without a row: 7"):  # an append
        publish.publish_all(dims, [(fact, rows.union(orphan))], database, [D2])
    assert publish.publish_all(dims, [(fact, rows.union(orphan))], database, [D1])["fact"] == 0
    wider = rows.union(orphan).withColumn("w", F.lit(1))
    with pytest.raises(Exception, match="s without a row: 7"):  # a refill
        publish.publish_all(dims, [(fact, wider)], database)
    assert values(spark.table(name), "k", "s") == [("1", 1), ("2", None)]
    dims["dim_s"] = dims["dim_s"].union(frame(spark, "id int, name string", [7, "c"]))
    assert publish.publish_all(dims, [(fact, rows.union(orphan))], database)["fact"] == 1
    with pytest.raises(ValueError, match="not published"):
        publish.publish_all({}, [(fact, rows)], database)


def test_readers_keep_the_version_before(spark, database):
    rows = frame(spark, "k string, d date", ["1", D1])
    publish.publish_fact(rows, database, FACT)
    shown = versions.current_version(spark, f"{database}.FACT")
    publish.publish_fact(rows.withColumn("v", F.lit(1)), database, FACT)
    assert versions.current_version(spark, f"{database}.FACT") != shown
    assert values(spark.table(shown)) == [("1", D1)]


def test_a_refill_cut_off_is_not_appended_to(spark, database):
    rows = frame(spark, "k string, d date", ["1", D1])
    publish.publish_fact(rows, database, FACT)
    shown = versions.current_version(spark, f"{database}.FACT")
    rows.limit(0).write.saveAsTable(f"{database}.FACT__v000002_00000000")  # left behind by a lost driver
    assert versions.current_version(spark, f"{database}.FACT") == shown
    assert publish.publish_fact(rows.union(frame(spark, "k string, d date", ["2", D1])), database, FACT) == 1
    assert spark.table(f"{database}.FACT").count() == 2


def test_a_plain_table_is_appended_to_until_its_columns_change(spark, database):
    rows = frame(spark, "k string, d date", ["1", D1])
    publish.append_fact(rows, f"{database}.FACT", "k", date_column="d")
    more = rows.union(frame(spark, "k string, d date", ["2", D2]))
    assert publish.publish_fact(more, database, FACT) == 1
    assert values(spark.table(f"{database}.FACT"), "k") == [("1",), ("2",)]
    assert publish.publish_fact(more.withColumn("v", F.lit(1)), database, FACT) == 2
    assert versions.current_version(spark, f"{database}.FACT") is not None
    assert values(spark.table(f"{database}.FACT"), "k", "v") == [("1", 1), ("2", 1)]


def test_an_empty_fact_is_published_once(spark, database):
    rows = frame(spark, "k string, d date", ["1", D1])
    assert publish.publish_fact(rows.limit(0), database, FACT) == 0
    assert spark.table(f"{database}.FACT").count() == 0
    assert publish.publish_fact(rows, database, FACT) == 1


# --- path tables with a pointer

ID = T.StructType([T.StructField("id", T.LongType())])


def test_a_pointer_commits_whole_tables(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert pointer.read_current(spark, path, ID).isEmpty()
    assert pointer.write_current(spark.range(0), path) == 0
    assert pointer.current_path(spark, path) is None
    for n in range(1, 5):
        assert pointer.write_current(spark.range(n), path) == n
        assert pointer.read_current(spark, path, ID).count() == n
    assert len(glob.glob(f"{path}/v*")) == 2
    before = pointer.read_current(spark, path, ID)
    assert pointer.write_current(before.union(spark.range(9, 10)), path) == 5  # may read from itself
    assert before.count() == 4


def test_a_failed_or_empty_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    pointer.write_current(spark.range(3), path)
    failing = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        pointer.write_current(failing, path)
    assert pointer.write_current(spark.range(0), path) == 0
    assert pointer.read_current(spark, path, ID).count() == 3
    assert len(glob.glob(f"{path}/v*")) == 1


def test_small_files_are_replaced_at_once(spark, tmp_path):
    path = str(tmp_path / "note")
    assert folders.read_text(spark, path) is None
    for text in ("one", "zwei ü"):
        folders.replace_text(spark, path, text)
        assert folders.read_text(spark, path) == text
    assert folders.children(spark, str(tmp_path)) == ["note"]


def test_publishing_stops_at_the_first_failure(spark, database):
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("a"))
    fact = publish.Fact("fact", "k", "d")
    rows = frame(spark, "k string, d date", ["1", D1])
    with pytest.raises(Exception, match="broken"):
        publish.publish_all({"good": spark.range(2), "bad": bad}, [(fact, rows)], database)
    assert spark.table(f"{database}.good").count() == 2
    assert not tables.table_exists(spark, f"{database}.fact")
    done = publish.publish_all({"good": spark.range(3)}, [(fact, rows)], database)
    assert done == {"good": 3, "fact": 1}


# --- CSV entry


def write_text(folder, name, text):
    os.makedirs(str(folder), exist_ok=True)
    with open(os.path.join(str(folder), name), "w") as f:
        f.write(text)


def test_csv_columns_are_read_by_name_in_every_file(spark, tmp_path):
    schema = schemas.columns("a string, b int, review_text string")
    folder = tmp_path / "t.csv"
    write_text(folder, "1.csv", "a,b\nx,1\n")
    write_text(folder, "2.csv", " b , a ,c\n2,y,z\n")
    write_text(folder, "3.csv", "review_text,b,a\nfine,3.0,w\n")
    write_text(folder, "4.csv", "")
    found = files.read_csv_by_name(spark, str(folder), schema, optional=["review_text"])
    assert values(found) == [("w", 3, "fine"), ("x", 1, None), ("y", 2, None)]
    with pytest.raises(schemas.SchemaMismatch, match="missing review_text"):
        files.read_csv_by_name(spark, str(folder), schema)
    assert files.read_csv_by_name(spark, str(tmp_path / "none"), schema, missing_ok=True).isEmpty()
    with pytest.raises(FileNotFoundError):
        files.read_csv_by_name(spark, str(tmp_path / "none"), schema)


def test_each_table_has_its_own_time(spark, tmp_path):
    source = tmp_path / "csv"
    write_text(source, "events.csv", "event_id,user_id,product_id,event_type,event_timestamp\ne1,u,p,view,2024-01-02 10:00:00\ne2,u,p,view,junk\n")
    write_text(source, "orders.csv", "order_id,user_id,total_amount,order_status,order_date\no1,u,NaN,Done,2024-01-01\n")
    write_text(source, "order_items.csv", "order_item_id,order_id,product_id,quantity,item_price\ni1,o1,p,2.0,1.5\ni2,o9,p,2,1.5\n")
    write_text(source, "users.csv", "user_id,name,email,city,gender\nu,A,a,Rome,F\n")
    stream = csv_entry.csv_event_stream(spark, str(source), 2)
    assert values(stream, "batch_id", "stream_type", "data.order_item_id", "data.total_amount") == [
        (0, "order_items", "i1", None), (0, "orders", None, None), (1, "events", None, None),
    ]
    day = csv_entry.csv_event_stream(spark, str(source), 2, day=dt.date(2024, 1, 1))
    assert values(day, "stream_type") == [("order_items",), ("orders",)]
    landing = str(tmp_path / "landing")
    csv_entry.land_csv(spark, str(source), landing, stream)
    assert files.read_envelopes(spark, f"{landing}/stream", multi_line=False).count() == 3
    assert files.read_json_table(spark, f"{landing}/static/users.json", schemas.USERS, multi_line=False).count() == 1
    assert not os.path.exists(f"{landing}/static/products.json")
