from __future__ import annotations

import json
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from userlake.operators import facts, trends
from userlake.operators.users import users_transformed
from userlake.plans import upkeep
from userlake.plans.jobs import PER_BATCH, Lake, run_all
from userlake.sources import catalog, records, sinks
from userlake.streaming import ingest
from userlake.tables import INGEST_SUMMARIES, RAW, READERS, SILVER, tables_from_raw


def bag(df):
    return Counter(tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect())


@pytest.fixture
def database(spark, tmp_path):
    name = "t_" + tmp_path.name.replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_write_modes(spark, database, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "v int, d string")

    table, path = f"{database}.kept", f"{tmp_path}/kept"
    sinks.save_table(rows((1, "a"), (2, "b")), table, "append", ["d"], path)
    sinks.save_table(rows((3, "b")), table, "append", ["d"], path)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "a"), (2, "b"), (3, "b")]
    sinks.save_table(rows((9, "b")), table, "overwrite", ["d"], path)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "a"), (9, "b")]
    sinks.save_table(rows((5, "c")), table, "merge", ["d"], path)
    assert sorted(map(tuple, spark.table(table).collect())) == [(5, "c")]
    with pytest.raises(ValueError):
        sinks.save_table(rows((5, "c")), table, "upsert")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_fallback_uses_an_insert_and_then_a_folder(spark, database, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    assert sinks.save_table_or_folder(df, f"{database}.a", f"{tmp_path}/a", provider="no_such_format") == "insert"
    assert spark.table(f"{database}.a").count() == 1
    assert sinks.save_table_or_folder(df, f"{database}.b", f"{tmp_path}/b") == "table"
    way = sinks.save_table_or_folder(df, "no_such_database.c", f"{tmp_path}/c")
    assert way == "folder"
    assert spark.read.parquet(f"{tmp_path}/c_parquet").count() == 1


def test_rows_that_do_not_fit_are_not_rerouted(spark, database, tmp_path):
    df = spark.createDataFrame([(1, "a")], "v int, w string")
    sinks.save_table(df, f"{database}.whole", path=f"{tmp_path}/whole")
    with pytest.raises(AnalysisException):
        sinks.save_table_or_folder(df.drop("w"), f"{database}.whole", f"{tmp_path}/whole")
    assert spark.table(f"{database}.whole").count() == 1
    assert not (tmp_path / "whole_parquet").exists()


def test_json_and_csv_keep_text_as_it_is(spark, tmp_path, users_like):
    df = users_like({"id": "", "first_name": '  a "b", c '}, {"id": None, "first_name": "line"})
    sinks.write_json_and_csv(df, f"{tmp_path}/j", f"{tmp_path}/c")
    reader = spark.read.schema(records.RAW_SCHEMA)
    assert bag(reader.json(f"{tmp_path}/j")) == bag(df)
    assert bag(reader.options(**sinks.CSV_OPTIONS).csv(f"{tmp_path}/c")) == bag(df)


def test_table_is_preferred_to_the_path(spark, database, tmp_path):
    sinks.write_folder(spark.range(3).toDF("v"), f"{tmp_path}/p")
    assert records.read_table_or_path(spark, f"{database}.v", f"{tmp_path}/p").count() == 3
    sinks.save_table(spark.range(5).toDF("v"), f"{database}.v")
    assert records.read_table_or_path(spark, f"{database}.v", f"{tmp_path}/p").count() == 5


def test_malformed_json_is_a_row_of_nulls(spark):
    messages = spark.createDataFrame([('{"id": "1", "gender": "male"}',), ("{oops",), (None,)], "value string")
    parsed = records.parse_user_json(messages)
    assert parsed.columns == records.RAW_COLUMNS
    assert sorted(r.id or "" for r in parsed.collect()) == ["", "", "1"]


def test_flatten_makes_new_ids(spark):
    record = {
        "name": {"first": "Ann", "last": "Lee"}, "gender": "female",
        "location": {"street": {"number": 5, "name": "Oak Road"}, "city": "Ulm", "state": "Bavaria",
                     "country": "Germany", "postcode": 89073},
        "email": "a@b.de", "login": {"username": "ann"}, "dob": {"date": "1990-01-01T00:00:00.000Z"},
        "registered": {"date": "2020-01-01T00:00:00.000Z"}, "phone": "1", "picture": {"medium": "u"},
    }
    text = spark.createDataFrame([(json.dumps(record),)] * 2, "value string")
    nested = text.select(F.from_json("value", records.NESTED_SCHEMA).alias("r")).select("r.*")
    flat = records.flatten_user_record(nested)
    rows = flat.collect()
    assert flat.columns == records.RAW_COLUMNS
    assert rows[0].address == "5 Oak Road, Ulm, Bavaria, Germany"
    assert (rows[0].post_code, rows[0].username) == ("89073", "ann")
    assert len({r.id for r in rows}) == 2


# Column counts of the declared tables.
WIDTHS = {
    "users_transformed": 31, "data_quality_summary": 12, "dim_user_demographics": 15,
    "fact_geographic_analysis": 12, "fact_age_generation_analysis": 20, "fact_email_provider_analysis": 9,
    "fact_email_domain_analysis": 14, "fact_data_quality_metrics": 20, "fact_quality_by_segment": 10,
    "fact_registration_trends": 12, "fact_geographic_expansion": 16, "fact_age_demographic_trends": 13,
    "fact_data_quality_trends": 17, "fact_registration_anomalies": 16, "fact_quality_anomalies": 21,
}


def test_declared_tables(spark, ctx, database, tmp_path):
    document = json.loads(json.dumps(catalog.declared_document(spark, ctx)))
    assert {n: len(t["columns"]) for n, t in document["tables"].items()} == WIDTHS
    catalog.create_tables(spark, document, database, f"{tmp_path}/root")
    assert spark.table(f"{database}.users_transformed").columns[-1] == "processing_date"
    document["tables"]["fact_quality_by_segment"]["columns"].append({"name": "note", "type": "string"})
    catalog.create_tables(spark, document, database, f"{tmp_path}/root")
    assert "note" in spark.table(f"{database}.fact_quality_by_segment").columns


def test_schema_differences_and_conformance(spark):
    df = spark.createDataFrame([("1", "x", 2.0)], "a string, b string, extra double")
    declared = catalog.declared_schema(
        {"columns": [{"name": "b", "type": "int"}, {"name": "a", "type": "bigint"}, {"name": "c", "type": "date"}]}
    )
    assert catalog.schema_differences(df.schema, declared) == [
        ("b", "int", "string"), ("a", "bigint", "string"), ("c", "date", ""), ("extra", "", "double"),
    ]
    conformed = catalog.conform_to_schema(df, declared)
    assert catalog.schema_differences(conformed.schema, declared) == []
    assert tuple(conformed.first()) == (None, 1, None)


def document(name, partitions=(), **types):
    columns = [{"name": column, "type": kind} for column, kind in types.items()]
    return {"tables": {name: {"columns": columns, "partitions": list(partitions)}}}


def test_types_are_widened_and_others_reported(spark, database, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x", "a"), (2, None, "y", "b")], "n int, x double, w string, d string")
    sinks.save_table(df, f"{database}.kept", "append", ["d"], f"{tmp_path}/kept")
    wanted = document("kept", ["d"], n="bigint", x="int", d="string", w="string")
    changes = catalog.evolve_tables(spark, wanted, database, str(tmp_path))
    assert [(c.column, c.stored, c.declared, c.widened) for c in changes] == [
        ("n", "int", "bigint", True), ("x", "double", "int", False),
    ]
    table = spark.table(f"{database}.kept")
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        ("n", "bigint"), ("x", "double"), ("w", "string"), ("d", "string"),
    ]
    assert bag(table) == bag(df)
    sinks.save_table(df.withColumn("n", F.col("n").cast("bigint")), f"{database}.kept", "append")
    assert spark.table(f"{database}.kept").count() == 4
    again = catalog.evolve_tables(spark, wanted, database, str(tmp_path))
    assert [(c.column, c.widened) for c in again] == [("x", False)]


@pytest.mark.parametrize("done", [1, 2])
def test_a_swap_left_half_done_is_completed(spark, database, tmp_path, done):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    sinks.save_table(df, f"{database}.kept", path=f"{tmp_path}/old")
    sinks.save_table(df.selectExpr("cast(n AS bigint) AS n"), f"{database}.kept__staged", path=f"{tmp_path}/new")
    spark.sql(f"ALTER TABLE {database}.kept RENAME TO {database}.kept__replaced")
    if done == 2:
        spark.sql(f"ALTER TABLE {database}.kept__staged RENAME TO {database}.kept")
    assert catalog.evolve_tables(spark, document("kept", n="bigint"), database, str(tmp_path)) == []
    assert [tuple(r) for r in spark.table(f"{database}.kept").orderBy("n").collect()] == [(1,), (2,)]
    assert [t.name for t in spark.catalog.listTables(database)] == ["kept"]


def test_each_kind_of_difference_is_a_row(spark, database, tmp_path):
    df = spark.createDataFrame([("1", "p", 1, "k"), ("x", "p", 2, "k"), (None, "p", 3, "k")], "a string, d string, more int, e string")
    sinks.save_table(df, f"{database}.kept", "append", ["d"], f"{tmp_path}/kept")
    wanted = document("kept", ["e"], a="int", d="string", e="string", absent="date")
    wanted["tables"]["no_such_table"] = {"columns": [{"name": "z", "type": "int"}], "partitions": []}
    rows = {(r.table_name, r.column_name): (r.difference, r.filled, r.unfit) for r in catalog.conformance_rows(spark, wanted, database).collect()}
    assert rows == {
        ("kept", "a"): ("type", 2, 1), ("kept", "d"): ("partition", None, None), ("kept", "e"): ("partition", None, None),
        ("kept", "absent"): ("missing", None, None), ("kept", "more"): ("undeclared", None, None),
        ("no_such_table", "z"): ("missing", None, None),
    }


def test_summary_reads_users_once_beside_the_quality_metrics(spark, ctx, raw, tmp_path):
    path = sinks.write_folder(raw, f"{tmp_path}/raw")
    plan = tables_from_raw(spark.read.parquet(path), ctx)["vw_executive_summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) == 2


def test_ingest_takes_each_file_once(spark, tmp_path):
    inbox, target, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"

    def drop(*ids):
        lines = spark.createDataFrame([(json.dumps({"id": i}),) for i in ids], "value string")
        lines.coalesce(1).write.mode("append").text(inbox)

    def run():
        ingest.ingest_available(ingest.stream_files(spark, inbox), target, checkpoint).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(target).select("id").collect())

    drop("1", "2")
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    drop("3")
    assert run() == ["1", "2", "3"]


def test_ingest_takes_each_user_once(spark, tmp_path):
    inbox, target, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"

    def drop(*users):
        lines = spark.createDataFrame([(json.dumps({"id": i, "gender": g}),) for i, g in users], "value string")
        lines.coalesce(1).write.mode("append").text(inbox)
        ingest.ingest_available(ingest.stream_files(spark, inbox), target, checkpoint).awaitTermination()
        return sorted((r.id or "", r.gender) for r in spark.read.parquet(target).collect())

    # Of one id the smallest record of its first batch stays; records without an id are all kept.
    assert drop(("1", "b"), ("1", "a"), (None, "x"), ("", "y")) == [("", "x"), ("", "y"), ("1", "a")]
    assert drop(("1", "0"), ("2", "c"), ("", "y")) == [("", "x"), ("", "y"), ("", "y"), ("1", "a"), ("2", "c")]
    assert drop(("2", "z")) == [("", "x"), ("", "y"), ("", "y"), ("1", "a"), ("2", "c")]


def test_a_repeated_batch_gives_the_same_records(spark):
    rows = [("1", "b"), ("1", "a"), ("2", "c"), (None, "d")]
    earlier = spark.createDataFrame([("2", "old")], "id string, gender string")
    for order in (rows, rows[::-1]):
        batch = spark.createDataFrame(order, "id string, gender string")
        assert bag(ingest.new_records(batch, earlier)) == Counter({("a", "1"): 1, ("d", "None"): 1})


def test_each_ingest_batch_can_be_summarised(spark, ctx, raw, tmp_path):
    inbox, reports = f"{tmp_path}/in", {}
    lines = raw.select(F.to_json(F.struct(*records.RAW_COLUMNS)).alias("value"))
    lines.repartition(2).write.text(inbox)

    def summarise(users, batch):
        reports[batch] = ingest.process_user_batch(users, f"{tmp_path}/summary/{batch}", ctx)

    ingest.ingest_available(
        ingest.stream_files(spark, inbox, files_per_batch=1), f"{tmp_path}/out", f"{tmp_path}/cp", summarise
    ).awaitTermination()
    assert sorted(reports) == [0, 1]
    assert sum(r.processed_users for r in reports.values()) == 150


def test_topic_reader_states_its_bounds():
    assert records.topic_options("host:9092", "users_created") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "users_created", "failOnDataLoss": "false",
    }


def test_topic_without_its_connector_is_refused(spark):
    with pytest.raises(AnalysisException):
        records.read_topic(spark, "host:9092", "users_created")


def test_batch_report(spark, ctx, raw, users_like, tmp_path):
    assert ingest.process_user_batch(users_like(), f"{tmp_path}/empty", ctx) is None
    report = ingest.process_user_batch(raw, f"{tmp_path}/batch", ctx)
    assert report.processed_users == 150
    genders = {r.metric_name: r.metric_value for r in report.gender_distribution.collect()}
    assert genders == {"gender_female": 87, "gender_male": 63}
    assert len(report.top_email_domains) == 5 and len(report.top_states) == 5
    assert sum(r.user_count for r in report.country_distribution.collect()) == 150


def test_stored_tables_give_the_same_answers(spark, ctx, raw, tmp_path):
    """The jobs' tables, and views over them, equal those derived straight from raw users."""
    lake = Lake(spark, "stored_lake", f"{tmp_path}/lake")
    try:
        stored, derived = run_all(lake, raw, ctx), tables_from_raw(raw, ctx)
        for name in SILVER:
            assert catalog.schema_differences(stored[name].schema, derived[name].schema) == [], name
        for name in ["users_transformed", "fact_geographic_analysis", "fact_email_domain_analysis",
                     "fact_registration_trends", "vw_executive_summary", "vw_top_countries", "pipeline_health"]:
            assert bag(stored[name].select(derived[name].columns)) == bag(derived[name]), name
        before = {name: stored[name].count() for name in SILVER}
        again = run_all(lake, raw, ctx)
        assert {name: again[name].count() for name in SILVER} == before
    finally:
        spark.sql("DROP DATABASE stored_lake CASCADE")


def test_daily_runs_equal_one_run_over_the_history(spark, ctx, raw, tmp_path):
    days = [date(2024, 10, 1), date(2024, 10, 2), date(2024, 10, 3)]
    whole, daily = Lake(spark, "whole_lake", f"{tmp_path}/w"), Lake(spark, "daily_lake", f"{tmp_path}/d")
    try:
        at_once = run_all(whole, raw.filter(F.col("processing_date").isin(days)), ctx)
        for day in days:
            by_day = run_all(daily, raw.filter(F.col("processing_date") == day), ctx, [day])
        # The summary of a run is that of its own dates; here the last day's took the place of the others.
        assert by_day["data_quality_summary"].first().total_records == by_day[RAW].filter(
            F.col("processing_date") == days[-1]
        ).count()
        for name in [RAW, *INGEST_SUMMARIES, *SILVER, "total_users", "vw_bronze_vs_silver_completeness"]:
            if name != "data_quality_summary":
                columns = [c for c in at_once[name].columns if c != "z_score"]
                assert bag(by_day[name].select(columns)) == bag(at_once[name].select(columns)), name

        emptied = run_all(daily, raw.limit(0), ctx, [days[-1]])
        rest = whole.tables(ctx)
        for name in [RAW, "users_transformed", *PER_BATCH]:
            left = rest[name].filter(F.col("processing_date") != days[-1])
            columns = [c for c in left.columns if c != "z_score"]
            assert bag(emptied[name].select(columns)) == bag(left.select(columns)), name
        with pytest.raises(ValueError, match="2024-10-02"):
            run_all(daily, raw.filter(F.col("processing_date") == days[1]), ctx, [days[0]])
    finally:
        spark.sql("DROP DATABASE whole_lake CASCADE")
        spark.sql("DROP DATABASE daily_lake CASCADE")


def rows_without(df, *columns):
    return bag(df.select([c for c in df.columns if c not in columns]))


@pytest.fixture
def small_lake(spark, tmp_path):
    lake = Lake(spark, "small_" + tmp_path.name.replace("-", "_").lower(), f"{tmp_path}/lake")
    yield lake
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")


UPKEPT = ["dim_user_demographics", "fact_data_quality_metrics", "fact_data_quality_trends"]


def test_upkeep_of_late_repeated_and_emptied_dates(ctx, raw, small_lake):
    """After each run the kept tables equal those made from all users that are stored."""
    days = [date(2024, 10, d) for d in range(1, 7)]

    def of(*chosen):
        return raw.filter(F.col("processing_date").isin(list(chosen)))

    # An id of the sixth day that the fourth day has as well, until the fourth day is repeated without it.
    shared = of(days[3]).limit(1).withColumn("processing_date", F.lit(days[5]))
    fewer = of(days[3]).join(shared.select("picture"), "picture", "left_anti").select(raw.columns)
    runs = [
        ([days[3]], of(days[3])),
        ([days[5]], of(days[5]).unionByName(shared)),
        ([days[1], days[2]], of(days[1], days[2])),  # late dates
        ([days[3]], fewer),  # repeated with fewer users: one is counted with the sixth day from now on
        ([days[2]], of()),  # emptied
        ([days[0], days[4]], of(days[0], days[4])),
    ]
    for dates, arrived in runs:
        stored = run_all(small_lake, arrived, ctx, dates)
        whole = tables_from_raw(stored[RAW], ctx)
        for name in UPKEPT:
            assert rows_without(stored[name], "z_score") == rows_without(whole[name], "z_score"), (name, dates)


def test_upkeep_reads_users_of_the_run_only(spark, ctx, raw, small_lake):
    first, second = date(2024, 10, 1), date(2024, 10, 2)
    for day in (first, second):
        run_all(small_lake, raw.filter(F.col("processing_date") == day), ctx, [day])
    users = upkeep.of_dates(spark.table(f"{small_lake.database}.users_transformed"), [second])
    plans = [
        facts.user_demographics(users, ctx),
        facts.daily_quality_figures(users),
        trends.daily_quality(users),
        upkeep.counted_users(users),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert len(scans) == 1 and re.search(r"PartitionFilters: \[isnotnull\(processing_date.*2024-10-02", scans[0])


def test_an_interrupted_move_of_counted_users_can_be_repeated(spark, ctx, raw, small_lake):
    """Users that a repeated date has lost are added elsewhere first; doing so again changes nothing."""
    day, other = date(2024, 10, 1), date(2024, 10, 2)
    users = raw.filter(F.col("processing_date") == day)
    again = users.withColumn("processing_date", F.lit(other))
    run_all(small_lake, users, ctx, [day])
    run_all(small_lake, again, ctx, [other])
    table = f"{small_lake.database}.known_users"
    before = spark.table(table).filter(F.col("processing_date") == day)
    moved = before.select("id", F.lit(other).alias("processing_date"))
    small_lake.save("known_users", moved, "append")  # as far as a broken run came
    stored = run_all(small_lake, users.limit(0), ctx, [day])
    known = spark.table(table)
    assert known.count() == known.select("id").distinct().count() == stored["fact_data_quality_metrics"].first().unique_users
    assert {r[0] for r in known.select("processing_date").distinct().collect()} == {other}


def test_a_batch_run_reads_only_its_partition(spark, ctx, raw, tmp_path):
    path = f"{tmp_path}/users"
    users_transformed(raw, ctx).write.partitionBy("processing_date").parquet(path)
    users = spark.read.parquet(path).filter(F.col("processing_date").isin([date(2024, 10, 2)]))
    plan = facts.email_domain_analysis(users, ctx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(processing_date") == plan.count("FileScan parquet") == 2


def test_cleaning_stays_within_one_compiled_method(spark, ctx, raw, tmp_path):
    """The JVM does not compile methods above 8000 bytes, so no generated one may pass that."""
    path = sinks.write_folder(raw, f"{tmp_path}/raw")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    code = users_transformed(spark.read.parquet(path), ctx)._jdf.queryExecution().explainString(mode)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_views_read_only_the_columns_they_need(spark, ctx, raw, tmp_path):
    path = sinks.write_folder(users_transformed(raw, ctx), f"{tmp_path}/users")
    tables = tables_from_raw(raw, ctx)
    tables._built["users_transformed"] = spark.read.parquet(path)
    plan = tables["vw_age_generation_distribution"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<age_group:string,generation:string>" in plan


def test_all_readers_are_known(tables):
    assert set(READERS) < set(tables)
    assert len(tables) == len(list(tables))
