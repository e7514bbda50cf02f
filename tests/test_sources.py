import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import rules, seeds
from riskweave.sources import files, schemas, sinks
from riskweave.sources.views import Views

FOLDER = "/root/testdata/sf0.001"


def test_csv_with_other_column_order_and_extra_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("extra,Class," + ",".join(f"V{i}" for i in range(28, 0, -1)) + ",Amount,Time\n"
                    + "x,1," + ",".join(str(i) for i in range(28, 0, -1)) + ",9.5,7\n")
    row = files.read_csv(spark, str(path), schemas.table_schema("card_transactions")).first()
    assert (row["Class"], row["V3"], row["Amount"], row["Time"]) == (1, 3.0, 9.5, 7.0)
    with pytest.raises(ValueError, match="missing: Label"):
        files.read_csv(spark, str(path), schemas.table_schema("card_transactions"), required=["Label"])


def test_csv_round_trip_and_optional_source(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    files.write_csv(df, str(tmp_path / "out"))
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path / "out"), df.schema).collect()} == {(1, "a"), (2, None)}
    absent = files.read_optional_csv(spark, str(tmp_path / "nothing.csv"), df.schema)
    assert absent.count() == 0 and absent.columns == ["n", "s"]


def test_first_existing_json(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"p": 0.25}, indent=2))
    schema = "p double"
    found = files.read_first_json(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")], schema)
    assert found.first()["p"] == 0.25
    with pytest.raises(FileNotFoundError):
        files.read_first_json(spark, [str(tmp_path / "a.json")], schema)


def test_report_document(spark, tmp_path):
    document = files.report_document({"rules": spark.createDataFrame([("r", 1)], "rule string, n int")})
    files.write_report(document, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["rules"][0]["rule"] == "r"


@pytest.mark.parametrize("parts", [1, 3])
def test_a_document_is_written_line_by_line(spark, tmp_path, parts):
    rows = [(n % 997, None if n % 5 == 0 else f'a "b"\n{n} \u00e9', {"x": n}) for n in range(5000)]
    big = spark.createDataFrame(rows, "n long, s string, m map<string,int>").repartition(7)
    sections = {"big": (big, ["n", "s"]), 'no "rows"': (big.where("n < 0"), ["n"]), "few": (spark.createDataFrame([(2,), (None,), (1,)], "section int"), ["section"])}
    files.write_document(sections, str(tmp_path / "document"), parts)
    written = sorted((tmp_path / "document").glob("part-*"))
    assert len(written) == parts
    found = json.loads("".join(p.read_text(encoding="utf-8") for p in written))
    assert list(found) == ["big", 'no "rows"', "few"]
    place = [(r["n"], r["s"] or "") for r in found["big"]]
    assert place == sorted(place)  # rows equal in n and s take any order
    assert sorted((r["n"], r["s"] or "", r["m"]["x"]) for r in found["big"]) == sorted((n, s or "", m["x"]) for n, s, m in rows)
    assert found['no "rows"'] == [] and found["few"] == [{"section": None}, {"section": 1}, {"section": 2}]
    lines = files.document_lines(sections)
    assert lines.agg(F.max(F.length("line"))).first()[0] < 100


def test_a_document_without_sections(spark, tmp_path):
    files.write_document({}, str(tmp_path / "document"))
    assert spark.read.text(str(tmp_path / "document")).first()["value"] == "{}"


def test_fingerprint_is_that_of_the_rows(spark):
    rows = [(1, "a"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "n int, s string")
    number = lambda *values: int(hashlib.md5("\n".join(values).encode()).hexdigest()[:8], 16)
    want = (3, number("1", "a") + 2 * number("2", "\\N"))
    assert tuple(files.fingerprint(df, ["n", "s"]).first()) == want == tuple(files.fingerprint(df.repartition(3).orderBy("s"), ["n", "s"]).first())
    assert tuple(files.fingerprint(df.limit(0), ["n", "s"]).first()) == (0, 0)


def test_csv_files_with_their_own_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n")
    (tmp_path / "c.csv").write_text("extra,x\nz,100\n")
    df = files.read_csv(spark, str(tmp_path), spark.createDataFrame([], "x int, y int").schema)
    assert {tuple(r) for r in df.select("x", "y").collect()} == {(1, 2), (3, 4), (10, 20), (100, None)}


def test_keys_of_any_length_stay_different(spark):
    customers = seeds.customers_for(spark.createDataFrame([(9999,), (10000,), (100001,), (1000000,), (10000010,)], "customer_id long"))
    for column in ("customer_code", "pan_number", "mobile_number"):
        assert customers.select(column).distinct().count() == 5
    assert seeds.kyc_for(customers, F.lit("2024-06-30").cast("date")).select("aadhaar_number").distinct().count() == 5


def test_partitioned_sink_prunes_files(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, n int")
    files.write_parquet(df, str(tmp_path / "t"), ["day"])
    assert spark.read.parquet(str(tmp_path / "t")).where("day = '2024-01-02'").first()["n"] == 2
    assert (tmp_path / "t" / "day=2024-01-01").is_dir()


def test_quarantine_files(spark, tmp_path):
    df = spark.createDataFrame([(17,), (40,)], "age int")
    sinks.write_quarantine(df, *[str(tmp_path / n) for n in ("clean", "bad", "audit")], "in.csv")
    assert spark.read.parquet(str(tmp_path / "clean")).first()["age"] == 40
    assert spark.read.parquet(str(tmp_path / "bad")).first()["quarantine_rule"] == "age_range"
    assert spark.read.json(str(tmp_path / "audit")).first()["quarantined_rows"] == 1


def sequential_insert(rows, existing, keys):
    table = list(existing)
    added = []
    for row in rows:
        if not any(row[k] is not None and row[k] == other[k] for other in table for k in keys):
            table.append(row)
            added.append(row["id"])
    return added


def test_insert_ignoring_conflicts_equals_row_by_row_insert(spark):
    rows = [{"id": 1, "a": "x", "b": "p"}, {"id": 2, "a": "y", "b": "p"}, {"id": 3, "a": "y", "b": "q"}, {"id": 4, "a": None, "b": "r"},
            {"id": 5, "a": None, "b": None}, {"id": 6, "a": "t", "b": "s"}, {"id": 7, "a": "u", "b": "s"}, {"id": 8, "a": "u", "b": "v"}]
    existing = [{"id": 0, "a": "t", "b": None}]
    schema = "id long, a string, b string"
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    table = spark.createDataFrame([tuple(r.values()) for r in existing], schema)
    added = sinks.insert_ignoring_conflicts(frame, table, ["a", "b"], "id")
    assert sorted(r["id"] for r in added.collect()) == sequential_insert(rows, existing, ["a", "b"]) == [1, 3, 4, 5, 7]


def test_seed_data(spark):
    customers = seeds.customers_for(seeds.seed_keys(spark))
    branches = seeds.branch_rows(spark)
    as_of = F.lit("2024-06-30").cast("date")
    accounts = seeds.accounts_for(customers, branches, as_of)
    assert customers.count() == 500 and accounts.count() == 500
    mix = {r["risk_category"]: r["count"] for r in customers.groupBy("risk_category").count().collect()}
    assert mix == {"Low": 400, "Medium": 75, "High": 25}
    assert seeds.kyc_for(customers, as_of).select("aadhaar_number").distinct().count() == 500
    first = accounts.where("customer_id = 10").first()
    assert (first["account_number"], str(first["opening_balance"]), first["branch_id"], first["account_type"]) == (
        "AC0000000010", "11255.00", 5, "Current")
    assert seeds.addresses_for(customers).where("customer_id = 3").first()["city"] == "Mumbai"


def test_alert_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    from riskweave.streaming.alerts import stream_alerts, write_alert_stream

    v = Views(spark, FOLDER)
    source = str(tmp_path / "transactions")
    v.transactions.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    alerts = stream_alerts(stream, v.accounts, v.customers, v.cards, v.merchants, v.devices, v.customer_kyc)
    out = str(tmp_path / "alerts")
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for run in ("first", "again"):
        write_alert_stream(alerts, out, str(tmp_path / run), available_now=True).awaitTermination()
        assert spark.read.parquet(out).count() == v.alerts.count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= cached
    again = sinks.append_alerts(v.alerts, out)
    assert again["created"] == 0 and again["skipped"] == v.alerts.count()


def jobs_of(spark, run):
    """How many jobs ``run`` starts, and what it returns."""
    context, group = spark.sparkContext, f"g{id(run)}"
    context.setJobGroup(group, "counted")
    try:
        result = run()
        return len(context.statusTracker().getJobIdsForGroup(group)), result
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_in_mixed_column_orders_take_few_jobs(spark, tmp_path):
    schema = spark.createDataFrame([], "x int, y int, z string").schema
    counts = {}
    for files_ in (150, 2000):
        folder = tmp_path / f"f{files_}"
        folder.mkdir()
        for i in range(files_):
            names = [("x", "y", "z"), ("z", "y", "x"), ("y", "extra", "x", "z")][i % 3]
            row = {"x": i, "y": -i, "z": f'"a,{i}"', "extra": "?"}
            (folder / f"part {i}.csv").write_text(",".join(names) + "\n" + ",".join(str(row[n]) for n in names) + "\n")
        (folder / "empty.csv").write_text("")
        counts[files_], rows = jobs_of(spark, lambda f=folder: files.read_csv(spark, str(f), schema).collect())
        assert sorted((r["x"], r["y"], r["z"]) for r in rows) == [(i, -i, f"a,{i}") for i in range(files_)]
    assert counts[150] == counts[2000] <= 12


def test_a_known_header_saves_the_scan_and_another_one_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    schema = spark.createDataFrame([], "x int, y int").schema
    assert files.read_csv(spark, str(tmp_path), schema, header=["x", "y"]).first()["y"] == 2
    (tmp_path / "b.csv").write_text("y,x\n4,3\n")
    with pytest.raises(Exception, match="header|CSV"):
        files.read_csv(spark, str(tmp_path), schema, header=["x", "y"]).collect()


def test_folder_of_empty_files_is_an_empty_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path), spark.createDataFrame([], "x int").schema, required=[]).isEmpty()


def random_clashes(rng, n):
    return [{"id": i, "a": rng.choice([None, *"abcdefgh"[: n // 6 + 2]]), "b": rng.choice([None, *"pqrstuvw"[: n // 6 + 2]]),
             "c": rng.choice([None, *range(n)])} for i in rng.sample(range(1000), n)]


@pytest.mark.parametrize("seed", range(5))
def test_insert_of_random_clashes_equals_row_by_row_insert(spark, seed):
    rng = random.Random(seed)
    rows = random_clashes(rng, 30)
    rows.sort(key=lambda r: r["id"])
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, a string, b string, c long").repartition(3)
    table = spark.createDataFrame([(1001, "a", None, 3)], frame.schema)
    added = sinks.insert_ignoring_conflicts(frame, table, ["a", "b", "c"], "id")
    want = sequential_insert(rows, [{"id": 1001, "a": "a", "b": None, "c": 3}], ["a", "b", "c"])
    assert sorted(r["id"] for r in added.collect()) == want and added.columns == frame.columns


def test_a_long_chain_of_clashes_takes_log_many_steps(spark, monkeypatch):
    n, steps = 10_000, []
    write = sinks.materialise
    monkeypatch.setattr(sinks, "materialise", lambda df: steps.append(1) or write(df))
    # each row clashes with the one before it, on a and on b in turn
    frame = spark.range(n).select("id", F.floor(F.col("id") / 2).alias("a"), F.floor((F.col("id") + 1) / 2).alias("b"))
    added = sinks.insert_ignoring_conflicts(frame, frame.limit(0), ["a", "b"], "id")
    assert [r["id"] for r in added.orderBy("id").collect()] == list(range(0, n, 2))
    assert len(steps) <= 14 + 2 + 6


def test_one_hot_key_is_decided_in_two_rounds(spark):
    frame = spark.range(3000).select("id", F.lit("x").alias("a"), F.when(F.col("id") > 0, F.col("id") % 7).alias("b"))
    added = sinks.insert_ignoring_conflicts(frame, frame.limit(0), ["a", "b"], "id")
    assert [r["id"] for r in added.collect()] == [0]


def alerts_of(spark, ids):
    return spark.createDataFrame([(i, "RULES", 0.5) for i in ids], "transaction_id long, detection_source string, fraud_score double")


def test_alert_table_is_met_in_place_and_only_touched_ranges_are_read(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert sinks.append_alerts(alerts_of(spark, range(0, 5000, 7)), path, buckets=4, span=1000) == {"created": 715, "skipped": 0}
    batch = alerts_of(spark, [3500, 3501, 4200, 4201, 4201])
    once = sinks.materialise(batch.withColumn(sinks.ALERT_RANGE, F.lit(3).cast("long")))
    table = sinks.alert_table(spark, path, once.schema, 4)
    dealt, existing = sinks.known_alerts(once, table, [3, 4], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rules.new_alerts(dealt, existing)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the alerts are dealt out, the table isn't
    assert "Bucketed: true" in plan and plan.count("hashpartitioning(transaction_id") == 1 and plan.count("Exchange") == 1
    assert f"PartitionFilters: [{sinks.ALERT_RANGE}" in plan and "IN (3,4)" in plan
    assert sinks.append_alerts(batch, path, buckets=4, span=1000) == {"created": 2, "skipped": 2}
    assert sinks.append_alerts(batch, path, buckets=4, span=1000) == {"created": 0, "skipped": 4}
    assert spark.read.parquet(path).count() == 717 and (tmp_path / "alerts" / f"{sinks.ALERT_RANGE}=4").is_dir()


def test_replayed_micro_batches_add_nothing(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for ids in ([1, 2, 3], [3, 4], [3, 4], [], [1, 2, 3]):
        sinks.append_alerts(alerts_of(spark, ids), path, buckets=2)
    assert sorted(r[0] for r in spark.read.parquet(path).select("transaction_id").collect()) == [1, 2, 3, 4]
