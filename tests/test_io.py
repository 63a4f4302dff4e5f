"""Sources, sinks and the drop zone on a local folder."""

import json

import pytest
from pyspark.sql import functions as F

from tallyproof.sources import contracts, encoders, files
from tallyproof.sources.batches import merchant_csv
from tallyproof.streaming import dropzone
from tallyproof.streaming.heartbeat import watch


def test_positional(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "wb") as f:
        f.write("code;code;v\nA;é;1,00\nB;x\n".encode("latin-1"))
    rows = [tuple(r) for r in files.positional(spark, path, 3).collect()]
    assert rows == [("A", "é", "1,00"), ("B", "x", None)]
    assert sorted(r.width for r in files.ragged(spark, path).collect()) == [2, 3]
    assert files.separator_of(spark, path) == ";" and files.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]


def test_publish_once(spark, tmp_path):
    df, path = spark.range(10).withColumn("v", F.col("id") * 2), str(tmp_path / "t")
    assert files.publish(df, path, ["id"]) == "published"
    assert files.publish(df.repartition(3), path) == "already_published"
    with pytest.raises(ValueError):
        files.publish(df.withColumn("v", F.col("id")), path)
    assert files.landing(spark, str(tmp_path / "t"), "part-").count() == 10
    one = files.publish(df, str(tmp_path / "u"), ["id"], one_file=True)
    assert one == "published" and len(spark.read.parquet(str(tmp_path / "u")).inputFiles()) == 1 and not [x for x in tmp_path.iterdir() if "staged" in x.name]


def test_digests_tell_nulls_apart(spark):
    rows = [[(None, "x"), ("a", "b")], [("x", None), ("a", "b")], [("a", "b"), (None, "x")], [(None, "x"), (None, "x"), ("a", "b")], [("x", ""), ("a", "b")]]
    found = [files.content_hash(spark.createDataFrame(r, "a string, b string")).first() for r in rows]
    assert found[0] == found[2] and len({tuple(f) for f in found}) == 4


def test_replaced_tables_and_evidence(spark, tmp_path):
    files.overwrite(spark.range(9).repartition(6), str(tmp_path / "o"), 2)
    files.overwrite(spark.range(5).repartition(6), str(tmp_path / "o"), 2)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5 and len(spark.read.parquet(str(tmp_path / "o")).inputFiles()) == 2
    for n in (3, 4):
        files.replace_table(spark.range(n), "replaced", str(tmp_path / "r"))
        assert spark.table("replaced").count() == n
    spark.sql("drop table replaced")
    digest = files.evidence(spark, {"b": {"z": 1, "a": "é"}, "a": {}}, str(tmp_path / "e"))
    assert (tmp_path / "e" / "b.json").read_text() == '{"a":"é","z":1}\n' and len(digest) == 64
    with pytest.raises(FileExistsError):
        files.evidence(spark, {"a": {}}, str(tmp_path / "e"))
    assert [r.sha256 for r in files.file_digests(spark, str(tmp_path / "e"), "a.json").collect()] == ["ca3d163bab055381827226140568f3bef7eaac187cebd76878e0b63e9e442356"]


def test_short_rows_and_anchored_totals(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h;h;h\n1;2;3\n1;"2;2"\n"a;b";c;d\n')
    assert tuple(files.short_rows(spark, str(tmp_path / "a.csv"), 3).first()) == (3, 1)
    (tmp_path / "t-202501.json").write_text(json.dumps({"linhas": 2, "soma": "3.10"}))
    anchor = spark.sql("select '202501' period, 9L rows, cast(1 as decimal(38,2)) total")
    assert [tuple(r)[:2] for r in files.monthly_totals(spark, str(tmp_path / "t-*.json"), anchor).collect()] == [("202501", 9)]


def test_totals_in_two_spellings(spark, tmp_path):
    for name, doc in (("t-202501.json", {"count_linhas": 2, "sum_vl_liquido": "3.10"}), ("t-202502.json", {"linhas": 4, "soma": "5.00"})):
        (tmp_path / name).write_text(json.dumps(doc))
    got = files.monthly_totals(spark, str(tmp_path / "t-*.json")).orderBy("period").collect()
    assert [(r.period, r.rows, str(r.total)) for r in got] == [("202501", 2, "3.10"), ("202502", 4, "5.00")]


def test_ready_batches(spark, tmp_path):
    for name in ("B202607230000001", "B202607230000002", "other"):
        (tmp_path / name).mkdir()
    (tmp_path / "B202607230000001" / "source-manifest.json").write_text("{}")
    (tmp_path / "other" / "source-manifest.json").write_text("{}")
    assert [r.batch_id for r in files.ready_batches(spark, str(tmp_path)).collect()] == ["B202607230000001"]


def test_expectation_needs_an_approver(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"approved_by": "someone", "records": [{"id": 1, "v": "x"}, {"id": 2}]}))
    (tmp_path / "b.json").write_text(json.dumps({"approved_by": " "}))
    found = contracts.expectation(spark, str(tmp_path / "a.json"))
    assert [tuple(r) for r in contracts.expected_records(spark, found).collect()] == [("1", "x"), ("2", None)]
    with pytest.raises(PermissionError):
        contracts.expectation(spark, str(tmp_path / "b.json"))
    assert contracts.layout("202508")[1] == 10 and contracts.layout("202509")[1] == 9


def test_metrics(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"n": 1}\nnot json\n{"n": 3}\n{"n": 2}\n')
    good, bad = contracts.metrics(spark, str(tmp_path / "m.jsonl"), "n int", "n", 2)
    assert [r.n for r in good.collect()] == [3, 2] and [r.value for r in bad.collect()] == ["not json"]


def test_csv_goes_round(spark):
    header = "chargeback_id;batch_id;merchant_id;merchant_tax_id;reason_code;description;original_amount_brl;rate_percent;chargeback_amount_brl;business_date"
    rows = spark.sql("select 'CBK2026072305001' chargeback_id, 'B202607230000501' batch_id, 'MER0000000000001' merchant_id, '12345678000195' merchant_tax_id, 'FRAUD' reason_code, 'a \"b\"; c' description, 67.00BD original_amount_brl, 1.500BD rate_percent, 1.01BD chargeback_amount_brl, date'2026-07-23' business_date, 1 position")
    written = encoders.merchant_csv(rows, header).select(F.lit("/f").alias("path"), F.encode("content", "UTF-8").alias("content"))
    result = merchant_csv(written, "06")
    assert result.batches.first().rejection_code is None and result.details.first().description == 'a "b"; c'


def test_drop_zone(spark, tmp_path):
    zone = tmp_path / "zone"
    zone.mkdir()
    beat = watch(spark)

    def handle(df):
        rows = df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.decode("content", "UTF-8").alias("body"))
        if rows.filter("body = 'bad'").count():
            raise ValueError("bad file")
        return rows

    def cycle():
        dropzone.work(dropzone.batches(spark, str(zone)), handle, str(tmp_path / "out"), str(tmp_path / "states"), str(tmp_path / "progress"), ["name"]).awaitTermination()

    (zone / "one.txt").write_text("1")
    cycle()
    (zone / "two.txt").write_text("bad")
    cycle()
    (zone / "three.txt").write_text("3")
    cycle()
    cycle()
    assert json.loads(beat.document()) and {x["state"] for x in beat.state.values()} <= {"running", "idle", "stopped"}
    spark.streams.removeListener(beat)
    assert sorted(r.name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["one.txt", "three.txt"]
    states = str(tmp_path / "states")
    last = lambda: {r.path.rsplit("/", 1)[1]: r.state for r in spark.read.json(states).groupBy("path").agg(F.max_by("state", "cycle").alias("state")).collect()}
    assert last() == {"one.txt": "succeeded", "two.txt": "retry_pending: ValueError", "three.txt": "succeeded"}
    (zone / "two.txt").write_text("2")  # mended: a retry takes it
    assert dropzone.retry(spark, handle, str(tmp_path / "out"), states, ["name"]) == 1
    assert sorted(r.name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["one.txt", "three.txt", "two.txt"]


def test_a_pending_file_is_read_again_with_later_ones(spark, tmp_path):
    zone, out, states = tmp_path / "zone", str(tmp_path / "out"), str(tmp_path / "states")
    zone.mkdir()
    mended = []

    def handle(df):
        rows = df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.decode("content", "UTF-8").alias("body"))
        if not mended and rows.filter("body = 'bad'").count():
            raise ValueError("bad file")
        return rows

    def cycle():
        dropzone.work(dropzone.batches(spark, str(zone)), handle, out, states, str(tmp_path / "progress"), ["name"]).awaitTermination()

    for name, body in (("a", "1"), ("b", "bad"), ("c", "3")):
        (zone / name).write_text(body)
    cycle()
    assert sorted(r.name for r in spark.read.parquet(out).collect()) == ["a", "c"]
    assert [r.path.rsplit("/", 1)[1] for r in dropzone.pending(spark, states).collect()] == ["b"]
    mended.append(True)
    (zone / "d").write_text("4")
    cycle()
    assert sorted(r.name for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"] and not dropzone.pending(spark, states).count()


def test_files_wait_for_their_marker(spark):
    rows = spark.createDataFrame([("/z/B1/data.dat",), ("/z/B1/source-manifest.json",), ("/z/B2/data.dat",)], "path string")
    assert [r.path for r in dropzone.ready(rows).collect()] == ["/z/B1/data.dat"]


def test_windowed_totals(spark, sf, tmp_path):
    source = spark.read.parquet(f"{sf}/events.parquet")
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    running = dropzone.running_totals(stream).writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).start()
    running.awaitTermination()
    assert spark.table("totals").agg(F.sum("n")).first()[0] == source.count()


def test_ledger_contracts_and_manifests(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b"; c'), (2, None)], "id int, v string")
    files.write_csv(rows, str(tmp_path / "csv"))
    back = files.expected_rows(spark, str(tmp_path / "csv"))
    assert sorted((r.id, r.v) for r in back.collect()) == [("1", 'a "b"; c'), ("2", None)]
    for n in (1, 2):
        files.append_ledger(rows.filter(f"id = {n}"), str(tmp_path / "ledger"))
    with open(tmp_path / "ledger" / "part-bad.json", "w") as f:
        f.write("not an event\n")
    read = files.ledger(spark, str(tmp_path / "ledger"), "id int, v string").cache()
    assert sorted(r.id for r in read.filter("_corrupt_record is null").collect()) == [1, 2] and read.filter("_corrupt_record is not null").count() == 1
    for n in (1, 2):
        (tmp_path / f"B{n}").mkdir()
        (tmp_path / f"B{n}" / "source-manifest.json").write_text(json.dumps({"batch_id": f"B{n}", "declared_net_amount": "1.50"}))
    found = files.manifests(spark, str(tmp_path), "batch_id string, declared_net_amount string")
    assert sorted(r.batch_id for r in found.filter("batch_id is not null").collect()) == ["B1", "B2"]


def test_catalog_frames(spark, tmp_path):
    from tallyproof.operators import search

    files.replace_table(spark.range(2).withColumn("name", F.lit("x")), "seen_table", str(tmp_path / "t"))
    found = search.tables(spark).filter("table_name = 'seen_table'").collect()
    spark.sql("drop table seen_table")
    assert sorted((r.column_name, r.data_type) for r in found) == [("id", "bigint"), ("name", "string")]
    assert search.routines(spark).filter("name = 'sha2'").count() == 1


def test_session_settings(spark):
    from tallyproof.plans.session import BASE, object_store, session

    again = session("again", more=object_store("http://store", "k", "s"))
    assert again.sparkContext is spark.sparkContext and set(object_store("e", "k", "s")) == {f"spark.hadoop.fs.s3a.{n}" for n in ("endpoint", "access.key", "secret.key", "path.style.access")}
    assert BASE["spark.sql.session.timeZone"] == "UTC"
