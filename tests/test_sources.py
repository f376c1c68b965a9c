import os

import pytest
from pyspark.sql import functions as F

from carelake.plans import readers
from carelake.operators import ccda, changes, logs, manifest, tickets
from carelake.sources import files, sinks
from carelake.streaming import marks


def _write(path, text, when=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    if when is not None:
        os.utime(path, (when, when))


def test_csv_dir_skips_by_whole_name(spark, tmp_path, rows_of):
    _write(tmp_path / "a.csv", "First Name,DOB\nAl,01\n")
    _write(tmp_path / "b.csv", "First Name,DOB\nBo,1e5\n")
    _write(tmp_path / "OptOutList.csv", "other,header,here\n1,2,3\n")
    _write(tmp_path / "processed", "x\n1\n")
    _write(tmp_path / "unprocessed may.csv", "First Name,DOB\nCy,3\n")
    out = files.read_csv_dir(spark, str(tmp_path), {"First Name": "fname", "DOB": "dob"})
    assert rows_of(out) == [("Al", "01", "a.csv"), ("Bo", "1e5", "b.csv"), ("Cy", "3", "unprocessed may.csv")]
    assert dict(out.dtypes)["dob"] == "string"


def test_csv_dir_reads_each_file_by_its_header(spark, tmp_path, rows_of):
    _write(tmp_path / "a.csv", "x,y\n1,\"two\nlines\"\n")
    _write(tmp_path / "b.csv", "y,x,z\n1,2,3\n")
    _write(tmp_path / "empty.csv", "")
    out = files.read_csv_dir(spark, str(tmp_path))
    assert rows_of(out, "x", "y", "z") == [("1", "two\nlines", None), ("2", "1", "3")]


def test_ragged_csv_with_two_headers(spark, tmp_path, rows_of):
    _write(tmp_path / "a.csv", "Name,City\nAl,X\n")
    _write(tmp_path / "b.csv", "City,>Name \nY,Bo,more\nZ\n")
    out = files.read_ragged_csv(spark, str(tmp_path), ["Name", "City"])
    assert rows_of(out) == [("", "Z"), ("Al", "X"), ("Bo", "Y")]


def test_table_keeps_other_partitions(spark, rows_of):
    rows = lambda ds, *ids: spark.createDataFrame([(i, ds) for i in ids], "id int, ds string")
    try:
        for ds, ids in (("2024-01", (1, 2)), ("2024-02", (3,)), ("2024-03", (4,)), ("2024-02", (5, 6)), ("2024-02", (5, 6))):
            sinks.save_table(rows(ds, *ids), "kept_parts", ["ds"], bucket="id", buckets=2)
        assert rows_of(spark.table("kept_parts"), "id", "ds") == [(1, "2024-01"), (2, "2024-01"), (4, "2024-03"), (5, "2024-02"), (6, "2024-02")]
        assert "2" in spark.sql("DESCRIBE EXTENDED kept_parts").filter("col_name = 'Num Buckets'").first().data_type
    finally:
        spark.sql("DROP TABLE IF EXISTS kept_parts")


def test_ragged_csv(spark, tmp_path, rows_of):
    _write(tmp_path / "r.csv", ">Name , City,,Extra\nA,X,1,2\nB\nC,Y,1,2,3,4\n\"D\nline\",Z,1,2\n")
    out = files.read_ragged_csv(spark, str(tmp_path / "r.csv"), ["Name", "City", "State"])
    assert rows_of(out) == [("A", "X", "Not Applicable"), ("B", "", "Not Applicable"), ("C", "Y", "Not Applicable"), ("D\nline", "Z", "Not Applicable")]
    assert rows_of(files.read_ragged_csv(spark, str(tmp_path / "r.csv"), ["State"], None))[0] == (None,)
    assert files.clean_header(["", "a>", None]) == ["_unnamed_0", "a", "_unnamed_2"]


def test_latest_file(spark, tmp_path):
    _write(tmp_path / "old.csv", "x", 1000)
    _write(tmp_path / "new.csv", "x", 2000)
    _write(tmp_path / "newer.txt", "x", 3000)
    listed = files.list_files(spark, str(tmp_path))
    assert listed.count() == 3
    assert files.latest_file(listed).first().path.endswith("/new.csv")


def test_tsv_logs_reject_files_of_another_width(spark, tmp_path, rows_of):
    base = tmp_path / "logs"
    _write(base / "dev-1" / "2024" / "a.log", "h1\th2\n1\t 2024-01-02 03:04:05 \n3\tx\n")
    _write(base / "dev-2" / "2025" / "b.log", "h1\th2\th3\n1\t2\t3\n")
    good, bad = files.read_tsv_logs(spark, str(base), ["Action", "Session_ID"])
    cleaned = logs.clean_logs(good, str(base), "2024-02-01 00:00:00")
    assert rows_of(cleaned, "Action", "Session_ID", "server_source") == [("1", "20240102_030405", "dev-1"), ("3", "x", "dev-1")]
    assert [(r.Source_File.rsplit("/", 1)[1], r.width) for r in bad.collect()] == [("b.log", 3)]
    assert good.filter(logs.in_listed_year(F.col("Source_File"), ("2024",))).count() == 2
    assert changes.unprocessed(good.select("Source_File"), good, "Source_File").count() == 0


def test_compaction_is_repeatable(spark, tmp_path):
    _write(tmp_path / "in" / "a.json", '{"a":\n1}', 1704067200)
    _write(tmp_path / "in" / "sub" / "b.json", "{}", 1706745600)
    for _ in range(2):
        files.compact_text_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((str(r.index_update), r.file_content) for r in out.collect()) == [("2024-01", '{"a":\n1}'), ("2024-02", "{}")]


def test_hl7_and_ccda_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.hl7").write_bytes("MSH|^~\\&|é\rPID|1\r".encode("latin-1"))
    row = files.read_hl7v2(spark, str(tmp_path / "m")).first()
    assert row.name == "x.hl7" and row.file.endswith("/m/x.hl7") and row.value == "MSH|^~\\&|é\rPID|1\r"
    doc = ('<ClinicalDocument xmlns="urn:hl7-org:v3"><recordTarget><patientRole><patient><name><given>A</given></name>'
           "</patient></patientRole>\n</recordTarget></ClinicalDocument>\n")
    _write(tmp_path / "d" / "s" / "one.XML", doc)
    _write(tmp_path / "d" / "two.xml", doc)
    _write(tmp_path / "d" / "t" / "two.xml", doc)
    _write(tmp_path / "d" / "no.txt", "x")
    people = ccda.ccda_demographics(files.read_ccda(spark, str(tmp_path / "d")))
    sinks.publish_snapshot(people, str(tmp_path / "p"))
    read = sorted(r.file.split("/d/")[1] for r in spark.read.parquet(str(tmp_path / "p")).collect())
    assert read == ["s/one.XML", "t/two.xml", "two.xml"]


def test_partition_overwrite_replaces_only_its_month(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    sinks.save_partitions(spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, ds string"), path, ["ds"])
    sinks.save_partitions(spark.createDataFrame([(3, "2024-02")], "v int, ds string"), path, ["ds"])
    back = spark.read.parquet(path)
    assert [r[0] for r in rows_of(back, "v")] == [1, 3]
    plan = back.filter("ds = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}/db'")
    for name in ("l", "r"):
        sinks.save_table(spark.range(1000).withColumnRenamed("id", "k"), f"bucketed.{name}", bucket="k", buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = spark.table("bucketed.l").join(spark.table("bucketed.r"), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed.l")
        spark.sql("DROP TABLE bucketed.r")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


SEEN = "client string, file string, modified timestamp_ntz"


def _seen(spark, rows):
    return spark.createDataFrame(rows, "client string, file string, m string").select("client", "file", F.col("m").cast("timestamp_ntz").alias("modified"))


def test_stream_keeps_marks_between_runs(spark, tmp_path, rows_of):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    def run():
        stream = marks.file_stream(spark, source, SEEN)
        marks.watch(stream, ["client", "file"], "modified", folder).awaitTermination()
        return rows_of(marks.changes_of(spark, folder).select("client", "file", F.date_format("modified", "dd").alias("d"), "version"))

    _seen(spark, [("c", "a", "2024-01-01 00:00:00"), ("c", "b", "2024-01-02 00:00:00")]).coalesce(1).write.mode("append").parquet(source)
    assert run() == [("c", "a", "01", 0), ("c", "b", "02", 0)]
    _seen(spark, [("c", "a", "2024-01-01 00:00:00"), ("c", "b", "2024-01-03 00:00:00"), ("d", "a", "2024-01-01 00:00:00")]).coalesce(1).write.mode("append").parquet(source)
    assert run() == [("c", "a", "01", 0), ("c", "b", "02", 0), ("c", "b", "03", 1), ("d", "a", "01", 1)]
    assert len(run()) == 4


def _moved(spark, rows):
    return spark.createDataFrame(rows, "k string, t bigint")


def test_mark_store_writes_what_changed(spark, tmp_path, rows_of):
    """A thousand marks, then batches of three: a delta each, merged as they grow, equal to the plain fold."""
    store = marks.MarkStore(spark, str(tmp_path / "m"), ["k"], "t", _moved(spark, [("a", 1)]), buckets=8, most_deltas=4)
    known = {f"k{i}": i for i in range(1000)} | {None: 5}
    state = store.advance(0, _moved(spark, list(known.items())))
    base = store.bytes_of(state["base"])
    for version in range(1, 8):
        moved = {f"k{version * 7}": 5000 + version, f"new{version}": version, None: 100 + version}
        known |= moved
        state = store.advance(version, _moved(spark, list(moved.items())))
        assert state["base"] == "base-0" and len(state["deltas"]) <= 5
        assert store.bytes_of(state["deltas"][-1]) < base / 2
    assert any(d.startswith("deltas-") for d in state["deltas"])
    read = changes.advance_marks(store.read(state), _moved(spark, []), ["k"], "t")
    assert {r.k: r.t for r in read.collect()} == known
    kept = {p.name for p in (tmp_path / "m").iterdir()} - {"state"}
    assert kept <= {state["base"], *state["deltas"], *store.state(6)["deltas"]}
    # Few keys read few buckets.
    some = store.read(state, _moved(spark, [("k7", 1)]))
    assert {r[0] for r in some.select("bucket").distinct().collect()} == {some.select(store.bucket()).first()[0]} and some.count() < 300
    # As many changes as marks: a new base.
    state = store.advance(8, _moved(spark, [(f"k{i}", 9000 + i) for i in range(1000)]))
    assert state == {"base": "base-8", "deltas": []} and store.read(state).count() == 1008


def test_mark_store_runs_a_version_again(spark, tmp_path, rows_of):
    """Stopped at any point of a version, the next run of it gives the same state."""
    store = marks.MarkStore(spark, str(tmp_path / "m"), ["k"], "t", _moved(spark, [("a", 1)]), buckets=4)
    store.advance(0, _moved(spark, [(f"k{i}", i) for i in range(300)]))
    store.advance(1, _moved(spark, [("k1", 900)]))
    first = store.advance(2, _moved(spark, [("k2", 901)]))
    want = rows_of(store.read(first), "k", "t")
    assert store.advance(2, _moved(spark, [("k2", 901)])) == first and rows_of(store.read(first), "k", "t") == want
    store._write(_moved(spark, [("half", 1)]), "delta-3")  # lost before its state was written
    last = store.advance(3, _moved(spark, [("k3", 902)]))
    assert rows_of(store.read(last), "k", "t") == sorted([*want, ("k3", 902)])
    empty = store.advance(4, _moved(spark, []))
    assert empty == last


def test_stream_loads_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    _write(source / "a.csv", "x\n1\n")
    for name in ("b.csv", "c.csv"):
        stream = marks.file_stream(spark, str(source), "x int", "csv", header="true")
        marks.load_new_files(stream, str(tmp_path / "s"), str(tmp_path / "out")).awaitTermination()
        _write(source / name, "x\n2\n")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_new_snapshots_and_directory_fold(spark, rows_of):
    listed = spark.createDataFrame([("d/x_20250301120000.csv",), ("d/x_20250205.csv",), ("d/x_20241231.csv",), ("d/x.csv",), ("d/y_20250401.txt",)], "path string")
    assert [r.path for r in changes.new_snapshots(listed, None, start="2025-02-01", earliest="2025-01-01").collect()] == ["d/x_20250205.csv", "d/x_20250301120000.csv"]
    cols = "Name string, HCID string, `Part of HCID` string, `QHIN HCID` string, FirstSeenDate string"
    day1 = spark.createDataFrame([("Top", "1", "urn/1", "1", "Not Applicable"), ("Kid", "2", "x/1", "9", "Not Applicable")], cols)
    day2 = spark.createDataFrame([("Kid", "2", "1", None, "old"), ("New", "3", "7", "2", "old")], cols)
    store = changes.directory_update(day1, day1.limit(0), "2025-02-05")
    assert rows_of(store, "HCID", "FirstSeenDate", "Part of HCID", "PartOfName", "QHIN_Name") == [
        ("1", "2025-02-05", "1", "Top", "Top"), ("2", "2025-02-05", "1", "Top", "NA")]
    folded = changes.fold_snapshots([("2025-03-01", day2)], store, lambda rows: store.unionByName(rows))
    assert rows_of(folded.filter("file_date = '2025-03-01'"), "HCID", "FirstSeenDate", "PartOfName", "QHIN_Name") == [
        ("2", "old", "NA", "NA"), ("3", "2025-03-01", "NA", "Kid")]


def test_ticket_score_errors_and_templates(spark, rows_of):
    df = spark.createDataFrame([("Critical - 8-9",), ("none",), (None,), ("High - x-y",)], "escalation_option string")
    out = tickets.ticket_priority(df)
    assert [(r.risk, r.impact, r.colour, r.parse_error) for r in out.collect()] == [
        ("Critical", 9, "crimson", False), ("", -1, "", False), ("", -1, "", False), (None, None, "", True)]
    support = spark.createDataFrame(
        [(5, "why", "C-1", "L-2", "desc", "long", "Legal", "me", "you@x", '[{"name":"my file.txt","link":"u"}]', "Low - 1-2")],
        "id int, ticket_reason string, project_ids string, ticket_reference_other_system string, data_extract_description string, "
        "ticket_reason_extended string, client_legal_name string, requestor_info string, behalf_of_email string, attachment string, escalation_option string")
    projects = spark.createDataFrame([("L-2", 7, 2), ("C-1", 4, 1), ("S-9", 1, 0)], "ProjectId string, Priority int, position int")
    reasons = spark.createDataFrame([("why", 3, "CAT", ["me"])], "text string, reason_id int, category string, subscribers array<string>")
    templates = spark.createDataFrame([("CAT", "See: {description}!")], "category string, template string")
    row = tickets.shape_tickets(support, projects, reasons, templates, "https://files/").first()
    assert row.priority == 4 and row.subscribed
    assert row.card_title == ("GID:SUP-5 why Client/Participant Name: ||||||Legal||| - Legal - L-2 - See: desc Description: long!... "
                              "- Requestor: me - On Behalf of: you@x")
    assert row.description.startswith("See: desc Description: long! | Link: https://files/my%20file.txt | <br>")


def test_find_card(spark, rows_of):
    boards = spark.sql("SELECT 'b' AS board, array(named_struct('cards', array(named_struct('id', 'x', 'checklists', array('1','2')), "
                       "named_struct('id', 'y', 'checklists', cast(array() as array<string>))))) AS swimlanes")
    assert rows_of(tickets.find_card(boards, "y")) == [("b", 0, "y")]
    assert tickets.flatten_boards(boards).count() == 2


def test_sync_and_routes(spark, rows_of):
    src = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("airflow_tmp_d", 9)], "path string, modified int")
    dst = spark.createDataFrame([("a", 5), ("b", 4)], "path string, modified int")
    assert rows_of(manifest.to_sync(src, dst), "path") == [("b",), ("c",)]
    paths = spark.createDataFrame([("hl7V2in/domainOid=1/root=2/extension=3/u",), ("a%2Fb%zz",), ("x/",)], "path string")
    out = [r.destination for r in manifest.route(paths).collect()]
    assert out[0] == "root=2_extension=3_u" and out[1] == "a%2Fb%zz" and out[2].startswith("unnamed_")


def test_packed_hl7v2_files_are_unpacked_and_bounded(spark, tmp_path):
    """Compressed files give the path, the name and the text of plain ones, in any character set."""
    import gzip

    text = "MSH|^~\\&|é\rPID|1\r"
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x+y.hl7.gz").write_bytes(gzip.compress(text.encode("ISO-8859-1")))
    (tmp_path / "a b" / "no.hl7").write_text("x")
    row = files.read_hl7v2(spark, str(tmp_path), glob="*.gz").collect()
    plain = files.read_hl7v2(spark, str(tmp_path), glob="*.hl7").first()
    assert [(r.name, r.value) for r in row] == [("x+y.hl7.gz", text)]
    assert row[0].file == plain.file.replace("no.hl7", "x+y.hl7.gz")
    texts = spark.range(3000).selectExpr("cast(id as string) AS file", "repeat('some text ', 40) AS value").coalesce(1)
    readers._packed_texts(texts, f"{tmp_path}/out", "gzip")
    assert sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.gz")) < 3000 * 400 / 4
    back = readers._unpacked_texts(files.read_hl7v2(spark, f"{tmp_path}/out", "UTF-8", "*.txt.gz"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, texts.collect()))
