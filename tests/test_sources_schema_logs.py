"""Sources, sinks, file checks, schema checks and run logs on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sievekit.operators import runlog as L
from sievekit.operators import schema as C
from sievekit.sources import delimited as S
from sievekit.sources import files as FL
from sievekit.sources import jsondoc, sinks, tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_delimited_sources(spark, tmp_dir):
    _write(f"{tmp_dir}/a.tsv", "id\tname\n1\tx\n2\t\n")
    df = S.read_delimited(spark, f"{tmp_dir}/a.tsv")
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert df.count() == 2
    _write(f"{tmp_dir}/c/r1.txt", "# comment line\nacc\tstatus\nA1\tlive\nA2\tsuppressed\n")
    _write(f"{tmp_dir}/c/r2.txt", "# another comment\nacc\tstatus\nB1\tlive\n")
    rep = S.read_delimited_after_comment(spark, f"{tmp_dir}/c")
    assert rep.columns == ["acc", "status"]
    assert sorted(r.acc for r in rep.collect()) == ["A1", "A2", "B1"]
    _write(f"{tmp_dir}/ids.txt", " g1 \n\ng2\n")
    assert [r.id for r in S.read_id_list(spark, f"{tmp_dir}/ids.txt").collect()] == ["g1", "g2"]


def test_file_checks(spark, tmp_dir):
    _write(f"{tmp_dir}/f/ok.tsv", "a\tb\n1\t2\n")
    _write(f"{tmp_dir}/f/bad.tsv", "a,b\n1,2\n3\t4\n")
    chk = FL.manifest_check(spark, [{"file_path": f"{tmp_dir}/f/ok.tsv"}, {"file_path": f"{tmp_dir}/f/none.tsv"},
                                    {"file_path": f"{tmp_dir}/nodir/x.tsv"}])
    assert [r.status for r in chk.orderBy("idx").collect()] == ["found", "not_found", "not_found"]
    d = {os.path.basename(r.file_path): r for r in FL.delimiter_check(spark, f"{tmp_dir}/f", "\t", 5).collect()}
    assert d["ok.tsv"].is_valid and not d["bad.tsv"].is_valid
    assert [x.line_number for x in d["bad.tsv"].invalid_lines] == [1, 2]
    d2 = {os.path.basename(r.file_path): r for r in FL.delimiter_check(spark, f"{tmp_dir}/f", "\t", 5, True).collect()}
    assert d2["bad.tsv"].checked_lines == 2


def test_member_file_resolution(spark, tmp_dir):
    root = f"{tmp_dir}/clades"
    _write(f"{root}/c1/GCF_000001.1_ASM1_protein.faa.gz", "x")
    _write(f"{root}/c1/GCF_000002.1_ASM2_protein.faa.gz", "x")
    _write(f"{root}/c1/GCF_000002.1_ASM2b_protein.faa.gz", "x")
    members = spark.createDataFrame([("c1", "GCF_000001.1"), ("c1", "GCF_000002.1"), ("c1", "GCF_000003.1")],
                                    "group string, member string")
    res = {r.member: r.status for r in FL.resolve_member_files(spark, members, root).collect()}
    assert res == {"GCF_000001.1": "ok", "GCF_000002.1": "many", "GCF_000003.1": "none"}


def test_sinks_and_tables(spark, tmp_dir):
    df = spark.range(5).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    sinks.write_table(df, f"{tmp_dir}/t")
    assert tables.path_table(spark, f"{tmp_dir}/t").count() == 5
    assert tables.sql_count(spark, f"{tmp_dir}/t").first().n_rows == 5
    sinks.write_name_list(df, "name", f"{tmp_dir}/names")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/names").collect())[:2] == ["n0", "n1"]
    staged = sinks.stage_table(df, "unit")
    assert staged.count() == 5


def test_keyed_document(spark, tmp_dir):
    doc = {"clusterA": {"genome": ["g1", "g2"], "aa": "MKV", "aux_genome": {"g3": 1}}, "clusterB": {"genome": []}}
    _write(f"{tmp_dir}/j/doc.json", json.dumps(doc, indent=2))
    rows = {r.key: r for r in jsondoc.read_keyed_document(spark, f"{tmp_dir}/j").collect()}
    assert json.loads(rows["clusterA"].genome) == ["g1", "g2"] and rows["clusterB"].aa is None


def test_schema_checks(spark, tmp_dir):
    _write(f"{tmp_dir}/s/out.tsv", "# generated\ngenome_id\tgtdb_taxonomy_id\textra\n1\t2\t3\n")
    schema = "classes:\n  genome:\n    slots:\n      - genome_id\n      - gtdb_taxonomy_id\n      - ncbi_biosample_id\n"
    res = C.file_schema_check(spark, f"{tmp_dir}/s/out.tsv", schema, "genomes.genome", ignore_first_line=True)
    assert res["missing_in_file"] == ["ncbi_biosample_id"] and res["extra_in_file"] == ["extra"]
    bad = C.file_schema_check(spark, f"{tmp_dir}/s/out.tsv", schema, "genomes.nothere", ignore_first_line=True)
    assert "error" in bad
    cfg = spark.createDataFrame([("genome", json.dumps({
        "validations": [{"column": "genome_id"}, {"column": "nope"}],
        "great_expectations_validations": [{"params": {"column": "also_nope"}}],
        "transformations": [{"column_name": "genome_id"}]}))], "config string, json string")
    cols = spark.createDataFrame([(c,) for c in C.schema_slots(schema, "genome")], "column string")
    missing = {(r.section, r.column) for r in C.config_columns_not_in_schema(cfg, cols).collect()}
    assert missing == {("validations", "nope"), ("great_expectations_validations", "also_nope")}


def test_run_logs_from_files(spark, tmp_dir):
    lines = [
        json.dumps({"time": "2025-07-10 05:29:06,123", "pipeline": "p", "schema": "s", "table": "t",
                    "level": "INFO", "module": "m", "msg": "ok"}),
        '{"time": "2025-07-10 05:30:00,000", "pipeline": "p", "schema": "s", "table": "t", "level": "ERROR", '
        '"module": "m", "msg": "raw\ttab \U0001F6A8 and \\"quote\\""}',
        "Traceback (most recent call last):",
        json.dumps({"time": "not a time", "pipeline": "p", "schema": "s", "table": "t", "level": "INFO",
                    "module": "m", "msg": "x"}),
    ]
    _write(f"{tmp_dir}/logs/pipeline_run_1.log", "\n".join(lines) + "\n")
    parsed = L.read_run_logs(spark, f"{tmp_dir}/logs")
    bad = L.bad_line_report(parsed).first()
    assert (bad.n_lines, bad.n_bad) == (4, 1)
    view = L.log_view(L.filter_logs(parsed, level="ERROR", start="2025-07-10", end="2025-07-10")).collect()
    assert len(view) == 1 and "\t" in view[0].msg and "\U0001F6A8" in view[0].msg
    assert L.filter_logs(parsed).count() == 2  # the line without a parseable time drops out
    opts = {(r.field, r.value) for r in L.option_values(parsed).collect()}
    assert ("level", "ERROR") in opts and ("level", "INFO") in opts


def test_first_lines_with_many_splits(spark, tmp_dir):
    """Files larger than a split: the header is still each file's first line."""
    body = "".join(f"{i}\tname{i}\n" for i in range(3000))
    _write(f"{tmp_dir}/big/one.tsv", "# comment one\nid\tname\n" + body)
    _write(f"{tmp_dir}/big/two.tsv", "# comment two\nid\tname\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(f"{tmp_dir}/big").rdd.getNumPartitions() > 4
        heads = {(os.path.basename(r.file_path), r.line_number): r.value
                 for r in S.first_lines(spark, f"{tmp_dir}/big", 2).collect()}
        assert heads[("one.tsv", 1)] == "# comment one" and heads[("two.tsv", 2)] == "id\tname"
        df = S.read_delimited_after_comment(spark, f"{tmp_dir}/big")
        assert df.columns == ["id", "name"] and df.count() == 6000
        assert df.filter(F.col("id").startswith("#") | (F.col("id") == "id")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_numbers_across_splits(spark, tmp_dir):
    from sievekit.operators import rules as R

    rows = "".join(f"g{i}\t{i % 150}\n" for i in range(4000))
    _write(f"{tmp_dir}/num/a.tsv", "genome_id\tscore\n" + rows)
    _write(f"{tmp_dir}/num/b.tsv", "genome_id\tscore\n" + rows[: len(rows) // 2])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        numbered = S.number_lines(spark, f"{tmp_dir}/num")
        got = {(os.path.basename(r.file_path), r.line_number): r.value for r in numbered.collect()}
        for name, text in (("a.tsv", "genome_id\tscore\n" + rows), ("b.tsv", "genome_id\tscore\n" + rows[: len(rows) // 2])):
            expect = {(name, i + 1): line for i, line in enumerate(text.splitlines())}
            assert {k: v for k, v in got.items() if k[0] == name} == expect
        df = S.read_delimited_numbered(spark, f"{tmp_dir}/num")
        rules = [{"column": "score", "validation_type": "numeric_range", "max": 100}]
        v = R.violation_rows(df, rules, ["file_path", "line_number"]).filter(F.col("file_path").endswith("a.tsv"))
        lines = sorted(r.line_number for r in v.collect())
        assert lines == [i + 2 for i in range(4000) if i % 150 > 100]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_input_checks_and_comment(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.tsv", "x\ty\n1\t2\n")
    _write(f"{tmp_dir}/in/b.csv", "x,y\n1,2\n")
    inputs = [{"file_path": f"{tmp_dir}/in/a.tsv", "file_type": "tsv", "delimiter": "\t", "ignore_first_line": "no"},
              {"file_path": f"{tmp_dir}/in/b.csv", "file_type": "csv", "delimiter": ",", "ignore_first_line": "no"}]
    res = {r.idx: r.status for r in FL.input_format_checks(spark, inputs).collect()}
    assert res == {0: "valid", 1: "skipped"}
    chk = {r.idx: (r.status, r.error) for r in FL.manifest_check(spark, inputs).collect()}
    assert chk[0] == ("found", None) and chk[1] == ("found", None)
    _write(f"{tmp_dir}/cm/c.tsv", "# note\nid\tv\n1\t2\n")
    df = S.read_delimited(spark, f"{tmp_dir}/cm/c.tsv", comment="#")
    assert df.columns == ["id", "v"] and df.count() == 1


# ---------------------------------------------------------------- heads, numbering, settings

def test_numbering_survives_another_split_layout(spark, tmp_dir):
    from pathlib import Path

    from sievekit.sources.delimited import number_lines, read_delimited_numbered, short_rows

    path = Path(tmp_dir) / "big.tsv"
    n = 20_000
    path.write_text("a\tb\n" + "".join(f"{i}\tvalue {i}\n" if i % 1000 else f"{i}\n" for i in range(n)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = number_lines(spark, str(path))
        rows = read_delimited_numbered(spark, str(path))
        short = short_rows(spark, str(path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700000")
        assert sorted(r["line_number"] for r in lines.collect()) == list(range(1, n + 2))
        assert {(int(r["a"]), r["line_number"]) for r in rows.collect()} == {(i, i + 2) for i in range(n)}
        assert {r["line_number"] for r in short.collect()} == {i + 2 for i in range(0, n, 1000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_other_headers_keep_their_own(spark, tmp_dir):
    from pathlib import Path

    from sievekit.sources.delimited import read_delimited, read_delimited_after_comment, read_delimited_numbered

    for name, text in (("1.tsv", "a\tb\n1\t2\n"), ("2.tsv", "b\ta\n2\t1\n"), ("3.tsv", "a\tb\tc\n1\t2\t3\n")):
        (Path(tmp_dir) / name).write_text(text)
    rows = read_delimited(spark, tmp_dir).collect()
    assert sorted((r["a"], r["b"], r["c"] or "") for r in rows) == [("1", "2", ""), ("1", "2", ""), ("1", "2", "3")]
    assert {(r["a"], r["line_number"]) for r in read_delimited_numbered(spark, tmp_dir).collect()} == {("1", 2)}
    assert {(r["a"], r["b"]) for r in read_delimited_after_comment(spark, tmp_dir, skip=0).collect()} == {("1", "2")}


def test_heads_are_bounded_reads(spark, tmp_dir):
    from pathlib import Path

    from sievekit.sources.delimited import first_lines

    for k in range(3):
        (Path(tmp_dir) / f"{k}.txt").write_text("".join(f"line {i}\n" for i in range(50_000)))
    got = first_lines(spark, tmp_dir, 5).collect()
    assert len(got) == 15 and {(r["line_number"], r["value"]) for r in got} == {(i, f"line {i - 1}") for i in range(1, 6)}


def test_byte_settings():
    from sievekit.functions.sizing import parse_bytes

    assert [parse_bytes(x) for x in ("1MB", "1k", "10485760", "-1", "64m", " 2 GB ", "10b")] == [
        1 << 20, 1024, 10485760, -1, 64 << 20, 2 << 30, 10]
    assert parse_bytes("many") is None and parse_bytes("1x") is None


def test_small_side_follows_the_setting(spark):
    from sievekit.functions.sizing import is_small

    df = spark.range(100_000)
    try:
        for value, small in (("1MB", True), ("1k", False), ("-1", False), ("700k", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert is_small(df) is small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stage_folders(spark, tmp_dir):
    from types import SimpleNamespace

    from sievekit.session import CHECKPOINT_CONF, _stages, ensure_checkpoint_dir, stage_table

    base = ensure_checkpoint_dir(spark)
    staged = stage_table(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].split("/stages/")[1].startswith(spark.sparkContext.applicationId)
    assert _stages(spark, base).endswith(spark.sparkContext.applicationId)
    # without a shared folder, a cluster is refused
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match=CHECKPOINT_CONF):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))


def test_stages_of_an_application_can_be_removed(spark, tmp_dir):
    from pathlib import Path

    from sievekit import session

    other = Path(tmp_dir) / "stages" / "another-application"
    other.mkdir(parents=True)
    own = Path(tmp_dir) / "stages" / spark.sparkContext.applicationId / "x"
    own.mkdir(parents=True)
    kept = session.ensure_checkpoint_dir
    try:
        session.ensure_checkpoint_dir = lambda _: str(tmp_dir)
        assert session.remove_stages(spark) and not own.exists() and other.exists()
        assert not session.remove_stages(spark)
    finally:
        session.ensure_checkpoint_dir = kept


# ---------------------------------------------------------------- publishing

def _failing(df):
    return df.withColumn("name", F.when(F.col("id") < 3, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))


def test_a_failing_write_leaves_the_old_rows(spark, tmp_dir):
    df = spark.range(5).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    for table in (None, "published_rows"):
        path = f"{tmp_dir}/p{table}"
        old = lambda: spark.table(table) if table else spark.read.parquet(path)
        sinks.write_table(df, path, table=table)
        with pytest.raises(Exception, match="lost"):
            sinks.write_table(_failing(df), path, table=table)
        assert old().count() == 5
        sinks.write_table(df.filter("id > 3"), path, table=table)
        assert [r.id for r in old().collect()] == [4]
        sinks.write_table(df.limit(0), path, table=table)  # an empty result replaces old rows
        assert old().count() == 0 and old().columns == ["id", "name"]
        sinks.write_table(df, path, table=table, mode="append")
        assert old().count() == 5
        leftovers = [p for p in os.listdir(tmp_dir) if p.startswith("_")]
        assert leftovers == []
    spark.sql("DROP TABLE published_rows")


def test_columns_of_old_and_new_rows_are_merged(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "id int, gone string")
    b = spark.createDataFrame([(2.5, 2)], "added double, id int")
    for table in (None, "merged_rows"):
        path = f"{tmp_dir}/m{table}"
        sinks.write_table(a, path, table=table)
        where = sinks.write_table(b, path, table=table)
        rows = spark.table(table) if table else spark.read.parquet(path)
        assert rows.columns == ["id", "gone", "added"] and [tuple(r) for r in rows.collect()] == [(2, None, 2.5)]
        with pytest.raises(sinks.SchemaConflict):
            sinks.write_table(spark.createDataFrame([("1",)], "id string"), path, table=table)
        assert spark.read.parquet(where).count() == 1
        plain = sinks.write_table(b, f"{path}-plain", merge_schema=False)
        assert spark.read.parquet(plain).columns == ["added", "id"]
    spark.sql("DROP TABLE merged_rows")


def test_rows_left_aside_by_a_dead_write_come_back(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.write_table(spark.range(3), path)
    os.rename(path, f"{tmp_dir}/_t.before")  # died between the two renames
    assert sinks.restore(spark, path) and spark.read.parquet(path).count() == 3
    assert not sinks.restore(spark, path)
    sinks.write_table(spark.read.parquet(path).filter("id > 0"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2


def test_names_are_quoted(spark, tmp_dir):
    folder = f"{tmp_dir}/it's here"
    sinks.write_table(spark.range(2), folder, table="default.1st_rows")
    assert spark.table("default.`1st_rows`").count() == 2
    spark.sql("DROP TABLE default.`1st_rows`")


def test_manifest_of_double_missing_and_unreadable_entries(spark, tmp_dir):
    _write(f"{tmp_dir}/m/a b%.tsv", "x")
    os.makedirs(f"{tmp_dir}/m/folder")
    listed = [(1, f"{tmp_dir}/m/a b%.tsv"), (2, f"{tmp_dir}/m/a b%.tsv"), (3, f"{tmp_dir}/m/none"), (4, f"{tmp_dir}/m/folder"),
              (5, f"{tmp_dir}/m/a b%.tsv/under"), (6, None)]
    got = {r.idx: r for r in FL.manifest_check(spark, spark.createDataFrame(listed, "idx int, file_path string")).collect()}
    assert [got[i].status for i in range(1, 7)] == ["found", "found", "not_found", "error", "error", "not_found"]
    assert got[1].length == 1 and got[4].error and got[3].error is None


# ---------------------------------------------------------------- schema history

def test_schema_history_and_drift_by_runs(spark):
    def snapshot(*rows):
        return spark.createDataFrame(list(rows), "table string, column string, type string")

    runs = {1: snapshot(("t", "a", "int"), ("t", "b", "int"), (None, "x", "int"), ("t", None, "int")),
            2: snapshot(("t", "a", "long"), ("t", "c", "int"), ("u", "a", "int"), ("u", "a", "double")),
            3: snapshot(("t", "a", "long"), ("t", "b", "int")),
            4: snapshot()}
    history = spark.createDataFrame([], C.HISTORY)
    log = None
    for run in (1, 2, 2, 1, 3, 4):  # repeated and late runs change nothing
        history = sinks.stage_table(C.schema_history(history, runs[run], run), "history")
        drift = C.drift_of_run(history, run)
        log = C.drift_log(drift).withColumn("run_id", F.lit(run).cast("long")) if log is None else log.unionByName(C.append_drift(log, drift, run))
        log = sinks.stage_table(log, "log")
    assert {tuple(r) for r in history.collect()} == {
        ("t", "a", "int", 1, 2), ("t", "a", "long", 2, 4), ("t", "b", "int", 1, 2), ("t", "b", "int", 3, 4), ("t", "c", "int", 2, 3), ("u", "a", "double", 2, 3)}
    assert {(r.run_id, r.table, r.column, r.kind) for r in log.collect()} == {
        (2, "t", "a", "retyped"), (2, "t", "b", "removed"), (2, "t", "c", "added"), (3, "t", "b", "returned"), (3, "t", "c", "removed"),
        (3, "u", "a", "removed"), (4, "t", "a", "removed"), (4, "t", "b", "removed")}
    assert log.count() == 8
