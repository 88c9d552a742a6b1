"""Text and Parquet tables, stored configurations."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from veilframe import (
    LinkSpec,
    Policy,
    link,
    materialize,
    profile,
    pseudonymize,
    read_link_spec,
    read_policy,
    read_table,
    refused_records,
    scratch,
    stored,
    write_table,
)
from veilframe.sources.tables import shared_folder


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_headers_of_every_file_and_folder_are_left_out(spark, tmp_path):
    put(tmp_path / "t" / "0.csv", "Id,이름\n1,가\nId7,나\n")
    put(tmp_path / "t" / "1.csv", "Id,이름\n2,다\n")
    put(tmp_path / "t" / "more" / "deep" / "2.csv", "Id,이름\n3,라\n")
    put(tmp_path / "t" / "_SUCCESS", "")
    df = read_table(spark, str(tmp_path / "t"))
    assert df.columns == ["Id", "이름"]
    assert rows(df) == [("1", "가"), ("2", "다"), ("3", "라"), ("Id7", "나")]


def test_no_clear_row_escapes_treatment_when_files_are_split(spark, tmp_path):
    body = "".join(f"{i},secret{i}\n" for i in range(5000))
    for part in range(3):
        put(tmp_path / "t" / f"{part}.csv", "k,v\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_table(spark, str(tmp_path / "t"))
        assert df.rdd.getNumPartitions() > 10
        got = pseudonymize(df, Policy.from_dict({"v": ["Encryption"]}))
        assert got.count() == 15000
        assert got.filter(F.col("v").rlike("^[0-9a-f]{64}$")).count() == 15000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cells_are_raw_text(spark, tmp_path):
    put(tmp_path / "t.csv", 'a,b,c\n"x",back\\slash, spaced \n,,\nshort\n1,2,3\n\\"q\\,"",\'\n')
    got = rows(read_table(spark, str(tmp_path / "t.csv")))
    assert got == sorted(
        [('"x"', "back\\slash", " spaced "), ("", "", ""), ("short", "", ""), ("1", "2", "3"), ('\\"q\\', '""', "'")]
    )


def test_windows_line_ends_and_blank_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("a,b\r\n1,가\r\n\r\n2,\r\n".encode())
    df = read_table(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["a", "b"] and rows(df) == [("1", "가"), ("2", "")]


def test_round_trip_keeps_every_cell(spark, tmp_path):
    cells = [("", '"', 'say "hi"'), (" lead", "trail ", "\\"), ("가나", "'", "#c"), ("x", "\t", "-")]
    df = spark.createDataFrame(cells, "a string, b string, c string")
    write_table(df, str(tmp_path / "t"))
    assert rows(read_table(spark, str(tmp_path / "t"))) == sorted(cells)


def test_unquoted_text_refuses_cells_that_would_break_lines(spark, tmp_path):
    for i, cell in enumerate(("a,b", "a\nb", "a\rb")):
        df = spark.createDataFrame([(cell, "x")], "a string, b string")
        with pytest.raises(Exception, match="holds a line break"):
            write_table(df, str(tmp_path / f"refused{i}"))


def test_quoted_text(spark, tmp_path):
    cells = [("", " x"), ('"', ","), ("a,b", 'x "y"'), ("back\\", '\\"')]
    df = spark.createDataFrame(cells, "a string, b string")
    write_table(df, str(tmp_path / "t"), quote='"')
    assert rows(read_table(spark, str(tmp_path / "t"), quote='"')) == sorted(cells)
    with pytest.raises(Exception, match="holds a line break"):
        write_table(df.withColumn("b", F.lit("x\ny")), str(tmp_path / "u"), quote='"')


def test_files_with_another_header_are_refused(spark, tmp_path):
    put(tmp_path / "t" / "0.csv", "a,b\n1,2\n")
    put(tmp_path / "t" / "1.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path / "t")).collect()


@pytest.mark.parametrize("pruning", ["true", "false"])
def test_records_with_more_cells_than_the_header_are_refused(spark, tmp_path, pruning):
    put(tmp_path / "t.csv", "a,b\n1,2\n1,2,3\n")
    put(tmp_path / "q.csv", 'a,b\n"1,1",2\n"x, ""y""",2,""\n')
    put(tmp_path / "one.csv", "a\n1\n1,2\n")
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", pruning)
    try:
        for name, quote in (("t", ""), ("q", '"'), ("one", "")):
            df = read_table(spark, str(tmp_path / f"{name}.csv"), quote=quote)
            for result in (df, df.select("a"), df.groupBy().count()):
                with pytest.raises(Exception, match="more cells than the header"):
                    result.collect()
        put(tmp_path / "fine.csv", "a,b\n1\n,\n")
        fine = read_table(spark, str(tmp_path / "fine.csv"))
        assert rows(fine) == [("", ""), ("1", "")] and fine.count() == 2
    finally:
        spark.conf.unset("spark.sql.csv.parser.columnPruning.enabled")


def test_tables_of_one_column_keep_empty_cells(spark, tmp_path):
    cells = [("",), ("a",), ("",), ("  ",), ("cell",), ("cell",), ("",)]
    df = spark.createDataFrame(cells, "cell string").repartition(3)
    write_table(df, str(tmp_path / "t"))
    got = read_table(spark, str(tmp_path / "t"))
    assert rows(got) == sorted(cells) and got.columns == ["cell"]
    write_table(df.limit(0), str(tmp_path / "none"))
    assert read_table(spark, str(tmp_path / "none")).columns == ["cell"]
    assert read_table(spark, str(tmp_path / "none")).count() == 0
    put(tmp_path / "u" / "0.csv", "x\n1\n\n2\n")
    put(tmp_path / "u" / "1.csv", "x\n\nx\n")
    assert rows(read_table(spark, str(tmp_path / "u"))) == [("",), ("",), ("1",), ("2",), ("x",)]
    put(tmp_path / "u" / "2.csv", "y\n1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path / "u")).collect()


def test_what_a_block_stores_is_removed(spark):
    with stored(spark.range(5)) as df:
        files = df.inputFiles()
        assert df.count() == 5
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_given_schema_and_parquet(spark, tmp_path):
    put(tmp_path / "t.csv", "a,b\n1,\n2,y\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    df = read_table(spark, str(tmp_path / "t.csv"), schema=schema)
    assert rows(df) == [(1, ""), (2, "y")]
    write_table(df, str(tmp_path / "p" / "sub"), format="parquet")
    got = read_table(spark, str(tmp_path / "p"), format="parquet", recursive=True)
    assert rows(got) == [(1, ""), (2, "y")]


def test_partitioned_parquet_keeps_its_partition_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    df.write.partitionBy("b").parquet(str(tmp_path / "p"))
    assert rows(read_table(spark, str(tmp_path / "p"), format="parquet")) == [(1, "x"), (2, "y")]


def test_existing_output_is_not_overwritten(spark, tmp_path):
    write_table(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_table(spark.range(1), str(tmp_path / "t"))


def test_empty_keys_of_text_tables_match(spark, tmp_path):
    put(tmp_path / "a" / "0.csv", "k,v\n,1\nx,2\n")
    put(tmp_path / "b" / "0.csv", "k,w\n,3\ny,4\n")
    a, b = read_table(spark, str(tmp_path / "a")), read_table(spark, str(tmp_path / "b"))
    got = link(a, b, LinkSpec(["k"], ["k"], ["v"], ["w"]))
    write_table(got, str(tmp_path / "out"), header=False)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text == "1,3\n"


def test_stored_configurations(spark, tmp_path):
    put(tmp_path / "policy.json", '{\n "혈액형": ["Encryption"],\n "v": ["Round", "R", 2]\n}')
    put(tmp_path / "link.json", '{"join_key": {"A": ["k"], "B": ["k"]},\n "column_list": {"A": ["v"], "B": ["w"]}}')
    assert read_policy(spark, str(tmp_path / "policy.json")).columns == ["혈액형", "v"]
    assert read_link_spec(spark, str(tmp_path / "link.json")) == LinkSpec(["k"], ["k"], ["v"], ["w"])


def test_statistics_sink(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    write_table(profile(df, Policy.from_dict({"x": ["TopBottom"]})), str(tmp_path / "s"))
    assert rows(read_table(spark, str(tmp_path / "s"))) == [("x", "Avg", "", "2.0"), ("x", "Sd", "", "1.0")]


def test_materialize_writes_to_the_shared_folder(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert rows(df) == [(i, 2 * i) for i in range(10)]
    assert all(shared_folder(spark) in f for f in df.inputFiles())


def test_refused_records_have_exact_lines_in_files_of_many_blocks(spark, tmp_path):
    wanted, folder = set(), tmp_path / "t"
    for name in ("a.csv", "sub/b.csv"):
        lines = ["id,x"] + [f"{i},{'y' * (i % 50)}" + (",more" if i % 97 == 0 else "") for i in range(5000)]
        lines[10] = lines[2000] = ""
        wanted |= {(name, i + 1, line) for i, line in enumerate(lines) if line.count(",") > 1}
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        observed = Observation()
        assert read_table(spark, str(folder), refused=observed).count() == 2 * 4998 - len(wanted)
        assert observed.get == {"records": len(wanted)}
        found = refused_records(spark, str(folder))
        got = {(r.file.split("/t/")[1], r.line, r.record) for r in found.collect()}
        assert got == wanted and found.count() == len(wanted)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_refused_records_of_quoted_tables_and_of_one_column(spark, tmp_path):
    put = tmp_path / "q"
    put.mkdir()
    (put / "0.csv").write_text('id,x\n1,"a,b"\n2,"a,b",c\n')
    assert read_table(spark, str(put), quote='"', refused=Observation()).count() == 1
    assert [(r.line, r.record) for r in refused_records(spark, str(put), quote='"').collect()] == [(3, '2,"a,b",c')]
    one = tmp_path / "one"
    one.mkdir()
    (one / "0.csv").write_text("id\n1\n\n2,3\n")
    observed = Observation()
    assert [r.id for r in read_table(spark, str(one), refused=observed).collect()] == ["1", ""]
    assert observed.get == {"records": 1}
    assert [(r.line, r.record) for r in refused_records(spark, str(one)).collect()] == [(4, "2,3")]


def test_scratch_removes_what_was_stored_but_for_what_is_kept(spark):
    folder, df = shared_folder(spark), spark.range(3)
    before = set(os.listdir(folder))
    with scratch(spark):
        with scratch(spark):
            inner, kept = materialize(df), materialize(df, keep=True)
            assert inner.count() == 3 and len(set(os.listdir(folder)) - before) == 2
        assert kept.count() == 3 and len(set(os.listdir(folder)) - before) == 1
        with pytest.raises(ZeroDivisionError):
            with stored(df) as table:
                table.select(1 / 0)
    assert set(os.listdir(folder)) == before
    outside = materialize(df, keep=True)
    assert outside.count() == 3 and len(set(os.listdir(folder)) - before) == 1
