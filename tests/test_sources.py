import gzip
import io
import random
import time

import pytest
from pyspark.sql import functions as F
from waybill.sources import as_text, clear_staged, drop_staged, preview, read_extract, stage, staging_root
from waybill.sources import extracts, heads, staging


def write(tmp_path, text, name="x.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return [tuple(r)[:-1] for r in df.orderBy("_ix").collect()]


def test_quotes_and_commas(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, 'key,note\n77,"left, then right"\n78,straight'))
    assert df.columns == ["key", "note", "_ix"]
    assert rows(df) == [("77", "left, then right"), ("78", "straight")]


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, 'p,q\n"a ""quoted"" word","first\nsecond\nthird"\n'))
    assert rows(df) == [('a "quoted" word', "first\nsecond\nthird")]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_ends_blank_lines_and_trailing_newline(spark, tmp_path, end):
    df = read_extract(spark, write(tmp_path, end.join(["a,b", "1,2", "", "3,4", ""])))
    assert rows(df) == [("1", "2"), ("3", "4")]


def test_short_long_and_blank_fields(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, "a,b,c\n1\n1,2,3,4\n,,\n"))
    assert rows(df) == [("1", "", ""), ("1", "2", "3"), ("", "", "")]


def test_trimming_of_values_and_headings(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, '﻿ a ," b"\n" x ",\ty \n'))
    assert df.columns[:2] == ["a", "b"]
    assert rows(df) == [("x", "y")]


def test_same_heading_twice_last_counts(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, "a,b,a\n1,2,3\n"))
    assert df.columns == ["a", "b", "_ix"]
    assert rows(df) == [("3", "2")]


def test_headings_differing_by_case_or_with_dots(spark, tmp_path):
    df = read_extract(spark, write(tmp_path, "State,state,x.y\n1,2,3\n"))
    assert df.columns[:3] == ["State", "state", "x.y"]
    assert rows(df) == [("1", "2", "3")]


def test_no_columns_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_extract(spark, write(tmp_path, "\n\n"))


def test_every_file_has_its_own_header(spark, tmp_path):
    write(tmp_path, "id,city,cost\n1,Boise,5\n", "a.csv")
    write(tmp_path, '\n"cost" , id ,city,extra\n9,4,"Day\nton",zz\n', "b.csv")
    write(tmp_path, "", "empty.csv")
    write(tmp_path, "id,city,cost\n2,Omaha,\n", "c [1] %20.csv")
    df = read_extract(spark, str(tmp_path))
    got = {tuple(r[c] for c in ("id", "city", "cost", "extra")) for r in df.collect()}
    assert got == {("1", "Boise", "5", ""), ("4", "Day\nton", "9", "zz"), ("2", "Omaha", "", "")}
    assert df.select("_ix").distinct().count() == 3


def test_row_order_of_a_split_file(spark, tmp_path):
    n = 5000
    path = write(tmp_path, "k,v\n" + "".join(f"{i},{'x' * 40}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_extract(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 1
        assert [int(r[0]) for r in rows(df)] == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_file_with_line_breaks_in_quotes_is_split(spark, tmp_path):
    """Read in many tasks, the file gives what it gives in one."""
    rng = random.Random(9)
    values = ["plain", '"two\nlines"', '"a ""b""\n\n,c"', '""', "", '"x, y"', '"' + "long\n" * 300 + '"']
    body = "".join(f"{i},{rng.choice(values)},{rng.choice(values)}\n" for i in range(3000))
    path = write(tmp_path, "\nk,v,w\n" + body)
    whole = sorted(rows(read_extract(spark, path)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        df = read_extract(spark, path, multi_line="split")
        assert sorted(rows(df)) == whole and len(whole) == 3000
        assert [int(r[0]) for r in rows(df)] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_preview_is_the_first_rows(spark, tmp_path):
    path = write(tmp_path, "k\n" + "".join(f"{i}\n" for i in range(20)))
    assert [r.k for r in preview(read_extract(spark, path)).collect()] == [
        str(i) for i in range(8)
    ]


def test_as_text_of_typed_table(spark):
    df = as_text(spark.sql("select 1 a, cast(null as double) b, date'2020-01-02' c, true d"))
    assert rows(df) == [("1", "", "2020-01-02", "true")]


def test_staged_table_is_read_back_from_the_shared_folder(spark):
    df = stage(spark.range(10), "t")
    assert df.count() == 10
    assert staging_root(spark) in df.inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir") in staging_root(spark)


class FakeSession:
    """A session whose checkpoint folder is not set."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        applicationId = "app-1"
        master = "local[2]"

        @staticmethod
        def getCheckpointDir():
            return None


def test_without_a_shared_folder_only_local_sessions_stage(monkeypatch):
    session = FakeSession()
    assert staging_root(session) == staging_root(session)
    monkeypatch.setattr(FakeSession.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(session)


def test_one_staged_table_can_be_dropped(spark):
    gone, kept = stage(spark.range(3), "t"), stage(spark.range(4), "t")
    drop_staged(gone)
    assert kept.count() == 4
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        gone.collect()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    counts = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert counts.count() == 7


def test_clearing_staged_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda s: str(tmp_path / "mine"))
    stage(spark.range(3), "t")
    assert list((tmp_path / "mine").iterdir())
    clear_staged(spark)
    assert not (tmp_path / "mine").exists()


def head(data, chunks=None):
    """First record of some bytes, and how many of them were read."""
    stream = io.BytesIO(data)
    fields = heads.first_record(stream.read)
    return fields, stream.tell()


def test_heads_are_read_and_no_more():
    rest = b"1,2\n" * 1_000_000
    assert head(b"a,b\n" + rest) == (["a", "b"], heads.CHUNK)
    assert head(b"\n  \r\n\xef\xbb\xbf".replace(b"\xef\xbb\xbf", b"") + b'"x ""y""",z \r' + rest)[0] == ['x "y"', "z "]
    assert head(b"\xef\xbb\xbf a,b\r\n1,2")[0] == ["a", "b"]
    assert head(b'"two\nlines",b\n' + rest)[0] == ["two\nlines", "b"]
    assert head(b'a"b,c\n' + rest)[0] == ['a"b', "c"]
    long = b",".join(b"column%d" % i for i in range(20_000)) + b"\n"
    fields, read = head(long + rest)
    assert len(fields) == 20_000 and read <= len(long) + heads.CHUNK
    assert head(b"") == ([], 0) and head(b"\n \n")[0] == []
    assert head(b'"never closed' + rest)[1] <= heads.HEAD_BYTES


def test_many_files_are_not_read_for_their_headers(spark, tmp_path, monkeypatch):
    """Three kinds of headers in 40 files; compressed ones too."""
    for i in range(40):
        body = f"k{i % 3},v\n" + f"{i},x\n" * 3
        if i % 5:
            write(tmp_path, body, f"f{i:02d}.csv")
        else:
            (tmp_path / f"f{i:02d}.csv.gz").write_bytes(gzip.compress(body.encode()))
    found = extracts._headers(spark, str(tmp_path))
    assert {names: len(files) for names, files in found.items()} == {
        (f"k{i}", "v"): len(range(i, 40, 3)) for i in range(3)
    }
    df = read_extract(spark, str(tmp_path))
    assert df.count() == 120 and df.select("_ix").distinct().count() == 120


def test_split_rows_are_numbered_where_they_are(spark, tmp_path):
    """No sort of all rows: places follow file, block and line over several files and headers."""
    for name, lead in (("a.csv", "k,v\n"), ("b.csv", "k,v\n"), ("c.csv", "v,k\n")):
        rows = [f'{name}{i:05d},"t\n{i}"\n' if i % 7 == 0 else f"{name}{i:05d},{'x' * 30}\n" for i in range(2000)]
        if lead == "v,k\n":
            rows = [",".join(reversed(r[:-1].split(",", 1))) + "\n" for r in rows]
        write(tmp_path, lead + "".join(rows), name)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = read_extract(spark, str(tmp_path), multi_line="split")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan.lower()
        got = [r.k for r in df.orderBy("_ix").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{n}{i:05d}" for n in ("a.csv", "b.csv", "c.csv") for i in range(2000)]
