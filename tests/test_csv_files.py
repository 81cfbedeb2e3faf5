import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.schemas import CUSTOMERS
from starloom.sources import csv_files

ABC = ("a", "b", "c")


@pytest.fixture
def folder(tmp_path):
    def write(*contents):
        for i, content in enumerate(contents):
            (tmp_path / f"part{i}_dataset.csv").write_bytes(content.encode())
        return str(tmp_path)

    return write


@pytest.fixture(params=["whole", "split"])
def reading(request, spark):
    """Both ways of reading; one byte per split makes every file a large one."""
    if request.param == "split":
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")


def rows(spark, path, columns=ABC):
    return sorted(
        (tuple(r) for r in csv_files.read_csv(spark, path, columns).collect()), key=str
    )


def test_plain(spark, folder, reading):
    assert rows(spark, folder("a,b,c\n1,2,3\n4,5,6\n")) == [("1", "2", "3"), ("4", "5", "6")]


def test_everything_stays_text(spark, folder, reading):
    assert rows(spark, folder("a,b,c\n01234,1.50,true\n")) == [("01234", "1.50", "true")]


def test_columns_by_name_in_declared_order(spark, folder, reading):
    assert rows(spark, folder("c,x,b,a\n3,9,2,1\n")) == [("1", "2", "3")]


def test_missing_markers(spark, folder, reading):
    lines = "".join(f'{i},{m},"{m}"\n' for i, m in enumerate(csv_files.MISSING_MARKERS))
    found = rows(spark, folder("a,b,c\n" + lines))
    assert len(found) == 19
    assert all(b is None and c is None for _, b, c in found)


def test_blanks_and_other_words_are_no_markers(spark, folder, reading):
    assert rows(spark, folder('a,b,c\n"  ", NA,nil\n')) == [("  ", " NA", "nil")]


def test_quotes_and_line_ends(spark, folder, reading):
    text = 'a,b,c\n1,"a ""b"", c","l1\nl2"\n2,"l1\r\nl2","x"\n3,"",""""\n'
    assert rows(spark, folder(text)) == [
        ("1", 'a "b", c', "l1\nl2"),
        ("2", "l1\r\nl2", "x"),
        ("3", None, '"'),
    ]


def test_what_is_in_a_file_decides_how_it_is_read(spark, folder):
    path = folder('a,b,c\n1,"x, ""y""",\n"2",,"z"\n', 'a,b,c\n1,5" x,"abc\ndef",5" y\n')
    # Quote counts per line are even in the second file, yet a record runs over the line end.
    assert [f.plain for f in csv_files._scan(spark, path)] == [True, False]


def test_quotes_without_line_ends(spark, folder, reading):
    path = folder('a,b,c\n1,"x, ""y""",\n"2",,"z"\n')
    assert rows(spark, path) == [("1", 'x, "y"', None), ("2", None, "z")]


# A record with a line end in quotes, for the other way of reading.
WOVEN = '0,"p\nq",0\n'


@pytest.mark.parametrize("woven", ["", WOVEN])
@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a,b,c\n1,x\ry,3\n", [("1", "x", None), ("y", "3", None)]),
        ("a,b,c\n1,2,3\n   \n4,5,6\n", [("1", "2", "3"), ("4", "5", "6")]),
        ("a,b,c\n1,2,3\r\n4,5,6\r\n", [("1", "2", "3"), ("4", "5", "6")]),
        ("a,b,c\r\n1,2,3\n4,5,6\n", [("1", "2", "3"), ("4", "5", "6")]),
        ("a,b,c\r1,2,3\r4,5,6\r", [("1", "2", "3"), ("4", "5", "6")]),
    ],
)
def test_line_ends(spark, folder, reading, text, expected, woven):
    found = rows(spark, folder(text + woven))
    assert found == sorted([*expected, *([("0", "p\nq", "0")] if woven else [])], key=str)


def test_same_rows_as_pandas(spark, folder, reading):
    """Line ends of all kinds, inside quotes and outside, with text after closing quotes."""
    pandas = pytest.importorskip("pandas")
    text = 'a,b,c\r\n1,"x\ry",3\n\n  \n4,"p\r\n\n q""",6\r7,"8\n9","\n"\r\n"z,\n",y"u,w\n'
    path = folder(text)
    frame = pandas.read_csv(f"{path}/part0_dataset.csv", dtype=str)
    expected = sorted((tuple(None if x != x else x for x in r) for r in frame.itertuples(index=False)), key=str)
    assert rows(spark, path) == expected


@pytest.mark.parametrize("content", [b"a,b,c\n1,\xff2,3\n", b"a,b,c\n1,\x002,3\n"])
def test_bytes_that_are_no_text_fail(spark, tmp_path, content):
    (tmp_path / "bad_dataset.csv").write_bytes(content)
    with pytest.raises(ValueError, match="bad_dataset.csv holds"):
        csv_files.read_csv(spark, str(tmp_path), ABC)


def test_byte_order_mark_and_blank_lines(spark, folder, reading):
    assert rows(spark, folder("﻿a,b,c\n\n1,2,3\n\n")) == [("1", "2", "3")]


def test_short_row_is_padded(spark, folder, reading):
    assert rows(spark, folder("a,b,c\n1,2\n4,5,6\n")) == [("1", "2", None), ("4", "5", "6")]


@pytest.mark.parametrize("row", ["7,8,9,10", "7,8,9,", '"a,b","c","d,e","f"', "7,8,9,,,"])
@pytest.mark.parametrize("first", [True, False])
def test_row_with_too_many_fields_fails(spark, folder, reading, row, first):
    lines = [row, "1,2,3"] if first else ["1,2,3", row]
    path = folder("a,b,c\n" + "\n".join(lines) + "\n")
    with pytest.raises(Exception, match="more fields than its header"):
        csv_files.read_csv(spark, path, ABC).collect()


def test_header_only(spark, folder, reading):
    assert rows(spark, folder("a,b,c\n")) == []


def test_empty_file(spark, folder):
    with pytest.raises(ValueError, match="has no header"):
        rows(spark, folder(""))


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="File not found: .*nowhere.csv"):
        csv_files.read_csv(spark, f"{tmp_path}/nowhere.csv", ABC)
    with pytest.raises(FileNotFoundError, match="File not found"):
        csv_files.read_csv(spark, f"{tmp_path}/*.csv", ABC)


def test_missing_columns_are_all_named(spark, folder):
    with pytest.raises(ValueError, match=r"is missing columns: \['b', 'c'\]"):
        csv_files.read_csv(spark, folder("a,x\n1,2\n"), ABC)


def test_column_names_match_exactly(spark, folder):
    with pytest.raises(ValueError, match=r"is missing columns: \['a'\]"):
        csv_files.read_csv(spark, folder("A,b,c\n1,2,3\n"), ABC)


def test_blank_and_repeated_names(spark, folder, reading):
    """An unnamed column is no declared one; of two equal names the first counts."""
    assert rows(spark, folder(",a,b,a,c\n0,1,2,9,3\n")) == [("1", "2", "3")]


def test_several_files(spark, folder, reading):
    path = folder("a,b,c\n1,2,3\n", "a,b,c\n4,5,6\n")
    assert rows(spark, path) == [("1", "2", "3"), ("4", "5", "6")]


def test_files_must_agree_on_the_header(spark, folder, reading):
    for other in ("b,a,c", "A,B,C"):
        path = folder("a,b,c\n1,2,3\n", f"{other}\n4,5,6\n")
        with pytest.raises(ValueError, match="part1_dataset.csv has another header"):
            csv_files.read_csv(spark, path, ABC)


def test_large_and_small_files_together(spark, folder):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        many = "".join(f"{i},{i},x\n" for i in range(50))
        path = folder("a,b,c\n1,2,3\n", "a,b,c\n" + many, 'a,b,c\n0,"q\n' + "z" * 60 + '",w\n')
        found = rows(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")
    assert len(found) == 52
    assert ("0", "q\n" + "z" * 60, "w") in found


def test_written_by_spark(spark, texts, tmp_path):
    given = texts(CUSTOMERS.columns, ("1", 'a "b"', "01234", "  x,y\nz ", None))
    given.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{tmp_path}/out")
    read = csv_files.read_csv(spark, f"{tmp_path}/out", CUSTOMERS.columns)
    assert read.collect() == given.collect()


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "a b %20"
    folder.mkdir()
    (folder / "x [1].csv").write_text('a,b,c\n1,"l1\nl2",3\n')
    (folder / "y{2}.csv").write_text("a,b,c\n" + "4,5,6\n" * 20)
    (folder / "z*.csv").write_text("a,b,c\n7,8,9\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "19")
    try:
        found = rows(spark, str(folder))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")
    assert found == [("1", "l1\nl2", "3"), *[("4", "5", "6")] * 20, ("7", "8", "9")]


def random_csv(seed, rows):
    rng = random.Random(seed)
    ends = ["\n", "\r\n", "\r"]

    def field(first):
        kind = rng.randrange(5)
        text = "".join(rng.choice('abé \t') for _ in range(rng.randrange(1, 12)))
        if kind < 2:
            return "x" + text
        if kind == 2:
            return 'y5" ' + text.replace("é", '"')  # quotes that are none
        inner = "".join(rng.choice(["a", ",", '""', " ", *ends, "line"]) for _ in range(rng.randrange(0, 30)))
        return f'"{inner}"' + (rng.choice(["", "", "tail", 't"']) if kind == 3 else "")

    lines = []
    for _ in range(rows):
        lines.append(",".join(field(i == 0) for i in range(3)) + rng.choice(ends))
        if rng.random() < 0.05:
            lines.append(rng.choice(["", "  ", "\t"]) + rng.choice(ends))
    return "a,b,c\r\n" + "".join(lines)


@pytest.mark.parametrize("size", [64, 300, 5_000, 1 << 20])
def test_random_files_in_blocks_of_any_size(spark, folder, size):
    pandas = pytest.importorskip("pandas")
    contents = [random_csv(seed, 150) for seed in (size, size + 1)] + ["a,b,c\n1,2,3\n"]
    path = folder(*contents)
    frames = [pandas.read_csv(f"{path}/part{i}_dataset.csv", dtype=str) for i in range(3)]
    expected = [tuple(None if x != x else x for x in r) for f in frames for r in f.itertuples(index=False)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        assert rows(spark, path) == sorted(expected, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")


def test_one_file_with_a_field_over_lines_is_read_by_many_tasks(spark, folder):
    long = "\n".join(f"line {i}" for i in range(60))
    path = folder("a,b,c\n" + "".join(f"{i},x,y\n" for i in range(400)) + f'9,"{long}",z\n' + "".join(f"{i},x,y\n" for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = csv_files.read_csv(spark, path, ABC)
        found = df.select("a", "b", F.spark_partition_id().alias("p")).collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(found) == 801 and [r.b for r in found if r.a == "9" and r.b != "x"] == [long]
    tasks = Counter(r.p for r in found)
    assert len(tasks) == 4 and max(tasks.values()) < 400
    # No window takes a whole file.
    assert re.search(r"hashpartitioning\(file#\d+L, home#\d+L", plan)
    assert not re.search(r"hashpartitioning\((file|uri)#\d+L?, \d+\)", plan)


@pytest.mark.parametrize("size", ["30", "134217728b"])
def test_a_quote_that_is_never_closed_fails_with_its_place(spark, folder, size):
    path = folder("a,b,c\n1,2,3\n" + '4,"x\ny",6\n7,"open,8\n' + "9,9,9\n" * 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        with pytest.raises(Exception, match="part0_dataset.csv has a quoted field without an end, in the line '7,\"open,8'"):
            csv_files.read_csv(spark, path, ABC).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")


def test_a_header_over_several_blocks(spark, folder):
    path = folder("\n" * 90 + 'a,b,c,"long\nheader\nname ' + "x" * 90 + '"\n1,2,"3\n4",5\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        assert rows(spark, path) == [("1", "2", "3\n4")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728b")
