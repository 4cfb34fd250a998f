"""Raw files: quoting, missing words, short and long rows, header."""

import pytest

from risklake.sources.delimited import read_raw, write_raw
from risklake.sources.schemas import Source

SOURCE = Source("bronze_t", "t.csv", ("a", "b", "c"))


def read(spark, folder, content, source=SOURCE):
    path = folder / "t.csv"
    path.write_text(content, encoding="utf-8")
    return read_raw(spark, str(path), source)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quotes_and_missing_words(spark, tmp_path):
    df = read(spark, tmp_path, 'a;b;c\n1;"x ""q"" ;y";""\n2;NA; NA \n3;\\;none\n')
    assert values(df) == [("1", 'x "q" ;y', None), ("2", None, " NA "), ("3", "\\", "none")]


def test_short_row_is_padded(spark, tmp_path):
    assert values(read(spark, tmp_path, "a;b;c\n1;2;3\n4;5\n")) == [("1", "2", "3"), ("4", "5", None)]


@pytest.mark.parametrize("row", ["1;2;3;4", '1;"2;9";3;4', "1;2;3;"])
def test_long_row_fails_whatever_is_read(spark, tmp_path, row):
    df = read(spark, tmp_path, f"a;b;c\n1;2;3\n{row}\n")
    for action in (df.collect, df.count, df.select("b").collect):
        with pytest.raises(Exception, match="more than 3 fields"):
            action()


def test_quoted_separators_are_not_fields(spark, tmp_path):
    assert values(read(spark, tmp_path, 'a;b;c\n"1;1;1;1";2\n')) == [("1;1;1;1", "2", None)]


def test_columns_go_by_name(spark, tmp_path):
    df = read(spark, tmp_path, "c;x;a;b\n3;0;1;2\n")
    assert values(df.select("a", "b", "c", "x")) == [("1", "2", "3", "0")]


def test_missing_column_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="bronze_t: no column b, c"):
        read(spark, tmp_path, "a;x\n1;2\n")


def test_header_without_rows(spark, tmp_path):
    assert read(spark, tmp_path, "a;b;c\n").count() == 0


def test_files_with_different_headers_fail(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "1.csv").write_text("a;b;c\n1;2;3\n")
    (folder / "2.csv").write_text("a;c;b\n1;3;2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|CSV header"):
        read_raw(spark, str(folder), SOURCE).collect()


def test_quoted_line_breaks(spark, tmp_path):
    source = Source("bronze_t", "t.csv", ("a", "b", "c"), multiline=True)
    assert values(read(spark, tmp_path, 'a;b;c\n1;"x\ny";3\n', source)) == [("1", "x\ny", "3")]


def test_quoted_line_breaks_fail_a_source_without_them(spark, tmp_path):
    for text in ('a;b;c\n1;"x\ny";3\n', 'a;b;c\n1;"x;y\n2;2;2\n', 'a;b;c\n1;2;"x\ny"\n3;4;5\n'):
        with pytest.raises(Exception, match="open quote .set multiline"):
            read(spark, tmp_path, text).collect()


def test_round_trip(spark, tmp_path):
    rows = [("1", ' "q"; ', "x"), ("2", None, " s "), ("3", "\\", "a;b")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_raw(df, str(tmp_path / "out"))
    assert values(read_raw(spark, str(tmp_path / "out"), SOURCE)) == sorted(rows, key=repr)


MULTILINE = Source("bronze_t", "t.csv", ("a", "b", "c"), multiline=True)


def test_quoted_line_breaks_over_many_splits(spark, tmp_path):
    """The same rows as one task reads, however small the splits are: some begin in quotes, some records span several."""
    import random

    draw = random.Random(3)
    pieces = ["x", ";", '""', "\n", "long text ", "\n\n", "é", " "]
    rows = [
        (str(i), "".join(draw.choice(pieces) for _ in range(draw.choice([1, 3, 8, 60]))), draw.choice(["z", "NA", "p q"])) for i in range(600)
    ]
    text = "a;b;c\n" + "".join(f'{a};"{b}";{c}\n' for a, b, c in rows)
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "1.csv").write_text(text, encoding="utf-8", newline="")
    (folder / "2.csv").write_text("a;b;c\n" + 'y;"1\n2";3\n' * 40, encoding="utf-8", newline="")
    expected = [(a, b.replace('""', '"') or None, None if c == "NA" else c) for a, b, c in rows] + [("y", "1\n2", "3")] * 40
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        for size in ("128m", "700", "90"):
            spark.conf.set(settings[0], size)
            spark.conf.set(settings[1], "1")
            df = read_raw(spark, str(folder), MULTILINE)
            assert values(df) == sorted(expected, key=repr)
        lines = spark.read.text(str(folder / "1.csv"))
        assert lines.rdd.getNumPartitions() > 100
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_multiline_files_are_checked_too(spark, tmp_path):
    for text, match in (
        ('a;b;c\n1;"x\ny";3;4\n', "more than 3 fields"), ('a;b;c\n1;"x\ny;3\n', "open quote"),
    ):
        with pytest.raises(Exception, match=match):
            read(spark, tmp_path, text, MULTILINE).collect()
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "1.csv").write_text("a;b;c\n1;2;3\n")
    (folder / "2.csv").write_text("a;c;b\n1;3;2\n")
    with pytest.raises(Exception, match="CSV header"):
        read_raw(spark, str(folder), MULTILINE).collect()
    assert values(read(spark, tmp_path, 'a;b;c\r\n1;"x\r\ny"\r\n\r\n2;;3\r\n', MULTILINE)) == [("1", "x\ny", None), ("2", None, "3")]
