"""Extracts with quoted line breaks, read by many tasks."""

import random

import pytest

from kitchenlight.sources.delimited import read_broken_extract
from kitchenlight.sources.quoted import UnclosedQuote, quoted_records


def written(folder, files):
    folder.mkdir()
    for number, text in enumerate(files):
        (folder / f"part-{number}.csv").write_bytes(text.encode())
    return str(folder)


def field(rng):
    text = "".join(rng.choice(["a", "é", " ", ",", '""', "\n", "\n\n", "x" * 20]) for _ in range(rng.randrange(1, 9)))
    return f'"{text}"' if rng.random() < 0.4 else rng.choice(["plain", "7", " padded "])


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("split", ["64b", "1k", "64m"])
def test_one_file_with_breaks_equals_the_whole_file_reader(spark, tmp_path, split):
    rng = random.Random(split)
    body = "".join(f"{field(rng)},{i},{field(rng)}\n" for i in range(400))
    path = written(tmp_path / "extract", ["NAME,NO,MORE ONE\n" + body, "NAME,NO,MORE ONE\n" + 'z,1,"last\n\nline"'])
    want = rows(spark.read.csv(path, header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_broken_extract(spark, path, ["NO"])
        assert rows(df) == want and len(want) == 401
        if split == "1k":
            assert spark.read.text(path).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_of_other_systems(spark, tmp_path):
    path = written(tmp_path / "extract", ['A,B\r\n1,"x\ny"\r\n\r\n2,z\r\n'])
    assert rows(read_broken_extract(spark, path)) == rows(spark.createDataFrame([("1", "x\ny"), ("2", "z")], "A string, B string"))


def test_header_alone(spark, tmp_path):
    assert read_broken_extract(spark, written(tmp_path / "extract", ["A,B\n"])).collect() == []


def test_unclosed_quote_fails_before_any_record(spark, tmp_path):
    path = written(tmp_path / "extract", ["A,B\n1,2\n", 'A,B\n1,"open\n2,3\n'])
    with pytest.raises(UnclosedQuote, match="part-1"):
        quoted_records(spark, path)


def test_short_record_fails(spark, tmp_path):
    path = written(tmp_path / "extract", ['A,B\n1,"x\ny"\n"only\none"\n'])
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        read_broken_extract(spark, path).collect()
