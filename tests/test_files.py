"""Readers and writers on real files."""

import datetime as dt

from tallyforge.operators.loadtest import rps_per_minute
from tallyforge.operators.pageviews import sum_by_title_day
from tallyforge.sinks import writers
from tallyforge.sources import files, records

INI = """; a comment = ignored
[Settings]
kind=steady

[Minute 1]
host-a=612.5

[Minute 2]
host-a=2100.5
host-b=1900

[Minute 3]
host-a = 4000
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_read_pagecounts_with_dates(spark, rows, tmp_path):
    write(tmp_path / "pagecounts-20151201-000000", "en A 3 100\n en  B\t4 1 \nen C 5\nen D 6 1 extra\n\n")
    write(tmp_path / "pagecounts-20151202-010000", "en A x 1\n")
    write(tmp_path / "other.txt", "en E 1 1\n")
    df = files.read_pagecounts(spark, str(tmp_path), file_date=True)
    assert df.dtypes == [("project", "string"), ("title", "string"), ("views", "bigint"), ("nbytes", "bigint"), ("day", "date")]
    assert rows(df) == sorted(
        [
            ("en", "A", 3, 100, dt.date(2015, 12, 1)), ("en", "B", 4, 1, dt.date(2015, 12, 1)),
            ("en", "A", None, 1, dt.date(2015, 12, 2)), ("en", "E", 1, 1, None),
        ],
        key=repr,
    )
    assert sum_by_title_day(df).count() == 4


def test_read_csv_plain_does_not_unquote(spark, rows, tmp_path):
    path = write(tmp_path / "songs.csv", 'T1,"Hello,World"\nT2,12" mix\n')
    df = files.read_csv_plain(spark, path, "track_id string, title string")
    assert rows(df) == [("T1", '"Hello'), ("T2", '12" mix')]


def test_read_tsv_positions_and_short_lines(spark, rows, tmp_path):
    path = write(tmp_path / "docs.tsv", "0\ttitle\tx\tbody\t\n1\tonly\n\t\t\t\n")
    fields = {"title": 1, "text": 3}
    assert rows(files.read_tsv(spark, path, fields)) == [("", ""), ("title", "body")]
    lines = files.read_lines(spark, path)
    assert rows(files.short_lines(lines, fields)) == [("1\tonly",)]
    assert files.parse_tsv(lines, fields, keep_short=True).count() == 3
    assert files.short_lines(lines, fields).count() + files.parse_tsv(lines, fields).count() == 3
    assert rows(files.parse_tsv(lines, {"a": 0}, trim=True)) == [("",), ("0",), ("1",)]


def test_read_title_list_of_several_files(spark, tmp_path):
    """In order of their names, however their sizes deal them to tasks."""
    titles = [f"T{i}" for i in range(600)]
    cuts = [0, 3, 10, 300, 301, 600]
    (tmp_path / "titles").mkdir()
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / "titles" / f"part-{k:05}.txt").write_text("\n".join(titles[a:b]) + "\n")
    listed = files.read_title_list(spark, str(tmp_path / "titles"))
    assert [r.title for r in listed.orderBy("position").collect()] == titles


def test_read_title_list_keeps_order(spark, tmp_path):
    path = write(tmp_path / "q", "Alder\n Birch.org \r\n\nZ\n")
    listed = files.read_title_list(spark, path).orderBy("position")
    assert [r["title"] for r in listed.collect()] == ["Alder", "Birch.org", "Z"]


def test_read_ini_log(spark, rows, tmp_path):
    path = write(tmp_path / "test.log", INI)
    log = files.read_ini_log(spark, path)
    plain = log.drop("test")
    assert rows(plain) == [(1, "host-a", 612.5), (2, "host-a", 2100.5), (2, "host-b", 1900.0), (3, "host-a", 4000.0)]
    assert rows(rps_per_minute(log).drop("test")) == [
        (1, 612.5, True, 2), (2, 4000.5, False, 2), (3, 4000.0, False, 2)
    ]
    assert rows(rps_per_minute(log, target=9000).drop("test"))[0] == (1, 612.5, True, None)


def test_tests_with_equal_minutes_stay_apart(spark, rows, tmp_path):
    for name, rps in (("a.log", 1000), ("b.log", 3500)):
        write(tmp_path / name, f"[Minute 1]\nh={rps}\n")
    log = files.read_ini_log(spark, str(tmp_path))
    assert rows(rps_per_minute(log, 3000).selectExpr("right(test, 5)", "rps", "below_target", "first_minute_at_target")) == [
        ("a.log", 1000.0, True, None), ("b.log", 3500.0, False, 1)
    ]


def test_read_ini_log_over_several_splits(spark, rows, tmp_path):
    """Headers reach lines that lie in a later split of the same file."""
    text = "".join(f"[Minute {m}]\n" + "".join(f"h{h}={m * 1000 + h}\n" for h in range(40)) for m in range(1, 30))
    write(tmp_path / "a.log", text)
    write(tmp_path / "b.log", "early=1\n" + text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        log = files.read_ini_log(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        found = rows(log.drop("test"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [(m, f"h{h}", float(m * 1000 + h)) for m in range(1, 30) for h in range(40)] * 2
    assert found == sorted(expected, key=repr)


def test_parse_records_separators(spark, rows):
    df = spark.createDataFrame([("Target 1 a;Target 2 b;;bad",)], "payload string")
    assert rows(records.parse_records(df, "payload")) == [(1, "Target 1 a"), (2, "Target 2 b")]
    other = spark.createDataFrame([("Target 1 a.*Target 2 b",)], "payload string")
    assert records.parse_records(other, "payload", sep=".*").count() == 2


def test_text_tsv_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "t string, n long")
    writers.write_text_tsv(df, str(tmp_path / "out"))
    assert rows(files.read_tsv(spark, str(tmp_path / "out"), {"t": 0, "n": 1})) == [("", "2"), ("a", "1")]


def test_merged_csv_column_order(spark, rows, tmp_path):
    sales = spark.createDataFrame([("T1", "2012", 3), ("T9", "2013", 4)], "track_id string, d string, sales_count long")
    songs = spark.createDataFrame([("T1", "One", "AR1")], "track_id string, title string, artist_id string")
    writers.write_merged_csv(sales, songs, str(tmp_path / "inner"))
    assert rows(files.read_lines(spark, str(tmp_path / "inner"))) == [("T1,2012,3,One,AR1",)]
    writers.write_merged_csv(sales, songs, str(tmp_path / "left"), how="left")
    assert rows(files.read_lines(spark, str(tmp_path / "left"))) == [("T1,2012,3,One,AR1",), ("T9,2013,4,,",)]


def test_month_shapes(spark, rows):
    daily = spark.createDataFrame(
        [("A", dt.date(2015, 12, 1), 5), ("A", dt.date(2015, 12, 3), 7), ("B", dt.date(2015, 12, 2), 1)],
        "title string, day date, views long",
    )
    lines = writers.month_line(daily)
    assert rows(lines) == [
        ("A", "12\tA\t20151201:5\t20151202:0\t20151203:7\t"), ("B", "1\tB\t20151201:0\t20151202:1\t20151203:0\t")
    ]
    assert writers.month_line(daily, min_total=1).count() == 1
    assert rows(records.parse_day_fields(lines).where("title = 'A' and views > 0")) == rows(daily.where("title = 'A'"))
    wide = writers.month_pivot(daily, [dt.date(2015, 12, 1), dt.date(2015, 12, 2)])
    assert wide.columns == ["title", "2015-12-01", "2015-12-02"]
    assert rows(wide) == [("A", 5, 0), ("B", 0, 1)]
