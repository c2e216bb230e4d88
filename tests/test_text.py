from __future__ import annotations

import gzip

import pytest
from conftest import synthetic_rows, synthetic_text

from wearline.schema import READING_COLUMNS
from wearline.sources.text import read_sensor_text, read_truth_text


def scan(spark, tmp_path, text, name="log.txt"):
    path = tmp_path / name
    path.write_text(text)
    return read_sensor_text(spark, str(path))


def line(*head, sensors=21, scale=1.0):
    return " ".join(map(str, [*head, *[scale * j for j in range(1, sensors + 1)]]))


def test_rows_of_two_engines(spark, tmp_path):
    heads = [(7, 1, 12.5, -0.75, 60.0), (7, 2, 12.75, 0.5, 60.0), (11, 1, -3.0, 1.0, 60.0)]
    text = "".join(line(*head, scale=k) + "\n" for k, head in enumerate(heads, start=1))
    rows = sorted(map(tuple, scan(spark, tmp_path, text).collect()))
    assert rows == [(*h, *[float(k * j) for j in range(1, 22)]) for k, h in enumerate(heads, start=1)]
    assert scan(spark, tmp_path, text).columns == list(READING_COLUMNS)


def test_trailing_spaces_and_surplus_fields(spark, tmp_path):
    text = "\n".join([line(1, 1, 0, 0, 100) + end for end in ("", " ", "  ", "    ", " x y z 1f")])
    rows = scan(spark, tmp_path, text).collect()
    assert len(rows) == 5
    assert {r.s21 for r in rows} == {21.0}


def test_signed_and_scientific(spark, tmp_path):
    row = scan(spark, tmp_path, "4 9 -41.5 2.25E2 +0.5 " + " ".join(["7"] * 21)).first()
    assert (row.setting1, row.setting2, row.setting3) == (-41.5, 225.0, 0.5)


def test_short_line_is_padded(spark, tmp_path):
    row = scan(spark, tmp_path, line(1, 1, 0, 0, 100, sensors=15)).first()
    assert row.s15 == 15.0
    assert [row[f"s{j}"] for j in range(16, 22)] == [None] * 6


def test_empty_fields_and_lines(spark, tmp_path):
    rows = scan(spark, tmp_path, line(1, 1, 0, "", 100) + "\n\n" + " 1 2 0 0 0\n").collect()
    assert len(rows) == 2
    assert rows[0].setting2 is None and rows[0].setting3 == 100.0
    assert rows[1].id is None and rows[1].cycle == 1


@pytest.mark.parametrize("bad", ["abc", "1d", "2.5F", "0x10", "NULL"])
@pytest.mark.parametrize("field", [0, 4, 25])
def test_bad_value_stops_the_job(spark, tmp_path, bad, field):
    fields = line(1, 1, 0, 0, 100).split(" ")
    fields[field] = bad
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a sensor line"):
        scan(spark, tmp_path, " ".join(fields)).collect()


def test_integers(spark, tmp_path):
    text = "".join(f"{token} 1 0 0 0\n" for token in ("1.0", "1.5", "2.5", "-1.5", "1e2", "+7"))
    assert [r.id for r in scan(spark, tmp_path, text).collect()] == [1, 2, 3, -2, 100, 7]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        scan(spark, tmp_path, "99999999999 1 0 0 0", "big.txt").collect()


def test_not_a_number_and_infinity_are_values(spark, tmp_path):
    row = scan(spark, tmp_path, "1 1 nan inf -inf").first()
    assert row.setting1 != row.setting1
    assert (row.setting2, row.setting3) == (float("inf"), -float("inf"))


def test_gzip(spark, tmp_path):
    path = tmp_path / "log.txt.gz"
    path.write_bytes(gzip.compress(synthetic_text().encode()))
    rows = read_sensor_text(spark, str(path)).collect()
    assert sorted(map(tuple, rows)) == synthetic_rows()


def test_remote_path_is_passed_on_unchanged(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        read_sensor_text(spark, "nosuchscheme://bucket/log.txt").collect()


def truth(spark, path):
    return sorted((r.id, r.rul_at_maxcycle) for r in read_truth_text(spark, str(path)).collect())


def test_truth_ids_are_line_numbers(spark, tmp_path):
    path = tmp_path / "rul.txt"
    path.write_text("31\n7\n250\n")
    assert truth(spark, path) == [(1, 31), (2, 7), (3, 250)]


def test_truth_spaces_and_blank_line(spark, tmp_path):
    path = tmp_path / "rul.txt"
    path.write_text(" 31\n\n7 \n")
    assert read_truth_text(spark, str(path)).orderBy("id").collect() == [(1, 31), (2, None), (3, 7)]


def test_truth_of_many_splits_and_files(spark, tmp_path):
    folder = tmp_path / "rul"
    folder.mkdir()
    numbers = [(7919 * i) % 1000 for i in range(60_000)]
    (folder / "a.txt").write_text("".join(f"{v}\n" for v in numbers[:45_000]))
    (folder / "b.txt").write_text("".join(f"{v}\n" for v in numbers[45_000:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert truth(spark, folder) == list(enumerate(numbers, start=1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["1 1 abc 0 0 2.5", "1 x 0 0 0 2.5", "99999999999 1 0 0 0 2.5"])
def test_bad_value_stops_the_job_in_any_session(spark, tmp_path, line, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    path = tmp_path / "log.txt"
    path.write_text(line + "\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
            read_sensor_text(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
