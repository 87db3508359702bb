import gzip
import random

import pytest

from ledgerlens.sources import csv_parts, tables

SCHEMA = "id int, text string, x double"


def content(seed, end, rows=60, last_end=True, header="id,text,x"):
    rng = random.Random(seed)
    pieces = ["a", "é", ",", '""', "\n", "\r\n", "\n\n", '""\n""', "long word ", "", '\n"",1\n', "\r\n,"]
    lines = [header]
    for i in range(rows):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(8)))
        plain = rng.random() < 0.2
        lines.append(f"{i},plain {i},{i / 4}" if plain else f'{i},"{text}",{i / 4}')
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if last_end else "")


def both(spark, path, part_bytes):
    one = tables.read_reports(spark, path, SCHEMA)
    many = tables.read_reports(spark, path, SCHEMA, part_bytes=part_bytes)
    assert many.dtypes == one.dtypes
    return sorted(map(tuple, one.collect()), key=repr), sorted(map(tuple, many.collect()), key=repr)


@pytest.mark.parametrize(
    "seed,end,last_end,part_bytes", [(1, "\n", True, 7), (2, "\r\n", True, 11), (3, "\n", False, 23), (4, "\r\n", False, 64), (5, "\n", True, 10**6)]
)
def test_equals_one_task(spark, tmp_path, seed, end, last_end, part_bytes):
    folder = tmp_path / "r"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.csv").write_bytes(content(seed + 10 * i, end, last_end=last_end).encode())
    one, many = both(spark, str(folder), part_bytes)
    assert len(one) == 120
    assert many == one


def test_every_boundary(spark, tmp_path):
    """One file cut at every one of its bytes."""
    path = tmp_path / "one.csv"
    path.write_bytes(b'id,text,x\n1,"a\r\n""b""\n",2\n\n2,"\n\n",\n3,c,4\n')
    one, many = both(spark, str(path), 1)
    assert many == one == [(1, 'a\r\n"b"\n', 2.0), (2, "\n\n", None), (3, "c", 4.0)]


def test_header_over_lines_and_records_over_ranges(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("\n\n" + content(3, "\n", rows=5, header='id,"te\nxt\n",x') + '9,"' + "many lines\n" * 50 + '",1\n')
    one, many = both(spark, str(path), 16)
    assert many == one and len(one) == 6


def test_shuffled_ranges_gzip_and_no_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_parts, "MOST_RANGES", 1)
    path = tmp_path / "one.csv"
    path.write_text(content(8, "\n"))
    one, many = both(spark, str(path), 40)
    assert many == one
    packed = tmp_path / "one.csv.gz"
    packed.write_bytes(gzip.compress(content(8, "\n").encode()))
    assert both(spark, str(packed), 40)[1] == one
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    bare = tmp_path / "bare.csv"
    bare.write_text("id,text,x\n")
    assert both(spark, str(empty), 5) == ([], []) and both(spark, str(bare), 5) == ([], [])


def test_settings_are_put_back(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(content(8, "\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tables.read_reports(spark, str(path), SCHEMA, part_bytes=40)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
