"""CSV read in pieces against Spark's own reader of whole files."""

import numpy as np
import pytest

from lendloom.sources.files import read_csv, write_csv
from lendloom.sources.split_csv import _lines, read_csv_split

SCHEMA = "id int, text string, amount double, tail string"


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def rows(count, seed):
    random = np.random.default_rng(seed)
    pieces = ["plain", 'a "quote"', "comma, here", "line\nbreak", "two\n\nbreaks", '"', '""\n', "tab\t", "", "é 漢字", "x" * 300]
    pick = lambda: "".join(random.choice(pieces, random.integers(1, 5)))
    return [(int(k), pick() if random.random() < 0.9 else None, float(random.integers(0, 99)), pick()) for k in range(count)]


@pytest.mark.parametrize("files, seed", [(1, 1), (3, 2)])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_blocks, files, seed):
    data = rows(900, seed)
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(data, SCHEMA).repartition(files), path)
    mine, whole = read_csv_split(spark, path, SCHEMA), read_csv(spark, path, SCHEMA)
    assert sorted(mine.collect(), key=str) == sorted(whole.collect(), key=str) and mine.count() == 900
    assert _lines(spark, path, '"').select("file", "block").distinct().count() > 10 * files


def test_hand_written_file(spark, tmp_path, small_blocks):
    text = 'id,text,amount,tail\r\n1,"one\r\n\r\ntwo",1.5,a\r\n\r\n2,,,"b ""x"""\r\n3,"' + "y\n" * 3000 + '",2,c\r\n4,last,3,"open\nend"'
    (tmp_path / "f.csv").write_bytes(text.encode())
    got = {r["id"]: r for r in read_csv_split(spark, str(tmp_path / "f.csv"), SCHEMA).collect()}
    assert set(got) == {1, 2, 3, 4} and got[3]["text"] == "y\n" * 3000
    assert (got[2]["text"], got[2]["tail"], got[4]["tail"]) == (None, 'b "x"', "open\nend")
    expected = {r["id"]: r for r in read_csv(spark, str(tmp_path / "f.csv"), SCHEMA).collect()}
    assert {k: (r["text"] or "").replace("\r", "") for k, r in got.items()} == {k: (r["text"] or "").replace("\r", "") for k, r in expected.items()}


def test_header_only_and_empty(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,text,amount,tail\n")
    (tmp_path / "e.csv").write_text("")
    assert read_csv_split(spark, str(tmp_path / "h.csv"), SCHEMA).count() == 0 and read_csv_split(spark, str(tmp_path / "e.csv"), SCHEMA).count() == 0
