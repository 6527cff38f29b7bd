import gzip
import hashlib
import zlib

import pytest

from lendloom.llm.warc import _inflated, archive_index, cut, normalise, read_records, round_trip, write_archives

BIG = "ä" * 60
PAGES = [(5, "http://a", BIG), (3, "http://b\r\nX: y", BIG), (9, None, BIG), (4, "u", None), (6, "u", ""), (7, "u", "x" * 99), (8, "u", "x" * 99), (2, "u", "line\r\n\r\nContent-Length: 7\r\n\r\nWARC/1.1"), (5, "http://a", BIG), (11, "u", "y" * 3_000_000), (None, "u", "lost")]


def plain(pages):
    first = {}
    for key, _, html in pages:
        raw = (html or "").encode()
        if key is not None and len(raw) >= 100:
            first[raw] = min(first.get(raw, key), key)
    out = []
    for key, _, html in pages:
        raw = (html or "").encode()
        if key is not None:
            again = first.get(raw, key) != key
            out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_file", [1, 3, 1000])
def test_round_trip(spark, per_file):
    df = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    back = round_trip(df, pages_per_file=per_file).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back], key=str) == plain(PAGES)
    for r in back:
        if r["record_type"] == "response":
            assert hashlib.sha256(bytes(r["body"])).hexdigest() == r["payload_digest"]
    assert {r["url"] for r in back if r["page_id"] == 3} == {"http://b%0D%0AX: y"}


def test_archives_are_gzip_and_indexed(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    write_archives(df, str(tmp_path / "raw"), pages_per_file=4)
    raw = sorted((tmp_path / "raw").glob("*.gz"))
    assert len(raw) == 3 and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n") for f in raw)
    normalise(spark, str(tmp_path / "raw"), str(tmp_path / "members"))
    contents = {r["archive"]: bytes(r["content"]) for r in spark.read.parquet(str(tmp_path / "members")).collect()}
    index = archive_index(spark, str(tmp_path / "members")).collect()
    assert len(index) == 10 and read_records(spark, str(tmp_path / "members")).count() == 10
    for r in index:
        record = zlib.decompress(contents[r["archive"]][r["offset"]:r["offset"] + r["length"]], 31)
        assert f"WARC-Record-ID: {r['record_id']}\r\n".encode() in record
    assert {f.name: gzip.decompress(f.read_bytes()) for f in raw} == {k: gzip.decompress(v) for k, v in contents.items()}


def test_cut_records():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in cut(bytes([b]) for b in record * 3)] == [b"abc"] * 3
    assert b"".join(_inflated(gzip.compress(b"one") + gzip.compress(b"two") + b"\0\0")) == b"onetwo"
    with pytest.raises(ValueError):
        list(cut([record[:-6]]))


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_damaged_payload_is_told(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    write_archives(df, str(tmp_path / "raw"))
    (raw,) = (tmp_path / "raw").glob("*.gz")
    whole = gzip.decompress(raw.read_bytes())
    at = whole.index(b"\r\n\r\n", whole.index(b"Content-Length: 1")) + 4
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.gz").write_bytes(gzip.compress(whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1:]))
    normalise(spark, str(tmp_path / "bad"), str(tmp_path / "members"))
    with pytest.raises(Exception, match="not the one that was written"):
        read_records(spark, str(tmp_path / "members")).collect()
