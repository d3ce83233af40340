"""Archives: exact round trip, dictionary, frames."""

import base64
import hashlib

import pytest
import zstandard

from hitloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, least int"


@pytest.fixture(scope="module")
def pages():
    rows = [(k, f"http://h{k % 7}.example/{k}", f"<html><body><p>Page {k % 90} of many, ünïcode &amp; more {'x' * (k % 50)}</p></body></html>", "c", 1) for k in range(200)]
    rows += [(300, None, "", "c", 1), (301, "http://a b\r\nX: y", None, "c", 1), (302, "http://e", "<p>\r\n\r\nWARC/1.1\r\n</p>", "c", 1)]
    rows += [(None, "http://n", "<p>no id</p>", "c", 1), (303, "http://n2", "<p>no id</p>", "c", 1), (5, "http://h5.example/5", rows[5][2], "c", 1), (304, "http://l", "long " * 400_000, "c", 1)]
    return rows


def want(rows):
    least = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            least[html or ""] = min(page_id, least.get(html or "", page_id))
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        first = least.get(html or "")
        same = page_id == first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((str(page_id), len(data), digest, "response" if same else "revisit", None if same else first))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    got = warc.archive_and_read(spark.createDataFrame(pages, SCHEMA)).collect()
    assert sorted(((str(r.page_id), *r[1:]) for r in got), key=str) == want(pages)


def test_files_are_plain_warc_zstd(spark, pages, tmp_path):
    folder = tmp_path / "warc"
    dictionary = warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(2), f"file://{folder}", per_file=40)
    files = [f for f in folder.iterdir() if f.name.startswith("part-")]
    assert len(files) > 4
    seen = 0
    for f in files:
        data = f.read_bytes()
        assert data[:4] == warc.DICTIONARY_MAGIC and data[8 : 8 + len(dictionary)] == dictionary
        records = list(warc.read_records(data))
        assert len(records) <= 40
        seen += len(records)
        # A reader that knows no more than Zstandard gives the same bytes.
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        with reader.stream_reader(data, read_across_frames=True) as stream:
            assert stream.read() == b"".join(records)
        assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    assert seen == len(pages)
    payloads = {r.page_id: r.payload for r in warc.read_archives(spark, f"file://{folder}").collect() if r.record_type == "response"}
    assert payloads[302] == pages[202][2].encode() and payloads[0] == pages[0][2].encode()


def test_empty_table(spark, pages):
    assert warc.archive_and_read(spark.createDataFrame([], SCHEMA)).collect() == []


def test_damage_is_noticed():
    record = warc.record(1, "http://x", b"payload")
    fields, _, payload = warc.parse_record(record)
    assert payload == b"payload" and fields["X-Page-ID"] == "1"
    with pytest.raises(ValueError):
        list(warc.frames(b"junk data"))
