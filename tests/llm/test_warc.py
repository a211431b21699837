"""WARC writing, normalising and reading."""

import gzip
import hashlib
import json
import zlib

import pytest

from lshark.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, size int, digest string")


ROWS = [(5, "http://a/", "<p>" + "x" * 200), (3, "http://b/", "<p>" + "x" * 200), (9, None, "<p>" + "x" * 200),
        (1, "http://c/", "short"), (2, "http://d/", "short"), (4, "http://e/", None), (6, "http://f/\r\nX: y", ""),
        (7, "http://g/", "é" * 50), (8, "http://h/", "é" * 50), (10, "http://i/", "WARC/1.1\r\n\r\n" * 30),
        (None, "http://j/", "<p>" + "y" * 300), (11, "http://k/", "<p>" + "y" * 300), (3, "http://b/", "<p>" + "x" * 200),
        (12, "http://l/", "z\r\n" * 400000)]


def test_round_trip(spark, tmp_path):
    got = warc.archive_pages(pages(spark, ROWS), str(tmp_path)).collect()
    first = {}
    for p, _, html in ROWS:
        b = (html or "").encode()
        if len(b) >= 100:
            k = -1 if p is None else p
            first[b] = min(first.get(b, k), k)
    want = []
    for p, _, html in ROWS:
        b = (html or "").encode()
        k = -1 if p is None else p
        same = first.get(b, k)
        want.append((p, len(b), hashlib.sha256(b).hexdigest(), "response" if same == k else "revisit",
                     None if same in (k, -1) else same))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    assert warc.archive_pages(pages(spark, []), str(tmp_path)).collect() == []


def test_every_record_is_a_member_that_reads_alone(tmp_path):
    records = [warc.record("response", f"urn:page:{i}", "http://x/", "00", n, b"q" * n, None)
               for i, n in enumerate([0, 10, 300000, 7])]
    records.append(warc.record("revisit", "urn:page:9", "http://x/", "00", 300000, b"ignored", "urn:page:2"))
    raw = tmp_path / "raw.warc.gz"
    raw.write_bytes(gzip.compress(b"".join(records)))
    n = warc.normalise(str(raw), f"{tmp_path}/out/a.warc.gz", f"{tmp_path}/out/a.index")
    data = (tmp_path / "out/a.warc.gz").read_bytes()
    index = [json.loads(x) for x in (tmp_path / "out/a.index").read_text().splitlines()]
    assert n == len(index) == 5 and gzip.decompress(data) == b"".join(records)
    for at, r in zip(index, records):
        member = zlib.decompressobj(31)
        assert member.decompress(data[at["offset"]:at["offset"] + at["length"]]) == r and member.eof
    with open(tmp_path / "out/a.warc.gz", "rb") as f:
        fields, block = warc.read_record(f, index[4]["offset"], index[4]["length"])
    assert fields["warc-refers-to"] == "<urn:page:2>" and index[4]["type"] == "revisit" and b"q" not in block


@pytest.mark.parametrize("cut", [1, 40])
def test_members_split_anywhere_and_damage_is_an_error(tmp_path, cut):
    body = warc.record("response", "urn:page:1", "u", "0", 50, b"a" * 50, None) * 3
    split = b"".join(gzip.compress(body[i:i + 97]) for i in range(0, len(body), 97))
    (tmp_path / "a").write_bytes(split)
    assert warc.normalise(str(tmp_path / "a"), f"{tmp_path}/o", f"{tmp_path}/i") == 3
    (tmp_path / "b").write_bytes(gzip.compress(body[:-cut]))
    with pytest.raises(ValueError):
        warc.normalise(str(tmp_path / "b"), f"{tmp_path}/o", f"{tmp_path}/i")
