import base64
import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

ROWS = [
    (1, "http://a.x/1", "<p>one</p>"), (2, "http://a.x/2", None), (3, None, ""), (4, "http://b.x/?q=ä\r\nX: y", "ünï"),
    (5, "http://a.x/5", "<p>one</p>"), (7, "http://a.x/7", "<p>one</p>"), (7, "http://a.x/7", "<p>one</p>"),
    (8, "http://c.x/", "long " * 300_000), (None, "http://n.x/", "<p>one</p>"), (-9, "u", "WARC/1.1\r\n\r\nnested"),
]


def pages(spark, rows=ROWS):
    schema = "page_id long, url string, html string, refers_to string, sha1 string, record_type int"
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def by_hand(rows, least=0):
    out = Counter()
    for i, _, html in rows:
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        data = (html or "").encode()
        last = max(same, default=None)
        role = i is None or last == i or len(data) < least
        out[i, len(data), digest(html), "response" if role else "revisit", None if role else last] += 1
    return out


@pytest.mark.parametrize("least", [0, 1, 100])
def test_round_trip(spark, tmp_path, least):
    got = warc.round_trip(pages(spark), str(tmp_path / "w"), least).collect()
    assert Counter(tuple(r) for r in got) == by_hand(ROWS, least)


def test_payloads_headers_and_filters(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark), folder).count()
    records = warc.read(spark, folder)
    by_id = {r.record_id: r for r in records.collect()}
    assert by_id["<urn:page:4>"].payload.decode() == "ünï"
    assert by_id["<urn:page:4>"].target_uri == "http://b.x/?q=ä%0D%0AX: y"
    assert by_id["<urn:page:-9>"].payload == b"WARC/1.1\r\n\r\nnested"
    assert by_id["<urn:page:2>"].refers_to == "<urn:page:3>" and by_id["<urn:page:3>"].target_uri is None
    assert by_id["<urn:page:8>"].headers["WARC-Payload-Digest"] == f"sha1:{digest('long ' * 300_000)}"
    kinds = records.where("record_type = 'revisit' AND refers_to IS NOT NULL").collect()
    assert {r.record_id for r in kinds} == {"<urn:page:1>", "<urn:page:2>", "<urn:page:5>"}
    starts = records.where(F.col("target_uri").startswith("http://a.x/")).count()
    assert starts == 5
    assert records.where("record_type IN ('warcinfo', 'request')").count() == 0


def test_unwanted_members_are_not_unpacked(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    warc.write(pages(spark), folder).count()
    reader = warc.WarcReader(folder, True, True)
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert left == [warc.EqualTo(("payload_bytes",), 3)]
    opened, open_ = [], warc._Member.open
    monkeypatch.setattr(warc._Member, "open", lambda m: opened.append(open_(m)) or opened[-1])
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == len(opened) > 0
    assert all(b"WARC-Type: revisit" in head for head in opened)
    # conditions on headers are checked before the payload is unpacked
    reader = warc.WarcReader(folder, True, True)
    assert not list(reader.pushFilters([warc.StringStartsWith(("target_uri",), "http://c.x")]))
    whole, unpacked = warc._Member.whole, []
    monkeypatch.setattr(warc._Member, "whole", lambda m: unpacked.append(1) or whole(m))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == len(unpacked) == 1 and rows[0]["payload_bytes"] == 1_500_000
    # who asks neither for payloads nor for their digests gets their sizes from the headers alone
    reader = warc.WarcReader(folder, False, False)
    sizes = {r["record_id"]: r["payload_bytes"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()}
    assert len(unpacked) == 1
    reader = warc.WarcReader(folder, True, True)
    assert sizes == {r["record_id"]: r["payload_bytes"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()}


def test_parts_are_planned_by_size(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    many = [(i, f"http://x/{i}", f"page {i}") for i in range(100)]
    warc.write(pages(spark, many), folder).count()
    monkeypatch.setattr(warc, "PART_BYTES", 2000)
    parts = warc.WarcReader(folder, True, True).partitions()
    read = [[r["record_id"] for b in warc.WarcReader(folder, True, True).read(p) for r in b.to_pylist()] for p in parts]
    assert len(parts) > 10 and sorted(sum(read, [])) == sorted(f"<urn:page:{i}>" for i in range(100))
    assert max(map(len, read)) < 20 and not any(hasattr(p, "members") for p in parts)


def test_every_stretch_of_an_index_has_its_lines(tmp_path):
    lines = [(k * 1000, 10 ** (k % 5), "revisit" if k % 3 else "response") for k in range(40)]
    path = tmp_path / "i"
    path.write_text("".join(f"{a} {n} {t}\n" for a, n, t in lines))
    size = path.stat().st_size
    for parts in (1, 2, 7, 39, size):
        cuts = [size * k // parts for k in range(parts + 1)]
        with path.open("rb") as index:
            got = [line for a, b in zip(cuts, cuts[1:]) if b > a for line in warc.index_lines(index, a, b)]
        assert got == lines


@pytest.mark.parametrize("indexed", [True, False])
def test_truncated_archives_are_told(spark, tmp_path, indexed):
    page = warc.record(3, "http://x/", b"body" * 5000, None, "<urn:n>", warc.DATE)
    whole = gzip.compress(page)
    headers = gzip.compress(page[:60])
    cases = {"headers": headers[:-12], "short": headers, "block": whole[: len(whole) // 2 + 40], "nothing": whole[:3]}
    for name, data in cases.items():
        folder = tmp_path / f"{name}{indexed}"
        folder.mkdir()
        (folder / "a.warc.gz").write_bytes(data)
        if indexed:
            (folder / "a.warc.gz.index").write_text(f"0 {len(data)} response\n")
        if name == "nothing" and not indexed:
            assert warc.read(spark, str(folder)).count() == 0
            continue
        with pytest.raises(Exception, match="ends within"):
            warc.read(spark, str(folder)).collect()


def test_header_names_in_any_case_and_repeated():
    head = b"WARC/1.1\r\nwarc-type: response\r\nWARC-Concurrent-To: <a>\r\nX: 1\r\nwarc-concurrent-to: <b>\r\nCONTENT-type: text/x"
    assert warc.parse_headers(head) == {
        "WARC-Type": "response", "WARC-Concurrent-To": "<a>, <b>", "X": "1", "Content-Type": "text/x"
    }


@pytest.mark.parametrize("packed", [True, False])
def test_archives_of_others(spark, tmp_path, packed):
    """No index, several members or one, and record types of other tools."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\nContent-Type: application/warc-fields\r\n\r\nhello\r\n\r\n"
    page = warc.record(3, "http://x/", b"body", None, "<urn:n>", warc.DATE)
    data = b"".join(gzip.compress(r) for r in (info, page, page)) if packed else info + page + page
    (tmp_path / ("a.warc.gz" if packed else "a.warc")).write_bytes(data)
    got = warc.read(spark, str(tmp_path)).orderBy("record_type").collect()
    assert [(r.record_type, r.payload) for r in got] == [("response", b"body")] * 2 + [("warcinfo", b"hello")]


def test_damaged_payloads_are_told(spark, tmp_path):
    page = warc.record(3, "http://x/", b"body", None, "<urn:n>", warc.DATE).replace(b"body", b"b0dy")
    (tmp_path / "a.warc").write_bytes(page)
    with pytest.raises(Exception, match="payload digest"):
        warc.read(spark, str(tmp_path)).collect()
    assert warc.read(spark, str(tmp_path), verify=False).first().payload == b"b0dy"


def test_empty_table(spark, tmp_path):
    assert warc.round_trip(pages(spark).where("false"), str(tmp_path / "none")).collect() == []
