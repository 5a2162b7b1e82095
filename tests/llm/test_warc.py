import base64
import gzip
import hashlib
from pathlib import Path

from tests.llm.helpers import LONG

from ledgerline.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [
    (1, "http://a/ b\n", "<html>é</html>"), (2, None, "<html>é</html>"), (3, "http://c", None), (4, "http://d", ""), (5, "x", LONG),
    (6, "u", "body\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n"), (7, "u", "same"), (7, "u", "same"), (None, "n", "same"), (None, None, None),
]


def test_round_trip(spark):
    df = spark.createDataFrame([(*p, "x", "x") for p in PAGES], "page_id long, url string, html string, kind string, _id string")
    rows = warc.read_archives(spark, warc.write_archives(df)).collect()
    assert all(r["kind"] == "record" for r in rows) and len(rows) == len(PAGES)
    top = {}
    for i, _, html in PAGES:
        top[html or ""] = max(top.get(html or "", -1), -1 if i is None else i)
    seen = set()
    for r in sorted(rows, key=lambda r: r["record_type"]):
        i = int(r["record_id"]) if r["record_id"] else None
        html = next(h or "" for j, _, h in PAGES if j == i and digest((h or "").encode()) == r["payload_digest"])
        assert r["payload_bytes"] == len(html.encode())
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == html.encode() and (-1 if i is None else i) == top[html] and html not in seen
            seen.add(html)
        else:
            assert r["refers_to"] == str(top[html]) and html in seen
    assert seen == set(top)


def test_least_bytes_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    rows = warc.read_archives(spark, warc.write_archives(df, least_bytes=3)).collect()
    assert sorted((r["record_id"], r["record_type"]) for r in rows) == [("1", "response"), ("2", "response"), ("3", "revisit"), ("4", "response")]
    assert warc.read_archives(spark, warc.write_archives(df.limit(0))).count() == 0


def record(k, payload):
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{k}>\r\nWARC-Payload-Digest: sha1:{digest(payload)}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def summary(data):
    return [(at, size, reason, found and found[0]["warc-record-id"]) for at, _, size, reason, found in warc.salvage(data)]


def test_salvage_plain():
    parts = [record(k, b"payload %d" % k * 20) for k in range(5)]
    damaged = bytearray(parts[1])
    damaged[-20] ^= 1  # digest
    short = parts[3][:-30]  # cut in the middle
    data = b"junk" + parts[0] + bytes(damaged) + parts[2] + short + parts[4]
    found = summary(data)
    assert [x[3] for x in found if x[3]] == ["<urn:page:0>", "<urn:page:2>", "<urn:page:4>"]
    gaps = [(at, size) for at, size, reason, _ in found if reason]
    first = 4 + len(parts[0])
    assert gaps == [(0, 4), (first, len(damaged)), (first + len(damaged) + len(parts[2]), len(short))]
    assert sum(size for _, size, _, _ in found) == len(data)


def test_salvage_members(tmp_path, spark):
    members = [gzip.compress(record(k, b"text %d " % k * 50)) for k in range(4)]
    broken = bytearray(members[1])
    broken[20:30] = b"\0" * 10
    data = members[0] + bytes(broken) + members[2] + members[3][:-6]
    found = summary(data)
    assert [x[3] for x in found if x[3]][:2] == ["<urn:page:0>", "<urn:page:2>"]
    assert any(reason and at == len(members[0]) for at, _, reason, _ in found)
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert {r["record_id"] for r in rows if r["kind"] == "record"} >= {"0", "2"} and any(r["kind"] == "gap" for r in rows)
    assert summary(b"") == [] and [x[2] for x in summary(b"no archive")] == ["version line"]


def test_salvage_of_a_damaged_written_file(tmp_path, spark):
    df = spark.range(3000).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(concat(sha2(string(id), 256), ' words '), 5) as html")
    root = warc.write_archives(df, root=str(tmp_path / "whole"))
    (path,) = Path(root).glob("part-*")
    whole = path.read_bytes()
    assert gzip.decompress(whole).count(b"WARC/1.0\r\n") == 3000
    for share in (0.1, 0.5, 0.9):
        data = bytearray(whole)
        data[int(share * len(data))] ^= 16
        ids = [found[0]["warc-record-id"] for *_, found in warc.salvage(bytes(data)) if found]
        assert len(ids) == len(set(ids)) >= 2998
    data = bytearray(whole)
    data[len(data) // 2 : len(data) // 2 + 5000] = bytes(5000)
    (tmp_path / "hurt.warc.gz").write_bytes(data)
    rows = warc.read_archives(spark, str(tmp_path / "hurt.warc.gz"), with_payload=False)
    assert rows.where("kind = 'record'").count() > 2950 and rows.where("kind = 'gap'").count() >= 1


def test_nothing_before_the_damage_is_lost():
    records = [record(k, hashlib.sha256(b"%d" % k).hexdigest().encode() * 3) for k in range(1000)]
    data = bytearray(gzip.compress(b"".join(records)))
    data[-8] ^= 1  # the check sum, in the last step
    found = summary(bytes(data))
    assert [x[3] for x in found if x[3]] == [f"<urn:page:{k}>" for k in range(1000)] and found[-1][2] == "gzip member"


def test_very_long_address(spark):
    url = "data:text/html," + "x" * 100_000
    rows = warc.read_archives(spark, warc.write_archives(spark.createDataFrame([(1, url, "a"), (2, "u", "b")], "page_id long, url string, html string"))).collect()
    assert sorted((r["kind"], r["record_id"], r["target_uri"]) for r in rows) == [("record", "1", url), ("record", "2", "u")]
