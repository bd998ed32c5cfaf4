import base64
import hashlib
import io

import pytest

from freightlens.llm import warc
from freightlens.llm.common import Scratch

PAGES = [(3, "http://a/x", "<p>é</p>"), (1, "http://b/", "<p>é</p>"), (2, "http://c/", ""), (4, None, None), (5, "http://d/\r\nX-Bad: 1", "long" * 500_000),
         (6, "http://e/", "<p>é</p>"), (6, "http://e/", "<p>é</p>"), (None, "http://f/", "<p>é</p>"), (None, None, None), (7, "http://g/", "a\r\n\r\nb\u0000"),
         (8, "http://h/", "lone"), (8, "http://h/", "lone")]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def folder(spark):
    out = Scratch(spark, "warc-test").path("archive")
    clash = "1 as address, 'x' as payload, 'y' as record_type, 'z' as row"
    warc.write(spark.createDataFrame(PAGES, SCHEMA).repartition(3).selectExpr("*", *clash.split(", ")), out)
    return out


def brute(rows, min_bytes=0):
    """page_id, bytes, digest, type and refers_to of each row."""
    data = sorted(((r[0] is None, r[0] or 0, r[1] or ""), (r[2] or "").encode(), r[0]) for r in rows)
    seen, out = {}, []
    for _, payload, page in data:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = payload in seen and len(payload) >= min_bytes
        out.append((page, len(payload), digest, "revisit" if again else "response", seen[payload] if again else None))
        seen.setdefault(payload, page)
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def parse(data):
    """One record of a WARC file, read by the format's rules."""
    f = io.BytesIO(data)
    assert f.readline() == b"WARC/1.1\r\n"
    fields = {}
    while (line := f.readline()) != b"\r\n":
        name, _, v = line.decode().partition(": ")
        fields[name] = v.removesuffix("\r\n")
    block = f.read(int(fields["Content-Length"]))
    assert f.read() == b"\r\n\r\n"
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def test_edge_rows(spark, folder):
    assert got(warc.read(spark, folder)) == brute(PAGES)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({(r[2] or "") for r in PAGES})


def test_small_payloads_are_all_responses(spark):
    out = Scratch(spark, "warc-test").path("archive")
    warc.write(spark.createDataFrame(PAGES, SCHEMA), out, min_bytes=5)
    assert got(warc.read(spark, out)) == brute(PAGES, 5)


def test_records_follow_the_format(spark, folder):
    rows = warc.records(spark, folder).collect()
    ids = {}
    for r in rows:
        fields, http, payload = parse(r.record)
        assert fields["WARC-Type"] == r.record_type and payload == (bytes(r.payload) if r.record_type == "response" else b"")
        assert fields.get("X-Page-ID") == (None if r.page_id is None else str(r.page_id))
        assert "X-Bad" not in fields and fields.get("WARC-Target-URI") == r.url
        assert f"Content-Length: {len(r.payload)}".encode() in http
        ids[fields["WARC-Record-ID"]] = fields
        whole, _, payload = parse(r.original)
        assert payload == bytes(r.payload) and whole["WARC-Type"] == "response" and "WARC-Refers-To" not in whole
        assert bytes(r.record).startswith(bytes(r.header))
    assert len(ids) == len(rows)
    for f in ids.values():
        if f["WARC-Type"] == "revisit":
            assert ids[f["WARC-Refers-To"]]["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and ids[f["WARC-Refers-To"]]["WARC-Type"] == "response"


def test_damage_is_found(spark, folder):
    payloads, headers = spark.read.schema(warc.PAYLOADS).parquet(f"{folder}/payloads"), spark.read.schema(warc.HEADERS).parquet(f"{folder}/headers")
    longer = "concat(payload, cast('!' as binary)) as payload"
    bad = {"payload differs": (headers, payloads.selectExpr("address", longer, "response_id", "response_page")),
           "header and payload differ": (headers, payloads.where("octet_length(payload) < 100000")),
           "header and payload differ ": (headers, payloads.selectExpr("address", "payload", "'<urn:uuid:0>' as response_id", "response_page")),
           "header and payload differ  ": (headers.selectExpr("address", "cast(replace(decode(header, 'utf-8'), 'Length: 4', 'Length: 5') as binary) as header"), payloads)}
    for said, (h, p) in bad.items():
        out = Scratch(spark, "warc-bad").path("archive")
        h.write.parquet(f"{out}/headers")
        p.write.parquet(f"{out}/payloads")
        with pytest.raises(Exception, match=said.strip()):
            warc.read(spark, out).collect()


def test_empty(spark):
    out = Scratch(spark, "warc-test").path("archive")
    warc.write(spark.createDataFrame([], SCHEMA), out)
    assert warc.records(spark, out).collect() == []
