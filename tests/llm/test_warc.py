import base64
import hashlib

from biomeframe.llm import warc
from biomeframe.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, digest string, n int"
ROWS = [
    (1, "http://a/", "<p>é", "x", 1), (2, "http://b/\r\nX: y%0A", "<p>é", "x", 1), (5, None, None, "x", 1),
    (4, "u", "", "x", 1), (None, "v", "<p>é", "x", 1), (9, "w", "other", "x", 1), (9, "w", "other", "x", 1),
]


def test_records(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    got = warc.archived(pages).collect()
    want = []
    for page, url, html, *_ in ROWS:
        data = (html or "").encode()
        top = max(p for p, _, h, *_ in ROWS if (h or "") == (html or "") and p is not None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = ("response", None) if page == top else ("revisit", top)
        want.append((str(page), url or "", len(data), digest, *kind))
    assert sorted(map(str, want)) == sorted(
        str((str(r.page_id), r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got
    )


def test_stored_once_and_rebuilt(spark):
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for r in warc.read_archive(spark, path).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4
        if fields["WARC-Type"] == "response":
            assert rest[:-4] == bytes(r.payload)


def test_least_bytes_and_empty(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    kinds = {(r.page_id, r.record_type) for r in warc.archived(pages, least_bytes=4).collect()}
    assert (4, "response") in kinds and (5, "response") in kinds and (1, "revisit") in kinds
    assert warc.archived(pages.limit(0)).count() == 0
