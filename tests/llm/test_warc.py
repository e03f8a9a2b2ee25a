from __future__ import annotations

import base64
import hashlib
import os
from collections import Counter

import pytest

from adlift.llm.warc import read_warc, write_warc

ROWS = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, "http://b/ü x", "é"), (4, None, None),
    (5, "http://c", ""), (6, "http://c", "z" * 200_000), (7, "http://c", "\r\n\r\nWARC/1.1\r\n"), (8, "u", "é"),
    (None, "n", "only"), (None, "m", "é"), (None, "p", "twice"), (None, "q", "twice"), (9, "eq", "equal"), (9, "eq", "equal"),
    (9, "other", "equal"), (None, "eq", "equals"), (None, "eq", "equals"),
]


def brute(rows):
    """One response per payload, a page with the largest id; all other rows revisit it."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        keeper = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        ids.remove(keeper)
        out.append((keeper, len(raw), digest, "response", None))
        out += [(i, len(raw), digest, "revisit", keeper) for i in ids]
    return Counter(out)


@pytest.fixture
def pages(spark):
    rows = [(*r, "extra", 9) for r in ROWS]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, salt int").repartition(3)


def test_round_trip(spark, pages, tmp_path):
    manifest = write_warc(pages, f"file://{tmp_path}/w", shards=3, roll_bytes=300)
    got = read_warc(manifest, f"file://{tmp_path}/w").collect()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r[c] for c in columns) for r in got) == brute(ROWS)
    texts = [(r.page_id, r.html) for r in got if r.record_type == "response"]
    assert len(texts) == len({html or "" for _, _, html in ROWS})
    assert {(6, "z" * 200_000), (7, "\r\n\r\nWARC/1.1\r\n"), (None, "only"), (None, "twice")} <= set(texts)
    files = manifest.collect()
    assert sum(f.records for f in files) == len(ROWS) and len(files) > 3
    for f in files:
        raw = open(f"{tmp_path}/w/{f.file}", "rb").read()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (f.bytes, f.sha256)
    # Leftovers that no manifest names are not read, and a second run writes the same bytes.
    with open(f"{tmp_path}/w/_tmp-x-shard-000009-000000.warc.gz", "wb") as f:
        f.write(b"broken")
    assert read_warc(manifest, f"file://{tmp_path}/w").count() == len(ROWS)
    again = write_warc(pages.repartition(5), f"file://{tmp_path}/v", shards=3, roll_bytes=300)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, files))


def test_a_damaged_payload_is_told(spark, pages, tmp_path):
    import gzip

    manifest = write_warc(pages.where("page_id = 3"), str(tmp_path), shards=1)
    path = os.path.join(tmp_path, manifest.first().file)
    raw = gzip.decompress(open(path, "rb").read())
    with open(path, "wb") as f:
        f.write(gzip.compress(raw.replace("é".encode(), b"xy")))
    with pytest.raises(Exception, match="differs from its digest"):
        read_warc(manifest, str(tmp_path)).collect()


def test_empty(spark, pages, tmp_path):
    manifest = write_warc(pages.limit(0), str(tmp_path))
    assert read_warc(manifest, str(tmp_path)).collect() == []
