import base64
import gzip
import hashlib
import pathlib

import pytest

from corpuslake.llm import warc
from corpuslake.stages import Stages

PAGES = [
    (1, "http://a/1", "<p>x</p>"),
    (2, "http://a/2 b", "<p>x</p>"),
    (3, "http://a/3\r\nX: y", "HTTP\r\n\r\nWARC/1.1\r\n\r\nß"),
    (4, None, ""),
    (5, "http://a/5", None),
    (9, "http://a/9", "<p>x</p>"),
    (9, "http://a/9", "<p>x</p>"),
    (9, "http://a/9", "other"),
    (-7, "http://a/7", "z" * 300_000),
    (None, "http://a/0", "<p>x</p>"),
    (None, None, "<p>x</p>"),
]


def want(rows, least):
    keep = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            keep[html or ""] = max(keep.get(html or "", page), page)
    out, stored = [], set()
    for page, _, html in rows:
        body = (html or "").encode()
        to = keep.get(html or "") if page is not None else None
        if to == page and to is not None and (page, html) not in stored:
            stored.add((page, html))
            to = None
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), sha, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 8, 9])
def test_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    folder = (tmp_path / "out").as_uri()
    warc.write_warc(df, folder, Stages(spark), least_bytes=least, file_bytes=600, shard_bytes=64)
    got = warc.read_warc(spark, folder).collect()
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(rows, key=str) == want(PAGES, least)
    names = {p.name for p in (tmp_path / "out").iterdir()}
    assert "_temporary" not in names and len([n for n in names if n.endswith(".gz")]) > 3


def test_payloads_survive_and_files_are_the_same_again(spark, tmp_path):
    df = spark.createDataFrame(PAGES[:9], "page_id long, url string, html string")
    made = []
    for k, n in enumerate((1, 4)):
        folder = tmp_path / f"out{k}"
        warc.write_warc(df.repartition(n), folder.as_uri(), Stages(spark), shard_bytes=64)
        made.append({p.name: p.read_bytes() for p in sorted(folder.glob("*.gz"))})
    assert made[0] == made[1]
    got = {(r.page_id, r.payload) for r in warc.read_warc(spark, folder.as_uri(), with_payload=True).collect() if r.payload}
    assert (3, PAGES[2][2]) in got and (-7, PAGES[8][2]) in got
    text = b"".join(gzip.decompress(b) for b in made[0].values()).decode()
    assert "WARC-Target-URI: http://a/3%0D%0AX:%20y\r\n" in text


def test_empty_table_and_clashing_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "h", 3)], "page_id long, url string, html string, sha int")
    assert warc.write_warc(df, (tmp_path / "a").as_uri(), Stages(spark)).count() == 1
    warc.write_warc(df.limit(0), (tmp_path / "b").as_uri(), Stages(spark))
    assert warc.read_warc(spark, (tmp_path / "b").as_uri()).collect() == []
    assert not list(pathlib.Path(tmp_path / "b").glob("*.gz"))


def test_broken_archives_are_refused():
    packed = warc.page_record("1", "u", b"abc", None, False, "1970-01-01T00:00:00Z")
    headers, block = warc.parse(gzip.decompress(packed))
    with pytest.raises(ValueError, match="digest"):
        warc.page_of(headers, block[:-1] + b"x", False)
    with pytest.raises(ValueError, match="shorter"):
        warc.parse(gzip.decompress(packed)[:-9])
