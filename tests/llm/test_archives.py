import io
import random
import zipfile
from collections import Counter

import pytest

from patchlode.llm.archives import read_archives, write_archives
from patchlode.llm.zipstore import DATA, INDEX, Writer, digest, index_lines, members, read_at, record


@pytest.mark.parametrize("limit", [0xFFFFFFFF, 1, 300])
def test_archive_round_trip(limit):
    out = io.BytesIO()
    writer = Writer(out, zip64_from=limit)
    rng = random.Random(1)
    payloads = [b"", b"\r\n\r\n", "é".encode() * 9, rng.randbytes(5000)]
    for i, p in enumerate(payloads):
        writer.add(record(i, "http://x/ y\n", p, 7 if i == 2 else None, digest(p)))
    size = writer.close()
    assert size == len(out.getvalue())
    found = [read_at(out, *line) for line in index_lines(out, size)]
    assert [b for _, b in found] == [payloads[0], payloads[1], b"", payloads[3]]
    assert found[2][0]["WARC-Refers-To"] == "<urn:page:7>" and found[2][0]["WARC-Payload-Digest"] == "sha1:" + digest(payloads[2])
    plain = zipfile.ZipFile(io.BytesIO(out.getvalue()))  # another reader agrees
    assert plain.namelist() == [DATA, INDEX] and plain.testzip() is None
    at, n = members(out, size)[INDEX]
    assert plain.read(INDEX) == out.getvalue()[at : at + n]


def test_broken_archives():
    with pytest.raises(ValueError):
        members(io.BytesIO(b"nothing here"), 12)
    out = io.BytesIO()
    writer = Writer(out)
    writer.add(record(1, None, b"x", None, digest(b"x")))
    size = writer.close()
    with pytest.raises(ValueError):
        members(io.BytesIO(out.getvalue()[: size // 2]), size)


def test_pages_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "same" if i % 3 else f"page {i} é" * (i % 50), 1) for i in range(60)]
    rows += [(100, None, None, 1), (101, "u", "", 1), (None, "n", "same", 1), (None, "n", "only without id", 1), (59, "again", "same", 1), (7, "x", "big " * 100_000, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, holder int").repartition(5)
    folder = str(tmp_path / "warc")
    archives = write_archives(pages, folder, archive_bytes=3000)
    assert archives.count() > 2
    found = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None) for r in read_archives(archives, folder).collect())
    expected = Counter()
    for i, _, html, _ in rows:
        p = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        holder = max(ids) if ids else None
        revisit = holder is not None and i != holder
        expected[(i, len(p), digest(p), "revisit" if revisit else "response", holder if revisit else None, None if revisit else p)] += 1
    assert found == expected


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert read_archives(write_archives(pages, str(tmp_path)), str(tmp_path)).count() == 0
