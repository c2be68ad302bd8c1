"""Pages to WARC records in ZIP archives and back, as Spark jobs.

Payload digests are taken first; an aggregate that combines before the shuffle finds, for each payload, the
largest page id, whose record is the response. Each task streams its pages into archives of about
``archive_bytes`` in a shared folder, under names no other attempt uses, and returns them as rows; only the archives of tasks
that Spark committed are read. Reading lists every archive's index, deals the record ranges out evenly, and
reads each record by its range.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import row_key, stage, stage_path
from .words import chunks
from .zipstore import Writer, digest, index_lines, read_at, record

_LIST = 2000


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _uri(folder: str) -> str:
    """file:/x as file:///x, as Arrow wants it."""
    return "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(_uri(folder))
        name = out = writer = None
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            nonlocal writer
            if writer is not None:
                done.append((name, writer.close(), len(writer.index)))
                out.close()
                writer = None

        for batch in batches:
            for part in chunks(batch, "html"):
                for row in part.to_pylist():
                    if writer is None:
                        name = f"pages-{uuid.uuid4().hex}.zip"
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}")
                        writer = Writer(out)
                    payload = (row["html"] or "").encode()
                    writer.add(record(row["page_id"], row["url"], payload, row["refers_to"], digest(payload)))
                    if writer.at >= archive_bytes:
                        close()
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["name", "size", "records"])

    return run


def write_archives(
    pages: DataFrame, folder: str, archive_bytes: int = 256 << 20, least_payload: int = 0,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write one record per row of ``pages``; a staged table of the archives (name, size, records).

    Null html is an empty payload. Of rows with equal payloads of at least ``least_payload`` bytes, those with the
    largest page id are responses (a repeated id gives several) and others revisit it. A null id never is the
    largest; payloads without any id are all responses. Other columns are not read.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    names = rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha1"), *row_key("page_id", "html")).where(
        F.octet_length("html") >= least_payload)
    largest = names.groupBy("sha1").agg(F.max("page_id").alias("holder"))
    # only pages that revisit another one take part in the join with the payloads
    revisits = names.join(largest, "sha1").where("holder is not null and not page_id <=> holder")
    revisits = revisits.select("k1", "k2", F.col("holder").alias("refers_to")).distinct()
    dealt = rows.withColumns({k: c for k, c in zip(("k1", "k2"), row_key("page_id", "html"), strict=True)}).join(revisits, ["k1", "k2"], "left")
    written = dealt.select("page_id", "url", "html", "refers_to").mapInArrow(_write(folder, archive_bytes), "name string, size bigint, records bigint")
    return stage(written, "archives")


def _list(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(_uri(folder))
        for batch in batches:
            for name, size in zip(batch.column("name").to_pylist(), batch.column("size").to_pylist(), strict=True):
                with fs.open_input_file(f"{root}/{name}") as file:
                    block: list[tuple[int, int]] = []
                    for line in index_lines(file, size):
                        block.append(line)
                        if len(block) == _LIST:
                            yield _ranges(name, block)
                            block = []
                    if block:
                        yield _ranges(name, block)

    return run


def _ranges(name: str, block: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(block)), pa.array([b[0] for b in block]), pa.array([b[1] for b in block])], ["name", "at", "n"])


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(_uri(folder))
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        number = lambda urn: None if urn is None or urn == "<urn:page:none>" else int(urn[10:-1])
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            current = file = None
            for name, at, n in zip(*(batch.column(c).to_pylist() for c in ("name", "at", "n")), strict=True):
                if name != current:
                    if file is not None:
                        file.close()
                    current, file = name, fs.open_input_file(f"{root}/{name}")
                fields, block = read_at(file, at, n)
                sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = fields["WARC-Type"]
                if kind == "response" and (digest(block) != sha1 or len(block) != int(fields["Payload-Length"])):
                    raise ValueError(f"record at {at} of {name} does not match its digest")
                rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["Payload-Length"]), sha1, kind,
                             number(fields.get("WARC-Refers-To")), block if kind == "response" else None))
                held += len(block)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)
                    rows, held = [], 0
            if file is not None:
                file.close()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return run


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The payload of a response is checked against its digest and length; revisits carry none (null).
    """
    ranges = archives.mapInArrow(_list(folder), "name string, at bigint, n bigint")
    even = ranges.repartition("name", F.floor(F.col("at") / (4 << 20))).sortWithinPartitions("name", "at")
    return even.mapInArrow(
        _read(folder), "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read all records back."""
    folder = stage_path(spark, "warc")
    return read_archives(write_archives(pages, folder), folder)
