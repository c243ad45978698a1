"""Legacy web archives: ARC records become WARC records with equivalent identifiers, timestamps, types and digests."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import join_counted, new_path, staged, table, width

#: Payload bytes of an ARC file, and the least of one that is only written so that all tasks have work. A reading task holds
#: a file compressed and a record at a time.
FILE_BYTES, LEAST_FILE_BYTES = 64_000_000, 4_000_000
#: Equal payloads of fewer bytes are all written out.
LEAST_REVISIT = 100
#: Effort of the compression.
LEVEL = 4
_GZIP, _NEAR = b"\x1f\x8b", 1 << 20
#: Rows of records that revisit others up to which all tasks get them all (about 20 MB).
BROADCAST_REVISITS = 200_000
#: Records in which a task hands bytes on.
_ROWS = 64

# Fixed field names of the two versions of ARC header lines.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_STAMP = "%04d%02d%02d000000"
_VERSION = re.compile(rb"\d+ \d+ [^\r\n]*\r?\nURL IP-address ")
_PAGE = re.compile(r"^X-Page-Id: (-?\d+)\r?$", re.M)


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own, without the member's last byte.

    That byte is the highest of the record's length, zero below 16 MB; ``_write`` puts it there as its line separator. A
    longer record is followed by an empty member, which ends in a zero too.
    """
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    packed = packer.compress(record) + packer.flush()
    if packed[-1]:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed += packer.compress(b"") + packer.flush()
    return packed[:-1]


def _write(members: DataFrame, path: str) -> None:
    """Writes a column ``value`` of gzip members, a file a partition."""
    members.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def _unzipped(content: bytes) -> io.BufferedReader:
    """Bytes of a file of gzip members, or of a plain one, as a stream."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 18)


def _parts(block: bytes) -> tuple[bytes, bytes, bytes]:
    """HTTP header, the blank line after it and payload; a block without a status line is all payload, one without a blank line all header."""
    if not block.startswith(b"HTTP/"):
        return b"", b"", block
    cut = re.search(rb"\r?\n\r?\n", block)
    return (block[: cut.start()], cut[0], block[cut.end() :]) if cut else (block, b"", b"")


def _exactly(stream: io.BufferedReader | io.BytesIO, length: int, what: str) -> bytes:
    block = stream.read(length)
    if len(block) < length:
        raise ValueError(f"{what} declares {length} bytes and has {len(block)}")
    return block


def arc_records(pages: pd.DataFrame, version: str, name: str) -> Iterator[bytes]:
    """A record for each page, with its closing line feed."""
    for row in pages.itertuples(index=False):
        body = (row.html or "").encode()
        known = "" if pd.isna(row.page_id) else f"X-Page-Id: {row.page_id}\r\n"
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}\r\n".encode()
        url = re.sub(r"\s", lambda m: "".join("%%%02X" % b for b in m[0].encode()), row.url or "") or "about:blank"
        k = 0 if pd.isna(row.page_id) else int(row.page_id)
        stamp = _STAMP % (2000 + k % 20, 1 + k % 12, 1 + k % 28)
        extra = f"200 - - 0 {name}.arc " if version == "2" else ""
        yield f"{url} 0.0.0.0 {stamp} text/html {extra}{len(head) + len(body)}\n".encode() + head + body + b"\n"


def arc_start(version: str, name: str) -> bytes:
    """The version block that a file begins with."""
    origin = f"{version} 0 tempoframe\n{ARC_FIELDS[version]}\n"
    extra = f"200 - - 0 {name}.arc " if version == "2" else ""
    return f"filedesc://{name}.arc 0.0.0.0 20240101000000 text/plain {extra}{len(origin)}\n{origin}\n".encode()


def parse_arc(content: bytes, salvage: bool = False) -> Iterator[dict]:
    """``read_records``, or, with ``salvage``, what of them can be read: of a damaged record a dict with ``kind`` 'damaged', its place and the ``error``.

    In a file of gzip members reading goes on at the next member, so that only the damaged ones are lost; of any other file the rest is lost.
    """
    if not salvage:
        yield from read_records(_unzipped(content))
        return
    at, fields, version = -1, None, None
    for part in _separate(content):
        try:
            for r in read_records(io.BytesIO(_inflated(part) if part[:2] == _GZIP else part), fields, version, at):
                at, fields, version = r["at"], r["fields"], r["arc_version"]
                yield r
        except (ValueError, EOFError, OSError, zlib.error) as e:
            at += 1
            yield {"at": at, "kind": "damaged", "error": f"{type(e).__name__}: {e}"}


def _separate(content: bytes) -> Iterator[bytes]:
    """The gzip members of a file, a damaged one up to where the next begins; a file that is not gzipped as it is."""
    if content[:2] != _GZIP:
        yield content
        return
    at, n = 0, len(content)
    while at < n:
        unpacker, end = zlib.decompressobj(31), at
        try:
            while not unpacker.eof:
                if end >= n:
                    raise EOFError("a gzip member is cut off")
                unpacker.decompress(content[end : end + _NEAR])
                end = min(n, end + _NEAR)
            end -= len(unpacker.unused_data)
        except (zlib.error, EOFError):
            found = content.find(_GZIP + b"\x08", at + 1)
            end = found if found > 0 else n
        yield content[at:end]
        at = end


def _inflated(part: bytes) -> bytes:
    unpacker = zlib.decompressobj(31)
    made = unpacker.decompress(part) + unpacker.flush()
    if not unpacker.eof:
        raise EOFError("a gzip member is cut off")
    return made


def read_records(stream: io.BufferedReader | io.BytesIO, fields: list[str] | None = None, version: str | None = None, at: int = -1) -> Iterator[dict]:
    """Records of an ARC file of either version, gzipped as a whole or by records, or plain.

    A version block tells which fields the header lines after it have; each header line declares the length of what
    follows. ``kind`` is ``version`` for such a block, ``http`` for a record that begins with a status line and
    ``other`` for any other (names resolved, other protocols), whose ``http`` is empty. URLs that hold blanks are kept.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        at += 1
        line = line.rstrip(b"\r\n")
        named = line.startswith(b"filedesc://")
        if not named and fields is None:
            raise ValueError("the file does not begin with an ARC version block")
        block = _exactly(stream, int(line.rsplit(b" ", 1)[-1]), "an ARC record")
        start = named and (fields is None or _VERSION.match(block) is not None)  # a page may have such an address too
        if start:
            version = block.split(b" ", 1)[0].decode("ascii", "replace")
            if version not in ARC_FIELDS:
                raise ValueError(f"no ARC version {version!r}")
            fields = ARC_FIELDS[version].split(" ")
        parts = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(parts) != len(fields):
            raise ValueError(f"record {at} does not have the {len(fields)} fields of its version")
        values = dict(zip(fields, parts, strict=True))
        header, gap, payload = _parts(block)
        yield {
            "at": at, "kind": "version" if start else "http" if header else "other", "url": values["URL"], "ip": values["IP-address"],
            "stamp": values["Archive-date"].ljust(14, "0"), "content_type": values["Content-type"], "http": header, "gap": gap,
            "payload": payload, "arc_version": version, "fields": fields,
        }


def _date(stamp: str) -> str:
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"


def record_id(file: str, at: int) -> str:
    """The identifier of an ARC file's record, which a repeated conversion makes again."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{at}').urn}>"


def warc_record(file: str, record: dict, first: tuple[str, int, str] | None = None) -> bytes:
    """One WARC record with its closing blank lines; ``first`` is file, place and stamp of the record that it revisits."""
    if record["kind"] == "version":
        block = f"software: tempoframe\r\nformat: WARC File Format 1.1\r\nsource: {file} (ARC version {record['arc_version']})\r\n".encode()
        kind, media, extra = "warcinfo", "application/warc-fields", [f"WARC-Filename: {file}"]
    else:
        media = "application/http; msgtype=response" if record["kind"] == "http" else record["content_type"]
        kind = "revisit" if first else "response" if record["kind"] == "http" else "resource"
        digest = hashlib.sha256(record["payload"]).hexdigest()
        block = record["http"] + record["gap"] + (b"" if first else record["payload"])
        extra = [f"WARC-Target-URI: {record['url']}", f"WARC-IP-Address: {record['ip']}", f"WARC-Payload-Digest: sha256:{digest}"]
    if first:
        extra += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(*first[:2])}",
            f"WARC-Refers-To-Date: {_date(first[2])}",
        ]
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(file, record['at'])}", f"WARC-Date: {_date(record['stamp'])}", *extra,
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Type: {media}", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(content: bytes) -> Iterator[dict]:
    """Header fields and block of each record of a WARC file, by the declared lengths."""
    stream, k = _unzipped(content), 0
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"record {k} of the file is no WARC record")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n").decode()) != "":
            name, _, value = line.partition(": ")
            fields[name] = value
        block = _exactly(stream, int(fields["Content-Length"]), "a WARC record")
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"WARC record {k} does not end where it declares")
        yield fields | {"block": block}
        k += 1


def write_arc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Writes ``pages`` (page_id, url, html) as ARC files of about ``file_bytes``, a gzip member a record; every other file is of version 2."""
    total = int(pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0)
    files = max(-(-total // file_bytes), min(width(pages.sparkSession), -(-total // LEAST_FILE_BYTES)), 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyspark

        k = pyspark.TaskContext.get().partitionId()
        version, name, begun = "12"[k % 2], f"part{k:06d}", False
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                made = [] if begun else [member(arc_start(version, name))]
                begun = True
                yield pd.DataFrame({"value": made + [member(r) for r in arc_records(batch.iloc[a : a + _ROWS], version, name)]})

    dealt = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html").repartition(files, F.xxhash64("page_id", "url"))
    _write(dealt.mapInPandas(run, "value binary"), path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


_ARC = "file string, at long, kind string, url string, stamp string, page_id long, digest string, size long"


def read_arc(spark: SparkSession, path: str, payloads: bool = False, salvage: bool = False) -> DataFrame:
    """Records of the ARC files in ``path``, without version blocks: where they are, what their header says, digest and size of the
    payload, ``page_id`` where the HTTP header names one, and the payload itself if asked for.

    A damaged record raises an error; with ``salvage`` it has a row of ``kind`` 'damaged' with the error as its ``url``, and the others are read (see ``parse_arc``).
    """
    columns = [c.split(" ")[0] for c in _ARC.split(", ")] + ["payload"] * payloads

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                rows = []
                for r in parse_arc(content, salvage):
                    if r["kind"] == "version":
                        continue
                    if r["kind"] == "damaged":
                        rows.append({"file": file, "at": r["at"], "kind": "damaged", "url": r["error"]})
                        continue
                    page = _PAGE.search(r["http"].decode("utf-8", "replace"))
                    rows.append(r | {"file": file, "page_id": int(page[1]) if page else None, "digest": hashlib.sha256(r["payload"]).hexdigest(), "size": len(r["payload"])})
                    if len(rows) == (_ROWS if payloads else 4096):
                        yield _frame(rows, columns)
                        rows = []
                yield _frame(rows, columns)

    return _contents(spark, path).mapInPandas(run, _ARC + ", payload binary" * payloads)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=columns)
    return made.astype({c: "Int64" for c in ("page_id", "payload_bytes") if c in columns})


def _revisits(records: DataFrame) -> DataFrame:
    """``file``, ``at`` and ``first`` (file, at, stamp) of HTTP records whose payload another record has first: that with the
    smallest page_id, records without one last, then by file and place."""
    long = records.where((F.col("kind") == "http") & (F.col("size") >= LEAST_REVISIT))
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "file", "at", "stamp")
    firsts = long.groupBy("digest").agg(F.min(order).alias("head"), F.count("*").alias("copies")).where("copies > 1")
    joined = join_counted(long.select("digest", "file", "at"), staged(firsts, "firsts"), ["digest"])
    return joined.where("file <> head.file or at <> head.at").select("file", "at", F.struct("head.file", "head.at", "head.stamp").alias("first"))


def convert(spark: SparkSession, arc: str, path: str, salvage: bool = False) -> None:
    """Writes WARC files in ``path`` of the ARC files in ``arc``, a gzip member a record.

    Version blocks become warcinfo records, HTTP records responses or revisits of an earlier equal payload of ``LEAST_REVISIT`` bytes or more,
    all others resources. Which records revisit is found on digests alone; the files are then read again, each with its
    own list. That goes to all tasks while it is short, so that files stay where they are read; a longer one meets its compressed file in a shuffle.
    A damaged record raises an error; with ``salvage`` it is left out (``read_arc`` names it).
    """
    records = staged(read_arc(spark, arc, salvage=salvage).select("file", "at", "kind", "stamp", "page_id", "digest", "size"), "records")
    revisits = staged(_revisits(records), "revisits")
    again = revisits.groupBy("file").agg(F.collect_list(F.struct("at", "first")).alias("again"))
    files = _contents(spark, arc)
    if revisits.count() <= BROADCAST_REVISITS:
        dealt = files.join(F.broadcast(again), "file", "left")
    else:
        dealt = files.repartition(max(1, files.select("file").count()), "file").join(again.hint("shuffle_hash"), "file", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content, revisits in batch[["file", "content", "again"]].itertuples(index=False, name=None):
                first = {r["at"]: (r["first"]["file"], r["first"]["at"], r["first"]["stamp"]) for r in (() if revisits is None else revisits)}
                made = []
                for record in parse_arc(content, salvage):
                    if record["kind"] == "damaged":
                        continue
                    made.append(member(warc_record(file, record, first.get(record["at"]))))
                    if len(made) == _ROWS:
                        yield pd.DataFrame({"value": made})
                        made = []
                yield pd.DataFrame({"value": made})

    _write(dealt.mapInPandas(run, "value binary"), path)


_WARC = "record_id string, record_type string, date string, url string, page_id long, payload_bytes long, payload_digest string, refers_to_id string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses, revisits and resources in the WARC files of ``path``, checked against their digests. A revisit's payload
    is elsewhere: its ``payload_bytes`` is null."""
    columns = [c.split(" ")[0] for c in _WARC.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for f in parse_warc(content):
                    kind, block = f["WARC-Type"], f["block"]
                    if kind == "warcinfo":
                        continue
                    header, _, payload = (b"", b"", block) if kind == "resource" else _parts(block)
                    page = _PAGE.search(header.decode("utf-8", "replace"))
                    digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"the payload of {f['WARC-Record-ID']} does not have its digest")
                    rows.append((
                        f["WARC-Record-ID"], kind, f["WARC-Date"], f["WARC-Target-URI"], int(page[1]) if page else None,
                        None if kind == "revisit" else len(payload), digest, f.get("WARC-Refers-To"),
                    ))
                yield _frame(rows, columns)

    return _contents(spark, path).mapInPandas(run, _WARC)


def convert_pages(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Takes pages through ARC files and their conversion, and returns the WARC records as read back.

    One row per input row: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` ('response' or 'revisit'),
    ``refers_to`` (page of the response that a revisit names), ``record_id``, ``date`` and ``url``. A null html is an empty payload,
    a null or empty url is about:blank, white space in a url is escaped. Rows without a page_id have records too, which
    come back without one. Of rows that repeat a page_id and payload one is the response and the others revisit it; with
    different payloads they are separate records of one page. An empty table gives no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if source.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, date string, url string")
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(source, arc, file_bytes)
    convert(spark, arc, warc)
    records = staged(read_warc(spark, warc), "records")
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date", "url")


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``refers_to`` and a revisit's ``payload_bytes``, found at the record that it names."""
    again = records.where("record_type = 'revisit'").drop("payload_bytes").withColumnRenamed("refers_to_id", "named")
    named = again.groupBy("named").agg(F.count("*").alias("copies"))
    heads = records.where("record_type = 'response'").select(F.col("record_id").alias("named"), F.col("page_id").alias("refers_to"), "payload_bytes")
    found = join_counted(again, staged(named.join(heads, "named"), "named"), ["named"])
    none: Column = F.lit(None).cast("long")
    others = records.where("record_type <> 'revisit'").withColumn("refers_to", none)
    cols = ["record_id", "record_type", "date", "url", "page_id", "payload_bytes", "payload_digest", "refers_to"]
    return others.select(*cols).unionAll(found.select(*cols))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for each page, converted from ARC and read back."""
    return convert_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = {
    "op8_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (
  SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS head FROM p
  WINDOW w AS (PARTITION BY d, n >= {LEAST_REVISIT} ORDER BY page_id NULLS LAST))
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN k > 1 AND n >= {LEAST_REVISIT} THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k > 1 AND n >= {LEAST_REVISIT} THEN head END AS refers_to
FROM r
"""
}
