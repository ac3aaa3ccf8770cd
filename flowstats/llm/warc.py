"""WARC archives of pages: one Zstandard frame per record, with a shared dictionary in a leading skippable frame.

The writer stores each archive as a file in the shared folder. The reader takes the dictionary from the skippable
frame, decodes one frame per record, and validates every header and length before it returns the record.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowstats.llm.common import cut, open_store, shared_dir

# Fixed values of the file formats.
DICTIONARY_FRAME = 0x184D2A5D  # the skippable frame that may hold a dictionary, raw or compressed
FRAME_MAGIC = 0xFD2FB528
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"
#: Headers that a record may hold several times; their values are joined by blanks.
REPEATABLE = ("warc-concurrent-to",)
#: Payloads below this many bytes are always written whole.
MIN_REVISIT_BYTES = 100
#: A new archive begins once this many bytes of records were compressed into one.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is fitted on the records at the head of each archive, this many bytes at most.
DICTIONARY_SAMPLE_BYTES = 512 << 10
DICTIONARY_BYTES = 32 << 10


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def record_id(page_id: int | None, serial: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{serial}')}>"


def encode_record(page_id, url, payload: bytes, digest: str, payload_bytes: int, refers_to, serial: int = 0) -> bytes:
    """One record: headers, blank line, block, two line ends. A revisit has no block; its headers name the response."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, serial)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(payload_bytes)),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # A header value is one line; anything else in the address is written as escapes.
        headers.insert(2, ("WARC-Target-URI", url.encode("unicode_escape").decode("ascii")))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, 0)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    head = "\r\n".join([WARC_VERSION, *(f"{k}: {v}" for k, v in headers)])
    return head.encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; raises WarcError if a header, length or line end is wrong."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError("a record has no end of headers")
    try:
        lines = record[:end].decode("utf-8").split("\r\n")
    except UnicodeDecodeError as e:
        raise WarcError(f"headers are not UTF-8: {e}") from e
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"unknown version line {lines[0]!r}")
    headers = {}
    for line in lines[1:]:
        name, sep, value = line.partition(":")
        if not sep or not name or name != name.strip():
            raise WarcError(f"malformed header {line!r}")
        name, value = name.lower(), value.strip()
        if name not in headers:
            headers[name] = value
        elif name in REPEATABLE:
            headers[name] += " " + value
        else:
            raise WarcError(f"header {name} occurs twice")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"missing header {name}")
    if not headers["content-length"].isdigit():
        raise WarcError("Content-Length is not a number")
    length = int(headers["content-length"])
    block, rest = record[end + 4 : end + 4 + length], record[end + 4 + length :]
    if len(block) != length or rest != b"\r\n\r\n":
        raise WarcError(f"Content-Length {length} does not match the record")
    return headers, block


def encode_archive(records: list[bytes], level: int = 3) -> bytes:
    """The file's bytes: the dictionary in a skippable frame, if one could be fitted, then a frame per record."""
    sample, held = [], 0
    for r in records:
        if held >= DICTIONARY_SAMPLE_BYTES:
            break
        sample.append(r[:DICTIONARY_BYTES])
        held += len(sample[-1])
    try:
        fitted = zstandard.train_dictionary(
            min(DICTIONARY_BYTES, max(256, held // 10)), sample, k=200, d=8, level=level
        )
        out = [struct.pack("<II", DICTIONARY_FRAME, len(fitted.as_bytes())), fitted.as_bytes()]
    except zstandard.ZstdError:  # too few or too uniform records
        fitted, out = None, []
    if fitted is not None:
        fitted.precompute_compress(level=level)
    packer = zstandard.ZstdCompressor(level=level, dict_data=fitted, write_checksum=True, write_content_size=True)
    return b"".join([*out, *map(packer.compress, records)])


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends: header, blocks of declared sizes, checksum."""
    try:
        size = zstandard.frame_header_size(data[at : at + 18])
        checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise WarcError(f"a frame has no valid header: {e}") from e
    at += size
    while True:
        if at + 3 > len(data):
            raise WarcError("a frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        kind, length = (head >> 1) & 3, head >> 3
        if kind == 3:
            raise WarcError("reserved block type")
        at += 3 + (1 if kind == 1 else length)
        if head & 1:
            break
    at += 4 * checksum
    if at > len(data):
        raise WarcError("a frame is cut off")
    return at


def _decompress(unpacker: zstandard.ZstdDecompressor, frame) -> bytes:
    """The content of one whole frame, whether or not its header says how long it is."""
    try:
        reader = unpacker.decompressobj()
        content = reader.decompress(bytes(frame))
    except zstandard.ZstdError as e:
        raise WarcError(f"a frame cannot be decoded: {e}") from e
    if not reader.eof or reader.unused_data:
        raise WarcError("a frame is cut off")
    return content


def decode_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive; raises WarcError where it breaks the format."""
    data, at, fitted = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        length = struct.unpack_from("<I", data, 4)[0]
        if 8 + length > len(data):
            raise WarcError("the dictionary frame is cut off")
        raw, at = bytes(data[8 : 8 + length]), 8 + length
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
            raw = _decompress(zstandard.ZstdDecompressor(), raw)
        fitted = zstandard.ZstdCompressionDict(raw)
    unpacker = zstandard.ZstdDecompressor(dict_data=fitted)
    while at < len(data):
        if at + 8 > len(data):
            raise WarcError("trailing bytes")
        magic = struct.unpack_from("<I", data, at)[0]
        if 0x184D2A50 <= magic <= 0x184D2A5F:  # other skippable frames carry no record
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                raise WarcError("a skippable frame is cut off")
            continue
        if magic != FRAME_MAGIC:
            raise WarcError("neither a frame nor a skippable frame")
        end = _frame_end(data, at)
        yield decode_record(_decompress(unpacker, data[at:end]))
        at = end


def plan_records(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to) of every page.

    The first page id of each digest is a partial aggregation over (digest, id), so thousands of equal payloads meet
    as one row per task; only digests that occur twice are joined back, and adaptive execution splits a digest that
    holds many rows.
    """
    payload = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = (
        pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", F.sha2("payload", 256))
    )
    first = (
        rows.where((F.col("payload_bytes") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page"))
        .where("first_page < last_page")
        .select(F.col("payload_digest").alias("of"), "first_page")
    )
    later = (F.col("page_id") != F.col("first_page")) | F.col("page_id").isNull()
    return rows.join(first, F.col("payload_digest") == F.col("of"), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("first_page").isNotNull() & later, F.col("first_page")).alias("refers_to"),
    )


def _row(headers: dict[str, str], block: bytes) -> tuple:
    """A record as a row of `_READ_SCHEMA`."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"a record of type {kind}")
    for name in ("warc-payload-digest", "x-payload-length", "x-page-id"):
        if name not in headers:
            raise WarcError(f"missing header {name}")
    digest, page, refers = headers["warc-payload-digest"].removeprefix("sha256:"), headers["x-page-id"], headers.get("x-refers-to-page")
    try:
        length, page_id, refers_to = int(headers["x-payload-length"]), int(page) if page else None, int(refers) if refers else None
        url = headers.get("warc-target-uri")
        url = url and url.encode("ascii").decode("unicode_escape")
    except ValueError as e:
        raise WarcError(f"a header value is malformed: {e}") from e
    if kind == "response" and (len(block) != length or hashlib.sha256(block).hexdigest() != digest):
        raise WarcError("the payload does not match its headers")
    return page_id, url, block if kind == "response" else None, length, digest, kind, refers_to


def write_archives(records: DataFrame, out_dir: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records as archives under `out_dir`; returns the manifest (path, records, bytes).

    Every task attempt writes under names of its own, and only the manifest says which files count, so files of a
    lost or repeated attempt are never read. The manifest is written to the shared folder before it is used.
    """

    def run(batches):
        store, root = open_store(out_dir)
        store.create_dir(root, recursive=True)
        held, size = [], 0

        def flush():
            name = f"{root}/{uuid.uuid4().hex}.warc.zst"
            content = encode_archive(held)
            with store.open_output_stream(name) as f:
                f.write(content)
            return pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "bytes": [len(content)]})

        for batch in batches:
            cols = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                held.append(encode_record(cols[0][i].as_py(), cols[1][i].as_py(), cols[2][i].as_py(),
                                          cols[4][i].as_py(), cols[3][i].as_py(), cols[5][i].as_py(), len(held)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return cut(records.mapInArrow(run, "path string, records long, bytes long"))


def read_archives(manifest: DataFrame, out_dir: str, tasks: int | None = None) -> DataFrame:
    """One row per record of the archives of a manifest: its headers and the block, validated.

    (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to). A response's length and digest
    are computed from its block and must equal its headers; a wrong header, length or digest raises WarcError. An
    empty manifest gives an empty result.
    """

    def run(batches):
        store, _ = open_store(out_dir)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path) as f:
                    content = f.read()
                rows = []
                records = decode_archive(content)
                while True:
                    try:
                        record = next(records, None)
                        if record is None:
                            break
                        rows.append(_row(*record))
                    except WarcError as e:
                        raise WarcError(f"{path}: {e}") from e
                    if len(rows) == 512:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    source = manifest.select("path")
    return (source.repartition(tasks) if tasks else source).mapInArrow(run, _READ_SCHEMA)


_READ_SCHEMA = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
_ARROW_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW_SCHEMA, strict=True)], schema=_ARROW_SCHEMA)


def archive_pages(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) to archives and read them back.

    A null html has an empty payload; payloads under MIN_REVISIT_BYTES bytes are always responses; of rows with equal
    longer payloads those with the smallest page id are responses (a repeated row of that page too), the others
    revisit it. A null page id is kept and never referred to. Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    out_dir = out_dir or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(plan_records(pages), out_dir)
    n = manifest.count()
    return read_archives(manifest, out_dir, max(1, n))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY ALL)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
    CASE WHEN f.first_page < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN f.first_page < p.page_id THEN f.first_page END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
