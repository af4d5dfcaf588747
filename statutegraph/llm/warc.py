"""WARC archives as a PySpark Python data source, reader and writer.

    spark.dataSource.register(WarcDataSource)
    spark.read.format("warc").load(folder).filter("record_type = 'response'")

The reader plans partitions from file sizes, large files in pieces, takes over
predicates on record headers, reads each record's headers first and skips the
payload of a record that no predicate wants.  What is no record, a header
without a colon, a length that is no number, costs no more than itself.  The
writer rolls files by size; a task's files count from the commit of the job on.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import operator
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from ..storage import new_path
from .common import staged, with_group, without_group
from .exact import hash_of, marked, may_be_among

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, payload_bytes long, "
    "refers_to string, intact boolean, headers map<string,string>, payload binary"
)
#: Columns whose predicates the reader evaluates on headers, before any payload.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 64 << 20
#: Own files are read whole, as they are about as large as a piece.
FILE_BYTES = PARTITION_BYTES


def base32_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1, as WARC archives write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Control characters would end a header line; they are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _plain(name: str, value: str) -> str:
    """What a column shows of a header: ids without angle brackets, digests without the algorithm."""
    if name in ("record_id", "refers_to"):
        return value.strip("<>")
    return value.removeprefix("sha1:") if name == "payload_digest" else value


@dataclass
class Pieces(InputPartition):
    """(path, start, end): records that begin there; end None is that of the file."""

    pieces: list[tuple[str, int, int | None]]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


_COMPARE = {EqualTo: operator.eq, EqualNullSafe: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
_COMPARE |= {StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: operator.contains}


def header_test(f: Filter) -> tuple[str, Callable[[str | None], bool]] | None:
    """The header column of a filter and its test of a value, null where the header is missing; None if it is none of ours."""
    if isinstance(f, Not):
        inner = header_test(f.child)
        if inner is None or isinstance(f.child, (IsNull, IsNotNull, EqualNullSafe, Not)):
            return None
        return inner[0], lambda v: v is not None and not inner[1](v)
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADER_OF:
        return None
    if isinstance(f, IsNull):
        return column, lambda v: v is None
    if isinstance(f, IsNotNull):
        return column, lambda v: v is not None
    if isinstance(f, In):
        values = {x for x in f.value if x is not None}
        return (column, lambda v: v in values) if len(values) == len(set(f.value)) else None
    if type(f) not in _COMPARE or (f.value is None and not isinstance(f, EqualNullSafe)):
        return None
    compare, value = _COMPARE[type(f)], f.value
    if value is None:
        return column, lambda v: v is None
    return column, lambda v: v is not None and compare(v, value)


class Member(io.RawIOBase):
    """The text of one gzip member that begins at `at` of a file; when it is read up, `end` is where the next may begin."""

    def __init__(self, file, at: int):
        file.seek(at)
        self.file, self.at, self.end = file, at, None
        self.inflate, self.left = zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.file.read(1 << 16)
            if not data:
                self.end = self.at
                return 0  # the file breaks off inside
            self.at += 0 if self.inflate.unconsumed_tail else len(data)
            got = self.inflate.decompress(data, len(out))
            if self.inflate.eof:
                self.end = self.at - len(self.inflate.unused_data)
            if got:
                out[: len(got)] = got
                return len(got)
        return 0


class WarcReader(DataSourceReader):
    """`payload`: true gives payloads, verify only checks them against their digests, false skips them."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower()
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, Callable[[str | None], bool]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            test = header_test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[Pieces]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(root) :].split("/") if x)
        files = sorted((x.path, x.size) for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz")) and not hidden(x.path))
        out: list[Pieces] = []
        room = 0
        for path, size in files:
            if size > 2 * self.partition_bytes:
                cuts = range(0, size, self.partition_bytes)
                out += [Pieces([(path, at, at + self.partition_bytes if at + self.partition_bytes < size else None)]) for at in cuts]
                room = 0
                continue
            if size > room or not out:
                out.append(Pieces([]))
                room = self.partition_bytes
            out[-1].pieces.append((path, 0, None))
            room -= size
        return out or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[tuple]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for path, start, end in partition.pieces:
            with fs.open_input_file(path) as raw:
                if not path.endswith(".gz"):
                    if start and (start := first_record(raw, start, end)) is None:
                        continue
                    raw.seek(start)
                    yield from self.records(io.BufferedReader(raw, 1 << 20), end)
                elif (start, end) == (0, None):
                    yield from self.records(gzip.GzipFile(fileobj=raw))
                else:
                    yield from self.members(raw, start, end)

    def members(self, raw, start: int, end: int | None) -> Iterator[tuple]:
        """Records of the gzip members that begin in a piece; that what begins there is one shows in its first bytes."""
        at, size = start, raw.size()
        while at < (size if end is None else end):
            raw.seek(at)
            window = raw.read((1 << 16) + 2)
            found = window.find(b"\x1f\x8b\x08")
            if found < 0:
                at += 1 << 16
                continue
            at += found
            if at >= (size if end is None else end):
                return
            try:
                begins = io.BufferedReader(Member(raw, at), 1 << 10).peek(5).startswith(b"WARC/")
            except zlib.error:
                begins = False
            if not begins:
                at += 1
                continue
            member = Member(raw, at)
            text = io.BufferedReader(member, 1 << 16)
            yield from self.records(text)
            while text.read(1 << 20):
                pass
            at = max(at + 1, member.end or 0)

    def records(self, file, end: int | None = None) -> Iterator[tuple]:
        """Records from where the file stands, up to the first of those from `end` on at which another piece begins."""
        at, line = file.tell() if file.seekable() else 0, file.readline()
        while line:
            if not line.startswith(b"WARC/"):
                at, line = at + len(line), file.readline()
                continue
            if end is not None and at >= end and is_first(file, at):
                return
            headers, n = read_headers(file)
            body = at + len(line) + n
            length = whole_number(headers.get("content-length"))
            values = {column: _plain(column, headers[name]) if name in headers else None for column, name in HEADER_OF.items()}
            wanted = all(test(values[column]) for column, test in self.tests)
            if length is None:  # goes on to the next line that begins a record
                if wanted:
                    yield (*(values[k] for k in _FIRST), None, values["refers_to"], False, headers, None)
                at, line = body, file.readline()
                continue
            if wanted:
                yield self.row(values, headers, file, length)
            else:
                skip(file, length)
            at, line = body + length, file.readline()

    def row(self, values: dict, headers: dict, file, length: int) -> tuple:
        head, rest = (b"", b"")
        if headers.get("content-type", "").lower().startswith("application/http"):
            head, rest = http_head(file, length)
        whole = values["record_type"] != "revisit"
        size = length - len(head)
        if not whole:  # its payload stands elsewhere; how long it is, its own HTTP headers say
            size = whole_number(next((x.split(b":", 1)[1].decode("latin-1") for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), None))
        payload = intact = None
        if whole and self.payload != "false":
            payload = rest + file.read(length - len(head) - len(rest))
            if values["payload_digest"]:
                intact = len(payload) == size and base32_digest(payload) == values["payload_digest"]
        else:
            skip(file, length - len(head) - len(rest))
        return (*(values[k] for k in _FIRST), size, values["refers_to"], intact, headers, payload if self.payload == "true" else None)


#: What ends a record and begins the next.
_BETWEEN = b"\r\n\r\nWARC/"


def _at_record(file, at: int) -> bool:
    """Whether a record with type, id and length begins at `at`, and after it another or the file's end."""
    file.seek(at)
    if not file.readline().startswith(b"WARC/"):
        return False
    headers, _ = read_headers(file)
    length = whole_number(headers.get("content-length"))
    if length is None or "warc-type" not in headers or "warc-record-id" not in headers:
        return False
    skip(file, length)
    return file.read(len(_BETWEEN)) in (_BETWEEN, b"\r\n\r\n")


def is_first(file, at: int) -> bool:
    """Whether first_record() would find the record at `at`, of which the first line was just read; the file stays where it is."""
    here = file.tell()
    file.seek(at - 4)
    found = file.read(len(_BETWEEN)) == _BETWEEN and _at_record(file, at)
    file.seek(here)
    return found


def first_record(raw, start: int, end: int | None) -> int | None:
    """Where the first record of a piece begins: after the end of another one, with a header that is whole.

    A payload that holds such records itself, an archive in the archive, may be taken for
    them; a larger `partitionBytes` leaves the file whole.
    """
    at, stop = start - 4, raw.size() if end is None else end
    while at + 4 < stop:
        raw.seek(at)
        window = raw.read((1 << 20) + len(_BETWEEN) - 1)
        found = window.find(_BETWEEN)
        if found < 0:
            at += 1 << 20
            continue
        if at + found + 4 >= stop:
            return None
        file = io.BufferedReader(raw, 1 << 12)
        good = _at_record(file, at + found + 4)
        file.detach()  # or else it closes the file
        if good:
            return at + found + 4
        at += found + 1
    return None


_FIRST = ("record_id", "record_type", "target_uri", "date", "payload_digest")


def whole_number(text: str | None) -> int | None:
    text = (text or "").strip()
    return int(text) if text.isascii() and text.isdigit() else None


def read_headers(file) -> tuple[dict[str, str], int]:
    """Headers up to the empty line, names in lower case, and how many bytes they took.

    A line that begins with white space goes on with the one before; one without a
    colon is passed over; of a name that repeats the values are joined by a comma.
    """
    headers, n, name = {}, 0, None
    while line := file.readline():
        n += len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text.strip():
            break
        if text[0] in " \t" and name is not None:
            headers[name] += f" {text.strip()}"
        elif ":" in text:
            name, value = (x.strip() for x in text.split(":", 1))
            name = name.lower()
            headers[name] = f"{headers[name]}, {value}" if name in headers else value
    return headers, n


def http_head(file, length: int) -> tuple[bytes, bytes]:
    """The head of an HTTP message up to its empty line, and what was read beyond it; all of it if there is none."""
    data = b""
    while len(data) < length:
        more = file.read(min(1 << 12, length - len(data)))
        if not more:
            break
        data += more
        at = data.find(b"\r\n\r\n", max(0, len(data) - len(more) - 3))
        if at >= 0:
            return data[: at + 4], data[at + 4 :]
    return data, b""


def skip(file, n: int) -> None:
    if file.seekable():
        file.seek(n, 1)
        return
    while n > 0 and (data := file.read(min(n, 1 << 20))):
        n -= len(data)


class WarcWriter(DataSourceWriter):
    """Rows: record_id, record_type, target_uri, date, refers_to, payload_digest, payload_bytes, payload.

    Tasks write into a folder of the job that readers pass over.  The commit moves
    the files of the tasks that count to their place and drops the folder, with
    all that lost, repeated or speculative tasks left in it.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.zip = options.get("compression", "none") == "gzip"
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.staging = f"_job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(f"{root}/{self.staging}", recursive=True)
        names: list[str] = []
        out, size = None, 0
        for row in iterator:
            if out is None or size >= self.file_bytes:
                if out is not None:
                    out.close()
                names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' if self.zip else ''}")
                out, size = fs.open_output_stream(f"{root}/{self.staging}/{names[-1]}", compression=None), 0
            record = self.record(row.asDict())
            record = gzip.compress(record) if self.zip else record  # one member a record
            out.write(record)
            size += len(record)
        if out is not None:
            out.close()
        return Written(names)

    def record(self, r: dict) -> bytes:
        payload = r["payload"] if r["payload"] is not None else b""
        payload = payload.encode("utf-8") if isinstance(payload, str) else bytes(payload)
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
        block = http + payload
        head = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['date']}"]
        if r["target_uri"] is not None:
            head.append(f"WARC-Target-URI: {_header_value(r['target_uri'])}")
        head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(r['payload_digest'])).decode()}")
        if r["refers_to"] is not None:
            head += [f"WARC-Refers-To: <{r['refers_to']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
        head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"

    def commit(self, messages: list[Written]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        old = [x.path for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file and f"/{self.staging}/" not in x.path] if self.overwrite else []
        for name in (n for m in messages if m is not None for n in m.names):
            fs.move(f"{root}/{self.staging}/{name}", f"{root}/{name}")
        for path in old:
            fs.delete_file(path)
        self.sweep(fs, root)

    def sweep(self, fs, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.staging}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages: list[Written]) -> None:
        self.sweep(*pafs.FileSystem.from_uri(self.path))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """A record for each page: the smallest id of equal payloads is a response, others revisit it.

    Payloads under `min_bytes` are all responses.  A null payload is empty, a
    null url leaves the target out, rows that repeat the smallest id are all
    responses.  A null id counts as the largest; a group of null ids only is all
    responses.  Payloads are compared by SHA-1 and length; very long ones are
    hashed whole; an empty table gives none; other columns are not looked at.

    Two passes: digests fill Bloom filters, and only digests that may repeat
    shuffle and are grouped.  Filters of the groups' digests and first ids then
    tell which pages move, and which of these with their payload; the others are
    responses as they are.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("group", F.concat_ws("|", "payload_digest", "payload_bytes"))
    slim = marked(staged(rows.select("id", "group"), "page-digests"), F.col("group"), "page-marked")
    groups = slim.filter("again").groupBy("group").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    groups = staged(groups, "page-groups")
    again = may_be_among(groups.select(hash_of("group").alias("h")))(hash_of("group"))
    alone = without_group(slim.filter(again).select("id", "group"), groups, "group", "n")  # the filter's false alarms
    may_be_first = may_be_among(groups.select(F.xxhash64("first").alias("h")).unionByName(alone.select(F.xxhash64("id").alias("h"))))
    met = rows.filter(again)
    # Staged, as it is read twice: html itself is read once for digests, once here, once for what does not repeat.
    met = met.withColumn("payload", F.when(may_be_first(F.xxhash64("id")) | (F.col("payload_bytes") < min_bytes), F.col("payload")))
    columns = ["id", "target_uri", "payload", "payload_digest", "payload_bytes"]
    both = with_group(staged(met, "page-repeats"), groups, "group", "n", how="left")
    both = both.select(*columns, F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first")).alias("first"))
    both = both.unionByName(rows.filter(~again).select(*columns, F.col("id").alias("first")))
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return both.select(
        urn("id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.when(revisit, urn("first")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(records: DataFrame, path: str, compression: str = "none") -> None:
    register(records.sparkSession)
    records.write.format("warc").option("compression", compression).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool | str = True) -> DataFrame:
    """The records of an archive; `payload` True, False, or "verify" to check payloads without giving them."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write `pages` as an archive in the shared folder and read every record back.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to and
    intact (whether the digest of the payload read is the recorded one; null for
    revisits, which hold none).  An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archive(page_records(pages), path)
    of = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return read_archive(spark, path, "verify").select(
        of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", of("refers_to").alias("refers_to"), "intact"
    )
