"""Operator 11, WARC: archives as a Python data source, ``spark.read.format("warc")`` and
``df.write.format("warc")``.

Reading. ``partitions()`` plans the files of a folder: a file is read by one task, small files share
one up to ``partition_bytes``, and a record is never split. ``pushFilters`` takes comparisons of the
record type and of header columns; a task parses a record's headers first, tests the filters on
them, and only then touches the payload. Where the requested schema has no payload, or a filter
turned the record down, the payload is not decoded: an uncompressed file is sought past it by
Content-Length, a gzip member past it by the compressed length in its "sl" extra field (members that
lack the field are inflated and thrown away). Files end in ``.warc`` or ``.warc.gz``; gzip members
hold one record or several.

Writing. A task writes files of about ``file_bytes`` under fresh names; the driver's commit writes
one list of the files that count. A folder with such lists is read by them, so a repeated or lost
task leaves at most an orphan; a folder without lists (archives from elsewhere) is read whole.

Columns to write (all but record_id and record_type may be absent or null): record_id, record_type,
target_uri, warc_date, payload_digest, refers_to, payload_bytes, payload. A response is an HTTP message
with the payload as its body; a revisit is its headers alone, which tell the full payload's length.

Defined cases: a null payload is empty; a null header column is left out and reads back as null (a null
date is the time of writing, the format demands one); line breaks in a header value become spaces; a null record_id or record_type is an error; records that
repeat are written each; a record cut off at the end of a file ends the job with an error unless
``truncated`` is "skip"; a folder without archives reads as no rows; further columns are ignored.
Paths may be any that pyarrow's file systems open; on a cluster the folder must be shared.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from livepulse.session import scratch_dir

from .common import stored

SCHEMA = ("record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
          "refers_to string, content_type string, content_length long, payload_bytes long, payload binary, "
          "file string, offset long")
#: Column -> header, fixed names of the format.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "warc_date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
           "content_type": "Content-Type", "content_length": "Content-Length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LISTS = "_archives-"
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1024
CHUNK = 1 << 16                # bytes read from a file at once
LEAST = 2048                   # bytes inflated at once, at least
HEAD_BYTES = 1 << 24         # headers longer than this are no headers


def _folder(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def archives(uri: str) -> list[tuple[str, int]]:
    """(path, bytes) of the archives of a folder (or of one file), in order of name."""
    from pyarrow import fs
    system, path = _folder(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        return []
    found = {f.base_name: f for f in system.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File}
    lists = [f for name, f in found.items() if name.startswith(LISTS)]
    names = set()
    for f in lists:
        with system.open_input_stream(f.path) as s:
            names.update(json.loads(s.read()))
    files = [f for name, f in found.items() if name.endswith((".warc", ".warc.gz")) and (not lists or name in names)]
    if missing := names - set(found):
        raise FileNotFoundError(f"{uri}: {len(missing)} committed archives are gone, {min(missing)} among them")
    return sorted((f.path, f.size) for f in files)


class WarcError(ValueError):
    """The bytes are no archive."""


class CutOff(WarcError):
    """The file ends inside a record."""


class _Plain:
    """Bytes of an uncompressed file; ``skip`` seeks."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def offset(self, ahead: int) -> int:
        """Where the bytes began of which ``ahead`` have been read."""
        return self.file.tell() - ahead

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def unread(self, data: bytes) -> None:
        self.file.seek(self.file.tell() - len(data))

    def skip(self, n: int) -> None:
        at = self.file.tell() + n
        if at > self.size:
            raise CutOff("a record is cut off")
        self.file.seek(at)


class _Gzip:
    """Inflated bytes of a file of gzip members; ``skip`` leaves a member by the length its "sl"
    field tells, if no further record follows in it."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.inflater, self.buffer, self.input = None, b"", b""
        self.at = self.taken = 0                             # where the member begins, plain bytes read of it
        self.length: tuple[int, int] | None = None           # of the member: compressed, plain

    def offset(self, ahead: int) -> int:
        return self.at

    def _member(self) -> bool:
        self.at = self.file.tell() - len(self.input)
        if self.at >= self.size:
            return False
        while len(self.input) < 24 and (more := self.file.read(CHUNK)):
            self.input += more
        head = self.input
        if head[:2] != b"\x1f\x8b":
            raise WarcError("not a gzip member")
        self.length = struct.unpack("<II", head[16:24]) if head[3] & 4 and head[12:16] == b"sl\x08\x00" else None
        self.inflater, self.taken = zlib.decompressobj(31), 0
        return True

    def read(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n and (self.inflater is not None or self._member()):
            data = self.input or self.file.read(CHUNK)
            if not data:
                raise CutOff("a record is cut off")
            parts.append(self.inflater.decompress(data, max(n - have, LEAST)))
            have += len(parts[-1])
            self.taken += len(parts[-1])
            self.input = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.input, self.inflater = self.inflater.unused_data, None
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]

    def unread(self, data: bytes) -> None:
        self.buffer = data + self.buffer

    def skip(self, n: int) -> None:
        # what is left of this record reaches the member's end, but for the two line breaks
        if self.inflater is not None and self.length and self.taken - len(self.buffer) + n + 4 >= self.length[1]:
            end, read = self.at + self.length[0], self.file.tell()
            if end > self.size:
                raise CutOff("a record is cut off")
            # within the bytes already read, or beyond them
            self.input = self.input[len(self.input) - (read - end):] if end <= read else b""
            if end > read:
                self.file.seek(end)
            self.inflater, self.buffer = None, b""
            return
        while n:
            part = self.read(min(n, CHUNK))
            if not part:
                raise CutOff("a record is cut off")
            n -= len(part)


def _head(source, most: int | None = None) -> tuple[str, dict[str, str], int] | None:
    """The first line, the headers (names in lower case) up to the empty line, and the bytes taken;
    what follows is left unread. None if ``most`` bytes hold no empty line (all left unread)."""
    head = b""
    while (end := head.find(b"\r\n\r\n")) < 0:
        n = 512 if most is None else min(512, most - len(head))
        more = source.read(n) if n else b""
        if not more:
            if most is not None and len(head) == most:
                source.unread(head)
                return None
            raise CutOff("a record is cut off")
        head += more
        if most is None and len(head) > HEAD_BYTES:
            raise WarcError("headers without an end")
    source.unread(head[end + 4:])
    lines = head[:end].split(b"\r\n")
    out = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return lines[0].decode("latin-1"), out, end + 4


class Test(NamedTuple):
    """A pushed comparison; ``negated`` turns its answer round where there is one."""
    kind: str
    column: str
    value: object
    negated: bool = False


_COMPARE = {"eq": lambda a, b: a == b, "in": lambda a, b: a in b, "lt": lambda a, b: a < b, "le": lambda a, b: a <= b,
            "gt": lambda a, b: a > b, "ge": lambda a, b: a >= b, "starts": lambda a, b: a.startswith(b),
            "ends": lambda a, b: a.endswith(b), "contains": lambda a, b: b in a}


def _fits(tests: Sequence[Test], row: dict) -> bool:
    """Do all comparisons hold? As in SQL, a null answers only the null tests."""
    for kind, column, value, negated in tests:
        have = row.get(column)
        if kind == "null":
            ok = (have is None) != negated
        elif kind == "same":
            ok = (have == value) != negated
        elif have is None or value is None or kind == "in" and negated and None in value:
            ok = False
        else:
            ok = _COMPARE[kind](have, value) != negated
        if not ok:
            return False
    return True


def records(file, name: str, compressed: bool, tests: Sequence[Test] = (), want_payload: bool = True,
            want_length: bool = True, seen: dict | None = None) -> Iterator[dict]:
    """The records of one open file that pass ``tests`` (on header columns), with their payload if
    wanted. ``seen`` counts what became of payloads: "decoded" or "skipped"."""
    source = _Gzip(file) if compressed else _Plain(file)
    seen = {} if seen is None else seen
    while True:
        lead = source.read(2)
        while lead == b"\r\n":                              # line breaks between records
            lead = source.read(2)
        if not lead:
            return
        row: dict = {"file": name, "offset": source.offset(len(lead))}
        source.unread(lead)
        first, head, _ = _head(source)
        if not first.startswith("WARC/"):
            raise WarcError(f"no record at {row['offset']}")
        row |= {c: head.get(h.lower()) for c, h in HEADERS.items()}
        if (digest := row["payload_digest"]) and ":" in digest:
            row["payload_digest"] = digest.split(":", 1)[1]
        for c in ("record_id", "refers_to"):
            row[c] = row[c].strip("<>") if row[c] else row[c]
        left = row["content_length"] = int(row["content_length"] or 0)
        wanted = _fits(tests, row)
        if wanted and (want_payload or want_length):
            inner = _head(source, left) if (row["content_type"] or "").startswith("application/http") else None
            if inner is not None:
                left -= inner[2]
            told = inner[1].get("content-length", "") if inner and row["record_type"] == "revisit" else ""
            row["payload_bytes"] = int(told) if told.isdigit() else left
        if wanted and want_payload and row["record_type"] != "revisit":
            row["payload"] = source.read(left)
            if len(row["payload"]) < left:
                raise CutOff("a record is cut off")
            seen["decoded"] = seen.get("decoded", 0) + 1
        else:
            source.skip(left)
            seen["skipped"] = seen.get("skipped", 0) + 1
        if wanted:
            yield row


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        self.value = files


#: Filter class -> comparison the reader tests on a header column.
_PUSHED = {EqualTo: "eq", EqualNullSafe: "same", In: "in", LessThan: "lt", LessThanOrEqual: "le", GreaterThan: "gt",
           GreaterThanOrEqual: "ge", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains",
           IsNull: "null", IsNotNull: "null"}


def pushed(f: Filter) -> Test | None:
    """The comparison a filter stands for, None if it is not on one header column."""
    if isinstance(f, Not):
        inner = pushed(f.child)
        return inner._replace(negated=not inner.negated) if inner else None
    kind = _PUSHED.get(type(f))
    if kind is None or len(f.attribute) != 1 or f.attribute[0] not in HEADERS:
        return None
    return Test(kind, f.attribute[0], getattr(f, "value", None), isinstance(f, IsNotNull))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, partition_bytes: int, skip_cut: bool):
        self.path, self.names = path, schema.fieldNames()
        self.partition_bytes, self.skip_cut = partition_bytes, skip_cut
        self.tests: list[Test] = []
        from pyspark.sql.pandas.types import to_arrow_schema
        self.schema = to_arrow_schema(schema)

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if (test := pushed(f)) is not None:
                self.tests.append(test)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        parts: list[list[str]] = []
        room = 0
        for path, size in sorted(archives(self.path), key=lambda f: -f[1]):
            if not parts or size > room:
                parts.append([])
                room = self.partition_bytes
            parts[-1].append(path)
            room -= size
        return [_Files(p) for p in parts or [[]]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = _folder(self.path)
        rows: list[dict] = []
        held = 0
        for path in partition.value:
            with system.open_input_file(path) as file:
                found = records(file, path, path.endswith(".gz"), self.tests, "payload" in self.names, "payload_bytes" in self.names)
                while (row := self._next(found, path)) is not None:
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _next(self, found: Iterator[dict], path: str) -> dict | None:
        try:
            return next(found, None)
        except CutOff as e:
            if self.skip_cut:
                return None
            raise CutOff(f"{path}: {e}") from None
        except WarcError as e:
            raise WarcError(f"{path}: {e}") from None

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in self.schema],
                                          schema=self.schema)


def _line(name: str, value: object) -> bytes:
    return f"{name}: {' '.join(str(value).splitlines())}\r\n".encode()


def record_bytes(row: dict, now: str) -> tuple[bytes, bytes]:
    """(headers, block) of a record to write; ``now``: the date of a record that has none."""
    kind = row.get("record_type")
    if kind is None or row.get("record_id") is None:
        raise ValueError("a record needs record_id and record_type")
    payload = row.get("payload") or b""
    head = [b"WARC/1.1\r\n", _line("WARC-Type", kind), _line("WARC-Record-ID", f"<{row['record_id']}>")]
    head.append(_line("WARC-Date", row["warc_date"] if row.get("warc_date") is not None else now))
    if row.get("target_uri") is not None:
        head.append(_line("WARC-Target-URI", row["target_uri"]))
    if row.get("payload_digest") is not None:
        head.append(_line(HEADERS["payload_digest"], f"sha1:{row['payload_digest']}"))
    if kind in ("response", "revisit"):
        size = row["payload_bytes"] if kind == "revisit" and row.get("payload_bytes") is not None else len(payload)
        block = b"HTTP/1.1 200 OK\r\n" + _line("Content-Type", "text/html; charset=utf-8") + \
            _line("Content-Length", size) + b"\r\n" + (payload if kind == "response" else b"")
        head.append(_line("Content-Type", "application/http; msgtype=response"))
    else:
        block = payload
        head.append(_line("Content-Type", "application/octet-stream"))
    if kind == "revisit":
        head.append(_line("WARC-Profile", REVISIT_PROFILE))
    if row.get("refers_to") is not None:
        head.append(_line("WARC-Refers-To", f"<{row['refers_to']}>"))
    head.append(_line("Content-Length", len(block)) + b"\r\n")
    return b"".join(head), block


def gzip_member(plain: bytes, level: int) -> bytes:
    """One gzip member whose extra field "sl" tells its compressed and plain length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    size = 24 + len(body) + 8
    extra = b"sl\x08\x00" + struct.pack("<II", size, len(plain) & 0xFFFFFFFF) if size < 1 << 32 else b""
    head = b"\x1f\x8b\x08" + (b"\x04" if extra else b"\x00") + b"\x00\x00\x00\x00\x00\xff"
    head += struct.pack("<H", len(extra)) + extra if extra else b""
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, compress: bool, level: int, file_bytes: int):
        self.path, self.overwrite, self.compress, self.level, self.file_bytes = path, overwrite, compress, level, file_bytes
        self.now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = _folder(self.path)
        system.create_dir(path, recursive=True)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                columns = [c for c in batch.schema.names if c in (*HEADERS, "payload", "payload_bytes")]
                for lo in range(0, batch.num_rows, 64):
                    part = batch.slice(lo, 64)
                    for values in zip(*(part.column(c).to_pylist() for c in columns)):
                        head, block = record_bytes(dict(zip(columns, values)), self.now)
                        data = head + block + b"\r\n\r\n"
                        data = gzip_member(data, self.level) if self.compress else data
                        if out is not None and size and size + len(data) > self.file_bytes:
                            out.close()
                            out = None
                        if out is None:
                            names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' if self.compress else ''}")
                            out, size = system.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                        out.write(data)
                        size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        from pyarrow import fs
        system, path = _folder(self.path)
        system.create_dir(path, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        before = system.get_file_info(fs.FileSelector(path))
        with system.open_output_stream(f"{path}/{LISTS}{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(names).encode())
        if self.overwrite:                                   # the new list counts alone
            for f in before:
                if f.base_name.startswith(LISTS):
                    system.delete_file(f.path)

    def abort(self, messages: list) -> None:
        system, path = _folder(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                system.delete_file(f"{path}/{n}")


class WarcDataSource(DataSource):
    """Options: ``path`` (or load/save's argument), ``partition_bytes`` (reading, 128 MB),
    ``truncated`` ("error" or "skip"), ``compress`` ("true"), ``level`` (gzip, 3), ``file_bytes`` (1 GB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("partition_bytes", 128 << 20)),
                          self.options.get("truncated", "error") == "skip")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite, self.options.get("compress", "true") == "true",
                          int(self.options.get("level", 3)), int(self.options.get("file_bytes", 1 << 30)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session; filters are pushed to it (a session setting)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archives(rows: DataFrame, folder: str, **options) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").options(**options).mode("append").save(folder)


def read_archives(spark: SparkSession, folder: str, payload: bool = True, **options) -> DataFrame:
    """All records; ``payload`` False: headers (and what they tell of the payload) only."""
    register(spark)
    names = ", ".join(f for f in SCHEMA.split(", ") if payload or not f.startswith("payload binary"))
    return spark.read.format("warc").schema(names).options(**options).load(folder)


HOT_GROUPS = 4096


def page_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, html). Of rows with equal payloads of at
    least ``least_bytes`` bytes the one with the largest page_id (a null one is the least; of rows
    that repeat it, one) is a response, the others revisit it; all others are responses.

    Payloads are told apart by SHA-256; only digests are grouped. Groups above one row in
    ``HOT_GROUPS`` are at most as many, and are joined by broadcast, so no hot group is shuffled."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload"), F.sha2(html, 256).alias("sha"), F.sha1(html).alias("sha1"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long"))
    order = F.coalesce(F.col("page_id"), F.lit(-(1 << 63)))
    groups = rows.filter(F.col("size") >= least_bytes).groupBy("sha", order.alias("id")).agg(F.count("*").alias("n")) \
        .groupBy("sha").agg(F.max(F.struct("id", "n")).alias("best"), F.sum("n").alias("rows"))
    groups = stored(groups.filter("rows > 1").select(F.col("sha").alias("_sha"), F.col("best.id").alias("_id"),
                                                     F.col("best.n").alias("_same"), "rows"), "payload-groups")
    total = groups.agg(F.sum("rows")).first()[0] or 0
    hot = groups.filter(F.col("rows") * HOT_GROUPS > total).drop("rows")
    rest = groups.filter(F.col("rows") * HOT_GROUPS <= total).drop("rows")
    named = [F.col(c).alias(c + x) for x in ("h",) for c in ("_id", "_same")]
    both = rows.join(F.broadcast(hot.select(F.col("_sha").alias("_shah"), *named)), F.col("sha") == F.col("_shah"), "left")
    # a row that has its group, or none, is dealt by itself
    both = both.withColumn("_key", F.when(F.col("_idh").isNull() & (F.col("size") >= least_bytes), F.col("sha"))
                           .otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    both = both.join(rest, F.col("_key") == F.col("_sha"), "left")
    best, same = F.coalesce("_idh", "_id"), F.coalesce("_sameh", "_same")
    both = both.withColumn("_best", best).withColumn("_n", F.coalesce(same, F.lit(0)))
    mine = F.col("_best").isNull() | (F.col("_best") == order)
    whole = ["page_id", "url", "payload", "sha", "sha1", "size", "_best"]
    single = both.filter((~mine) | (F.col("_n") <= 1)).select(*whole, mine.alias("first"))
    if groups.filter("_same > 1").isEmpty():
        out = single
    else:
        # rows that repeat payload and page_id: the first by address is the response
        again = both.filter(mine & (F.col("_n") > 1))
        one = again.groupBy("sha").agg(F.min(F.struct("url", "page_id", "payload", "sha1", "size", "_best")).alias("r")) \
            .select("r.page_id", "r.url", "r.payload", "sha", "r.sha1", "r.size", "r._best", F.lit(True).alias("first"))
        urls = again.groupBy("sha", "url", "page_id", "sha1", "size", "_best").agg(F.count("*").alias("copies"))
        least = again.groupBy("sha").agg(F.min(F.struct("url")).alias("u")).select(
            F.col("sha").alias("_sha2"), F.col("u.url").alias("_url2"))
        copies = F.col("copies") - F.when(F.col("url").eqNullSafe(F.col("_url2")), 1).otherwise(0)
        others = urls.join(least, F.col("sha") == F.col("_sha2")).withColumn("copies", copies).filter("copies > 0") \
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))) \
            .select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "sha", "sha1", "size", "_best",
                    F.lit(False).alias("first"))
        out = single.unionByName(one).unionByName(others)
    name = lambda page, digest: F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), digest)
    refers = F.when(~F.col("first"), name(F.nullif(F.col("_best"), F.lit(-(1 << 63))), F.col("sha")))
    return out.select(
        name(F.col("page_id"), F.col("sha")).alias("record_id"),
        F.when(F.col("first"), "response").otherwise("revisit").alias("record_type"), F.col("url").alias("target_uri"),
        F.col("sha1").alias("payload_digest"), refers.alias("refers_to"), F.col("size").alias("payload_bytes"),
        F.when(F.col("first"), F.col("payload")).alias("payload"))


def page_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of page archives: page_id, payload_bytes, payload_digest, record_type, refers_to. A
    response's are those of its payload as read; a revisit's come from headers, its block is skipped."""
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+):", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    responses = read_archives(spark, folder).filter("record_type = 'response'").select(
        "record_id", "refers_to", "record_type", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    revisits = read_archives(spark, folder, payload=False).filter("record_type = 'revisit'").select(
        "record_id", "refers_to", "record_type", "payload_bytes", "payload_digest")
    return responses.unionByName(revisits).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 1000) -> DataFrame:
    """Write the archives, read them back (see page_index)."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "llm", "warc")
    write_archives(page_records(pages, least_bytes), folder)
    return page_index(spark, folder)
