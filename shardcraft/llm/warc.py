"""WARC archives: writer with revisit records, and a salvage reader.

Writing: each task writes its rows as gzip members, one record each, to archives
that are rotated at ``rotate`` bytes, in a folder that all executors share.  File
names carry the attempt, and only files named in the committed manifest count,
so a lost or repeated task leaves nothing behind that is read.

A payload of at least ``min_bytes`` that several records share is stored once, in
the record with the largest id; the others become ``revisit`` records.  The
table of shared payloads is written first, so that Spark knows its size and
broadcasts it only below its own threshold; otherwise a join with skew
splitting is used.

Reading: archives are streamed record by record in bounded buffers.  A record
is checked by its gzip checksum, version line, header lines (folded ones too), length and
digest (hex, base32 or base64); a member may hold any number of records.  A record is held
in memory as a whole, an archive never is.  After a failed check the reader searches for the next valid member (or version line in
an archive that isn't compressed), goes on from there, and logs the skipped bytes
as a quarantined gap.

Defined results: a null payload is empty; a null id is written as ``null`` and read
back as null; control characters in an address are escaped; rows that repeat
the largest id of a shared payload are all responses; an empty table gives no
archives and no rows; other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardcraft.session import scratch_path

from .common import written

MANIFEST = "archive string, bytes long, records long"
READ = ("archive string, position long, kind string, page_id long, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, uri string, payload binary, gap_bytes long, reason string")
CHUNK = 1 << 20
READ_TASKS = 20_000
#: digest algorithms of archives and their lengths
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}
_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")


# ---------------------------------------------------------------------- writing

def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, kind: str, refers_to, digest: str, size: int) -> bytes:
    """One record.  A response holds an HTTP head and the payload; a revisit has
    no block and tells the full payload's digest and length."""
    block = b""
    if kind == "response":
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload)) + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
             f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, rotate: int, compressed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        done, out, size, n = [], None, 0, 0
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "kind", "first", "digest"))):
                page_id, url, html, kind, first, digest = r
                payload = html.encode()
                data = record(page_id, url, payload, kind, first, digest, len(payload))
                if compressed:
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = z.compress(data) + z.flush()
                if out is not None and size + len(data) > rotate:
                    out.close()
                    done.append((name, size, n))
                    out = None
                if out is None:
                    name = (f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done):04d}.warc"
                            + ".gz" * compressed)
                    out, size, n = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            done.append((name, size, n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{x}" for x, _, _ in done], pa.string()),
             pa.array([s for _, s, _ in done], pa.int64()), pa.array([c for _, _, c in done], pa.int64())],
            ["archive", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, rotate: int = 64 << 20,
                   compressed: bool = True) -> DataFrame:
    """Write one record per page under ``folder``; returns the written manifest."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"),
                        F.octet_length(html).alias("size"))
    shared = written(rows.where(F.col("size") >= min_bytes).groupBy("digest")
                     .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1 and first is not null").select("digest", "first"), "warc-shared")
    again = F.col("first").isNotNull() & (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    planned = rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first")).alias("first"))
    return written(planned.mapInArrow(_write(folder, rotate, compressed), MANIFEST), "warc-manifest")


# ---------------------------------------------------------------------- reading

class Damaged(Exception):
    pass


class Source:
    """Random access to an archive through one bounded buffer."""

    def __init__(self, handle):
        self.handle, self.size, self.at, self.buf = handle, handle.size(), 0, b""

    def read(self, pos: int, n: int = CHUNK) -> bytes:
        if not self.at <= pos < self.at + len(self.buf):
            self.handle.seek(pos)
            self.at, self.buf = pos, self.handle.read(CHUNK)
        off = pos - self.at
        return self.buf[off:off + n]

    def find(self, needle: bytes, pos: int) -> int:
        while pos < self.size:
            piece = self.read(pos)
            if len(piece) < len(needle) and pos + len(piece) < self.size:
                self.at, self.buf = 0, b""           # too near the buffer's end: read on from here
                continue
            i = piece.find(needle)
            if i >= 0:
                return pos + i
            if pos + len(piece) >= self.size:
                break
            pos += max(1, len(piece) - len(needle) + 1)
        return -1


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not _VERSION.fullmatch(lines[0] + b"\n"):
        raise Damaged("no version line")
    out, last = {}, None
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and last:      # a folded line goes on with the one before
            out[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        last = name.decode("latin-1").strip().lower()
        out[last] = value.decode("utf-8", "replace").strip()
    if not out.get("content-length", "").isdigit():
        raise Damaged("no length")
    return out


def digest_of(label: str) -> tuple[str, str] | None:
    """Algorithm and lower-case hex value of a digest header, which holds hex, base32 or
    base64; None without one, or with an algorithm that isn't known."""
    kind, _, value = label.partition(":")
    kind, value = kind.strip().lower(), value.strip()
    if kind not in DIGEST_BYTES:
        return None
    n, bare = DIGEST_BYTES[kind], value.rstrip("=")
    try:
        if len(value) == 2 * n:
            return kind, bytes.fromhex(value).hex()
        if len(bare) == -(-n * 8 // 5):
            return kind, base64.b32decode(bare.upper() + "=" * (-len(bare) % 8)).hex()
        if len(bare) == -(-n * 8 // 6):
            return kind, base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True).hex()
    except ValueError:
        pass
    raise Damaged("digest not readable")


def check(head: dict[str, str], block: bytes) -> None:
    told = digest_of(head.get("warc-block-digest", ""))
    if told and hashlib.new(told[0], block).hexdigest() != told[1]:
        raise Damaged("block digest differs")


def split_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Head, checked block and length of the record that ``data`` starts with."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Damaged("header not ended")
    head = parse_head(data[:end])
    n = int(head["content-length"])
    block = data[end + 4:end + 4 + n]
    if len(block) < n or data[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
        raise Damaged("length differs")
    check(head, block)
    return head, block, end + 8 + n


class Member:
    """The gzip member at ``pos``, decompressed forward piece by piece."""

    def __init__(self, src: Source, pos: int):
        self.src, self.pos, self.z = src, pos, zlib.decompressobj(31)
        self.buf, self.full = bytearray(), False

    def more(self) -> bool:
        """Lengthen :attr:`buf`; False at the member's end, after its checksum held."""
        if self.z.eof:
            return False
        piece = self.z.unconsumed_tail
        if not piece and not self.full:
            piece = self.src.read(self.pos)
            if not piece:
                raise Damaged("member not ended")
            self.pos += len(piece)
        try:
            out = self.z.decompress(piece, CHUNK)
        except zlib.error as e:
            raise Damaged(f"gzip: {str(e)[:60]}") from e
        self.buf += out
        self.full = len(out) == CHUNK
        if self.z.eof:
            self.pos -= len(self.z.unused_data)
        return True


def read_member(src: Source, pos: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records in the gzip member at ``pos``; returns the position after it.  One
    record is held back until the next one, or the member's end, has been checked."""
    m, held = Member(src, pos), None
    while True:
        while len(m.buf) < 5 and m.more():
            pass
        if not m.buf:
            break
        if not m.buf.startswith(b"WARC/"):
            raise Damaged("no version line")
        while (end := m.buf.find(b"\r\n\r\n")) < 0:
            if len(m.buf) > 2 * CHUNK or not m.more():
                raise Damaged("header not ended")
        stop = end + 8 + int(parse_head(bytes(m.buf[:end]))["content-length"])
        while len(m.buf) < stop:
            if not m.more():
                raise Damaged("length differs")
        head, block, _ = split_record(bytes(m.buf[:stop]))
        del m.buf[:stop]
        if held:
            yield held
        held = head, block
    if not held:
        raise Damaged("empty member")
    yield held
    return m.pos


def read_plain(src: Source, pos: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The record at ``pos`` of an archive that isn't compressed; returns the position after it."""
    end = src.find(b"\r\n\r\n", pos)
    if end < 0 or end - pos > CHUNK:
        raise Damaged("header not ended")
    head_bytes = b""
    while len(head_bytes) < end - pos:
        head_bytes += src.read(pos + len(head_bytes), end - pos - len(head_bytes))
    n = int(parse_head(head_bytes)["content-length"])
    if end + 8 + n > src.size:
        raise Damaged("length differs")
    data = [head_bytes]
    at, stop = end, end + 8 + n
    while at < stop:
        data.append(src.read(at, stop - at))
        at += len(data[-1])
    head, block, _ = split_record(b"".join(data))
    yield head, block
    return stop


class Marks:
    """The next place of either mark, each searched once however often it is asked for."""

    def __init__(self, src: Source):
        self.src, self.next = src, {_MEMBER: -1, b"WARC/": -1}

    def after(self, pos: int) -> int:
        for mark, at in self.next.items():
            if at <= pos:
                found = self.src.find(mark, pos + 1)
                self.next[mark] = found if found >= 0 else self.src.size
        return min(self.next.values())


def salvage(src: Source) -> Iterator[tuple]:
    """``("record", position, head, block)`` and ``("gap", position, bytes, reason)``
    in file order; together they cover the archive.  Records of one member share its
    position; a member that is damaged after some sound records is a gap as a whole."""
    pos, gap, why, marks = 0, None, "", Marks(src)
    while pos < src.size:
        start = src.read(pos, 3)
        if len(start) < 3:
            start += src.read(pos + len(start), 3 - len(start))
        read = (read_member if start[:2] == _MEMBER[:2] else read_plain)(src, pos)
        failed = None
        while failed is None:
            try:
                head, block = next(read)
            except StopIteration as end:
                pos = end.value
                break
            except Damaged as e:
                failed = e
                continue
            if gap is not None:
                yield "gap", gap, pos - gap, why
                gap = None
            yield "record", pos, head, block
        if failed is not None:
            if gap is None:
                gap, why = pos, str(failed)
            pos = marks.after(pos)
    if gap is not None:
        yield "gap", gap, src.size - gap, why


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m.group(1)) if m else None


def _told(head: dict[str, str]) -> str | None:
    """The payload digest a revisit tells, as hex; None if it tells none that can be read."""
    try:
        told = digest_of(head.get("warc-payload-digest", ""))
    except Damaged:
        return None
    return told[1] if told else None


def _read(with_payload: bool):
    def rows(archive: str) -> Iterator[tuple]:
        store, path = fs.FileSystem.from_uri(archive)
        with store.open_input_file(path) as f:
            for kind, pos, x, y in salvage(Source(f)):
                if kind == "gap":
                    yield (archive, pos, "gap", None, None, None, None, None, None, None, x, y)
                    continue
                payload = y.partition(b"\r\n\r\n")[2] if x.get("content-type", "").startswith("application/http") else y
                whole = x.get("warc-type") != "revisit"
                digest = hashlib.sha1(payload).hexdigest() if whole else _told(x)
                size = len(payload) if whole else int(x.get("x-payload-length", 0))
                yield (archive, pos, "record", _page(x.get("warc-record-id")), x.get("warc-type"), size, digest,
                       _page(x.get("warc-refers-to")), x.get("warc-target-uri"), payload if with_payload else None,
                       None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
                 pa.string(), pa.binary(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in READ.split(", ")]

        def batch(held):
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names)

        for b in batches:
            for archive in b.column(0).to_pylist():
                held, size = [], 0
                for row in rows(archive):
                    held.append(row)
                    size += 200 + len(row[9] or b"")
                    if size > 4 << 20:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)
    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives named in column ``archive``,
    see :data:`READ`; one task reads whole archives, in bounded buffers and a record at a time.
    Names are dealt out to as many tasks as there are archives (at most
    :data:`READ_TASKS`): names are tiny, so their bytes say nothing about the work."""
    names = archives.select("archive")
    tasks = max(1, min(names.count(), READ_TASKS))
    return names.repartition(tasks).mapInArrow(_read(with_payload), READ)


def round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_bytes), with_payload=False)
