"""WARC archives: a writer with revisit records, and a reader that salvages what is damaged."""

from __future__ import annotations

import base64
import binascii
import hashlib
import zlib
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch, own

#: Bytes of an archive after which the next one begins; a reader holds one archive.
ARCHIVE_BYTES = 8 << 20
MIN_REVISIT = 100
#: Bytes of a gzip member that are inflated at once.
PIECE = 1 << 16
#: Digests of pages that occur twice that may be broadcast, about 100 bytes each; beyond, payloads are dealt by salted digest.
BROADCAST_DIGESTS, SALTS = 200_000, 32
ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
GZIP = b"\x1f\x8b\x08"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = datetime(2024, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(kind: str, uri: str, record_id: str, payload: bytes, digest: str, payload_bytes: int, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record.  A response has its payload behind an HTTP head; a revisit has the head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    block = http + (payload if kind == "response" else b"")
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in uri)
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"X-Payload-Length: {payload_bytes}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member of its own, without a time."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class BadRecord(ValueError):
    pass


def differs(said: str, data: bytes) -> bool:
    """Whether a digest "algorithm:value" in hex, base32 or base64 is not that of `data`; False if it cannot be told."""
    name, sep, value = said.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    if not sep or name not in ALGORITHMS:
        return False
    is_ = hashlib.new(name, data, usedforsecurity=False).digest()
    bare, n = value.rstrip("="), len(is_)
    try:
        if len(bare) == 2 * n:
            return bytes.fromhex(bare) != is_
        if len(bare) == -(-8 * n // 5):
            return base64.b32decode(bare.upper() + "=" * (-len(bare) % 8)) != is_
        if len(bare) == -(-4 * n // 3):
            return base64.b64decode(bare.replace("-", "+").replace("_", "/") + "=" * (-len(bare) % 4), validate=True) != is_
    except (ValueError, binascii.Error):
        return True
    return False


#: A record's head is no longer; the search for its end stops there.
HEAD_BYTES = 1 << 16


class Marks:
    """Where the next gzip member or version line may start.  Each marker's next place is kept until it is passed, so an archive is searched once for it, however many checks fail."""

    def __init__(self, data: bytes):
        self.data, self.next = data, {GZIP: -1, b"WARC/1.": -1}

    def after(self, at: int) -> int:
        for mark, place in self.next.items():
            if place < at:
                found = self.data.find(mark, at)
                self.next[mark] = found if found >= 0 else len(self.data)
        return min(self.next.values())


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at `at`; BadRecord if any check fails."""
    line = data.find(b"\r\n", at, at + 64)
    if line < 0 or data[at:line] not in VERSIONS:
        raise BadRecord("no version line")
    stop = data.find(b"\r\n\r\n", line, at + HEAD_BYTES)
    if stop < 0:
        raise BadRecord("no end of head")
    headers = {}
    for h in data[line + 2 : stop].split(b"\r\n"):
        k, sep, v = h.partition(b":")
        if not sep:
            raise BadRecord("a header without a colon")
        headers[k.strip().lower().decode("utf-8", "replace")] = v.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise BadRecord("a needed header is missing")
    begin, end = stop + 4, stop + 4 + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise BadRecord("the block does not end where it should")
    block = data[begin:end]
    if differs(headers.get("warc-block-digest", ""), block):
        raise BadRecord("the block's digest differs")
    return headers, block, end + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """(what the gzip member at `at` holds as far as it inflates, its end, what is wrong with it).

    It is fed a piece at a time, so the rest of the archive is not touched; the piece
    that fails is fed in ever smaller ones, so what came before the fault is kept.
    """
    z, out, view, pos, step = zlib.decompressobj(31), [], memoryview(data), at, PIECE
    while pos < len(data):
        before = z.copy()
        try:
            out.append(z.decompress(view[pos : pos + step]))
        except zlib.error as e:
            if step == 1:
                return b"".join(out), pos, f"gzip: {e}"
            z, step = before, max(1, step >> 5)
            continue
        pos = min(pos + step, len(data))
        if z.eof:
            return b"".join(out), pos - len(z.unused_data), ""
    return b"".join(out), pos, "gzip: cut short"


def _checked(headers: dict[str, str]) -> bool:
    """Whether a digest of the whole block is named that parse_record compares."""
    return headers.get("warc-block-digest", "").partition(":")[0].strip().lower().replace("-", "") in ALGORITHMS


def _inside(inner: bytes, start: int, end: int):
    """What an inflated member holds, in the form of salvage."""
    pos, good = 0, True
    while pos < len(inner):
        try:
            headers, block, pos = parse_record(inner, pos)
        except BadRecord as e:
            if good:
                yield "gap", start, end, str(e), b""
            good, pos = False, inner.find(b"WARC/1.", pos + 1)
            if pos < 0:
                return
            continue
        good = True
        yield "record", start, end, headers, block


def salvage(data: bytes):
    """Yields ("record", start, end, headers, block) and ("gap", start, end, reason, b"") over a whole archive.

    Members of gzip and plain records may follow each other.  Where a check fails, the
    bytes up to the next place at which a valid member or record starts are a gap.
    Every byte is in exactly one record or gap.

    A member that holds a bad record keeps its other records, from the next version line
    in its inflated bytes on; each bad stretch is a gap of its own with the member's start
    and end, as its records have.  A member that does not inflate to its end keeps the
    records before the fault: all that are whole where it is cut short, those with a block
    digest where its data is wrong.  These end where the next valid place is found, as the
    gap for the rest does.
    """
    at, gap, why, held, marks = 0, None, "", [], Marks(data)

    def quarantined(end):
        for _, _, _, headers, block in held:
            yield "record", gap, end, headers, block
        yield "gap", gap, end, why, b""

    while at < len(data):
        found = []
        try:
            if data.startswith(GZIP, at):
                inner, end, fault = _inflate(data, at)
                found = list(_inside(inner, at, end))
                good = [f for f in found if f[0] == "record"]
                if fault:
                    good = [f for f in good if fault == "gzip: cut short" or _checked(f[3])]
                    if good:
                        if gap is not None:
                            yield from quarantined(at)
                        gap, why, held = at, fault, good
                    raise BadRecord(fault)
                if not good:
                    if gap is None:
                        gap, why = at, found[0][3] if found else "an empty member"
                    at = end
                    continue
            else:
                headers, block, end = parse_record(data, at)
                found.append(("record", at, end, headers, block))
        except BadRecord as e:
            if gap is None:
                gap, why = at, str(e)
            at = marks.after(at + 1)
            continue
        if gap is not None:
            yield from quarantined(at)
            gap, held = None, []
        yield from found
        at = end
    if gap is not None:
        yield from quarantined(len(data))


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def _write(folder: str, compress: bool, archive_bytes: int):
    def run(batches):
        filesystem, base = _filesystem(folder)
        task, n, held, size = TaskContext.get(), 0, [], 0

        def flush():
            # a name of this attempt's own: only files that the manifest lists are read
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{n:05d}.warc" + ".gz" * compress
            with filesystem.open_output_stream(f"{base}/{name}", compression=None) as f:
                for x in held:
                    f.write(x)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([len(held)], pa.int64())], ["path", "bytes", "records"])

        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for i in range(len(batch)):
                page, url, html, digest, refers = (c[i].as_py() for c in cols)
                payload = (html or "").encode()
                data = record("response" if refers is None else "revisit", url or "", "null" if page is None else str(page), payload, digest, len(payload), None if refers is None else str(refers))
                held.append(member(data) if compress else data)
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    n, held, size = n + 1, [], 0
        if held:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", compress: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page and returns the manifest (path, bytes, records), which the caller must write or read once.

    Of pages with equal payloads (UTF-8 of html, null: empty) of at least 100 bytes the
    one with the least id is a response and the others revisit it; repeated rows of
    that id are responses all.  The least id of a digest is a partial aggregate, and
    only digests that occur twice are joined back: broadcast up to BROADCAST_DIGESTS of
    them, so that payloads are not shuffled, and by salted digest beyond.

    Nulls: a null url is empty; a null id is written as "null", and takes part in no
    group.
    """
    n = own(pages.columns, "first", "salt")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    able = (F.octet_length("html") >= MIN_REVISIT) & F.col("page_id").isNotNull()
    firsts = rows.where(able).groupBy("digest").agg(F.min("page_id").alias(n["first"]), F.max("page_id").alias("last")).where(F.col("last") > F.col(n["first"])).drop("last")
    firsts = Scratch(pages.sparkSession).cut(firsts, "firsts")
    if firsts.count() <= BROADCAST_DIGESTS:
        joined = rows.join(F.broadcast(firsts), "digest", "left")
    else:  # pages of one payload, of which there may be many, go to SALTS tasks
        salted = firsts.withColumn(n["salt"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn(n["salt"], F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["digest", n["salt"]], "left")
    refers = F.when(able & (F.col("page_id") > F.col(n["first"])), F.col(n["first"]))
    filesystem, base = _filesystem(folder)
    filesystem.create_dir(base, recursive=True)
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to")).mapInArrow(_write(folder, compress, archive_bytes), "path string, bytes long, records long")


def _payload(headers: dict[str, str], block: bytes) -> tuple[bytes | None, bool]:
    """What a record's row gives as its payload, and whether it contradicts the payload's digest.

    The body of an HTTP response, nothing of a revisit, and the block of every other
    record.  The digest of an HTTP message is its body's.  It is not compared where the
    record holds a segment of the payload only, or a body in a transfer coding.
    """
    kind = headers["warc-type"].lower()
    if kind == "revisit":
        return None, False
    http = kind in ("response", "request") and (headers.get("content-type", "").lower().startswith("application/http") or block.startswith(b"HTTP/"))
    head, _, body = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    able = "warc-segment-number" not in headers and b"\r\ntransfer-encoding:" not in head.lower()
    return body if kind == "response" else block, able and differs(headers.get("warc-payload-digest", ""), body)


def _read(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, size = [], 0
            for kind, start, end, what, block in salvage(content.as_py() or b""):
                if kind == "gap":
                    rows.append((path, kind, start, end, what, None, None, None, None, None, None, None))
                    continue
                payload, wrong = _payload(what, block)
                digest = what.get("warc-payload-digest", "").removeprefix("sha256:")
                if wrong:
                    rows.append((path, "gap", start, end, "the payload's digest differs", None, None, None, None, None, None, None))
                    continue
                name = lambda x: x[10:-1] if x.startswith("<urn:page:") else x or None
                n = len(payload) if payload is not None else int(what.get("x-payload-length", -1))
                rows.append((path, kind, start, end, None, name(what["warc-record-id"]), what.get("warc-target-uri"), what["warc-type"], name(what.get("warc-refers-to", "")), digest, n, payload))
                size += len(payload or b"")
                if size > 8 << 20:
                    yield _rows(rows)
                    rows, size = [], 0
            if rows:
                yield _rows(rows)


_FIELDS = {"path": pa.string(), "kind": pa.string(), "start": pa.int64(), "end": pa.int64(), "reason": pa.string(), "record_id": pa.string(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _FIELDS.values(), strict=True)], list(_FIELDS))


def read_archives(archives: DataFrame) -> DataFrame:
    """archives(path, content) -> a row per record, and one per quarantined gap (kind "gap": path, start, end, reason).

    A record has record_id, url, record_type, refers_to, payload_digest, payload_bytes
    and payload (see _payload; null for a revisit).  Digests of blocks and payloads are
    checked by the algorithm and encoding they name; one of an unknown kind is not.
    An archive without content, or a null one, gives no rows, as does an empty table; equal
    archives and records of equal ids are read each.
    """
    schema = "path string, kind string, start long, end long, reason string, record_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
    return archives.select("path", "content").mapInArrow(_read, schema)


def write_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives of `pages` in the shared folder, and what reading them back gives (see read_archives).

    Nulls, repeated rows and ties are as in write_archives; without pages there are no rows.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    folder = scratch.path("archives")
    manifest = scratch.cut(write_archives(pages, folder, id_col, url_col, html_col), "manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder) if not manifest.isEmpty() else spark.createDataFrame([], "path string, content binary")
    # a lost attempt may have left files of its own
    named = manifest.select(F.element_at(F.split("path", "/"), -1).alias("name"))
    listed = files.select("path", "content").withColumn("name", F.element_at(F.split("path", "/"), -1)).join(named, "name", "left_semi")
    return read_archives(listed)
