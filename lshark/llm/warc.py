"""WARC archives of pages and a normaliser for monolithic gzip files (operator 7).

Writers produce one gzip stream per archive file, as simple tools do.  The
normaliser inflates such a file once, rewrites every record as a gzip member
of its own and writes a sidecar index of offsets, so that any record can then
be read alone.  Spark deals out pages, files and records; files live in the
shared folder and are opened through its file system.  A task names its file
freshly and only files that a finished task has reported are read, so a task
can be run again anywhere.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm.common import batch, id_back, id_key, in_task, ship, stage
from lshark.session import stage_path

LEVEL = 6
READ = 1 << 18
FILE_BYTES = 64 << 20        # payload after which a writer starts the next file
MOST_TASKS = 20_000
LEAST_REVISIT = 100          # payloads shorter than this are always written in full
GZIP = 31                    # zlib's window bits for gzip framing
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    """File system and path of a URI or a plain path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _out(uri: str):
    system, path = _open(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


# ------------------------------------------------------------------ records


def record(kind: str, name: str, url: str, digest: str, length: int, payload: bytes, refers: str | None) -> bytes:
    """A response, or a revisit without payload that names the record it repeats."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head[3:3] = [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Named fields of a record's or a response's head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


# ------------------------------------------------------------------ normaliser


class Inflated:
    """Bytes of a gzip file, one member or many, inflated once as they are read."""

    def __init__(self, stream):
        self.stream, self.inflater, self.held, self.raw = stream, zlib.decompressobj(GZIP), bytearray(), b""

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(READ)
                if not self.raw:
                    return False
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(GZIP)
            got = self.inflater.decompress(self.raw, READ)
            self.raw = self.inflater.unconsumed_tail or self.inflater.unused_data
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``; nothing at the end."""
        at, seen = self.held.find(mark), 0
        while at < 0:
            seen = max(len(self.held) - len(mark) + 1, 0)
            if not self._more():
                if self.held.strip():
                    raise ValueError("archive ends inside a record head")
                return b""
            at = self.held.find(mark, seen)
        return self._take(at + len(mark))

    def _take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        """``n`` bytes in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError("archive ends inside a record block")
            piece = self._take(min(n, len(self.held)))
            n -= len(piece)
            yield piece


def normalise(source: str, target: str, index: str, level: int = LEVEL) -> int:
    """Rewrite ``source`` with one gzip member per record and write the sidecar:
    a JSON line per record with its offset, length, name, type and URL.  Memory
    is bounded whatever the size of file or record."""
    system, path = _open(source)
    offset = count = 0
    with system.open_input_stream(path, compression=None) as raw, _out(target) as out, _out(index) as side:
        data = Inflated(raw)
        while head := data.until(b"\r\n\r\n").lstrip(b"\r\n"):
            fields = headers(head)
            packer, size = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0
            for piece in (head, *_chain(data, int(fields["content-length"]))):
                coded = packer.compress(piece)
                size += len(coded)
                out.write(coded)
            coded = packer.compress(b"\r\n\r\n") + packer.flush()
            out.write(coded)
            size += len(coded)
            side.write(json.dumps({"offset": offset, "length": size, "id": fields["warc-record-id"].strip("<>"),
                                   "type": fields["warc-type"], "url": fields.get("warc-target-uri", "")}).encode() + b"\n")
            offset += size
            count += 1
    return count


def _chain(data: Inflated, n: int) -> Iterator[bytes]:
    yield from data.exactly(n)
    for end in data.exactly(4):
        if end.strip(b"\r\n"):
            raise ValueError("record block is not followed by its end")


def read_record(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record whose member is there."""
    stream.seek(offset)
    data = zlib.decompress(stream.read(length), GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    return fields, rest[:int(fields["content-length"])]


# ------------------------------------------------------------------ on Spark


def described(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(p, url, html, digest, size)``, null html as empty."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.select(id_key(F.col(id_col)).alias("p"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                        html.alias("html")).withColumns({"digest": F.sha2("html", 256),
                                                         "size": F.octet_length("html").cast("bigint")})


def typed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with record type: the smallest id of equal payloads is the response."""
    known = described(pages, id_col, url_col, html_col)
    firsts = (known.where(F.col("size") >= least).groupBy("digest")
              .agg(F.min("p").alias("first"), F.count("*").alias("k")).where("k > 1").select("digest", "first"))
    firsts = stage(firsts, "repeated-payloads")
    joined = known.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("p") != F.col("first")) & (F.col("size") >= least)
    return joined.select("p", "url", "digest", "size", F.when(revisit, F.col("first")).alias("refers"),
                         F.when(~revisit, F.col("html")).alias("html"))


def write_archives(records: DataFrame, folder: str, level: int = LEVEL, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write typed pages as archives of a single gzip stream each; returns ``(file, records)``."""
    def run(batches):
        out = packer = name = None
        size = count = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("p", "url", "digest", "size", "refers", "html")),
                           strict=True):
                p, url, digest, length, refers, html = row
                if out is None:
                    name = f"{folder}/raw/{uuid.uuid4().hex}.warc.gz"
                    out, packer, size, count = _out(name), zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, 0
                kind = "response" if refers is None else "revisit"
                url = url.replace("\r", "%0D").replace("\n", "%0A")
                data = record(kind, f"urn:page:{p}", url, digest, length, (html or "").encode(),
                              None if refers is None else f"urn:page:{refers}")
                out.write(packer.compress(data))
                size += len(data)
                count += 1
                if size >= file_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
                    yield batch(["file", "records"], [pa.array([name]), pa.array([count], pa.int64())])
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield batch(["file", "records"], [pa.array([name]), pa.array([count], pa.int64())])

    return records.select("p", "url", "digest", "size", "refers", "html").mapInArrow(in_task(run), "file string, records long")


def _dealt(files: DataFrame) -> DataFrame:
    """A task per file (a few files from ``MOST_TASKS`` on).  The rows are tiny, so
    without a fixed number Spark would put them all into one task."""
    return files.repartition(max(1, min(files.count(), MOST_TASKS)), "file")


def normalise_archives(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Normalise every listed file; returns ``(file, index, records)``."""
    def run(batches):
        for b in batches:
            for source in b.column("file").to_pylist():
                name = f"{folder}/members/{uuid.uuid4().hex}"
                n = normalise(source, f"{name}.warc.gz", f"{name}.index", level)
                yield batch(["file", "index", "records"],
                            [pa.array([f"{name}.warc.gz"]), pa.array([f"{name}.index"]), pa.array([n], pa.int64())])

    return _dealt(files.select("file")).mapInArrow(in_task(run), "file string, index string, records long")


def read_archives(files: DataFrame) -> DataFrame:
    """Read records back by their index: ``(p, payload_bytes, payload_digest, record_type, refers)``.

    The digest of a response is computed from its payload and must equal the
    recorded one; a revisit states length and digest of what it repeats.
    """
    def number(name: str) -> int:
        return int(name.strip("<>").rpartition(":")[2])

    def run(batches):
        for b in batches:
            for path, index in zip(b.column("file").to_pylist(), b.column("index").to_pylist(), strict=True):
                system, place = _open(path)
                with system.open_input_file(place) as f, system.open_input_stream(_open(index)[1]) as side:
                    rows = []
                    for line in _lines(side):
                        at = json.loads(line)
                        fields, block = read_record(f, at["offset"], at["length"])
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].partition(":")[2]
                        size = int(headers(head)["content-length"])
                        if fields["warc-type"] == "response" and (
                                len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"damaged record {at['id']} in {path}")
                        refers = fields.get("warc-refers-to")
                        rows.append((number(at["id"]), size, digest, fields["warc-type"],
                                     None if refers is None else number(refers)))
                        if len(rows) == 4096:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    def _rows(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        return batch(["p", "payload_bytes", "payload_digest", "record_type", "refers"],
                     [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)])

    return _dealt(files.select("file", "index")).mapInArrow(
        in_task(run), "p long, payload_bytes long, payload_digest string, record_type string, refers long")


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while got := stream.read(READ):
        *whole, rest = (rest + got).split(b"\n")
        yield from whole
    if rest:
        yield rest


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", level: int = LEVEL) -> DataFrame:
    """Write pages as archives, normalise them and read them back:
    ``(id, payload_bytes, payload_digest, record_type, refers_to)``.

    Null html is an empty payload and null urls are empty; null ids come
    before all others and stay null.  Rows that repeat the id of a response
    with its payload are responses too.  An empty table writes no archive and
    gives an empty result.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or stage_path(spark, "llm-warc")           # goes with the stage scope
    raw = stage(write_archives(typed(pages, id_col, url_col, html_col), folder, level), "archives")
    done = stage(normalise_archives(raw, folder, level), "normalised")
    out = read_archives(done)
    return out.select(id_back(F.col("p")).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                      id_back(F.col("refers")).alias("refers_to"))
