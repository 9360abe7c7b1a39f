"""WARC derivative builder: responses to linked metadata and plain-text conversion records.

Every response gives two records that refer to it. The metadata record (application/warc-fields) keeps the response's HTTP
headers, its digests, the page's title, language and outlinks, and names the conversion record. The conversion record
(text/plain) has the page's text. Both carry WARC-Refers-To, WARC-Refers-To-Target-URI, WARC-Refers-To-Date, and the
digest of the response's payload as WARC-Source-Digest. Record ids follow from the response's id and the type, so a
repeated task makes the same records.

Scale: row by row, without an exchange; a task holds one batch of pages. Markup is read by one scanner that never goes back,
so the time is linear in the page. Reading takes whole files from Spark's binary source, a gzip member at a time; writing
makes one file for each partition, and only files that the manifest names count.

Defined results: a null page is an empty payload, whose text is empty; a null URL leaves the target URI out. A response
without an HTTP header is all payload. Chunked and gzip or deflate bodies are decoded for the text up to where they are
damaged; a body that only claims a coding is taken as it stands, and one in another coding has no text. Digests are of the
payload as it stands. The text is decoded by the header's charset, else, or where that is no charset of texts, as UTF-8, with
replacement. A payload that is text but not HTML is its own text, one that is no text has an empty one. Repeated pages give
repeated records; no pages give none; other columns are carried only where asked for. Malformed markup never fails: an open
comment, script or style runs to the end; a ``<`` that begins no tag is text, as is a tag that another ``<`` or the page's end
cuts off; of attributes with one name the first counts. In a file, a record without a length or cut off and a damaged gzip
member are problems, which ``read_problems`` lists; what stands behind them is read from the next record on.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from archivolt.llm._common import check_store, open_store, ship

CRLF = b"\r\n"
_BATCH_BYTES = 4 << 20
#: Elements that begin and end a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main"
    " nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text.
SILENT = frozenset("script style noscript template".split())
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)")
_STOP = re.compile(r"[<>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?|\"[^\"]*\"|'[^']*'")
#: Codecs that are no charset of texts.
_NO_CHARSET = frozenset("idna punycode undefined unicode_escape raw_unicode_escape".split())
_MAGIC = b"\x1f\x8b\x08"
_BREAKS = re.compile(r"[\n\r\x0b\x0c\x85\u2028\u2029]")


def _tag_end(page: str, at: int, unclosed: set[str]) -> tuple[int, bool]:
    """Where the tag whose attributes begin at ``at`` ends, and whether it does: behind its ``>``, or where it is cut off.

    ``unclosed`` gathers quotes that never come again, which then are plain characters.
    """
    while m := _STOP.search(page, at):
        c = m[0]
        if c == ">":
            return m.end(), True
        if c == "<":
            return m.start(), False
        close = -1 if c in unclosed else page.find(c, m.end())
        if close < 0:
            unclosed.add(c)
            at = m.end()
        else:
            at = close + 1
    return len(page), False


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content) of a page in order, each character once: text; open and close with the element's lower-case name
    and the attributes. Comments, declarations and the content of silent elements are left out."""
    at, low, unclosed = 0, None, set()
    while (begin := page.find("<", at)) >= 0:
        if begin > at:
            yield "text", "", page[at:begin]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else len(page)
        elif m := _NAME.match(page, begin + 1):
            name, closing = m[1].lower(), m[0][0] == "/"
            at, whole = _tag_end(page, m.end(), unclosed)
            if not whole:
                yield "text", "", page[begin:at]
                continue
            yield "close" if closing else "open", name, page[m.end() : at - 1]
            if name in SILENT and not closing:
                low = page.lower() if low is None else low
                at = low.find(f"</{name}", at) if len(low) == len(page) else _find_close(page, name, at)
                at = len(page) if at < 0 else at
        elif page[begin + 1 : begin + 2] in ("!", "?", "/"):
            end = page.find(">", begin + 2)
            at = end + 1 if end >= 0 else len(page)
            if end < 0:
                yield "text", "", page[begin:]
        else:
            yield "text", "", "<"
            at = begin + 1
    if at < len(page):
        yield "text", "", page[at:]


def _find_close(page: str, name: str, at: int) -> int:
    """For pages whose lower case has another length."""
    m = re.compile(f"</{name}", re.I).search(page, at)
    return m.start() if m else -1


def attribute(content: str, name: str) -> str | None:
    """The value of a tag's first attribute of that name, if it has one; text within quoted values is never an attribute."""
    for m in _ATTRIBUTE.finditer(content):
        if m[1] and m[1].lower() == name:
            value = next((v for v in m.groups()[1:] if v is not None), None)
            return None if value is None else html.unescape(value)
    return None


def read_page(page: str) -> tuple[str, str | None, str | None, list[str]]:
    """A page's text (entities resolved, a line for each block, no blank lines), its title, language and links."""
    parts, links, title, own, language = [], [], None, None, None
    for kind, name, content in scan(page):
        if kind == "text":
            parts.append(content)
            if own is not None:
                own.append(content)
            continue
        if name in BLOCKS:
            parts.append("\n")
        if name == "title":
            if kind == "open" and title is None:
                own = []
            elif kind == "close" and own is not None:
                title, own = _clean(html.unescape("".join(own))), None
        elif kind == "open" and name == "a" and (link := attribute(content, "href")) is not None:
            links.append(link)
        elif kind == "open" and name == "html" and language is None:
            language = (attribute(content, "lang") or "").strip().lower() or None
    lines = (" ".join(line.split()) for line in _BREAKS.split(html.unescape("".join(parts))))
    return "\n".join(line for line in lines if line), title, language, links


def plain_text(page: str) -> str:
    """See ``read_page``."""
    return read_page(page)[0]


def digest(block: bytes) -> str:
    """SHA-1 in base 32, as WARC digests are written."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()  # noqa: S324


def record_id(kind: str, source: str) -> str:
    """An id that follows from the kind of record and what it is made of."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {source}')}>"


def split_response(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """HTTP headers, the status line first with an empty name, and the payload."""
    head, gap, payload = block.partition(CRLF * 2)
    if not gap or not head.startswith(b"HTTP/"):
        return [], block
    lines = head.decode("latin-1").split("\r\n")
    fields = [line.partition(":") for line in lines[1:]]
    return [("", lines[0]), *((n.strip(), v.strip()) for n, _, v in fields)], payload


def _clean(value: str) -> str:
    return " ".join(value.split())


_SIZE = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;.*)?", re.S)


def dechunked(body: bytes) -> bytes:
    """A chunked body's content, as far as it is well formed; a body that isn't chunked stays."""
    out, at = [], 0
    while (end := body.find(CRLF, at)) >= 0 and (m := _SIZE.fullmatch(body, at, end)):
        size = int(m[1], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out) if out else body


def inflated(payload: bytes, coding: str) -> bytes:
    """A gzip or deflate body's content up to where it is damaged; a body that doesn't begin as one stays."""
    if coding != "deflate" and payload[:2] != _MAGIC[:2]:
        return payload
    out, rest = [], memoryview(payload)
    while len(rest) and (coding == "deflate" or rest[:2] == _MAGIC[:2]):
        stream = zlib.decompressobj(31 if coding != "deflate" else 15 if payload[:1] == b"\x78" else -15)
        try:
            for at in range(0, len(rest), 1 << 14):  # in steps, so that what comes before the damage stays
                out.append(stream.decompress(rest[at : at + (1 << 14)]))
                if stream.eof:
                    break
        except zlib.error:
            break
        if not stream.eof or coding == "deflate":
            break
        rest = rest[min(at + (1 << 14), len(rest)) - len(stream.unused_data) :]
    return b"".join(out)


def decoded_text(payload: bytes, charset: str | None) -> str:
    """A payload as text, with replacement; as UTF-8 where the charset isn't known or none of texts."""
    try:
        name = codecs.lookup(charset or "utf-8").name
        if name.replace("-", "_") not in _NO_CHARSET:
            return payload.decode(name, "replace")
    except (LookupError, ValueError):
        pass
    return payload.decode("utf-8", "replace")


def decoded_payload(headers: list[tuple[str, str]], payload: bytes) -> tuple[str, bool]:
    """The payload as text, and whether it is markup; empty where it is no text."""
    own = {n.lower(): v for n, v in headers}
    if "chunked" in own.get("transfer-encoding", "").lower():
        payload = dechunked(payload)
    coding = own.get("content-encoding", "").strip().lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        payload = inflated(payload, coding)
    elif coding not in ("", "identity"):
        payload = b""
    kind, _, rest = own.get("content-type", "text/html").partition(";")
    kind = kind.strip().lower()
    charset = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", rest, re.I)
    text = decoded_text(payload, charset[1] if charset else None)
    markup = "html" in kind or kind.endswith("xml") or not kind
    return (text, markup) if markup or kind.startswith("text/") else ("", False)


def derivatives(response: str, uri: str | None, date: str | None, block: bytes) -> list[tuple[str, str, list[tuple[str, str]], bytes]]:
    """(type, id, headers, block) of the metadata and the conversion record of one response."""
    headers, payload = split_response(block)
    page, markup = decoded_payload(headers, payload)
    text, title, language, links = read_page(page) if markup else (page, None, None, [])
    source = digest(payload)
    ids = {k: record_id(k, response) for k in ("metadata", "conversion")}
    fields = [("source-status" if not n else f"source-header-{n.lower()}", v) for n, v in headers]
    fields += [("source-block-digest", digest(block)), ("source-payload-digest", source), ("conversion-record", ids["conversion"])]
    if title is not None:
        fields.append(("title", title))
    if language is not None:
        fields.append(("language", language))
    for link in links:
        try:
            link = urljoin(uri or "", link)
        except ValueError:
            pass
        fields.append(("outlink", _clean(link)))
    described = "".join(f"{n}: {v}\r\n" for n, v in fields).encode()
    out = []
    for kind, content, own in (("metadata", "application/warc-fields", described), ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))):
        named = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date or "1970-01-01T00:00:00Z"), ("WARC-Refers-To", response)]
        if uri is not None:
            named += [("WARC-Target-URI", uri), ("WARC-Refers-To-Target-URI", uri)]
        if date is not None:
            named.append(("WARC-Refers-To-Date", date))
        named += [("WARC-Source-Digest", source), ("WARC-Block-Digest", digest(own)), ("Content-Type", content), ("Content-Length", str(len(own)))]
        out.append((kind, ids[kind], named, own))
    return out


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A whole WARC/1.1 record."""
    return b"WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in headers).encode() + CRLF + block + CRLF * 2


def _members(data: memoryview, piece: int = 1 << 16) -> Iterator[tuple[int, bytes, str | None]]:
    """(place, content, problem) of the members of a gzip file, one after another, in steps of ``piece`` bytes.

    Behind a damaged member the next place is taken whose first bytes unpack to the beginning of a record.
    """
    whole, at = bytes(data) if not isinstance(data.obj, bytes) else data.obj, 0
    while at < len(data):
        begin, member, out, problem = at, zlib.decompressobj(31), [], None
        try:
            while at < len(data) and not member.eof:
                out.append(member.decompress(data[at : at + piece]))
                at += min(piece, len(data) - at)
            at -= len(member.unused_data)
            problem = None if member.eof else "cut gzip member"
        except zlib.error:
            problem, at = "damaged gzip member", whole.find(_MAGIC, begin + 1)
            while at >= 0 and not _begins_record(data[at : at + 512]):
                at = whole.find(_MAGIC, at + 1)
            at = len(data) if at < 0 else at
        yield begin, b"".join(out), problem


def _begins_record(start: memoryview) -> bool:
    try:
        return zlib.decompressobj(31).decompress(start, 5) == b"WARC/"
    except zlib.error:
        return False


def _records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, str | None]]:
    """(place, headers, block, problem) of every record of a plain file."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.find(CRLF * 2, start)
        if end < 0:
            yield start, {}, b"", "cut record header"
            return
        fields = (line.partition(":") for line in data[start:end].decode("utf-8", "replace").split("\r\n")[1:])
        headers = {n.strip().lower(): v.strip() for n, _, v in fields}
        length = headers.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", length):
            yield start, headers, b"", "record without a length"
            at = end + 4
        elif end + 4 + int(length) > len(data):
            yield start, headers, b"", "cut record"
            at = end + 4
        else:
            at = end + 4 + int(length)
            yield start, headers, data[end + 4 : at], None


def checked_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, str | None]]:
    """(place in the file, headers with names in lower case, block, problem) of every record of a file, plain or one gzip
    member for each record; with a problem there is no block."""
    if data[:2] == _MAGIC[:2]:
        for begin, member, problem in _members(memoryview(data)):
            if problem:
                yield begin, {}, b"", problem
            else:
                yield from ((begin, *record) for _, *record in _records(member))
    else:
        yield from _records(data)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with names in lower case, block) of every whole record of a file."""
    return ((headers, block) for _, headers, block, problem in checked_records(data) if problem is None)


_RESPONSE = "record_id string, target_uri string, warc_date string, block binary"
_PROBLEM = "file string, place long, record_id string, problem string"


def _rows_of_files(spark: SparkSession, path: str, schema: str, rows_of: Callable[[str, bytes], Iterator[tuple]], weight: int | None) -> DataFrame:
    """Rows that ``rows_of`` makes of every file, in batches of bounded size; ``weight`` is the column that has the bytes."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = [(f.name, {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}[f.dataType.simpleString()]) for f in T._parse_datatype_string(schema).fields]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for row in rows_of(file, content.as_py()):
                    rows.append(row)
                    size += len(row[weight]) if weight is not None else 100
                    if size >= _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        yield batch_of(rows)

    return files.mapInArrow(run, schema)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, target_uri, warc_date, block) of the whole response records of WARC files, by any path that Spark can read."""

    def responses(_: str, content: bytes) -> Iterator[tuple]:
        for h, block in parse_records(content):
            if h.get("warc-type") == "response":
                yield h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), block

    return _rows_of_files(spark, path, _RESPONSE, responses, 3)


def read_problems(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, record_id, problem) of what ``read_responses`` leaves out of WARC files because it isn't whole."""

    def problems(file: str, content: bytes) -> Iterator[tuple]:
        return ((file, place, h.get("warc-record-id"), problem) for place, h, _, problem in checked_records(content) if problem)

    return _rows_of_files(spark, path, _PROBLEM, problems, None)


def responses_of_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> DataFrame:
    """The id column, and a response record for each page: record_id, target_uri, warc_date, block."""
    ship(pages.sparkSession)
    source = pages.select(id_col, url_col, html_col)
    schema = T.StructType([source.schema[id_col], *T._parse_datatype_string(_RESPONSE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages_ = (batch.column(c).to_pylist() for c in (id_col, url_col, html_col))
            blocks = []
            for page in pages_:
                body = (page or "").encode()
                blocks.append(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body)
            own = [record_id("response", f"{i} {u} {digest(b)}") for i, u, b in zip(ids, urls, blocks, strict=True)]
            columns = [batch.column(id_col), pa.array(own), pa.array(urls, pa.string()), pa.array([date] * len(own), pa.string()), pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


_HEADER = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))


def derive_records(responses: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Two rows for each response: the carried columns, warc_type, record_id, refers_to, target_uri, source_digest,
    block_digest, content_type, content_length, headers (in order) and block."""
    ship(responses.sparkSession)
    carry = carry or []
    out = "warc_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, content_type string"
    out += ", content_length long, headers array<struct<name:string,value:string>>, block binary"
    schema = T.StructType([*(responses.schema[c] for c in carry), *T._parse_datatype_string(out).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for i, (own, uri, date, block) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("record_id", "target_uri", "warc_date", "block")), strict=True)):
                for kind, rid, headers, content in derivatives(own, uri, date, block or b""):
                    h = dict(headers)
                    named = [{"name": n, "value": v} for n, v in headers]
                    rows.append([i, kind, rid, own, uri, h["WARC-Source-Digest"], h["WARC-Block-Digest"], h["Content-Type"], len(content), named, content])
            at, *columns = zip(*rows, strict=True) if rows else [[]] * 11
            arrays = [batch.column(c).take(pa.array(at, pa.int64())) for c in carry]
            kinds = [pa.string()] * 7 + [pa.int64(), _HEADER, pa.binary()]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=schema.names)

    columns = ["record_id", "target_uri", "warc_date", "block"]
    return responses.select(*dict.fromkeys([*carry, *columns])).mapInArrow(run, schema)


def write_records(records: DataFrame, folder: str) -> list[tuple[str, int]]:
    """Writes records with headers and block as gzip members; returns (path, records) of every file that counts."""
    ship(records.sparkSession)
    check_store(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for headers, block in zip(batch.column("headers").to_pylist(), batch.column("block").to_pylist(), strict=True):
                if stream is None:
                    fs, inner = open_store(path)
                    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    stream = fs.open_output_stream(inner, compression=None)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                stream.write(member.compress(serialise([(h["name"], h["value"]) for h in headers], block)) + member.flush())
                n += 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n": pa.array([n], pa.int64())})

    return [(r[0], r[1]) for r in records.select("headers", "block").mapInArrow(run, "path string, n long").collect()]
