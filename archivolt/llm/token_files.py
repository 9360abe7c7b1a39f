"""Token-id files: independent zstandard frames with a trailing seek table and per-frame checksums.

A file is: data frames of ``FRAME_IDS`` ids each (little-endian, 2 or 4 bytes an id; the last one shorter), then one index
frame with the documents' ids and lengths, then the seek table as a skippable frame: for each frame its compressed size,
its decompressed size and the low 32 bits of the XXH64 of its content, and a footer with the number of frames. A reader
takes the footer, the table and the index, and decompresses only the frames in which requested documents lie.

Writing: documents are range-partitioned by id and a hash of the text and sorted, so each file holds a range of ids in
ascending order and an id that a third of all rows share is dealt over files; a task
streams its documents through a worker's chunk table and holds one frame at a time, and a long document spans frames. Each
attempt of a task writes a file of its own name in the shared folder, and only files that the manifest names count, so a
repeated task does no harm. The manifest has one row for each file. Reading back: one task for each file.

Files grow with the input beyond ``MOST_FILES`` of ``FILE_BYTES`` of text each, so the manifest, which is on the driver,
stays small. Files of attempts that don't count are deleted.

Defined results: null and empty texts have no ids but the end id; a very long text is one vectorised step of its own.
Documents with a null id come first; equal ids are ordered by a hash of the text, and may fill several files. Equal rows lie
in one file. Ids must be numbers that fit a long. Other columns, whatever their names, are not read. No documents give no files.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.llm._common import check_store, open_store, scratch_path, ship, steps, text_bytes
from archivolt.llm.chunks import ChunkTable, distinct_chunks

FRAME_IDS = 1 << 16
FILE_BYTES = 32 << 20
MOST_FILES = 50_000
#: Fixed values of the published zstd seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX_MAGIC = b"AVTOK1\0\0"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def pretoken_chunks(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, chunk starts and documents' bounds in them; each chunk starts where a byte-level pre-token must start.

    That is so where white space follows a visible ASCII or Latin-1 letter or sign, and where ASCII punctuation follows a
    letter, unless an added token's text occurs, which may begin or end anywhere but at white space.
    """
    own = data[offsets[0] : offsets[-1]]
    off = offsets - offsets[0]
    before = np.zeros(len(own), np.uint8)
    before[1:] = own[:-1]
    latin = np.zeros(len(own), bool)
    latin[2:] = own[:-2] == 0xC3
    latin &= (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    visible = ((before > 32) & (before < 127)) | latin
    cut = _SPACE[own] & visible
    whole = own.tobytes()
    if not any(s in whole for s in special):
        cut |= _PUNCT[own] & (_LETTER[before] | latin)
    cut[off[:-1][np.diff(off) > 0]] = True
    starts = np.flatnonzero(cut)
    return own, starts, np.searchsorted(starts, off)


class IdEncoder:
    """Ids of whole texts by the tokenizers library, through a chunk table; made once in each worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.table = ChunkTable(self._encode, 1)

    def _encode(self, chunks: list[bytes]) -> list[tuple]:
        found = self.tok.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        return [(np.array(e.ids, f"<u{self.width}").tobytes(),) for e in found]

    def run(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """For each document its ids as bytes."""
        own, starts, bounds = pretoken_chunks(data, offsets, self.special)
        chunks, at = distinct_chunks(own, starts)
        (ids,) = self.table.columns_of(chunks)
        at = at.tolist()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield b"".join([ids[i] for i in at[a:b]])


_ENCODERS: dict[str, IdEncoder] = {}


def _encoder(path: str) -> IdEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def _checksum(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes one file to a binary stream; documents come in order."""

    def __init__(self, stream, width: int, level: int = 1):
        import zstandard

        self.stream, self.width = stream, width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.buffer = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.stream.write(packed)
        self.frames.append((len(packed), len(content), _checksum(content)))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Adds a document with its ids as bytes of the file's width."""
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // self.width)
        self.buffer += ids
        size = FRAME_IDS * self.width
        while len(self.buffer) >= size:
            self._frame(bytes(self.buffer[:size]))
            del self.buffer[:size]

    def close(self) -> None:
        """Writes the last data frame, the index and the seek table."""
        if self.buffer:
            self._frame(bytes(self.buffer))
        null = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        head = INDEX_MAGIC + struct.pack("<IIQ", self.width, FRAME_IDS, len(ids))
        self._frame(head + ids.tobytes() + np.array(self.lengths, "<u8").tobytes() + null.tobytes())
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE))


class TokenFileReader:
    """Random access to one file, given as a seekable binary stream."""

    def __init__(self, stream, size: int):
        self.stream, self.cached = stream, (-1, b"")
        stream.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        stream.seek(size - 9 - 12 * n)
        self.frames = np.frombuffer(stream.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.frames[:, 0])))
        index = self._frame(n - 1)
        if index[:8] != INDEX_MAGIC:
            raise ValueError("no document index")
        self.width, self.frame_ids, docs = struct.unpack("<IIQ", index[8:24])
        ids = np.frombuffer(index, "<i8", docs, 24)
        self.lengths = np.frombuffer(index, "<u8", docs, 24 + 8 * docs).astype(np.int64)
        null = np.frombuffer(index, np.uint8, docs, 24 + 16 * docs)
        self.doc_ids = [None if m else i for i, m in zip(ids.tolist(), null.tolist(), strict=True)]
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))

    def _frame(self, k: int) -> bytes:
        import zstandard

        if self.cached[0] != k:
            self.stream.seek(int(self.at[k]))
            content = zstandard.ZstdDecompressor().decompress(self.stream.read(int(self.frames[k, 0])))
            if len(content) != self.frames[k, 1] or _checksum(content) != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self.cached = (k, content)
        return self.cached[1]

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at a place in the file."""
        a, b = int(self.starts[place]), int(self.starts[place + 1])
        parts = []
        for k in range(a // self.frame_ids, -(-b // self.frame_ids)):
            base = k * self.frame_ids
            own = np.frombuffer(self._frame(k), f"<u{self.width}")
            parts.append(own[max(a - base, 0) : b - base])
        return np.concatenate(parts) if parts else np.zeros(0, f"<u{self.width}")


@dataclass(frozen=True)
class TokenFile:
    """A row of the manifest: a file, its number of documents and ids, and the number of ids in the files before it."""

    path: str
    documents: int
    ids: int
    before: int


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES
) -> list[TokenFile]:
    """Writes all documents' ids, each with the end id, in ascending order of their ids; returns the manifest."""
    ship(docs.sparkSession)
    check_store(folder)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-total // max(file_bytes, total // MOST_FILES)))
    keyed = source.withColumn("th", F.xxhash64("text"))
    dealt = keyed.repartitionByRange(files, F.asc_nulls_first("id"), "th").sortWithinPartitions(F.asc_nulls_first("id"), "th").select("id", "text", "th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        writer = stream = None
        first, path = None, f"{folder}/{uuid.uuid4().hex}.tok"
        for batch in batches:
            ids = batch.column("id").to_pylist()
            data, off = text_bytes(batch.column("text"))
            for a, b in steps(off, 4_000_000):
                if writer is None:
                    fs, inner = open_store(path)
                    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    stream = fs.open_output_stream(inner, compression=None)
                    writer, first = TokenFileWriter(stream, encoder.width), (ids[a], batch.column("th")[a].as_py())
                for doc_id, own in zip(ids[a:b], encoder.run(data, off[a : b + 1]), strict=True):
                    writer.add(doc_id, own + end)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "first": pa.array([first[0]], pa.int64()),
                    "th": pa.array([first[1]], pa.int64()),
                    "path": [path],
                    "documents": pa.array([len(writer.ids)], pa.int64()),
                    "ids": pa.array([sum(writer.lengths)], pa.int64()),
                }
            )

    rows = dealt.mapInArrow(run, "first long, th long, path string, documents long, ids long").collect()
    out, before = [], 0
    for r in sorted(rows, key=lambda r: (r.first is not None, r.first or 0, r.th)):
        out.append(TokenFile(r.path, r.documents, r.ids, before))
        before += r.ids
    if out:
        fs, inner = open_store(folder)
        counted = {f.path.rsplit("/", 1)[1] for f in out}
        for f in fs.get_file_info(pafs.FileSelector(inner)):
            if f.base_name not in counted:
                fs.delete_file(f.path)
    return out


def read_token_files(spark: SparkSession, files: list[TokenFile], *, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document, read from the files: its id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), and on request the ids."""
    ship(spark)
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = [(f.path, f.before) for f in files]
    listed = spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                fs, inner = open_store(path)
                with fs.open_input_file(inner) as stream:
                    reader = TokenFileReader(stream, stream.size())
                    for a in range(0, len(reader.doc_ids), 1000):
                        b = min(a + 1000, len(reader.doc_ids))
                        own = [reader.ids(i).astype("<u4") for i in range(a, b)]
                        got = {
                            id_col: pa.array(reader.doc_ids[a:b], pa.int64()),
                            "start": pa.array(before + reader.starts[a:b], pa.int64()),
                            "n_tokens": pa.array(reader.lengths[a:b], pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                        }
                        if with_ids:
                            got["ids"] = pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_pydict(got)

    return listed.mapInArrow(run, schema)


def read_documents(file: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Ids of the requested documents of one file; only their frames are decompressed."""
    fs, inner = open_store(file)
    with fs.open_input_file(inner) as stream:
        reader = TokenFileReader(stream, stream.size())
        wanted = set(doc_ids)
        return {d: reader.ids(i) for i, d in enumerate(reader.doc_ids) if d in wanted}


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' ids under the shared folder and reads every file back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    return read_token_files(spark, write_token_files(docs, tokenizer_path, folder, end_id=end_id, id_col=id_col, text_col=text_col), id_col=id_col)
