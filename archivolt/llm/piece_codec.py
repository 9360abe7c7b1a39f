"""SentencePiece encoding and decoding with a distinct-chunk table of the corpus.

The normalised text begins with a whitespace marker and has one in place of every space. When no piece holds a marker
after another character, no piece crosses the start of a marker run, and pieces can be merged within such a chunk alone.
So each distinct marked word of the corpus is segmented once and its ids are joined back by position:

1. A pass over the texts (Arrow) names the distinct chunks of each block of ``BLOCK_BYTES`` of text, dealt into parts of the
   table by a checksum of the chunk: rows (part, block, chunks), the chunks in order and compressed.
2. An exchange by part brings all requests for a chunk to one task, which segments it once and answers every block.
3. An exchange by block sorts the answers into slots, files of some blocks with small row groups in the shared folder. There
   are more of them for more text, so that neither a slot nor the task that writes it grows with the input.
4. A second pass cuts the texts into the same blocks, reads each block's answers and joins them by position. A block is known
   by a digest of its chunks, so one that is cut otherwise the second time finds no answers and is segmented on the spot.

Texts do not move. What is exchanged is a block's distinct chunks and their ids, which grow slower than the text; a part of
the table is in memory once at a time, as is a block. A frequent chunk has a row for each block at most. Decoding uses the
same table: a chunk's ids never share a byte sequence with the next chunk's, so decoded chunks are joined by position too.

Defined results: null and empty texts have no ids and decode to the empty text. A very long text is a block of its own.
Repeated rows are encoded each; documents' other columns are carried as they are, but those whose names clash with results.
No documents give no rows. A model whose pieces can cross markers, or that normalises or trims, is refused.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.llm._common import check_store, open_store, scratch_path, ship, steps, text_bytes, trim_memory
from archivolt.llm.chunks import distinct_chunks

MARK = "▁"
#: Bytes of text in a block at most, within which each distinct chunk is asked for once; an Arrow batch bounds it too.
BLOCK_BYTES = 8_000_000
#: Times the session's shuffle partitions: into so many parts the table of distinct chunks is dealt.
PARTS_PER_PARTITION = 4
#: Chunks that are answered before their answers leave the task.
ANSWERED = 100_000
#: Shuffle partitions for each slot of answers, bytes of text for each where that gives more, and the bytes of a slot's row
#: groups.
PARTITIONS_PER_SLOT = 4
SLOT_BYTES = 128 << 20
GROUP_BYTES = 4 << 20
_MARK = MARK.encode()


def check_model(processor) -> None:
    """Raises unless chunks between whitespace markers can be encoded on their own."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(processor.serialized_model_proto())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
        raise ValueError("the model's normaliser changes texts; chunks can't be encoded on their own")
    if model.trainer_spec.treat_whitespace_as_suffix or any(MARK in p.piece.lstrip(MARK) for p in model.pieces):
        raise ValueError("pieces of this model cross whitespace markers")
    if any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in model.pieces):
        raise ValueError("user-defined pieces can cross whitespace markers")


def mark_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes (a space before each text that isn't empty), the starts of its chunks, and documents' bounds in them."""
    off = offsets - offsets[0]
    sizes = np.diff(off)
    full = sizes > 0
    shift = np.cumsum(full)
    out = np.full(int(off[-1] + shift[-1]) if len(shift) else 0, 32, np.uint8)
    if len(out):
        out[np.arange(off[-1]) + np.repeat(shift, sizes)] = data[offsets[0] : offsets[-1]]
    begin = off[:-1] + shift - full
    mark = out == 32
    after = np.zeros(len(out), bool)
    after[1:] = mark[:-1]
    lead = np.flatnonzero(out[: max(0, len(out) - 2)] == _MARK[0])
    lead = lead[(out[lead + 1] == _MARK[1]) & (out[lead + 2] == _MARK[2])]
    mark[lead] = True
    after[(lead + 3)[lead + 3 < len(out)]] = True
    cut = mark & ~after
    cut[begin[full]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(begin[1:], len(out)) if len(begin) else begin
    return out, starts, np.concatenate(([0], np.searchsorted(starts, ends)))


def packed(values: list[bytes]) -> bytes:
    """Byte strings in one compressed block: their lengths, then all of them; nothing for empty strings alone."""
    import zstandard

    sizes = np.array([len(v) for v in values], "<u4")
    if not sizes.any():
        return b""
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(values))


def unpacked(block: bytes, n: int) -> list[bytes]:
    """The ``n`` byte strings of a block."""
    import zstandard

    if not block:
        return [b""] * n
    data = zstandard.ZstdDecompressor().decompress(block)
    ends = 4 * n + np.concatenate(([0], np.cumsum(np.frombuffer(data, "<u4", n), dtype=np.int64)))
    ends = ends.tolist()
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class PieceCodec:
    """Encodes and decodes chunks; made once in each worker."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        check_model(self.sp)
        self.lone = [self.sp.piece_to_id(MARK)]
        self.width = "<u2" if self.sp.get_piece_size() <= 1 << 16 else "<u4"
        self.said = [f"{i},".encode() for i in range(self.sp.get_piece_size())]

    def encode(self, chunks: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Of each chunk: its ids as bytes, and its decoded bytes with the first marker, empty if that is the chunk itself."""
        texts = [(c[1:] if c[0] == 32 else c[3:]).decode() for c in chunks]
        ids = [i if t else self.lone for t, i in zip(texts, self.sp.encode(texts, num_threads=1), strict=True)]
        plain = (b" " + p.encode() for p in self.sp.decode(ids, num_threads=1))
        flat, at = np.array([x for i in ids for x in i], self.width).tobytes(), 0
        packed_ids, step = [], np.dtype(self.width).itemsize
        for i in ids:
            packed_ids.append(flat[at : at + step * len(i)])
            at += step * len(i)
        return packed_ids, [b"" if c == d else d for c, d in zip(chunks, plain, strict=True)]

    def decimals(self, ids: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Of each chunk: how many ids it has, and these as decimals with commas."""
        flat = np.frombuffer(b"".join(ids), self.width)
        counts = np.array([len(i) for i in ids], np.int64) // np.dtype(self.width).itemsize
        text = list(map(self.said.__getitem__, flat.tolist()))
        ends = np.concatenate(([0], np.cumsum(counts))).tolist()
        return counts, [text[a] if b == a + 1 else b"".join(text[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


_CODECS: dict[str, PieceCodec] = {}


def _codec(model_path: str) -> PieceCodec:
    if model_path not in _CODECS:
        _CODECS[model_path] = PieceCodec(model_path)
    return _CODECS[model_path]


class Block:
    """Some documents cut into chunks: the distinct ones, where each stands, and the parts of the table that hold them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, parts: int):
        out, starts, self.bounds = mark_chunks(data, offsets)
        self.chunks, self.at = distinct_chunks(out, starts)
        part = np.fromiter(map(zlib.crc32, self.chunks), np.int64, len(self.chunks)) % parts
        heads = np.frombuffer(b"".join([c[:8].ljust(8, b"\0") for c in self.chunks]), ">u8")  # like chunks side by side compress well
        order = np.lexsort((heads, part))
        self.order = order.tolist()
        self.parts, self.first = np.unique(part[order], return_index=True)
        ordered = [self.chunks[i] for i in self.order]
        sizes = np.array([len(c) for c in ordered], "<u4")
        self.key = hashlib.blake2b(sizes.tobytes() + b"".join(ordered), digest_size=16).hexdigest()

    def requests(self) -> Iterator[tuple[int, list[bytes]]]:
        """The chunks of each part, in order."""
        cuts = [*self.first.tolist(), len(self.order)]
        for part, a, b in zip(self.parts.tolist(), cuts, cuts[1:], strict=False):
            yield part, [self.chunks[i] for i in self.order[a:b]]

    def placed(self, answers: pa.Table) -> tuple[list[bytes], list[bytes]] | None:
        """The answers to all requests, by chunk; None unless they are complete."""
        answers = answers.sort_by("part")
        part = answers["part"].to_numpy()
        if len(part) > len(self.parts):  # equal blocks have equal answers
            answers = answers.take(pa.array(np.unique(part, return_index=True)[1]))
        if answers["part"].to_pylist() != self.parts.tolist() or sum(answers["n"].to_pylist()) != len(self.chunks):
            return None
        found = []
        for column in ("ids", "plain"):
            own: list[bytes] = [b""] * len(self.chunks)
            values = (v for block, n in zip(answers[column].to_pylist(), answers["n"].to_pylist(), strict=True) for v in unpacked(block, n))
            for i, v in zip(self.order, values, strict=True):
                own[i] = v
            found.append(own)
        return found[0], found[1]


_REQUEST = "part int, block string, n int, chunks binary"
_ANSWER = "part int, block string, n int, ids binary, plain binary"


def _answers(docs: DataFrame, model_path: str, text_col: str, parts: int, slots: int, path: str) -> None:
    """Writes the answers to every block's requests, a folder for each slot of blocks."""

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(0))
            for a, b in steps(off, BLOCK_BYTES):
                block = Block(data, off[a : b + 1], parts)
                rows = [(part, len(own), packed(own)) for part, own in block.requests()]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
                key = pa.array([block.key] * len(rows), pa.string())
                del block, rows
                yield pa.RecordBatch.from_arrays([columns[0], key, *columns[1:]], names=["part", "block", "n", "chunks"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now, known = _codec(model_path), -1, {}
        for batch in batches:
            first, ids, plain, size = 0, [], [], 0
            for k in range(batch.num_rows):
                part, n = batch.column("part")[k].as_py(), batch.column("n")[k].as_py()
                if part != now:
                    now, known = part, {}
                own = unpacked(batch.column("chunks")[k].as_py(), n)
                new = [c for c in own if c not in known]
                if new:
                    known.update(zip(new, zip(*codec.encode(new), strict=True), strict=True))
                ids.append(packed([known[c][0] for c in own]))
                plain.append(packed([known[c][1] for c in own]))
                size += n
                if size >= ANSWERED or k + 1 == batch.num_rows:
                    rows = k + 1 - first
                    columns = [*(batch.column(c).slice(first, rows) for c in ("part", "block", "n")), pa.array(ids, pa.binary()), pa.array(plain, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "n", "ids", "plain"])
                    first, ids, plain, size = k + 1, [], [], 0
        known.clear()
        trim_memory()

    asked = docs.select(text_col).mapInArrow(request, _REQUEST)
    dealt = asked.repartition("part").sortWithinPartitions("part", "block").mapInArrow(answer, _ANSWER)
    placed = dealt.withColumn("slot", (F.crc32("block") % slots).cast("int")).repartition(slots, "slot").sortWithinPartitions("slot", "block")
    placed.write.partitionBy("slot").option("parquet.block.size", str(GROUP_BYTES)).parquet(path)


def _read_block(path: str, slots: int, key: str) -> pa.Table | None:
    """A block's answers: the row groups of its slot that can hold them."""
    import pyarrow.parquet as pq

    fs, inner = open_store(path)
    folder = pafs.FileSelector(f"{inner}/slot={zlib.crc32(key.encode()) % slots}", allow_not_found=True)
    found = []
    for file in (f.path for f in fs.get_file_info(folder) if f.path.endswith(".parquet")):
        with fs.open_input_file(file) as stream:
            table = pq.ParquetFile(stream)
            at = table.schema_arrow.get_field_index("block")
            kept = []
            for k in range(table.num_row_groups):
                s = table.metadata.row_group(k).column(at).statistics
                if s is None or not s.has_min_max or s.min <= key <= s.max:
                    kept.append(k)
            rows = table.read_row_groups(kept, ["part", "block", "n", "ids", "plain"]) if kept else None
            if rows is not None:
                found.append(rows.filter(pc.equal(rows["block"], key)))
    return pa.concat_tables(found) if any(map(len, found)) else None


def encode_decode(
    docs: DataFrame, model_path: str, *, text_col: str = "text", carry: list[str] | None = None, with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """One row per document: the carried columns, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256
    (of the decoded text), and on request the ids and the decoded text. ``model_path`` is a path on every machine. Carried
    columns whose names clash with results are left out."""
    spark = docs.sparkSession
    ship(spark)
    results = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    results += [("ids", T.ArrayType(T.IntegerType()))] * with_ids + [("decoded", T.StringType())] * with_text
    names = {n for n, _ in results}
    carry = [c for c in (docs.columns if carry is None else carry) if c not in names]
    source = docs.select(*dict.fromkeys([*carry, text_col]))
    fields = [f for f in source.schema.fields if f.name in carry]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in results)])
    parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "chunk_answers")
    check_store(path)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    slots = max(1, parts // (PARTS_PER_PARTITION * PARTITIONS_PER_SLOT), -(-size // SLOT_BYTES))
    _answers(docs, model_path, text_col, parts, slots, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(text_col))
            for a, b in steps(off, BLOCK_BYTES):
                block = Block(data, off[a : b + 1], parts)
                answers = _read_block(path, slots, block.key)
                found = block.placed(answers) if answers is not None else None
                codec = _codec(model_path)
                ids, plain = found or codec.encode(block.chunks)
                changed = np.array([bool(p) for p in plain], bool)  # chunks that don't decode to themselves
                counts, decimals = codec.decimals(ids)
                total = np.concatenate(([0], np.cumsum(counts[block.at]))) if len(block.at) else np.zeros(1, np.int64)
                rows = []
                for d, (x, y) in enumerate(zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True), a):
                    own = block.at[x:y]
                    if changed[own].any():
                        text = b"".join([plain[i] or block.chunks[i] for i in own.tolist()])[1:]
                    else:
                        text = data[off[d] : off[d + 1]].tobytes()
                    own = own.tolist()
                    said = b"".join([decimals[i] for i in own])[:-1]
                    row = [int(total[y] - total[x]), hashlib.sha256(said).hexdigest(), hashlib.sha256(text).hexdigest()]
                    row += [np.frombuffer(b"".join([ids[i] for i in own]), codec.width).astype(np.int32)] * with_ids + [text.decode()] * with_text
                    rows.append(row)
                got = [pa.array(x, pa.list_(pa.int32()) if n == "ids" else None) for (n, _), x in zip(results, zip(*rows, strict=True), strict=True)]
                del block, answers, found, ids, plain, counts, decimals, total, rows
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name)[a:b] for f in fields), *got], names=schema.names)

    return source.mapInArrow(run, schema)
