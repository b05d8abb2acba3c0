"""Token ids in files of byte or bit planes, written and read by Spark.

A file image holds whole documents: their ids are cut into blocks of fixed size, each block is transposed
into planes (bit or byte k of every id together), each plane is compressed with zstandard, and an index of
block and plane lengths stands before the data, so that one block can be read alone. The images are rows
of a Parquet table (``part``, ``seq``, ``n_ids``, ``part_start``, ``content``), since that is what Spark
can write to any store. Ids are at most 32 bits.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbana.llm.arrow import slices, texts
from urbana.llm.pieces import Words

MAGIC = b"URBPLN01"
BLOCK = 65536  # ids of a block
FILE_IDS = 1 << 20  # a file image is closed when it has as many ids
LEVEL = 3
WORDS = 300_000  # words a worker keeps
PIECES = 400_000  # pieces of words a worker keeps


# --- the file format ------------------------------------------------------------------------------


def _planes(block: np.ndarray, bit: bool) -> list[bytes]:
    width = max(1, int(block.max()).bit_length())
    if not bit:
        raw = block.view(np.uint8).reshape(-1, 4)
        return [raw[:, p].tobytes() for p in range((width + 7) // 8)]
    bits = np.unpackbits(block.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return [x.tobytes() for x in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def _block(planes: list[bytes], n: int, bit: bool) -> np.ndarray:
    if not bit:
        raw = np.zeros((n, 4), np.uint8)
        for p, x in enumerate(planes):
            raw[:, p] = np.frombuffer(x, np.uint8)
        return raw.view("<u4").ravel()
    rows = np.stack([np.frombuffer(x, np.uint8) for x in planes])
    bits = np.zeros((n, 32), np.uint8)
    bits[:, : len(planes)] = np.unpackbits(rows, axis=1, count=n, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block: int = BLOCK, bit: bool = False, level: int = LEVEL) -> bytes:
    """The file image of documents one after another."""
    pack = zstandard.ZstdCompressor(level=level).compress
    ids = np.ascontiguousarray(ids, "<u4")
    index, data = [], []
    for lo in range(0, len(ids), block):
        planes = [pack(x) for x in _planes(ids[lo : lo + block], bit)]
        index.append(struct.pack(f"<I{len(planes)}I", len(planes), *map(len, planes)))
        data += planes
    known = np.array([x is not None for x in doc_ids], np.uint8).tobytes()
    names = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    table = pack(known + names + np.array(lengths, "<u8").tobytes())
    head = MAGIC + struct.pack("<IBQQII", block, bit, len(ids), len(doc_ids), len(table), sum(map(len, index)))
    image = b"".join([head, table, *index, *data])
    return image + struct.pack("<I", zlib.crc32(image))


def load(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a file image. Raises ValueError if it is damaged."""
    if image[:8] != MAGIC or zlib.crc32(memoryview(image)[:-4]) != struct.unpack("<I", image[-4:])[0]:
        raise ValueError("damaged token file")
    block, bit, n, docs, table, index = struct.unpack_from("<IBQQII", image, 8)
    at = 8 + struct.calcsize("<IBQQII")
    unpack = zstandard.ZstdDecompressor().decompress
    raw = unpack(image[at : at + table])
    known = np.frombuffer(raw, np.uint8, docs)
    names = np.frombuffer(raw, "<i8", docs, docs)
    lengths = np.frombuffer(raw, "<u8", docs, 9 * docs).astype(np.int64)
    at += table
    data, out = at + index, np.empty(n, "<u4")
    for lo in range(0, n, block):
        (planes,) = struct.unpack_from("<I", image, at)
        sizes = struct.unpack_from(f"<{planes}I", image, at + 4)
        at += 4 + 4 * planes
        got = []
        for size in sizes:
            got.append(unpack(image[data : data + size]))
            data += size
        out[lo : lo + block] = _block(got, min(block, n - lo), bool(bit))
    return [int(x) if k else None for x, k in zip(names, known, strict=True)], lengths, out


def load_block(image: bytes, number: int) -> np.ndarray:
    """The ids of one block of a file image, found by the index; no other block is decompressed."""
    block, bit, n, _, table, index = struct.unpack_from("<IBQQII", image, 8)
    if not 0 <= number < -(-n // block):
        raise IndexError(f"no block {number}")
    at = 8 + struct.calcsize("<IBQQII") + table
    data = at + index
    for _ in range(number + 1):
        (planes,) = struct.unpack_from("<I", image, at)
        sizes = struct.unpack_from(f"<{planes}I", image, at + 4)
        at, data = at + 4 + 4 * planes, data + sum(sizes)
    data -= sum(sizes)
    starts = np.cumsum([data, *sizes]).tolist()
    unpack = zstandard.ZstdDecompressor().decompress
    return _block([unpack(image[a:b]) for a, b in zip(starts, starts[1:], strict=False)], min(block, n - number * block), bool(bit))


# --- encoding ---------------------------------------------------------------------------------------


class ByteLevel:
    """The tokenizers library's byte-level BPE, asked once for each word that occurs.

    A word goes with the one space before it. Where white space is only single spaces and line ends, words
    are found by splitting; else by the pattern that keeps them apart from other white space; texts with
    special tokens or control characters that count as white space go to the library as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.odd = [*special, *"\x1c\x1d\x1e\x1f"]
        # White space other than a space or line end, and two of those together.
        self.other_space = ["  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
        self.word = re.compile(r" ?\S+|\s+(?!\S)|\s+")
        self.tok, self.model, self.pretokens = tok, tok.model, tok.pre_tokenizer.pre_tokenize_str
        # How the library writes bytes as letters: printable Latin-1 stands for itself, the others for letters from U+0100.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.letters = {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}
        self.pieces = Words(self.piece, PIECES)
        self.plain = Words(self.part, WORDS)
        self.spaced = Words(lambda w: self.part(" " + w), WORDS)
        self.newline = self.part("\n")

    def piece(self, piece: str) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in self.model.tokenize(piece)]) else b""

    def part(self, text: str) -> bytes:
        """Ids of a text without special tokens. A Latin word, with or without one mark after it, is split here, others by the library."""
        end = text[-1:]
        core = text[:-1] if end in ".,!" and end else text
        word = core[1:] if core[:1] == " " else core
        if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
            mapped = core.encode().decode("latin-1").translate(self.letters)
            return self.pieces[mapped] if core is text else self.pieces[mapped] + self.pieces[end]
        return b"".join([self.pieces[p] for p, _ in self.pretokens(text)])

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(x in text for x in self.odd):
            return self.whole(text)
        if any(x in text for x in self.other_space):
            return b"".join(map(self.plain.__getitem__, self.word.findall(text)))
        plain, spaced, out = self.plain.__getitem__, self.spaced.__getitem__, []
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if i:
                out.append(self.newline)
            if words[0]:
                out.append(plain(words[0]))
            out += map(spaced, words[1:])
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteLevel:
    return ByteLevel(path)


# --- Spark ------------------------------------------------------------------------------------------


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS, bit: bool = False) -> None:
    """Write the ids of every document, each followed by ``end_id``, in ascending id order (null ids first, ties by text).

    Null texts are empty; repeated rows are written each; other columns are not read; an empty table gives no file images. Texts are
    dealt by ranges of the id and a hash of the text, so a task holds one file image at a time, however many rows share an id.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        names: list[int | None] = []
        parts: list[bytes] = []
        seq = start = held = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            image = dump(names, [len(x) // 4 for x in parts], ids, block, bit)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([start], pa.int64()), pa.array([image], pa.binary())], names=["part", "seq", "n_ids", "part_start", "content"])

        for b in slices(batches):
            for i, t in zip(b.column(0).to_pylist(), texts(b, "text"), strict=True):
                names.append(i)
                parts.append(model.encode(t.decode()) + end)
                held += len(parts[-1]) // 4
                if held >= file_ids:
                    yield close()
                    seq, start, held = seq + 1, start + held, 0
                    names.clear()
                    parts.clear()
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    images = ordered.mapInArrow(run, "part int, seq bigint, n_ids bigint, part_start bigint, content binary")
    images.write.option("compression", "uncompressed").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files: where its ids start among all ids, and its ids (binary, little-endian 32 bit).

    Repeated rows are read back as they were written, and files of an empty table give none. A task holds one file image, which ends with the document that fills it.
    """
    files = spark.read.parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row for each writing task
    offset, before = {}, 0
    for r in totals:
        offset[r["part"]] = before
        before += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, image in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                names, lengths, ids = load(image)
                ends = np.cumsum(lengths)
                raw = ids.tobytes()
                each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                starts = offset[part] + start + ends - lengths
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(starts), pa.array(each, pa.binary())], names=["doc_id", "start", "ids"])

    return files.select("part", "part_start", "content").mapInArrow(run, "doc_id bigint, start bigint, ids binary")
