"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents, in ascending order of their ids, each document closed by an end id:

    magic "PFOR1\\0\\0\\0" | uint32 version, block length, documents, blocks | uint64 ids
    | int64 doc_id of each document | uint64 end of each document among the file's ids
    | uint64 start of each block among the block bytes, and their total | block bytes

A block holds up to BLOCK ids: uint32 minimum, uint16 ids, uint8 width, uint8 zero, uint32 exceptions; the ids less
the minimum in ``width`` bits each, the width being what PERCENTILE of them need, padded to 8 bytes; then the
places (uint16) and the high bits (uint32) of those that need more.  The block starts let a reader go to any id
without reading what is before it.  All integers are little-endian.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwork.llm.shared import documents, ready, shared_folder, stored, texts

MAGIC = b"PFOR1\0\0\0"
HEAD = struct.Struct("<8sIIIIIIQ")
VERSION = 2
BLOCK_HEAD = struct.Struct("<IHBBI")
BLOCK = 1024
#: Blocks that are packed at a time.
PACKED = 256
PERCENTILE = 0.9
END_ID = 0
#: Ids after which a task closes a file and opens the next one.
IDS_PER_FILE = 4_000_000
#: Segments of text whose ids a Python worker keeps; the half that is older goes when there are more.
KEPT_SEGMENTS = 500_000
LONGEST_KEPT = 64
#: New words that go to the library as one text.
JOINED = 400
ID = np.dtype("<u4")

# The characters with the Unicode property White_Space.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENTS = 800_000
LONGEST_KEPT = 64
#: New words that go to the library as one text.
JOINED = 400
ID = np.dtype("<u4")

# The characters with the Unicode property White_Space.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Latin letters before white space or one of these marks end a word for the tokenizer; an apostrophe may not.
_LETTER, _MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", r"""!"#$%&()*,./:;?@|-"""
_SEGMENT = re.compile(f"[{_WHITE}]*+[{_LETTER}]++(?=[{_WHITE}{re.escape(_MARK)}]|\\Z)|[{_WHITE}]*+[^{_WHITE}]++|[{_WHITE}]++")


# -- blocks ---------------------------------------------------------------------------------------------


def _widths(rest: np.ndarray) -> np.ndarray:
    """The bits that each number needs."""
    return np.frexp(rest.astype(np.float64))[1].astype(np.uint8)


def pack_block(ids: np.ndarray) -> bytes:
    """One block: minimum, bit-packed low parts, and the exceptions."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype("<u4")
    needed = _widths(rest)
    enough = np.cumsum(np.bincount(needed, minlength=33)) >= len(rest) * PERCENTILE
    width = int(np.argmax(enough))
    places = np.flatnonzero(needed > width).astype("<u2")
    high = (rest[places].astype(np.uint64) >> np.uint64(width)).astype("<u4")
    cell = "<u2" if width <= 16 else "<u4"
    bits = np.unpackbits(rest.astype(cell).view(np.uint8).reshape(len(rest), -1), axis=1, bitorder="little")
    packed = np.packbits(bits[:, :width], bitorder="little").tobytes()
    head = BLOCK_HEAD.pack(low, len(rest), width, 0, len(places))
    return b"".join([head, packed, b"\0" * (-len(packed) % 8), places.tobytes(), high.tobytes()])


def pack_blocks(flat: np.ndarray) -> list[bytes]:
    """All blocks of a file: those that are full by groups of equal width, the last one on its own."""
    full = len(flat) // BLOCK
    made: list[bytes] = [b""] * full
    for start in range(0, full, PACKED):
        part = flat[start * BLOCK : min(full, start + PACKED) * BLOCK].reshape(-1, BLOCK)
        low = part.min(axis=1)
        rest = part - low[:, None]
        needed = _widths(rest)
        most = math.ceil(BLOCK * PERCENTILE) - 1
        widths = np.partition(needed, most, axis=1)[:, most]
        for width in np.unique(widths).tolist():
            some = np.flatnonzero(widths == width)
            cell = "<u2" if width <= 16 else "<u4"
            bits = np.unpackbits(rest[some].astype(cell).view(np.uint8).reshape(len(some), BLOCK, -1), axis=2, bitorder="little")
            packed = np.packbits(bits[:, :, :width].reshape(len(some), -1), axis=1, bitorder="little")
            row, places = np.nonzero(needed[some] > width)
            high = (rest[some][row, places].astype(np.uint64) >> np.uint64(width)).astype("<u4")
            places, cuts = places.astype("<u2"), np.searchsorted(row, np.arange(len(some) + 1)).tolist()
            for i, block in enumerate(some.tolist()):
                a, b = cuts[i], cuts[i + 1]
                head = BLOCK_HEAD.pack(int(low[block]), BLOCK, width, 0, b - a)
                made[start + block] = head + packed[i].tobytes() + places[a:b].tobytes() + high[a:b].tobytes()
    if len(flat) > full * BLOCK:
        made.append(pack_block(flat[full * BLOCK :]))
    return made


def unpack_block(data: memoryview) -> np.ndarray:
    low, count, width, _, exceptions = BLOCK_HEAD.unpack_from(data)
    at, size = BLOCK_HEAD.size, (count * width + 7) // 8
    cell = "<u2" if width <= 16 else "<u4"
    bits = np.zeros((count, 8 * np.dtype(cell).itemsize), np.uint8)
    packed = np.frombuffer(data, np.uint8, size, at)
    bits[:, :width] = np.unpackbits(packed, count=count * width, bitorder="little").reshape(count, width)
    rest = np.packbits(bits, bitorder="little").view(cell).astype(np.uint32)
    at += size + -size % 8
    places = np.frombuffer(data, "<u2", exceptions, at)
    high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    rest[places] |= high << np.uint32(width)
    return (rest + np.uint32(low)).astype(ID)


# -- files ----------------------------------------------------------------------------------------------


def pack_file(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """A whole file from the documents' ids as little-endian unsigned 32-bit integers; documents without an id come last."""
    unnamed = doc_ids.count(None)
    if None in doc_ids[: len(doc_ids) - unnamed]:
        raise ValueError("documents without an id come last")
    flat = np.frombuffer(b"".join(ids), ID)
    ends = np.cumsum([len(x) // ID.itemsize for x in ids]).astype("<u8")
    blocks = pack_blocks(flat)
    starts = np.cumsum([0] + [len(b) for b in blocks]).astype("<u8")
    head = HEAD.pack(MAGIC, VERSION, BLOCK, len(doc_ids), len(blocks), unnamed, 0, len(flat))
    return b"".join([head, np.array([i or 0 for i in doc_ids], "<i8").tobytes(), ends.tobytes(), starts.tobytes(), *blocks])


def read_index(data: memoryview) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """doc_ids, ends of the documents, starts of the blocks, and where the blocks begin."""
    magic, version, block, n_docs, n_blocks, unnamed, _, _ = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION or block != BLOCK:
        raise ValueError("not a file of this format")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", n_docs, at).tolist()
    doc_ids[n_docs - unnamed :] = [None] * unnamed
    ends = np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    starts = np.frombuffer(data, "<u8", n_blocks + 1, at + 16 * n_docs).astype(np.int64)
    return doc_ids, ends, starts, at + 16 * n_docs + 8 * (n_blocks + 1)


def read_ids(data: memoryview, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a file; only the blocks that hold them are unpacked."""
    _, _, starts, base = read_index(data)
    first, last = start // BLOCK, -(-end // BLOCK)
    found = [unpack_block(data[base + starts[b] : base + starts[b + 1]]) for b in range(first, last)]
    return np.concatenate([np.zeros(0, ID), *found])[start - first * BLOCK : end - first * BLOCK]


def unpack_file(data: memoryview) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, start among the file's ids, and ids of each document, one after another."""
    doc_ids, ends, starts, base = read_index(data)
    held, at, block = np.zeros(0, ID), 0, 0  # unpacked ids, the place of the first, the next block
    start = 0
    for doc_id, end in zip(doc_ids, ends.tolist(), strict=True):
        parts, have = [held], at + len(held)
        while have < end:
            parts.append(unpack_block(data[base + starts[block] : base + starts[block + 1]]))
            have += len(parts[-1])
            block += 1
        held = np.concatenate(parts)[start - at :]
        at = start
        yield doc_id, start, held[: end - start]
        start = end


# -- encoding -------------------------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts as the tokenizers library gives them.

    A byte-level tokenizer splits text before it merges: always where white space follows something else, and where
    marks other than an apostrophe follow a letter.  So the ids of a text are those of its words, with the
    white space before them, one after another.  Words met before need no second call.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        # a byte-level token is spelled with one character a byte; added tokens are not joined with others
        self.byte_count = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.byte_count[i] = len(token)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _kept(self, segments: Iterable[str]) -> None:
        """Bring these segments into the newer half."""
        missing = []
        for segment in segments:
            known = self.older.get(segment)
            if known is None:
                missing.append(segment)
            else:
                self.newer[segment] = known
        joined = [s for s in missing if s[0] == " " and s[-1].isalpha()]
        for i in range(0, len(joined), JOINED):
            self._together(joined[i : i + JOINED])
        alone = [s for s in missing if s not in self.newer]
        for segment, e in zip(alone, self.library.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.newer[segment] = np.array(e.ids, ID).tobytes()

    def _together(self, segments: list[str]) -> None:
        """Encode words that a space opens as one text, and cut its ids where the words' bytes end."""
        encoded = self.library.encode_batch_fast(["".join(segments)], add_special_tokens=False)
        ids = np.array(encoded[0].ids, ID)
        ends = np.cumsum([len(s.encode()) for s in segments])
        cuts = np.searchsorted(np.cumsum(self.byte_count[ids]), ends) + 1
        if self.byte_count[ids].sum() == ends[-1]:
            spelled, size = ids.tobytes(), ID.itemsize
            for segment, start, end in zip(segments, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                self.newer[segment] = spelled[start * size : end * size]

    def encode(self, some: list[str | None]) -> list[bytes]:
        """Ids of each text, then the end id, as little-endian unsigned 32-bit integers."""
        if len(self.newer) >= KEPT_SEGMENTS // 2:
            self.older, self.newer = self.newer, {}
        end = np.array([END_ID], ID).tobytes()
        split = [_SEGMENT.findall(text) if text else [] for text in some]
        new = set().union(*split).difference(self.newer)
        self._kept(new)
        get = self.newer.__getitem__
        found = [b"".join(map(get, segments)) + end for segments in split]
        for segment in new:
            if len(segment) > LONGEST_KEPT:
                del self.newer[segment]
        return found


_encoders: dict[str, Encoder] = {}


def encoder_at(path: str) -> Encoder:
    """The tokenizer, read once in each Python worker; it starts no threads of its own there."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt, then move: readers never see half a file, and a second attempt replaces the first."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(made := f"{path}/_{name}.{uuid4().hex}") as out:
        out.write(data)
    system.move(made, f"{path}/{name}")


def _written(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Write the sorted documents of one partition; tell each file's name, and the partition's ids before it and in it."""
    encoder, partition = encoder_at(tokenizer), TaskContext.get().partitionId()
    doc_ids: list[int | None] = []
    ids: list[bytes] = []
    held = number = before = 0

    def close() -> pa.RecordBatch:
        nonlocal doc_ids, ids, held, number, before
        name = f"ids-{partition:08d}-{number:06d}.pfor"
        _put(folder, name, pack_file(doc_ids, ids))
        told = pa.RecordBatch.from_pylist([{"file": name, "part": partition, "before": before, "n_ids": held}])
        doc_ids, ids, held, number, before = [], [], 0, number + 1, before + held
        return told

    for batch in batches:
        for doc_id, spelled in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch)), strict=True):
            doc_ids.append(doc_id)
            ids.append(spelled)
            held += len(spelled) // ID.itemsize
            if held >= IDS_PER_FILE:
                yield close()
    if doc_ids:
        yield close()


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, *, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the ids of all documents to files below ``folder``, in ascending order of doc_id, and return the files: file, first (its first id's number).

    Documents are dealt out by ranges of doc_id and sorted there, so file names sort as their documents do.  Null texts
    count as empty and have the end id alone; rows of equal doc_id stay side by side, ordered by text; rows without a
    doc_id come after all others; an empty table makes no file.  The driver gets one row for each partition; the
    table of files, one row for every IDS_PER_FILE ids, is written to the shared folder.
    """
    spark = docs.sparkSession
    ready(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = documents(docs, id_col, text_col)
    # the text orders rows of equal doc_id, and no more
    order = F.col("doc_id").asc_nulls_last()
    dealt = told.repartitionByRange(partitions, order).sortWithinPartitions(order, "text")
    write = partial(_written, folder=folder, tokenizer=tokenizer)
    files = stored(dealt.mapInArrow(write, "file string, part long, before long, n_ids long"), "id-files")
    totals = sorted(tuple(r) for r in files.groupBy("part").agg(F.sum("n_ids")).collect())
    firsts = np.cumsum([0] + [n for _, n in totals]).tolist()
    if not totals:
        return files.select("file", F.col("before").alias("first"))
    of_part = F.create_map(*[F.lit(x) for (part, _), first in zip(totals, firsts, strict=False) for x in (part, first)])
    return files.select("file", (of_part[F.col("part")] + F.col("before")).alias("first"))


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with system.open_input_stream(f"{path}/{row['file']}") as told:
                data = memoryview(told.read())
            out: list[tuple[int | None, int, np.ndarray]] = []
            held = 0
            for doc in unpack_file(data):
                out.append(doc)
                held += len(doc[2])
                if held > 500_000:
                    yield _rows(out, row["first"])
                    out, held = [], 0
            if out:
                yield _rows(out, row["first"])


def _rows(out: list[tuple[int | None, int, np.ndarray]], first: int) -> pa.RecordBatch:
    ends = np.cumsum([0] + [len(ids) for _, _, ids in out])
    flat = np.concatenate([ids for _, _, ids in out])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _, _ in out], pa.int64()),
            pa.array([first + s for _, s, _ in out], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view("<i4"), pa.int32())),
        ],
        ["doc_id", "start", "ids"],
    )


def read_back(files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), ids (array<int>, the end id included)."""
    spark = files.sparkSession
    # files are of like size; a task reads several where there are many
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(tasks).mapInArrow(partial(_read, folder=folder), "doc_id long, start long, ids array<int>")


def crc32(ids: Iterable[np.ndarray]) -> list[int]:
    return [zlib.crc32(np.ascontiguousarray(x, ID)) for x in ids]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        flat, ends = lists.values.to_numpy().view(ID), lists.offsets.to_numpy()
        sums = crc32(flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        counts = pa.array(np.diff(ends).astype(np.int64), pa.int64())
        columns = [batch.column(0), batch.column(1), counts, pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read_back`` returns."""
    return ids.mapInArrow(_sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **columns: str) -> DataFrame:
    """Write the ids of all documents to a new shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "ids")
    return read_back(write_ids(docs, folder, tokenizer, **columns), folder)
