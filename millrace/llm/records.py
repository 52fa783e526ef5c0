"""Token-id files: length-delimited binary records with masked checksums, and an offset index for shuffled reads.

A data file ``part-00000.rec`` is a row of frames, all numbers little-endian:

    length of the payload   8 bytes
    its masked checksum     4 bytes   of the 8 bytes before
    payload                 doc_id (8 bytes, signed), 1 byte: 1 if the row had an id, 1 byte: bytes per token id, ids
    masked checksum         4 bytes   of the payload

The masked checksum is crc32 turned right by 15 bits plus a constant, so that the checksum of data that holds
checksums stays sound. The index ``part-00000.idx`` holds the offset of every frame as 8 bytes each.

Rows lie in ascending order of id over all files, null ids first, equal ids by text. File boundaries are quantiles of
the ids, so files are even. Each file is written by one task under a name of its attempt and then renamed, so repeated
tasks leave the same files. The folder may be any that ``pyarrow.fs`` opens on all machines.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import memo, quantiles, saved, with_small_batches
from millrace.llm.token_ids import WordTokenizer

HEAD = struct.Struct("<QI")
FOOT = struct.Struct("<I")
FRONT = struct.Struct("<qBB")
#: Bytes read or written at a time.
BUFFER = 8 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + FOOT.pack(masked(size)) + payload + FOOT.pack(masked(payload))


def read_frame(source) -> bytes | None:
    """Next payload of an open file; None at its end. Damage raises."""
    head = source.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("record is cut off")
    size, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("length checksum differs")
    payload, foot = source.read(size), source.read(FOOT.size)
    if len(payload) < size or len(foot) < FOOT.size:
        raise ValueError("record is cut off")
    if masked(payload) != FOOT.unpack(foot)[0]:
        raise ValueError("payload checksum differs")
    return payload


@dataclass(frozen=True)
class Record:
    doc_id: int | None
    ids: np.ndarray  # unsigned 32-bit

    @staticmethod
    def parse(payload: bytes) -> Record:
        doc_id, has_id, width = FRONT.unpack_from(payload)
        ids = np.frombuffer(payload, f"<u{width}", offset=FRONT.size).astype("<u4")
        return Record(doc_id if has_id else None, ids)


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write_records(
    docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", files: int | None = None
) -> DataFrame:
    """Write the token ids of every row, ``end_id`` after each, and return the manifest.

    The manifest has one row per file (file, name, docs, tokens, bytes). Null text counts as empty. ``files`` is the
    number of files at most; by default the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    with_small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(quantiles(rows, "id", files), "int64")

    @F.pandas_udf("int")
    def file_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.zeros(len(ids), "int32")
        at[known] = np.searchsorted(bounds, ids[known].to_numpy("int64"), "left")
        return pd.Series(at)

    dealt = rows.withColumn("file", file_of("id")).repartitionById(len(bounds) + 1, F.col("file")).sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_file(batches, folder, tokenizer_file, end_id)

    return saved(dealt.mapInArrow(write, "file int, name string, docs long, tokens long, bytes long"), "manifest")


def _write_file(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_file: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Write the rows of one file and give its line of the manifest."""
    fs, top = _place(folder)
    tokens = memo(WordTokenizer, tokenizer_file)
    end, data, count, total, file = tokens.end(end_id), None, 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if data is None:
            file = batch.column("file")[0].as_py()
            fs.create_dir(top, recursive=True)
            own = f"{top}/.part-{file:05d}-{TaskContext.get().taskAttemptId()}"
            data = fs.open_output_stream(f"{own}.rec", buffer_size=BUFFER)
            index = fs.open_output_stream(f"{own}.idx", buffer_size=BUFFER)
            offset = 0
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("id").to_pylist(), tokens.encode_all(texts, end), strict=True):
            out = frame(FRONT.pack(doc_id or 0, doc_id is not None, tokens.width) + ids)
            data.write(out)
            index.write(struct.pack("<Q", offset))
            offset += len(out)
            count += 1
            total += len(ids) // tokens.width
    if data is not None:
        data.close()
        index.close()
        name = f"part-{file:05d}"
        fs.move(f"{own}.idx", f"{top}/{name}.idx")
        fs.move(f"{own}.rec", f"{top}/{name}.rec")
        yield pa.RecordBatch.from_pylist([{"file": file, "name": name, "docs": count, "tokens": total, "bytes": offset}], MANIFEST)


MANIFEST = pa.schema([("file", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """All records from the files: (doc_id, start, ids). ``start`` counts the ids of all records before.

    Every frame's checksums are verified. Each file is read as a stream by one task. The driver sees the manifest
    only, one row per file.
    """
    listed, start = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r["file"]):
        listed.append((len(listed), row["name"], start))
        start += row["tokens"]
    parts = spark.createDataFrame(listed, "part int, name string, start long").repartitionById(max(1, len(listed)), F.col("part"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _read_files(batches, folder)

    return parts.mapInArrow(read, "doc_id long, start long, ids binary")


def _read_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, top = _place(folder)
    for batch in batches:
        for row in batch.to_pylist():
            at, held, size = row["start"], [], 0
            with fs.open_input_stream(f"{top}/{row['name']}.rec", buffer_size=BUFFER) as source:
                while (payload := read_frame(source)) is not None:
                    record = Record.parse(payload)
                    held.append((record.doc_id, at, record.ids.tobytes()))
                    at += len(record.ids)
                    size += 4 * len(record.ids)
                    if size > BUFFER:
                        yield _records(held)
                        held, size = [], 0
            if held:
                yield _records(held)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    ids, starts, raw = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "start", "ids"])


def shuffled(folder: str, name: str, seed: int) -> Iterator[Record]:
    """The records of one file in a random order that ``seed`` fixes, each found by the index."""
    fs, top = _place(folder)
    with fs.open_input_file(f"{top}/{name}.idx") as index:
        offsets = np.frombuffer(index.read(), "<u8").tolist()
    random.Random(seed).shuffle(offsets)
    with fs.open_input_file(f"{top}/{name}.rec") as source:
        for offset in offsets:
            source.seek(offset)
            yield Record.parse(read_frame(source))
