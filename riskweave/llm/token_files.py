"""Token ids in length-delimited binary records, with a separate index of offsets.

A record is: length of the data (8 bytes, little-endian), masked CRC-32C of these 8 bytes, the data, masked CRC-32C of
the data; the layout of TFRecord files. The data are the ids of one document in the narrowest of 2 and 4 bytes that
holds the vocabulary. Documents stand in ascending order of doc_id over the files and inside each. The index, a
Parquet table, gives file, offset and size of every record, so that readers can fetch records in any order.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import zlib
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.scratch import new_folder, small_batches
from riskweave.llm.word_encoder import word_encoder

HEADER, FOOTER = 12, 4
#: Reflected polynomial of CRC-32C, and the mask of the record format (fixed values).
POLYNOMIAL, MASK_DELTA = 0x82F63B78, 0xA282EAD8
INDEX = "doc_id long, file string, offset long, size long, n_tokens long, shard int, position long"


# --- checksum ------------------------------------------------------------------------------------------------------
class Crc32c:
    """CRC-32C of byte arrays, by tables over whole blocks: the checksum is linear in the bits of the message."""

    BLOCK = 256

    def __init__(self):
        steps = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
        self.steps = steps.astype(np.uint32)
        #: what a byte adds when it stands so many bytes before the end of a block
        self.table = np.empty((self.BLOCK, 256), np.uint32)
        row = self.steps.copy()
        for back in range(self.BLOCK):
            self.table[self.BLOCK - 1 - back] = row
            row = self.steps[row & 0xFF] ^ (row >> 8)
        self.rows = np.arange(self.BLOCK)
        #: shifts[k]: a register moved on by 2**k zero bytes, by byte of the register
        self.shifts = [np.stack([self._zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * i)) for i in range(4)])]
        while len(self.shifts) < 48:
            last = len(self.shifts) - 1
            self.shifts.append(np.stack([self._shift(t, last) for t in self.shifts[-1]]))

    def _zeros(self, register: np.ndarray) -> np.ndarray:
        return self.steps[register & 0xFF] ^ (register >> 8)

    def _shift(self, register: np.ndarray, power: int) -> np.ndarray:
        t = self.shifts[power]
        return t[0][register & 0xFF] ^ t[1][(register >> 8) & 0xFF] ^ t[2][(register >> 16) & 0xFF] ^ t[3][register >> 24]

    def __call__(self, messages: list[bytes]) -> list[int]:
        """Checksums of many messages, those with equally many blocks at once."""
        lengths = np.array([len(m) for m in messages], np.int64)
        start = np.full(len(messages), 0xFFFFFFFF, np.uint32)
        for power in range(int(lengths.max(initial=0)).bit_length()):
            moved = (lengths >> power & 1).astype(bool)
            start[moved] = self._shift(start[moved], power)
        levels = np.array([max(0, (-(-n // self.BLOCK) - 1)).bit_length() for n in lengths.tolist()])
        sums = np.zeros(len(messages), np.uint32)
        for level in np.unique(levels).tolist():
            own, width = np.flatnonzero(levels == level), self.BLOCK << level
            for at in range(0, len(own), max(1, (1 << 20) // width)):
                part = own[at: at + max(1, (1 << 20) // width)].tolist()
                # zeros before a message change nothing
                filled = np.frombuffer(b"".join([messages[k].rjust(width, b"\0") for k in part]), np.uint8)
                some = np.bitwise_xor.reduce(self.table[self.rows, filled.reshape(len(part), -1, self.BLOCK)], axis=2)
                for step in range(level):
                    some = self._shift(some[:, 0::2], self.BLOCK.bit_length() - 1 + step) ^ some[:, 1::2]
                sums[part] = some[:, 0]
        return (sums ^ start ^ np.uint32(0xFFFFFFFF)).tolist()


@lru_cache(1)
def crc32c() -> Crc32c:
    return Crc32c()


def masked(checksums: list[int]) -> list[int]:
    return [(((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF for c in checksums]


def framed(messages: list[bytes]) -> list[bytes]:
    """A record for each message."""
    crc, heads = crc32c(), [struct.pack("<Q", len(m)) for m in messages]
    checks = zip(heads, masked(crc(heads)), messages, masked(crc(messages)))
    return [b"".join([head, struct.pack("<I", a), data, struct.pack("<I", b)]) for head, a, data, b in checks]


def unframe(records: list[bytes]) -> list[bytes]:
    """The data of records; an error if a checksum or a length is wrong."""
    crc, heads, data = crc32c(), [r[:8] for r in records], [r[HEADER: -FOOTER] for r in records]
    for record, a, message, b in zip(records, masked(crc(heads)), data, masked(crc(data))):
        if len(record) < HEADER + FOOTER or struct.unpack_from("<QI", record) != (len(message), a):
            raise ValueError("damaged record header")
        if struct.unpack_from("<I", record, len(record) - FOOTER)[0] != b:
            raise ValueError("damaged record data")
    return data


# --- files ---------------------------------------------------------------------------------------------------------
def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write record files and an index below ``folder`` (a URI), return the index.

    Null and empty texts give a record that holds the end id alone. Rows are dealt out by ranges of doc_id and the
    hash of the text and sorted in each; null ids come first, repeated rows give a record each. Other columns are
    ignored. A file is written under a name of its attempt and renamed, so a task that runs twice leaves one file.
    """
    from pyspark import TaskContext

    spark = docs.sparkSession
    ordered = (small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .withColumn("place", F.xxhash64("text")).repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(vocabulary)
        end = np.array([end_id], own.kind).tobytes()
        context = TaskContext.get()
        shard, files, done = context.partitionId(), None, 0
        name = f"tokens-{shard:06d}.{own.kind.str[1:]}"
        trial = f"_{name}.{context.taskAttemptId()}"
        position = 0
        for rows in batches:
            if files is None:
                files, base = _store(folder)
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/{trial}")
            ids, borders = own.encode(rows.column("text"))
            data, ends = ids.tobytes(), (borders * own.kind.itemsize).tolist()
            sizes = []
            for record in framed([data[a:b] + end for a, b in zip(ends, ends[1:])]):
                out.write(record)
                sizes.append(len(record))
            n = len(sizes)
            upto = np.cumsum(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column("doc_id"), "file": pa.array([name] * n), "offset": done + upto - sizes, "size": pa.array(sizes, pa.int64()),
                "n_tokens": np.diff(borders) + 1, "shard": pa.array([shard] * n, pa.int32()), "position": np.arange(position, position + n)})
            done += int(upto[-1]) if n else 0
            position += n
        if files is not None:
            out.close()
            files.move(f"{base}/{trial}", f"{base}/{name}")

    ordered.select("doc_id", "text").mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index and start: ids of all records before each, counted over shards and then inside them."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))  # one row per file
    before = totals.select("shard", F.coalesce(F.sum("total").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        before, "shard").withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def _read(index: DataFrame, folder: str, added: str, make: Callable[[list[bytes], list[int]], dict[str, list]]) -> DataFrame:
    """The columns of ``index`` and those that ``make`` adds from the data of records and the bytes of an id."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[str, pyarrow.NativeFile] = {}
        files = None
        for rows in frames:
            if files is None:
                files, base = _store(folder)
            for at in range(0, len(rows), 256):
                part = rows.iloc[at: at + 256]
                data = []
                for name, offset, size in zip(part["file"], part["offset"], part["size"]):
                    if name not in opened:
                        for old in opened.values():
                            old.close()
                        opened = {name: files.open_input_file(f"{base}/{name}")}
                    data.append(opened[name].read_at(int(size), int(offset)))
                yield part.assign(**make(unframe(data), [int(n.rpartition(".u")[2]) for n in part["file"]]))

    return index.mapInPandas(run, f"{columns}, {added}")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Records named by rows of ``index``: its columns and data (bytes), item_bytes (2 or 4). Checksums are verified.

    Rows are read in the order they come, each from its own offset, so a shuffled index reads shuffled records.
    """
    return _read(index, folder, "data binary, item_bytes int", lambda data, widths: {"data": data, "item_bytes": widths})


def digest_token_files(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as 4 bytes each) of the records, from the files.

    One Python step reads and digests: a second one would keep twice as many workers in memory.
    """
    def make(data: list[bytes], widths: list[int]) -> dict[str, list]:
        ids = [np.frombuffer(d, f"<u{w}").astype("<u4") for d, w in zip(data, widths)]
        return {"n_read": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids]}

    return _read(with_starts(index), folder, "n_read long, ids_crc32 long", make).select(
        "doc_id", "start", F.col("n_read").alias("n_tokens"), "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write ``docs`` into token files (by default in a new folder of the shared store) and read all of them back."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    index = write_token_files(docs, folder, vocabulary, end_id)
    return digest_token_files(index, folder)
