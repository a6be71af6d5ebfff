"""Token-ID files: length-delimited binary records with masked checksums, and a separate offset index.

A shard ``part-NNNNNN.rec`` is a sequence of records, one per document in ascending doc_id order over all shards:

    length   8 bytes   unsigned, of the payload
    check    4 bytes   masked CRC-32 of the length's bytes
    payload            token ids as little-endian unsigned integers of 2 bytes (ids below 65,536) or 4
    check    4 bytes   masked CRC-32 of the payload

The mask rotates the checksum right by 15 bits and adds 0xA282EAD8, so that checksums of data that hold checksums
stay useful. The index ``part-NNNNNN.idx`` has 32 bytes for each record: doc_id (signed; ``NO_ID`` for null), the
record's place in the shard, its number of tokens, and the tokens before it in the shard. A reader can thus
fetch any record by one seek, in any shuffled order.

Shards follow the input: ranges of doc_id, as many as hold ``SHARD_BYTES`` of text each on average, and no fewer than
there are cores as long as each has ``LEAST_BYTES``. Index entries are written as they come, so a task's memory holds
one slice of texts however large its shard is. The report reads each shard and its index in one pass from front to
back; seeks are for the shuffled reader alone.

A task writes to a name of its own and renames at the end, so a task that is run again after a lost executor,
or twice by speculation, leaves one whole shard. The manifest (one row per shard) is a Parquet table. Files are
written and read through pyarrow's file systems, at a URI in the folder that driver and executors share.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import new_path
from offerweave.llm.word_encoder import encoder
from offerweave.llm.words import buffers, slices

NO_ID = -(1 << 63)
INDEX = np.dtype([("doc_id", "<i8"), ("place", "<u8"), ("tokens", "<u8"), ("before", "<u8")])
SHARD_BYTES = 256 << 20
LEAST_BYTES = 1 << 20
ROW_BYTES = 48  # what a record has besides its text's ids, index entry included
READ = 4096  # records of a batch of the report
BUFFER = 1 << 20
_MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def _exactly(stream, size: int) -> bytes:
    """So many bytes, or those that are left: some stores' streams give fewer at a time."""
    data = stream.read(size)
    while len(data) < size and (more := stream.read(size - len(data))):
        data += more
    return data


def next_record(stream, place: int) -> bytes:
    """The payload of the record that the stream stands at, which is ``place``; ValueError if it is damaged."""
    head = _exactly(stream, 12)
    if len(head) != 12:
        raise ValueError(f"no record at {place}")
    size, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError(f"damaged length at {place}")
    body = _exactly(stream, size + 4)
    if len(body) != size + 4 or masked(body[:-4]) != int.from_bytes(body[-4:], "little"):
        raise ValueError(f"damaged payload at {place}")
    return body[:-4]


def unframe(stream, place: int) -> bytes:
    """The payload of the record at ``place``; ValueError if lengths or checksums don't agree."""
    stream.seek(place)
    return next_record(stream, place)


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _writer(uri: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([end_id], f"<u{2 if own.width == 'H' else 4}").tobytes()
        files, root = _files(uri)
        shard = TaskContext.get().partitionId()
        name, trial = f"{root}/part-{shard:06d}", f"{root}/.trial-{uuid.uuid4().hex}"
        files.create_dir(root, recursive=True)
        records, place, before = 0, 0, 0
        with files.open_output_stream(f"{trial}.rec") as out, files.open_output_stream(f"{trial}.idx") as index:
            for batch in slices(batches, "text"):
                data, at = buffers(batch.column(1))
                ids = [NO_ID if x is None else x for x in batch.column(0).to_pylist()]
                entries = []
                for doc_id, a, b in zip(ids, at[:-1].tolist(), at[1:].tolist(), strict=True):
                    payload = own.text(data[a:b].tobytes()) + end
                    tokens = len(payload) // len(end)
                    entries.append((doc_id, place, tokens, before))
                    out.write(record := frame(payload))
                    place, before = place + len(record), before + tokens
                index.write(np.array(entries, INDEX).tobytes())
                records += len(entries)
        for kind in ("rec", "idx"):
            try:
                files.move(f"{trial}.{kind}", f"{name}.{kind}")
            except OSError:  # some stores don't rename onto a file that another try has left, which is the same
                if files.get_file_info(f"{name}.{kind}").type.name != "File":
                    raise
                files.delete_file(f"{trial}.{kind}")
        yield pa.record_batch(
            [pa.array([shard], pa.int64()), pa.array([records], pa.int64()), pa.array([before], pa.int64()), pa.array([len(end)], pa.int32())],
            ["shard", "n_records", "n_tokens", "width"],
        )

    return run


def shard_count(texts: DataFrame, cores: int) -> int:
    """How many shards the column ``text`` asks for, by its bytes alone."""
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    size = (size or 0) + ROW_BYTES * rows
    return max(1, -(-size // SHARD_BYTES), min(cores, size // LEAST_BYTES))


def write_records(docs: DataFrame, path: str, end_id: int, uri: str | None = None) -> str:
    """Write the token ids of all texts of ``docs`` (doc_id, text), each followed by ``end_id``; gives the folder.

    Ascending doc_id, nulls first; rows of equal doc_id by a hash of their text, then by the text. Null texts
    count as empty: a record that holds ``end_id`` only. An empty table gives empty shards or none. A very long text comes
    alone into a slice and is one record; a repeated row gives a record each time. Other columns, whatever their names,
    aren't read.
    """
    uri = uri or new_path(docs.sparkSession, "token-records")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    shards = shard_count(rows, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    ordered = keyed.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    manifest = ordered.mapInArrow(_writer(uri, path, end_id), "shard long, n_records long, n_tokens long, width int")
    manifest.write.parquet(f"{uri}/manifest")
    return uri


def _reader(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(uri)
        for batch in batches:
            for shard, base, width in zip(*(batch.column(c).to_pylist() for c in ("shard", "base", "width")), strict=True):
                name = f"{root}/part-{shard:06d}"
                with files.open_input_stream(f"{name}.idx", buffer_size=BUFFER) as index, files.open_input_stream(f"{name}.rec", buffer_size=BUFFER) as stream:
                    place = 0
                    while entries := _exactly(index, READ * INDEX.itemsize):
                        part, crc = np.frombuffer(entries, INDEX), []
                        for said in part["place"].tolist():
                            if said != place:
                                raise ValueError(f"the index has a record at {said}, the shard at {place}")
                            payload = next_record(stream, place)
                            crc.append(zlib.crc32(np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()))
                            place += len(payload) + 16
                        ids = part["doc_id"].astype(np.int64)
                        yield pa.record_batch(
                            [
                                pa.array(ids, mask=ids == NO_ID),
                                pa.array(part["before"].astype(np.int64) + base),
                                pa.array(part["tokens"].astype(np.int64)),
                                pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def manifest(spark, uri: str) -> DataFrame:
    """One row per shard, with ``base``: the tokens of all shards before it."""
    rows = spark.read.schema("shard long, n_records long, n_tokens long, width int").parquet(f"{uri}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_report(spark, uri: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, read back from the files and checked."""
    shards = manifest(spark, uri)
    # a number of partitions is given so that rows this small, each of a whole shard, aren't put together
    dealt = shards.repartitionByRange(max(1, shards.count()), "shard")
    return dealt.mapInArrow(_reader(uri), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(files_uri: str, shard: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) of one shard in an order drawn from ``seed``, by seeks through the index; for a loader."""
    files, root = _files(files_uri)
    with files.open_input_file(f"{root}/part-{shard:06d}.idx") as f:
        index = np.frombuffer(f.read(), INDEX)
    with files.open_input_file(f"{root}/part-{shard:06d}.rec") as stream:
        for k in np.random.default_rng([seed, shard]).permutation(len(index)).tolist():
            payload = unframe(stream, int(index["place"][k]))
            width = len(payload) // int(index["tokens"][k])
            yield int(index["doc_id"][k]), np.frombuffer(payload, f"<u{width}")
