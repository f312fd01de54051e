"""Token ids as fixed-width bit-packed files, written and read by tasks.

Documents are dealt to ranges of ascending id, each range is sorted and written
as a row of shards of bounded size. A shard holds its documents' ids one after
the other, ``width`` bits each, in blocks whose offsets are listed, so a reader
unpacks any range of ids with numpy and touches only the blocks it needs.

A shard, all numbers little-endian:

    magic "ESTBITS1", then 5 x u64: width in bits, ids per block, ids, documents, blocks
    document ids i64, known flags u8 (0: the id is null), ends u64 (ids up to and with the document)
    block offsets u64 (one more than blocks, from the start of the payload), payload
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelake.llm.common import TEXT_ROWS, scratch, small_batches, stored, text_of, width_of
from estatelake.llm.tokens import text_ids

MAGIC = b"ESTBITS1"
BLOCK = 4096
SHARD_IDS = 1 << 21


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits per id, lowest bit first, without gaps."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    parts = []
    for i in range(0, len(ids), 1 << 16):  # a multiple of 8 ids ends on a byte
        bits = (ids[i : i + (1 << 16), None].astype(np.uint64) >> np.arange(width, dtype=np.uint64)) & 1
        parts.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(parts)


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    out, step = np.empty(count, np.uint32), 1 << 16
    weights = (np.uint32(1) << np.arange(width, dtype=np.uint32)).astype(np.uint32)
    for i in range(0, count, step):
        n = min(step, count - i)
        raw = np.frombuffer(data, np.uint8, (n * width + 7) // 8, i * width // 8)
        bits = np.unpackbits(raw, count=n * width, bitorder="little").reshape(n, width)
        out[i : i + n] = bits @ weights
    return out


def shard_bytes(doc_ids: list, ends: np.ndarray, ids: np.ndarray, width: int, block: int = BLOCK) -> bytes:
    blocks = -(-len(ids) // block)
    payload = pack(ids, width)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * (block * width // 8), len(payload))
    head = np.array([width, block, len(ids), len(doc_ids), blocks], "<u8").tobytes()
    known = np.array([i is not None for i in doc_ids], np.uint8)
    numbers = np.array([i or 0 for i in doc_ids], "<i8")
    return b"".join([MAGIC, head, numbers.tobytes(), known.tobytes(), ends.astype("<u8").tobytes(),
                     offsets.astype("<u8").tobytes(), payload])


class Shard:
    """A shard opened for reading; only what is asked for is read."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        if self._at(0, 8) != MAGIC:
            raise ValueError(f"{uri} is no shard of token ids")
        self.width, self.block, self.n_ids, n, blocks = np.frombuffer(self._at(8, 40), "<u8").tolist()
        index = self._at(48, n * 17 + (blocks + 1) * 8)
        self.known = np.frombuffer(index, np.uint8, n, n * 8).astype(bool)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.ends = np.frombuffer(index[n * 9 : n * 17], "<u8").astype(np.int64)
        self.offsets = np.frombuffer(index[n * 17 :], "<u8").astype(np.int64)
        self.payload = 48 + len(index)

    def _at(self, position: int, count: int) -> bytes:
        return self.file.read_at(count, position)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self._at(self.payload + self.offsets[first], self.offsets[last + 1] - self.offsets[first])
        base = first * self.block
        return unpack(data, self.width, min((last + 1) * self.block, self.n_ids) - base)[start - base : stop - base]

    def documents(self) -> Iterator[tuple]:
        """(doc_id, start, ids) of every document; a shard is small enough to unpack at once."""
        start, every = 0, self.ids(0, self.n_ids)
        for i, end in enumerate(self.ends.tolist()):
            yield (int(self.doc_ids[i]) if self.known[i] else None), start, every[start:end]
            start = end


#: Schemes of Hadoop file systems under the names that Arrow has for them.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs", "wasb": "abfs"}


def task_folder(spark: SparkSession, folder: str) -> str:
    """The folder as tasks can open it: qualified by the cluster's file system, under a scheme that Arrow knows.

    A folder without a scheme lies on the cluster's default file system and not on
    each executor's disk. Schemes that tasks could not open are refused here,
    before any work.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme, rest = system.makeQualified(path).toUri().toString().split(":", 1)
    uri = f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}"
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as unknown:
        raise ValueError(f"token files cannot be written to {folder}: tasks cannot open {scheme}") from unknown
    return uri


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
    text_col: str = "text", shard_ids: int = SHARD_IDS, block: int = BLOCK,
) -> DataFrame:
    """Write all documents' ids; returns the manifest, one row per shard, from a stored table.

    Manifest: part, shard, uri, n_docs, n_ids, start (ids in all shards before).
    Documents go by ascending id, null ids first, rows of one id by their ids.
    A null text is empty and has the end id only. A shard takes documents until
    it holds ``shard_ids`` ids; a longer document is a shard by itself. A task
    that runs again writes the same bytes under the same name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    parts = width_of(spark)
    cuts = rows.select("doc_id").stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)
    cuts = np.unique(np.array(cuts, dtype=np.float64))

    def texts(batches):
        for batch in batches:
            yield from zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)

    def encode(batches):
        own = text_ids(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        small = own.vocabulary <= 1 << 16
        for part in batched(own.of_rows(texts(batches)), TEXT_ROWS):
            doc_ids, data = zip(*part, strict=True)
            ids = pa.array(doc_ids, pa.int64())
            packed = [x + end for x in data]
            if small:
                packed = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in packed]
            where = np.searchsorted(cuts, ids.fill_null(-(1 << 62)).to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where), ids, pa.array(packed, pa.binary())], ["part", "doc_id", "ids"]
            )

    encoded = rows.mapInArrow(encode, "part int, doc_id long, ids binary")
    target = task_folder(spark, f"{folder}/shards")

    def write(batches):
        own = text_ids(tokenizer)
        width, kind = bits_for(own.vocabulary), "<u2" if own.vocabulary <= 1 << 16 else "<u4"
        doc_ids, data, held, made, part = [], [], 0, 0, None

        def flush():
            nonlocal doc_ids, data, held, made
            ids = np.frombuffer(b"".join(data), kind)
            ends = np.cumsum([len(d) // int(kind[2]) for d in data])
            uri = f"{target}/{part:06d}-{made:06d}.bits"
            system, path = fs.FileSystem.from_uri(uri)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            attempt = f"{path}.{uuid.uuid4().hex}"
            with system.open_output_stream(attempt) as out:
                out.write(shard_bytes(doc_ids, ends, ids, width, block))
            system.move(attempt, path)
            row = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([made], pa.int32()), "uri": [uri],
                 "n_docs": [len(doc_ids)], "n_ids": [len(ids)]}
            )
            doc_ids, data, held, made = [], [], 0, made + 1
            return row

        for batch in batches:
            for p, doc_id, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if data and (held >= shard_ids or p != part):
                    yield flush()
                if p != part:
                    part, made = p, 0
                doc_ids.append(doc_id)
                data.append(ids)
                held += len(ids) // int(kind[2])
        if data:
            yield flush()

    manifest = stored(
        encoded.repartitionById(parts, "part")
        .sortWithinPartitions("part", "doc_id", "ids")
        .mapInArrow(write, "part int, shard int, uri string, n_docs long, n_ids long"),
        f"{folder}/manifest",
    )
    # One row per part goes through one task; shards add up within their part.
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = totals.select(
        "part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before")
    )
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    return manifest.join(before, "part").withColumn("start", F.col("_before") + within).drop("_before")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document from the shards: doc_id, start, n_tokens, ids_crc32, on request ids."""

    def read(batches):
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows = [
                    (doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids if with_ids else None)
                    for doc_id, at, ids in Shard(uri).documents()
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = manifest.select("uri", "start")
    return rows.repartition(width_of(manifest.sparkSession), "uri").mapInArrow(read, schema)
