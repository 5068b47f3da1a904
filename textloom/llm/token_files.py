"""Token ids in binary files: one concatenated id array a file, Elias-Fano coded boundaries.

A dataset is a folder: ``ids`` holds the files, ``manifest`` (Parquet) says for each of them how many
documents and ids it has and how many ids are in the files before it. A file has, little-endian:

* the ids of its documents, one behind the other, in 16 bits where all of them fit, else in 32;
* Elias-Fano: where each document ends (see elias_fano.py);
* Elias-Fano: the documents' ids less the first one;
* a footer: see FOOTER. Documents without an id come first and are only counted.

Rows are dealt in ranges of doc_id, sorted and written where they are; a file is closed at FILE_IDS
ids or FILE_DOCS documents, so a task holds one file's ids, and a document of more ids than that is
a file's last. Files are written under another name and renamed, so a task that runs twice leaves
the same files; names follow the partition, and only files of the manifest are read.

Defined results: null and empty texts are the end id alone; texts of any length are tokenized whole;
rows without an id come first; equal ids go by a hash of the text, equal rows in any order, and rows
of one id are dealt over several ranges where they are many; an empty table gives no files and no
rows; ids of documents must be whole numbers (TypeError); other columns, whatever their names, are
left alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, shuffle_partitions
from .elias_fano import EliasFano, encoded
from .packing import END_ID, token_ids, tokenizer_path

FILE_IDS, FILE_DOCS = 4_000_000, 65_536
#: Manifests of at most so many files are broadcast when documents get their place in the corpus (about 50 bytes each).
BROADCAST_FILES = 200_000
#: Documents, those of them without an id, ids, first doc_id, bytes of an id, start of the boundaries and of the doc_ids, magic.
FOOTER = struct.Struct("<IIQqBQQ8s")
MAGIC = b"IDS-EF-1"
MANIFEST = "part int, file string, n_docs long, n_ids long"


def packed(ids: bytes, ends: list[int], docs: list[int | None]) -> bytes:
    """A file's bytes. ids: unsigned 32 bits each; ends: where each document ends; docs: their ids, ascending, None first."""
    array = np.frombuffer(ids, "<u4")
    width = 2 if not len(array) or int(array.max()) < 1 << 16 else 4
    body = array.astype(f"<u{width}").tobytes()
    known = [d for d in docs if d is not None]
    first = known[0] if known else 0
    bounds, names = encoded(np.array(ends, np.uint64)), encoded(np.array([d - first for d in known], np.uint64))
    at = len(body)
    return b"".join((body, bounds, names, FOOTER.pack(len(docs), len(docs) - len(known), len(array), first, width, at, at + len(bounds), MAGIC)))


class IdFile:
    """A file's documents by their place in it."""

    def __init__(self, data: bytes) -> None:
        self.n_docs, self.n_null, n_ids, self.first, width, bounds, names, magic = FOOTER.unpack_from(data, len(data) - FOOTER.size)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.ids = np.frombuffer(data, f"<u{width}", n_ids)
        self.bounds, self.names = EliasFano(data, bounds), EliasFano(data, names)

    def spans(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the i-th documents in the id array; i rises."""
        ends = self.bounds[i].astype(np.int64)
        starts = np.zeros(len(i), np.int64)
        starts[i > 0] = self.bounds[i[i > 0] - 1]
        return starts, ends

    def doc_ids(self, i: np.ndarray) -> list[int | None]:
        known = i[i >= self.n_null] - self.n_null
        return [None] * int((i < self.n_null).sum()) + [self.first + d for d in self.names[known].tolist()]


def _stored(target: arrow_fs.FileSystem, path: str, data: bytes) -> None:
    hidden = "/.".join(path.rsplit("/", 1)) + "-" + uuid.uuid4().hex
    with target.open_output_stream(hidden) as out:
        out.write(data)
    try:
        target.move(hidden, path)
    except OSError:  # some stores don't rename onto a file, which an earlier attempt has left
        target.delete_file(path)
        target.move(hidden, path)


def write_ids(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS) -> str:
    """Writes all documents' ids and gives the folder (a new one in spark.checkpoint.dir if none is named)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"doc ids must be whole numbers, not {kind}")
    folder = folder or f"{shared_dir(spark)}/textloom/ids-{uuid.uuid4().hex}"
    target, base = arrow_fs.FileSystem.from_uri(f"{folder}/ids")
    target.create_dir(base)
    tokenizer = tokenizer or tokenizer_path()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = arrow_fs.FileSystem.from_uri(f"{folder}/ids")
        part, ids_of = TaskContext.get().partitionId(), token_ids(tokenizer)
        held, ends, names, made = bytearray(), [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal held, ends, names, made
            file = f"{part:07d}-{made:05d}.ids"
            _stored(target, f"{base}/{file}", packed(bytes(held), ends, names))
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([len(names)], pa.int64()), pa.array([len(held) // 4], pa.int64())], names=["part", "file", "n_docs", "n_ids"])
            held, ends, names, made = bytearray(), [], [], made + 1
            return row

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                held += ids_of(text.as_py()) + end
                ends.append(len(held) // 4)
                names.append(name.as_py())
                if len(held) >= 4 * file_ids or len(names) >= file_docs:
                    yield close()
        if names:
            yield close()

    # rows that are alike are told apart by their place in the input, so that a great many of them are not one range
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = [F.asc_nulls_first("id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = picked.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(F.asc_nulls_first("id"), F.xxhash64("text"))
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/written")
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/written")
    before = lambda *by: F.coalesce(F.sum("n_ids").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each partition of the shuffle; the files of a partition by themselves
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", before("part").alias("ahead"))
    placed = files.withColumn("inside", before("part", "file")).join(parts, "part")
    placed.select("file", "n_docs", "n_ids", (F.col("ahead") + F.col("inside")).alias("base")).write.parquet(f"{folder}/manifest")
    return folder


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files; ids too if asked."""
    names = ["file", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 6 if with_ids else 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                file = IdFile(content.as_py())
                for first in range(0, file.n_docs, 10_000):
                    i = np.arange(first, min(first + 10_000, file.n_docs))
                    starts, ends = file.spans(i)
                    whole = file.ids[starts[0] : ends[-1]].astype("<u4")
                    parts = [whole[a:z] for a, z in zip((starts - starts[0]).tolist(), (ends - starts[0]).tolist())]
                    cols = [pa.array([path.as_py().rsplit("/", 1)[1]] * len(i)), pa.array(file.doc_ids(i), pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    if with_ids:
                        offsets = np.append(starts, ends[-1]) - starts[0]
                        cols.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whole.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(f"{folder}/ids").select("path", "content")
    rows = files.mapInArrow(run, "file string, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    manifest = spark.read.schema("file string, n_docs long, n_ids long, base long").parquet(f"{folder}/manifest").select("file", "base")
    few = F.broadcast(manifest) if manifest.count() <= BROADCAST_FILES else manifest
    return rows.join(few, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), *names[3:])
