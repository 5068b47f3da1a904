"""LDA by expectation maximisation over blocks of documents: the steps of MLlib's EM optimizer, without its graph.

That graph has an edge for each different term of each document, with vertices of k numbers, and is written anew in every
iteration. Here a block's terms are written once, in a file of the shared folder; a step reads them, gives each occurrence to
the topics and leaves its documents' counts (k numbers each) in a second file that takes the place of the one before. The
terms' counts (terms times k numbers) are broadcast to a step and come back summed up by task, so nothing is shuffled.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as arrow_fs
from pyspark import TaskContext
from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

#: Numbers (terms times topics) of a model that is broadcast; larger ones are MLlib's to fit.
MOST_NUMBERS = 16_000_000
#: Terms of documents in a block at least and at most; a single block's steps are all one task.
LEAST_BLOCK, BLOCK = 400_000, 1_000_000
#: Terms of documents that a step looks at in one go, times topics: so many numbers.
LOOKED = 1_000_000
#: Bytes of tasks' sums that the driver takes by itself; more are summed on executors first.
DRIVER_BYTES = 256 << 20


@dataclass(frozen=True)
class Fitted:
    """A fit's counts: of terms (terms, topics) here, of documents in the blocks' files."""

    terms: np.ndarray
    folder: str
    keys: str
    rounds: int
    n_docs: int
    alpha: float
    eta: float
    #: The first term of each group of terms; a topic's weights are over its group's total.
    groups: np.ndarray | None = None

    def weights(self) -> np.ndarray:
        """What each topic weighs for each term, by topic."""
        return _smoothed(self.terms, self.eta, self.groups)

    def shares(self, spark) -> DataFrame:  # noqa: ANN001
        """id, shares: the topics of each training document, as EM has them after its last step."""
        folder, rounds, k = self.folder, self.rounds, self.terms.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                    own = _read_counts(folder, block, rounds, k)
                    own /= np.maximum(own.sum(axis=1, keepdims=True), np.finfo(float).tiny)
                    for first in range(0, len(own), 10_000):
                        part = own[first : first + 10_000]
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * k, pa.int32()), pa.array(part.reshape(-1)))
                        yield pa.RecordBatch.from_arrays([ids.values.slice(first, 10_000), lists], names=["id", "shares"])

        written = spark.read.parquet(f"{folder}/written")
        return written.repartition(max(1, written.count())).select("block", "ids").mapInArrow(run, f"id {self.keys}, shares array<double>")

    def log_likelihood(self, spark) -> float:  # noqa: ANN001
        """Of the training documents' words, with topics and shares smoothed as MLlib has them."""
        weights = spark.sparkContext.broadcast(self.weights())
        folder, rounds, alpha = self.folder, self.rounds, self.alpha

        def one(block: int) -> float:
            w = weights.value
            sizes, codes, counts = _read_terms(folder, block)
            own = _read_counts(folder, block, rounds, len(w)) + (alpha - 1)
            own /= own.sum(axis=1, keepdims=True)
            doc_of = np.repeat(np.arange(len(sizes)), sizes)
            fits = np.zeros(len(codes))
            for j in range(len(w)):
                fits += w[j][codes] * own[:, j][doc_of]
            return float((counts * np.log(fits)).sum())

        blocks = _blocks_of(spark, folder)
        got = spark.sparkContext.parallelize(blocks, max(1, len(blocks))).map(one).sum()
        weights.destroy()
        return got


def _target(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(f"{folder}/blocks")


def _stored(target: arrow_fs.FileSystem, path: str, *parts: bytes) -> None:
    hidden = "/.".join(path.rsplit("/", 1)) + "-" + uuid.uuid4().hex
    with target.open_output_stream(hidden) as out:
        for part in parts:
            out.write(part)
    try:
        target.move(hidden, path)
    except OSError:  # some stores don't rename onto a file, which an earlier attempt has left
        target.delete_file(path)
        target.move(hidden, path)


def _read(folder: str, name: str) -> bytes:
    target, base = _target(folder)
    with target.open_input_stream(f"{base}/{name}") as file:
        return file.read()


HEAD = struct.Struct("<qqcc")
#: Numbers as small as they go.
KINDS = {b"1": np.uint8, b"2": np.uint16, b"4": np.int32, b"8": np.float64}


def _narrow(values: np.ndarray) -> tuple[bytes, bytes]:
    whole = values.dtype.kind != "f" or bool((values == np.floor(values)).all())
    most = values.max(initial=0)
    kind = b"8" if not whole or most >= 1 << 31 else b"1" if most < 1 << 8 else b"2" if most < 1 << 16 else b"4"
    return kind, np.ascontiguousarray(values, KINDS[kind]).tobytes()


def _packed(sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    (code_kind, code_bytes), (count_kind, count_bytes) = _narrow(codes), _narrow(counts)
    return [HEAD.pack(len(sizes), len(codes), code_kind, count_kind), sizes.tobytes(), code_bytes, count_bytes]


def _read_terms(folder: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different terms of each document, and their codes and numbers."""
    data = _read(folder, f"{block}.terms")
    n_docs, n, code_kind, count_kind = HEAD.unpack_from(data)
    at = HEAD.size
    sizes = np.frombuffer(data, np.int32, n_docs, at)
    codes = np.frombuffer(data, KINDS[code_kind], n, at + sizes.nbytes)
    counts = np.frombuffer(data, KINDS[count_kind], n, at + sizes.nbytes + codes.nbytes)
    return sizes, codes.astype(np.int64), counts.astype(np.float64)


def _read_counts(folder: str, block: int, rounds: int, k: int) -> np.ndarray:
    return np.frombuffer(_read(folder, f"{block}.{rounds}"), np.float64).reshape(-1, k).copy()


def _blocks_of(spark, folder: str) -> list[int]:  # noqa: ANN001
    return sorted(r["block"] for r in spark.read.parquet(f"{folder}/written").select("block").collect())


def _starts(codes: np.ndarray, doc_of: np.ndarray, seeds: np.ndarray, seed: int, j: int) -> np.ndarray:
    """A number from 0 to 1 for a term of a document and a topic, of their hashes: alike wherever a document is."""
    with np.errstate(over="ignore"):
        x = seeds[doc_of] + codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + j + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _pieces(sizes: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last document of pieces of a block, and their places in it."""
    ends, first = np.cumsum(sizes, dtype=np.int64), 0
    most = max(1, LOOKED // k)
    while first < len(sizes):
        start = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + most, "right")))
        yield first, last, start, int(ends[last - 1])
        first = last


def step(sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray, n_terms: int, k: int, given) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
    """Counts of documents (by topic in the rows' places) and of terms, where given(codes, documents' places, j) is what a
    topic j weighs for a term of a document."""
    docs, terms = np.zeros((len(sizes), k)), np.zeros((k, n_terms))
    for first, last, start, end in _pieces(sizes, k):
        own, at, n = sizes[first:last], codes[start:end], counts[start:end]
        doc_of = np.repeat(np.arange(first, last), own)
        parts = np.empty((k, len(at)))
        for j in range(k):
            parts[j] = given(at, doc_of, j)
        total = parts.sum(axis=0)
        scale = np.divide(n, total, out=np.zeros_like(total), where=total > 0)
        begins = np.cumsum(own) - own
        for j in range(k):
            parts[j] *= scale
            docs[first:last, j] = np.add.reduceat(parts[j], begins)
            terms[j] += np.bincount(at, parts[j], n_terms)
    return docs, terms


def _smoothed(terms: np.ndarray, eta: float, groups: np.ndarray | None = None) -> np.ndarray:
    """What a topic weighs for a term, by topic: (terms' counts + eta - 1) over the topic's total, of a group if there are groups."""
    own = terms + (eta - 1)
    total = own.sum(axis=0) if groups is None else np.repeat(np.add.reduceat(own, groups), np.diff(groups, append=len(own)), axis=0)
    return np.ascontiguousarray((own / np.maximum(total, np.finfo(float).tiny)).T)


def _block_step(folder: str, block: int, rounds: int, n_terms: int, k: int, alpha: float, weights: np.ndarray | None, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One step over a block: the first one deals terms by hashes (weights None), or by given weights. Leaves the documents' counts
    as those of the next round and gives the block's terms and their counts."""
    sizes, codes, counts = _read_terms(folder, block)
    target, base = _target(folder)
    # the block's own terms: of a large vocabulary it has few
    said = np.zeros(n_terms, bool)
    said[codes] = True
    used = np.flatnonzero(said)
    codes = (np.cumsum(said) - 1)[codes]
    if weights is None:
        seeds = np.frombuffer(_read(folder, f"{block}.seeds"), np.uint64)
        docs, found = step(sizes, codes, counts, len(used), k, lambda at, of, j: _starts(used[at], of, seeds, seed, j))
    else:
        shares = np.ascontiguousarray((_read_counts(folder, block, rounds, k) + (alpha - 1)).T) if rounds >= 0 else np.ones((k, len(sizes)))
        own = np.ascontiguousarray(weights[:, used])
        docs, found = step(sizes, codes, counts, len(used), k, lambda at, of, j: own[j][at] * shares[j][of])
    _stored(target, f"{base}/{block}.{rounds + 1}", docs.tobytes())
    return used, found


def _added(total: np.ndarray, part: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    total[:, part[0]] += part[1]
    return total


def _forget(folder: str, block: int, rounds: int) -> None:
    # the round before the last one is what a task that runs again starts from
    target, base = _target(folder)
    path = f"{base}/{block}.{rounds}"
    if rounds >= 0 and target.get_file_info(path).type != arrow_fs.FileType.NotFound:
        target.delete_file(path)


def _written(parts: DataFrame, key: str, folder: str) -> tuple[list[int], int]:
    """Writes the files of all blocks; their numbers, and the number of documents."""
    spark = parts.sparkSession
    target, base = _target(folder)
    target.create_dir(base)
    n = parts.agg(F.sum(F.size("ids"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    most = int(min(max(LEAST_BLOCK, n // (2 * cores)), BLOCK, max(LEAST_BLOCK, n)))
    picked = parts.filter(F.size("ids") > 0).select(F.col(key).alias("id"), F.xxhash64(key).alias("seed"), "ids", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _target(folder)
        block, held, size = TaskContext.get().partitionId() << 33, [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, held, size
            of = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sizes = pc.list_value_length(of.column("ids")).to_numpy(zero_copy_only=False).astype(np.int32)
            codes, counts = (of.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "counts"))
            _stored(target, f"{base}/{block}.terms", *_packed(sizes, codes, counts))
            _stored(target, f"{base}/{block}.seeds", of.column("seed").to_numpy().view(np.uint64).tobytes())
            row = pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of.column("id"))], names=["block", "ids"])
            block, held, size = block + 1, [], 0
            return row

        for batch in batches:
            lengths = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                before = int(lengths[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(lengths, before + most - size, "right")))
                held.append(batch.slice(first, last - first))
                size, first = size + int(lengths[last - 1]) - before, last
                if size >= most or first < batch.num_rows:
                    yield close()
        if held:
            yield close()

    dealt = picked.coalesce(1) if n <= most else picked.repartition(2 * cores) if parts.rdd.getNumPartitions() < cores else picked
    dealt.mapInArrow(run, f"block long, ids array<{parts.schema[key].dataType.simpleString()}>").write.parquet(f"{folder}/written")
    made = spark.read.parquet(f"{folder}/written").select("block", F.size("ids").alias("n")).collect()  # a row for each block
    return sorted(r["block"] for r in made), sum(r["n"] for r in made)


def fit(
    parts: DataFrame, key: str, n_terms: int, k: int, iterations: int, alpha: float, eta: float, seed: int, groups: np.ndarray | None = None, weights: np.ndarray | None = None
) -> Fitted:
    """EM over documents (key, ids, counts; terms are numbered below n_terms). It starts from hashes of documents and terms, as
    MLlib does from random numbers, or with a first one of its steps from weights (terms, topics). groups: as of Fitted."""
    spark = parts.sparkSession
    sc, folder = spark.sparkContext, f"{shared_dir(spark)}/textloom/em-{uuid.uuid4().hex}"
    blocks, n_docs = _written(parts, key, folder)
    rounds = iterations if weights is None else iterations - 1
    fitted = lambda terms: Fitted(np.ascontiguousarray(terms.T), folder, parts.schema[key].dataType.simpleString(), rounds, n_docs, alpha, eta, groups)
    start = None if weights is None else np.ascontiguousarray(weights.T)
    if not blocks:
        return fitted(np.zeros((k, n_terms)))

    def steps(of: list[int], r: int, now: np.ndarray | None) -> np.ndarray:
        """The sums of a task; terms that are in none of its blocks stay 0."""
        total = np.zeros((k, n_terms))
        for block in of:
            _added(total, _block_step(folder, block, r, n_terms, k, alpha, now, seed))
            _forget(folder, block, r - 1)
        return total

    if len(blocks) == 1:

        def all_rounds(of: list[int]) -> np.ndarray:
            now = start
            for r in range(-1, rounds):
                terms = steps(of, r, now)
                now = _smoothed(terms.T, eta, groups)
            return terms

        return fitted(sc.parallelize([blocks], 1).map(all_rounds).first())
    tasks = min(len(blocks), 2 * sc.defaultParallelism)
    # blocks that lie side by side, which have terms in common, are in the same task in all rounds
    dealt = sc.parallelize([[int(b) for b in of] for of in np.array_split(np.array(blocks), tasks)], tasks)
    deep = tasks * n_terms * k * 8 > DRIVER_BYTES

    def filled(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(total.any(axis=0))
        return used, np.ascontiguousarray(total[:, used])

    def both(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        used = np.union1d(a[0], b[0])
        total = np.zeros((k, len(used)))
        for terms, found in (a, b):
            total[:, np.searchsorted(used, terms)] += found
        return used, total

    now = start
    for r in range(-1, rounds):
        given = sc.broadcast(now)
        sums = dealt.map(lambda of, r=r, given=given: filled(steps(of, r, given.value)))
        terms = np.zeros((k, n_terms))
        for part in [sums.treeReduce(both)] if deep else sums.collect():
            _added(terms, part)
        now = _smoothed(terms.T, eta, groups)
        given.destroy()
    return fitted(terms)


def local_model(spark, fitted: Fitted, seed: int) -> LocalLDAModel:  # noqa: ANN001
    """MLlib's model of a fit, as its EM model is made local to infer the topics of documents."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    n_terms, k = fitted.terms.shape

    def doubles(values: np.ndarray):  # noqa: ANN202
        out = gateway.new_array(jvm.double, len(values))
        jvm.java.nio.ByteBuffer.wrap(bytearray(values.astype(">f8").tobytes())).asDoubleBuffer().get(out)
        return out

    topics = jvm.org.apache.spark.mllib.linalg.DenseMatrix(n_terms, k, doubles(fitted.terms.T.reshape(-1)))
    prior = jvm.org.apache.spark.mllib.linalg.DenseVector(doubles(np.full(k, fitted.alpha)))
    old = jvm.org.apache.spark.mllib.clustering.LocalLDAModel(topics, prior, float(fitted.eta), 100.0)
    made = LocalLDAModel(jvm.org.apache.spark.ml.clustering.LocalLDAModel(f"lda-{uuid.uuid4().hex[:12]}", n_terms, old, spark._jsparkSession))
    made._java_obj.setSeed(seed)
    made._fitted = fitted
    return made
