"""Suffix-array dedup: bytes covered by a string of some length that also starts elsewhere.

Equal strings of LENGTH bytes choose the same anchor inside them (the gram of least hash, a
function of the string alone), so all occurrences of a string meet in the bucket of its
anchor. First only the anchors travel; those that occur once cannot lie in a repeated string.
Strings of an anchor with very many different surroundings choose again, among longer grams, so
that what differs around a frequent line parts; at last a string is its own anchor (GRAMS).

The texts around repeated anchors are laid out in their bucket in order of document and place,
and suffix-sorted to a depth of LENGTH bytes by tripling the depth that ranks stand for, with
the common prefixes of neighbours. The previous and next smaller positions in suffix order give
each position's longest previous factor: where it reaches LENGTH, there is an earlier match, so
the string is a later copy; the positions that are so pointed to are the first ones.

``keep="first"`` removes later copies only and keeps the first (least document id, null before
all, ids that are no whole numbers by their hash; ties by the text's hash; then least place);
``keep="none"`` removes every occurrence. Exact copies of a text (equal by SHA-256) are one
node throughout, and equal surroundings of an anchor travel once for a task.

Matches never cross documents. Defined results: null and empty texts have no bytes; texts
shorter than LENGTH lose none; texts of any length are read whole, in time proportional to it;
repeated rows are copies of each other, with ``keep="first"`` all rows of the least document id
keep the text; an empty table gives no rows; other columns, whatever their names, are left
alone.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import discard, materialize, shuffle_partitions
from .hashing import Ranges, U, mix

LENGTH = 200
#: Bytes of an anchor's gram; a string of LENGTH bytes has LENGTH - gram + 1 of them. Strings of anchors with more
#: than HOT different surroundings go on to the next length; the last one is the string itself.
GRAMS = (40, 160, LENGTH)
HOT = 2_000
#: Node ids up to this many are broadcast (8 bytes each), more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Anchors, or bytes of surroundings, that a task holds before it hands them on.
FLUSH, FLUSH_BYTES = 600_000, 24_000_000
#: Bytes of surroundings in a bucket, about: sorting takes some hundred times as much memory.
BUCKET_BYTES = 600_000
#: Bytes of text for each bucket of anchors, which has some sixteenth as many of them.
ANCHOR_BYTES = 64_000_000
#: A text with more copies than this, or than so many millionths of all rows, is joined to its rows by broadcast.
MANY_COPIES, COPIES_SHARE = 500, 10


def anchors_of_windows(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of width grams the place of the leftmost with the least hash (by its upper 32 bits)."""
    n = len(h)
    both = np.full(-(-n // width) * width, U(0xFFFFFFFFFFFFFFFF))
    both[:n] = (h & U(0xFFFFFFFF00000000)) | np.arange(n, dtype=U)
    blocks = both.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[: n - width + 1], before[width - 1 : n]) & U(0xFFFFFFFF)).astype(np.int64)


def choose(ranges: Ranges, length: int = LENGTH, gram: int = GRAMS[0]) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a text: the first string start of each, and its gram's hash. Strings follow in order."""
    h = ranges.of_size(gram)
    at = anchors_of_windows(h, length - gram + 1)
    first = np.flatnonzero(changes(at))
    return first, h[at[first]]


def changes(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before, the first included."""
    out = np.empty(len(x), bool)
    out[:1] = True
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def intervals(data: np.ndarray, chain: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """String starts [lo, hi) by their anchor, its hash, and a hash of their bytes, among the GRAMS after chain, which
    has for each of the lengths before the lo of those intervals that went on."""
    ranges = Ranges(data)
    lo, hi = np.zeros(1, np.int64), np.array([len(data) - LENGTH + 1], np.int64)
    for level, gram in enumerate(GRAMS[: len(chain) + 1]):
        first, h = choose(ranges, LENGTH, gram)
        # both are rows of intervals: cut the anchors' at the ends of those that are left
        cuts = np.unique(np.concatenate([first, lo, hi]))
        owner = np.searchsorted(lo, cuts, "right") - 1
        inside = (owner >= 0) & (cuts < hi[np.maximum(owner, 0)])
        ends = np.r_[cuts[1:], len(data) - LENGTH + 1]
        lo, hi, h = cuts[inside], ends[inside], h[np.searchsorted(first, cuts[inside], "right") - 1]
        if level < len(chain):
            left = np.isin(lo, chain[level])
            lo, hi = lo[left], hi[left]
    return lo, hi, h, ranges.between(lo, hi - 1 + LENGTH)


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts in suffix order to a depth, equal ones by place, and the common prefix, up to the depth, of each with the one
    before. Every start has depth bytes."""

    def dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.cumsum(changes(key[order]), dtype=np.uint32) - np.uint32(1)
        return rank

    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U)
    x = x[:-1] << U(8) | x[1:]
    x = x[:-2] << U(16) | x[2:]
    eight = (x[:-4] << U(32) | x[4:])[: len(data)]
    rank, reach, n = dense(eight), 8, len(data)
    ranks = [(reach, rank)]
    bits = U(max(1, int(n).bit_length()))
    times = 3 if 3 * int(bits) <= 64 else 2

    def key_of(at: np.ndarray | slice, offsets: list[int]) -> np.ndarray:
        key = None
        for o in offsets:
            part = np.zeros(n, np.uint32)
            part[: n - o] = rank[o:]
            part = part[at].astype(U)
            key = part if key is None else key << bits | part
        return key

    while times * reach < depth:
        rank = dense(key_of(slice(None), [reach * i for i in range(times)]))
        reach *= times
        ranks.append((reach, rank))
    key = key_of(starts, [min(reach * i, depth - reach) for i in range(-(-depth // reach))]) if reach < depth else rank[starts].astype(U)
    order = np.lexsort((starts, key))
    place, key = starts[order], key[order]
    common = np.zeros(len(order), np.int64)
    common[1:][key[1:] == key[:-1]] = depth
    # where the whole depth differs, the longest steps that agree, then single bytes
    left = np.flatnonzero(changes(key))[1:]
    a, b, so_far = place[left - 1], place[left], np.zeros(len(left), np.int64)
    for step, rank in reversed(ranks):
        for _ in range(times):
            fits = so_far + step <= depth
            same = fits & (rank[np.where(fits, a + so_far, a)] == rank[np.where(fits, b + so_far, b)])
            so_far += step * same
    at = np.minimum(so_far, depth - 1)
    differ = eight[a + at] ^ eight[b + at]
    for k in range(7):
        so_far += differ >> U(56 - 8 * k) == 0
    common[left] = np.minimum(so_far, depth)
    return order, common


def smaller_before(place: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in order the nearest one before whose place is smaller, and their common prefix; 0 where it is below least.

    All pointers move at once: whatever stands between one and its target is larger than both.
    """
    to, low = np.arange(len(place)) - 1, common.copy()
    open_ = np.flatnonzero((to >= 0) & (low >= least))
    open_ = open_[place[to[open_]] > place[open_]]
    while len(open_):
        over = to[open_]
        low[open_], to[open_] = np.minimum(low[open_], low[over]), to[over]
        open_ = open_[(to[open_] >= 0) & (low[open_] >= least)]
        open_ = open_[place[to[open_]] > place[open_]]
    return to, np.where((to >= 0) & (low >= least), low, 0)


def previous_factors(place: np.ndarray, common: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in order the length of the longest factor that also begins at a smaller place (0: shorter than least), and
    the suffix that has it."""
    before, one = smaller_before(place, common, least)
    after, two = smaller_before(place[::-1], np.r_[np.zeros(1, common.dtype), common[:0:-1]], least)
    after, two = len(place) - 1 - after[::-1], two[::-1]
    return np.maximum(one, two), np.where(one >= two, before, after)


def covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The union of [s, s + length) for sorted starts, as runs."""
    if not len(starts):
        return starts, starts
    gap = starts[1:] - starts[:-1] > length
    return starts[np.r_[True, gap]], starts[np.r_[gap, True]] + length


def _bytes_of(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer((x.as_py() or "").encode(), np.uint8)


def _unpacked(places: pa.Scalar) -> np.ndarray:
    return np.frombuffer(places.as_py(), "<u4").astype(np.int64)


def emit_anchors(texts: DataFrame, buckets: int, levels: int = 0) -> DataFrame:
    """texts: node, text and for each level before packed places. Packed rows: bucket, nodes, places, hashes, around."""
    chained = [f"hot{k}" for k in range(levels)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, places, hashes, arounds, held = [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not places:
                return
            node, place, h, around = np.repeat(np.array(nodes, np.int64), [len(p) for p in places]), np.concatenate(places), np.concatenate(hashes), np.concatenate(arounds)
            to = ((h >> U(40)) % U(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            ends = np.searchsorted(to[order], np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                i = order[ends[b] : ends[b + 1]]
                if len(i):
                    rows.append((b, node[i].tobytes(), place[i].astype("<u4").tobytes(), (h[i] & U(0xFFFFFFFF)).astype("<u4").tobytes(), (around[i] >> U(32)).astype("<u4").tobytes()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["bucket", "nodes", "places", "hashes", "around"])

        seen: set[int] = set()
        for batch in batches:
            for row, node in enumerate(batch.column(0).to_pylist()):
                if node in seen:
                    continue
                seen.add(node)
                data = _bytes_of(batch.column(1)[row])
                if len(data) < LENGTH:
                    continue
                lo, _, h, around = intervals(data, [_unpacked(batch.column(2 + k)[row]) for k in range(levels)])
                nodes.append(node)
                places.append(lo)
                hashes.append(h)
                arounds.append(around)
                held += len(lo)
                if held > FLUSH:
                    yield from flush()
                    nodes, places, hashes, arounds, held = [], [], [], [], 0
                    seen.clear()
        yield from flush()

    return texts.select("node", "text", *chained).mapInArrow(run, "bucket int, nodes binary, places binary, hashes binary, around binary")


def _repeated_anchors(most: float, shards: int):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        """The anchors of a bucket that occur at two places or more, packed by shards of their nodes: shard, hot (more than
        most different surroundings), nodes, places."""
        node = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("nodes")])
        place, h, around = (np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column(c)]) for c in ("places", "hashes", "around"))
        order = np.lexsort((place, node, around, h))
        node, place, h, around = node[order], place[order], h[order], around[order]
        begins = changes(h)
        new = begins | changes(node) | changes(place)
        node, place, h, around, begins = node[new], place[new], h[new], around[new], changes(h[new])
        first = np.flatnonzero(begins)
        often = np.diff(np.r_[first, len(h)])
        different = np.add.reduceat((begins | changes(around)).astype(np.int64), first) if len(first) else often
        keep = np.repeat(often > 1, often)
        hot = np.repeat(different > most, often)[keep]
        node, place = node[keep], place[keep]
        shard = (mix(node.view(U)) % U(shards)).astype(np.int64)
        order = np.lexsort((shard, hot))
        node, place, hot, shard = node[order], place[order], hot[order], shard[order]
        ends = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (hot[1:] != hot[:-1]), True]) if len(shard) else np.zeros(1, np.int64)
        rows = [(int(shard[a]), bool(hot[a]), node[a:z].tobytes(), place[a:z].astype("<u4").tobytes()) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
        cols = list(zip(*rows)) or [()] * 4
        return pa.table({c: pa.array(x, k) for c, x, k in zip(("shard", "hot", "nodes", "places"), cols, (pa.int32(), pa.bool_(), pa.binary(), pa.binary()))})

    return run


def _by_node(table: pa.Table) -> pa.Table:
    """node, places, hot: for each node of a shard its repeated anchors, packed, apart those that are hot."""
    node = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("nodes")])
    place = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("places")])
    hot = np.repeat(table.column("hot").to_numpy(zero_copy_only=False), [len(x.as_py()) // 8 for x in table.column("nodes")])
    order = np.lexsort((place, hot, node))
    node, place, hot = node[order], place[order], hot[order]
    first = np.flatnonzero(changes(node))
    cold, warm = [], []
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(node)]):
        k = a + int(np.count_nonzero(~hot[a:z]))
        cold.append(place[a:k].astype("<u4").tobytes())
        warm.append(place[k:z].astype("<u4").tobytes())
    return pa.table({"node": pa.array(node[first], pa.int64()), "places": pa.array(cold, pa.binary()), "hot": pa.array(warm, pa.binary())})


def emit_surroundings(texts: DataFrame, buckets: int, levels: int = 0) -> DataFrame:
    """texts: node, doc, text, packed places, and those for each level before. Packed rows of the bytes around repeated anchors."""
    names = ["bucket", "data", "sizes", "owners", "nodes", "docs", "starts"]
    chained = [f"hot{k}" for k in range(levels)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, tuple] = {}  # different bytes; of each anchor: which bytes, node, document, start
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for b, (parts, *of) in by_bucket.items():
                rows.append((b, b"".join(parts), np.array([len(p) for p in parts], "<u4").tobytes(), *[x.tobytes() for x in of]))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)

        for batch in batches:
            for row, (node, doc) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                raw = (batch.column(2)[row].as_py() or "").encode()
                data = np.frombuffer(raw, np.uint8)
                lo, hi, h, _ = intervals(data, [_unpacked(batch.column(4 + k)[row]) for k in range(levels)])
                repeated = np.isin(lo, _unpacked(batch.column(3)[row]))
                to = (h >> U(40)) % U(buckets)
                for a, z, b in zip(lo[repeated].tolist(), hi[repeated].tolist(), to[repeated].tolist()):
                    part = raw[a : z - 1 + LENGTH]
                    if b not in by_bucket:
                        by_bucket[b] = {}, array("I"), array("q"), array("q"), array("I")
                    parts, *of = by_bucket[b]
                    i = parts.get(part)
                    if i is None:
                        i = parts[part] = len(parts)
                        held += len(part) + 200
                    held += 24
                    for x, v in zip(of, (i, node, doc, a)):
                        x.append(v)
                if held > FLUSH_BYTES:
                    yield from flush()
                    by_bucket, held = {}, 0
        yield from flush()

    return texts.select("node", "doc", "text", "places", *chained).mapInArrow(run, "bucket int, data binary, sizes binary, owners binary, nodes binary, docs binary, starts binary")


def _matches(keep_first: bool):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        """node, runs: covered bytes of each node's strings in one bucket, as packed starts and ends."""
        parts: dict[bytes, int] = {}
        which, node, doc, start = [], [], [], []
        for row in table.to_pylist():
            at, own = 0, []
            for size in np.frombuffer(row["sizes"], "<u4").tolist():
                own.append(parts.setdefault(row["data"][at : at + size], len(parts)))
                at += size
            which.append(np.array(own, np.int64)[np.frombuffer(row["owners"], "<u4")])
            node.append(np.frombuffer(row["nodes"], "<i8"))
            doc.append(np.frombuffer(row["docs"], "<i8"))
            start.append(np.frombuffer(row["starts"], "<u4").astype(np.int64))
        which, node, doc, start = map(np.concatenate, (which, node, doc, start))
        # each part stands for its first owner, and the parts are laid out in their order
        order = np.lexsort((start, node, doc))
        which, node, start = which[order], node[order], start[order]
        part, lead = np.unique(which, return_index=True)
        laid = part[np.argsort(lead)]
        name = np.empty(len(parts), np.int64)
        name[laid] = np.arange(len(laid))
        which = name[which]
        content = list(parts)
        content = [content[i] for i in laid.tolist()]
        del parts, table
        size = np.array([len(p) for p in content], np.int64)
        offset = np.cumsum(size) - size
        strings = size - LENGTH + 1
        base = np.cumsum(strings) - strings
        starts = np.arange(strings.sum()) + np.repeat(offset - base, strings)
        order, common = suffix_order(np.frombuffer(b"".join(content), np.uint8), starts)
        factor, source = previous_factors(starts[order], common)
        later = factor >= LENGTH
        removed = np.zeros(len(starts), bool)
        removed[order[later]] = True
        if not keep_first:
            removed[order[source[later]]] = True
        is_first = np.zeros(len(which), bool)
        is_first[np.sort(lead)] = True
        copied = np.bincount(which, minlength=len(size)) > 1
        out_node, out_runs = [], []
        for i, n, a, first in zip(which.tolist(), node.tolist(), start.tolist(), is_first.tolist()):
            if not first or (copied[i] and not keep_first):
                lo, hi = np.array([a]), np.array([a + size[i]])
            else:
                hit = np.flatnonzero(removed[base[i] : base[i] + strings[i]])
                if not len(hit):
                    continue
                lo, hi = covered(hit + a, LENGTH)
            out_node.append(n)
            out_runs.append(np.stack([lo, hi], 1).astype("<u4").tobytes())
        return pa.table({"node": pa.array(out_node, pa.int64()), "runs": pa.array(out_runs, pa.binary())})

    return run


def cut(raw: bytes, runs: list[bytes]) -> tuple[int, int, bytes, list[tuple[int, int]]]:
    """Removed bytes, maximal removed spans, what is left, and the spans."""
    spans = np.concatenate([np.frombuffer(r, "<u4").reshape(-1, 2) for r in runs]).astype(np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    first = np.flatnonzero(new)
    lo, hi = spans[first, 0], np.maximum.reduceat(spans[:, 1], first)
    left = b"".join(raw[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)]))
    return int((hi - lo).sum()), len(lo), left, list(zip(lo.tolist(), hi.tolist()))


#: Parts of 64 bits of a SHA-256.
PARTS = 4


def node_of_sha(part: int = 0) -> Column:
    """64 bits of the text's SHA-256 as a signed long: the first ones, or a later part."""
    high, low = (F.conv(F.substring("sha", 16 * part + k, 8), 16, 10).cast("long") for k in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _with_nodes(rows: DataFrame, moved: DataFrame | None) -> DataFrame:
    """The rows (with a column sha) and their nodes. moved: sha, part of the few whose node is not of the first part."""
    if moved is None:
        return rows.withColumn("node", node_of_sha())
    few = F.broadcast(moved) if moved.count() <= BROADCAST_IDS else moved
    part = F.coalesce(F.col("part"), F.lit(0))
    return rows.join(few, "sha", "left").withColumn("node", F.coalesce(*[F.when(part == k, node_of_sha(k)) for k in range(PARTS)])).drop("part")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (half-open byte ranges) of every document."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the node is 64 bits of the text's SHA-256; of texts that share them all but one get a node of the next 64
    named = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("sha", F.sha2("text", 256))
    facts = materialize(named.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")).withColumn("node", node_of_sha()), "suffix-docs")
    total, n_rows = facts.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count("*")).first()
    buckets = max(4 * shuffle_partitions(spark), total // ANCHOR_BYTES)
    whole_numbers = isinstance(facts.schema["doc_id"].dataType, IntegralType)
    place = F.coalesce(F.col("doc_id").cast("long") if whole_numbers else F.xxhash64("doc_id"), F.lit(-(1 << 63)))
    by_node = lambda: materialize(facts.groupBy("node").agg(F.min(place).alias("doc"), F.count("*").alias("copies"), F.min("sha").alias("sha"), F.max("sha").alias("other")), "suffix-nodes")
    firsts, moved = by_node(), None
    for part in range(1, PARTS):
        clashing = firsts.filter("sha <> other").select("node", F.col("sha").alias("stays"))
        if not clashing.limit(1).count():
            break
        more = facts.join(clashing, "node").filter("sha <> stays").select("sha").distinct().withColumn("part", F.lit(part))
        moved = materialize(more if moved is None else moved.unionByName(more).groupBy("sha").agg(F.max("part").alias("part")), "suffix-moved")
        facts = materialize(_with_nodes(facts.drop("node"), moved), "suffix-docs")
        firsts = by_node()
    else:
        if firsts.filter("sha <> other").limit(1).count():
            raise RuntimeError("two texts share all parts of their SHA-256")

    long_ones = _with_nodes(named.filter(F.octet_length("text") >= LENGTH).select("sha", "text"), moved).select("node", "text")
    packed = emit_anchors(long_ones, buckets)
    runs, level = None, 0
    while True:
        # the last gram is the string itself, of which nothing goes on
        most = HOT if level + 1 < len(GRAMS) else float("inf")
        found = packed.groupBy("bucket").applyInArrow(_repeated_anchors(most, buckets // 4), "shard int, hot boolean, nodes binary, places binary")
        found = found.groupBy("shard").applyInArrow(_by_node, "node long, places binary, hot binary")
        if not level:
            found = materialize(found.join(firsts.select("node", "doc"), "node"), "suffix-places")
            few = found.count() <= BROADCAST_IDS
            ids = found.select("node")
            texts = long_ones.join(F.broadcast(ids) if few else ids, "node").groupBy("node").agg(F.first("text").alias("text"))
            texts = all_texts = materialize(texts.join(found.withColumnRenamed("hot", "hot0"), "node"), "suffix-texts")
            discard(found)
        else:
            found = found.withColumnRenamed("hot", f"hot{level}")
            texts = materialize(texts.drop("places").join(found, "node"), f"suffix-texts-{level}")
        # strings of an anchor start within LENGTH - gram bytes, half of them on average
        some = texts.filter(F.octet_length("places") > 0)
        n, hot = texts.agg(*[F.sum(F.octet_length(c).cast("long") / 4).cast("long") for c in ("places", f"hot{level}")]).first()
        span = 1.5 if not level else 1 + (LENGTH - GRAMS[level]) / LENGTH / 2
        around = emit_surroundings(some, max(4 * shuffle_partitions(spark), int((n or 0) * span * LENGTH / BUCKET_BYTES)), level)
        got = around.groupBy("bucket").applyInArrow(_matches(keep == "first"), "node long, runs binary")
        runs = got if runs is None else runs.unionByName(got)
        if not hot:
            break
        texts = texts.filter(F.octet_length(f"hot{level}") > 0)
        level += 1
        # an interval has some of the next anchors, at last one for each string
        packed = emit_anchors(texts, max(buckets, hot * LENGTH // FLUSH), level)
    runs = runs.groupBy("node").agg(F.collect_list("runs").alias("runs"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, r in zip(batch.column(1), batch.column(2).to_pylist()):
                removed, n, left, spans = cut((x.as_py() or "").encode(), r)
                rows.append((removed, n, hashlib.sha256(left).hexdigest(), [{"start": a, "end": b} for a, b in spans]))
            cols = list(zip(*rows)) or [()] * 4
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), span))]], names=["node", "removed", "n", "left_sha", "cut_spans"])

    some = all_texts.select("node", "text").join(runs, "node").mapInArrow(finish, "node long, removed long, n long, left_sha string, cut_spans array<struct<start:bigint,end:bigint>>")
    # rows of a text with very many copies are not dealt by its node: there are few such texts
    many = firsts.filter(F.col("copies") > max(MANY_COPIES, n_rows * COPIES_SHARE // 1_000_000)).select("node", F.col("doc").alias("many_doc"))
    facts = facts.join(F.broadcast(many), "node", "left")
    later = F.col("many_doc").isNotNull() & (F.lit(keep == "none") | (place != F.col("many_doc")))
    crowd = facts.filter(later).select("doc_id", "node", "n_bytes", "sha", F.lit(2).cast("long").alias("copies"), F.col("many_doc").alias("doc"))
    crowd = crowd.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("removed", "long"), ("n", "long"), ("left_sha", "string"), ("cut_spans", "array<struct<start:bigint,end:bigint>>"))])
    copied = firsts.filter("copies > 1").select("node", "copies", "doc")
    rest = facts.filter(~later).drop("many_doc").join(copied, "node", "left").join(some, "node", "left")
    out = rest.unionByName(crowd)
    whole = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    if keep == "first":
        whole = whole & (place != F.col("doc"))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.coalesce("cut_spans", nothing)).alias("spans"),
    )
