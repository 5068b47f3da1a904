"""N-gram Jaccard join by universe partition.

A document is its set of hashed 5-word shingles. Sets go to size bands; the scheme of band j
joins band j with itself and with band j + 1, beyond which the similarity cannot be reached.
A scheme deals the shingle universe to m segments by hash. Two sets that link differ in at
most H shingles, so if one of them has more than H segments with a shingle in them, at least
one of these is the same in both: its subset's hash is a signature that both emit. A segment
that also emits its one-deletion neighbourhood counts twice, as there one shingle may differ.
It is enough that one of the two has so many; sets that have too few are short, and emit each
shingle for itself besides, which joins them with each other. How many segments a scheme has,
and in how many of them neighbourhoods are emitted, is the allocation of the fewest signatures
over all documents, those of short sets included.

Groups of sets with a common signature give candidates, which are pruned by parity sketches
(the number of different bits never exceeds the difference of the sets) and verified on the
texts. Candidates come in two rounds: first each set against the centres of its groups, then
all pairs of a group that are not yet in one component, in blocks of members. What a set has
beyond its need lets it leave its most frequent signatures' groups in that round (two sets
that link share more signatures than a set that is not short leaves, all leave by one order
and short ones leave none, so the rarest that they share stays); a passage that many documents
share does not pair them all.

Exact copies (equal sets) are one node throughout. Shingles are compared by 64-bit hashes, and a node is
64 bits of its set: of n different sets some n * n / 2**65 pairs are taken for one, which is not verified.

Defined results: null texts and texts without words have n_shingles 0 and link with nothing,
not with each other; texts of fewer than five words are one shingle; a text of any length is
one set of all its shingles; repeated rows are copies; of equal least doc_ids in a component
it does not matter which gives component_id; documents without an id link like others, and a
component of such alone has none; an empty table gives no rows; other columns, whatever their
names, are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lean, materialize, shuffle_partitions
from .graph import components
from .hashing import BASE, Ranges, U, mix

N = 5
#: Segments per shingle of a band's least size, and one in how many of them has neighbourhoods. The
#: last allocation, one shingle a segment, leaves no set short.
ALLOCATIONS = ((0.34, 2), (0.42, 4), (0.45, 0), (0.47, 0), (0.5, 0), (0.56, 0), (0.75, 0), (math.inf, 0))
LAST = len(ALLOCATIONS) - 1
#: What is added to a scheme's number for the shingles of its short sets; there are fewer schemes.
SHORT = 128
#: Signatures in a bucket, about.
BUCKET_SIGNATURES = 300_000
#: Bands whose least size is below this have one shingle a segment.
SMALL = 24
#: Candidate ids up to this many are broadcast (8 bytes each), more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Signatures a task holds before it hands them on.
FLUSH = 600_000

_C1, _C2 = U(BASE), U(0xBF58476D1CE4E5B9)
WHITE = np.isin(np.arange(256), [32, *range(9, 14)])


class Shingles:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, n: int = N) -> None:
        self.n = n
        self.powers = [U(pow(BASE, k, 1 << 64)) for k in range(n)]

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode().lower(), np.uint8)  # of bytes, only A to Z change
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~WHITE[data]
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        k = len(starts)
        if not k:
            return np.empty(0, U)
        h = Ranges(data).between(starts, ends)
        if k < self.n:
            return mix(np.array([(h * np.array(self.powers[:k])).sum() + U(k)], U))
        s = np.full(k - self.n + 1, U(self.n))
        for i, p in enumerate(self.powers):
            s += h[i : k - self.n + 1 + i] * p
        s = mix(s)
        s.sort()
        return s[changes(s)]


def node_of(s: np.ndarray) -> int:
    """Identity of a set, as a signed long."""
    x = xxhash.xxh64_intdigest(s.tobytes())
    return x - (1 << 64) if x >> 63 else x


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both) and both > 0


def sketch(s: np.ndarray) -> bytes:
    """Parity of the number of shingles by hash, in as many bits as shingles (a power of two, 256 at least)."""
    bits = max(256, 1 << (len(s) - 1).bit_length()) if len(s) else 256
    return np.packbits((np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound on the symmetric difference of two sets, from their sketches."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def most_difference(total: int) -> int:
    """The largest difference at which two sets of that total size, or a little less, link."""
    return max(t - 2 * -(-3 * t // 7) for t in range(max(2, total - 7), total + 1))


@lru_cache(None)
def band_starts(upto: int = 1 << 40) -> tuple[int, ...]:
    out = [1]
    while out[-1] < upto:
        out.append(4 * out[-1] // 3 + 1)
    return tuple(out)


def band(n: int) -> int:
    import bisect

    return bisect.bisect_right(band_starts(), n) - 1


@lru_cache(4096)
def needed(n: int, scheme: int) -> int:
    """Segments that must count for a set of n shingles in a scheme."""
    starts = band_starts()
    if band(n) == scheme:
        return most_difference(n + 4 * n // 3) + 1
    return most_difference(n + starts[scheme + 1] - 1) + 1


def schemes_of(n: int) -> tuple[int, ...]:
    j = band(n)
    return (j, j - 1) if j and 4 * (band_starts()[j] - 1) >= 3 * n else (j,)


def shape(scheme: int, allocation: int) -> tuple[int, int]:
    """Number of segments (0: one shingle each) and of those with neighbourhoods."""
    per, share = ALLOCATIONS[allocation]
    least = band_starts()[scheme]
    if math.isinf(per) or least < SMALL:
        return 0, 0
    m = math.ceil(per * least)
    return m, m // share if share else 0


def segments(s: np.ndarray, m: int) -> np.ndarray:
    """The segment of each shingle: its hash's place among m ranges, so in order where the hashes are."""
    return ((s >> U(32)) * U(m)) >> U(32)


def changes(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before, the first included."""
    out = np.empty(len(x), bool)
    out[:1] = True
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def accounts(s: np.ndarray, scheme: int) -> list[int]:
    """For each allocation what a set has beyond its need (below 0: it is short), and how many signatures it emits."""
    n, need = len(s), needed(len(s), scheme)
    out, known = [], {}
    for a in range(len(ALLOCATIONS)):
        m, wide = shape(scheme, a)
        if not m:
            out += [n - need, n]
            continue
        if m not in known:
            seg = segments(s, m)
            known[m] = seg, 1 + int(np.count_nonzero(seg[1:] != seg[:-1]))
        seg, some = known[m]
        twice = np.bincount(seg[: np.searchsorted(seg, U(wide))].astype(np.int64)) if wide else np.empty(0, np.int64)
        twice = twice[twice >= 2]
        spare, cost = some + len(twice) - need, some + int(twice.sum())
        out += [spare, cost if spare >= 0 else cost + n]
    return out


def signatures(s: np.ndarray, scheme: int, allocation: int, tag: int | None = None) -> np.ndarray:
    m, wide = shape(scheme, allocation)
    salt = U(((scheme if tag is None else tag) + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    if not m:
        return mix(s ^ salt)
    seg, h = segments(s, m), mix(s ^ _C1)
    first = np.flatnonzero(changes(seg))
    sums = np.add.reduceat(h, first)
    place = salt + (seg + U(1)) * _C2
    out = mix(sums + place[first])
    if wide and (n := int(np.searchsorted(seg, U(wide)))):
        held = np.diff(np.r_[first, len(seg)])
        own = np.repeat(np.arange(len(first)), held)[:n]
        less = mix(sums[own] - h[:n] + place[:n])
        out = np.concatenate([out, less[held[own] >= 2]])
    return out


def emitted(s: np.ndarray, scheme: int, allocation: int) -> list[tuple[int, np.ndarray]]:
    """(scheme or SHORT + scheme, signatures) of a set."""
    out = [(scheme, signatures(s, scheme, allocation))]
    m, wide = shape(scheme, allocation)
    if m:
        seg = segments(s, m)
        count = 1 + int(np.count_nonzero(seg[1:] != seg[:-1]))
        if wide:
            count += int(np.count_nonzero(np.bincount(seg[: np.searchsorted(seg, U(wide))].astype(np.int64)) >= 2))
        if count < needed(len(s), scheme):
            out.append((SHORT + scheme, signatures(s, scheme, LAST, SHORT + scheme)))
    return out


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, node, n_shingles, band, sketch, and for the set's one or two schemes what each allocation would leave and cost."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "text_hash", "node", "n_shingles", "band", "sketch", "own", "upper"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles()
        for batch in batches:
            rows = []
            for x in batch.column(2):
                s = of(x.as_py())
                if not len(s):
                    rows.append((None, 0, -1, None, None, None))
                    continue
                both = [accounts(s, scheme) for scheme in schemes_of(len(s))]
                rows.append((node_of(s), len(s), band(len(s)), sketch(s), both[0], both[1] if len(both) > 1 else None))
            cols = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(cols, kinds)]], names=names)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return picked.mapInArrow(lean(run), f"doc_id {id_type}, text_hash long, node long, n_shingles long, band int, sketch binary, own array<int>, upper array<int>")


def allocate(sets: DataFrame) -> tuple[dict[int, int], int]:
    """The cheapest allocation of each scheme, and how many signatures there will be. The driver gets a row for each size band."""
    k = len(ALLOCATIONS)
    aggs = [F.sum(F.get(F.col(c), F.lit(2 * a + 1))).alias(f"{c}{a}") for c in ("own", "upper") for a in range(k)]
    rows = {r["band"]: r for r in sets.filter("band >= 0").groupBy("band").agg(*aggs).collect()}
    out, total = {}, 0
    for scheme in {j for b in rows for j in (b, b - 1) if j >= 0}:
        cost = lambda a: sum(rows[b][f"{c}{a}"] or 0 for b, c in ((scheme, "own"), (scheme + 1, "upper")) if b in rows)  # noqa: B023, E731
        out[scheme] = min(range(k), key=lambda a: (cost(a), a))
        total += cost(out[scheme])
    return out, total


def emit(docs: DataFrame, chosen: dict[int, int], buckets: int, text_col: str) -> DataFrame:
    """Signatures, packed: a row for each bucket and flush with the nodes, how many signatures each has, and 40 bits of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles()
        nodes, scheme_of, sigs, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not sigs:
                return
            count = np.array([len(x) for x in sigs])
            every = np.concatenate(sigs)
            owner = np.repeat(np.arange(len(sigs)), count)
            to = ((every >> U(40)) % U(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            every, owner, to = every[order], owner[order], to[order]
            node, scheme = np.array(nodes, np.int64), np.array(scheme_of, np.uint8)
            ends = np.searchsorted(to, np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                x, o = every[ends[b] : ends[b + 1]], owner[ends[b] : ends[b + 1]]
                if len(x):
                    first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                    who, n = o[first], np.diff(np.r_[first, len(o)])
                    rows.append((b, node[who].tobytes(), scheme[who].tobytes(), n.astype("<u2").tobytes() if n.max() < 65536 else n.astype("<u4").tobytes(), (x & U(0xFFFFFFFF)).astype("<u4").tobytes(), (x >> U(32)).astype(np.uint8).tobytes()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["bucket", "nodes", "schemes", "counts", "low", "high"])

        seen: set[int] = set()
        for batch in batches:
            for x in batch.column(0):
                s = of(x.as_py())
                if not len(s):
                    continue
                node = node_of(s)
                if node in seen:
                    continue
                seen.add(node)
                for scheme in schemes_of(len(s)):
                    for tag, got in emitted(s, scheme, chosen[scheme]):
                        nodes.append(node)
                        scheme_of.append(tag)
                        sigs.append(got)
                        held += len(got)
                if held > FLUSH:
                    yield from flush()
                    nodes, scheme_of, sigs, held = [], [], [], 0
                    seen.clear()
        yield from flush()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(lean(run), "bucket int, nodes binary, schemes binary, counts binary, low binary, high binary")


def _groups(table: pa.Table) -> pa.Table:
    """The distinct groups of nodes that share a signature in one bucket, with the number of such signatures."""
    node, scheme, sig = [], [], []
    for row in table.to_pylist():
        n = np.frombuffer(row["nodes"], np.int64)
        low = np.frombuffer(row["low"], "<u4")
        count = np.frombuffer(row["counts"], "<u2" if len(row["counts"]) == 2 * len(n) else "<u4").astype(np.int64)
        sig.append(low.astype(U) | np.frombuffer(row["high"], np.uint8).astype(U) << U(32))
        node.append(np.repeat(n, count))
        scheme.append(np.repeat(np.frombuffer(row["schemes"], np.uint8), count))
    sig, node, scheme = np.concatenate(sig), np.concatenate(node), np.concatenate(scheme)
    order = np.argsort(sig, kind="stable")
    sig, node, scheme = sig[order], node[order], scheme[order]
    same = sig[1:] == sig[:-1]
    keep = np.r_[False, same] | np.r_[same, False]
    sig, node, scheme = sig[keep], node[keep], scheme[keep]
    order = np.lexsort((node, sig))
    sig, node, scheme = sig[order], node[order], scheme[order]
    new = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])] if len(sig) else np.empty(0, bool)
    sig, node, scheme = sig[new], node[new], scheme[new]
    first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.empty(0, np.int64)
    size = np.diff(np.r_[first, len(sig)])
    key = np.add.reduceat(mix(node.view(U)), first) if len(first) else np.empty(0, U)
    first, key, size = first[size > 1], key[size > 1], size[size > 1]
    key = mix(key ^ (scheme[first].astype(U) + U(1)) * _C1)
    key, at, times = np.unique(key, return_index=True, return_counts=True)
    members = [node[first[i] : first[i] + size[i]] for i in at]
    return pa.table(
        {
            "key": pa.array(key.view(np.int64), pa.int64()), "scheme": pa.array(scheme[first[at]].astype(np.int32), pa.int32()),
            "times": pa.array(times, pa.int64()), "nodes": pa.array(members, pa.list_(pa.int64())),
        }
    )


def shared_groups(packed: DataFrame) -> DataFrame:
    """key, scheme, times, nodes: each distinct group of two nodes or more, and its number of signatures."""
    got = packed.groupBy("bucket").applyInArrow(_groups, "key long, scheme int, times long, nodes array<long>")
    return got.groupBy("key").agg(F.first("scheme").alias("scheme"), F.sum("times").alias("times"), F.first("nodes").alias("nodes"))


def fitting(pairs: np.ndarray, size: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Which pairs (rows of two places) sizes and sketches do not rule out."""
    i, j = pairs[:, 0], pairs[:, 1]
    fits = (4 * size[i] >= 3 * size[j]) & (4 * size[j] >= 3 * size[i])
    most = size[i] + size[j] + 2 * (-3 * (size[i] + size[j]) // 7)
    length = np.array([len(x) for x in sketches], np.int64)
    at = np.zeros(len(sketches), np.int64)
    rows: dict[int, np.ndarray] = {}
    for n in np.unique(length).tolist():
        own = np.flatnonzero(length == n)
        at[own] = np.arange(len(own))
        rows[n] = np.frombuffer(b"".join(sketches[k] for k in own.tolist()), np.uint8).reshape(len(own), n)

    def folded(n: int, which: np.ndarray, to: int) -> np.ndarray:
        x = rows[n][at[which]]
        while x.shape[1] > to:
            half = x.shape[1] // 2
            x = x[:, :half] ^ x[:, half:]
        return x

    left = np.flatnonzero(fits)
    both = length[i[left]] * (1 << 32) + length[j[left]]
    for code in np.unique(both).tolist():
        one, two = code >> 32, code & (1 << 32) - 1
        every = left[both == code]
        step = max(1, (8 << 20) // max(one, two))
        for k in range(0, len(every), step):
            part = every[k : k + step]
            to = min(one, two)
            differ = np.bitwise_count(folded(one, i[part], to) ^ folded(two, j[part], to)).sum(axis=1, dtype=np.int64)
            fits[part] = differ <= most[part]
    return fits


def prune(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not rule out."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            k = x.num_rows
            if k:
                size = np.concatenate([x.column(2).to_numpy(), x.column(3).to_numpy()])
                fits = fitting(np.stack([np.arange(k), np.arange(k) + k], 1), size, x.column(4).to_pylist() + x.column(5).to_pylist())
                yield x.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(lean(run), "a long, b long")


#: Members of a family's groups that meet in one task, about. Groups of more members are dealt in pairs of blocks.
SHARD_ROWS = 2_000
#: Of each member's groups, so many least ones are known where it meets others: a pair that shares one of them, less
#: than the group at hand, is left to that one.
KNOWN_KEYS = 8
#: Pairs a task holds before it reduces them to different ones.
HELD_PAIRS = 1_000_000


def _open_pairs(table: pa.Table) -> pa.Table:
    """Different fitting pairs (a, b) of the members of each group that are in different components, and, where two blocks
    of a group meet, in different blocks. Pairs that are known to meet in a lesser group are left out."""
    key, node, block, origin = (table.column(c).to_numpy() for c in ("key", "node", "block", "origin"))
    nodes, first, name = np.unique(node, return_index=True, return_inverse=True)
    root = np.unique(table.column("root").to_numpy(), return_inverse=True)[1][first]
    size = table.column("n").to_numpy()[first]
    sketches = [x.as_py() for x in table.column("sketch").take(pa.array(first))]
    known = np.frombuffer(b"".join(x.as_py() for x in table.column("known").take(pa.array(first))), ">i8").reshape(len(first), KNOWN_KEYS).astype(np.int64)
    order = np.lexsort((name, key, origin))
    key, name, block, origin = key[order], name[order], block[order], origin[order]
    ends = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    # pairs as codes, and the least group in which each meets here
    seen, least, codes, groups, held = np.empty(0, np.int64), np.empty(0, np.int64), [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every, at = np.unique(np.concatenate([seen, *codes]), return_index=True)
        return every, np.concatenate([least, *groups])[at]

    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
        m, blocks = name[a:z], block[a:z]
        r = root[m]
        inside = r == np.bincount(r).argmax()
        # the largest component is never held against itself
        m, r, blocks = (np.concatenate([x[~inside], x[inside]]) for x in (m, r, blocks))
        for k in range(int((~inside).sum())):
            open_ = r[k + 1 :] != r[k]
            if blocks[k] >= 0:
                open_ &= blocks[k + 1 :] != blocks[k]
            other = m[k + 1 :][open_]
            codes.append(np.minimum(other, m[k]) * len(nodes) + np.maximum(other, m[k]))
            groups.append(np.full(len(other), origin[a]))
            held += len(other)
            if held > HELD_PAIRS:
                (seen, least), codes, groups, held = merged(), [], [], 0
    seen, least = merged()
    pairs = np.stack([seen // len(nodes), seen % len(nodes)], 1)
    if len(pairs):
        fits = fitting(pairs, size, sketches)
        pairs, least = pairs[fits], least[fits]
    elsewhere = np.zeros(len(pairs), bool)
    for k in range(KNOWN_KEYS):
        mine = known[pairs[:, 0], k]
        elsewhere |= (mine < least) & (known[pairs[:, 1]] == mine[:, None]).any(axis=1)
    pairs = pairs[~elsewhere]
    return pa.table({"a": pa.array(nodes[pairs[:, 0]], pa.int64()), "b": pa.array(nodes[pairs[:, 1]], pa.int64())})


def known_keys(open_: DataFrame) -> DataFrame:
    """node, known: its KNOWN_KEYS least groups as packed longs, the last one again where there are fewer."""
    nth = F.row_number().over(Window.partitionBy("node").orderBy("key"))
    few = open_.select("node", "key").withColumn("nth", nth).filter(F.col("nth") <= KNOWN_KEYS)
    # sixteen hex digits of each key, in order
    rows = few.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("nth", "key"))).alias("k"))
    digits = F.transform(F.sequence(F.lit(1), F.lit(KNOWN_KEYS)), lambda i: F.lpad(F.hex(F.element_at("k", F.least(i, F.size("k")))["key"]), 16, "0"))
    return rows.select("node", F.unhex(F.array_join(digits, "")).alias("known"))


def sharded(open_: DataFrame) -> DataFrame:
    """Members of groups (key, node, root) dealt to shards: shard, key, node, root, block, and the group's own key as origin.

    Groups of one family mostly have one least member: they meet in a few shards, each of which
    gives a pair once. A group of more than SHARD_ROWS / 2 members is cut into blocks, and each
    pair of blocks is a group of its own (block -1: all pairs count, else those of two blocks).
    """
    half = max(1, SHARD_ROWS // 2)
    about = open_.groupBy("key").agg(F.min("node").alias("start"), F.count("*").alias("size"))
    rows = about.filter(F.col("size") <= half).groupBy("start").agg(F.ceil(F.sum("size") / SHARD_ROWS).alias("parts"))
    few = about.filter(F.col("size") <= half).join(rows, "start")
    few = few.select("key", F.xxhash64("start", F.pmod(F.col("key"), F.col("parts"))).alias("shard"))
    small = open_.join(few, "key").select("shard", "key", "node", "root", F.lit(-1).alias("block"), F.col("key").alias("origin"))
    many = about.filter(F.col("size") > half).select("key", F.ceil(F.col("size") / F.lit(half)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    cut = open_.join(many, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    apart = F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise(F.col("own"))
    large = cut.select(pair.alias("shard"), pair.alias("key"), "node", "root", apart.alias("block"), F.col("key").alias("origin"))
    return small.unionByName(large)


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose texts (node, text) link."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles()
        last, s = None, None
        for x in batches:
            fits = []
            for a, ta, tb in zip(x.column(0).to_pylist(), x.column(2), x.column(3)):
                if a != last:
                    last, s = a, of(ta.as_py())
                fits.append(linked(s, of(tb.as_py())))
            yield x.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return pairs.join(two, "b").join(one, "a").select("a", "b", "ta", "tb").mapInArrow(lean(run), "a long, b long")


def _ordered(a, b):  # noqa: ANN001, ANN202
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", centres: int = 3) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    return linked_rows(docs, id_col, text_col, centres).select("doc_id", "n_shingles", "component_id")


def link_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different sets, also inside components: (a, b) with a < b, and the node of every document
    (doc_id, node, n_shingles). Every pair of a group is held against each other, so a family of k different near
    copies costs k * k / 2 pairs of sketches and a verification for each that fits."""
    found = _Found(docs, id_col, text_col)
    pairs = found.keep(found.second_round(None, None), "ngram-second")
    links = materialize(found.verified(pairs, "ngram-second"), "ngram-all-links")
    discard(*found.tables)
    return links, found.described.select("doc_id", "node", "n_shingles")


class _Found:
    """The sets of documents and the groups that share signatures."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.docs, self.text_col, self.tables = docs, text_col, []
        self.described = materialize(describe(docs, id_col, text_col), "ngram-sets")
        self.chosen, total = allocate(self.described)
        packed = emit(docs, self.chosen, max(2 * shuffle_partitions(docs.sparkSession), total // BUCKET_SIGNATURES), text_col)
        self.members = self.keep(shared_groups(packed), "ngram-groups").select("key", "scheme", "times", F.size("nodes").alias("size"), F.explode("nodes").alias("node"))
        # one row for each different set: one of its texts stands for it
        sets = self.described.filter("band >= 0").groupBy("node").agg(
            F.min("text_hash").alias("text_hash"), F.first("n_shingles").alias("n"), F.first("band").alias("band"), F.first("sketch").alias("sketch"), F.first("own").alias("own"), F.first("upper").alias("upper")
        )
        self.sets = self.keep(sets.join(self.members.select("node").distinct(), "node", "left_semi"), "ngram-candidates")
        self.n_sets = self.sets.count()

    def keep(self, df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
        self.tables.append(materialize(df, tag, rows))
        return self.tables[-1]

    def first_round(self, centres: int) -> DataFrame:
        """Every set against the centres of its groups (the member that shares most), those first with which it shares most."""
        members = self.members
        shares = members.groupBy("node").agg(F.sum(F.col("times") * (F.col("size") - 1)).alias("shares"))
        centre = members.join(shares, "node").groupBy("key").agg(F.max(F.struct("shares", "node"))["node"].alias("a"))
        stars = members.join(centre, "key").filter(F.col("node") != F.col("a")).groupBy("a", F.col("node").alias("b")).agg(F.sum("times").alias("n"))
        top = Window.partitionBy("b").orderBy(F.desc("n"), "a")
        first = stars.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= centres).select(*_ordered(F.col("a"), F.col("b"))).distinct()
        return prune(first, self.sets)

    def second_round(self, roots: DataFrame | None, done: DataFrame | None) -> DataFrame:
        """Pairs of a group in different components, without the groups that a set need not be found in."""
        chosen, sets = self.chosen, self.sets
        k = F.create_map(*[F.lit(v) for s, a in chosen.items() for v in (s, 2 * a)]) if chosen else F.lit(None).cast("map<int,int>")
        double = F.create_map(*[F.lit(v) for s, a in chosen.items() for v in (s, 1 + (shape(s, a)[1] > 0))]) if chosen else F.lit(None).cast("map<int,int>")
        member = self.members.join(sets.select("node", "band", "own", "upper"), "node")
        is_short, scheme = F.col("scheme") >= SHORT, F.col("scheme") % SHORT
        place = F.when(is_short, F.lit(2 * LAST)).otherwise(F.try_element_at(k, scheme))
        spare = F.when(F.col("band") == scheme, F.get("own", place)).otherwise(F.get("upper", place))
        # the same order of signatures for all sets, frequent ones first, so that the rarest that a pair shares stays in both
        frequent = Window.partitionBy("node", "scheme").orderBy(F.desc("size"), "key").rowsBetween(Window.unboundedPreceding, 0)
        load = F.sum(F.col("times") * F.when(is_short, F.lit(1)).otherwise(F.try_element_at(double, scheme))).over(frequent)
        kept = member.withColumn("load", load).filter(F.col("load") > spare).select("key", "node")
        if roots is None:
            kept = kept.withColumn("root", F.col("node"))
        else:
            kept = kept.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        open_groups = kept.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
        kept = self.keep(kept.join(open_groups, "key", "left_semi"), "ngram-open")
        facts = sets.select("node", "n", "sketch").join(known_keys(kept), "node")
        rest = sharded(kept).join(facts, "node").groupBy("shard").applyInArrow(_open_pairs, "a long, b long").distinct()
        return rest if done is None else rest.join(done, ["a", "b"], "left_anti")

    def verified(self, pairs: DataFrame, tag: str) -> DataFrame:
        """Pairs that link. Texts come by broadcast of their hashes if these are few."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = self.keep(self.sets.select("node", "text_hash").join(wanted, "node", "left_semi"), f"{tag}-ids", self.n_sets)
        texts = self.docs.select(F.xxhash64(self.text_col).alias("text_hash"), F.col(self.text_col).alias("text"))
        got = texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "text_hash")
        return verify(pairs, self.keep(got.groupBy("node").agg(F.first("text").alias("text")), f"{tag}-texts"))


def linked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", centres: int = 3) -> DataFrame:
    """link_components with the hash of each row's text and whether the row stays where one of each component does.

    The row of the smallest doc_id stays, nulls last, of equal ones that of the smallest text_hash;
    rows of the same doc_id and text all do. Rows without shingles stay.
    """
    found = _Found(docs, id_col, text_col)
    first = found.keep(found.first_round(centres), "ngram-first", centres * found.n_sets)
    links = found.verified(first, "ngram-first")
    roots = components(links)
    second = found.keep(found.second_round(roots, first), "ngram-second")
    if second.limit(1).count():
        # the components so far are stars, which stand for their links
        more = found.verified(second, "ngram-second").unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        old, roots = roots, components(more)
        discard(old)
    discard(*found.tables)

    rooted = found.described.select("doc_id", "text_hash", "node", "n_shingles").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node")).withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.min("place").alias("first"))
    out = rooted.join(least, "root", "left")
    stays = F.col("root").isNull() | F.col("place").eqNullSafe(F.col("first"))
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "text_hash", stays.alias("stays"))
