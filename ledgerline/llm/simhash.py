"""Near-duplicates by SimHash fingerprints and BK-trees.

Fingerprints are grouped into shards in which every pair within the radius can meet: for a small radius by all pairs of
bit blocks (two fingerprints that differ in r bits agree on two of r + 2 blocks, so none is missed), for a large one by
samples of bits, as many as the wanted recall takes. A shard is a BK-tree: children are keyed by their Hamming distance
to the parent, and a search follows only edges within the radius. Trees are built where their shard is instead of being
broadcast, because all trees together grow with the corpus; a shard above ``SHARD_ROWS`` is cut into slices of which
each pair gets a tree of its own. Subtrees already linked to the searching fingerprint are skipped, so a large group of
copies costs little, and a shard passes on a spanning forest, never all pairs.

With ``similarity`` fingerprints only propose: pairs that share a band of minimum hashes are candidates, and a link counts
once the exact Jaccard similarity of the two shingle sets has been computed. Candidates are first each node and the
smallest node of its bands; then, inside shards that hold the sets, all that differ in at most ``radius`` sketch bits and
are not connected yet. No pair leaves a shard, only edges that merge components.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import small_batches, store, utf8
from ledgerline.llm.graph import components

#: Fingerprints of one shard above which it is cut, and rows that are searched at a time.
SHARD_ROWS = 20_000
TASK_ROWS = 100_000
VISITS = 500_000
#: Bytes of shingle sets in a slice of a shard, and in the shards that a task works on at once.
SHARD_BYTES, TASK_BYTES = 16 << 20, 32 << 20


@dataclass(frozen=True)
class Settings:
    """``words`` 64-bit words of fingerprint over shingles of ``shingle`` words; links differ in at most ``radius`` bits.

    Without ``recall`` no link is missed. With it (large radius), tables of sampled bits find a pair at the radius with that
    probability and closer pairs with a higher one. A table's shards hold about ``load`` fingerprints: the smaller they are,
    the more bits a table needs and the more tables the recall takes.
    """

    shingle: int = 3
    words: int = 1
    radius: int = 2
    recall: float | None = None
    load: int = 16
    seed: int = 42
    #: Least Jaccard similarity of shingle sets, in percent, which each link is checked for; None: the radius decides.
    similarity: int | None = None


#: Bands of minimum hashes: at a similarity of 0.8 a pair shares one of 20 bands of 5 with probability 0.9996.
BANDS, BAND_ROWS = 20, 5
#: One bit of each of 256 minimum hashes; at 0.8 they differ in 25.6 bits with a deviation of 4.8, so 46 loses about 1 in 10,000.
SIMILAR = Settings(shingle=5, words=4, radius=46, similarity=80)


def shingle_hashes(data: bytes, size: int, seed: int) -> list[int]:
    """XXH64 of each shingle, repeats included; of all words if there are fewer; none without words."""
    words = data.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    digest = xxhash.xxh64_intdigest
    return [digest(b" ".join(part), seed) for part in zip(*[words[k:] for k in range(size)])]


def simhash(hashes: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """Fingerprints (texts, words) of hashes that lie text after text. A bit is set if it is in over half of a text's hashes.

    Eight bits of a hash at a time are spread to the bytes of a word and summed, at most 255 hashes to a sum.
    """
    out = np.zeros((len(counts), words), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some].astype(np.int64)
    pieces = -(-n // 255)
    firsts = np.concatenate([[0], np.cumsum(n)[:-1]])
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(firsts, pieces) + 255 * inner
    texts = np.cumsum(pieces) - pieces
    ones = np.uint64(0x0101010101010101)
    for w in range(words):
        h = hashes
        if w:  # further words: a different mixing of the same hash
            h = (hashes ^ np.uint64(w)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
        for j in range(8):
            sums = np.add.reduceat((h >> np.uint64(j)) & ones, starts)
            totals = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), texts, axis=0)
            set_bits = (2 * totals > n[:, None]).astype(np.uint64)
            out[some, w] |= (set_bits << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(j))).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprint(df: DataFrame, text: str, into: str, settings: Settings) -> DataFrame:
    """Add the binary column ``into``, big-endian. Null texts and texts without a word have fingerprint zero."""

    small_batches(df)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for a in range(0, len(batch), 500):
                values = utf8(batch.slice(a, 500))
                each = [np.array(shingle_hashes(d or b"", settings.shingle, settings.seed), np.uint64) for d in values]
                counts = np.array([len(x) for x in each])
                found = simhash(np.concatenate(each), counts, settings.words)
                parts += [x.tobytes() for x in found.astype(">u8")]
            yield pa.array(parts, type=pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # as objects: Spark reads them
    return df.withColumn(into, F.arrow_udf(run, "binary")(F.col(text).cast("string")))


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Trees:
    """BK-trees over rows of fingerprints, one tree per group; all trees grow level by level together."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        n = len(prints)
        self.prints, self.width = prints, 64 * prints.shape[1] + 1
        self.parent, self.edge = np.full(n, -1), np.zeros(n, dtype=np.int64)
        self.levels: list[np.ndarray] = []
        rest, key = np.arange(n), np.unique(groups, return_inverse=True)[1]
        while len(rest):
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            nodes = rest[first]
            self.levels.append(nodes)
            of = nodes[np.cumsum(first) - 1]
            rest, of = rest[~first], of[~first]
            gap = hamming(prints[rest], prints[of])
            self.parent[rest], self.edge[rest] = of, gap
            key = of * self.width + gap
        self.root = np.empty(n, dtype=np.int64)
        for nodes in self.levels:
            self.root[nodes] = np.where(self.parent[nodes] < 0, nodes, self.root[np.maximum(self.parent[nodes], 0)])
        code = self.parent * self.width + self.edge
        self.children = np.argsort(code, kind="stable")
        self.codes = code[self.children]
        self.sizes = np.bincount(self.root, minlength=n)[self.root]

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """The label that a whole subtree has, or -1."""
        out = label.copy()
        for nodes in self.levels[:0:-1]:
            up = self.parent[nodes]
            out[up[out[nodes] != label[up]]] = -1
        return out

    def search(self, rows: np.ndarray, radius: int, label: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, node) within the radius, but for subtrees that wholly have the row's label."""
        q, v = rows, self.root[rows]
        found_q, found_v = [], []
        while len(q):
            new = whole[v] != label[q]
            q, v = q[new], v[new]
            gap = hamming(self.prints[q], self.prints[v])
            hit = (gap <= radius) & (q != v)
            found_q.append(q[hit])
            found_v.append(v[hit])
            low = np.searchsorted(self.codes, v * self.width + np.maximum(gap - radius, 0), "left")
            high = np.searchsorted(self.codes, v * self.width + np.minimum(gap + radius, self.width - 1), "right")
            many = high - low
            q = np.repeat(q, many)
            v = self.children[np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
        return np.concatenate(found_q), np.concatenate(found_v)

    def forest(self, radius: int) -> np.ndarray:
        """For each row the first row of its component."""
        label = np.arange(len(self.prints))
        chunk = np.cumsum(self.sizes) // VISITS
        for part in np.split(label.copy(), np.flatnonzero(np.diff(chunk)) + 1):
            a, b = self.search(part, radius, label, self.uniform(label))
            label = merged(label, a, b)
        return label


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after linking a and b; a label is the smallest row of its component."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _tables(settings: Settings, count: int) -> list[np.ndarray]:
    """Bit numbers of each table."""
    bits = 64 * settings.words
    if settings.recall is None:
        blocks = np.array_split(np.arange(bits), settings.radius + 2)
        return [np.concatenate(pair) for pair in itertools.combinations(blocks, 2)]
    size = max(10, min(40, math.ceil(math.log2(max(count / settings.load, 2)))))
    agree = (1 - settings.radius / bits) ** size
    number = math.ceil(math.log(1 - settings.recall) / math.log(1 - agree))
    draw = np.random.default_rng(settings.seed)
    return [draw.choice(bits, size, replace=False) for _ in range(number)]


def _bits(prints: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(prints), dtype=np.uint64)
    for k, bit in enumerate(numbers):
        out |= ((prints[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)) << np.uint64(k)
    return out


def _prints(column: pa.Array, words: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=">u8").reshape(-1, words).astype(np.uint64)


def links(prints: DataFrame, settings: Settings, count: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (``a``, ``b``) between distinct fingerprints ``fp`` that together connect what lies within the radius."""
    tables, words, radius = _tables(settings, count), settings.words, settings.radius

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _prints(batch.column(0), words)
            for k, numbers in enumerate(tables):
                code = (_bits(values, numbers) ^ np.uint64(k << 44)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code), batch.column(0)], names=["key", "fp"])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def search():
            group, values = (np.concatenate(x) for x in zip(*held, strict=True))
            label = Trees(values, group).forest(radius)
            more = np.flatnonzero(label != np.arange(len(label)))
            raw = [x.tobytes() for x in values.astype(">u8")]
            ends = [pa.array([raw[i] for i in side], pa.binary()) for side in (more, label[more])]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for batch in batches:
            group, values = batch.column(0).to_numpy(), _prints(batch.column(1), words)
            last = np.flatnonzero(group != group[-1])  # the last shard may go on in the next batch
            cut = last[-1] + 1 if len(last) else 0
            if held and sum(len(g) for g, _ in held) >= TASK_ROWS and (cut or group[0] != held[-1][0][-1]):
                own = np.flatnonzero(group != held[-1][0][-1])
                end = own[0] if len(own) else len(group)
                held.append((group[:end], values[:end]))
                yield search()
                held = []
                group, values = group[end:], values[end:]
            if len(group):
                held.append((group, values))
        if held:
            yield search()

    keyed = prints.select("fp").mapInArrow(keys, "key long, fp binary")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / shard_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), slices).cast("int")
    dealt = keyed.join(sizes, "key").select(
        "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("other")
    ).select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp")
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "fp")
    return ordered.mapInArrow(trees, "a binary, b binary")


def with_sketch(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add ``fp``, a digest of the shingle set (16 bytes) and its sketch, and ``keys``, its bands of 8 bytes each."""
    small_batches(df)
    bits = 64 * settings.words
    draw = np.random.default_rng(settings.seed)
    flips, factors = draw.integers(0, 2**64, (2, bits), dtype=np.uint64)
    factors |= np.uint64(1)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for data in utf8(batch):
                hashes = np.unique(np.array(shingle_hashes(data or b"", settings.shingle, settings.seed), np.uint64))
                least = np.full(bits, 2**64 - 1, np.uint64)
                for a in range(0, len(hashes), 512):
                    np.minimum(least, ((hashes[a : a + 512, None] ^ flips) * factors).min(axis=0), out=least)
                sketch = np.packbits((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63) == 1)
                bands = [xxhash.xxh64_digest(least[BAND_ROWS * j : BAND_ROWS * (j + 1)].tobytes(), j) for j in range(BANDS)]
                out.append(xxhash.xxh3_128_digest(hashes.tobytes()) + sketch.tobytes() + b"".join(bands))
            yield pa.array(out, type=pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    both = df.withColumn("_both", F.arrow_udf(run, "binary")(F.col(text).cast("string")))
    size = 16 + bits // 8
    return both.withColumns({"fp": F.substring("_both", 1, size), "keys": F.substring("_both", size + 1, 8 * BANDS)}).drop("_both")


def _shingle_sets(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add ``shingles``, the sorted distinct hashes of the text as bytes."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(
                [np.unique(np.array(shingle_hashes(d or b"", settings.shingle, settings.seed), np.uint64)).tobytes() for d in utf8(batch)],
                type=pa.binary(),
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn("shingles", F.arrow_udf(run, "binary")(F.col(text).cast("string")))


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets have at least the similarity."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            found = []
            for x, y in zip(left, right, strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                found.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.array(found, pa.bool_())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    left = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    short, long = (f(F.octet_length("x"), F.octet_length("y")) for f in (F.least, F.greatest))
    joined = pairs.join(left, "a").join(right, "b").where(short * 100 >= long * percent)
    return joined.where(F.arrow_udf(run, "boolean")("x", "y")).select("a", "b")


def checked_links(texts: DataFrame, prints: DataFrame, settings: Settings, shard_bytes: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect exactly the candidates which links of checked similarity connect.

    First each node is checked against the pivot, the smallest node, of each of its bands, in a join. Bands whose nodes
    are not all connected by that become shards to which the shingle sets are sent: there a BK-tree finds what lies within
    the radius, the sets decide, and what leaves the task is one edge for each component that was merged.

    ``texts`` has ``_id``, ``_text`` and ``twin``; ``prints`` has ``fp``, ``keys`` and ``_least``, the row that stands for it.
    """
    words, radius = settings.words, settings.radius

    def sketch(column: pa.Array) -> np.ndarray:
        width = 2 + words
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
        return np.ascontiguousarray(raw.reshape(-1, width)[:, 2:])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(hamming(sketch(batch.column(0)), sketch(batch.column(1))) <= radius))

    def search(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        group, root = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
        raw = np.array([x for b in held for x in b.column(2).to_pylist()], dtype=object)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for b in held for x in b.column(3)]
        # Roots are one only inside a group here: another group of this task may hold other rows of it.
        label = first_places(group, root)
        before = label.copy()
        tree = Trees(np.concatenate([sketch(b.column(2)) for b in held]), group)
        chunk = np.cumsum(tree.sizes) // VISITS
        for part in np.split(np.arange(len(label)), np.flatnonzero(np.diff(chunk)) + 1):
            a, b = tree.search(part, radius, label, tree.uniform(label))
            label = linked(label, a, b, group, sets, settings.similarity)
        joined = np.flatnonzero((before == np.arange(len(label))) & (label != before))  # one edge for each root that was merged
        return pa.RecordBatch.from_arrays([pa.array(raw[x], pa.binary()) for x in (joined, label[joined])], names=["a", "b"])

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                group = batch.column(0).to_numpy()
                if size >= TASK_BYTES and group[0] != held[-1].column(0)[-1].as_py():
                    yield search(held)
                    held, size = [], 0
                same = np.flatnonzero(group != group[0])
                cut = same[0] if size >= TASK_BYTES and len(same) else len(group)
                held.append(batch.slice(0, cut))
                size, batch = size + held[-1].nbytes, batch.slice(cut)
        if held:
            yield search(held)

    key = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.substring("keys", j * 8 + 1, F.lit(8))))
    keyed = prints.select("fp", key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where("n > 1")
    shared = store(keyed.join(sizes, "key"), "shared")
    wanted = prints.join(shared.select("fp").distinct(), "fp", "left_semi").select(
        "fp", F.col("_least.id").alias("_node_id"), F.col("_least.twin").alias("_node_twin")
    )
    its = F.col("_id").eqNullSafe(F.col("_node_id")) & (F.col("twin") == F.col("_node_twin"))
    # Of repeated rows one; the set is made once a row, after the join has dropped the others.
    sets = store(
        _shingle_sets(texts.join(wanted, its), "_text", settings).groupBy("fp").agg(F.first("shingles").alias("shingles")), "shingles"
    )
    stars = shared.where("fp <> pivot").select(F.col("fp").alias("a"), F.col("pivot").alias("b")).distinct()
    first = store(_checked(stars.mapInArrow(close, "a binary, b binary"), sets, settings.similarity), "stars")
    rooted = shared.select("key", "fp").join(components(first).withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.xxhash64(F.coalesce("root", "fp")).alias("root")
    )
    sized = rooted.join(sets.select("fp", F.octet_length("shingles").alias("bytes")), "fp")
    main = sized.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min_by("root", "fp").alias("main"))
    apart = sized.join(main.where("low <> high").select("key", "main"), "key").withColumn("other", F.col("root") != F.col("main"))
    large = apart.groupBy("key").agg(
        *[F.greatest(F.ceil(F.sum(F.when(side, F.col("bytes") + 64)) / shard_bytes), F.lit(1)).cast("int").alias(n) for n, side in (("rest", F.col("other")), ("mains", ~F.col("other")))]
    )
    ordered = apart.join(large, "key").select(F.explode(_shards_of()).alias("shard"), "root", "fp").join(sets, "fp").select(
        "shard", "root", "fp", "shingles"
    ).repartition("shard").sortWithinPartitions("shard", "fp")
    return first.unionByName(store(ordered.mapInArrow(forests, "a binary, b binary"), "rest"))


def _shards_of() -> Column:
    """The shards of a row of ``key``, so that any two rows meet unless both are linked to its pivot already (``other`` false).

    The rows linked to the pivot are cut into ``mains`` slices and the others into ``rest``; a shard holds one slice of each,
    or two slices of the others. A key whose rows fit in one shard has one.
    """
    slice_ = F.pmod(F.xxhash64("fp"), F.when(F.col("other"), F.col("rest")).otherwise(F.col("mains"))).cast("int")

    def shard(kind: int, a: Column, b: Column) -> Column:
        return F.xxhash64("key", F.lit(kind), a, b)

    with_mains = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: shard(0, slice_, j))
    with_rest = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda j: shard(1, F.least(slice_, j), F.greatest(slice_, j)))
    others = F.when(F.col("rest") > 1, F.concat(with_mains, with_rest)).otherwise(with_mains)
    return F.when(F.col("other"), others).otherwise(F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda j: shard(0, j, slice_)))


def first_places(group: np.ndarray, root: np.ndarray) -> np.ndarray:
    """For each row the first row of the same group and root."""
    order = np.lexsort((np.arange(len(group)), root, group))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (group[order][1:] != group[order][:-1]) | (root[order][1:] != root[order][:-1])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


#: Pairs of one group above which sets are compared as rows of bits, and pairs at a time.
_FEW, _PAIRS = 64, 20_000


def linked(label: np.ndarray, a: np.ndarray, b: np.ndarray, group: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The labels after linking those of the pairs (a, b) whose sets have the similarity. Pairs already linked are not compared."""
    sizes = np.array([len(s) for s in sets])
    short, long = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    wanted = (a < b) & (100 * short >= percent * long) & (label[a] != label[b])
    back = (a > b) & (100 * short >= percent * long) & (label[a] != label[b])
    pairs = np.unique(np.stack([np.concatenate([a[wanted], b[back]]), np.concatenate([b[wanted], a[back]])]), axis=1)
    order = np.argsort(group[pairs[0]], kind="stable")
    a, b = pairs[0][order], pairs[1][order]
    cuts = np.flatnonzero(np.diff(group[a])) + 1
    for x, y in zip(np.split(a, cuts), np.split(b, cuts), strict=True):
        compare = _Bits(np.unique(np.concatenate([x, y])), sets) if len(x) > _FEW else None
        for k in range(0, len(x), _PAIRS):
            p, q = x[k : k + _PAIRS], y[k : k + _PAIRS]
            apart = label[p] != label[q]
            p, q = p[apart], q[apart]
            if compare is None:
                both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(p, q, strict=True)], np.int64)
            else:
                both = compare.common(p, q)
            near = 100 * both >= percent * (sizes[p] + sizes[q] - both)
            label = merged(label, p[near], q[near])
    return label


class _Bits:
    """Sets as rows of bits, over the members that more than one of the sets has, some columns at a time."""

    _COLUMNS = 1 << 14

    def __init__(self, rows: np.ndarray, sets: list[np.ndarray]):
        self.rows = rows
        of = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        _, member, counts = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
        column = np.cumsum(counts > 1) - 1
        several = counts[member] > 1
        self.of, self.column = of[several], column[member[several]]
        order = np.argsort(self.column, kind="stable")
        self.of, self.column = self.of[order], self.column[order]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Members that the sets of each pair share."""
        a, b = np.searchsorted(self.rows, a), np.searchsorted(self.rows, b)
        total = np.zeros(len(a), np.int64)
        for low in range(0, int(self.column[-1]) + 1 if len(self.column) else 0, self._COLUMNS):
            own = slice(*np.searchsorted(self.column, [low, low + self._COLUMNS]))
            width = int(self.column[own][-1]) - low + 1
            flat = np.zeros(len(self.rows) * -(-width // 64) * 64, dtype=bool)
            flat[self.of[own] * (-(-width // 64) * 64) + self.column[own] - low] = True
            bits = np.packbits(flat).view(np.uint64).reshape(len(self.rows), -1)
            for k in range(0, len(a), 2000):
                total[k : k + 2000] += np.bitwise_count(bits[a[k : k + 2000]] & bits[b[k : k + 2000]]).sum(axis=1, dtype=np.int64)
        return total


def near_duplicates(df: DataFrame, text: str = "text", id_column: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """``id``, ``twin`` (a hash of the text), ``fp`` (binary), ``component_id`` and ``chosen`` for every row.

    ``component_id`` is the smallest id reachable over links; ``chosen`` is true for the row of that id (of several texts
    under one id, for the smallest hash). Texts without a word share fingerprint zero and link like any other. Equal
    fingerprints are one node, so a group of copies of any size is one row after an aggregate that combines before the
    shuffle. Null ids belong to components but name one only if it has no other. Repeated rows come back each. Only id and
    text are read.
    """
    texts = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).withColumn("twin", text_hash("_text"))
    exact = settings.similarity is not None
    made = with_sketch(texts, "_text", settings) if exact else with_fingerprint(texts, "_text", "fp", settings)
    rows = store(made.drop("_text"), "prints")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "twin"))
    prints = store(rows.groupBy("fp").agg(first.alias("_least"), *([F.min("keys").alias("keys")] if exact else [])), "distinct")
    edges = checked_links(texts, prints, settings, SHARD_BYTES) if exact else links(prints, settings, prints.count())
    roots = components(edges)
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root")
    )
    names = named.groupBy("root").agg(F.min("_least").alias("_first"))
    by_print = named.join(names, "root").select("fp", "_first")
    chosen = F.col("_id").eqNullSafe(F.col("_first.id")) & (F.col("twin") == F.col("_first.twin"))
    return rows.drop("keys").join(by_print, "fp").select(
        F.col("_id").alias(id_column), "twin", "fp", F.col("_first.id").alias("component_id"), chosen.alias("chosen")
    )


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def keep_one(df: DataFrame, text: str = "text", id_column: str = "doc_id", settings: Settings = SIMILAR) -> DataFrame:
    """The rows of ``df`` with one of each component: the one with the smallest id (see ``near_duplicates``); of repeated rows one."""
    kept = store(
        near_duplicates(df, text, id_column, settings).where("chosen")
        .select(F.col(id_column).alias("_kept_id"), F.col("twin").alias("_kept_twin")).distinct(),
        "kept",
    )
    rows = df.withColumn("_twin", text_hash(text))
    same = F.col(id_column).eqNullSafe(F.col("_kept_id")) & (F.col("_twin") == F.col("_kept_twin"))
    turn = Window.partitionBy(id_column, "_twin").orderBy("_twin")
    return rows.join(kept, same, "left_semi").withColumn("_turn", F.row_number().over(turn)).where("_turn = 1").select(*df.columns)
