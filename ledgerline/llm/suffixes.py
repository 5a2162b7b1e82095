"""Exact repeats of ``length`` bytes across a corpus: suffix arrays per shard, merged across shards.

1. Every window of ``length`` bytes has a key, the least hash of the 32-byte strings in it. Neighbouring windows mostly
   share it, so a text is cut into runs of windows, one for about 35 bytes. Equal windows have equal keys: a key at
   one place of the corpus holds no repeat, and all windows that may be equal meet under one key. Nothing is lost here.
2. The text of the remaining runs goes to shards by key. A shard is a suffix array in numpy by Larsson-Sadakane
   refinement with Kasai's common prefixes; windows between neighbours that share ``length`` bytes are equal, and all but
   the earliest are repeats.
3. A key too frequent for one shard is dealt to several. Each passes on its distinct windows, sorted, and the runs are
   merged by binary search.

Earlier means: smaller id, then smaller hash of the text, then earlier start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import store

#: Bytes of a shard; numpy needs about 40 bytes for each.
SHARD_BYTES = 3 << 20
GRAM = 32
#: Windows per cell of the merge.
CELL_WINDOWS = 500_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Stands for a null id: before all others.
NO_ID = -(2**63)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash (63 bits) of each string of ``GRAM`` bytes."""
    p = data.astype(np.uint64)
    for k in (1, 2, 4):
        p = p[:-k] | (p[k:] << np.uint64(8 * k))
    for k, (x, y) in ((8, (_A, _B)), (16, (_B, _C))):
        p = p[:-k] * x + p[k:] * y
        p ^= p >> np.uint64(31)
    p *= _C
    p ^= p >> np.uint64(29)
    return (p >> np.uint64(1)).astype(np.int64)


def sliding_least(values: np.ndarray, reach: int) -> np.ndarray:
    out, span = values, 1
    while 2 * span <= reach:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (reach - span)], out[reach - span :]) if reach > span else out


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Key, text number, first start, number of starts of each run of windows, and whether its key is at two places in it."""
    long_enough = [k for k, t in enumerate(texts) if len(t) >= length]
    if not long_enough:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty, empty > 0
    data = np.frombuffer(b"".join(texts[k] for k in long_enough), dtype=np.uint8)
    sizes = np.array([len(texts[k]) for k in long_enough])
    begins = np.cumsum(sizes) - sizes
    reach = length - GRAM + 1
    hashes = gram_hashes(data)
    keys = sliding_least(hashes, reach)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    new[begins[begins < len(keys)]] = True
    tails = begins + sizes - length + 1  # first start that is no longer a window of the text
    new[tails[tails < len(keys)]] = True
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(keys)))
    text = np.searchsorted(begins, at, "right") - 1
    valid = at < tails[text]
    at, count, text = at[valid], count[valid], text[valid]
    own = keys[at]
    twice = np.zeros(len(at), dtype=bool)
    around, back = np.arange(reach), np.arange(reach)[::-1]
    for k in range(0, len(at), 4096):
        part, key = slice(k, k + 4096), own[k : k + 4096, None]
        first = at[part] + (hashes[at[part, None] + around] == key).argmax(axis=1)
        end = at[part] + count[part] - 1
        last = end + reach - 1 - (hashes[end[:, None] + back] == key).argmax(axis=1)
        twice[part] = first != last
    return own, np.array(long_enough)[text], at - begins[text], count, twice


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order. Groups of suffixes equal in their first h bytes are refined by the group of the suffix h further on."""
    n = len(data)
    key = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        key = (key[:-k] << np.uint64(8 * k)) | key[k:]
    key = key[:n]
    order = np.argsort(key, kind="stable")
    first = np.ones(n, dtype=bool)
    first[1:] = key[order[1:]] != key[order[:-1]]
    group = np.empty(n + 1, dtype=np.int64)  # the place of a suffix's group
    group[n] = -1
    # Suffixes shorter than 8 bytes are told from their zero-padded equals by the later steps, as the end is below all.
    group[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    starts = np.flatnonzero(first)
    alone = np.diff(np.append(starts, n)) == 1
    open_slots = np.flatnonzero(~np.repeat(alone, np.diff(np.append(starts, n))))
    h = 8
    while len(open_slots):
        suffix = order[open_slots]
        code = group[suffix] * (n + 2) + group[np.minimum(suffix + h, n)] + 1
        turn = np.argsort(code, kind="stable")
        suffix, code = suffix[turn], code[turn]
        order[open_slots] = suffix
        first = np.ones(len(code), dtype=bool)
        first[1:] = code[1:] != code[:-1]
        starts = np.flatnonzero(first)
        group[suffix] = open_slots[starts][np.cumsum(first) - 1]
        sizes = np.diff(np.append(starts, len(code)))
        open_slots = open_slots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lane: int = 128) -> np.ndarray:
    """Kasai: bytes (up to ``most``) that each suffix in order shares with the one before; lanes of text advance together."""
    n = len(order)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(most + 1, dtype=np.uint8)])
    shared = np.zeros(n, dtype=np.int32)
    starts = np.arange(0, n, lane)
    h = np.zeros(len(starts), dtype=np.int64)
    for step in range(min(lane, n)):
        at = starts + step
        at = at[at < n]
        h = np.maximum(h[: len(at)] - 1, 0)
        prior = before[at]
        h[prior < 0] = 0
        live = np.flatnonzero((prior >= 0) & (h < most))
        while len(live):
            a, b = at[live] + h[live], prior[live] + h[live]
            same = (padded[a] == padded[b]) & (np.maximum(a, b) < n)
            live = live[same]
            h[live] += 1
            live = live[h[live] < most]
        shared[at] = h
    return shared[order]


def repeats(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For the joined pieces: which places start a window, and which of these are repeats of an earlier one."""
    sizes = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    ends = np.cumsum(sizes)
    window = np.ones(len(data), dtype=bool)
    tails = np.repeat(ends, sizes) - np.arange(len(data))
    window &= tails >= length
    order = suffix_array(data)
    shared = common_prefixes(data, order, length)
    classes = np.cumsum(shared < length)
    slots = np.flatnonzero(window[order])
    place, own = order[slots], classes[slots]
    repeat = np.zeros(len(data), dtype=bool)
    if len(place):
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        least = np.minimum.reduceat(place, starts)
        repeat[place] = place != np.repeat(least, np.diff(np.append(starts, len(place))))
    return window, repeat


def spread(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_RUNS = "key long, doc long, twin long, start int, count int, twice boolean"
_SPANS = "doc long, twin long, start int, stop int, cell int, run long, prints binary, docs binary, twins binary, starts binary"
_NAMES = [x.split()[0] for x in _SPANS.split(", ")]


def _runs_of(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a = 0
            while a < len(texts):
                b, held = a, 0
                while b < len(texts) and (held < 2 << 20 or b == a):
                    held += len(texts[b])
                    b += 1
                key, text, start, count, twice = runs(texts[a:b], length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[a:b][text]), pa.array(twins[a:b][text]), pa.array(start.astype(np.int32)),
                     pa.array(count.astype(np.int32)), pa.array(twice)],
                    names=["key", "doc", "twin", "start", "count", "twice"],
                )
                a = b

    return docs.select("doc", "twin", "bytes").mapInArrow(run, _RUNS)


def _pieces_of(candidates: DataFrame, length: int) -> DataFrame:
    """The text below each run: (key, parts, doc, twin, start, piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(2)[k].as_py()
                hits = batch.column(3).slice(k, 1).flatten()
                key, parts, start, count = (hits.field(i) for i in range(4))
                cut = [data[s : s + c + length - 1] for s, c in zip(start.to_pylist(), count.to_pylist(), strict=True)]
                same = lambda c: pa.array(np.full(len(cut), batch.column(c)[k].as_py(), dtype=np.int64))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [key, parts, same(0), same(1), start, pa.array(cut, pa.binary())],
                    names=["key", "parts", "doc", "twin", "start", "piece"],
                )

    return candidates.select("doc", "twin", "bytes", "hits").mapInArrow(
        run, "key long, parts int, doc long, twin long, start int, piece binary"
    )


def _search(pieces: DataFrame, length: int, cells: int, shard_bytes: int) -> DataFrame:
    """Repeats within shards, and for keys dealt to several shards their distinct windows by cell."""

    def shard(rows: list[tuple], merge: bool) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], int] = {}
        kept, whole = [], []
        for row in rows:
            (whole if (row[0], row[4]) in seen else kept).append(row)
            seen.setdefault((row[0], row[4]), 1)
        doc, twin, start, stop = [], [], [], []
        for _, d, t, s, piece in whole:  # the same text under the same key: all its windows are repeats
            doc.append(d), twin.append(t), start.append(s), stop.append(s + len(piece))
        window, repeat = repeats([r[4] for r in kept], length)
        sizes = np.array([len(r[4]) for r in kept])
        begins = np.cumsum(sizes) - sizes
        for a, b in zip(*spread(repeat), strict=True):
            k = int(np.searchsorted(begins, a, "right")) - 1
            _, d, t, s, _ = kept[k]
            doc.append(d), twin.append(t), start.append(s + int(a - begins[k])), stop.append(s + int(b - begins[k]) + length)
        if doc:
            n = len(doc)
            none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.binary())] * 4]
            columns = [pa.array(doc, pa.int64()), pa.array(twin, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *none], names=_NAMES)
        if merge:
            data = b"".join(r[4] for r in kept)
            places = np.flatnonzero(window & ~repeat)
            prints = np.array([xxhash.xxh3_64_intdigest(data[p : p + length]) for p in places.tolist()], dtype=np.uint64)
            order = np.argsort(prints, kind="stable")
            prints, places = prints[order], places[order]
            of = np.searchsorted(begins, places, "right") - 1
            docs = np.array([r[1] for r in kept])[of]
            twins = np.array([r[2] for r in kept])[of]
            starts = np.array([r[3] for r in kept])[of] + places - begins[of]
            again = np.array([xxhash.xxh3_64_intdigest(data[p : p + length], 1) for p in places.tolist()], dtype=np.uint64)
            bounds = np.searchsorted(prints, (np.arange(1, cells) * (2**64 // cells)).astype(np.uint64)) if cells > 1 else []
            for cell, part in enumerate(np.split(np.arange(len(prints)), bounds)):
                if len(part):
                    blobs = [np.stack([prints[part], again[part]], axis=1).tobytes(), docs[part].tobytes(), twins[part].tobytes(), starts[part].tobytes()]
                    row = [None, None, None, None, cell, int(rows[0][0]), *blobs]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], type=t) for v, t in zip(row, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4], strict=True)],
                        names=_NAMES,
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, current = 0, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, parts, doc, twin, start, piece in zip(*columns, strict=True):
                new = key != current
                full = size + len(piece) > shard_bytes
                # A key in one part is never cut; keys in several parts have shards of their own, cut where they are full.
                if held and ((new and (full or parts > 1 or held_parts > 1)) or (full and parts > 1)):
                    yield from shard(held, held_parts > 1)
                    held, size = [], 0
                held.append((key, doc, twin, start, piece))
                held_parts, size, current = parts, size + len(piece), key
        if held:
            yield from shard(held, held_parts > 1)

    return pieces.select("key", "parts", "doc", "twin", "start", "piece").mapInArrow(run, _SPANS)


def _merge(found: DataFrame, length: int) -> DataFrame:
    """Windows of the sorted runs that an earlier document holds too, as spans."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        prints = np.zeros((0, 2), dtype=np.uint64)
        place = np.zeros((0, 3), dtype=np.int64)
        later = []
        for row in cell.itertuples():
            own = np.frombuffer(row.prints, dtype=np.uint64).reshape(-1, 2)
            at = np.stack([np.frombuffer(x, dtype=np.int64) for x in (row.docs, row.twins, row.starts)], axis=1)
            spot = np.searchsorted(prints[:, 0], own[:, 0])
            near = np.minimum(spot, max(len(prints) - 1, 0))
            hit = (prints[near] == own).all(axis=1) if len(prints) else np.zeros(len(own), dtype=bool)
            old, new = place[near[hit]], at[hit]
            first = np.zeros(len(new), dtype=bool)  # the new window is the earlier one
            equal = np.ones(len(new), dtype=bool)
            for c in range(3):
                first |= equal & (new[:, c] < old[:, c])
                equal &= new[:, c] == old[:, c]
            later += [old[first], new[~first & ~equal]]
            place[near[hit][first]] = new[first]
            fresh = np.flatnonzero(~hit)
            prints = np.insert(prints, spot[fresh], own[fresh], axis=0)
            place = np.insert(place, spot[fresh], at[fresh], axis=0)
        out = np.concatenate(later) if later else place[:0]
        out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
        cut = np.ones(len(out), dtype=bool)
        cut[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1) | (out[1:, 2] > out[:-1, 2] + 1)
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(out)) - 1
        return pd.DataFrame({
            "doc": out[begin, 0], "twin": out[begin, 1], "start": out[begin, 2].astype(np.int32),
            "stop": (out[end, 2] + length).astype(np.int32),
        })

    return found.groupBy("cell").applyInPandas(run, "doc long, twin long, start int, stop int")


def remove_repeats(
    df: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = 100, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (start, stop of removed bytes) per row.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier in the corpus. Null texts are empty; null
    ids come before all others; of rows with equal text the one with the smallest id stays (of repeated rows one), the
    others lose all if they have ``length`` bytes. Only id and text are read.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    docs = df.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(content).alias("twin"), content.alias("bytes"),
    )
    same = F.sha2("bytes", 256)
    facts = store(
        docs.select("doc", "twin", F.octet_length("bytes").cast("long").alias("n_bytes"), same.alias("sha"))
        .groupBy("doc", "twin", "sha", "n_bytes").agg(F.count("*").alias("n")), "facts")
    firsts = facts.groupBy("sha").agg(F.min("doc").alias("first"))
    facts = store(facts.join(firsts, "sha").withColumn("is_first", F.col("doc") == F.col("first")).drop("first"), "firsts")

    # Runs whose key occurs at two different places of two different texts, or of one. Copies of a text count once.
    by_key = Window.partitionBy("key")
    place = F.struct("twin", "start")
    repeated = (
        _runs_of(docs, length)
        .withColumns({"low": F.min(place).over(by_key), "high": F.max(place).over(by_key), "n": F.sum(F.col("count") + length).over(by_key)})
        .where("low <> high or twice")
        .join(facts.where("is_first").select("doc", "twin"), ["doc", "twin"], "left_semi")
    )
    parts = F.ceil(F.col("n") / shard_bytes).cast("int")
    hits = store(
        repeated.groupBy("doc", "twin").agg(F.collect_list(F.struct("key", parts.alias("parts"), "start", "count")).alias("hits")), "hits")
    candidates = store(docs.drop("id").dropDuplicates(["doc", "twin"]).join(hits, ["doc", "twin"]), "candidates")

    pieces = _pieces_of(candidates, length).withColumn("part", F.pmod(F.xxhash64("doc", "twin"), F.col("parts")))
    ordered = pieces.repartition("key", "part").sortWithinPartitions("key", "doc", "twin", "start")
    dealt = hits.select(F.explode("hits").alias("h")).where("h.parts > 1").agg(F.coalesce(F.sum("h.count"), F.lit(0))).first()[0]
    cells = max(1, -(-dealt // CELL_WINDOWS))
    found = store(_search(ordered, length, cells, shard_bytes), "found")
    spans = found.where("cell is null").select("doc", "twin", "start", "stop")
    if dealt:
        spans = spans.unionByName(_merge(found.where("cell is not null"), length))
    per_text = spans.groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    changed = candidates.select("doc", "twin", "bytes").join(per_text, ["doc", "twin"]).mapInArrow(
        _cut, "doc long, twin long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    gone = (F.col("n_bytes") >= length) & (~F.col("is_first") | (F.col("copy") > 1))

    def pick(name: str, if_gone: Column, otherwise: Column) -> Column:
        return F.when(gone, if_gone).otherwise(F.coalesce(F.col(name), otherwise)).alias(name)

    each = facts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return each.join(changed, ["doc", "twin"], "left").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_column), "n_bytes",
        pick("n_removed", F.col("n_bytes"), F.lit(0)).cast("long").alias("n_removed"),
        pick("n_spans", F.lit(1), F.lit(0)).cast("long").alias("n_spans"),
        pick("kept_sha256", F.lit(hashlib.sha256().hexdigest()), F.col("sha")),
        pick("spans", F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop"))), none),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans, as digests."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        rows = []
        for data, spans in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            data, gone = data.as_py(), union([(s["start"], s["stop"]) for s in spans])
            digest, at = hashlib.sha256(), 0
            for a, b in gone:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            rows.append((sum(b - a for a, b in gone), len(gone), digest.hexdigest(), [{"start": a, "stop": b} for a, b in gone]))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.string()), pa.array(columns[3], kind)],
            names=["doc", "twin", "n_removed", "n_spans", "kept_sha256", "spans"],
        )
