"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over the words of the benchmark; document frequencies come from the whole corpus. A randomised
SVD of all passages of the corpus, whose moments and products are Spark jobs, gives a latent space. Every window of every document is compared with
every benchmark passage by cosine there (the benchmark is the stated, small query set). What comes near is checked on the
words: the longest common subsequence, and for weaker matches whether the answer, the end of the item, is there too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import small_batches, store


@dataclass(frozen=True)
class Settings:
    """``block`` words are the step between windows of two blocks. ``rank`` dimensions; all passages of the corpus and all
    benchmark passages, with as much weight together, fit the space. Items are searched in
    blocks of about ``item_bytes`` of text, each with a space of its own, so the broadcasts stay bounded. Words in more than ``common`` of all
    documents weigh nothing, unless an item has fewer than ``least_terms`` others. ``cosine``: least similarity of a
    candidate. A match has a common subsequence of ``verbatim`` of the item's words, or of ``paraphrase`` together with
    half of the rarer words of its answer.
    """

    block: int = 16
    rank: int = 128
    power: int = 2
    common: float = 0.1
    least_terms: int = 4
    cosine: float = 0.5
    coverage: float = 0.15
    verbatim: float = 0.8
    paraphrase: float = 0.55
    seed: int = 42
    item_bytes: int = 1_000_000


_SPACES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case runs of ASCII letters, digits and all characters beyond ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()


def common_subsequence(item: dict[bytes, int], words: list[bytes], size: int) -> int:
    """Length of the longest common subsequence; ``item`` has a bit mask of places for each of its ``size`` words."""
    full = (1 << size) - 1
    row = full
    for word in words:
        mask = item.get(word)
        if mask:
            met = row & mask
            row = ((row + met) | (row - met)) & full
    return size - row.bit_count()


def masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for k, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << k
    return out


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    masks: dict[bytes, int]
    answer: list[bytes]


@dataclass
class Space:
    """Latent vectors: of terms (weighted by IDF) and, of unit length, of benchmark passages, with their length and item."""

    terms: dict[bytes, int]
    vectors: np.ndarray
    passages: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    items: list[Item]


def _ids(words: list[bytes], terms: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(terms.get, words, repeat(-1)), dtype=np.int32, count=len(words))


def term_finder(terms: dict[bytes, int]) -> Callable[[list[str | None]], list[np.ndarray]]:
    """A function from texts to the numbers of their words, as ``_ids(words_of(text), terms)`` but with no object per word."""
    known = pa.array(list(terms), pa.large_binary())
    numbers = np.fromiter([*terms.values(), -1], np.int32, len(terms) + 1)

    def find(texts: list[str | None]) -> list[np.ndarray]:
        spaced = [(t or "").lower().encode("utf-8", "surrogatepass").translate(_SPACES) for t in texts]
        data = b" ".join(spaced)
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = np.frombuffer(data, dtype=np.uint8) != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        letters = pa.py_buffer(data.translate(None, b" "))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters])
        place = pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
        ends = np.cumsum([len(x) + 1 for x in spaced])
        return np.split(numbers[place], np.searchsorted(starts, ends[:-1])) if texts else []

    return find


def _groups(batches: Iterator[pa.Array]) -> Iterator[list[str | None]]:
    """The texts of all batches, in groups of a size to be worked on at once; no group is of two batches."""
    for batch in batches:
        group, held = [], 0
        for text in (x.as_py() for x in batch):
            group.append(text)
            held += len(text or "")
            if held > 600_000 or len(group) >= 2000:
                yield group
                group, held = [], 0
        if group:
            yield group


def _blocks(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Windows of two blocks (one, if there are no more words)."""
    return [ids[a : a + 2 * size] for a in range(0, max(len(ids) - size, 1), size)]


def frequencies(docs: DataFrame, terms: dict[bytes, int]) -> tuple[np.ndarray, int, int]:
    """Documents that hold each term, documents and words, over all of ``docs`` (``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums = np.zeros(len(known) + 2, dtype=np.int64)
        find = term_finder(known)
        for group in _groups(b.column(0) for b in batches):
            for ids in find(group):
                seen = np.zeros(len(known) + 1, dtype=bool)
                seen[ids] = True  # -1 falls on the last place
                sums[:-2] += seen[:-1]
                sums[-2:] += (1, len(ids))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["place", "n"])

    rows = docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n")).collect()
    total = np.zeros(len(terms) + 2, dtype=np.int64)
    for place, n in rows:  # as many as the benchmark has words
        total[place] = n
    return total[:-2], int(total[-2]), int(total[-1])


def _tf(rows: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, terms and weights of all occurrences of terms in the passages."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    known = ids >= 0
    return of[known], ids[known], idf[ids[known]]


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def _product(rows: list[np.ndarray], idf: np.ndarray, right: np.ndarray, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """For the passage matrix A (rows of unit length, times ``scale``): A.T @ (A @ right) and the Gram matrix of A @ right."""
    of, ids, weight = _tf(rows, idf)
    cells, inverse = np.unique(of * np.int64(len(idf)) + ids, return_inverse=True)
    value = np.bincount(inverse, weights=weight, minlength=len(cells))
    row, term = cells // len(idf), cells % len(idf)
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=len(rows)))
    value = scale * value / np.maximum(norm[row], 1e-12)
    out, gram = np.zeros_like(right), np.zeros((right.shape[1], right.shape[1]))
    step = max(16, min(512, 2**23 // max(len(idf), 1)))  # rows made dense at a time: 64 MB
    for a in range(0, len(rows), step):
        own = slice(*np.searchsorted(row, [a, a + step]))
        dense = np.zeros((step, len(idf)))
        dense[row[own] - a, term[own]] = value[own]
        image = dense @ right
        out += dense.T @ image
        gram += image.T @ image
    return out, gram


#: Words of a benchmark up to which a task adds up the moments in one dense matrix, and passages taken at a time.
_DENSE_TERMS = 2896
_PASSAGES = 8192
#: With more words, cells that a task holds at most before it adds up equal ones: 48 MB, some three times that while it does.
_CELLS = 3_000_000
#: Moments are added as whole numbers, so that sums do not depend on the order of tasks.
_UNIT = float(1 << 32)


def _pair_moments(rows: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (term * terms + term, the smaller term first) and values of A.T @ A for passages A, rows of unit length."""
    of, ids, weight = _tf(rows, idf)
    used = weight > 0
    cells, inverse = np.unique(of[used] * np.int64(len(idf)) + ids[used], return_inverse=True)
    value = np.bincount(inverse, weights=weight[used], minlength=len(cells))
    row, term = cells // len(idf), cells % len(idf)
    value = value / np.maximum(np.sqrt(np.bincount(row, weights=value**2, minlength=len(rows)))[row], 1e-12)
    at = np.arange(len(cells))
    after = np.searchsorted(row, row, "right") - at  # terms of the row from this one on
    left = np.repeat(at, after)
    right = left + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    return term[left] * len(idf) + term[right], value[left] * value[right]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, ascending, with the sum of its weights; each part is ascending."""
    cells, weights = (np.concatenate([part[k] for part in parts]) for k in range(2))
    order = np.argsort(cells, kind="stable")  # merges the parts
    cells = cells[order]
    starts = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[starts], np.add.reduceat(weights[order], starts)


def moment_rows(docs: DataFrame, terms: dict[bytes, int], idf: np.ndarray, settings: Settings) -> DataFrame:
    """``cell``, ``weight``: summands of the upper half of A.T @ A over all passages of ``docs`` (``text``), -1 their number.

    A task gives each cell once as long as it meets at most half of ``_CELLS`` different ones, else once for each such lot.
    """
    shared = docs.sparkSession.sparkContext.broadcast((terms, idf))
    block = settings.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = shared.value
        size = len(weights)
        dense = np.zeros(size * size) if size <= _DENSE_TERMS else None
        count, held = 0, []
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def whole(values: np.ndarray) -> np.ndarray:
            return np.rint(values * _UNIT).astype(np.int64)

        def out(cells: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(cells), 250_000):
                part = [pa.array(x[a : a + 250_000]) for x in (cells, sums)]
                yield pa.RecordBatch.from_arrays(part, names=["cell", "weight"])

        def added() -> Iterator[pa.RecordBatch]:
            cells, values = _pair_moments(held, weights)
            if dense is not None:
                np.add.at(dense, cells, values)
                return
            cells, inverse = np.unique(cells, return_inverse=True)
            parts.append((cells, whole(np.bincount(inverse, weights=values, minlength=len(cells)))))
            if sum(len(part) for part, _ in parts) > _CELLS:
                parts[:] = [_summed(parts)]
                if len(parts[0][0]) > _CELLS // 2:
                    yield from out(*parts.pop())

        find = term_finder(known)
        for group in _groups(b.column(0) for b in batches):
            for ids in find(group):
                held += _blocks(ids, block)
                if len(held) >= _PASSAGES:
                    count += len(held)
                    yield from added()
                    held = []
        if held:
            count += len(held)
            yield from added()
        if dense is not None:
            at = np.flatnonzero(dense)
            yield from out(at, whole(dense[at]))
        if parts:
            yield from out(*_summed(parts))
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([count], pa.int64())], names=["cell", "weight"])

    return docs.select("text").mapInArrow(run, "cell long, weight long")


def moments(docs: DataFrame, terms: dict[bytes, int], idf: np.ndarray, settings: Settings) -> tuple[DataFrame, int]:
    """The upper half of A.T @ A over all passages of ``docs`` (``text``), stored as ``cell``, ``weight``; and their number."""
    # A task gives up to all cells, so there are as many tasks as cores, each with many files.
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    rows = moment_rows(docs.select("text").coalesce(tasks), terms, idf, settings)
    stored = store(rows.groupBy("cell").agg(F.sum("weight").alias("weight")), "passage-moments")
    count = stored.where("cell = -1").first()
    return stored.where("cell >= 0"), count.weight if count else 0


def latent_space(docs: DataFrame, items: list[tuple[int, str]], settings: Settings) -> Space:
    """Fit the space on all passages. The driver holds matrices of (benchmark words x rank) only."""
    split = [(i, words_of(t)) for i, t in items]
    split = [(i, w) for i, w in split if w]
    terms = {w: k for k, w in enumerate(sorted({w for _, ws in split for w in ws}))}
    count, n_docs, n_words = frequencies(docs, terms)
    idf = np.log((n_docs + 1) / (count + 1)) + 0.1
    heavy = count > settings.common * n_docs
    spared = np.zeros(len(terms), dtype=bool)
    for _, words in split:
        ids = np.unique(_ids(words, terms))
        if (~heavy[ids]).sum() < settings.least_terms:
            spared[ids] = True
    idf[heavy & ~spared] = 0.0

    own_rows, owner = [], []
    for k, (_, words) in enumerate(split):
        ids = _ids(words, terms)
        own = [ids] if len(ids) <= 3 * settings.block else _blocks(ids, settings.block)
        own_rows += own
        owner += [k] * len(own)

    spark = docs.sparkSession
    width = min(settings.rank + 12, len(terms))
    cells, passage_count = moments(docs, terms, idf, settings) if terms else (None, 0)
    scale = np.sqrt(max(1.0, passage_count / max(len(own_rows), 1)))

    def multiply(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all passages A: A.T @ (A @ right) and the Gram matrix of A @ right."""
        sent = spark.sparkContext.broadcast(right)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by, out = sent.value, np.zeros_like(sent.value)
            for batch in batches:
                cell, weight = (batch.column(k).to_numpy() for k in range(2))
                one, two = cell // len(by), cell % len(by)
                off = one != two
                into, of = np.concatenate((one, two[off])), np.concatenate((two, one[off]))
                value = np.concatenate((weight, weight[off])) / _UNIT
                order = np.argsort(into, kind="stable")
                for a in range(0, len(order), 8192):
                    own = order[a : a + 8192]
                    starts = np.flatnonzero(np.diff(into[own], prepend=-1))
                    out[into[own][starts]] += np.add.reduceat(by[of[own]] * value[own, None], starts, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], names=["product"])

        out, gram = _product(own_rows, idf, right, scale=scale)
        corpus = np.zeros_like(out)
        for (more,) in cells.coalesce(8).mapInArrow(run, "product binary").toLocalIterator():  # 8 rows
            corpus = corpus + np.frombuffer(more).reshape(out.shape)
        sent.destroy()
        return out + corpus, gram + right.T @ corpus

    basis = np.linalg.qr(np.random.default_rng(settings.seed).standard_normal((len(terms), width)))[0] if terms else np.zeros((0, 0))
    for _ in range(settings.power if terms else 0):
        basis = np.linalg.qr(multiply(basis)[0])[0]
    if terms:
        _, turn = np.linalg.eigh(multiply(basis)[1])
        basis = basis @ turn[:, ::-1][:, : settings.rank]
    vectors = (idf[:, None] * basis).astype(np.float32)
    passages = np.zeros((len(own_rows), vectors.shape[1]), dtype=np.float32)
    for k, ids in enumerate(own_rows):
        passages[k] = vectors[ids].sum(axis=0)
    full = [
        Item(i, ws, masks(ws), [w for w in ws[-max(3, len(ws) // 4) :] if not heavy[terms[w]]]) for i, ws in split
    ]
    vectors = np.where((idf > 0)[:, None], vectors, 0)
    return Space({w: k if idf[k] > 0 else -1 for w, k in terms.items()}, vectors, _unit(passages), np.linalg.norm(passages, axis=1), np.array(owner, dtype=np.int64), full)


def near_windows(ids: list[np.ndarray], space: Space, settings: Settings) -> Iterator[tuple[int, int, int, float]]:
    """(text, item, window, cosine) of windows near a passage of the item."""
    block = settings.block
    counts = np.array([max(1, -(-len(x) // block)) for x in ids])
    firsts = np.cumsum(counts) - counts
    place = np.concatenate([f + np.arange(len(x)) // block for f, x in zip(firsts, ids, strict=True)])
    flat = np.concatenate(ids)
    known = np.flatnonzero(flat >= 0)
    sums = np.zeros((int(counts.sum()), space.vectors.shape[1]), dtype=np.float32)
    if not len(known):
        return
    at = place[known]
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    for a in range(0, len(starts), 4096):
        own = starts[a : a + 4096]
        end = starts[a + 4096] if a + 4096 < len(starts) else len(known)
        sums[at[own]] = np.add.reduceat(space.vectors[flat[known[own[0] : end]]], own - own[0], axis=0)
    last = np.zeros(len(sums), dtype=bool)
    last[firsts + counts - 1] = True
    windows = sums.copy()
    windows[:-1][~last[:-1]] += sums[1:][~last[:-1]]
    of = np.repeat(np.arange(len(ids)), counts)
    for a in range(0, len(windows), 8192):
        own = windows[a : a + 8192]
        along = own @ space.passages.T
        lengths = np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
        near = (along >= settings.cosine * lengths) & (along >= settings.coverage * space.lengths) & (along > 0)
        for row, passage in zip(*np.nonzero(near), strict=True):
            text = int(of[a + row])
            yield text, int(space.owner[passage]), int(a + row - firsts[text]), float(along[row, passage] / lengths[row, 0])


def verified(words: list[bytes], windows: list[tuple[int, float]], item: Item, settings: Settings) -> tuple | None:
    """(cosine, subsequence, answer found, first word, end) of the best stretch of near windows, if it is a match."""
    size, best = len(item.words), None
    windows = sorted(windows)
    stretches: list[list[int]] = []
    for w, _ in windows:
        if stretches and w <= stretches[-1][1] + 1:
            stretches[-1][1] = w
        else:
            stretches.append([w, w])
    for low, high in stretches:
        begin = max(0, low * settings.block - size)
        end = min(len(words), (high + 2) * settings.block + size)
        for a in range(begin, max(begin + 1, end - size), max(size, 1)):  # about two lengths at a time
            part = words[a : min(end, a + 2 * size + settings.block)]
            found = common_subsequence(item.masks, part, size)
            here = set(part)
            answer = sum(w in here for w in item.answer)
            answered = 2 * answer >= len(item.answer)
            if found >= settings.verbatim * size or (found >= settings.paraphrase * size and answered):
                row = (max(c for _, c in windows), found, answered, a, min(end, a + 2 * size + settings.block))
                best = row if best is None or row[1] > best[1] else best
    return best


_MATCH = (
    "struct<item_id:long,cosine:double,lcs:long,item_words:long,answer_found:boolean,first_word:long,end_word:long>"
)
_TYPE = pa.struct([
    ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.int64()), ("item_words", pa.int64()),
    ("answer_found", pa.bool_()), ("first_word", pa.int64()), ("end_word", pa.int64()),
])


def with_matches(
    df: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text", into: str = "matches",
    item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """Add ``into``: for each benchmark item that the text holds, the evidence (see ``_MATCH``), in the order of items.

    No row moves and none is dropped. The benchmark is the stated query set; it is searched in blocks of items, a scan for
    each ``item_bytes`` of text, and one block at a time is collected. Null or empty texts and items match nothing; equal
    items are reported each, repeated rows too; empty tables give no matches. Words are compared in lower case without
    punctuation. An existing column of the name ``into`` is replaced. A very long text is one list of words in its task,
    about 100 bytes for each.
    """
    small_batches(df)
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // settings.item_bytes))
    if blocks == 1:
        return _with_block(df, items, settings, text, into)
    block_of = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    out, parts = df.drop(into), [f"_{into}_{k}" for k in range(blocks)]
    for k, part in enumerate(parts):
        out = _with_block(out, items.where(block_of == k), settings, text, part)
    return out.withColumn(into, F.array_sort(F.concat(*parts))).drop(*parts)


def _with_block(df: DataFrame, items: DataFrame, settings: Settings, text: str, into: str) -> DataFrame:
    """``with_matches`` for items that the driver can hold."""
    spark = df.sparkSession
    items = [(r[0], r[1]) for r in items.orderBy("id", "text").collect()]
    texts_only = df.select(F.col(text).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(latent_space(texts_only, items, settings))

    def matches(texts: list[str | None], space: Space, ids: list[np.ndarray]) -> list[list[dict]]:
        near: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for k, item, window, cosine in near_windows(ids, space, settings):
            near.setdefault((k, item), []).append((window, cosine))
        rows: list[list[dict]] = [[] for _ in texts]
        words = {k: words_of(texts[k]) for k in {k for k, _ in near}}
        for k, number in sorted(near):
            item = space.items[number]
            if found := verified(words[k], near[k, number], item, settings):
                cosine, lcs, answered, first, end = found
                rows[k].append({
                    "item_id": item.item_id, "cosine": cosine, "lcs": lcs, "item_words": len(item.words),
                    "answer_found": answered, "first_word": first, "end_word": end,
                })
        return rows

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        space = shared.value
        find = term_finder(space.terms)
        for batch in batches:
            rows = []
            for group in _groups(iter([batch])):
                rows += matches(group, space, find(group)) if space.items else [[] for _ in group]
            yield pa.array(rows, type=pa.list_(_TYPE))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # as objects: Spark reads them
    return df.withColumn(into, F.arrow_udf(run, f"array<{_MATCH}>")(F.col(text).cast("string")))
