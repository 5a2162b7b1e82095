"""Phrases whose words keep together, counted by tries of hash containers in the tasks and merged as sorted runs.

A task counts in a trie over word numbers: the root has a child for each first word, a child begins as a hash container
of the rest of its phrases and bursts, when it grows too large, into containers by the second word; deeper it does not
go. When the trie holds too many phrases, whole subtrees, the largest first, leave it as sorted runs. The task keeps
these as arrays and merges them, so that a phrase leaves it once for each ``kept`` phrases and not for each chunk of text.
Spark deals what leaves by its prefix, the first two words, and merges it in order.

As a phrase can only be frequent if all its words, pairs and triples of words are, all of these are counted first, by
hashes alone: a hash found too seldom belongs to no frequent triple. The others make a filter of a fixed size, and only
phrases that it lets through are counted by their words. It may let an infrequent one through, which costs work, and never
stops a frequent one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import Words, byte_set, ranks, small_batches, store
from ledgerline.operators.joins import spread_join

#: Longest phrase; the packing of phrases into 64 bits and the levels of counting rest on it.
LONGEST = 4
_BLANKS = byte_set([0x20, 0x09])
_BREAKS = byte_set([*b".,;:!?", *range(0x0A, 0x0E)])
_WORD_BITS = 21
_RUNS = "part int, lang string, size int, phrase string, f bigint"
#: Words of a batch that are worked on at once, and words that a task numbers before it begins anew.
_CHUNK = 1 << 18
_VOCABULARY = 1 << 19


@dataclass(frozen=True)
class Mining:
    """``least``: occurrences of a candidate. ``inside`` percent: a phrase whose words lie in a longer one that is so
    often found goes. ``top``: phrases returned for each language. ``entries``: phrases a task's trie holds before it spills;
    ``burst``: phrases of a container before it bursts; ``kept``: phrases of spilled runs that a task keeps to merge, 24
    bytes each; ``filter_bits``: size of the filter, 8 MB at 26, 40 at most."""

    least: int = 30
    inside: int = 80
    top: int = 2000
    entries: int = 250_000
    burst: int = 4096
    kept: int = 2_000_000
    filter_bits: int = 26


class HatTrie:
    """Counts of phrases, given as numbers of words below 2**21.

    ``children`` of the root belong to one language and first word. A container is a dict from the packed rest of a
    phrase to its count; a burst child is a list of one dict, from the second word to such containers. Phrases of one word
    end at the root, in ``ends``.
    """

    def __init__(self, entries: int, burst: int):
        self.entries, self.burst = entries, burst
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, dict[int, int] | list[dict[int, dict[int, int]]]] = {}
        self.sizes: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.held = 0

    def add_words(self, heads: list[int], counts: list[int]) -> None:
        for head, count in zip(heads, counts, strict=True):
            self.ends[head] = self.ends.get(head, 0) + count

    def add(self, head: int, rests: list[int], counts: list[int]) -> None:
        """Count phrases of one first word; ``rests`` are packed, the second word lowest."""
        child = self.children.get(head)
        if child is None:
            child = self.children[head] = {}
        before = self.sizes.get(head, 0)
        if isinstance(child, dict):
            for rest, count in zip(rests, counts, strict=True):
                child[rest] = child.get(rest, 0) + count
            size = len(child)
            if size > self.burst:
                self.children[head] = [_by_second(child)]
        else:
            inner, size = child[0], before
            for rest, count in zip(rests, counts, strict=True):
                box = inner.setdefault(rest & _MASK, {})
                if rest in box:
                    box[rest] += count
                else:
                    box[rest] = count
                    size += 1
        self.sizes[head] = size
        self.held += size - before

    def full(self) -> bool:
        return self.held + len(self.ends) > self.entries

    def spill(self, everything: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Take subtrees out, the largest first, until half of the room is free: heads, rests and counts."""
        if self.ends:
            heads = np.fromiter(self.ends.keys(), np.int64, len(self.ends))
            yield heads, np.zeros(len(heads), np.int64), np.fromiter(self.ends.values(), np.int64, len(heads))
            self.ends = {}
        heads, rests, counts = [], [], []
        for head in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if not everything and self.held <= self.entries // 2:
                break
            child = self.children.pop(head)
            size = self.sizes.pop(head)
            self.held -= size
            heads.append(np.full(size, head, np.int64))
            for box in [child] if isinstance(child, dict) else child[0].values():
                rests.append(np.fromiter(box.keys(), np.int64, len(box)))
                counts.append(np.fromiter(box.values(), np.int64, len(box)))
        if heads:
            yield np.concatenate(heads), np.concatenate(rests), np.concatenate(counts)


_MASK = (1 << _WORD_BITS) - 1


def _by_second(container: dict[int, int]) -> dict[int, dict[int, int]]:
    inner: dict[int, dict[int, int]] = {}
    for rest, count in container.items():
        inner.setdefault(rest & _MASK, {})[rest] = count
    return inner


class _Vocabulary:
    """Numbers from 1 for the words of a task, and their hashes. It is emptied with the trie when it is full."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = [b""]
        self.hashes: list[int] = [0]

    def room_for(self, words: list[bytes]) -> bool:
        room = _VOCABULARY - len(self.words)
        return len(words) <= room or sum(w not in self.number for w in words) <= room

    def numbers(self, words: list[bytes], hashes: list[int]) -> np.ndarray:
        number, spelled, hashed = self.number, self.words, self.hashes
        out = []
        for word, h in zip(words, hashes, strict=True):
            n = number.get(word)
            if n is None:
                n = number[word] = len(spelled)
                spelled.append(word)
                hashed.append(h)
            out.append(n)
        return np.array(out, np.int64)


def _text_hashes(texts: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in texts), np.uint64, len(texts))


def _joined(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    h = hashes * np.uint64(0x9E3779B97F4A7C15) + word
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _packed(columns: list[np.ndarray], head: np.ndarray) -> np.ndarray:
    """One integer for each row of numbers; rows are equal exactly if their integers are."""
    key, room = head, int(head.max(initial=0)) + 1
    for column in columns:
        width = int(column.max(initial=0)) + 1
        if room * width >= 2**62:
            key = ranks(key)
            room = int(key.max(initial=0)) + 1
        key, room = key * width + column, room * width
    return key


#: Bits of a hash that are counted; the others of a 64-bit integer hold the count.
_HASH_BITS = 40
_COUNT_BITS = 64 - _HASH_BITS
_HELD = 1_000_000


class _HashCounter:
    """Counts hashes of words, pairs and triples of words, each with its language; a row is a hash and its count in one integer."""

    def __init__(self):
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 250) for a in range(0, batch.num_rows, 250)):
                words = Words(part.column("text"), _BLANKS | _BREAKS, lower=True)
                piece, lang = _pieces(words), _text_hashes(part.column("lang").to_pylist())
                found = _hashes(words.hashes(), np.repeat(lang, np.diff(words.first)))
                found = [h[piece[size:] == piece[: len(h)]] if size else h for size, h in enumerate(found)]
                for a in range(0, len(found[0]), _CHUNK):
                    self._add(np.concatenate([h[a : a + _CHUNK] for h in found]))
                    if len(self.hashes) > _HELD:
                        yield from self._spilled()
        yield from self._spilled()

    def _add(self, hashes: np.ndarray) -> None:
        found, counts = np.unique(hashes >> np.uint64(_COUNT_BITS), return_counts=True)
        self.hashes, inverse = np.unique(np.concatenate((self.hashes, found)), return_inverse=True)
        self.counts = np.bincount(inverse, np.concatenate((self.counts, counts)), len(self.hashes)).astype(np.int64)

    def _spilled(self) -> Iterator[pa.RecordBatch]:
        most = (1 << _COUNT_BITS) - 1
        while len(self.hashes):
            packed = self.hashes << np.uint64(_COUNT_BITS) | np.minimum(self.counts, most).astype(np.uint64)
            for a in range(0, len(packed), 250_000):
                yield pa.RecordBatch.from_arrays([pa.array(packed[a : a + 250_000].view(np.int64))], names=["packed"])
            left = self.counts > most
            self.hashes, self.counts = self.hashes[left], self.counts[left] - most


def _pieces(words: Words) -> np.ndarray:
    """A number for the piece of each word: no separator and no end of a text lies within one."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    return np.searchsorted(np.flatnonzero(_BREAKS[words.data]), words.starts) + text


#: Words of the longest parts that the filter knows.
_PARTS = 3


def _hashes(of_word: np.ndarray, of_lang: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word, pair and triple of neighbours, with their language."""
    out = [_joined(of_lang, of_word)]
    for size in range(1, _PARTS):
        out.append(_joined(out[-1][:-1], of_word[size:]))
    return out


def _merged(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads, rests and counts of all runs, sorted, each phrase once."""
    heads, rests, counts = (np.concatenate([r[k] for r in runs] or [np.zeros(0, np.int64)]) for k in range(3))
    order = np.lexsort((rests, heads))
    heads, rests, counts = heads[order], rests[order], counts[order]
    first = np.ones(len(heads), bool)
    first[1:] = (heads[1:] != heads[:-1]) | (rests[1:] != rests[:-1])
    starts = np.flatnonzero(first)
    return heads[starts], rests[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class _Counter:
    """Counts the phrases of 1 to 4 words that a filter lets through, in Arrow batches of ``lang`` and ``text``."""

    def __init__(self, mining: Mining, gate: np.ndarray):
        self.gate, self.mining = gate, mining
        self.trie, self.vocabulary = HatTrie(mining.entries, mining.burst), _Vocabulary()
        self.langs: dict[str, int] = {}
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.kept_rows = 0

    def runs(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 250) for a in range(0, batch.num_rows, 250)):
                yield from self._texts(part.column("lang"), part.column("text"))
        yield from self._spilled(everything=True)

    def _texts(self, langs: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts, _BLANKS | _BREAKS, lower=True)
        counts = np.diff(words.first)
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs.to_pylist()], np.int64)
        used, inverse = np.unique(lang, return_inverse=True)  # the size 0 counts all words of a language
        totals = np.bincount(inverse, counts, len(used)).astype(np.int64) if len(used) else []
        yield self._batch(np.zeros(len(used), np.int32), used, 0, pa.array([""] * len(used)), totals)
        if not len(words):
            return
        piece, lang_of, hashes = _pieces(words), np.repeat(lang, counts), words.hashes()
        parts = [self._open(h) for h in _hashes(hashes, _text_hashes(self._lang_names())[lang_of])]
        for shorter, longer in zip(parts, parts[1:]):  # the words of a part, and its pairs, must pass as well
            longer &= shorter[:-1] & shorter[1:]
        for at in range(0, len(words), _CHUNK):
            last = min(at + _CHUNK + LONGEST - 1, len(words))
            count = min(_CHUNK, len(words) - at)
            begins = [(size, self._begins(size, piece[at:last], [p[at:last] for p in parts], count)) for size in range(1, LONGEST + 1)]
            needed = np.zeros(last - at, bool)
            for size, place in begins:
                for k in range(size):
                    needed[place + k] = True
            needed = np.flatnonzero(needed)
            spelled = words.spelled(at + needed).dictionary_encode()
            code = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            distinct = spelled.dictionary.to_pylist()
            if not self.vocabulary.room_for(distinct):
                yield from self._spilled(everything=True)
                self.vocabulary.clear()
            hash_of = np.zeros(len(distinct), np.uint64)
            hash_of[code] = hashes[at + needed]
            numbers = self.vocabulary.numbers(distinct, hash_of.tolist())
            codes = np.zeros(last - at, np.int64)
            codes[needed] = code
            for size, place in begins:
                self._count(size, place, codes, numbers, lang_of[at:last])
            if self.trie.full():
                yield from self._spilled()

    def _begins(self, size: int, piece: np.ndarray, parts: list[np.ndarray], count: int) -> np.ndarray:
        """Where, among the first ``count`` places, a phrase of a size lies in one piece, all its longest parts let through."""
        reach = max(min(count, len(piece) - size + 1), 0)
        allowed = piece[size - 1 : size - 1 + reach] == piece[:reach]
        longest = min(size, _PARTS)
        for k in range(size - longest + 1):
            allowed &= parts[longest - 1][k : k + reach]
        return np.flatnonzero(allowed)

    def _count(self, size: int, place: np.ndarray, codes: np.ndarray, numbers: np.ndarray, lang: np.ndarray) -> None:
        if len(place):
            columns = [codes[place + k] for k in range(size)]
            _, one, counts = np.unique(_packed(columns, lang[place]), return_index=True, return_counts=True)
            self._add(lang[place[one]], [numbers[c[one]] for c in columns], counts)

    def _open(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes the filter lets through."""
        bit = hashes >> np.uint64(64 - self.mining.filter_bits)
        return (self.gate[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

    def _lang_names(self) -> list[str]:
        return sorted(self.langs, key=self.langs.get)

    def _add(self, lang: np.ndarray, words: list[np.ndarray], counts: np.ndarray) -> None:
        head = lang << _WORD_BITS | words[0]
        if len(words) == 1:
            self.trie.add_words(head.tolist(), counts.tolist())
            return
        rest = np.zeros(len(head), np.int64)
        for k, word in enumerate(words[1:]):
            rest |= word << (k * _WORD_BITS)
        order = np.argsort(head, kind="stable")
        head = head[order]
        cuts = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        rests, counted, heads = rest[order].tolist(), counts[order].tolist(), head[cuts].tolist()
        for h, a, b in zip(heads, cuts.tolist(), [*cuts[1:].tolist(), len(rests)], strict=True):
            self.trie.add(h, rests[a:b], counted[a:b])

    def _spilled(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Subtrees leave the trie for the kept runs; these leave the task when there are too many of them, merged."""
        for run in self.trie.spill(everything):
            self.kept.append(run)
            self.kept_rows += len(run[0])
        if not everything and self.kept_rows <= self.mining.kept:
            return
        merged = _merged(self.kept)
        self.kept, self.kept_rows = [merged], len(merged[0])
        if everything or self.kept_rows > self.mining.kept // 2:
            self.kept, self.kept_rows = [], 0
            yield from self._rows(*merged)

    def _rows(self, heads: np.ndarray, rests: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Runs sorted by part, language and phrase."""
        spelled = pa.array(self.vocabulary.words, pa.large_binary())
        hashes, of_lang = np.array(self.vocabulary.hashes, np.uint64), _text_hashes(self._lang_names())
        numbers = [heads & _MASK] + [rests >> (k * _WORD_BITS) & _MASK for k in range(LONGEST - 1)]
        size = sum((n > 0).astype(np.int64) for n in numbers)
        for s in np.unique(size):
            of_size = np.flatnonzero(size == s)
            for a in range(0, len(of_size), 100_000):
                at = of_size[a : a + 100_000]
                lang = heads[at] >> _WORD_BITS
                # The part is told by the prefix: the first word, or the first two.
                prefix = of_lang[lang]
                for n in numbers[: min(s, 2)]:
                    prefix = _joined(prefix, hashes[n[at]])
                part = (prefix >> np.uint64(33)).astype(np.int32)
                yield self._batch(part, lang, int(s), _text([spelled.take(pa.array(n[at])) for n in numbers[:s]]), counts[at])

    def _batch(self, part: np.ndarray, lang: np.ndarray, size: int, phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        names = pa.array(self._lang_names(), pa.string()).take(pa.array(lang, pa.int64()))
        rows = pa.RecordBatch.from_arrays(
            [pa.array(part), names, pa.array([size] * len(names), pa.int32()), phrase.cast(pa.string()), pa.array(counts, pa.int64())],
            names=["part", "lang", "size", "phrase", "f"],
        )
        return rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("part", "lang", "phrase")]))


def _text(words: list[pa.Array]) -> pa.Array:
    texts = [w.cast(pa.large_string()) for w in words]
    return pc.binary_join_element_wise(*texts, pa.scalar(" ", pa.large_string()))


def _filter(texts: DataFrame, mining: Mining):
    """The hashes of words, pairs and triples found often enough as a bitmap, broadcast: 2**filter_bits bits, however many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _HashCounter().rows(batches)

    def often_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hashes whose counts, which lie one after the other, add up to enough."""
        last, held = None, 0
        for batch in batches:
            packed = batch.column(0).to_numpy().view(np.uint64)
            if not len(packed):
                continue
            hashes, counts = packed >> np.uint64(_COUNT_BITS), (packed & np.uint64((1 << _COUNT_BITS) - 1)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            hashes, counts = hashes[starts], np.add.reduceat(counts, starts)
            if last is not None and last == hashes[0]:
                counts[0] += held
            elif last is not None and held >= mining.least:
                yield pa.RecordBatch.from_arrays([pa.array([int(last)], pa.int64())], names=["h"])
            last, held = hashes[-1], int(counts[-1])  # it may go on in the next batch
            enough = hashes[:-1][counts[:-1] >= mining.least]
            yield pa.RecordBatch.from_arrays([pa.array(enough.view(np.int64))], names=["h"])
        if last is not None and held >= mining.least:
            yield pa.RecordBatch.from_arrays([pa.array([int(last)], pa.int64())], names=["h"])

    rest = _HASH_BITS - mining.filter_bits
    # Sorted and added up in passing: a hash table would hold every hash of a partition.
    dealt = texts.mapInArrow(run, "packed bigint").repartition(F.shiftrightunsigned("packed", _COUNT_BITS)).sortWithinPartitions("packed")
    often = dealt.mapInArrow(often_found, "h bigint")
    bit = F.shiftrightunsigned("h", rest)
    mask = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {rest}) & 63 AS INT))")
    often = often.select(F.shiftrightunsigned(bit, 6).alias("place"), mask.alias("mask"))
    held = often.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(1 << max(mining.filter_bits - 6, 0), np.uint64)
    bitmap[held.column("place").to_numpy()] = held.column("mask").to_numpy().view(np.uint64)
    return texts.sparkSession.sparkContext.broadcast(bitmap)


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def count_phrases(df: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``f``: occurrences within pieces of every phrase of 1 to 4 words found ``least`` times,
    and under size 0, with an empty phrase, the number of all words of each language.

    The text is read twice: for the filter and for the phrases. What is found is a stored table.
    """
    small_batches(df)
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    gate = _filter(texts, mining)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Counter(mining, gate.value).runs(batches)

    key = ["part", "lang", "size", "phrase"]
    # Each task gives up to all frequent phrases, so there are as many tasks as cores, each with many files.
    few = texts.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    runs = few.mapInArrow(run, _RUNS).repartition("part").sortWithinPartitions(*key)
    merged = runs.groupBy(*key).agg(F.sum("f").alias("f"))
    return store(merged.where((F.col("f") >= mining.least) | (F.col("size") == 0)).drop("part"), "phrases")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A text is lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and those into words at blanks. A
    candidate is a phrase of 2 to 4 words found a >= ``least`` times. Its score is floor(2000000 * a / (l + r)) for the cut
    into two parts (found l and r times) with the lowest score, of equals the first. Candidates whose words lie in a longer
    one, candidate itself, that is found at least ``inside`` percent as often go. ``n`` counts all words of the language.
    All arithmetic is on decimals. A null text has no words, a null lang is ``und``, repeated rows count each time; an
    empty table, or one without candidates, gives no rows. Other columns are not looked at. A very long text is
    worked on in chunks of 2**18 words; a task holds its batch, ``entries`` and ``kept`` phrases and 2**19 words.
    """
    counted = count_phrases(df, text, lang, mining)
    found = counted.where("size > 0").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    candidates = counted.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = candidates.select("lang", "phrase", "a", "words", "size", cut.alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    with_l = spread_join(cuts, found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    with_r = spread_join(with_l, found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"], sized_by=cuts)
    score = F.expr("(2000000 * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = with_r.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best")
    )

    # Every run of fewer words inside a candidate, with the most often found candidate around it.
    size, at = F.explode(F.sequence(F.lit(2), F.col("size") - 1)), F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1))
    parts = candidates.where("size > 2").select("lang", "a", "words", "size", size.alias("part")).select("lang", "a", "words", "part", at.alias("at"))
    around = parts.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("part")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    free = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * mining.inside)
    )

    # The best of each task's rows first, so that the ranking of a language sees ``top`` rows of each.
    order = [F.col("best.score").desc(), F.col("a").desc(), F.col("phrase")]
    slice_ = Window.partitionBy("lang", "_slice").orderBy(*order)
    few = free.withColumn("_slice", F.spark_partition_id()).withColumn("_place", F.row_number().over(slice_))
    ranked = few.where(F.col("_place") <= mining.top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ).where(F.col("rank") <= mining.top)
    totals = counted.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )
