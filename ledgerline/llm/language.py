"""Language identification of mixed text.

The script of a word (from ranges of code points) narrows the languages to those that were seen to use it. Words get a
score per language from character 1- to 3-grams, hashed to a fixed number of cells; Viterbi over the words of a text with
a penalty for each switch then labels spans, and the language with most letters is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import store

#: First and last code point of common scripts (fixed values); letters outside are script 0.
SCRIPTS = (
    (0x41, 0x24F, 1), (0x1E00, 0x1EFF, 1), (0x370, 0x3FF, 2), (0x1F00, 0x1FFF, 2), (0x400, 0x52F, 3), (0x530, 0x58F, 4),
    (0x590, 0x5FF, 5), (0x600, 0x6FF, 6), (0x750, 0x77F, 6), (0x900, 0x97F, 7), (0x980, 0x9FF, 8), (0xA00, 0xA7F, 9),
    (0xA80, 0xAFF, 10), (0xB80, 0xBFF, 11), (0xC00, 0xC7F, 12), (0xC80, 0xCFF, 13), (0xD00, 0xD7F, 14), (0xE00, 0xE7F, 15),
    (0x10A0, 0x10FF, 16), (0x1100, 0x11FF, 17), (0xAC00, 0xD7AF, 17), (0x3040, 0x30FF, 18), (0x3400, 0x4DBF, 19),
    (0x4E00, 0x9FFF, 19),
)
N_SCRIPTS = 20
#: Cells per n-gram length.
CELLS = 1 << 16
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``fit_rows``: labelled texts per language that the model is fitted on, drawn by a hash of the id.

    ``smoothing`` is added to each count. ``switch`` is the cost, in nats, of a change of language between two words;
    scores of a word are capped at ``word_cap`` nats, so one odd word can't force a change. ``least_share``: a language
    uses a script that has at least this share of its letters.
    """

    fit_rows: int = 3000
    smoothing: float = 0.5
    switch: float = 8.0
    word_cap: float = 6.0
    least_share: float = 0.01


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (3 * CELLS, languages): log odds
    allowed: np.ndarray  # (N_SCRIPTS, languages)
    usual: int = 0  # the language with most letters in the fit


def letter_table() -> tuple[np.ndarray, np.ndarray]:
    """For each code point below 0x40000 whether it is a letter, and its script; no plane behind has letters."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x40000)), dtype=bool, count=0x40000)
    scripts = np.zeros(0x40000, dtype=np.uint8)
    for first, last, script in SCRIPTS:
        scripts[first : last + 1] = script
    return letters, scripts


def code_points(text: str, letters: np.ndarray) -> np.ndarray:
    """Lower-case letters of the text; everything else, and both ends, is 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    padded = np.zeros(len(codes) + 2, dtype=np.uint32)
    inside = np.where(codes < len(letters), codes, 0)
    padded[1:-1] = np.where(letters[inside], inside, 0)
    return padded


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (3, n) of the 1-, 2- and 3-grams that end at each place, and whether they belong to a word (edges do)."""
    c = codes.astype(np.uint64)
    p, q = np.zeros_like(c), np.zeros_like(c)
    p[1:], q[2:] = c[:-1], c[:-2]
    mix = np.uint64(0x9E3779B97F4A7C15)
    keys = np.stack([c, c + (p << np.uint64(18)) + np.uint64(1 << 60), c + (p << np.uint64(18)) + (q << np.uint64(36)) + np.uint64(1 << 61)])
    cells = ((keys * mix) >> np.uint64(48)).astype(np.int64) + np.arange(3, dtype=np.int64)[:, None] * CELLS
    valid = np.stack([c > 0, (c > 0) | (p > 0), p > 0])
    return cells, valid


def fit(labelled: DataFrame, text: str, label: str, id_column: str, settings: Settings = Settings()) -> Model:
    """Fit on at most about ``fit_rows`` texts per language. Counts are summed by Spark; the driver gets one row per language.

    Rows with a null text or label are not used; an empty table gives a model without languages.
    """
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text"), F.col(id_column).cast("string").alias("id")
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return Model([], np.zeros((3 * CELLS, 0), dtype=np.float32), np.zeros((N_SCRIPTS, 0), dtype=bool))
    rates = F.create_map(*[F.lit(v) for k in names for v in (k, min(1.0, settings.fit_rows / counts[k]))])
    unit = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 20)) / float(1 << 20)
    # Drawn by all tasks and stored: only then is the sample small enough for a few.
    drawn = store(known.where(unit < F.element_at(rates, F.col("label"))).select("label", "text"), "labelled-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, scripts = letter_table()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch["label"], batch["text"], strict=True):
                codes = code_points(text, letters)
                cells, valid = grams(codes)
                total = sums.setdefault(name, np.zeros(3 * CELLS + N_SCRIPTS, dtype=np.int64))
                total[: 3 * CELLS] += np.bincount(cells[valid], minlength=3 * CELLS)
                total[3 * CELLS :] += np.bincount(scripts[codes[codes > 0]], minlength=N_SCRIPTS)
        if sums:
            yield pd.DataFrame({"label": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    def add(pieces: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in pieces["counts"])
        return pd.DataFrame({"label": pieces["label"][:1], "counts": [total.tobytes()]})

    partial = drawn.repartition(16).mapInPandas(count, "label string, counts binary")
    found = {r["label"]: np.frombuffer(r["counts"], dtype=np.int64) for r in partial.groupBy("label").applyInPandas(add, "label string, counts binary").collect()}
    names = [n for n in names if n in found]
    table = np.zeros((3 * CELLS, len(names)), dtype=np.float64)
    allowed = np.zeros((N_SCRIPTS, len(names)), dtype=bool)
    letters = np.zeros(len(names), dtype=np.int64)
    for k, name in enumerate(names):
        for g in range(3):
            part = found[name][g * CELLS : (g + 1) * CELLS] + settings.smoothing
            table[g * CELLS : (g + 1) * CELLS, k] = np.log(part / part.sum())
        seen = found[name][3 * CELLS :]
        allowed[:, k] = seen >= max(1, settings.least_share * seen.sum())
        letters[k] = seen.sum()
    table -= table.mean(axis=1, keepdims=True)
    return Model(names, (table / 3).astype(np.float32), allowed, int(letters.argmax()) if names else 0)


def word_scores(codes: np.ndarray, model: Model, scripts: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Starts and letter counts of the words, a score for each word and language, whether any word's script is in use."""
    is_letter = codes > 0
    starts = np.flatnonzero(is_letter[1:] & ~is_letter[:-1]) + 1
    if not len(starts):
        return starts, starts, np.zeros((0, len(model.languages)), dtype=np.float32), False
    lengths = np.add.reduceat(is_letter.astype(np.int64), starts)
    scores = np.zeros((len(starts), len(model.languages)), dtype=np.float32)
    size = 1 << 18
    cells, valid = grams(codes)
    for k, language in enumerate(model.languages):
        column = model.table[:, k]
        each = np.zeros(len(codes), dtype=np.float32)
        for a in range(0, len(codes), size):
            each[a : a + size] = np.where(valid[:, a : a + size], column[cells[:, a : a + size]], 0).sum(axis=0)
        scores[:, k] = np.add.reduceat(each, starts)
    scores -= scores.max(axis=1, keepdims=True)
    np.maximum(scores, -cap, out=scores)
    usable = model.allowed[scripts[codes[starts]]]
    some = usable.any(axis=1)
    scores[some[:, None] & ~usable] = -4 * cap
    scores[~some] = 0
    return starts, lengths, scores, bool(some.any())


def viterbi(scores: np.ndarray, ends: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word. Texts lie one after the other and end at ``ends``; all step forward together."""
    begins = np.concatenate([[0], ends[:-1]])
    counts = ends - begins
    order = np.argsort(-counts, kind="stable")
    begins, counts = begins[order], counts[order]
    label = np.zeros(len(scores), dtype=np.int32)
    if not len(scores):
        return label
    active = np.searchsorted(-counts, -np.arange(int(counts[0])), "left")  # texts longer than t words
    best = np.zeros(len(scores), dtype=np.int32)  # where a switch into this word comes from
    stay = np.zeros(scores.shape, dtype=bool)
    state = scores[begins[: active[0]]].astype(np.float64)
    for t in range(1, len(active)):
        n = active[t]
        at = begins[:n] + t
        held = state[:n]
        top = held.argmax(axis=1)
        jump = held[np.arange(n), top] - switch
        best[at] = top
        kept = held >= jump[:, None]
        stay[at] = kept
        state[:n] = np.where(kept, held, jump[:, None]) + scores[at]
    now = state.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        label[at] = now[:n]
        if t:
            rows = np.arange(n)
            now[:n] = np.where(stay[at, now[:n]], now[:n], best[at])
    return label


_OUT = "lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>"
_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def with_language(
    df: DataFrame, model: Model, text: str = "text", into: str = "language", settings: Settings = Settings(), spans: bool = True
) -> DataFrame:
    """Add the struct ``into``: ``lang_pred``, ``score`` (its share of the letters) and ``spans`` in code points of the lower-case text.

    Texts that are null, empty or without a letter are ``und`` with score 0 and no spans; so are all texts if the model
    knows no language. Ties go to the language first in order. Words of a script that no language uses score alike for
    all and follow their neighbours; a text of such words alone gets the language that most letters were learned from,
    with score 0 and one span. No row moves; an existing column of that name is replaced. With ``spans`` off that field
    is null. An empty table gives an empty one. A very long text takes about 100 bytes for each letter in its task.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # 0.8 MB for each language

    def label(texts: list[str | None], letters: np.ndarray, scripts: np.ndarray) -> list[tuple]:
        known = shared.value
        if not known.languages:
            return [(UNKNOWN, 0.0, [] if spans else None)] * len(texts)
        words = [word_scores(code_points(t or "", letters), known, scripts, settings.word_cap) for t in texts]
        ends = np.cumsum([len(w[0]) for w in words])
        path = viterbi(np.concatenate([w[2] for w in words]), ends, settings.switch)
        out = []
        for (starts, lengths, _, usable), end in zip(words, ends, strict=True):
            own = path[end - len(starts) : end]
            if not len(own):
                out.append((UNKNOWN, 0.0, [] if spans else None))
                continue
            if not usable:
                own = np.full(len(own), known.usual)
            share = np.bincount(own, weights=lengths, minlength=len(known.languages))
            top = int(share.argmax())
            found = None
            if spans:
                first = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
                last = np.concatenate([first[1:], [len(own)]]) - 1
                found = [
                    {"lang": known.languages[own[a]], "start": int(starts[a]) - 1, "end": int(starts[b] + lengths[b]) - 1}
                    for a, b in zip(first, last, strict=True)
                ]
            out.append((known.languages[top], float(share[top] / share.sum()) if usable else 0.0, found))
        return out

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters, scripts = letter_table()
        for batch in batches:
            rows, group, held = [], [], 0
            for t in (x.as_py() for x in batch):
                group.append(t)
                held += len(t or "")
                if held > 4_000_000 or len(group) >= 2000:
                    rows += label(group, letters, scripts)
                    group, held = [], 0
            if group:
                rows += label(group, letters, scripts)
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.list_(_SPAN))],
                names=["lang_pred", "score", "spans"],
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # as objects: Spark reads them
    return df.withColumn(into, F.arrow_udf(run, _OUT)(F.col(text).cast("string")))


def held_out(id_column: str) -> Column:
    """The fold that is kept from fitting: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
