import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import queries, runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words, least=24, periods=3):
    """All maximal stretches at every lag; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def as_tuples(row):
    return [tuple(r) for r in row]


def check(frame):
    rows = runs.with_runs(frame).collect()
    assert len(rows) == frame.count()
    for r in rows:
        words = words_of(r["text"])
        expected = brute(words)
        assert as_tuples(r["periodic"]["runs"]) == expected
        assert r["periodic"]["collapsed"] == collapsed(words, expected)


def test_awkward_rows(spark):
    check(awkward(spark).where("doc_id is null or doc_id <> 4"))  # the long one has its own expectation
    long = runs.with_runs(awkward(spark).where("doc_id = 4")).first()
    assert as_tuples(long["periodic"]["runs"]) == [(0, 12000, 3)] and long["periodic"]["collapsed"] == "word soup number"
    assert runs.with_runs(empty(spark)).count() == 0
    again = runs.with_runs(awkward(spark).withColumn("periodic", F.lit(1)))
    assert again.columns == awkward(spark).columns + ["periodic"]


def test_generated_texts(spark):
    pick = random.Random(5)
    texts = []
    for _ in range(250):
        words = []
        for _ in range(pick.randint(1, 5)):
            block = [pick.choice("abcd") for _ in range(pick.choice([1, 2, 3, 5, 8, 9, 12, 13, 14, 20, 33, 50]))]
            size = int(len(block) * pick.choice([1, 2.5, 3, 3.2, 7, 7.9]))
            words += [block[i % len(block)] for i in range(size)]
            words += [pick.choice("abcdefgh") for _ in range(pick.randint(0, 9))]
        texts.append(" ".join(words) + pick.choice(["", " ", "\n\t"]))
    # Strings rich in repeats: Fibonacci, Thue-Morse, and a period of two nearly equal halves.
    a, b = "a", "ab"
    for _ in range(12):
        a, b = b, b + a
    texts += [" ".join(b), " ".join(str(bin(i).count("1") % 2) for i in range(1500))]
    half = [str(i) for i in range(30)]
    texts += [" ".join((half + half[:-1] + ["x"]) * 4), " ".join(half * 2 * 4), " ".join(["z"] * 23), " ".join(["z"] * 24)]
    check(spark.createDataFrame(enumerate(texts), "doc_id long, text string"))


def test_documents_with_planted_runs(spark):
    found = {r["doc_id"]: r for r in queries.QUERIES["op13_run_detection"](spark, "/root/testdata/sf0.001").collect()}
    rows = documents(spark).collect()
    assert len(found) == len(rows) and any(r["n_runs"] for r in found.values())
    for d in rows:
        words = words_of(d["text"])
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        expected = quick(words)
        ours = found[d["doc_id"]]
        assert ours["n_runs"] == len(expected)
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in expected)
        assert ours["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert ours["collapsed_sha256"] == hashlib.sha256(collapsed(words, expected).encode()).hexdigest()
        best = min(expected, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (ours["start"], ours["length"], ours["period"]) == (best or (None, None, None))
        assert ours["exponent_milli"] == (best and 1000 * best[1] // best[2])


def quick(words):
    """As ``brute``, with numpy over each lag."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    found = {}
    for q in range(1, len(ids) // 3 + 1):
        same = np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0]))
        begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for i, j in zip(begin.tolist(), end.tolist(), strict=True):
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_very_long_texts(spark):
    block = " ".join(f"w{i}" for i in range(60_000))
    distinct = " ".join(f"v{i}" for i in range(500_000))  # about 4 MB
    rows = runs.with_runs(spark.createDataFrame([(1, " ".join([block] * 4)), (2, distinct), (3, "na " * 1_000_000)], "doc_id long, text string"))
    found = {r["doc_id"]: as_tuples(r["periodic"]["runs"]) for r in rows.select("doc_id", "periodic.runs").selectExpr("doc_id", "struct(runs) as periodic").collect()}
    assert found == {1: [(0, 240_000, 60_000)], 2: [], 3: [(0, 1_000_000, 1)]}
