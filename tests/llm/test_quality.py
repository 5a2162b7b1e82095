import os
import random
import re

import zstandard
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for k in range(len(words) - 4):
        places.setdefault(tuple(words[k : k + 5]), []).append(k)
    covered = {p for ks in places.values() if len(ks) > 1 for k in ks for p in range(k, k + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def results(df):
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    return [(r["text"], tuple(r["quality"][f] for f in fields), r["quality"]) for r in quality.with_quality(df).collect()]


def test_same_as_brute_force(spark):
    for frame in (documents(spark), awkward(spark)):
        found = results(frame)
        assert len(found) == frame.count()
        for text, ours, q in found:
            assert ours == brute(text)
            if text:
                assert abs(q["ratio"] - len(text.encode()) / len(zstandard.ZstdCompressor(level=3).compress(text.encode()))) < 1e-9
            assert not (q["base_failed"] and q["kept"])


def test_no_rows(spark):
    assert results(empty(spark)) == []


def test_bands(spark):
    random.seed(3)
    noise = " ".join(os.urandom(6).hex() for _ in range(2000))
    hexed = "".join(chr(0x21 + random.randrange(90)) for _ in range(30000))
    prose = " ".join("".join(random.choice("etaoinshrdlu") for _ in range(random.randrange(2, 9))) for _ in range(3000))
    numbered = "\n".join(f"line {k} of the same long report about nothing at all {k * 7}" for k in range(3000))
    rows = [(1, prose), (2, " ".join(hexed[k : k + 9] for k in range(0, 30000, 9))), (3, numbered), (4, noise)]
    verdict = {
        r["doc_id"]: r["quality"]["verdict"]
        for r in quality.with_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert verdict[1] == "ok" and verdict[2] == "incompressible" and verdict[3] in ("repetitive", "base")


def test_clean_rows_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels, "doc_id")
    rows = quality.with_quality(docs, into="q").where("not q.base_failed").select("q.kept").collect()
    assert sum(r["kept"] for r in rows) == len(rows) > 100
