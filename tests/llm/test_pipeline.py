import re

import corpus_pipeline
import zstandard
from tests.llm.helpers import awkward
from tests.llm.test_quality import brute as brute_quality

from ledgerline.llm import decontaminate, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
        sizes.append(docs.count())
        if name != "shards":
            assert docs.columns == columns
    raw, good, unique, clean, mixed, placed = kept
    assert all(r["q"]["kept"] for r in quality.with_quality(good, into="q").collect())
    ids = lambda d: {r[0] for r in d.select("doc_id").collect()}
    assert ids(unique) <= ids(good) and unique.count() == len(ids(unique))
    texts = [r["text"] for r in unique.collect()]
    assert len(texts) == len(set(texts))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    gone = {r["doc_id"] for r in decontaminate.with_matches(unique, benchmark).where("size(matches) > 0").collect()}
    assert gone and ids(clean) == ids(unique) - gone
    assert ids(mixed) <= ids(clean)
    repeats = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert max(repeats) <= 3
    assert sorted(r[0] for r in placed.select("doc_id").collect()) == sorted(r[0] for r in mixed.select("doc_id").collect())
    assert corpus_pipeline.run(spark, SF).count() == placed.count()


def test_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def plain_kept(text):
    """The quality verdict of a text, in plain Python: base rules, whole ratio by length, ratios of 2 kB chunks."""
    base, data = brute_quality(text), (text or "").encode()
    if base[-1] or not data:
        return False
    bands, packer = quality.Bands(), zstandard.ZstdCompressor(level=quality.Bands().level)
    ratio = len(data) / len(packer.compress(data))
    top, low, high = next(b for b in bands.whole if len(data) <= b[0])
    chunks = [data[a : a + bands.chunk_bytes] for a in range(0, len(data) - bands.chunk_bytes + 1, bands.chunk_bytes)]
    bad = [c for c in chunks if not bands.chunk[0] <= len(c) / len(packer.compress(c)) <= bands.chunk[1]]
    return low <= ratio <= high and len(bad) <= bands.bad_share * len(chunks)


def plain_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k], row[k + 1])
    return row[-1]


def test_stages_against_plain_python(spark):
    """Quality, near-duplicates and leaks against versions that share no code with the operators."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = stages["quality_rules"](spark, docs, SF)
    found = {r[0] for r in good.select("doc_id").collect()}
    assert found == {i for i, t in rows.items() if plain_kept(t)}

    sets = {}
    for i in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in rows[i]))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and root[a] != root[b] and 100 * (both := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    unique = stages["near_duplicates"](spark, good, SF)
    kept = {r[0] for r in unique.select("doc_id").collect()}
    assert kept == {i for i in root if root[i] == i}

    items = [plain_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in stages["benchmark_leaks"](spark, unique, SF).select("doc_id").collect()}
    for i in kept:
        words = plain_words(rows[i])
        best = 0.0
        for item in filter(None, items):
            if len(set(item) & set(words)) >= 0.8 * len(set(item)):
                for s in range(0, max(1, len(words) - len(item) // 2), max(1, len(item) // 2)):
                    best = max(best, plain_lcs(item, words[s : s + 2 * len(item)]) / len(item))
        assert (i not in clean) == (best >= 0.8), (i, best)
