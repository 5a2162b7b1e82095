"""Every operator and stage on texts of some megabytes: one of distinct words, one that repeats itself."""

import base64
import hashlib
import zlib

import corpus_pipeline
import pytest
from tests.llm.helpers import documents

from ledgerline.llm import language, mixing, quality, sharding, simhash, suffixes, warc

DISTINCT = " ".join(f"v{i}" for i in range(400_000))
REPEATED = "soup " * 600_000
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long(spark):
    rows = [(1, DISTINCT, "en", "a"), (2, REPEATED, "en", "a"), (3, "a short text beside them", "en", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(long):
    found = by_id(quality.with_quality(long).select("doc_id", "quality.*"))
    assert (found[1]["n_words"], found[1]["n_repeat_words"]) == (400_000, 0)
    assert (found[2]["n_words"], found[2]["n_repeat_words"], found[2]["kept"]) == (600_000, 600_000, False)
    assert found[1]["n_chunks"] == len(DISTINCT) // 2048


def test_sharding(long):
    found = by_id(sharding.shard(long, 2))
    assert [found[k]["size"] for k in (1, 2)] == [len(DISTINCT) + 8, len(REPEATED) + 8]
    assert found[1]["text_crc32"] == zlib.crc32(DISTINCT.encode())


def test_suffixes(long):
    found = by_id(suffixes.remove_repeats(long))
    assert found[1]["n_removed"] == 0 and found[1]["kept_sha256"] == hashlib.sha256(DISTINCT.encode()).hexdigest()
    # Every string of 100 bytes that starts from the sixth byte on also starts five bytes earlier.
    assert (found[2]["n_removed"], found[2]["n_spans"]) == (len(REPEATED) - 5, 1)


def test_simhash(long):
    rows = simhash.near_duplicates(long).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, rows)) == [(1, 1), (2, 2), (3, 3)]


def test_mixing(long):
    found = by_id(mixing.with_repeats(long).select("doc_id", "mix.*"))
    assert [found[k]["size"] for k in (1, 2, 3)] == [400_000, 600_000, 5]


def test_warc(spark, long):
    pages = long.selectExpr("doc_id AS page_id", "'http://x' AS url", "text AS html")
    back = warc.read_archives(spark, warc.write_archives(pages), with_payload=False).where("kind = 'record'").collect()
    found = {int(r["record_id"]): (r["payload_bytes"], r["payload_digest"]) for r in back}
    assert found[1] == (len(DISTINCT), base64.b32encode(hashlib.sha1(DISTINCT.encode()).digest()).decode())
    assert found[2][0] == len(REPEATED)


def test_language(spark, long):
    model = language.fit(documents(spark), "text", "lang", "doc_id")
    found = by_id(language.with_language(long, model).select("doc_id", "language.lang_pred"))
    assert all(found[k]["lang_pred"] in model.languages for k in (1, 2, 3))


def test_stages(spark, long):
    kept = {name: [r[0] for r in stage(spark, long, SF).select("doc_id").collect()] for name, stage in corpus_pipeline.STAGES}
    assert 2 not in kept["quality_rules"]  # it repeats itself
    for name in ("near_duplicates", "benchmark_leaks", "shards"):
        assert sorted(kept[name]) == [1, 2, 3]
    assert 0 < len(kept["source_mixture"]) <= 9
