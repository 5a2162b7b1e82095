import random
import re

import pyarrow as pa
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import decontaminate

SF = "/root/testdata/sf0.001"


def matches(df, benchmark):
    return {(r["doc_id"], m["item_id"]) for r in decontaminate.with_matches(df, benchmark).collect() for m in r["matches"]}


def brute(df, benchmark):
    """All windows of all documents against all items, by common subsequence alone."""
    items = [(r["item_id"], decontaminate.words_of(r["text"])) for r in benchmark.collect()]
    found = set()
    for r in df.collect():
        words = decontaminate.words_of(r["text"])
        for i, item in items:
            if item:
                masks = decontaminate.masks(item)
                starts = range(0, max(1, len(words) - len(item) // 2), max(1, len(item) // 2))
                if any(decontaminate.common_subsequence(masks, words[s : s + 2 * len(item)], len(item)) >= 0.8 * len(item) for s in starts):
                    found.add((r["doc_id"], i))
    return found


def test_same_as_brute_force(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = documents(spark)
    expected = brute(docs, benchmark)
    assert expected and matches(docs, benchmark) == expected


def test_paraphrases(spark):
    random.seed(8)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = [r["text"].split() for r in documents(spark).where("length(text) > 800").limit(30).collect()]
    filler = sorted({w for words in clean for w in words})
    rows, planted = [], set()
    for r in benchmark.collect():
        words = [w.upper() if random.random() < 0.1 else w for w in r["text"].split() if random.random() > 0.1]
        words = [w if random.random() > 0.1 else random.choice(filler) for w in words]
        host = random.choice(clean)
        at = random.randrange(len(host))
        rows.append((r["item_id"], " ".join([*host[:at], *words, *host[at:]])))
        planted.add((r["item_id"], r["item_id"]))
    found = matches(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    assert len(planted & found) >= 0.95 * len(planted)


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame([(1, "same text twice in the table"), (1, "same text twice in the table"), (2, None), (None, ""), (3, "word soup")],
                                      "item_id long, text string")
    df = awkward(spark)
    rows = decontaminate.with_matches(df, benchmark, into="m").collect()
    assert len(rows) == df.count() and set(rows[0].asDict()) == {*df.columns, "m"}
    found = {(r["doc_id"], m["item_id"]) for r in rows for m in r["m"]}
    assert {(5, 1), (6, 1), (4, 3)} <= found and not {i for i, _ in found} & {1, 2, 3, 7, None}
    assert decontaminate.with_matches(empty(spark), benchmark).count() == 0
    none = decontaminate.with_matches(df, benchmark.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["matches"] for r in none)


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b):
                last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k], row[k + 1])
        return row[-1]

    random.seed(2)
    for _ in range(200):
        a, b = ([random.choice([b"a", b"b", b"c", b"d"]) for _ in range(random.randrange(1, 90))] for _ in range(2))
        assert decontaminate.common_subsequence(decontaminate.masks(a), b, len(a)) == plain(a, b)


def plain_words(text):
    return re.findall("[0-9a-z\\x80-\U0010ffff]+", (text or "").lower())


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k], row[k + 1])
    return row[-1]


def test_answer_decides_weaker_matches(spark):
    """An item with 65 percent of its words in order counts if its answer is there, and not if it isn't."""
    words = [f"term{k}x" for k in range(40)]
    filler = " ".join(f"other{k}" for k in range(60))
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    with_answer = [w for k, w in enumerate(words) if k >= 30 or k % 2 == 0]  # 15 + 10 of 40
    without = [w for k, w in enumerate(words) if k < 26]  # 26 of 40, none of the last ten
    texts = [with_answer, without, words, words[:18]]
    for t, expected in zip(texts, (True, False, True, False), strict=True):
        share = plain_lcs(words, t) / len(words)
        held = len(set(words[-10:]) & set(t))
        assert expected == (share >= 0.8 or (share >= 0.55 and 2 * held >= 10))
    others = [(100 + k, f"{filler} note{k}") for k in range(60)]  # so that the item's words are rare
    df = spark.createDataFrame([(k, f"{filler} {' '.join(t)} {filler}") for k, t in enumerate(texts)] + others, "doc_id long, text string")
    rows = {r["doc_id"]: r["matches"] for r in decontaminate.with_matches(df, benchmark).collect()}
    assert [bool(rows[k]) for k in range(4)] == [True, False, True, False]
    for k in (0, 2):
        assert rows[k][0]["lcs"] == plain_lcs(words, plain_words(" ".join(texts[k])))


def test_blocks_of_items(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = documents(spark)
    small = decontaminate.Settings(item_bytes=2000)
    rows = decontaminate.with_matches(docs, benchmark, small).collect()
    assert {(r["doc_id"], m["item_id"]) for r in rows for m in r["matches"]} == matches(docs, benchmark)
    assert set(rows[0].asDict()) == {*docs.columns, "matches"}


def test_copies_do_not_fill_the_sample(spark):
    """A text held by most rows is drawn once."""
    base = documents(spark).select("doc_id", "text")
    copies = base.limit(1).crossJoin(spark.range(2000)).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert matches(base.unionByName(copies), benchmark) == matches(base, benchmark)


def test_very_long_texts(spark):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = benchmark.orderBy("item_id").first()
    long = " ".join(f"v{i}" for i in range(400_000))
    df = spark.createDataFrame([(1, f"{long} {item['text']} {long}"), (2, "soup " * 1_000_000)], "doc_id long, text string")
    assert matches(df, benchmark) == {(1, item["item_id"])}


def test_space_is_fitted_on_every_passage(spark):
    """Each passage of 25,000 texts has length one, so the squares add up to their number; a rare text at the end counts too."""
    import numpy as np

    terms = {b"alpha": 0, b"beta": 1, b"gamma": 2}
    rare = spark.createDataFrame([("gamma beta gamma",)], "text string")
    texts = spark.range(25_000).selectExpr("concat('alpha other', id % 7, ' beta beta') AS text").unionByName(rare)
    cells, count = decontaminate.moments(texts, terms, np.ones(3), decontaminate.Settings())
    found = {r["cell"]: r["weight"] / 2**32 for r in cells.collect()}
    assert count == 25_001 and abs(found[0] + found[4] + found[8] - 25_001) < 1e-3
    assert abs(found[0] - 5000) < 1e-3 and abs(found[1] - 10_000) < 1e-3
    assert abs(found[5] - 0.4) < 1e-6 and abs(found[8] - 0.8) < 1e-6


def test_a_task_gives_each_moment_once(spark, monkeypatch):
    """Beyond the words of a dense matrix, passages that come in several lots are added up in the task; sums are as in one."""
    import numpy as np

    terms = {f"w{k}".encode(): k for k in range(decontaminate._DENSE_TERMS + 1)}
    idf = 1 + np.arange(len(terms)) % 7 / 7
    texts = spark.range(0, 3 * decontaminate._PASSAGES, 1, 1).selectExpr("concat('w', id % 90, ' other w', id % 35, ' w2000') AS text")
    rows = [(r["cell"], r["weight"]) for r in decontaminate.moment_rows(texts, terms, idf, decontaminate.Settings()).collect()]
    assert len(rows) == len({cell for cell, _ in rows})
    cells, count = decontaminate.moments(texts, terms, idf, decontaminate.Settings())
    assert dict(rows) == {-1: count} | {r["cell"]: r["weight"] for r in cells.collect()} and count == 3 * decontaminate._PASSAGES
    norm = [decontaminate._tf([decontaminate._ids(f"w{k % 90} w{k % 35} w2000".encode().split(), terms)], idf) for k in range(630)]
    weights = [np.bincount(ids, weights=weight, minlength=len(terms)) for _, ids, weight in norm]
    one = np.array([w[[0, 5, 2000]] / np.linalg.norm(w) for w in weights])[np.arange(count) % 630]
    found = {cell: weight / 2**32 for cell, weight in rows}
    for (a, i), (b, j) in [((0, 0), (0, 0)), ((0, 0), (5, 1)), ((5, 1), (2000, 2)), ((2000, 2), (2000, 2))]:
        assert abs(found.get(a * len(terms) + b, 0) - (one[:, i] * one[:, j]).sum()) < 1e-3

    monkeypatch.setattr(decontaminate, "_CELLS", 300)  # the task gives what it holds several times
    lots = decontaminate.moment_rows(texts, terms, idf, decontaminate.Settings())
    assert lots.count() > len(rows) and dict(lots.groupBy("cell").sum("weight").collect()) == dict(rows)

    parts = [(np.array([1, 4, 9]), np.array([1, 2, 3])), (np.array([4, 9]), np.array([2**53, 1])), (np.zeros(0, int), np.zeros(0, int))]
    assert [x.tolist() for x in decontaminate._summed(parts)] == [[1, 4, 9], [1, 2**53 + 2, 4]]
    assert [x.tolist() for x in decontaminate._summed(parts[2:])] == [[], []]


def test_terms_are_found_without_an_object_per_word():
    """The numbers are those of the words one by one, whatever the texts; and no word becomes an object."""
    texts = ["The cat, the CAT!", None, "", " \t", "ΑΣ Σίσυφος ΣΑΣ.", "İstanbul É é ß \x00 a\x00b x1", "no terms", "cat", "ΟΔΟΣ", "\U0001f600 cat"]
    picked = sorted({w for t in texts for w in decontaminate.words_of(t)} - {b"no", b"x1"})
    terms = {w: -1 if w == b"the" else k for k, w in enumerate(picked)}
    for group in (texts, texts[::-1], [None], [""], ["cat"], []):
        found = decontaminate.term_finder(terms)(group)
        assert [f.tolist() for f in found] == [decontaminate._ids(decontaminate.words_of(t), terms).tolist() for t in group]
    assert [f.tolist() for f in decontaminate.term_finder({})(["a b", None])] == [[-1, -1], []]


def test_words_are_made_only_where_an_item_may_be(monkeypatch):
    """Scans for frequencies and moments, and the search of texts without a near window, don't split texts into words."""
    split = []
    monkeypatch.setattr(decontaminate, "words_of", lambda text, of=decontaminate.words_of: split.append(text) or of(text))
    item = "which river flows through the old town and reaches the northern sea by the great harbour"
    batch = pa.RecordBatch.from_pydict({"text": ["unrelated lines of other things"] * 50})
    terms = {w: k for k, w in enumerate(sorted(set(decontaminate.words_of(item))))}
    split.clear()
    found = [f for group in decontaminate._groups([batch.column(0)]) for f in decontaminate.term_finder(terms)(group)]
    assert len(found) == 50 and not split
