import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import collocations
from ledgerline.llm.collocations import HatTrie, Mining


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least=30, inside=80, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.setdefault(lang or "und", Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= inside * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def ours(df, mining):
    return sorted(tuple(r) for r in collocations.collocations(df, mining=mining).collect())


def test_trie_against_a_counter():
    pick = random.Random(1)
    trie, expected, spilled = HatTrie(entries=200, burst=8), Counter(), Counter()
    bits = collocations._WORD_BITS

    def take(everything):
        for heads, rests, counts in trie.spill(everything):
            spilled.update({(h, r): 0 for h, r in zip(heads.tolist(), rests.tolist())})
            for h, r, c in zip(heads.tolist(), rests.tolist(), counts.tolist(), strict=True):
                spilled[h, r] += c

    for _ in range(4000):
        head, rest = pick.randint(1, 12), pick.randint(1, 6) | pick.randint(0, 5) << bits
        if pick.random() < 0.2:
            trie.add_words([head], [2])
            expected[head, 0] += 2
        else:
            trie.add(head, [rest, rest, rest + 1], [1, 2, 1])
            expected[head, rest] += 3
            expected[head, rest + 1] += 1
        if trie.full():
            take(False)
            assert trie.held <= 100
    assert any(isinstance(c, list) for c in trie.children.values())
    take(True)
    assert spilled == expected and trie.held == 0 and not trie.children


def test_same_as_brute_force(spark):
    pick = random.Random(2)
    rows = []
    for _ in range(300):
        words = [pick.choice(["a", "B", "c", "the", "of", "é", "New York", "x.y", "end!", "q\n"]) for _ in range(pick.randint(0, 30))]
        rows.append((" ".join(words), pick.choice(["en", "fr", None])))
    rows += [("One two three four five. one TWO three", "en")] * 40 + [(None, "en"), ("", None), ("\t \n", "de")]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    # A trie of 50 phrases spills all the time; a filter of 64 bits lets nearly everything through, one of 2**10 much.
    for mining in (Mining(), Mining(entries=50, burst=3), Mining(filter_bits=6), Mining(filter_bits=10, top=7), Mining(least=5, inside=50)):
        assert ours(frame, mining) == brute(rows, mining.least, mining.inside, mining.top)


def test_phrases_leave_a_task_once():
    """Runs of a task are merged before they leave it: a trie that is full at every chunk does not repeat its phrases."""
    pick = random.Random(3)
    texts = [" ".join(pick.choice("abcdefgh") for _ in range(40)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 1000, "text": texts})
    expected = Counter()
    for text in texts:
        words = text.split()
        expected.update(" ".join(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    everything = np.full(1, 2**64 - 1, np.uint64)
    for kept in (2_000_000, 6000):  # 6000: more than are distinct after a merge, then fewer than half are free
        rows = Counter()
        found = Counter()
        for run in collocations._Counter(Mining(entries=50, burst=3, kept=kept, filter_bits=6), everything).runs([batch]):
            for row in run.to_pylist():
                if row["size"]:
                    rows[row["phrase"]] += 1
                    found[row["phrase"]] += row["f"]
        assert found == expected
        assert kept == 6000 or set(rows.values()) == {1}


def test_longer_parts_need_their_shorter_ones():
    """What the filter lets through by chance alone is not counted if a word in it was not let through."""
    counter = collocations._Counter(Mining(), np.zeros(1, np.uint64))
    langs, texts = pa.array(["en"]), pa.array(["a b c d"])
    words = collocations.Words(texts, collocations._BLANKS | collocations._BREAKS, lower=True)
    hashes = collocations._hashes(words.hashes(), np.repeat(collocations._text_hashes(["en"]), 4))
    single = set(hashes[0].tolist())
    counter._open = lambda h: np.array([x not in single for x in h.tolist()], bool)
    assert [r["size"] for b in [*counter._texts(langs, texts), *counter._spilled(everything=True)] for r in b.to_pylist()] == [0]


def test_documents(spark):
    frame = documents(spark)
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    found = ours(frame, Mining(least=8))
    assert found == brute(rows, 8) and len(found) > 50


def test_awkward_rows(spark):
    frame = awkward(spark).withColumns({"phrase": F.lit("x"), "f": F.lit(1), "a": F.lit(2), "k": F.lit(3)})
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    assert ours(frame, Mining()) == brute(rows) and ours(frame, Mining(least=2)) == brute(rows, 2)
    assert ours(empty(spark), Mining()) == []


def test_very_long_texts(spark):
    distinct = " ".join(f"w{i}" for i in range(600_000))
    repeated = "tick tock goes it " * 400_000  # over a chunk of words: phrases across its end are counted
    found = ours(spark.createDataFrame([(distinct, "a"), (repeated, "b")], "text string, lang string"), Mining())
    n = 400_000
    assert {r[0] for r in found} == {"b"}
    assert {(r[2], r[3]) for r in found} == {("tick tock goes it", n), ("tock goes it tick", n - 1), ("goes it tick tock", n - 1), ("it tick tock goes", n - 1)}


def test_counts_past_64_bits(spark):
    """The arithmetic of scores on counts near 2**62."""
    row = spark.sql(
        "SELECT (2000000 * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS s "
        "FROM VALUES (4611686018427387904, 4611686018427387905, 9223372036854775807) t(a, l, r)"
    ).first()
    assert row["s"] == 2000000 * 4611686018427387904 // (4611686018427387905 + 9223372036854775807)
