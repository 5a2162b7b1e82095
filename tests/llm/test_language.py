import itertools

import numpy as np
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", language.held_out("doc_id"))
    model = language.fit(docs.where("not held"), "text", "lang", "doc_id")
    rows = language.with_language(docs.where("held"), model, spans=False).select("lang", "language.*").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_spans_of_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs, "text", "lang", "doc_id")
    by = {r["lang"]: r["text"] for r in docs.where("length(text) between 400 and 900").collect()}
    text = by["de"] + "\n" + by["en"]
    row = language.with_language(spark.createDataFrame([(text,)], "text string"), model).first()["language"]
    assert {s["lang"] for s in row["spans"]} == {"de", "en"} and len(row["spans"]) <= 4
    edge = next(s["start"] for s in row["spans"] if s["lang"] == "en")
    assert abs(edge - len(by["de"])) < 120


def test_awkward_rows(spark):
    model = language.fit(documents(spark), "text", "lang", "doc_id")
    rows = language.with_language(awkward(spark), model).collect()
    for r in rows:
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["lang_pred"] == "und") == none
        assert len(r["language"]["spans"]) == 0 if none else True
    assert language.with_language(empty(spark), model).count() == 0
    blank = language.fit(empty(spark), "text", "lang", "doc_id")
    assert {r["language"]["lang_pred"] for r in language.with_language(awkward(spark), blank).collect()} == {"und"}


def test_unknown_script(spark):
    model = language.fit(documents(spark), "text", "lang", "doc_id")
    texts = ["Съешь ещё этих", "Съешь the of and with", "\U00030010\U00030011", "12 -- \u00b2", "ªº"]
    rows = language.with_language(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    found = [(r["language"]["lang_pred"], r["language"]["score"]) for r in rows]
    assert found[0] == found[2] == (model.languages[model.usual], 0.0) and found[1][0] == "en" and found[3] == ("und", 0.0)
    assert found[4][0] in model.languages
    assert [s["lang"] for s in rows[0]["language"]["spans"]] == [model.languages[model.usual]]


def test_one_language_alone(spark):
    model = language.fit(documents(spark).where("lang = 'en'"), "text", "lang", "doc_id")
    rows = language.with_language(documents(spark), model).collect()
    assert {(r["language"]["lang_pred"], r["language"]["score"]) for r in rows if any(c.isalpha() for c in r["text"] or "")} == {("en", 1.0)}


def plain_result(text, model, switch=8.0, cap=6.0):
    """Language and share of letters, character by character in plain Python."""
    script_of = lambda c: next((s for a, b, s in language.SCRIPTS if a <= ord(c) <= b), 0)
    cell = lambda key, g: ((key * 0x9E3779B97F4A7C15) % 2**64 >> 48) + g * language.CELLS
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    words = low.split(" ")
    rows, sizes = [], []
    for word in filter(None, words):
        codes = [0, *map(ord, word)]
        total = np.zeros(len(model.languages))
        for k in range(1, len(codes)):
            c, p, q = codes[k], codes[k - 1], codes[k - 2] if k > 1 else 0
            total += model.table[cell(c, 0)] + model.table[cell(c + (p << 18) + (1 << 60), 1)]
            if p:
                total += model.table[cell(c + (p << 18) + (q << 36) + (1 << 61), 2)]
        last, before = codes[-1], codes[-2]  # the edge behind the word
        total += model.table[cell((last << 18) + (1 << 60), 1)] + model.table[cell((last << 18) + (before << 36) + (1 << 61), 2)]
        total = np.maximum(total - total.max(), -cap)
        usable = model.allowed[script_of(word[0])]
        rows.append(np.where(usable, total, -4 * cap) if usable.any() else total * 0)
        sizes.append(len(word))
    state, paths = rows[0].copy(), []
    for row in rows[1:]:
        top = int(state.argmax())
        come = [k if state[k] >= state[top] - switch else top for k in range(len(state))]
        state = np.array([max(state[k], state[top] - switch) for k in range(len(state))]) + row
        paths.append(come)
    at = int(state.argmax())
    labels = [at]
    for come in reversed(paths):
        at = come[at]
        labels.append(at)
    share = np.bincount(labels[::-1], weights=sizes, minlength=len(state))
    return model.languages[int(share.argmax())], share.max() / share.sum()


def test_scores_against_plain_python(spark):
    model = language.fit(documents(spark), "text", "lang", "doc_id")
    rows = language.with_language(documents(spark).where("length(text) < 3000"), model, spans=False).collect()
    checked = 0
    for r in rows:
        if any(c.isalpha() for c in r["text"] or ""):
            name, score = plain_result(r["text"], model)
            assert r["language"]["lang_pred"] == name and abs(r["language"]["score"] - score) < 1e-3
            checked += 1
    assert checked > 50


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(5)
    lengths = [0, 1, 4, 6, 3]
    scores = draw.normal(size=(sum(lengths), 3)) * 3
    ends = np.cumsum(lengths)
    found = language.viterbi(scores, ends, 2.0)
    for end, n in zip(ends, lengths, strict=True):
        own = scores[end - n : end]
        value = lambda p: sum(own[k, x] for k, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731,B023
        if n:
            assert np.isclose(value(found[end - n : end]), max(map(value, itertools.product(range(3), repeat=n))))
