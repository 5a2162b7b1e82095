import hashlib

import pytest

from ledgerline.llm import chat

TEXTS = [
    "\\### Assistant: </turn> ok", "", "plain", "<turn><turn>", ":### Role: \\", "\\\\</turn>\\", "é😀 ### User:\n", "#" * 9 + " Assistant: ",
    "a" * 3000, "word " * 30000,
]


@pytest.fixture(scope="module")
def codec():
    return chat.Codec(chat.load_ranks(), chat.Template())


def test_escape_round_trip():
    pattern = chat.escape_pattern(chat.Template())
    for text in TEXTS:
        escaped = chat.escape(text, pattern)
        assert chat.unescape(escaped) == text
        for control in chat.Template().reserved:
            at = escaped.find(control)
            while at >= 0:  # never without a backslash that is not itself escaped
                before = escaped[:at]
                assert (len(before) - len(before.rstrip("\\"))) % 2 == 1
                at = escaped.find(control, at + 1)


@pytest.mark.parametrize("role", ["user", "assistant", "", "critic :### </turn>", "é"])
def test_turn_round_trip(codec, role):
    for text in TEXTS:
        ids, mask = codec.encode(role, text)
        found, said, under, chars = codec.decode(ids, mask)
        assert (found, said, under) == (role, text, text if role == "assistant" else "")
        assert chars == len(codec.text(ids.tolist())) and set(mask.tolist()) <= {0, 1}
        reserved = [i for i in ids.tolist() if i in codec.strings]
        assert reserved[0] == codec.ids["<turn>"] and reserved[-1] == codec.ids["</turn>"] and len(reserved) in (3, 4)


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, 0, None, None), (None, 0, "user", "x"), (3, 1, "user", "t"), (3, 1, "user", "t"),
            (3, None, "system", "first"),
            (3, 1, "user", "other at the same place"), (3, 1, "user", "é"), (3, 1, "user", "Zebra"), (3, 1, "user", ""), *[(9, k, "assistant" if k % 2 else "user", f"turn {k} </turn>") for k in range(500)]]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, ids string, position string")
    expected = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())):
        expected.setdefault(conv, []).append((role or "", text or ""))
    placed = chat.format_conversations(df)
    found = {r["conv_id"]: r for r in chat.read_back(placed).collect()}
    assert set(found) == set(expected)
    for conv, turns in expected.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert found[conv]["n_turns"] == len(turns) and found[conv]["loss_chars"] == len(said)
        assert found[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert found[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    nine = sorted((r["position"], r["token_start"], len(r["ids"])) for r in placed.collect() if r["conv_id"] == 9)
    assert [p for p, _, _ in nine] == list(range(500))
    assert all(a[1] + a[2] == b[1] for a, b in zip(nine, nine[1:], strict=False))
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_very_long_turn(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_conversations(df)).first()
    assert row["loss_chars"] == len(long) and row["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
