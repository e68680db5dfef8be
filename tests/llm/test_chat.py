"""Chat formatting: exact round trips, loss masks and layouts."""

import hashlib
import json
import random

from streambed.llm import chat

BITS = ["\\", "### ", "</turn>", "###", "#", "Assistant:", ": ", ":", "\n", "é", "a", "<", "/turn>", "\\### ", ""]


def test_round_trip_of_hostile_texts():
    rng = random.Random(1)
    for _ in range(5000):
        turns = [("".join(rng.choices(BITS, k=rng.randint(0, 3))) if rng.random() < 0.4 else "assistant", "".join(rng.choices(BITS, k=rng.randint(0, 7)))) for _ in range(rng.randint(0, 4))]
        text, spans = chat.format_turns(turns)
        assert chat.read_turns(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2])] == [t for r, t in turns if r == "assistant"]


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_query_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a: b"]), rng.choice([None, "", "hi \\ </turn>", "é ### x\n"]), "extra") for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "x", "e"), (None, 0, "assistant", "y", "e"), (50, None, "user", "first", "e"), (50, 3, "user", "b", "e"), (50, 3, "user", "a", "e"), (50, 3, "user", "a", "e")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.chat_digest(frame).collect()}
    want = {-7: expected([("user", chat.EXTRA[1]["prompt"]), ("assistant", chat.EXTRA[1]["response"])])}
    for conv in {r[0] for r in rows}:
        said = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        want[conv] = expected([(r[2] or "", r[3] or "") for r in said])
    assert got == want
    assert [r.conv_id for r in chat.chat_digest(frame.limit(0)).collect()] == [-7]


def test_layouts_reach_the_same_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "meta": {"k": 1}},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"prompt": "q", "response": "a", "id": 3}, {"instruction": "q", "input": "", "output": "a"},
        {"other": 1}, "not json",
    ]
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    got = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string")).collect()
    for i in range(5):
        assert [(r.role, r.text) for r in got if r.conv_id == i] == [("user", "q"), ("assistant", "a")]
    assert [(r.layout, r.text) for r in got if r.conv_id > 4] == [(None, None)] * 2
    assert len({r.fingerprint for r in got}) == 7
