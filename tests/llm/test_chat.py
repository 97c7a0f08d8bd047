import hashlib

from cartloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, targets string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "be\\kind <|im_end|>"), (1, 1, "user", "hi <| <\\| \\"), (1, 2, "assistant", "<|im_start|>assistant\nno"), (1, 3, "user", "é😀"),
    (1, 4, "assistant", None), (1, 5, "assistant", "last\\"), (2, 0, "user", ""), (3, 0, "assistant", "x" * 30000), (None, 1, "user", "a"), (None, 1, "user", "a"),
    (4, None, None, "no number"), (4, 1, "us%er\n<|", "odd role"), (5, 0, "user", "<"), (5, 1, "assistant", "|>"), (5, 1, "assistant", "|>"),
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark):
    rows = {r["conv_id"]: r for r in chat.report(table(spark, ROWS)).collect()}
    groups = {}
    for conv, turn, role, text in ROWS:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(rows) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        row, loss = rows[conv], "".join(t[3] for t in turns if t[2] == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == digest("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), digest(loss))


def test_examples_are_prefixes_with_one_trained_reply(spark):
    formatted = chat.format_conversations(table(spark, ROWS[:6]))
    whole = formatted.first()["formatted"]
    found = chat.examples(formatted).orderBy("turn").collect()
    assert [r["turn"] for r in found] == [2, 4, 5]
    for r in found:
        assert whole.startswith(r["text"]) and r["loss_end"] == len(r["text"])
        assert r["text"][: r["loss_start"]].endswith("<|im_start|>assistant\n")
    assert "<|im_start|>assistant" not in whole.replace("<|im_start|>assistant\n", "", 3)


def test_empty(spark):
    assert chat.report(table(spark, [])).count() == 0


def test_a_conversation_of_many_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(50_000)]
    whole = chat.format_conversations(table(spark, rows)).first()
    assert len(whole["targets"]) == 25_000
    assert all(whole["formatted"][t["start"]:t["end"]] == f"t{t['turn']}" and t["turn"] % 2 for t in whole["targets"])
