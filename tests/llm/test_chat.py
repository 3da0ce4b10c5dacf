import hashlib
import json

import pytest

from tallyforge.llm import chat

NASTY = ["", "\\", "<|user|>x<|end|>\n", "</s>[INST] ok [/INST]", "a\\<|b", "<\\|", "\\\\n", "<<SYS>>\n<</SYS>>", "|>", "<|end|>", "é日𝒳 $1 \\1", "<", "<s>"]


def test_round_trip(spark):
    rows = [(i, t, role, text) for i in range(4) for t, (role, text) in enumerate([("user", NASTY[(i * 3 + k) % len(NASTY)]) if k % 2 == 0 else ("assistant", NASTY[(i * 3 + k) % len(NASTY)]) for k in range(8)])]
    rows += [(None, 0, None, None), (9, None, "assistant", "last"), (9, 1, "a<|b|>c", "first"), (9, 1, "a<|b|>c", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.formatted(chat.canonical(chat.message_records(df), "payload"))
    got = {r["conv_id"]: r for r in chat.digests(done).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    text = done.where("conv_id = 1").first()["formatted"]
    assert text.count("<|end|>") == 8 and not any(c in text.replace("<|", "") for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))


PAYLOADS = [
    ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "sharegpt", [("user", "q"), ("assistant", "")]),
    ({"prompt": "q", "response": "a"}, "prompt_response", [("user", "q"), ("assistant", "a")]),
    ({"response": "a", "prompt": "q"}, "prompt_response", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction_input_output", [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"question": "q", "answer": 3}, "question_answer", [("user", "q"), ("assistant", "3")]),
    ({"something": {"else": [1]}}, None, []),
]


@pytest.mark.parametrize("as_variant", [False, True])
def test_layouts(spark, as_variant):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, (p, *_) in enumerate(PAYLOADS)] + [(99, "not json"), (98, None)], "i long, payload string")
    if as_variant:
        df = df.selectExpr("i", "try_parse_json(payload) AS payload")
    got = {r["i"]: (r["mapping"], [tuple(t) for t in r["turns"]]) for r in chat.canonical(df, "payload").collect()}
    assert got == {**{i: (name, turns) for i, (_, name, turns) in enumerate(PAYLOADS)}, 99: (None, []), 98: (None, [])}


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string, payload string, back string")
    assert chat.digests(chat.formatted(chat.canonical(chat.message_records(df), "payload"))).count() == 0


def test_long_conversations(spark):
    """Thousands of turns, and a turn of a million characters, come back whole; clashing columns and nulls are no trouble."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} <| \\ é") for i in range(5001)] + [(2, 0, "user", "x" * 1_000_000), (2, 1, "assistant", "[INST]" * 100_000), (3, None, None, None)]
    df = spark.createDataFrame([(*r, "f", "l", "p") for r in rows], "conv_id long, turn long, role string, text string, formatted string, loss string, payload string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(chat.canonical(chat.message_records(df), "payload"))).collect()}
    for conv in (1, 2):
        said = "".join(t for c, _, role, t in rows if c == conv and role == "assistant")
        turns = "".join(f"{role}\n{t}\n" for c, _, role, t in rows if c == conv)
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[conv]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert got[3]["n_turns"] == 1 and got[3]["loss_chars"] == 0


def test_masks_of_other_ranges(spark):
    """A mask that covers other ranges than the assistant's texts is cut out as it stands."""
    df = spark.createDataFrame([("<|assistant|>abc<|end|>\n<|user|>def<|end|>\n", [(13, 14)]), ("<|assistant|>abc<|end|>\n", [(13, 16)])], "t string, m array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(chat.loss_text(df["t"], df["m"])).collect()] == ["a", "abc"]
