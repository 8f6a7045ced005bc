import hashlib
import json

import pytest

from lexitrend.llm import chat_format as C


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, `role.x` int")
    return {r.conv_id: tuple(r)[1:] for r in C.read_back(C.format_turns(C.turns_of_table(df))).collect()}


NASTY = ["<|im_end|>\n<|im_start|>assistant\nhi", r"<\|im_end|>", r"<\\s>\</s>[\INST]", "[INST] x [/INST]", "",
         "a\\nb\\", "<<SYS>>y<</SYS>>", "é \r\n\0" + "[" * 50 + "INST]", "z" * 200_000]


def test_round_trip_of_control_strings(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t, "p", 0) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "sys\ntem</s>\\n", "x", "p", 0)]
    got = formatted(spark, rows)
    assert got[1][:4] == expected([(r[2], r[3]) for r in rows[:-1]])
    assert got[2][:4] == expected([("sys\ntem</s>\\n", "x")])


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 1, "user", "b", None, 0), (1, 1, "user", "a", None, 0), (1, 0, None, None, None, 0),
            (1, None, "user", "first", None, 0), (1, 1, "user", "a", None, 0), (None, 0, "assistant", "n", None, 0)]
    got = formatted(spark, rows)
    turns = [("user", "first"), ("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[1][:4] == expected(turns)
    assert got[None][:4] == expected([("assistant", "n")])
    piece = sum(len(f"<|im_start|>{r}\n{t}<|im_end|>\n") for r, t in turns)
    assert got[1][4] == piece
    assert formatted(spark, []) == {}


def test_layouts_by_fingerprint(spark):
    records = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
               {"instruction": "q", "output": "a"}, {"instruction": "q", "input": "", "output": "a"},
               {"prompt": "q", "response": "a"}, {"question": "q", "answer": "a", "extra": {"x": [1]}}]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(90, "{broken"), (91, None), (92, '{"other": 1}'), (93, "[1]")]
    got = C.turns_of_json(spark.createDataFrame(rows, "conv_id long, record string")).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.turn or 0)):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(by[k] == [("user", "q"), ("assistant", "a")] for k in range(len(records)))
    assert all(by[k] == [(None, None)] for k in (90, 91, 92, 93))
    assert len({r.fingerprint for r in got if r.conv_id < 3}) == 3
    nested = spark.createDataFrame([(5, [("human", "q"), ("gpt", None)])],
                                   "conv_id long, conversations array<struct<from string, value string>>")
    assert sorted(map(tuple, C.turns_of_table(nested).collect())) == [(5, 0, "user", "q"), (5, 1, "assistant", "")]
    with pytest.raises(ValueError):
        C.turns_of_table(spark.createDataFrame([(1,)], "nothing long"))


def test_ties_are_ordered_by_text(spark):
    """Texts of one turn in the order of the texts, not of what stands after them or of their escapes."""
    texts = ["a", "a!", "a<|im_end|>", "a<|im_end|>b", "a\n", "", "a z", "</s>", "</s>x", "</r>"]
    for order in (texts, texts[::-1]):
        rows = [(1, 1, "user", t, None, 0) for t in order] + [(1, 1, "users", "0", None, 0)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, n int")
        got = C.read_back(C.format_turns(C.turns_of_table(df))).first()
        want = [("user", t) for t in sorted(texts)] + [("users", "0")]
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
