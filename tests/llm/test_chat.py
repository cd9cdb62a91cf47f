import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.llm import chat


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_read_back(spark):
    said = "</s>[INST] ok [/INST]"
    turns = {
        1: [("system", "be \\ kind"), ("user", said), ("assistant", said), ("user", "<s>"), ("assistant", "")],
        2: [("user", ""), ("assistant", "x\ny")],
        3: [("assistant", "first"), ("tool[]", "<<SYS>>\n"), ("", "nothing")],
        4: [("user", "no answer")],
    }
    rows = [(c, k, r, t) for c, own in turns.items() for k, (r, t) in enumerate(own)]
    schema = "conv_id long, turn int, role string, text string"
    out = {r["conv_id"]: r for r in chat.digests(chat.formatted(spark.createDataFrame(rows, schema).repartition(3))).collect()}
    for c, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert (out[c]["n_turns"], out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(own), len(loss), digest(loss))
        assert out[c]["turns_sha256"] == digest("".join(f"{r}\n{t}\n" for r, t in own))
    assert [out[c]["valid"] for c in sorted(turns)] == [True, True, False, False]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x]\\"]), st.text("\\<[]/s>INT \nA", max_size=30)), max_size=5))
def test_no_text_imitates_a_control_string(turns):
    def escaped(t):
        return "".join("\\" + c if c in chat.TEMPLATE["control"] else c for c in t)

    text = ""
    for role, own in turns:
        a, b = chat.TEMPLATE["turns"].get(role, (chat.TEMPLATE["other"][0] + escaped(role) + chat.TEMPLATE["other"][1], chat.TEMPLATE["other"][2]))
        text += a + escaped(own) + b
    assert chat.read(text) == turns


def test_odd_rows(spark):
    schema = "conv_id long, turn int, role string, text string"
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (2, None, "assistant", "é" * 100_000), (2, 0, None, "")]
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS segments", "2 AS before", "3 AS valid", "4 AS may_follow")
    out = {r["conv_id"]: r for r in chat.digests(chat.formatted(df)).collect()}
    assert {c: r["n_turns"] for c, r in out.items()} == {None: 1, 1: 2, 2: 2}
    assert out[2]["loss_chars"] == 100_000
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0
