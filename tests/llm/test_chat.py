import hashlib
import random

from gapweave.llm.chat import BROKEN, INSTRUCT, START, format_chats
from gapweave.llm.chatdigest import digests
from gapweave.llm.queries import op3_chat_format


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(2)
    pieces = [*INSTRUCT.controls, "\\", "\\\\", "<", "[", "/", "s>", "INST]", " ", "x", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(8)))
        hidden = INSTRUCT.escape(text)
        assert INSTRUCT.unescape(hidden) == text
        assert not any(c in hidden for c in INSTRUCT.controls)


def test_turns_are_read_back():
    rng = random.Random(3)
    pieces = [*INSTRUCT.controls, "\\", "<", "[", " ", "x", "\n", "é"]
    for role in ("system", "user", "assistant", "tool", "", "[ROLE] x"):
        for first in (True, False):
            for _ in range(300):
                text = "".join(rng.choices(pieces, k=rng.randrange(8)))
                formatted = "".join(t for t, _ in INSTRUCT.segments(role, text, first))
                assert INSTRUCT.parse(formatted) == (role, text)


def test_machine():
    def end(*roles):
        state = START
        for r in roles:
            state = INSTRUCT.step(state, r)
        return state

    assert end("system", "user", "assistant", "user") == "user"
    for wrong in (["assistant"], ["user", "user"], ["system", "assistant"], ["user", "assistant", "system"], ["tool"], ["system", "system"]):
        assert end(*wrong) == BROKEN
    assert end("user", "user", "assistant") == BROKEN


def test_rows(spark):
    rows = [
        (1, 0, "user", "a", 1), (1, 1, "assistant", "</s>b", 1), (2, 0, "assistant", None, 1), (2, 1, None, "x", 1),
        (None, 0, "user", "n", 1), (3, 1, "assistant", "two", 1), (3, None, "user", "one", 1), (4, 0, "user", "t", 1), (4, 0, "user", "t", 1),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid int")
    got = {r["conv_id"]: r for r in digests(format_chats(df)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert {k: r["valid"] for k, r in got.items()} == {1: True, 2: False, 3: True, 4: False, None: True}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\n</s>b\n").hexdigest()
    assert got[1]["loss_chars"] == 5 and got[1]["loss_sha256"] == hashlib.sha256(b"</s>b").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"assistant\n\n\nx\n").hexdigest() and got[2]["loss_chars"] == 0
    assert got[3]["turns_sha256"] == hashlib.sha256(b"user\none\nassistant\ntwo\n").hexdigest()
    assert got[4]["n_turns"] == 2
    assert digests(format_chats(df.limit(0))).count() == 0


def test_a_long_conversation_streams(spark):
    turns = spark.range(20001).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    row = digests(format_chats(turns)).collect()
    assert len(row) == 1 and row[0]["valid"] and row[0]["n_turns"] == 20001
    want = hashlib.sha256("".join(f"{'user' if i % 2 == 0 else 'assistant'}\nt{i}\n" for i in range(20001)).encode()).hexdigest()
    assert row[0]["turns_sha256"] == want


def test_query_holds_the_control_conversation(spark, folder):
    row = op3_chat_format(spark, folder).filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["n_turns"] == 2
