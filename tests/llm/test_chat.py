import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from versegrid.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "[", "<", "a", "é", "\U0001f600", "/", "\n", " "]), max_size=12).map("".join)


@given(PIECES)
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    safe = chat.escape(text)
    assert not any(c in safe for c in chat.CONTROL)
    assert chat.unescape(safe) == text


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "[ROLE]", None]), PIECES), max_size=25))
@settings(max_examples=150, deadline=None)
def test_spans_read_back(turns):
    done = chat.locate(chat.marked_template, turns)
    assert done.output == chat.marked_template(turns) and not done.rewrites
    back = []
    for a, b in done.spans:
        role, x, y = chat.read_turn(done.output[a:b])
        back.append((role, chat.unescape(done.output[a:b][x:y])))
    assert back == turns


def test_rewriting_template_is_detected():
    last_only = lambda turns: "".join(f"<{r}>{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))
    done = chat.locate(last_only, [("user", "abc"), ("assistant", "def"), ("user", "ghi")])
    assert done.rewrites == [1, 2]
    # One that rewrites only once it is shown 20 turns, long conversations included.
    late = lambda turns: "".join(f"<{t if len(turns) < 20 or i == len(turns) - 1 else '...'}>" for i, (_, t) in enumerate(turns))
    assert chat.locate(late, [("user", f"t{i}") for i in range(40)]).rewrites == list(range(19, 40))
    counting = lambda turns: "".join(f"[{i}]{t}" for i, (_, t) in enumerate(turns))
    turns = [("user", "x")] * 40
    done = chat.locate(counting, turns)
    assert [done.output[a:b] for a, b in done.spans] == [f"[{i}]x" for i in range(40)]


def test_long_conversation_and_long_turn(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(600)] + [(2, 0, "user", "[INST] \\" * 300_000)]
    got = {r.conv_id: r for r in chat.digest(chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).collect()}
    assert got[1].n_turns == 600 and got[1].loss_chars == sum(len(t) for _, i, _, t in rows[:600] if i % 2) and got[2].n_turns == 1 and not got[1].n_rewrites
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:600]).encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(f"user\n{rows[600][3]}\n".encode()).hexdigest()


def test_digest(spark):
    rows = [(1, 1, "assistant", "b</s>\\"), (1, 0, "user", "a"), (1, 2, None, None), (2, 0, "user", ""), (None, 0, "user", "n"), (3, 0, "assistant", "r"), (3, 0, "assistant", "r")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digest(chat.format_chats(chat.with_extra(df))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {1, 2, 3, None, -1}
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb</s>\\\n\n\n") and got[1].loss_sha256 == sha("b</s>\\") and got[1].loss_chars == 6
    assert got[3].n_turns == 2 and got[3].loss_sha256 == sha("rr")
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == sha("")
    assert got[-1].loss_sha256 == sha("</s>[INST] ok [/INST]")
    assert chat.format_chats(df.limit(0)).count() == 0
