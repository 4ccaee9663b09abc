import hashlib
import random
from collections import defaultdict

from orderlens.llm import chat

CONTROLS = chat.INSTRUCT.controls()
SCHEMA = "conv_id long, turn long, role string, text string"


def odd_text(rnd):
    return "".join(rnd.choice([*CONTROLS, "\\", "\\\\", "[", "<", "INST]", "a", " ", "é", "\n", "/", "s>"]) for _ in range(rnd.randint(0, 12)))


def test_escaping_is_reversible_and_leaves_no_control_string():
    rnd = random.Random(1)
    for _ in range(5000):
        text = odd_text(rnd)
        made = chat.escape(text)
        assert chat.unescape(made) == text and not any(c in made for c in CONTROLS)


def test_turns_are_read_back():
    rnd = random.Random(2)
    for role in ("system", "user", "assistant", "tool", "", "<s>", "us\\er"):
        for _ in range(300):
            text = odd_text(rnd)
            whole = "".join(t for t, _ in chat.segments(role, text))
            assert chat.read_turn(whole) == (role, text)


def plain(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        roles, loss = [r for *_, r, _ in turns], "".join(x for *_, r, x in turns if r == "assistant")
        order = all(r in {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}.get(b, ()) for b, r in zip(["", *roles], roles))
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), order and roles[-1] == "assistant")
    return out


def test_conversations(spark):
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "assistant", "user", None, "tool"]), rnd.choice([None, odd_text(rnd)]))
            for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", odd_text(rnd)) for t in range(500)]  # a long one
    rows += [(None, 0, "user", "x"), (None, None, "user", "y"), (101, 0, "user", "same"), (101, 0, "user", "same")]
    rows += [(102, 0, "system", "s"), (102, 1, "user", "u"), (102, 2, "assistant", "a")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", position string, segments string")
    formatted = chat.format_chat(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat.digest(formatted).collect()}
    assert got == plain(rows) and got[102][-1] and got[100][-1] and not got[101][-1]
    sizes = {r.conv_id: r.formatted_chars for r in chat.digest(formatted).collect()}
    assert sizes[102] == len("<<SYS>>s<</SYS>>[INST] u [/INST]<s>a</s>")


def test_out_of_order_turns_are_marked(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a"), (1, 1, "user", "u"), (1, 2, "user", "v"), (1, 3, "assistant", "b")], SCHEMA)
    assert [r.allowed for r in sorted(chat.format_chat(df).collect(), key=lambda r: r.position)] == [False, True, False, True]


def test_empty_table(spark):
    assert chat.digest(chat.format_chat(spark.createDataFrame([], SCHEMA))).collect() == []
