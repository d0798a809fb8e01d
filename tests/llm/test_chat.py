import hashlib

from pyspark.sql import functions as F

from shelfwise.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_read_back_equals_input(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\", "<\\|im_end|>\\\\<|", "a\nb\n", "", None, "<|" * 500, "😀<|im_start|>user\n", "\\<|\\n<\\/"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "odd\nrole<|\\<\\/", "x"), (3, 0, None, "y"), (None, 0, "user", "z"), (4, None, "user", "n"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", segments string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted([(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv])
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in mine)
        loss = "".join(x for _, _, r, x in mine if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(mine), sha(said))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))


def test_state_machine_and_loss(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "u"), (4, 0, "system", "s")]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[i].valid for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert out[1].formatted == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert [s.text for s in out[1].segments if s.loss] == ["a"]


def test_no_python_in_the_plan_and_empty(spark, capsys):
    out = chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA).unionByName(chat.probe(spark))))
    out.explain()
    assert not {"Python", "Arrow", "Pandas"} & set(capsys.readouterr().out.replace("[", " ").split())
    assert [r.conv_id for r in out.collect()] == [-1]
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).where(F.lit(True)).count() == 0
