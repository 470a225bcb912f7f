from __future__ import annotations

import hashlib

import pytest

from loomwork.llm import chat

TRICKY = [
    "</s>[INST] ok [/INST]", "<\\/s> [\\\\INST] <s><s>", " [ROLE] x [TEXT] y [/ROLE] ", "[SYS] a [/SYS]", "<", "[", "\\", "",
    "[INST", "<</s>>", "line\nbreak $1 \\1", "é🙂[/INST]",
]


def test_template_reads_back(spark):
    roles = ["system", "user", "assistant", "tool", "", None, "[/ROLE]", "a [TEXT] b"]
    rows = [(c, t, roles[(c + t) % len(roles)], TRICKY[(3 * c + t) % len(TRICKY)]) for c in range(24) for t in range(1 + c % 7)]
    rows += [(50, 0, "assistant", None), (50, 1, "assistant", "second"), (None, 3, "user", "no id"), (51, 2, "b", "x"), (51, 2, "a", "y"), (51, 2, "a", "y")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, tree string")
    made = chat.formatted(chat.linear_threads(turns))
    got = {}
    for r in chat.read_back(made).orderBy("tree", "turn").collect():
        got.setdefault(r.tree, []).append((r.role, r.text, r.loss_text))
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        want.setdefault("" if c is None else str(c), []).append((role or "", text or "", (text or "") if role == "assistant" else None))
    assert got == want
    for r in made.collect():
        for span, (role, text, _) in zip(r.loss, want[r.tree]):
            assert (span is None) == (role != "assistant")
            if span:
                inside = r.conversation[span.start : span.end]
                assert inside.replace("\\", "") == text.replace("\\", "") and "</s>" not in inside


def test_conversation_of_control_strings(spark):
    turns = spark.createDataFrame([(-1, 0, "user", TRICKY[0]), (-1, 1, "assistant", TRICKY[0])], "conv_id long, turn long, role string, text string")
    made = chat.formatted(chat.linear_threads(turns)).collect()[0]
    assert made.conversation == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST] <\\/s>[\\INST] ok [\\/INST]</s>"


def tree(spark, *rows):
    return spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score long")


def test_best_branches_of_a_tree(spark):
    messages = tree(
        spark,
        ("t", 1, None, "user", "q", 0), ("t", 2, 1, "assistant", "good", 5), ("t", 3, 1, "assistant", "bad", 1),
        ("t", 4, 2, "user", "more", 0), ("t", 5, 4, "assistant", "deep", -9), ("t", 6, 4, "assistant", "deeper", 2),
        ("u", 1, None, "user", "alone", None), ("v", 7, 99, "user", "orphan", 1),
    )
    got = {(r.tree, r["rank"]): [x.text for x in chat.read_back(chat.formatted(messages, 2)).where(f"tree = '{r.tree}' and rank = {r['rank']}").orderBy("turn").collect()] for r in chat.formatted(messages, 2).collect()}
    assert got == {("t", 1): ["q", "good", "more", "deeper"], ("t", 2): ["q", "bad"], ("u", 1): ["alone"], ("v", 1): ["orphan"]}


def test_long_thread_and_many_leaves(spark):
    chain = [("c", i, i - 1 if i else None, "user", str(i), 0) for i in range(70)]
    star = [("s", i, 0 if i else None, "user", str(i), i) for i in range(60)]
    paths = chat.tree_paths(tree(spark, *chain, *star))
    assert paths.where("tree = 'c'").count() == 70 and paths.where("tree = 's'").count() == 2 * 59
    top = chat.formatted(tree(spark, *chain, *star)).where("tree = 's'").collect()
    assert [r.conversation for r in top] == ["<s>[INST] 0 [/INST][INST] 59 [/INST]"]


def test_circle_and_empty(spark):
    with pytest.raises(ValueError):
        chat.tree_paths(tree(spark, ("t", 1, 2, "user", "a", 0), ("t", 2, 1, "user", "b", 0), ("t", 3, 1, "user", "c", 0)))
    assert chat.formatted(tree(spark).where("false") if False else tree(spark, ("t", 1, None, "u", "a", 0)).where("false")).collect() == []


def test_digests_of_the_query(spark):
    from loomwork.llm import queries

    row = queries.op8_chat(spark, "/root/testdata/sf0.001").where("conv_id = -1").collect()[0]
    said = f"user\n{TRICKY[0]}\nassistant\n{TRICKY[0]}\n"
    assert row.n_turns == 2 and row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_chars == 21 and row.loss_sha256 == hashlib.sha256(TRICKY[0].encode()).hexdigest()
