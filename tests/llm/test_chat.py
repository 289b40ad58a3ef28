import hashlib

import pytest

from tourney.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string, window int"

ROWS = [
    (1, 0, "system", "be <<SYS>> brief", 9),
    (1, 1, "user", "</s>[INST] ok [/INST]", 9),
    (1, 2, "assistant", "a <\\/s> </s> <\\\\/s> [ROLE]", 9),
    (1, 3, "user", "x" * 300, 9),
    (1, 4, "assistant", "y" * 900, 9),
    (1, 5, "user", "", 9),
    (1, 6, "assistant", "last é\U0001f600", 9),
    (2, 0, None, None, 9),
    (2, 1, "to\n ol%", "{}\n [\\/ROLE]", 9),
    (2, 1, "assistant", "same turn", 9),
    (2, 1, "assistant", "same turn", 9),
    (None, None, "user", "no id", 9),
    (3, 0, "assistant", "z" * 20_000, 9),
    (4, 0, "system", "alone", 9),
]


def expected(rows):
    by_conversation = {}
    for conv, turn, role, text, _ in rows:
        key = (turn is not None, turn or 0, role or "", text or "")
        by_conversation.setdefault(conv, []).append((*key[:2], *key[2:]))
    out = {}
    for conv, turns in by_conversation.items():
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in sorted(turns))
        loss = "".join(text for _, _, role, text in sorted(turns) if role == "assistant")
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (said, loss)]
        out[conv] = (len(turns), sha[0], len(loss), sha[1])
    return out


@pytest.mark.parametrize("budget", [64, 200, 1024])
def test_reads_back_what_was_formatted(spark, budget):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    windows = chat.format_windows(rows, budget=budget, history_tokens=budget // 4)
    found = {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat.read_back(windows).collect()
    }
    assert found == expected(ROWS)


def test_windows_keep_the_budget_the_system_turn_and_some_history(spark):
    rows = [(1, 0, "system", "rules", 0)]
    for turn in range(1, 60):
        rows.append((1, turn, "user" if turn % 2 else "assistant", f"turn {turn} " * 5, 0))
    frame = spark.createDataFrame(rows, SCHEMA)
    windows = chat.format_windows(frame, budget=100, history_turns=2, history_tokens=40)
    found = sorted(windows.collect(), key=lambda r: r.window)
    assert len(found) > 5
    assert all(len(r.formatted) <= 4 * 100 for r in found)
    assert all(r.formatted.startswith("<<SYS>>\nrules\n<</SYS>>\n") for r in found)
    assert all(r.repeated > 1 for r in found[1:])
    assert sum(r.turns - r.repeated for r in found) == len(rows)


def test_empty_table(spark):
    assert chat.read_back(chat.format_windows(spark.createDataFrame([], SCHEMA))).count() == 0


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    plan = chat.read_back(chat.format_windows(frame))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
