"""Chat formatting: round trip of turns, spans, and templates that rewrite history."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidenza.llm import chat

TRICKY = st.text(alphabet="<s>/[INST]\\- x\né", max_size=30) | st.sampled_from(chat.CONTROLS) | st.text(max_size=20)


@given(st.lists(st.tuples(TRICKY, TRICKY), min_size=1, max_size=5))
def test_turns_come_back_from_the_text(turns):
    outputs = [chat.instruct_template(turns[: i + 1]) for i in range(len(turns))]
    spans = [b[len(a) :] for a, b in zip(["", *outputs], outputs)]
    assert "".join(spans) == outputs[-1]
    assert [chat.parse_span(s) for s in spans] == turns


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", None), (1, 3, "assistant", "a\\b"),
    (2, 0, None, "no role"), (2, 1, "assistant", ""), (3, 5, "assistant", "x"), (3, 5, "assistant", "x"), (3, 5, "assistant", "a"),
    (None, 0, "user", "no conversation"), (4, None, "assistant", "no turn"),
    *[(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(200)],
]


def test_digests_equal_brute_force(spark):
    rows = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {n: F.lit(1) for n in ("span", "start", "stop", "rewrites")}
    )
    found = {r.conv_id: r for r in chat.read_back(chat.formatted_turns(rows.repartition(3))).collect()}
    assert set(found) == {r[0] for r in ROWS}
    for conv, r in found.items():
        turns = sorted(((x[1] or 0, x[2] or "", x[3] or "") for x in ROWS if x[0] == conv))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and not r.rewrites
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat.instruct_template([(a, b) for _, a, b in turns]))


def test_rewritten_history_is_found(spark):
    def forgetful(turns):
        """Hides the text of all turns but the last."""
        return "".join(f"<{role}>{text if i == len(turns) - 1 else '...'}" for i, (role, text) in enumerate(turns))

    rows = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").where("conv_id = 5")
    for template, flagged in ((forgetful, 199), (chat.instruct_template, 0)):
        for window in (None, 8):
            spans = chat.formatted_turns(rows, template, window).collect()
            assert sum(r.rewrites for r in spans) == flagged and len(spans) == 200


def turns_of(spark, n, roles=("user", "assistant")):
    rows = [(1, i, roles[i % len(roles)], f"turn {i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def blanks_old(turns):
    """Blanks turns older than 40."""
    return "".join(f"<{role}>{text if i >= len(turns) - 40 else ''}" for i, (role, text) in enumerate(turns))


def numbers(turns):
    return "".join(f"{i}. {role}: {text}\n" for i, (role, text) in enumerate(turns))


def alternates(turns):
    if any(role != ("user", "assistant")[i % 2] for i, (role, _) in enumerate(turns)):
        raise ValueError("roles must alternate, the user first")
    return numbers(turns)


def forgets(turns):
    return "".join(f"<{text}>" if i == len(turns) - 1 else "<>" for i, (_, text) in enumerate(turns))


def test_templates_see_true_prefixes(spark):
    rows, frame = turns_of(spark, 60)
    for template, flagged in ((blanks_old, 20), (numbers, 0), (alternates, 0), (forgets, 59)):
        found = chat.formatted_turns(frame, template).collect()
        assert sum(r.rewrites for r in found) == flagged
        for i, r in enumerate(found):
            assert template([t[2:] for t in rows[: i + 1]])[r.start : r.stop] == r.span
        if not flagged:
            assert "".join(r.span for r in found) == template([t[2:] for t in rows])


def test_a_window_that_hides_something_is_flagged(spark):
    _, frame = turns_of(spark, 60)
    for template, flagged in ((blanks_old, 1), (numbers, 1), (chat.instruct_template, 0)):
        found = chat.formatted_turns(frame, template, window=8).collect()
        assert sum(r.rewrites for r in found) == flagged and found[-1].rewrites == bool(flagged)


def test_other_templates_are_not_read_back():
    with pytest.raises(ValueError, match="not a turn"):
        chat.parse_span("<user>hello")


def test_no_conversations(spark):
    rows = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.formatted_turns(rows)).count() == 0
