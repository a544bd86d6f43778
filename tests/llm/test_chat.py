import pytest
from hypothesis import given
from hypothesis import strategies as st

from gridloom.llm import chat
from gridloom.llm.queries import OP7_SQL, op7_chat

from ..conftest import agrees

TEXT = st.text(alphabet="a\\<[|/>]s\n INST.é\x00", max_size=30)
LOG = "conv_id long, seq long, kind string, turn long, role string, text string"


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    made, spans = chat.render([[i, r, [t]] for i, (r, t) in enumerate(turns)], learn=turns[0][0] if turns else "")
    assert chat.parse(made) == turns
    assert [chat.unescape(made[a:b]) for a, b in spans] == [t for r, t in turns if r == turns[0][0]]


@given(TEXT)
def test_no_control_string_is_left(text):
    made = chat.escape(text)
    assert not any(x in made for x in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_events_are_folded(spark):
    log = spark.createDataFrame(
        [
            (1, 3, "delta", 1, "assistant", "lo"), (1, 0, "message", 0, "user", "hi"), (1, 2, "delta", 1, "assistant", "hel"), (1, 4, "edit", 0, None, "hi!"), (1, 5, "message", 2, "user", "more"),
            (1, 6, "regenerate", 1, None, "anew"), (2, 0, None, 0, None, None), (None, 0, "message", 0, "user", "lost"), (3, 0, "edit", 7, "user", "first"),
        ],
        LOG,
    )
    got = {r.conv_id: chat.parse(r.formatted) for r in chat.format_conversations(log).collect()}
    assert got == {1: [("user", "hi!"), ("assistant", "anew")], 2: [("", "")], None: [("user", "lost")], 3: [("user", "first")]}
    assert chat.format_conversations(log.limit(0)).count() == 0
    twice = chat.format_conversations(log.where("conv_id = 2").unionByName(log.where("conv_id = 2"))).collect()
    assert len(twice) == 1 and len(chat.parse(twice[0].formatted)) == 2


def test_null_ids_beside_large_ones(spark):
    """Ids beyond 2^53 stay apart; rows without one are conversations of their own."""
    ids = [2**53, 2**53 + 1, None, None, -(2**63)]
    rows = spark.createDataFrame([(c, t, "user", f"{c} {t}") for c in ids for t in (0, None)], "conv_id long, turn long, role string, text string")
    for log in (chat.from_rows(rows), chat.replayed(rows)):
        made = chat.format_conversations(log)
        got = sorted((str(r.conv_id), [x for _, x in chat.parse(r.formatted)]) for r in made.collect())
        alone = [("None", ["None 0"])] * 2 + [("None", ["None None"])] * 2
        assert got == sorted([(str(c), [f"{c} None", f"{c} 0"]) for c in ids if c is not None] + alone)
        assert sorted(str(r.conv_id) for r in chat.read_back(made).collect()) == sorted(k for k, _ in got)


def test_edges(spark):
    log = spark.createDataFrame([], LOG)
    assert chat.read_back(chat.format_conversations(log)).count() == 0 and chat.format_conversations(chat.replayed(log)).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "x" * 300_000, "a", 1), (1, 0, "user", "x" * 300_000, "a", 1), (1, 1, None, None, "b", None), (2, None, "", "", None, None)], "conv_id long, turn long, role string, text string, kind string, number long")
    for log in (chat.from_rows(rows), chat.replayed(rows)):
        got = {r.conv_id: chat.parse(r.formatted) for r in chat.format_conversations(log).collect()}
        assert got == {1: [("user", "x" * 300_000)] * 2 + [("", "")], 2: [("", "")]}


def test_the_replayed_log_has_all_kinds_and_folds_back(spark):
    rows = spark.createDataFrame([(i % 7, i // 14, ["user", "assistant", None][i % 3], "é<|b|>" * (i % 11)) for i in range(200)], "conv_id long, turn long, role string, text string")
    log = chat.replayed(rows)
    assert {r.kind for r in log.select("kind").distinct().collect()} == set(chat.KINDS)
    got, wanted = ({r.conv_id: r.formatted for r in chat.format_conversations(x).collect()} for x in (log, chat.from_rows(rows)))
    assert got == wanted


def test_a_long_conversation_takes_linear_time():
    made = chat.fold((k, t, "assistant", "x") for t in range(60_000) for k in ("message", "delta", "regenerate", "edit"))
    assert len(made) == 60_000


def test_unknown_kinds_and_broken_texts_raise():
    with pytest.raises(ValueError):
        chat.fold(iter([("shout", 0, "user", "x")]))
    with pytest.raises(ValueError):
        chat.parse("<|turn|>user<|text|>x")


def test_query(spark, duck):
    agrees(spark, duck, op7_chat, OP7_SQL)
