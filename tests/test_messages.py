"""Edge rows of message normalisation and validation."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions import messages as M
from dialoom.operators import clean as C

DEFAULT = "default prompt"


def raw(spark, conversations):
    # through JSON, which keeps the order of the keys
    rows = [(i, None if c is None else json.dumps(c)) for i, c in enumerate(conversations)]
    df = spark.createDataFrame(rows, "conv_id bigint, c string")
    return df.select(
        "conv_id", F.from_json("c", "array<map<string,string>>").alias("conversation")
    )


def structs(spark, conversations):
    rows = [(i, [tuple(m) for m in c]) for i, c in enumerate(conversations)]
    return spark.createDataFrame(rows, f"conv_id bigint, conversation {M.MESSAGES_TYPE}")


def out(df):
    got = df.orderBy("conv_id").select("conversation").collect()
    return [[(m["from"], m["value"]) for m in r.conversation] for r in got]


def apply(df, fn):
    return out(df.withColumn("conversation", fn(F.col("conversation"))))


def H(v):
    return ("human", v)


def G(v):
    return ("gpt", v)


def test_rename_role_wins(spark):
    df = raw(spark, [[{"role": "user", "from": "x", "value": "old", "content": "new", "k": "1"}]])
    row = df.select(M.rename_message_keys(F.col("conversation"))[0].alias("m")).first().m
    assert (row["from"], row["value"], row["meta"]) == ("user", "new", {"k": "1"})


def test_metadata(spark):
    conversation = [
        {"from": "system", "value": "s", "hidden": "x"},
        {"from": "tool", "value": "t", "ok": "true", "k": "tool", "gone": "here"},
        {"from": "user", "value": "u", "gone": None},
        {"from": "assistant", "value": "a", "late": "1", "k": "gpt"},
        {"from": "assistant", "value": "a", "text": "None"},
    ]
    m = M.map_roles(M.rename_message_keys(F.col("conversation")))
    df = raw(spark, [conversation]).select(
        M.metadata_prompt(M.collect_metadata(m)).alias("p")
    )
    assert df.first().p == "ok: true, k: gpt, late: 1"


@pytest.mark.parametrize(
    ("conversation", "head"),
    [
        ([{"from": "user", "value": "u"}], DEFAULT),
        ([{"from": "system", "value": ""}, {"from": "user", "value": "u"}], DEFAULT),
        ([{"from": "system", "value": " \n"}, {"from": "user", "value": "u"}], DEFAULT),
        ([{"from": "system", "value": " a, "}, {"from": "user", "value": "u"}], "a"),
        ([{"from": "system", "value": ", ,"}, {"from": "user", "value": "u"}], DEFAULT),
        ([{"from": "system", "value": "a"}, {"from": "user", "value": "u", "k": "v"}], "a, k: v"),
        ([{"from": "user", "value": "u", "k": "v"}], "k: v"),
        ([{"from": "system", "value": ""}, {"from": "user", "value": "u", "k": "v"}], "k: v"),
    ],
)
def test_system_prompt(spark, conversation, head):
    got = out(C.normalize(raw(spark, [conversation]), DEFAULT))
    assert got == [[("system", head), H("u")]]


def test_empty_conversation_gets_system(spark):
    assert out(C.normalize(raw(spark, [[]]), DEFAULT)) == [[("system", DEFAULT)]]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ([H("a"), H("b"), G("c")], [H("a b"), G("c")]),
        ([H("a"), G("b"), G("c"), G("d")], [H("a"), G("b c d")]),
        ([H("a"), ("tool", "t"), H("b"), G("c")],) * 2,
        ([("system", "x"), ("system", "y"), H("a"), G("b")],) * 2,
        ([H("a"), H("b")],) * 2,  # no gpt: nothing is merged
        ([H("a"), H("b"), G("")],) * 2,
    ],
)
def test_merge(spark, given, wanted):
    assert apply(structs(spark, [given]), M.merge_consecutive_turns) == [wanted]


def test_merge_is_idempotent_and_matches_a_loop(spark):
    import random

    rng = random.Random(3)
    conversations = [
        [(rng.choice(["human", "gpt", "tool"]), rng.choice(["", "x", "yy"])) for _ in range(n)]
        for n in range(40)
    ]

    def loop(c):
        if not any(r == "human" and v for r, v in c) or not any(r == "gpt" and v for r, v in c):
            return c
        done = []
        for r, v in c:
            if done and r in ("human", "gpt") and done[-1][0] == r:
                done[-1] = (r, done[-1][1] + " " + v)
            else:
                done.append((r, v))
        return done

    df = structs(spark, conversations)
    once = apply(df, M.merge_consecutive_turns)
    assert once == [loop(c) for c in conversations]
    assert apply(structs(spark, once), M.merge_consecutive_turns) == once


@pytest.mark.parametrize(
    ("given", "ok"),
    [
        ([G("a"), H("b")], False),
        ([H("a"), ("system", "s"), G("b")], False),
        ([H("a"), ("tool", "s"), G("b")], False),
        ([("system", "s"), H("a"), G("b"), H("c")], True),
        ([], True),
    ],
)
def test_turn_order(spark, given, ok):
    df = structs(spark, [given])
    assert df.select(M.valid_turn_order(F.col("conversation")).alias("ok")).first().ok is ok


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ([H("a"), G("b"), H("c")], [H("a"), G("b")]),
        ([H("a"), G("b"), H("c"), ("tool", "t")],) * 2,
        ([H("a")], []),
        ([], []),
    ],
)
def test_trailing_human(spark, given, wanted):
    assert apply(structs(spark, [given]), M.drop_trailing_human) == [wanted]


def test_nbytes_is_the_length_of_the_json(spark):
    texts = ['"quoted"', "back\\slash", "line\nbreak\t\r", "\x01\x1f", "àéîõü", "🙂 emoji", "", "a/b"]
    conversations = [[("system", "ignored"), H(t), G(t + "!")] for t in texts] + [[("system", "x")], []]
    df = structs(spark, conversations)
    got = [
        r.n
        for r in df.orderBy("conv_id")
        .select(M.conversation_nbytes(F.col("conversation")).alias("n"))
        .collect()
    ]
    wanted = [
        sum(
            len(json.dumps({"from": r, "value": v}, ensure_ascii=False).encode())
            for r, v in c
            if r != "system"
        )
        for c in conversations
    ]
    assert got == wanted


def test_conversation_line_is_json(spark):
    conversations = [[H('a "b" \n'), G("é🙂")], []]
    df = structs(spark, conversations).orderBy("conv_id")
    lines = [r[0] for r in df.select(M.conversation_line(F.col("conversation"))).collect()]
    assert lines == [
        json.dumps([{"from": r, "value": v} for r, v in c], ensure_ascii=False)
        for c in conversations
    ]


def test_quarantine(spark):
    df = raw(
        spark,
        [
            [{"role": "user", "content": "x"}],
            [{"role": "user"}],
            [{"content": "x"}],
            None,
            [None],
            [],
        ],
    )
    good, bad = C.quarantine(df)
    assert sorted(r.conv_id for r in good.collect()) == [0, 5]
    assert sorted(r.conv_id for r in bad.collect()) == [1, 2, 3, 4]


def test_final_role_check_allows_empty_values(spark):
    df = structs(spark, [[H(""), G("")], [H("a")], [G("a")], []])
    assert [r.conv_id for r in C.require_both_roles(df).collect()] == [0]
