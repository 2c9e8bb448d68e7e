"""Edge rows of text cleaning."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dialoom import PreprocessOptions
from dialoom import fixed_values as fixed
from dialoom.functions import text as T
from dialoom.functions.base import strip, words
from dialoom.operators import clean as C
from tests.test_messages import G, H, out, structs


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, v string")


def run(spark, values, fn):
    df = texts(spark, values).select("id", fn(F.col("v")).alias("x"))
    return [r.x for r in df.orderBy("id").collect()]


def test_strip_and_words_are_pythons(spark):
    rng = random.Random(5)
    letters = fixed.PYTHON_WHITESPACE + "ab\x00\x7f"
    values = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    assert run(spark, values, strip) == [v.strip() for v in values]
    assert run(spark, values, words) == [v.split() for v in values]


def test_strip_phrases_is_sequential(spark):
    phrases = ["ab", "cd", " end"]

    def loop(v):
        for p in phrases:
            v = v.replace(p, "").strip()
        return v

    rng = random.Random(6)
    values = ["".join(rng.choice("abcd en") for _ in range(12)) for _ in range(200)]
    values += ["cabd", "ab", "xaby", "ab end", "end"]
    assert run(spark, values, lambda v: T.strip_phrases(v, phrases)) == [loop(v) for v in values]
    assert run(spark, [" x "], lambda v: T.strip_phrases(v, [])) == [" x "]


def test_cut_at_marker(spark):
    values = [
        "Keep. Remember, it's important to x. Remember, it's important",
        "Keep. Remember, it’s always important",
        "Remember, it's important",
        " untouched ",
    ]
    assert run(spark, values, T.cut_at_marker) == ["Keep.", "Keep.", "", " untouched "]


@pytest.mark.parametrize("headers", [fixed.SECTION_HEADERS, fixed.SECTION_HEADERS_STRICT])
def test_cut_reference_sections(spark, headers):
    pattern = re.compile(
        r"^\s*(" + "|".join(map(re.escape, headers)) + r")\s*\n", re.IGNORECASE | re.MULTILINE
    )

    def loop(v):
        found = pattern.search(v)
        return v[: found.start()].strip() if found else v

    values = [
        "text\nReferences: see\nmore",
        "text\nReferences",
        " text \n\n  rEfErEnCeS \nmore",
        "text\r\nNotes\r\nmore",
        "See also\nx",
        "body\nBibliography\nx",
        "body\nFootnotes\n",
        "body\nBibliographyFootnotes\nx",
        "  no header, outer space  ",
        "a\nNotes and references\nb\nNotes\nc",
        "",
    ]
    assert run(spark, values, lambda v: T.cut_reference_sections(v, headers)) == list(
        map(loop, values)
    )


def test_charset_filter_is_strict_and_sees_answers_only(spark):
    options = PreprocessOptions(charset_threshold=0.9)
    nine_of_ten = "abcdefghié"
    df = structs(
        spark,
        [
            [H("x"), G(nine_of_ten)],
            [H("x"), G("abcdefgh" + "éé")],
            [H("ééé"), G("")],
            [H("x"), G("→∀α" * 5)],
            [H("x"), G("🙂")],
        ],
    )
    kept = C.filter_charset_ratio(df, options).select("conv_id").collect()
    assert sorted(r.conv_id for r in kept) == [0, 2, 3]


def test_rejection_messages(spark):
    df = structs(
        spark,
        [
            [("system", "an AI "), H(" a "), G("b")],
            [H("MAIN"), G("b")],
            [H("AI"), G(" AI ")],
            [H("ai"), G("b")],
            [("AI", "x"), H("a"), G("b")],
        ],
    )
    assert out(C.drop_rejection_messages(df, PreprocessOptions())) == [
        [H("a"), G("b")],
        [G("b")],
        [H("AI"), G("AI")],
        [H("ai"), G("b")],
        [H("a"), G("b")],
    ]


SWAPS = {"Dance": ["Movement", "a dance of"], "movement": ["x"], "a.b": ["Dot"]}


def test_swap(spark):
    got = run(
        spark,
        ["Dance", "dance", "DANCE", "abundance!", "a.b axb A.B", "nothing", "dance dance"],
        lambda v: T.swap_phrases(v, {"Dance": ["Movement"], "a.b": ["Dot"]}, 1, F.col("id")),
    )
    assert got == [
        "Movement",
        "movement",
        "Movement",
        "abunmovement!",
        "dot axb Dot",
        "nothing",
        "movement movement",
    ]


def test_swap_sees_earlier_replacements_once(spark):
    # the alternative holds the phrase itself: it is not replaced again
    got = run(spark, ["dance"], lambda v: T.swap_phrases(v, {"dance": ["a dance of"]}, 1, F.col("id")))
    assert got == ["a dance of"]
    got = run(
        spark, ["dance"], lambda v: T.swap_phrases(v, {"dance": ["Movement"], "movement": ["x"]}, 1)
    )
    assert got == ["x"]


def test_swap_uses_every_alternative_and_repeats(spark):
    def swap(seed):
        return run(
            spark, ["dance " * 30] * 3, lambda v: T.swap_phrases(v, {"dance": list("pqr")}, seed, F.col("id"))
        )

    assert swap(1) == swap(1) != swap(2)
    assert set("".join(swap(1)).replace(" ", "")) == set("pqr")


@pytest.mark.parametrize(
    ("original", "wanted"), [("Abc", "Some words"), ("abc", "some Words"), ("ABC", "Some words"), ("1", "some Words")]
)
def test_capitalization(spark, original, wanted):
    assert run(spark, [original], lambda v: T.match_capitalization(v, F.lit("some Words"))) == [wanted]


def test_generated_prompt(spark):
    values = [
        "no marker",
        "New System Prompt: one New System Prompt: two\n\nlines  x Note: rest",
        "New System Prompt:  ''quoted'' itâ€™s ``` code",
        "New System Prompt:",
        "x New System Prompt: a Perspective: b",
    ]
    assert run(spark, values, T.clean_generated_prompt) == [
        None,
        "two lines x",
        "quoted it_s",
        "",
        "a",
    ]
    strict = run(
        spark,
        values[-1:],
        lambda v: T.clean_generated_prompt(v, fixed.GENERATION_STOP_MARKERS_STRICT),
    )
    assert strict == ["a Perspective: b"]


def test_strip_ansi(spark):
    values = ["\x1b[31mred\x1b[0m", "\x1b[1;2Hx", "a\x1bMb", "plain [31m"]
    assert run(spark, values, T.strip_ansi) == ["red", "x", "ab", "plain [31m"]


def test_truncate(spark):
    assert run(spark, [" a　b  c ", "a", ""], lambda v: T.truncate_tokens(v, 2)) == ["a b", "a", ""]
