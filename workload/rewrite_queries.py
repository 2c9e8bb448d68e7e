"""Rewriting of system prompts, with a deterministic stand-in for the model."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from dialoom.config import RewriteOptions
from dialoom.fixed_values import DEFAULT_CURRENT_PROMPT, GENERATION_STOP_MARKERS
from dialoom.functions import text as T
from dialoom.operators import rewrite as R
from dialoom.operators.clean import with_nbytes
from dialoom.session import new_folder, stage_table
from workload import common as W
from workload.registry import query
from workload.size_queries import SIZES

CONTEXT = 700
OPTIONS = RewriteOptions(context_size=CONTEXT)


def make_generator():
    """Answers with the length of the prompt, between noise; refuses lengths that are
    divisible by five."""

    def generate(prompts):
        return [
            None
            if len(p) % 5 == 0
            else f"\x1b[1mecho {p[:10]}\nNew System Prompt: I  answer\nin {len(p)} ''ways. Note: x"
            for p in prompts
        ]

    return generate


def records(t):
    return with_nbytes(W.with_roles(W.raw(t)))


_FITS = f"nbytes <= 2 * {CONTEXT}"


@query("prompt_size_gate", f"WITH {SIZES} SELECT conv_id, nbytes FROM recs WHERE {_FITS}")
def gate(t):
    return W.sized(t).where(R.prompt_size_gate(F.col("nbytes"), CONTEXT))


def sql_prompt(current: str) -> str:
    instruction = W.quote(f"SYSTEM: {OPTIONS.instruction}\nUSER: CONVERSATION: Current System Prompt: ")
    return f"""{instruction} || {current} || chr(10) || turns || chr(10) || 'New System Prompt:'"""


_PROMPTS = f"""{SIZES}, heads AS (
  SELECT r.conv_id, r.nbytes, CASE WHEN m.role = 'system' THEN m.value
    ELSE {W.quote(DEFAULT_CURRENT_PROMPT)} END AS current
  FROM recs r JOIN msgs m ON m.conv_id = r.conv_id AND m.pos = 0),
spoken AS (
  SELECT conv_id, string_agg(CASE role WHEN 'human' THEN 'User Prompt' ELSE 'My Response' END
    || ': ' || value || chr(10), ' ' ORDER BY pos) AS turns
  FROM msgs WHERE pos > 0 AND role IN ('human', 'gpt') GROUP BY conv_id),
asked AS (
  SELECT h.conv_id, h.nbytes, h.current, coalesce(s.turns, '') AS turns
  FROM heads h LEFT JOIN spoken s USING (conv_id)),
prompts AS (SELECT *, {sql_prompt('current')} AS prompt FROM asked)"""


@query("build_rewrite_prompt", f"WITH {_PROMPTS} SELECT conv_id, prompt FROM prompts")
def build_prompt(t):
    m = F.col("conversation")
    return records(t).select(
        "conv_id",
        R.build_rewrite_prompt(m, R.current_system_prompt(m), OPTIONS.instruction).alias("prompt"),
    )


_ANSWER = """CASE WHEN length({p}) % 5 <> 0 THEN 'I answer in ' || length({p}) || ' ways.' END"""
_GENERATED = f"""{_PROMPTS}, first AS (
  SELECT *, CASE WHEN {_FITS} THEN {_ANSWER.format(p='prompt')} END AS g1 FROM prompts),
second_prompt AS (SELECT *, {sql_prompt('g1')} AS prompt2 FROM first),
second AS (SELECT *, {_ANSWER.format(p='prompt2')} AS g2 FROM second_prompt)"""


@query("generate_text", f"WITH {_GENERATED} SELECT conv_id, g1 AS generated FROM second")
def generate(t):
    return R.two_pass_generate(records(t), make_generator, OPTIONS).select("conv_id", "generated")


@query("two_pass_generate", f"WITH {_GENERATED} SELECT conv_id, g2 AS generated FROM second")
def two_pass(t):
    options = RewriteOptions(context_size=CONTEXT, twice=True)
    return R.two_pass_generate(records(t), make_generator, options).select("conv_id", "generated")


@query(
    "accept_rewrite",
    f"""WITH {_GENERATED} SELECT m.conv_id, m.pos, m.role,
      CASE WHEN m.pos = 0 AND m.role = 'system' AND length(s.g1) > 10 THEN s.g1 ELSE m.value END
        AS value FROM msgs m JOIN second s USING (conv_id)""",
)
def accept(t):
    return W.rows(R.improve_system_prompts(records(t), make_generator, OPTIONS))


@query(
    "strip_ansi",
    "SELECT conv_id, turn, text || 'red' AS value FROM conversations",
)
def strip_ansi(t):
    coloured = F.concat(F.lit("\x1b[2K\x1bD"), F.col("text"), F.lit("\x1b[31;1mred\x1bM"))
    return t("conversations").select("conv_id", "turn", T.strip_ansi(coloured).alias("value"))


def sql_clean_output(x: str) -> str:
    prompt = f"string_split({x}, 'New System Prompt:')[-1]"
    for stop in GENERATION_STOP_MARKERS:
        prompt = f"string_split({prompt}, {W.quote(stop)})[1]"
    return (
        f"CASE WHEN contains({x}, 'New System Prompt:') THEN replace(array_to_string(list_filter("
        f"regexp_split_to_array(replace({prompt}, '''''', ''), '{W.SQL_SPACE}+'), "
        f"lambda w: w <> ''), ' '), 'â€™', '_') END"
    )


@query(
    "clean_generated_prompt",
    f"""WITH o AS (SELECT conv_id, turn, replace(CASE WHEN turn % 2 = 0
        THEN 'New System Prompt: a' || text || 'New System Prompt: ''' || '''' || text || ' Note: b'
        ELSE text END, chr(10), ' ') AS x FROM conversations)
    SELECT conv_id, turn, {sql_clean_output('x')} AS value FROM o""",
)
def clean_output(t):
    text = F.col("text")
    output = F.when(
        F.col("turn") % 2 == 0,
        F.concat(
            F.lit("New System Prompt: a"), text, F.lit("New System Prompt: ''"), text, F.lit(" Note: b")
        ),
    ).otherwise(text)
    return t("conversations").select(
        "conv_id", "turn", T.clean_generated_prompt(output).alias("value")
    )


@query(
    "resume_processing",
    f"""WITH {_GENERATED} SELECT m.conv_id, m.pos, m.role,
      CASE WHEN m.pos = 0 AND m.role = 'system' AND length(s.g1) > 10 THEN s.g1 ELSE m.value END
        AS value FROM msgs m JOIN second s USING (conv_id)""",
)
def resume(t):
    """A first run saw the conversations without a system prompt; the second goes on."""
    path = new_folder(t.spark, "rewritten")
    df = records(t)
    started = df.where(F.col("conversation")[0]["from"] != "system")
    R.resume_processing(started, path, make_generator, OPTIONS)
    return W.rows(R.resume_processing(df, path, make_generator, OPTIONS))


def make_raising_generator():
    """As ``make_generator``, but raises on a batch that holds a prompt whose length is
    divisible by seven."""
    inner = make_generator()

    def generate(prompts):
        for p in prompts:
            if len(p) % 7 == 0:
                raise ValueError(f"length {len(p)}")
        return inner(prompts)

    return generate


@query(
    "generate_text_errors",
    f"""WITH {_PROMPTS} SELECT conv_id,
      CASE WHEN length(prompt) % 7 <> 0 THEN {_ANSWER.format(p='prompt')} END AS generated,
      CASE WHEN length(prompt) % 7 = 0 THEN 'ValueError: length ' || length(prompt) END AS error
    FROM prompts WHERE {_FITS}""",
)
def generate_errors(t):
    """A prompt that the model raises on costs itself only."""
    fitting = records(t).where(R.prompt_size_gate(F.col("nbytes"), CONTEXT))
    return R.two_pass_generate(fitting, make_raising_generator, OPTIONS, "error").select(
        "conv_id", "generated", "error"
    )


@query(
    "resume_in_parts",
    f"""WITH {_GENERATED} SELECT m.conv_id, m.pos, m.role,
      CASE WHEN m.pos = 0 AND m.role = 'system' AND length(s.g1) > 10 THEN s.g1 ELSE m.value END
        AS value FROM msgs m JOIN second s USING (conv_id)""",
)
def resume_in_parts(t):
    """Two of four slices of some records, then all records: the others of those slices
    are done as well."""
    path = new_folder(t.spark, "rewritten")
    df = stage_table(records(t), "records")
    options = replace(OPTIONS, slices=4)
    early = df.where(F.col("conv_id") % 5 != 0)
    R.resume_processing(early, path, make_generator, options, max_slices=2)
    return W.rows(R.resume_processing(df, path, make_generator, options))
