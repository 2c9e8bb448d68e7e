"""Row-local cleaning and filtering of conversations.

Everything here is narrow: no shuffle, no Python, so the same functions also run on a
streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.config import PreprocessOptions
from dialoom.fixed_values import GPT, HUMAN
from dialoom.functions import messages as M
from dialoom.functions import text as T
from dialoom.functions.base import let, refine, strip


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw records into usable ones and ones that cannot be read: corrupt input,
    no conversation, or a message whose role or text is missing or null."""
    unusable = F.exists(
        M.rename_message_keys(F.col("conversation")),
        lambda m: m["from"].isNull() | m["value"].isNull(),
    )
    bad = F.col("conversation").isNull() | F.coalesce(unusable, F.lit(True))
    if "_corrupt_record" in df.columns:
        bad = bad | F.col("_corrupt_record").isNotNull()
    return df.where(~bad), df.where(bad)


def normalize(df: DataFrame, system_prompt: str, column: str = "conversation") -> DataFrame:
    """Raw message maps → clean messages with a system prompt in front."""
    renamed = M.map_roles(M.rename_message_keys(F.col(column)))
    return df.withColumn(
        column,
        let(
            renamed,
            lambda m: M.upsert_system_prompt(
                m, M.metadata_prompt(M.collect_metadata(m)), system_prompt
            ),
        ),
    )


def _is_valid(m: Column) -> Column:
    return (
        M.has_role_with_value(m, HUMAN)
        & M.has_role_with_value(m, GPT)
        & M.valid_turn_order(m)
    )


def filter_valid_conversations(df: DataFrame, column: str = "conversation") -> DataFrame:
    """Merge repeated turns, drop invalid conversations and a trailing human turn."""
    merged = M.merge_consecutive_turns(F.col(column))
    return refine(df, column, merged, _is_valid).withColumn(
        column, M.drop_trailing_human(F.col(column))
    )


def _cleaned_answers(messages: Column, options: PreprocessOptions) -> Column:
    return M.map_values(
        messages,
        lambda v: T.cut_at_marker(T.strip_phrases(v, options.strip_phrases), options.cut_markers),
        [GPT],
    )


def clean_answers(df: DataFrame, options: PreprocessOptions) -> DataFrame:
    return df.withColumn("conversation", _cleaned_answers(F.col("conversation"), options))


def _reaches_charset_ratio(messages: Column, options: PreprocessOptions) -> Column:
    return ~F.exists(
        messages,
        lambda m: (m["from"] == GPT)
        & F.coalesce(
            T.charset_share(m["value"], options.code_points) < options.charset_threshold,
            F.lit(False),
        ),
    )


def filter_charset_ratio(df: DataFrame, options: PreprocessOptions) -> DataFrame:
    """Keep conversations whose every non-empty answer reaches the threshold."""
    return df.where(_reaches_charset_ratio(F.col("conversation"), options))


def _without_sections(messages: Column, options: PreprocessOptions) -> Column:
    return M.map_values(
        messages, lambda v: T.cut_reference_sections(v, options.section_headers), [GPT]
    )


def cut_reference_sections(df: DataFrame, options: PreprocessOptions) -> DataFrame:
    return df.withColumn("conversation", _without_sections(F.col("conversation"), options))


def with_nbytes(df: DataFrame) -> DataFrame:
    return df.withColumn("nbytes", M.conversation_nbytes(F.col("conversation")))


def cap_size(df: DataFrame, max_nbytes: int) -> DataFrame:
    """A cap on the bytes of each record, not on the number of records."""
    return df.where(F.col("nbytes") <= max_nbytes)


def size_and_cap(
    df: DataFrame, max_nbytes: int, conversation: Column | None = None
) -> DataFrame:
    """``with_nbytes`` and ``cap_size`` in one step, with a new conversation if one is
    given; the conversation is computed once."""
    value = F.col("conversation") if conversation is None else conversation
    sized = let(
        value,
        lambda c: F.struct(c.alias("conversation"), M.conversation_nbytes(c).alias("nbytes")),
    )
    kept = refine(df.drop("nbytes"), "conversation", sized, lambda s: s["nbytes"] <= max_nbytes)
    others = [c for c in kept.columns if c != "conversation"]
    return kept.select(*others, "conversation.*")


def drop_rejection_messages(df: DataFrame, options: PreprocessOptions) -> DataFrame:
    """Drop single messages that match; keep all if none would be left; trim the rest."""
    phrases = options.rejection_phrases

    def cleaned(m):
        kept = F.filter(
            m,
            lambda x: ~(T.is_rejected(x["value"], phrases) | T.is_rejected(x["from"], phrases)),
        )
        return let(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(m))

    return df.withColumn(
        "conversation", M.map_values(let(F.col("conversation"), cleaned), strip)
    )


def require_both_roles(df: DataFrame) -> DataFrame:
    m = F.col("conversation")
    return df.where(M.has_role(m, HUMAN) & M.has_role(m, GPT))


def clean(df: DataFrame, options: PreprocessOptions | None = None) -> DataFrame:
    """All row-local steps, in order.  Raw records in, cleaned and sized records out."""
    options = options or PreprocessOptions()
    if options.validate:
        df = filter_valid_conversations(normalize(df, options.system_prompt))
    else:
        df = df.withColumn(
            "conversation", M.project_messages(M.rename_message_keys(F.col("conversation")))
        )
    m = F.col("conversation")
    if options.strip:
        m = _cleaned_answers(m, options)
    if options.check_charset:
        df = refine(df, "conversation", m, lambda c: _reaches_charset_ratio(c, options))
    else:
        df = df.withColumn("conversation", m)
    df = size_and_cap(df, options.max_nbytes, _without_sections(F.col("conversation"), options))
    if options.drop_rejections:
        df = drop_rejection_messages(df, options)
    return df


def swap_phrases(df: DataFrame, swaps, seed: int, id_column: str = "conv_id") -> DataFrame:
    """Swap phrases in the messages of every role."""
    if not swaps:
        return df
    return df.withColumn(
        "conversation", swapped_messages(F.col("conversation"), swaps, seed, F.col(id_column))
    )


def swapped_messages(messages: Column, swaps, seed: int, id_: Column) -> Column:
    return F.transform(
        messages,
        lambda m, i: M.message(m["from"], T.swap_phrases(m["value"], swaps, seed, id_, i)),
    )
