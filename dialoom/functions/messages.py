"""Message arrays: ``array<struct<from, value>>`` in, the same out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.fixed_values import (
    DEFAULT_SYSTEM_PROMPT,
    GPT,
    HUMAN,
    QA_PREFIX,
    QA_SEPARATOR,
    ROLE_NAMES,
    SYSTEM,
)
from dialoom.functions.base import let, run_lengths, strip

_RESERVED = ("from", "value", "role", "content")
MESSAGES_TYPE = "array<struct<from:string,value:string>>"


def message(role: Column, value: Column) -> Column:
    return F.struct(role.alias("from"), value.alias("value"))


def map_values(
    messages: Column,
    change: Callable[[Column], Column],
    roles: Sequence[str] | None = None,
) -> Column:
    """Apply ``change`` to the text of every message, or of the given roles."""

    def one(m: Column) -> Column:
        changed = message(m["from"], change(m["value"]))
        if roles is None:
            return changed
        return F.when(m["from"].isin(*roles), changed).otherwise(
            message(m["from"], m["value"])
        )

    return F.transform(messages, one)


def rename_message_keys(raw: Column) -> Column:
    """``array<map<string,string>>`` → ``array<struct<from, value, meta>>``.

    ``role`` and ``content`` win over ``from`` and ``value`` when both are there; all
    other keys stay in ``meta``.
    """

    def pick(m: Column, new: str, old: str) -> Column:
        return F.when(F.map_contains_key(m, new), F.try_element_at(m, F.lit(new))).otherwise(
            F.try_element_at(m, F.lit(old))
        )

    return F.transform(
        raw,
        lambda m: F.struct(
            pick(m, "role", "from").alias("from"),
            pick(m, "content", "value").alias("value"),
            F.map_filter(m, lambda k, _: ~k.isin(*_RESERVED)).alias("meta"),
        ),
    )


def role_name(role: Column) -> Column:
    renamed = role
    for old, new in ROLE_NAMES.items():
        renamed = F.when(role == old, F.lit(new)).otherwise(renamed)
    return renamed


def map_roles(messages: Column) -> Column:
    """user → human, assistant → gpt; every other role is left as it is."""
    return F.transform(messages, lambda m: m.withField("from", role_name(m["from"])))


def collect_metadata(messages: Column) -> Column:
    """Ordered ``array<struct<key, value>>`` of the metadata of a conversation.

    Roles other than system, human and gpt come first, human and gpt second.  A key
    stays where it first appeared and takes its last value; null reads ``None``.
    """

    def entries(m: Column, keep: Callable[[Column], Column]) -> Column:
        return F.flatten(
            F.transform(
                F.filter(m, lambda x: keep(F.coalesce(x["from"], F.lit("")))),
                lambda x: F.map_entries(x["meta"]),
            )
        )

    def resolve(e: Column) -> Column:
        keys = F.array_distinct(F.transform(e, lambda x: x["key"]))
        return F.transform(
            keys,
            lambda k: F.struct(
                k.alias("key"),
                F.coalesce(
                    F.element_at(F.filter(e, lambda x: x["key"] == k), -1)["value"],
                    F.lit("None"),
                ).alias("value"),
            ),
        )

    return let(
        messages,
        lambda m: let(
            F.concat(
                entries(m, lambda role: ~role.isin(SYSTEM, HUMAN, GPT)),
                entries(m, lambda role: role.isin(HUMAN, GPT)),
            ),
            resolve,
        ),
    )


def metadata_prompt(metadata: Column) -> Column:
    """``"k: v, k: v"`` without the entries whose value is ``None``."""
    shown = F.filter(metadata, lambda e: e["value"] != "None")
    return F.array_join(
        F.transform(shown, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), ", "
    )


def project_messages(messages: Column) -> Column:
    return F.transform(messages, lambda m: message(m["from"], m["value"]))


def upsert_system_prompt(
    messages: Column, metadata: Column, default: str = DEFAULT_SYSTEM_PROMPT
) -> Column:
    """Make message 0 a system message that carries the metadata text."""

    def rebuild(m: Column) -> Column:
        first = F.get(m, F.lit(0))
        head = F.struct(
            F.coalesce(first["from"] == SYSTEM, F.lit(False)).alias("is_system"),
            strip(F.coalesce(first["value"], F.lit(""))).alias("old"),
            metadata.alias("metadata"),
        )

        def with_head(h: Column) -> Column:
            joined = F.trim(F.concat(h["old"], F.lit(", "), h["metadata"]), F.lit(", "))
            prompt = F.when(h["is_system"] & (h["old"] != ""), joined).otherwise(h["metadata"])
            prompt = let(prompt, lambda p: F.when(p != "", p).otherwise(F.lit(default)))
            rest = F.when(h["is_system"], F.slice(m, F.lit(2), F.size(m))).otherwise(m)
            return F.concat(F.array(message(F.lit(SYSTEM), prompt)), rest)

        return let(head, with_head)

    return let(project_messages(messages), rebuild)


def has_role(messages: Column, role: str) -> Column:
    return F.exists(messages, lambda m: F.coalesce(m["from"] == role, F.lit(False)))


def has_role_with_value(messages: Column, role: str) -> Column:
    return F.exists(
        messages,
        lambda m: F.coalesce((m["from"] == role) & (m["value"] != ""), F.lit(False)),
    )


def merge_consecutive_turns(messages: Column) -> Column:
    """Neighbouring human+human or gpt+gpt messages become one, joined by a space,
    provided that both roles have something to say."""

    def same(a: Column, b: Column) -> Column:
        return (a["from"] == b["from"]) & b["from"].isin(HUMAN, GPT)

    def merged(m: Column) -> Column:
        return F.transform(
            run_lengths(m, same),
            lambda run: message(
                F.get(m, run["start"])["from"],
                F.array_join(
                    F.transform(
                        F.slice(m, run["start"] + 1, run["length"]), lambda x: x["value"]
                    ),
                    " ",
                ),
            ),
        )

    return let(
        messages,
        lambda m: F.when(
            has_role_with_value(m, HUMAN) & has_role_with_value(m, GPT), merged(m)
        ).otherwise(m),
    )


def valid_turn_order(messages: Column) -> Column:
    """Every gpt message directly follows a human one."""
    return let(
        messages,
        lambda m: ~F.exists(
            F.transform(
                m,
                lambda x, i: F.coalesce(x["from"] == GPT, F.lit(False))
                & (
                    F.coalesce(
                        F.when(i > 0, F.get(m, i - 1)["from"]), F.lit("")
                    )
                    != HUMAN
                ),
            ),
            lambda bad: bad,
        ),
    )


def drop_trailing_human(messages: Column) -> Column:
    return let(
        messages,
        lambda m: F.when(
            F.get(m, F.size(m) - 1)["from"] == HUMAN,
            F.slice(m, F.lit(1), F.size(m) - 1),
        ).otherwise(m),
    )


def conversation_nbytes(messages: Column) -> Column:
    """Bytes of the non-system messages written as JSON with ``", "`` and ``": "``.

    One compact rendering of the whole array is measured: for n messages it has n+1
    bytes more (brackets, commas) and 3n bytes less (spaces) than the sum wanted.
    """
    spoken = F.filter(messages, lambda m: F.coalesce(m["from"] != SYSTEM, F.lit(True)))
    return let(
        spoken,
        lambda m: F.when(
            F.size(m) > 0, F.octet_length(F.to_json(m)) + 2 * F.size(m) - 1
        ).otherwise(0),
    ).cast("bigint")


def _said(messages: Column, role: str) -> Column:
    spoken = F.transform(
        F.filter(messages, lambda m: m["from"] == role), lambda m: m["value"]
    )
    return F.concat(F.lit(QA_PREFIX), F.array_join(spoken, QA_SEPARATOR))


def question_text(messages: Column) -> Column:
    return _said(messages, HUMAN)


def answer_text(messages: Column) -> Column:
    return _said(messages, GPT)


def system_prompt_column(messages: Column) -> Column:
    first = F.get(messages, F.lit(0))
    return F.when(first["from"] == SYSTEM, first["value"]).otherwise(F.lit(""))


def conversation_line(messages: Column) -> Column:
    """The message array as one JSON text with ``", "`` and ``": "`` separators."""

    def quoted(text: Column) -> Column:
        array = F.to_json(F.array(text))
        return F.substring(array, F.lit(2), F.length(array) - 2)

    parts = F.transform(
        messages,
        lambda m: F.concat(
            F.lit('{"from": '),
            quoted(m["from"]),
            F.lit(', "value": '),
            quoted(m["value"]),
            F.lit("}"),
        ),
    )
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))
