"""Personal data: base patterns and bootstrapped contextual extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import SPACE, narrow
from dialoom.session import stage_table

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the stated patterns: they match the same texts, need no stack on
# long runs, and a run of digits or letters is tried at its start only (or where the
# previous match ended).
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
    r"(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of the number is right."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.element_at(
                F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                F.coalesce(d.cast("int"), F.lit(0)) + 1,
            )
        ),
    )
    total = F.aggregate(each, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(
            r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
        )
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(16, 19) & _luhn(_digits(value))
    return n.between(8, 15)


_CONTEXT_TAIL = 200
_CONTEXT_WORDS = 3
_FLAGS = 1 << 17  # size of the table of context flags: the bound of what is shipped
# a word that holds a digit or an @: what could be an identifier of an unseen form
_MENTION = r"(?<!\S)[\S&&[^0-9@]]*+[0-9@]\S*+"
_SPAN = "struct<start:int,end:int,value:string,context:string>"


def _plain(text: Column) -> Column:
    """Words of a context: lower case, without punctuation that carries no meaning."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}=:#\x20\x09-\x0D]+", "")
    return F.array_remove(F.split(bare, SPACE), "")


def _context(before: Column) -> Column:
    """The words before a span, or null if there are too few."""
    last = _plain(F.substring(before, -_CONTEXT_TAIL, _CONTEXT_TAIL))
    return F.when(
        F.size(last) >= _CONTEXT_WORDS,
        F.array_join(F.slice(last, -_CONTEXT_WORDS, _CONTEXT_WORDS), " "),
    )


def _located(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches with their places in code points and the words before them.

    The pieces between the matches and the matches themselves alternate, so running
    lengths give the places.
    """
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(matches)),
        matches,
        lambda piece, m: F.struct(piece.alias("before"), m.alias("value")),
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found")
    )

    def step(acc, pair):
        first = acc["at"] + F.length(pair["before"])
        end = first + F.length(pair["value"])
        span = F.struct(
            first.alias("start"),
            end.alias("end"),
            pair["value"].alias("value"),
            _context(pair["before"]).alias("context"),
        )
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["found"])
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(none) if needs else found


def _base(text: Column) -> dict[str, Column]:
    needs = {"email": "@", "phone": "+"}

    def of(kind: str) -> Column:
        located = _located(text, _PATTERNS[kind], needs.get(kind))
        return F.filter(located, lambda s: _valid(kind, s["value"]))

    return {kind: of(kind) for kind in KINDS}


def _could_be(kind: str, value: Column) -> Column:
    """Whether an unseen value has the form of the kind, read generously."""
    n = F.length(_digits(value))
    letters = value.rlike(r"\p{L}")
    if kind == "email":
        return F.contains(value, F.lit("@"))
    if kind == "ip":
        return value.rlike(r"^[0-9a-fA-F]+([.:][0-9a-fA-F]*){2,}$") & (n >= 2)
    if kind == "card":
        return n.between(12, 19) & ~letters
    return n.between(6, 15) & ~letters


def _all_kinds(make) -> Column:
    """One array from an array per kind."""
    return F.concat(*[make(kind, number) for number, kind in enumerate(KINDS)])


def _context_totals(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """How often each of ``contexts`` occurs in all texts, whatever follows it.

    A table of flags of fixed size tells the runs of words that cannot be one of them, so
    the shuffle sees few of the others.
    """
    key = F.xxhash64("context")
    table = bytearray(_FLAGS)
    for row in contexts.select(F.pmod(key, F.lit(_FLAGS)).cast("int").alias("at")).distinct().toLocalIterator():
        table[row["at"]] = 1
    flags = F.lit(table)
    tokens = texts.select(_plain(F.col("text")).alias("words")).filter(F.size("words") >= _CONTEXT_WORDS)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("words") - (_CONTEXT_WORDS - 1)),
        lambda i: F.array_join(F.slice("words", i, _CONTEXT_WORDS), " "),
    )
    flagged = F.filter(
        runs,
        lambda p: F.substring(flags, F.pmod(F.xxhash64(p), F.lit(_FLAGS)).cast("int") + 1, F.lit(1))
        == F.lit(bytearray(b"\x01")),
    )
    return (
        tokens.select(F.explode(flagged).alias("context"))
        .groupBy("context")
        .agg(F.count(F.lit(1)).alias("n_all"))
    )


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    min_support: int = 3,
    min_confidence: float = 0.6,
) -> DataFrame:
    """``doc_id, base, added``: spans ``(kind, start, end, value)`` of every row.

    ``base`` has the matches of the stated patterns.  ``added`` is found from contexts:

    * the three words before a base match are a pattern; the pattern is kept if it stands
      before ``min_support`` different base values of a kind;
    * patterns and values form a graph.  In each round the confidence of a pattern is the
      mean confidence of what follows it in the whole corpus, with 0 for ordinary words;
      the confidence of a value is that of its best pattern, or 1 for a base value;
    * words with a digit or an ``@`` that follow a pattern of ``min_confidence`` or more,
      have the form of the kind and touch no base match are added.

    Null and empty texts have no spans.  Every row gives one row; rows with equal id and
    text get equal spans.  Places count code points, the end is exclusive.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    base = _base(F.col("text"))
    found = rows.select("doc_id", "text", *[c.alias(f"b_{k}") for k, c in base.items()])
    tag = lambda kind, number: F.transform(
        f"b_{kind}",
        lambda s: F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["value"].alias("value"), s["context"].alias("context"),
        ),
    )
    located = found.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        _all_kinds(tag).alias("base"),
        F.filter(
            _located(F.col("text"), _MENTION), lambda s: F.length(s["value"]).between(5, 100)
        ).alias("words"),
    )
    free = F.filter(
        "words",
        lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    spans = stage_table(located.withColumn("words", free), "spans")
    known = (
        spans.select(F.explode("base").alias("s"))
        .select("s.kind", "s.value", "s.context")
        .filter("context is not null")
        .groupBy("kind", "context", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    supported = (
        known.groupBy("kind", "context")
        .agg(F.count_distinct("value").alias("n_values"))
        .filter(F.col("n_values") >= min_support)
        .select("kind", "context")
    )
    supported = stage_table(supported, "contexts")
    contexts = supported.select("context").distinct()
    totals = stage_table(_context_totals(rows, contexts), "context-totals")
    unseen = (
        spans.select("doc_id", "text_hash", F.explode("words").alias("s"))
        .select("doc_id", "text_hash", "s.*")
        .join(supported, "context")
        .filter(
            F.element_at(
                F.array(*[_could_be(k, F.col("value")) for k in KINDS]), F.col("kind") + 1
            )
        )
    )
    unseen = stage_table(unseen, "unseen")
    edges = known.join(supported, ["kind", "context"], "left_semi").withColumn(
        "seed", F.lit(1.0)
    ).unionByName(
        unseen.groupBy("kind", "context", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("seed", F.lit(0.0))
    )
    graph = stage_table(edges.withColumn("confidence", F.col("seed")), "graph")
    for number in range(rounds):
        patterns = (
            graph.groupBy("kind", "context")
            .agg(F.sum(F.col("n") * F.col("confidence")).alias("weight"))
            .join(totals, "context")
            .select("kind", "context", (F.col("weight") / F.col("n_all")).alias("pattern"))
        )
        if number == rounds - 1:
            break
        scored = graph.drop("confidence").join(patterns, ["kind", "context"])
        best = scored.groupBy("kind", "value").agg(F.max("pattern").alias("best"))
        graph = stage_table(
            scored.drop("pattern")
            .join(best, ["kind", "value"])
            .select(
                "kind", "context", "value", "n", "seed",
                F.greatest("seed", F.least("best", F.lit(1.0))).alias("confidence"),
            ),
            "graph",
        )
    sure = patterns.filter(F.col("pattern") >= min_confidence).select("kind", "context")
    added = (
        unseen.join(sure, ["kind", "context"], "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("kind", "start", "end", "value")).alias("added"))
        .select(
            F.col("doc_id").alias("a_id"), F.col("text_hash").alias("a_hash"), "added"
        )
    )
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    slim = F.transform(
        "base", lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"])
    ).cast("array<struct<kind:int,start:int,end:int,value:string>>")
    return spans.join(
        added,
        spans["doc_id"].eqNullSafe(added["a_id"]) & (spans["text_hash"] == added["a_hash"]),
        "left",
    ).select("doc_id", slim.alias("base"), F.coalesce("added", empty).alias("added"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by kind and start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )
