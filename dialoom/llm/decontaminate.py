"""Benchmark decontamination by templates with typed slots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.base import let
from dialoom.llm.common import narrow
from dialoom.session import stage_table

#: Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs day days week weeks "
    "month months year years hour hours minute minutes second seconds meter meters metre "
    "metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "dollar dollars cent cents euro euros usd eur gbp percent degrees celsius mph kmh "
    "watt watts volt volts joule joules newton newtons"
).split()

_NAME = "\u0001"
_JOIN = "\u0002"  # between the words of one slot
#: Bytes of the table of window flags: 128 per window of the benchmark within these bounds.
_MIN_FLAGS, _MAX_FLAGS = 1 << 18, 1 << 24
_PROBES = (0, 20, 40)  # bits of a hash where its three places in the table are taken from
#: How capitalised words are read: as names inside a sentence only, or everywhere, with
#: the words of one name, or a number and its unit, in one slot.
INSIDE, EVERYWHERE = 0, 1
_PLAIN, _CAPITAL, _NUMBER, _UNIT = range(4)


_GLUED = rf"^\p{{N}}++({'|'.join(UNITS)})$"


def _words(text: Column) -> Column:
    """Per word with a letter or number: ``w`` as it stands, ``p`` in lower case without
    punctuation, the hash ``h`` of ``p``, and its kind ``k``.  Most words are plain lower-case
    ones, which take the short way everywhere."""

    def word(w: Column, p: Column, kind: Column) -> Column:
        return F.struct(
            w.alias("w"), p.alias("p"), F.xxhash64(p).alias("h"), kind.cast("int").alias("k")
        )

    def unit(p: Column) -> Column:
        return F.when(p.isin(*UNITS), F.lit(_UNIT)).otherwise(F.lit(_PLAIN))

    def other(w: Column, p: Column) -> Column:
        capital = w.rlike(r"^[\"'(]?\p{Lu}\p{Ll}")
        number = p.rlike(r"^\p{N}")
        return word(w, p, F.when(capital, _CAPITAL).when(number, _NUMBER).otherwise(unit(p)))

    def read(w: Column) -> Column:
        stripped = F.lower(F.regexp_replace(w, r"[^\p{L}\p{M}\p{N}]+", ""))
        return F.when(w.rlike(r"^\p{Ll}++$"), word(w, w, unit(w))).otherwise(
            let(stripped, lambda p: other(w, p))
        )

    # one plain character is split without a pattern; empty pieces have no letter and go
    spaced = reduce(
        lambda t, space: F.replace(t, F.lit(space), F.lit(" ")),
        "\t\n\x0b\x0c\r",
        F.coalesce(text, F.lit("")),
    )
    return F.filter(F.transform(F.split(spaced, " "), read), lambda x: x["p"] != "")


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _is_unit(words: Column, i: Column) -> Column:
    """Whether the word at ``i`` is a unit of the bare number before it; ``in`` before a
    number or a name is no inch."""
    w, before, after = F.get(words, i), F.get(words, i - 1), F.get(words, i + 1)
    bare = _is((before["k"] == _NUMBER) & before["p"].rlike(r"^\p{N}++$"))
    inch = (w["p"] != "in") | ~_is(after["k"].isin(_NUMBER, _CAPITAL))
    return _is(w["k"] == _UNIT) & bare & inch


def _inside(words: Column, name: Column, number: Column, unit: Column, plain: str) -> Column:
    """The words of the first reading: what is given for a slot, a field for a plain word."""

    def word(w: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        ends = F.substring(before["w"], -1, 1).isin(*".!?:;")
        inner = (i > 0) & ~_is(ends)
        return (
            F.when(w["k"] == _PLAIN, w[plain])
            .when(w["k"] == _CAPITAL, F.when(inner, name).otherwise(w[plain]))
            .when(w["k"] == _NUMBER, number)
            .otherwise(F.when(_is(before["k"] == _NUMBER), unit).otherwise(w[plain]))
        )

    return F.transform(words, word)


def _everywhere(words: Column, name: Column, number: Column, plain) -> Column:
    """The words of the second reading, with null for those that stand in the slot before
    them: a name after a name, a unit, a further number with unit."""

    def word(w: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        # no punctuation between them
        same_name = (
            _is((before["k"] == _CAPITAL) & before["w"].rlike(r"[\p{L}\p{M}\p{N}]$"))
            & w["w"].rlike(r"^\p{L}")
        )
        measure = w["p"].rlike(_GLUED) | _is_unit(words, i + 1)
        after_measure = _is_unit(words, i - 1) | _is(
            (before["k"] == _NUMBER) & before["p"].rlike(_GLUED)
        )
        return (
            F.when(w["k"] == _PLAIN, plain(w, i))
            .when(w["k"] == _CAPITAL, F.when(~same_name, name))
            .when(w["k"] == _NUMBER, F.when(~(measure & after_measure), number))
            .otherwise(F.when(~_is_unit(words, i), plain(w, i)))
        )

    return F.transform(words, word)


def _values(words: Column, starts: Column) -> Column:
    """The words of each slot of the second reading, joined; a unit stands at its number."""
    pieces = F.transform(
        words,
        lambda w, i: F.concat(
            F.when(_is_unit(words, i), F.lit("")).otherwise(F.lit(_JOIN)),
            F.when(w["k"] == _CAPITAL, F.lit(_NAME)).otherwise(F.lit("")),
            w["p"],
        ),
    )
    return let(
        pieces,
        lambda made: F.transform(
            starts,
            lambda at, k: F.substring(
                F.array_join(
                    F.slice(made, at + 1, F.coalesce(F.get(starts, k + 1), F.size(words)) - at), ""
                ),
                2,
                1 << 30,
            ),
        ),
    )


def _read(text: Column, values: bool) -> Column:
    """Struct of both readings of a text: hashes ``h0``, ``h1`` of the template's words,
    and with ``values`` the words ``tpl0``, ``tpl1`` and what stands for them, ``raw0``,
    ``raw1``."""
    slots = [F.lit(s) for s in ("<name>", "<num>", "<unit>")]
    hashes = [F.xxhash64(s) for s in slots]

    def fields(words: Column) -> Column:
        second = _everywhere(words, hashes[0], hashes[1], lambda w, i: w["h"])
        made = [
            _inside(words, *hashes, "h").alias("h0"),
            F.array_compact(second).alias("h1"),
        ]
        if values:
            named = F.transform(
                words, lambda w: F.concat(F.lit(_NAME), w["p"])
            )
            first = _inside(words, *slots, "p")
            raw = F.zip_with(
                F.zip_with(first, named, lambda t, n: F.when(t == "<name>", n)),
                words,
                lambda n, w: F.coalesce(n, w["p"]),
            )
            templates = _everywhere(words, *slots[:2], lambda w, i: w["p"])
            starts = F.filter(
                F.transform(templates, lambda t, i: F.when(t.isNotNull(), i)), lambda i: i.isNotNull()
            )
            made += [
                first.alias("tpl0"),
                raw.alias("raw0"),
                F.array_compact(templates).alias("tpl1"),
                let(starts, lambda at: _values(words, at)).alias("raw1"),
            ]
        return F.struct(*made)

    return let(_words(text), fields)


def _run_hashes(hashes: Column, n: int) -> Column:
    """Hash of the ``n`` words from each word on, from those of halves: the words' hashes,
    shifted by their place, joined by exclusive or.  The last ``n - 1`` mean nothing."""
    if n == 1:
        return hashes
    half = 1 << ((n - 1).bit_length() - 1)

    def joined(left: Column, right: Column) -> Column:
        return F.transform(
            left, lambda h, i: F.shiftleft(h, n - half).bitwiseXOR(F.get(right, i + half))
        )

    def rest(left: Column) -> Column:
        return joined(left, left) if n == 2 * half else let(_run_hashes(hashes, n - half), lambda r: joined(left, r))

    return let(_run_hashes(hashes, half), rest)


def _window_hashes(hashes: Column, n: int) -> Column:
    """Hash of the ``n`` words from each word on, as far as there are ``n``."""
    return let(
        hashes,
        lambda h: F.slice(_run_hashes(h, n), F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0))),
    )


def _candidates(rows: DataFrame, width: int, short: list[int], flags: tuple[Column, int]) -> DataFrame:
    """The rows with a window that may be one of the benchmark's."""

    def any_window(read: Column, table: Column) -> Column:
        made = [(read["h0"], width), (read["h1"], width)] + [(read["h0"], n) for n in short]
        found = [
            F.exists(_window_hashes(h, n), lambda x: _flag_set((table, flags[1]), x)) for h, n in made
        ]
        return reduce(lambda a, b: a | b, found)

    # the table stands in the plan once
    test = let(flags[0], lambda table: let(_read(F.col("text"), False), lambda r: any_window(r, table)))
    return rows.filter(test)


def _windows(
    rows: DataFrame, width: int, short: list[int], keep: tuple[Column, int] | None = None
) -> DataFrame:
    """``(..., reading, n_tokens, pos, h)``: one row per window of either template, of those
    ``keep`` allows.  Windows of the widths ``short`` are made of the first reading."""
    # exploded, so that each of its fields does not read the text again
    read = F.explode(F.array(_read(F.col("text"), True))).alias("read")
    split = rows.select(*rows.drop("text").columns, read)

    def found(r: int, n: int) -> Column:
        windows = F.transform(
            _window_hashes(F.col(f"read.h{r}"), n),
            lambda h, i: F.struct(
                F.lit(r).alias("reading"), F.lit(n).alias("n"), (i + 1).alias("pos"), h.alias("h")
            ),
        )
        return windows

    def of(name: str) -> Column:
        return F.when(F.col("w.reading") == INSIDE, F.col(f"read.{name}{INSIDE}")).otherwise(
            F.col(f"read.{name}{EVERYWHERE}")
        )

    made = F.concat(
        *[found(r, width) for r in (INSIDE, EVERYWHERE)], *[found(INSIDE, n) for n in short]
    )
    if keep is not None:
        every = made
        made = let(
            keep[0], lambda table: F.filter(every, lambda w: _flag_set((table, keep[1]), w["h"]))
        )
    return split.withColumn("w", F.explode(made)).select(
        *rows.drop("text").columns,
        "w.reading",
        F.size(of("tpl")).alias("n_tokens"),
        F.col("w.pos").alias("pos"),
        F.col("w.h").alias("h"),
        F.slice(of("raw"), F.col("w.pos"), F.col("w.n")).alias("raw"),
        F.slice(of("tpl"), F.col("w.pos"), F.col("w.n")).alias("tpl"),
    )


def _first_word_either_way(windows: DataFrame, widths: Sequence[int]) -> DataFrame:
    """The windows, and those at the start of an item with its first word read the other
    way: whether it is marked depends on what stands before it."""
    word, rest = F.col("raw")[0], lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    named = F.col("tpl")[0] == "<name>"
    words = F.transform("tpl", lambda t: F.xxhash64(t))
    whole = F.coalesce(*[F.when(F.size("tpl") == n, F.get(_window_hashes(words, n), F.lit(0))) for n in widths])
    other = (
        windows.filter(
            (F.col("pos") == 1)
            & (named | ~F.col("tpl")[0].startswith("<"))
            & ~F.contains(word, F.lit(_JOIN))
        )
        .withColumn("first", F.when(named, F.substring(word, 2, 1 << 30)).otherwise(F.concat(F.lit(_NAME), word)))
        .withColumn("tpl", F.concat(F.array(F.when(named, F.col("first")).otherwise(F.lit("<name>"))), rest("tpl")))
        .withColumn("raw", F.concat(F.array("first"), rest("raw")))
        .withColumn("h", whole)
        .drop("first")
    )
    return windows.withColumn("turned", F.lit(False)).unionByName(
        other.withColumn("turned", F.lit(True))
    )


def _places(h: Column, size: int) -> list[Column]:
    return [
        (F.shiftright(h, bits) if bits else h).bitwiseAND(F.lit(size - 1)).cast("int")
        for bits in _PROBES
    ]


def _flag_set(flags: tuple[Column, int], h: Column) -> Column:
    """Whether all places of a hash are flagged."""
    table, size = flags
    hits = [F.substring(table, at + 1, F.lit(1)) == F.lit(bytearray(b"\x01")) for at in _places(h, size)]
    return reduce(lambda a, b: a & b, hits)


def _flag_table(bench: DataFrame) -> tuple[Column, int]:
    """The table as a literal, and its size."""
    n = bench.count()
    size = _MIN_FLAGS
    while size < min(128 * n, _MAX_FLAGS):
        size *= 2
    table = bytearray(size)
    at = bench.select(F.explode(F.array(*_places(F.col("h"), size))).alias("at")).distinct()
    for row in at.toLocalIterator():  # at most as many numbers as the table has bytes
        table[row["at"]] = 1
    return F.lit(table), size


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 8,
    min_words: int = 13,
    short_items: bool = False,
) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names or units.

    Returns ``doc_id, item_id, n_windows, n_item_windows, n_slots, n_changed``, one row per
    pair.  A template window is ``width`` words with typed placeholders.  Texts are read
    twice: with capitalised words as names inside sentences only, and with every capitalised
    word as a name, where the words of a name, and a number with its unit, are one slot.
    A document and an item match along a diagonal of one reading (document position minus
    item position).  The pair is reported if on one diagonal

    * the windows cover ``min_words`` words, or the whole item if that is shorter, and
    * the slots are consistent: along the diagonal each value of the item stands for one
      value in the document, and the other way round.

    Windows made of slots only carry no words of the item, and are left out.  The first word
    of an item matches itself whether it is read as a name or not.  Null and empty texts
    match nothing, nor do items shorter than a window; with ``short_items`` these have one
    window of their whole length, in the first reading.  Rows of one id with different texts
    are judged apart, and the pair with the most windows is reported.

    The windows of the benchmark are written once.  A first pass over the documents hashes
    words and windows and keeps the texts with a window in a table of flags: 128 bytes per
    window of the benchmark, at most 16 MB, asked at three places, so that about one window
    in 75,000 passes wrongly (more beyond 130,000 windows, which costs time and no result).
    Only these texts are read with their values, and only their flagged windows are joined,
    by hash and words.
    """
    items = narrow(benchmark, item_id=item_col, text=item_text_col)
    plain = F.filter("tpl", lambda t: ~t.startswith("<"))
    made = _windows(items, width, [])
    if short_items:
        whole = _windows(items, width, list(range(1, width))).filter(
            (F.size("tpl") < width) & (F.size("tpl") == F.col("n_tokens"))
        )
        made = made.unionByName(whole)
    bench = stage_table(
        _first_word_either_way(
            made.filter(F.size(plain) > 0), range(1 if short_items else width, width + 1)
        ).filter(F.size(plain) > 0),
        "bench",
    )
    widths = bench.select(F.size("tpl").alias("n")).distinct().collect()  # width at most
    short = sorted(r["n"] for r in widths if r["n"] < width)
    sizes = bench.groupBy("item_id", "reading").agg(
        F.count_distinct("pos").alias("n_item_windows")
    )
    flags = _flag_table(bench)
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("content", F.xxhash64("text"))
    # texts without a flagged window, nearly all, end here; the others are read once more
    chosen = stage_table(_candidates(rows, width, short, flags), "candidates")
    windows = _windows(chosen, width, short, flags)
    left = windows.select(
        "doc_id", "content", "reading", F.col("pos").alias("doc_pos"), "h", "tpl", F.col("raw").alias("doc_raw")
    )
    right = bench.select(
        "item_id", "reading", "n_tokens", F.col("pos").alias("item_pos"), "h", "tpl", "raw", "turned"
    )
    # a word that is a name for its place only stands for itself
    itself = (F.col("doc_raw")[0] == F.col("raw")[0]) | F.endswith(
        F.col("doc_raw")[0], F.concat(F.lit(_JOIN + _NAME), F.substring(F.col("raw")[0], 2, 1 << 30))
    )
    # a name at either end of the item may have run together with its neighbours
    at_end = lambda s: (s["at"] == 1) | (s["at"] == F.col("n_tokens"))
    hits = left.join(right, ["reading", "h", "tpl"]).filter(~F.col("turned") | itself).select(
        "doc_id",
        "content",
        "item_id",
        "reading",
        (F.col("doc_pos") - F.col("item_pos")).alias("diagonal"),
        "item_pos",
        F.filter(
            F.transform(
                F.arrays_zip("tpl", "raw", "doc_raw"),
                lambda s, i: F.struct(
                    (F.col("item_pos") + i).alias("at"),
                    s["tpl"].alias("type"),
                    s["raw"].alias("item_value"),
                    s["doc_raw"].alias("doc_value"),
                ),
            ),
            lambda s: s["type"].startswith("<")
            & ~(at_end(s) & F.contains(s["doc_value"], F.lit(_JOIN)) & (s["item_value"] != s["doc_value"])),
        ).alias("slots"),
    )
    hits = stage_table(hits, "hits")
    key = ["doc_id", "content", "item_id", "reading", "diagonal"]
    covered = hits.groupBy(*key).agg(F.count_distinct("item_pos").alias("n_windows"))
    slots = hits.select(*key, F.explode("slots").alias("s")).select(*key, "s.*").distinct()
    pairs = slots.groupBy(*key, "type", "item_value").agg(
        F.count_distinct("doc_value").alias("fan"),
        F.max("doc_value").alias("doc_value"),
        F.count(F.lit(1)).alias("n"),
    )
    back = pairs.groupBy(*key, "type", "doc_value").agg(
        F.max("fan").alias("fan"),
        F.count(F.lit(1)).alias("back_fan"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("item_value") != F.col("doc_value"), F.col("n")).otherwise(0)).alias(
            "changed"
        ),
    )
    checked = back.groupBy(*key).agg(
        F.max(F.greatest("fan", "back_fan")).alias("worst"),
        F.sum("n").alias("n_slots"),
        F.sum("changed").alias("n_changed"),
    )
    renamed = checked.select(
        *[F.col(c).alias(f"c_{c}") for c in key], "worst", "n_slots", "n_changed"
    )
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in key]
    needed = F.least(F.lit(min_words - width + 1), F.col("n_item_windows"))
    good = (
        covered.join(renamed, same, "left")
        .join(
            sizes.select(F.col("item_id").alias("s_item"), F.col("reading").alias("s_reading"), "n_item_windows"),
            F.col("item_id").eqNullSafe(F.col("s_item")) & (F.col("reading") == F.col("s_reading")),
        )
        .filter((F.col("n_windows") >= needed) & (F.coalesce(F.col("worst"), F.lit(1)) <= 1))
    )
    best = F.max(
        F.struct(
            "n_windows",
            (-F.col("reading")).alias("order"),
            "n_item_windows",
            F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
            F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
        )
    )
    return good.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", *[f"best.{c}" for c in ("n_windows", "n_item_windows", "n_slots", "n_changed")]
    )
