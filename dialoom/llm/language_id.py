"""Language identification: multinomial logistic regression on character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import narrow

UNKNOWN = "und"
_ORDERS = 3
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_CHUNK = 1 << 16


@dataclass
class LanguageOptions:
    """``rows_per_language`` bounds the sample that the weights are fitted on; document
    frequencies are counted over all training rows."""

    bits: int = 15
    rows_per_language: int = 400
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3
    scale: float = 30.0


@dataclass
class LanguageModel:
    """``table[f, k]``: weight of feature ``f`` for language ``k``, times its idf."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    bits: int = 15
    details: dict = field(default_factory=dict)

    def logits(self, index: np.ndarray) -> np.ndarray:
        total = self.bias.astype(np.float64).copy()
        for start in range(0, len(index), _CHUNK):
            part = self.table[index[start : start + _CHUNK]]
            total += part.sum(axis=0, dtype=np.float64) / len(index)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        index = features(text, self.bits)
        if index is None or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(index) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter(
            (chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1
        )
    return _LETTERS


def features(text: str | None, bits: int) -> np.ndarray | None:
    """Hashed character n-grams of the whole text in lower case, one per position and
    order; what is not a letter ends a word.  None without letters."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one mark after each word
    chars = np.where(letter, points, np.uint32(32))[keep]
    chars = np.concatenate((np.array([32], dtype=np.uint32), chars))
    shift = np.uint32(32 - bits)
    grams = []
    h = np.zeros(len(chars), dtype=np.uint32)
    for order in range(_ORDERS):
        if order >= len(chars):
            break
        h = (h[: len(chars) - order] ^ chars[order:]) * _MULTIPLIERS[order]
        h ^= h >> np.uint32(15)
        grams.append(((h + np.uint32(order)) * np.uint32(0x27D4EB2F)) >> shift)
    return np.concatenate(grams)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _document_frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many of all training rows each feature occurs; counts are added per task
    first, so a task sends one row per feature at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << bits
        total, n = np.zeros(size + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                index = features(text, bits)
                n += 1
                if index is not None:
                    seen = np.zeros(size + 1, dtype=bool)
                    seen[index] = True
                    total += seen
        total[size] = n
        found = np.flatnonzero(total)
        yield pd.DataFrame({"feature": found.astype(np.int32), "n": total[found]})

    counted = (
        texts.mapInPandas(count, "feature int, n bigint")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most 2 ** bits + 1 rows
    )
    df = np.zeros((1 << bits) + 1, dtype=np.int64)
    df[counted["feature"].to_numpy()] = counted["n"].to_numpy()
    return df[:-1], int(df[-1])


def _sample(training: DataFrame, options: LanguageOptions) -> pd.DataFrame:
    """The bounded sample: of each language the rows that come first by hash."""
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = (
        training.withColumn("place", F.xxhash64("doc_id"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= options.rows_per_language)
    )
    bits = options.bits

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                index = features(text, bits)
                found, n = np.unique(
                    np.zeros(0, np.uint32) if index is None else index, return_counts=True
                )
                rows.append((found.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()))
            out = batch[["lang", "place", "calibrates"]].copy()
            out["index"], out["n"] = [r[0] for r in rows], [r[1] for r in rows]
            yield out

    schema = "lang string, place bigint, calibrates boolean, index binary, n binary"
    return chosen.select("lang", "place", "calibrates", "text").mapInPandas(extract, schema).toPandas()


def _ftrl(rows: list, size: int, k: int, o: LanguageOptions) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader: per-coordinate steps; L1 leaves small sums at zero."""
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def weights(at):
        za, na = z[at], n[at]
        w = (np.sign(za) * o.l1 - za) / ((o.beta + np.sqrt(na)) / o.alpha + o.l2)
        return np.where(np.abs(za) <= o.l1, 0.0, w), na

    for _ in range(o.epochs):
        for at, x, label in rows:
            w, na = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1.0
            g = np.outer(x, p)
            squares = na + g * g
            z[at] += g - (np.sqrt(squares) - np.sqrt(na)) / o.alpha * w
            n[at] = squares
    w, _ = weights(slice(None))
    return w[:size], w[size]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Golden-section search for the temperature of least negative log-likelihood."""

    def loss(log_t: float) -> float:
        s = logits / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def train_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    options: LanguageOptions | None = None,
) -> LanguageModel:
    """A model of the rows whose ``remainder`` is not 2 and whose label is not null.

    Rows of remainder 3 in the sample are kept from the weights and set the temperature.
    A table without labelled texts gives a model that answers ``und``.
    """
    o = options or LanguageOptions()
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=label_col)
    rest = remainder(F.col("doc_id"))
    training = rows.filter(F.col("lang").isNotNull() & (rest != 2)).withColumn(
        "calibrates", rest == 3
    )
    df, n_docs = _document_frequencies(training.select("text"), o.bits)
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
    sample = _sample(training, o)
    sample = sample[sample["index"].str.len() > 0].sort_values(["place", "lang"])
    languages = sorted(set(sample["lang"]))
    size = 1 << o.bits
    if not languages:
        empty = np.zeros((size, 0), dtype=np.float32)
        return LanguageModel([], empty, np.zeros(0), 1.0, o.bits)
    fit, calibrate = [], []
    for lang, held, index, n in zip(
        sample["lang"], sample["calibrates"], sample["index"], sample["n"], strict=True
    ):
        at, n = np.frombuffer(index, np.int32), np.frombuffer(n, np.int32)
        x = n / n.sum() * idf[at] * o.scale
        row = (np.append(at, size), np.append(x, 1.0), languages.index(lang))
        (calibrate if held else fit).append(row)
    if not fit:
        fit, calibrate = calibrate, []
    w, bias = _ftrl(fit, size, len(languages), o)
    model = LanguageModel(
        languages, (w * (idf * o.scale)[:, None]).astype(np.float32), bias, 1.0, o.bits,
        {"nonzero": float((w != 0).mean()), "rows": len(fit)},
    )
    if calibrate:
        full = np.vstack([w, bias])
        logits = np.array([x @ full[at] for at, x, _ in calibrate])
        model.temperature = _temperature(logits, np.array([y for *_, y in calibrate]))
    return model


def language_column(model: LanguageModel, text: Column, spark) -> Column:
    """Struct ``lang, score`` of a text column.  The model is shipped once per executor;
    it has ``2 ** bits`` times the number of languages weights, whatever the corpus."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        current = shipped.value
        for batch in batches:
            yield pd.DataFrame([current.predict(t) for t in batch], columns=["lang", "score"])

    return identify(text)


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    options: LanguageOptions | None = None,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, whole texts.

    ``und`` with score 0 where the text is null or has no letter.  Labels, sources and ids
    are no input of a prediction.
    """
    model = train_language_model(docs, id_col, text_col, label_col, options)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 2).alias("held_out"),
        language_column(model, F.col("text"), docs.sparkSession).alias("p"),
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
