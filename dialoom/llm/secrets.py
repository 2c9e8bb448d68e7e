"""Secret scans: base patterns, and a character network over every candidate."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import narrow
from dialoom.session import stage_table

KINDS = ("assign", "access", "hex")
LEARNED = "learned"
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the leftmost longest match
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_DIGIT = re.compile(r"[0-9]")
_SUMMED = 256  # shards whose networks are added up in one group
_SPAN = "struct<start:int,end:int,kind:int>"
_CANDIDATE_TYPE = "struct<start:int,end:int,labelled:boolean,left:string,value:string,right:string>"
_FINDINGS = f"doc_id bigint, base array<{_SPAN}>, candidates array<{_CANDIDATE_TYPE}>"


@dataclass
class SecretOptions:
    """Labels of more than ``balance`` findings weigh alike in training; ``shard`` is about
    the number of findings that one task learns from between two averages."""

    balance: int = 1000
    shard: int = 2048
    left: int = 24
    right: int = 8
    embedding: int = 8
    filters: int = 16
    width: int = 5
    epochs: int = 6
    rate: float = 0.01
    recall: float = 0.98


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the stated patterns, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found)


def candidate_spans(text: str) -> list[tuple[int, int]]:
    """Runs of the characters of secrets that hold a digit or have 20 characters."""
    return [
        m.span()
        for m in _CANDIDATE.finditer(text)
        if m.end() - m.start() >= 20 or _DIGIT.search(m[0])
    ]


def _findings(left: int, right: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, candidates = [], []
            for text in batch["text"]:
                text = text or ""
                spans = base_spans(text)
                rows, k = [], 0
                for start, end in candidate_spans(text):
                    while k < len(spans) and spans[k][1] <= start:
                        k += 1
                    labelled = any(a < end and start < b for a, b, _ in spans[k : k + 3])
                    rows.append(
                        {
                            "start": start,
                            "end": end,
                            "labelled": labelled,
                            "left": text[max(0, start - left) : start],
                            "value": text[start:end],
                            "right": text[end : end + right],
                        }
                    )
                base.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in spans])
                candidates.append(rows)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "candidates": candidates})

    return scan


def _codes(text: str) -> np.ndarray:
    """Printable ASCII keeps its character; space, digits of other scripts and the rest
    share classes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    printable = (points >= 32) & (points < 127)
    return np.where(printable, points - 31, np.where(points < 32, 1, 96)).astype(np.int64)


class CharNetwork:
    """Embedding, one convolution, largest and mean response over the candidate and over
    its context, and a logistic output."""

    def __init__(self, o: SecretOptions, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.o = o
        self.p = {
            "embed": rng.normal(0, 0.3, (97, o.embedding)),
            "conv": rng.normal(0, (2.0 / (o.width * (o.embedding + 1))) ** 0.5,
                               (o.width * (o.embedding + 1), o.filters)),
            "conv_bias": np.zeros(o.filters),
            "out": rng.normal(0, 0.1, 3 * o.filters),
            "out_bias": np.zeros(1),
        }
        self.scale, self.threshold = 1.0, 1.0

    def _forward(self, left: str, value: str, right: str):
        o, p = self.o, self.p
        codes = _codes(left + value + right)
        inside = np.zeros(len(codes))
        inside[len(left) : len(left) + len(value)] = 1.0
        x = np.concatenate((p["embed"][codes], inside[:, None]), axis=1)
        pad = o.width // 2
        padded = np.pad(x, ((pad, pad), (0, 0)))
        columns = np.lib.stride_tricks.sliding_window_view(padded, o.width, axis=0)
        columns = columns.transpose(0, 2, 1).reshape(len(codes), -1)
        hidden = np.maximum(columns @ p["conv"] + p["conv_bias"], 0.0)
        mask = inside > 0
        at_in = np.flatnonzero(mask)[hidden[mask].argmax(axis=0)]
        outside = np.flatnonzero(~mask)
        at_out = outside[hidden[outside].argmax(axis=0)] if len(outside) else None
        wide = np.arange(o.filters)
        pooled = np.concatenate(
            (
                hidden[at_in, wide],
                hidden[mask].mean(axis=0),
                hidden[at_out, wide] if at_out is not None else np.zeros(o.filters),
            )
        )
        return float(pooled @ p["out"] + p["out_bias"][0]), (
            codes, columns, hidden, mask, at_in, at_out, pooled, wide,
        )

    def logit(self, left: str, value: str, right: str) -> float:
        return self._forward(left, value, right)[0]

    def probability(self, left: str, value: str, right: str) -> float:
        z = self.scale * self.logit(left, value, right)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))))

    def _gradients(self, row) -> dict[str, np.ndarray]:
        left, value, right, label = row
        z, (codes, columns, hidden, mask, at_in, at_out, pooled, wide) = self._forward(
            left, value, right
        )
        o, p = self.o, self.p
        dz = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))) - label
        f = o.filters
        dh = np.zeros_like(hidden)
        np.add.at(dh, (at_in, wide), dz * p["out"][:f])
        dh[mask] += dz * p["out"][f : 2 * f] / mask.sum()
        if at_out is not None:
            np.add.at(dh, (at_out, wide), dz * p["out"][2 * f :])
        dh *= hidden > 0
        dcolumns = (dh @ p["conv"].T).reshape(len(codes), o.width, o.embedding + 1)
        pad = o.width // 2
        dx = np.zeros((len(codes) + 2 * pad, o.embedding + 1))
        for k in range(o.width):
            dx[k : k + len(codes)] += dcolumns[:, k]
        dembed = np.zeros_like(p["embed"])
        np.add.at(dembed, codes, dx[pad : pad + len(codes), : o.embedding])
        return {
            "embed": dembed,
            "conv": columns.T @ dh,
            "conv_bias": dh.sum(axis=0),
            "out": dz * pooled,
            "out_bias": np.array([dz]),
        }

    def start(self) -> dict[str, np.ndarray]:
        """Means and squares of Adam and its steps, before the first."""
        zero = {f"{kind}.{k}": np.zeros_like(x) for kind in "mv" for k, x in self.p.items()}
        return zero | {"t": np.zeros(1)}

    def learn(self, rows: list, weights: dict, state: dict, epoch: int, batch: int = 16) -> None:
        """One epoch of Adam over shuffled batches; a row counts by the weight of its label."""
        rng = np.random.default_rng(11)
        for _ in range(epoch + 1):
            order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            chosen = [rows[i] for i in order[start : start + batch]]
            grads = [(weights[r[3]], self._gradients(r)) for r in chosen]
            state["t"] += 1
            t = state["t"][0]
            for k in self.p:
                g = sum(w * x[k] for w, x in grads) / len(grads)
                m = state[f"m.{k}"] = 0.9 * state[f"m.{k}"] + 0.1 * g
                v = state[f"v.{k}"] = 0.999 * state[f"v.{k}"] + 0.001 * g * g
                step = m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                self.p[k] = self.p[k] - self.o.rate * step

    def calibrate(self, rows: list) -> None:
        """``settle`` on the logits of ``rows``."""
        z = np.array([self.logit(*r[:3]) for r in rows])
        y = np.array([r[3] for r in rows], dtype=float)
        self.settle(z, y, np.ones(len(z)), np.ones(len(z)))

    def settle(self, z: np.ndarray, y: np.ndarray, n: np.ndarray, weight: np.ndarray) -> None:
        """Temperature of least log-loss, then a threshold, from ``n`` findings of each of the
        logits ``z``.

        The largest one that keeps the recall on these rows is an upper bound, whatever its
        value.  Where 99 % of what no pattern labels lie below it, the threshold is half way
        between; the rest may well be secrets of an unstated form.
        """
        scales = np.exp(np.linspace(-3, 1, 41))
        losses = [(n * weight * (np.logaddexp(0, z * s) - y * z * s)).sum() for s in scales]
        self.scale = float(scales[int(np.argmin(losses))])

        def ranks(label: int, falling: bool):
            chosen = np.flatnonzero(y == label)
            chosen = chosen[np.argsort(-z[chosen] if falling else z[chosen], kind="stable")]
            ends = np.cumsum(n[chosen])
            return int(ends[-1]) if len(ends) else 0, lambda r: float(
                z[chosen[np.searchsorted(ends, r, side="right")]]
            )

        total, at = ranks(1, True)
        if total:
            cut = at(max(1, math.ceil(self.o.recall * total)) - 1) * self.scale
            others, at = ranks(0, False)
            high = cut
            if others:
                place = 0.99 * (others - 1)
                low, up = at(math.floor(place)), at(math.ceil(place))
                high = (low + (up - low) * (place - math.floor(place))) * self.scale
            cut = min(cut, (cut + high) / 2)
            self.threshold = float(1.0 / (1.0 + np.exp(-np.clip(cut, -50, 50))))


def half_of(value: str) -> int:
    return zlib.crc32(value.encode("utf-8", "surrogatepass")) & 1


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([x.ravel() for x in arrays.values()]).tobytes()


def _unpacked(data: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, x in like.items():
        out[k] = data[at : at + x.size].reshape(x.shape).copy()
        at += x.size
    return out


def _epoch(o: SecretOptions, states: dict[int, bytes], totals: dict, weights: dict, epoch: int):
    """What a shard makes of its half's network in one epoch, by its share of the half."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        half, shard = int(key[0]), int(key[1])
        group = group.sort_values(
            ["labelled", "place", "value", "left", "right"], ascending=[False] + 4 * [True]
        )
        rows = [
            (r.left, r.value, r.right, int(r.labelled)) for r in group.itertuples(index=False)
        ]
        network = CharNetwork(o)
        like = network.p | network.start()
        held = _unpacked(np.frombuffer(states[half]), like)
        network.p = {k: held.pop(k) for k in network.p}
        # a value is what it is without its surroundings too
        network.learn(rows + [("", r[1], "", r[3]) for r in rows], weights, held, epoch)
        share = len(rows) / totals[half]
        made = {k: share * x for k, x in (network.p | held).items()}
        return pd.DataFrame({"half": [half], "shard": [shard], "state": [_packed(made)]})

    return run


def _sum_states(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Sum over neighbouring shards, in their order so that reruns agree."""
    total = 0.0
    for state in group.sort_values("shard")["state"]:
        total = total + np.frombuffer(state)
    return pd.DataFrame({"half": [key[0]], "shard": [key[1]], "state": [total.tobytes()]})


def _logits(shipped):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = [
                shipped.value[1 - r.half].logit(r.left, r.value, r.right)
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame({"half": batch["half"], "labelled": batch["labelled"], "z": z})

    return run


def train_networks(found: DataFrame, options: SecretOptions) -> list[CharNetwork] | None:
    """Two networks from all distinct findings, or None if a half has one label only.

    The findings are halved by value.  Each network is fitted on one half and calibrated on
    the other, and scores the values of the other: a secret of an unstated form, which the
    patterns label as none, is never judged by a network that learnt that label.

    A half is dealt into shards by hash.  In each epoch every shard goes on from the average
    of the last one, networks and moments of Adam, so the driver holds some averages and no
    findings, and reruns agree whatever the partitions.  Calibration counts the logits of
    the whole other half on a grid of 1/1024.
    """
    o, spark = options, found.sparkSession
    flat = found.select(F.explode("candidates").alias("c")).select("c.*")
    # equal findings count once, so a copied text does not weigh more
    distinct = flat.select("labelled", "left", "value", "right").distinct()
    rows = stage_table(
        distinct.withColumns(
            {
                "place": F.xxhash64("left", "value", "right"),
                "half": F.crc32(F.col("value")).bitwiseAND(F.lit(1)).cast("int"),
            }
        ),
        "training",
    )
    counts = {(r.half, int(r.labelled)): r["count"] for r in rows.groupBy("half", "labelled").count().collect()}
    if len(counts) < 4:
        return None
    totals = {half: counts[half, 0] + counts[half, 1] for half in (0, 1)}
    of_label = {label: counts[0, label] + counts[1, label] for label in (0, 1)}
    weights = {label: min(1.0, o.balance / n) for label, n in of_label.items()}
    weights = {label: w / max(weights.values()) for label, w in weights.items()}
    shards = {half: -(-n // o.shard) for half, n in totals.items()}
    of_half = F.when(F.col("half") == 0, shards[0]).otherwise(shards[1]).cast("long")
    # by number, as the tables are small for their work
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("place"), of_half)).repartition(
        sum(shards.values()), "half", "shard"
    )
    schema = "half int, shard bigint, state binary"
    networks = [CharNetwork(o), CharNetwork(o)]
    like = networks[0].p | networks[0].start()
    states = {half: _packed(like) for half in (0, 1)}
    for epoch in range(o.epochs):
        learned = dealt.groupBy("half", "shard").applyInPandas(
            _epoch(o, states, totals, weights, epoch), schema
        )
        neighbours = F.floor(F.col("shard") / _SUMMED).alias("part")
        summed = learned.groupBy("half", neighbours).applyInPandas(_sum_states, schema)
        parts = summed.collect()
        for half in (0, 1):
            mine = sorted((r.shard, r.state) for r in parts if r.half == half)
            states[half] = sum(np.frombuffer(state) for _, state in mine).tobytes()
    for half, network in enumerate(networks):
        held = _unpacked(np.frombuffer(states[half]), like)
        network.p = {k: held[k] for k in network.p}
    scored = rows.repartition(sum(shards.values()), "place").mapInPandas(
        _logits(spark.sparkContext.broadcast(networks)), "half int, labelled boolean, z double"
    )
    grid = F.floor(F.least(F.greatest("z", F.lit(-50.0)), F.lit(50.0)) * 1024).alias("grid")
    bins = scored.groupBy("half", "labelled", grid).agg(
        F.min("z").alias("z"), F.count(F.lit(1)).alias("n")
    )
    held_out = bins.toPandas()  # 102,400 rows a half and label at most
    for half, network in enumerate(networks):
        # of a grid step the least logit, so that the recall is kept
        mine = held_out[held_out["half"] == 1 - half].sort_values(["labelled", "z"])
        y = mine["labelled"].to_numpy().astype(int)
        weight = np.where(y == 1, weights[1], weights[0])
        network.settle(mine["z"].to_numpy(), y, mine["n"].to_numpy(), weight)
    return networks


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    options: SecretOptions | None = None,
) -> DataFrame:
    """``doc_id, base, added`` with spans ``(start, end, kind)``; ``added`` also has ``score``.

    ``base`` has the matches of the stated patterns.  A network sees every candidate with
    the characters around it; candidates that touch no base match and score at least the
    threshold are added.  Texts are read once: base spans and candidates are written, training
    and scoring both use that table.  Null and empty texts have no
    spans, every row gives one row, places count code points, ends are exclusive.
    """
    o = options or SecretOptions()
    rows = narrow(docs, doc_id=id_col, text=text_col)
    schema = _FINDINGS.replace("bigint", rows.schema["doc_id"].dataType.simpleString(), 1)
    found = stage_table(rows.mapInPandas(_findings(o.left, o.right), schema), "findings")
    networks = train_networks(found, o)
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(networks)

    @F.pandas_udf("array<struct<start:int,end:int,score:double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        current = shipped.value
        for batch in batches:
            out = []
            for candidates in batch:
                kept = []
                for c in candidates if current is not None else ():
                    if not c["labelled"]:
                        network = current[1 - half_of(c["value"])]
                        p = network.probability(c["left"], c["value"], c["right"])
                        if p >= network.threshold:
                            kept.append({"start": c["start"], "end": c["end"], "score": p})
                out.append(kept)
            yield pd.Series(out)

    return found.select("doc_id", "base", score("candidates").alias("added"))


def base_text(base: Column) -> Column:
    """``kind:start:end`` by start and kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, LEARNED)])
    ordered = F.array_sort(
        F.transform(base, lambda s: F.struct(s["start"], s["kind"], s["end"])).cast(
            "array<struct<start:int,kind:int,end:int>>"
        )
    )
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def all_text(base: Column, added: Column) -> Column:
    learned = F.transform(
        added,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(len(KINDS)).alias("kind")
        ),
    ).cast(f"array<{_SPAN}>")
    return base_text(F.concat(base, learned))
