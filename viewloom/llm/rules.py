"""Learned decision lists of quality rules.

Text statistics are computed once per document.  From the statistics of labelled documents, sequential covering grows conjunctions of
thresholds for label 0 (each condition by the largest information gain), prunes their last conditions on rows kept aside, and takes the rule's rows out
before the next one is grown.  The list is an ordered chain of Spark ``when`` expressions over the statistics' columns; a document that
no rule covers is kept.

Defined results: null and empty texts have all statistics 0 and fail the base rules (fewer than ten words); repeated rows are judged each on their own; null labels are
ignored; without labelled rows of both kinds the list is empty; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.text import _SPACE, _hash_spans, column_bytes, narrow, sample, slices, windows, word_spans

LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbols_per_word", "pipes_per_word", "shouts_per_word", "upper_share", "digit_share", "distinct_share", "repeat_share", "dup_line_share", "chars_per_word", "stops_per_word"]
SYMBOLS = b"#*$%&|<>"


def _table(chosen: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chosen)] = 1
    return out


_CLASSES = {
    "symbols": _table(SYMBOLS),
    "pipes": _table(b"|"),
    "shouts": _table(b"!"),
    "stops": _table(b".,;:?"),
    "upper": _table(bytes(range(65, 91))),
    "digits": _table(bytes(range(48, 58))),
    "word_chars": np.array([not _SPACE[b] and (b & 0xC0) != 0x80 for b in range(256)], np.int64),
}


def repeats(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: words inside 5-word windows that the row holds twice or more, and distinct words."""
    n = np.diff(at)
    runs, starts = windows(values, at)
    covered = np.zeros(len(values) + 1, np.int64)
    counts = np.zeros(len(n), np.int64)
    for i in np.flatnonzero(n):
        counts[i] = len(np.unique(values[at[i] : at[i + 1]]))
        if n[i] < 6:
            continue
        own = runs[starts[i] : starts[i + 1]]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        if same.any():
            twice = np.zeros(len(own), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            first = at[i] + np.flatnonzero(twice)
            np.add.at(covered, first, 1)
            np.add.at(covered, np.minimum(first + 5, len(values)), -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return inside[at[1:]] - inside[at[:-1]], counts


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines)), len(lines)


def statistics(docs: DataFrame, columns: list[str | Column], text: str = "text") -> DataFrame:
    """The named columns and the statistics ``LONGS`` and ``RATIOS`` of every whole text."""
    narrow(docs.sparkSession)
    chosen = docs.select(*columns, F.col(text).alias("_text"))
    schema = T.StructType([*chosen.schema.fields[:-1], *(T.StructField(x, T.LongType()) for x in LONGS), *(T.StructField(x, T.DoubleType()) for x in RATIOS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            raw, at = column_bytes(batch.column(batch.num_columns - 1))
            start, end = word_spans(raw, at)
            words_at = np.searchsorted(start, at)
            n = np.diff(words_at)
            sums = {}
            for name, of in _CLASSES.items():
                total = np.concatenate([[0], np.cumsum(of[raw])])
                sums[name] = total[at[1:]] - total[at[:-1]]
            repeated, kinds = repeats(_hash_spans(raw, start, end, False), words_at)
            body = raw.tobytes()
            lines = np.array([dup_lines(body[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]).reshape(-1, 2)
            some, chars = np.maximum(n, 1), np.maximum(sums["word_chars"], 1)
            longs = [n, sums["word_chars"], sums["symbols"], lines[:, 0], repeated]
            ratios = [sums["symbols"] / some, sums["pipes"] / some, sums["shouts"] / some, sums["upper"] / chars, sums["digits"] / chars, kinds / some]
            ratios += [repeated / some, lines[:, 0] / np.maximum(lines[:, 1], 1), sums["word_chars"] / some, sums["stops"] / some]
            yield pa.record_batch([*batch.columns[:-1], *(pa.array(x, pa.int64()) for x in longs), *(pa.array(x, pa.float64()) for x in ratios)], names=schema.names)

    return chosen.mapInArrow(run, schema)


@dataclass
class Rule:
    """A conjunction of (column, at_least, threshold) for label 0, with what it covered when pruned: (label 0, label 1)."""

    conditions: list[tuple[str, bool, float]]
    covered: tuple[int, int] = (0, 0)

    def column(self) -> Column:
        parts = [F.col(c) >= F.lit(t) if up else F.col(c) <= F.lit(t) for c, up, t in self.conditions]
        out = parts[0]
        for x in parts[1:]:
            out &= x
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c} {'>=' if up else '<='} {t:.4g}" for c, up, t in self.conditions)


def _covers(rule: list[tuple[int, bool, float]], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c, up, t in rule:
        out &= x[:, c] >= t if up else x[:, c] <= t
    return out


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], most: int) -> list[tuple[int, bool, float]]:
    rule: list[tuple[int, bool, float]] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most:
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        if not n or not p:
            break
        now, best = np.log2(p / (p + n)), (1e-9, None)
        for c, values in enumerate(cuts):
            own, own_bad = x[inside, c], bad[inside]
            order = np.argsort(own)
            sorted_x, run = own[order], np.concatenate([[0], np.cumsum(own_bad[order])])
            for up in (True, False):
                k = np.searchsorted(sorted_x, values, "left" if up else "right")
                pos = p - run[k] if up else run[k]
                total = len(own) - k if up else k
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / np.maximum(total, 1)) - now), 0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (c, up, float(values[i])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers([best[1]], x)
    return rule


def learn(x: np.ndarray, label: np.ndarray, names: list[str], most_rules: int = 16, most_conditions: int = 4, least_precision: float = 0.75, least_cover: int = 5, bins: int = 64, seed: int = 0) -> list[Rule]:
    """Sequential covering of label 0: grow on two thirds, prune on one third, stop at the first rule that is not precise enough."""
    rng = np.random.default_rng(seed)
    bad, rules = label == 0, []
    while len(rules) < most_rules and bad.sum() >= 2 * least_cover and (~bad).any():
        part = rng.permutation(len(x)) % 3 < 2
        cuts = [np.unique(np.quantile(np.concatenate([x[part & bad, c], x[part, c]]), np.linspace(0, 1, bins))) for c in range(x.shape[1])]
        rule = _grow(x[part], bad[part], cuts, most_conditions)
        if not rule:
            break
        held, held_bad = x[~part], bad[~part]
        worth = []
        for k in range(1, len(rule) + 1):
            inside = _covers(rule[:k], held)
            p, n = int((held_bad & inside).sum()), int((~held_bad & inside).sum())
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        value, k, p, n = max(worth)
        if p < least_cover / 2 or p < least_precision * (p + n):
            break
        rule = rule[:-k]
        inside = _covers(rule, x)
        rules.append(Rule([(names[c], up, t) for c, up, t in rule], (p, n)))
        x, bad = x[~inside], bad[~inside]
    return rules


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, seed: int = 0) -> list[Rule]:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label): a seeded sample of at most ``most`` labelled ids."""
    ids = sample(labels.where("label in (0, 1)"), most, seed).dropDuplicates(["doc_id"])
    # an id that stands in many rows gives its smallest text alone, so the sample is bounded in rows too
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    rows = statistics(texts, ["doc_id", "label"]).collect()
    rows = [r for r in rows if not (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])]
    if not rows:
        return []
    rows.sort(key=lambda r: (r["doc_id"], r["n_words"]))
    names = [*RATIOS, "n_words"]
    return learn(np.array([[float(r[c]) for c in names] for r in rows]), np.array([r["label"] for r in rows]), names, seed=seed)


def verdict(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that holds; null where none does."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(rules[0].column(), F.lit(1))
    for i, rule in enumerate(rules[1:], 2):
        out = out.when(rule.column(), F.lit(i))
    return out
