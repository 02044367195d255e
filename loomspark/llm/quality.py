"""Quality rules: a decision list learned by sequential covering from labelled statistics.

Each rule is a conjunction of thresholds on statistics of the text. Rules are grown condition by condition on one
part of the labelled sample, pruned on the rest, and accepted if they are precise there; the rows they cover
are set aside, and the next rule is grown. The list is emitted as one ordered Spark conditional.

Nulls: a null text has no words and fails the base rule. Rows without a label, or with a null one, are not
learned from. Without labels only the base rule holds. Rows that are alike get the same verdict. An empty
table gives no rows; other columns of documents pass through where documents are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import packed, small_batches, stage

#: Labelled rows that a list is learned from, at most: those with the least hashes of their ids.
SAMPLE = 6000
MIN_PRECISION, MIN_COVER, MAX_CONDITIONS, MAX_RULES, CUTS = 0.97, 8, 4, 12, 48

BLANK, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_digits", "n_letters", "n_marks", "n_distinct", "longest_word")
#: The statistics that conditions may use.
RATIOS = {
    "words": "CAST(n_words AS DOUBLE)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_ratio": "n_symbols / greatest(word_chars, 1)",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
    "upper_ratio": "n_upper / greatest(n_letters, 1)",
    "digit_ratio": "n_digits / greatest(word_chars, 1)",
    "letter_ratio": "n_letters / greatest(word_chars, 1)",
    "mark_ratio": "n_marks / greatest(n_words, 1)",
    "distinct_ratio": "n_distinct / greatest(n_words, 1)",
    "longest_word": "CAST(longest_word AS DOUBLE)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
}


def _measure(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six ASCII blanks
    n = len(words)
    dense = len(raw.translate(None, BLANK))
    seen: set[bytes] = set()
    lines = [x for x in raw.split(b"\n") if x.translate(None, BLANK)]
    dup = 0
    for x in lines:
        if x in seen:
            dup += 1
        else:
            seen.add(x)
    repeat = 0
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if n > 3:
        a = np.array(ids, dtype=np.int64)
        pairs = a[:-1] * len(number) + a[1:]
        if len(number) < 2_000_000:
            triples = pairs[:-1] * len(number) + a[2:]
        else:  # three ids no longer fit a word
            triples = np.unique(pairs, return_inverse=True)[1][:-1] * len(number) + a[2:]
        order = np.argsort(triples, kind="stable")
        same = triples[order][1:] == triples[order][:-1]
        if same.any():
            twice = np.zeros(len(triples), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(n, bool)
            for k in range(3):
                cover[k : k + len(triples)] |= twice
            repeat = int(cover.sum())
    count = lambda drop: len(raw) - len(raw.translate(None, drop))
    upper = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digits = count(b"0123456789")
    marks = count(b"!?.,;:-_=/\\'\"()[]{}@^~`+")
    symbols = count(SYMBOLS)
    chars = len(text) - (len(raw) - dense)
    letters = max(0, chars - digits - marks - symbols)
    return n, chars, symbols, dup, repeat, len(lines), upper, digits, letters, marks, len(number), max(map(len, number), default=0)


def statistics(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id (whole: all columns, as the struct `row`) and the counts of each row's whole text."""
    names = (*COUNTS, *MORE)
    small_batches(docs.sparkSession)
    rows = docs.select(packed(docs).alias("row")) if whole else docs.select("doc_id", "text")  # a text is sent once
    schema = T.StructType([rows.schema[0], *(T.StructField(c, T.LongType()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text") if whole else batch.column(1)
            counts = [_measure(t or "") for t in texts.to_pylist()]
            columns = zip(*counts, strict=True) if counts else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], [batch.schema.names[0], *names])

    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def column(self) -> Column:
        c = F.expr(RATIOS[self.feature])
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.covers(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray]) -> list[Condition]:
    """Add the condition with the largest gain in information until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best = (1e-9, None, inside)
        for name in x:
            for cut in cuts[name]:
                for above in (True, False):
                    c = Condition(name, above, float(cut))
                    now = inside & c.covers(x)
                    p, n = (now & bad).sum(), (now & ~bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0]:
                            best = (gain, c, now)
        if best[1] is None:
            break
        rule.append(best[1])
        inside = best[2]
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """The ordered rules; each marks rows as bad. Row i is for pruning if i % 3 == 2, else for growing."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    cuts = {k: np.unique(np.quantile(v, np.linspace(0.01, 0.99, CUTS))) if len(v) else v for k, v in x.items()}
    hold = np.arange(len(bad)) % 3 == 2
    of = lambda mask: ({k: v[mask] for k, v in x.items()}, bad[mask])
    while len(rules) < MAX_RULES and (left & bad & ~hold).sum() >= MIN_COVER:
        rule = _grow(*of(left & ~hold), cuts)
        if not rule:
            break
        xp, bp = of(left & hold)

        def worth(n: int, rule=rule, xp=xp, bp=bp) -> tuple[float, int]:
            c = covers(rule[:n], xp, len(bp))
            p, q = (c & bp).sum(), (c & ~bp).sum()
            return ((p - q) / max(p + q, 1), -n)

        rule = rule[: max(range(1, len(rule) + 1), key=worth)]
        c = covers(rule, x, len(bad)) & left
        p, q = (c & bad).sum(), (c & ~bad).sum()
        held = c & hold
        if p < MIN_COVER or p < MIN_PRECISION * (p + q) or (held & bad).sum() < MIN_PRECISION * held.sum():
            break
        rules.append(_widen(rule, *of(left)))
        left &= ~c
    return rules


def _widen(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Move each cut to the middle of the gap between the last good and the first bad value that it parts."""
    out = list(rule)
    for i, c in enumerate(rule):
        others = covers(out[:i] + out[i + 1 :], x, len(bad))
        v, b = x[c.feature][others], bad[others]
        sign = 1 if c.above else -1
        good_side, bad_side = sign * v[~b & (sign * v <= sign * c.cut)], sign * v[b & (sign * v > sign * c.cut)]
        if len(good_side) and len(bad_side):
            out[i] = Condition(c.feature, c.above, float(sign * (good_side.max() + bad_side.min()) / 2))
    return out


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Condition]]:
    """Learn the list from at most `sample` labelled rows (labels: doc_id, quality; 0 is bad)."""
    picked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), "quality").orderBy(F.xxhash64("_id"), "quality").limit(sample)
    rows = stats.where(~base_failed()).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "quality", *[F.expr(e).alias(k) for k, e in RATIOS.items()])
    pdf = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(sample).toPandas()
    return learn({k: pdf[k].to_numpy(float) for k in RATIOS}, pdf["quality"].to_numpy() == 0)


def verdict(rules: list[list[Condition]]) -> Column:
    """The first rule that a row meets (from 1), or null: an ordered conditional."""
    out = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        met = rules[i][0].column()
        for c in rules[i][1:]:
            met = met & c.column()
        out = F.when(met, F.lit(i + 1)).otherwise(out)
    return out


def _judged(stats: DataFrame, labels: DataFrame | None) -> DataFrame:
    rules = fit(stats, labels) if labels is not None else []
    out = stats.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, the counts, base_failed, rule (null: none) and kept for each row."""
    return _judged(stage(statistics(docs), "quality"), labels)


def keep_good(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of docs, with all their columns, that the base rule and the learned list keep."""
    stats = stage(statistics(docs, whole=True), "quality").withColumn("doc_id", F.col("row.doc_id"))
    return _judged(stats, labels).where("kept").select("row.*")
