"""Quality rules: fixed base counts, then a decision list learned by sequential covering.

Words are runs of characters other than the six white space characters.
``text_counts`` computes the counts of whole texts in tasks. ``learn`` grows
and prunes one conjunction of thresholds after another on labelled rows: a rule
takes the condition with the best gain until it covers no good row of the
growing part, drops conditions from the end as long as that does not hurt on
the pruning part, and the rows it covers are set aside. Rules that do not hold
on the pruning part end the list. ``verdict`` is the list as one Spark
expression: the first rule that fires rejects, everything else is kept.

The labelled sample is bounded: at most ``sample_rows`` labelled ids, chosen by
their hash. A missing text counts as empty; a text without words has
zero rates. Without labelled rows of both kinds the list is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import labelled_sample, narrow
from foliar.llm._text import SPACE, blocks, grams, mix, words

SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.95
MIN_COVER = 4
REPEAT_WORDS = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_ends"]
# Statistics the rules may use, as SQL over the counts.
STATISTICS = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "ends_per_word": "n_ends / greatest(n_words, 1)",
    "n_words": "n_words",
}

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_MARK = np.zeros(256, dtype=np.int64)
_MARK[list(b"!?")] = 1
_END = np.zeros(256, dtype=np.int64)
_END[list(b".,;:")] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[ord("A") : ord("Z") + 1] = 1
_WORD_CHAR = (~SPACE).astype(np.int64)
_WORD_CHAR[0x80:0xC0] = 0  # continuation bytes


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(w, texts: int, size: int = REPEAT_WORDS) -> np.ndarray:
    """Per text the number of words in runs of ``size`` words found twice or more in it."""
    h, at = grams(w, size)
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    if len(h):
        h = mix(h ^ mix(w.text[at].astype(np.uint64)))
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(h), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        first = at[twice]
        np.add.at(cover, first, 1)
        np.add.at(cover, first + size, -1)
    return _per_text((np.cumsum(cover)[:-1] > 0).astype(np.int64), w.first)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def _count(batches):
    for batch in batches:
        for block in blocks(batch.column(1)):
            w = words(block)
            lines = [_lines(block.text(i)) for i in range(block.rows)]
            table = lambda t: _per_text(t[block.data], block.offsets)
            counts = [
                np.diff(w.first),
                table(_WORD_CHAR),
                table(_SYMBOL),
                np.array([b for _, b in lines], dtype=np.int64),
                repeated_words(w, block.rows),
                np.array([a for a, _ in lines], dtype=np.int64),
                table(_UPPER),
                table(_MARK),
                table(_END),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), *[pa.array(c) for c in counts]], names=["doc_id", *COUNTS])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...)."""
    texts = narrow(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    """The fixed rules every text has to pass before the learned ones are asked."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, list(STATISTICS).index(self.statistic)]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.expr(f"cast({STATISTICS[self.statistic]} as double)")
        return value >= self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _best_condition(x: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The threshold with the best information gain over the rows a rule covers so far."""
    p0, n0 = bad.sum(), len(bad) - bad.sum()
    start = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for i, name in enumerate(STATISTICS):
        order = np.argsort(x[:, i], kind="stable")
        values, hits = x[order, i], bad[order]
        cuts = np.flatnonzero(values[1:] > values[:-1]) + 1
        if not len(cuts):
            continue
        below = np.cumsum(hits)[cuts - 1]
        for above in (True, False):
            p = p0 - below if above else below
            n = (len(bad) - cuts if above else cuts) - p
            score = np.where(p >= MIN_COVER, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - start), 0)
            k = int(np.argmax(score))
            if score[k] > gain:
                gain, best = score[k], Condition(name, above, float((values[cuts[k] - 1] + values[cuts[k]]) / 2))
    return best


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4) -> list[Rule]:
    """An ordered list of rules that reject; x has one column per statistic, every third row is for pruning."""
    rules: list[Rule] = []
    prune = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), dtype=bool)
    while len(rules) < max_rules:
        grow, check = left & ~prune, left & prune
        rule: Rule = ()
        at = grow.copy()
        while len(rule) < max_conditions and bad[at].sum() >= MIN_COVER and not bad[at].all():
            found = _best_condition(x[at], bad[at])
            if found is None:
                break
            rule = (*rule, found)
            at &= found.holds(x)

        def worth(r: Rule) -> float:
            hit = check & _covers(r, x)
            return (2 * bad[hit].sum() - hit.sum()) / max(hit.sum(), 1)

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule:
            break
        hit = left & _covers(rule, x)
        held = hit & prune
        if bad[hit].sum() < MIN_COVER or bad[hit].mean() < MIN_PRECISION or not bad[held].any() or bad[held].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(counts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from the labelled rows that pass the base rules; label 0 is bad."""
    known = narrow(labels, id="doc_id", quality="quality").where("quality is not null").groupBy("id").agg(F.min("quality").alias("quality"))
    rows = counts.where(~base_failed()).select(F.col("doc_id").alias("id"), *[F.expr(f"cast({sql} as double)").alias(f"x_{name}") for name, sql in STATISTICS.items()])
    sample = labelled_sample(rows, known, sample_rows).withColumn("o", F.xxhash64("id")).toPandas()
    sample = sample.sort_values(["o", "id", *[f"x_{n}" for n in STATISTICS]])
    bad = (sample["quality"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return []
    return learn(sample[[f"x_{n}" for n in STATISTICS]].to_numpy(), bad)


def verdict(rules: list[Rule]) -> Column:
    """Which rule of the list fires first (1, 2, ...), 0 if none."""
    out = None
    for i, rule in enumerate(rules, 1):
        hit = rule[0].column()
        for c in rule[1:]:
            hit = hit & c.column()
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts with ``base_failed``, the rule that fired and ``kept``."""
    return counts.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
