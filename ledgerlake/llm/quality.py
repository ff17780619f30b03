"""Quality rules (operator 6): text statistics and a learned decision list, in Spark SQL only.

The statistics of a text are built-in functions over its words and lines. A
decision list is learned by sequential covering from labelled statistics
(label 1 means keep, 0 means reject): a rule grows one threshold at a time by
information gain on two thirds of the labelled rows, is pruned back on the
other third, and is kept while it is precise enough there; the rows it covers
leave the training set and the next rule starts. A threshold lies midway
between two neighbouring observed values, on neither class's own edge. Each
growth step is one Spark aggregate (a histogram per statistic over at most
``cuts`` + 1 bins), so what reaches the driver is bounded by statistics times
bins at any input size. The list becomes one ordered conditional expression.

Defined results: a null text has no words; a text without words fails the base
rule; labels without quality, or without a matching document, are left out;
of several labels for a document the smallest quality counts; without labelled
rows the list is empty and only the base rule rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, smallest_hashes, written

#: Words in a window whose second appearance counts as a repetition.
WINDOW = 8
#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Labelled documents that the list is learned from at most.
MAX_FIT_ROWS = 20_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that rules may test, by name, from the counts of :func:`with_counts`.
RATIOS = {
    "words": "n_words",
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "short_word_share": "n_short_words / n_words",
    "distinct_word_share": "n_distinct_words / n_words",
    "words_per_line": "n_words / n_lines",
    "digit_share": "n_digits / word_chars",
}


def with_counts(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns and the counts of each text (all long).

    Names in ``carry`` must differ from the counts; wrap other columns in a
    struct. Repeated windows are found by 64-bit hashes of their words, sorted
    with their positions within the row; texts without any skip that.
    """
    carry = carry or []
    t = F.coalesce(F.col(text), F.lit(""))
    length = F.char_length

    def left_by(pattern: str) -> Column:
        return length(t) - length(F.regexp_replace(t, pattern, ""))

    split = docs.select(
        *carry,
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
        left_by(f"[{SYMBOLS}]+").cast("long").alias("n_symbols"),
        left_by("[0-9]+").cast("long").alias("n_digits"),
    )
    hashed = split.select(
        *carry, "n_symbols", "n_digits",
        length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: length(w) <= 3)).cast("long").alias("n_short_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    windows = F.when(
        F.size("_hashes") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
                    lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])))
    windowed = hashed.select(
        "*", windows.alias("_windows"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct_words"),
    )
    placed = windowed.select("*", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).alias("_sorted"))
    repeated = placed.select("*", F.sort_array(F.filter(
        F.transform("_sorted", lambda s, k: F.when(
            (s["h"] == F.get("_sorted", k - 1)["h"]) | (s["h"] == F.get("_sorted", k + 1)["h"]),
            s["i"])),
        lambda i: i.isNotNull())).alias("_starts"))
    # every window covers its words up to the start of the next repeated window
    covered = F.aggregate(
        F.transform("_starts", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    # inline() keeps later filters above the counts: pushed below, they would repeat every step
    return repeated.select(*carry, F.inline(F.array(F.struct(
        *BASE[:-1], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_short_words", "n_digits", "n_distinct_words"))))


def base_failed() -> Column:
    """Too short, or mostly repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def ratio(name: str) -> Column:
    """A statistic of :data:`RATIOS`; 0 where its denominator is 0."""
    top, _, bottom = RATIOS[name].partition(" / ")
    if not bottom:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    """``statistic > threshold`` or ``statistic <= threshold``."""

    statistic: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = ratio(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def on_bins(self) -> Column:
        b = F.col(f"_b_{self.statistic}")
        return b > self.bin if self.above else b <= self.bin

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a row that meets all conditions of a rule is rejected."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule_number(self) -> Column:
        """Number of the first rule that rejects the row, from 1; null if none does."""
        out = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            out = F.when(_all([c.column() for c in self.rules[i - 1]]), F.lit(i)).otherwise(out)
        return out

    def keep(self) -> Column:
        return self.rule_number().isNull()

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules)


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, carry: list[str],
                    most: int = MAX_FIT_ROWS) -> DataFrame:
    """``carry`` columns of at most ``most`` labelled documents, with the label as ``_label``.

    The documents with the smallest hashes of their ids: the same at every
    run. The ids (``most`` rows at most) are broadcast, so texts don't move.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("_label")))
    chosen = smallest_hashes(known, most, "_id")
    own = docs.select("doc_id", *[c for c in carry if c != "doc_id"])  # other names can clash
    return own.join(F.broadcast(chosen), own["doc_id"] == F.col("_id"), "inner") \
        .select(*carry, "_label")


def learn(stats: DataFrame, cuts: int = 32, min_precision: float = 0.9, min_covered: int = 3,
          max_rules: int = 12, max_conditions: int = 4) -> DecisionList:
    """A decision list from counts (:func:`with_counts`), ``_label`` (0: reject) and ``_key``.

    ``_key`` deals rows to the growing (two thirds) and pruning set.
    """
    names = list(RATIOS)
    points = [i / (cuts + 1) for i in range(1, cuts + 1)]
    rows = written(stats.select("_label", (F.pmod(F.xxhash64("_key"), F.lit(3)) == 0).alias("_prune"),
                                *[ratio(n).alias(n) for n in names]), "quality-sample")
    quantiles = rows.agg(*[F.percentile_approx(n, points, F.lit(10_000)).alias(n)
                           for n in names]).first()
    edges = {n: sorted(set(quantiles[n] or [])) for n in names}
    binned = rows.select("_label", "_prune", *[_bin(n, edges[n]).alias(f"_b_{n}") for n in names])
    counted = binned.groupBy("_prune", *[f"_b_{n}" for n in names]).agg(
        F.sum((F.col("_label") == 0).cast("long")).alias("_pos"),
        F.sum((F.col("_label") != 0).cast("long")).alias("_neg"))
    left = written(counted, "quality-bins")
    middles = _middles(rows, names, edges)

    out, weak = DecisionList(), set()
    while len(out.rules) < max_rules:
        open_rows = left.where(~_any_rule(out.rules))
        grown = _grow(open_rows.where(~F.col("_prune")), names, middles, max_conditions, weak)
        if not grown:
            break
        kept = _prune(open_rows.where("_prune"), open_rows, grown, min_precision, min_covered)
        if kept:
            out.rules.append(kept)
        else:  # no later rule starts from the statistic that failed on held rows
            weak.add(grown[0].statistic)
    return out


def _bin(name: str, edges: list[float]) -> Column:
    """How many of the edges lie under the value."""
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: F.col(name) > e))


def _middles(rows: DataFrame, names: list[str],
             edges: dict[str, list[float]]) -> dict[str, list[float]]:
    """Midway from each edge to the next larger value of its statistic (an edge without: itself).

    The rows on either side are the same as for the edge.
    """
    cells = rows.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), _bin(n, edges[n]).alias("b"), F.col(n).alias("v"))
        for n in names])).alias("x"))
    least: dict[str, dict[int, float]] = {n: {} for n in names}
    for r in cells.groupBy("x.n", "x.b").agg(F.min("x.v").alias("v")).collect():
        least[r["n"]][r["b"]] = r["v"]
    out: dict[str, list[float]] = {n: [] for n in names}
    for n in names:
        for b, edge in enumerate(edges[n]):
            above = min((v for k, v in least[n].items() if k > b), default=edge)
            middle = edge + (above - edge) / 2
            out[n].append(middle if edge < middle < above else edge)
    return out


def _any_rule(rules: list[list[Condition]]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | _all([c.on_bins() for c in r])
    return out


def _grow(rows: DataFrame, names: list[str], edges: dict[str, list[float]],
          most: int, weak: set[str]) -> list[Condition]:
    """Conditions added by the gain pos * (log p' - log p) until no row of the other class is left.

    A rule doesn't start with a statistic in ``weak``.
    """
    rule: list[Condition] = []
    while len(rule) < most:
        inside = rows.where(_all([c.on_bins() for c in rule]))
        cells = inside.select("_pos", "_neg", F.explode(F.array(*[
            F.struct(F.lit(n).alias("n"), F.col(f"_b_{n}").alias("b")) for n in names])).alias("x"))
        bins: dict[str, dict[int, tuple[int, int]]] = {n: {} for n in names}
        for r in cells.groupBy("x.n", "x.b").agg(F.sum("_pos").alias("p"),
                                                 F.sum("_neg").alias("q")).collect():
            bins[r["n"]][r["b"]] = (r["p"], r["q"])
        pos = sum(p for p, _ in bins[names[0]].values())
        neg = sum(q for _, q in bins[names[0]].values())
        if not pos or not neg and rule:
            break
        base = math.log2(pos / (pos + neg))
        best = (1e-9, None)
        for n in names if rule else [x for x in names if x not in weak]:
            p = q = 0
            for b, edge in enumerate(edges[n]):
                p += bins[n].get(b, (0, 0))[0]
                q += bins[n].get(b, (0, 0))[1]
                for above, x, y in ((False, p, q), (True, pos - p, neg - q)):
                    if x:
                        gain = x * (math.log2(x / (x + y)) - base)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(n, above, float(edge), b))
        if best[1] is None:
            break
        rule.append(best[1])
        if not neg:
            break
    return rule


def _prune(held: DataFrame, rows: DataFrame, rule: list[Condition], min_precision: float,
           min_covered: int) -> list[Condition]:
    """The leading part of ``rule`` with the best (p - n) / (p + n) on held rows; [] if too weak."""
    def counts(df: DataFrame) -> list[tuple[int, int]]:
        sums = []
        for k in range(1, len(rule) + 1):
            inside = _all([c.on_bins() for c in rule[:k]])
            sums += [F.sum(F.when(inside, F.col("_pos")).otherwise(0)).alias(f"p{k}"),
                     F.sum(F.when(inside, F.col("_neg")).otherwise(0)).alias(f"n{k}")]
        r = df.agg(*sums).first()
        return [(r[f"p{k}"] or 0, r[f"n{k}"] or 0) for k in range(1, len(rule) + 1)]

    scored = [((p - n) / (p + n) if p + n else -1.0, -k, k, p, n)
              for k, (p, n) in enumerate(counts(held), 1)]
    _, _, k, p, n = max(scored)
    if p < 1 or p < min_precision * (p + n):
        return []
    p, n = counts(rows)[k - 1]  # also over all rows, growing ones included
    return rule[:k] if p >= min_covered and p >= min_precision * (p + n) else []


def learn_from(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT_ROWS) -> DecisionList:
    """A decision list from the labelled documents (``doc_id``, ``text``; ``quality``) that
    pass the base rule."""
    sample = labelled_sample(docs, labels, "quality", ["doc_id", "text"], most)
    keyed = sample.select(F.col("doc_id").alias("_key"), "_label", "text")
    return learn(with_counts(keyed, "text", ["_key", "_label"]).where(~base_failed()))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """One row per document: counts, ``base_failed``, number of the rejecting rule, ``kept``."""
    counts = with_counts(docs, "text", ["doc_id"])
    return counts.select(
        "doc_id", *BASE, base_failed().alias("base_failed"),
        rules.rule_number().alias("rule"), (~base_failed() & rules.keep()).alias("kept"))


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The documents that the base rule and the list keep, all columns as they were."""
    packed = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    return (with_counts(packed, "_text", ["_row"])
            .where(~base_failed() & rules.keep()).select("_row.*"))
