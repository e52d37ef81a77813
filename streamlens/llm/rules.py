"""Quality rules: a decision list learned from labelled statistics, applied as one Spark conditional.

Statistics of whole texts are column expressions. Sequential covering learns the list on the driver from a
bounded sample (``SAMPLE`` labelled rows of a few numbers): each rule is a conjunction of thresholds, grown on
two thirds of the rows and pruned on the rest; the rows it covers are taken out and the next rule is learned.

A null text has no words; texts without words have all statistics 0. If there are no labelled rows of both
kinds the list is empty and only the base rule rejects.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.labelled import sample

SAMPLE = 4_000
BLANKS = " \t\n\x0b\f\r"
FEATURES = ("n_words", "word_length", "symbol_share", "repeat_share", "dup_line_share", "upper_share", "distinct_share")

# Words of a document that stand in a run of three words found twice or more in it: runs are numbered and sorted
# with their places; each place of a repeated run covers the words up to the next such place, three at most.
# ``array`` + ``transform`` binds a value once, where a plain reference could be evaluated for each element.
REPEATS = """
CASE WHEN size(_words) < 4 THEN 0L ELSE
  transform(array(_words), w ->
    transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)))), h ->
      CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
        transform(array(sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))), s ->
          transform(array(sort_array(transform(
              filter(sequence(0, size(s) - 1), k -> coalesce(get(s, k).h = get(s, k - 1).h, false) OR coalesce(get(s, k).h = get(s, k + 1).h, false)),
              k -> get(s, k).i))), p ->
            aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))), 0L, (a, x) -> a + x)
          )[0]
        )[0]
      END
    )[0]
  )[0]
END
"""


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold


Rule = list[Condition]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with its counts and the features of the rules."""
    body = F.coalesce(F.col(text), F.lit(""))
    names = {*FEATURES, "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_text", "_words", "_lines"}
    kept = [c for c in docs.columns if c != text and c not in names]
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.char_length(F.btrim(x, F.lit(BLANKS))) > 0)
    inner = F.btrim(body, F.lit(BLANKS))
    words = F.when(F.char_length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))
    cut = docs.select(*kept, body.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    counted = cut.select(
        *kept, F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(REPEATS).alias("n_repeat_words"), F.size("_lines").alias("_n_lines"),
        F.regexp_count("_text", F.lit("[A-Z]")).alias("_upper"), F.size(F.array_distinct("_words")).alias("_distinct"),
    )
    share = lambda x, of: F.round(F.col(x) / F.greatest(F.col(of), F.lit(1)), 6)
    return counted.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("_upper", "word_chars").alias("upper_share"), share("_distinct", "n_words").alias("distinct_share"),
    )


def cuts(values: list[float], most: int = 24) -> list[float]:
    """Thresholds between the quantiles of the values."""
    distinct = sorted(set(values))
    steps = sorted({distinct[round(i * (len(distinct) - 1) / most)] for i in range(most + 1)} | {sorted(values)[round(i * (len(values) - 1) / most)] for i in range(most + 1)})
    return [round((a + b) / 2, 6) for a, b in zip(steps, steps[1:])]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _bad(rows: list[dict]) -> int:
    return sum(1 - r["label"] for r in rows)


def grow(rows: list[dict], thresholds: dict[str, list[float]], most: int = 4) -> Rule:
    """Add the condition with the largest information gain for rejected rows until none is wrongly covered."""
    rule: Rule = []
    while len(rule) < most and _bad(rows) < len(rows):
        bad = _bad(rows)
        base = math.log2(bad / len(rows))
        best, best_rows, gain = None, rows, 1e-9
        for feature, values in thresholds.items():
            ordered = sorted((r[feature], 1 - r["label"]) for r in rows)
            at = p = 0
            for t in values:
                while at < len(ordered) and ordered[at][0] <= t:
                    p += ordered[at][1]
                    at += 1
                for above, hits, n in ((False, p, at), (True, bad - p, len(rows) - at)):
                    if hits and (g := hits * (math.log2(hits / n) - base)) > gain:
                        best, gain = Condition(feature, above, t), g
        if best is None:
            break
        rule.append(best)
        rows = _covered([best], rows)
    return rule


def prune(rule: Rule, rows: list[dict]) -> Rule:
    """Drop trailing conditions as long as that does not lower (rejected - wrong) / covered on rows not grown on."""
    def worth(r: Rule) -> float:
        covered = _covered(r, rows)
        return (2 * _bad(covered) - len(covered)) / len(covered) if covered else -1.0

    return max((rule[:n] for n in range(1, len(rule) + 1)), key=worth, default=[])


def learn(rows: list[dict], precision: float = 0.9, most: int = 16) -> list[Rule]:
    """Ordered rules that reject. ``rows``: features and ``label`` (1: keep). A rule stays if at least
    ``precision`` of what it covers among the rows left is labelled for rejection."""
    rules: list[Rule] = []
    thresholds = {f: cuts([r[f] for r in rows]) for f in FEATURES} if rows else {}
    rest = list(rows)
    while len(rules) < most and _bad(rest):
        growing = [r for i, r in enumerate(rest) if i % 3]
        pruning = [r for i, r in enumerate(rest) if not i % 3]
        if not _bad(growing):
            break
        rule = prune(grow(growing, thresholds), pruning)
        covered = _covered(rule, rest) if rule else []
        if not covered or _bad(covered) < precision * len(covered) or _bad(covered) < 3:
            break
        rules.append(rule)
        rest = [r for r in rest if not all(c.holds(r) for c in rule)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: false at the first rule that holds, else true."""
    out = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE) -> list[Rule]:
    """Rules learned from at most ``at_most`` labelled documents whose crc32(doc_id) mod 4 is not 2."""
    rows = statistics(sample(docs, labels, "quality", at_most, 4, 2)).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return learn([r.asDict() for r in rows])


def apply(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Counts of each text, ``base_failed`` and ``kept``; other columns of ``docs`` stay."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = statistics(docs, text).withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))
