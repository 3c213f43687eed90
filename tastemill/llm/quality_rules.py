"""Quality rules: decision lists learned by sequential covering, applied as ordered conditional expressions.

Statistics of every text are DataFrame expressions; no row leaves the JVM. Conditions compare one statistic with one
of its cut points (quantiles of the labelled rows). A rule grows by the condition of greatest information gain,
is pruned on rows it has not seen, and covers its rows before the next one grows. All counts come from grouped sums
over all labelled rows; what reaches the driver is one count for each statistic, interval, label and part.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, words, written

#: Fixed by the contract.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Quantiles of the labelled rows, and of the bad ones among them, that conditions may use as cut points.
QUANTILES = [0.005, *(k / 100 for k in range(1, 100)), 0.995]

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbol_share", "repeat_share", "dup_line_share", "upper_share", "mark_share", "mean_word", "digit_share"]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with struct ``stats``: the base counts and their ratios.

    A word counts as repeated if it lies in a window of three words whose text is found twice or more in the document,
    the first included. Null texts have counts of 0 and ratios of 0.
    """
    keep = [c for c in docs.columns]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def chars(pattern: str) -> Column:
        """Characters that match the class."""
        return (F.length(body) - F.length(F.regexp_replace(body, pattern, ""))).cast("long")

    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(
        kept.alias("row_"),
        words(body).alias("w_"),
        F.filter(F.split(body, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines_"),
        chars(SYMBOLS).alias("symbols_"),
        chars(r"\p{Lu}").alias("upper_"),
        chars(r"\p{Punct}").alias("marks_"),
        chars(r"[0-9]").alias("digits_"),
    )
    # windows of three words by hash; each step reads the one before several times, so none is computed twice
    windows = F.when(
        F.size("w_") > 2,
        F.transform(F.slice("w_", 1, F.size("w_") - 2), lambda x, i: F.xxhash64(x, F.get("w_", i + 1), F.get("w_", i + 2))),
    )
    rows = rows.withColumn("hash_", windows)
    repeated = F.size(F.array_distinct("hash_")) < F.size("hash_")
    rows = rows.withColumn(
        "sorted_", F.when(repeated, F.sort_array(F.transform("hash_", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )
    rows = rows.withColumn(
        "places_",
        F.sort_array(
            F.transform(
                F.filter(
                    "sorted_",
                    lambda x, i: F.coalesce(x["h"] == F.get("sorted_", i - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("sorted_", i + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("places_", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places_", i + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    counts = rows.select(
        "row_",
        F.size("w_").cast("long").alias("n_words"),
        F.length(F.array_join("w_", "")).cast("long").alias("word_chars"),
        F.col("symbols_").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines_").alias("lines_"),
        "upper_",
        "marks_",
        "digits_",
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))

    stats = F.struct(
        *BASE,
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_dup_lines", "lines_").alias("dup_line_share"),
        share("upper_", "word_chars").alias("upper_share"),
        share("marks_", "word_chars").alias("mark_share"),
        share("word_chars", "n_words").alias("mean_word"),
        share("digits_", "word_chars").alias("digit_share"),
    )
    return counts.select(*[F.col("row_").getField(c).alias(c) for c in keep], stats.alias("stats"))


@dataclass(frozen=True)
class Condition:
    """A statistic is at least (or below) the value of one of its cut points."""

    name: str
    cut: int
    value: float
    at_least: bool

    def on_intervals(self) -> Column:
        return (F.col(self.name) > self.cut) if self.at_least else (F.col(self.name) <= self.cut)

    def on_statistics(self, stats: Column) -> Column:
        return (stats[self.name] >= self.value) if self.at_least else (stats[self.name] < self.value)


Rule = tuple[Condition, ...]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _precision(good: int, bad: int) -> float:
    return good / (good + bad) if good + bad else 0.0


def learn(
    labelled: DataFrame, names: list[str] = RATIOS, max_rules: int = 8, max_conditions: int = 3,
    min_precision: float = 0.97, min_cover: int = 3,
) -> list[Rule]:
    """Rules that pick rows with ``bad``, best first, from (key, bad, <names>); none where a class is missing.

    Rows go to the growing part (two thirds) or the pruning part by a hash of their key. A rule is kept if at least
    ``min_cover`` of the pruning part's uncovered bad rows are covered and ``min_precision`` of what it covers is bad;
    the first that fails ends the list.
    """
    cuts_row = labelled.agg(
        *[F.percentile_approx(n, QUANTILES, 10_000).alias(n) for n in names],
        *[F.percentile_approx(F.when(F.col("bad"), F.col(n)), QUANTILES, 10_000).alias(f"bad_{n}") for n in names],
    ).first()
    cuts = {n: sorted({*(cuts_row[n] or []), *(cuts_row[f"bad_{n}"] or [])}) for n in names}

    def interval(name: str) -> Column:
        """Number of cuts that a value reaches: interval k lies above the first k."""
        values = F.array(*[F.lit(float(v)) for v in cuts[name]]).cast("array<double>")
        return F.size(F.filter(values, lambda v: F.col(name) >= v)).alias(name)

    binned = labelled.select("bad", (F.pmod(F.xxhash64("key"), F.lit(3)) == 0).alias("prune"), *map(interval, names))
    binned = written(binned.groupBy("bad", "prune", *names).agg(F.count("*").alias("rows")), "quality-cells")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = binned.where(~_any([_all([c.on_intervals() for c in r]) for r in rules]))
        rule = _grown(left.where("not prune"), names, cuts, max_conditions)
        if not rule:
            break
        rule = _pruned(left.where("prune"), rule)
        bad, good = _covered(left.where("prune"), [rule])[0]
        if bad < min_cover or _precision(bad, good) < min_precision:
            break
        rules.append(rule)
    return rules


def _grown(rows: DataFrame, names: list[str], cuts: dict[str, list[float]], most: int) -> Rule:
    rule: list[Condition] = []
    while len(rule) < most:
        inside = rows.where(_all([c.on_intervals() for c in rule]))
        each = inside.select(
            "bad", "rows", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("at")) for n in names])).alias("s")
        )
        found = each.groupBy("s.name", "s.at").agg(
            F.sum(F.when(F.col("bad"), F.col("rows")).otherwise(0)).alias("p"),
            F.sum(F.when(F.col("bad"), 0).otherwise(F.col("rows"))).alias("n"),
        )
        counts = {(r["name"], r["at"]): (r["p"], r["n"]) for r in found.collect()}
        p0 = sum(p for (name, _), (p, _n) in counts.items() if name == names[0])
        n0 = sum(n for (name, _), (_p, n) in counts.items() if name == names[0])
        if not p0 or not n0:
            break
        best, gain = None, 0.0
        for name in names:
            for cut, value in enumerate(cuts[name]):
                below_p = sum(counts.get((name, k), (0, 0))[0] for k in range(cut + 1))
                below_n = sum(counts.get((name, k), (0, 0))[1] for k in range(cut + 1))
                for at_least, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                    if p and n < n0:
                        g = p * (log2(p / (p + n)) - log2(p0 / (p0 + n0)))
                        if g > gain:
                            best, gain = Condition(name, cut, float(value), at_least), g
        if best is None:
            break
        rule.append(best)
    return tuple(rule)


def _covered(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """(bad, good) rows that each rule covers."""
    sums = []
    for k, rule in enumerate(rules):
        inside = _all([c.on_intervals() for c in rule])
        sums.append(F.sum(F.when(inside & F.col("bad"), F.col("rows"))).alias(f"p{k}"))
        sums.append(F.sum(F.when(inside & ~F.col("bad"), F.col("rows"))).alias(f"n{k}"))
    row = rows.agg(*sums).first()
    return [(row[f"p{k}"] or 0, row[f"n{k}"] or 0) for k in range(len(rules))]


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule with the greatest (bad - good) / (bad + good) on rows it did not grow on."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    worth = [((p - n) / (p + n) if p + n else -1.0) for p, n in _covered(rows, heads)]
    return heads[max(range(len(heads)), key=lambda k: (worth[k], -k))]


def decide(rules: list[Rule], stats: Column) -> Column:
    """Number of the first rule that fits, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all([c.on_statistics(stats) for c in rule]), F.lit(k)).otherwise(out)
    return out


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def judged(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The rows (columns ``keep``, by default all) with ``stats``, ``base_failed``, ``rule`` (of the learned list, else null) and ``kept``.

    Rules are learned from all documents that ``labels`` (doc_id, quality) names and the base rules pass; a document
    with several labels is bad if one says so, null labels say nothing. Without labels of both kinds only the base
    rules decide. Statistics are written once, with the rows. An empty table gives an empty result. Own columns of the
    four names are left out, as the verdict has them; ``passing`` keeps every column.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("stats", "base_failed", "rule", "kept")]
    rows = _measured(docs, labels, key, text, kept)
    return rows.select(*[F.col("row_")[f"c{i}"].alias(c) for i, c in enumerate(kept)], "stats", "base_failed", "rule", "kept")


def passing(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns, whatever their names."""
    names = docs.columns
    rows = _measured(docs, labels, key, text, names).where("kept")
    return rows.select(*[F.col("row_")[f"c{i}"].alias(c) for i, c in enumerate(names)])


def _measured(docs: DataFrame, labels: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """row_ (struct of the columns to keep), stats, base_failed, rule, kept."""
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    plain = docs.select(row.alias("row_"), F.col(f"`{key}`").alias("key_"), F.col(f"`{text}`").alias("text_"))
    measured = written(statistics(plain, "text_").select("row_", "key_", "stats"), "quality-stats")
    return _verdicts(measured, rules_from(measured, labels, "key_")).drop("key_")


def rules_from(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> list[Rule]:
    """The list learned from all rows of (key, stats) that the base rules pass and ``labels`` names."""
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        (F.min("quality") == 0).alias("bad")
    )
    stats = F.col("stats")
    labelled = measured.where(~base_failed(stats)).select(F.col(f"`{key}`").alias("key"), "stats").join(
        known, F.col("key") == F.col("label_id")
    ).select("key", "bad", *[stats[n].cast("double").alias(n) for n in RATIOS])
    return learn(labelled)


def _verdicts(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    stats = F.col("stats")
    rule = F.when(~base_failed(stats), decide(rules, stats))
    return measured.withColumn("base_failed", base_failed(stats)).withColumn("rule", rule).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = judged(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return measured.select("doc_id", *[F.col("stats")[n].alias(n) for n in BASE], "base_failed", "kept", "rule")
