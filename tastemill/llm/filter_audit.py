"""How filters overlap: what each one removes, finds already removed and costs in labels, at every place of every order.

Each filter's failing documents are an id table of their own. What filter f removes after a set of others has run is
its id table, left-anti joined with theirs; what a further filter takes away from that is the left-semi join. Sets grow
by one filter a round, and one join serves all sets of a round, so five filters need four rounds and not a pass for each
of 120 orders. Only failing ids move: a document that fails nothing is counted once and is in no relation.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemill.session import scratch_path

from .common import table, word_count, words, written

#: A text that more than one in so many rows have is looked up in a broadcast table, which has no more rows than this.
SHARES = 4_096

#: Filters in order of their letters: (letter, condition of failing on the column ``text_``), see ``text_filters``.
Filters = list[tuple[str, Column]]


def text_filters() -> Filters:
    """The four filters that look at one text: short, repetitive, shouting, with marks."""
    text = F.col("text_")
    n_words, n_distinct = F.col("words_"), F.col("distinct_")
    return [
        ("A", n_words < 100),
        ("B", 100 * n_distinct < 80 * n_words),
        ("C", 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text)),
        ("D", text.rlike(r"[#$%&*|]")),
    ]


def _copies(rows: DataFrame) -> DataFrame:
    """Ids of rows whose digest a row of smaller doc_id has.

    Digests with a large share of the rows are few, and broadcast; any other fits a task whatever the size.
    """
    groups = rows.where("doc_id is not null").groupBy("digest").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    groups = written(groups.where("first < last").select(F.col("digest").alias("d"), "n", "first"), "audit-copies")
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = groups.where(F.col("n") * SHARES > total)  # fewer than SHARES rows
    same = (F.col("digest") == F.col("d")) & (F.col("doc_id") > F.col("first"))
    flagged = rows.join(F.broadcast(hot.select(F.col("d").alias("h"), F.col("first").alias("hot_first"))), F.col("digest") == F.col("h"), "left")
    flagged = flagged.select("id", "doc_id", "digest", "hot_first")
    cold = flagged.where("hot_first is null").join(groups.where(F.col("n") * SHARES <= total), same, "left_semi")
    return flagged.where("doc_id > hot_first").select("id").unionAll(cold.select("id"))


def failing_ids(
    docs: DataFrame, filters: Filters, copies: str | None, key: str, text: str, part: str
) -> tuple[DataFrame, DataFrame]:
    """(rows: id, doc_id, part; fails: filter, id): ``fails`` is stored as one id table for each filter.

    ``id`` numbers the rows of the table, so that repeated or null keys stay apart.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), body.alias("text_")
    )
    counted = plain.withColumn("words_", word_count(F.col("text_"))).withColumn(
        "distinct_", F.size(F.array_distinct(words(F.col("text_"))))
    )
    flags = [c.alias(f"fails_{letter}") for letter, c in filters]
    rows = written(
        counted.select(F.monotonically_increasing_id().alias("id"), "doc_id", "part", F.unhex(F.sha2("text_", 256)).alias("digest"), *flags),
        "audit-rows",
    )
    tables = {letter: rows.where(f"fails_{letter}").select("id") for letter, _ in filters}
    if copies is not None:
        tables[copies] = _copies(rows)
    path = scratch_path(docs.sparkSession, "audit-fails")
    for letter, ids in tables.items():
        ids.write.parquet(f"{path}/filter={letter}")
    fails = docs.sparkSession.read.schema("id long, filter string").parquet(path)
    return rows.select("id", "doc_id", "part"), fails.select("filter", "id")


def _bit(letters: str, letter: Column) -> Column:
    """The letter's place among the letters, as a bit of a set."""
    return F.element_at(F.create_map(*[F.lit(x) for i, a in enumerate(letters) for x in (a, 1 << i)]), letter)


def interactions(rows: DataFrame, fails: DataFrame, letters: str, good: DataFrame, toxic: DataFrame) -> DataFrame:
    """part, filter, before (set of filters as bits), removed, redundant, good_lost, toxic_lost: of every filter and set.

    ``good`` and ``toxic`` are tables of doc_id. Combinations without a failing document are left out.
    """
    known = rows.join(fails.select("id").distinct(), "id", "left_semi")
    known = written(known, "audit-known")
    labelled = [
        known.join(ids.select(F.col("doc_id")).where("doc_id is not null"), "doc_id", "left_semi").select("id", F.lit(name).alias("label"))
        for name, ids in (("good", good), ("toxic", toxic))
    ]
    labels = written(labelled[0].unionAll(labelled[1]), "audit-labels")
    bit = _bit(letters, F.col("filter"))
    left = written(
        fails.join(known.select("id", "part"), "id").select("filter", "id", "part", F.lit(0).alias("before"), F.lit(-1).alias("last")),
        "audit-removed",
    )
    by = ["part", "filter", "before"]
    relations = [left]
    met: list[DataFrame] = []
    numbered = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(a).alias("other")) for i, a in enumerate(letters)])
    others = written(fails.select(F.col("filter").alias("f"), F.col("id").alias("i")), "audit-others")
    for _ in range(len(letters) - 1):
        # the set grows by a filter after its last one, so that every set is reached once
        wider = relations[-1].select("*", F.explode(numbered).alias("next")).where(
            (F.col("next.at") > F.col("last")) & (F.col("next.other") != F.col("filter"))
        ).select(
            "filter", "id", "part", F.col("before").bitwiseOR(F.call_function("shiftleft", F.lit(1), F.col("next.at"))).alias("before"),
            F.col("next.at").alias("last"), F.col("next.other").alias("other"),
        )
        here = (F.col("other") == F.col("f")) & (F.col("id") == F.col("i"))
        met.append(wider.join(others, here, "left_semi").select(*by, "last"))
        relations.append(written(wider.join(others, here, "left_anti").drop("other"), "audit-removed"))
    removed = reduce(DataFrame.unionAll, relations).select(*by, "id")
    lost = removed.join(labels.where("label = 'good'"), "id", "left_semi").select(*by, F.lit("good_lost").alias("what")).unionAll(
        removed.join(labels.where("label = 'toxic'"), "id", "left_semi").select(*by, F.lit("toxic_lost").alias("what"))
    )
    counts = removed.select(*by, F.lit("removed").alias("what")).unionAll(lost).groupBy(*by, "what").agg(F.count("*").alias("n"))
    # what a filter of the set took first is redundant in that set and in all that go on from it
    taken = reduce(DataFrame.unionAll, met).groupBy(*by, "last").agg(F.count("*").alias("n"))
    everything = (1 << len(letters)) - 1
    later = F.filter(
        F.sequence(F.lit(0), F.lit(everything)),
        lambda s: (s.bitwiseAND(F.call_function("shiftleft", F.lit(2), F.col("last")) - 1) == F.col("before")) & (s.bitwiseAND(bit) == 0),
    )
    redundant = taken.select("part", "filter", F.explode(later).alias("before"), F.lit("redundant").alias("what"), "n")
    sums = [F.coalesce(F.sum(F.when(F.col("what") == w, F.col("n"))), F.lit(0)).alias(w) for w in ("removed", "redundant", "good_lost", "toxic_lost")]
    return counts.unionAll(redundant).groupBy(*by).agg(*sums)


def audit(
    docs: DataFrame, labels: DataFrame, filters: Filters | None = None, copies: str | None = "E",
    key: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``filters`` are letters with conditions, ``copies`` is the letter of the filter that fails texts which a smaller key
    has (None for no such filter); orders are all permutations of the letters, applied left to right. A row for each
    part, order and step, with zeros where nothing fails.

    Null texts are empty, null parts are the empty string, repeated rows are documents of their own, equal texts of one
    key are no copies, and a null key is neither a copy nor labelled. A key labelled in several rows counts as good
    (toxic) if one says so. No documents, no rows. Other columns are not looked at, whatever their names.
    """
    filters = text_filters() if filters is None else filters
    letters = "".join(sorted([letter for letter, _ in filters] + ([copies] if copies is not None else [])))
    rows, fails = failing_ids(docs, filters, copies, key, text, part)
    good = labels.where("quality = 1").select("doc_id")
    toxic = labels.where("toxic = 1").select("doc_id")
    found = interactions(rows, fails, letters, good, toxic)
    found = written(found, "audit-counts")  # at most 80 rows for each part
    steps = [
        (order, step + 1, order[step], sum(1 << letters.index(a) for a in order[:step]))
        for order in map("".join, permutations(letters))
        for step in range(len(letters))
    ]
    plan = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, before int")
    plan = plan.agg(F.collect_list(F.struct("filter_order", "step", "filter", "before")).alias("plan"))
    parts = rows.groupBy("part").agg(F.count("*").alias("documents"))
    grid = parts.select("part", "documents", plan.select(F.first("plan")).scalar().alias("plan")).select(
        "part", "documents", F.inline("plan")
    )
    full = grid.join(found, ["part", "filter", "before"], "left").fillna(0, ["removed", "redundant", "good_lost", "toxic_lost"])
    whole = (1 << len(letters)) - 1
    alone = F.when(F.col("before").bitwiseOR(_bit(letters, F.col("filter"))) == whole, F.col("removed"))
    per_filter = Window.partitionBy("part", "filter")  # one row for each order
    running = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return full.select(
        "part", "filter_order", "step",
        (F.col("documents") - F.sum("removed").over(running)).alias("kept"),
        "removed", "redundant",
        F.max(alone).over(per_filter).alias("unique_fails"),
        "good_lost", "toxic_lost",
        F.sum("removed").over(per_filter).alias("shapley"),
    )


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


ORACLE = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), docs as (
  select part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by text), false) as e,
    coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good,
    coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic
  from words
), sets as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as failed, count(*) as n,
    count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from docs group by all
), letters as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as t(f, bit)
), orders as (
  select p.f || q.f || r.f || s.f || t.f as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
  from letters p, letters q, letters r, letters s, letters t
  where p.bit | q.bit | r.bit | s.bit | t.bit = 31
), steps as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[:step - 1]), 0)::int as before
  from orders, range(1, 6) as g(step)
), counts as (
  select part, filter_order, step::int as step, any_value(bit) as bit,
    coalesce(sum(n) filter (failed & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (failed & bit > 0 and failed & before = 0), 0)::bigint as removed,
    coalesce(sum(n) filter (failed & bit > 0 and failed & before > 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (failed = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (failed & bit > 0 and failed & before = 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (failed & bit > 0 and failed & before = 0), 0)::bigint as toxic_lost
  from sets, steps group by part, filter_order, step
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from counts
"""
