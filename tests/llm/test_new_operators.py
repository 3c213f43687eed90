"""Whitening, packing and the filter audit against plain versions, and their edge cases."""

from __future__ import annotations

import re
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tastemill.llm import best_fit_packing, filter_audit, packing_plan, queries, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS_FILE = public_tokenizers.path("word_bpe_49k.json")

# ---- whitening


def plain_whitening(vectors, components=32):
    x = np.array([np.floor(np.array(v, float) * 64) + 1_000_000 for v in vectors])
    center = x.sum(axis=0) / len(x)
    values, axes = np.linalg.eigh((x - center).T @ (x - center) / len(x))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    total = np.trace((x - center).T @ (x - center) / len(x))
    return ((x - center) @ axes) / np.sqrt(values), values / total, ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)


def test_whitening_query_is_that_of_a_plain_decomposition(spark, sf):
    got = queries.QUERIES["op11_embedding_whitening"](spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    fine = [v is not None and np.isfinite(np.array(v, float)).all() for v in table.embedding]
    white, explained, deviation = plain_whitening(list(table.embedding[fine]))
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    assert wide.index.tolist() == table.vec_id[fine].tolist()
    sign = np.sign((wide.to_numpy() * white).sum(axis=0))
    np.testing.assert_allclose(wide.to_numpy() * sign, white, atol=1e-8)
    np.testing.assert_allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got.groupby("vec_id").deviation.first().tolist() == [int(d) for d in deviation]
    assert set(got.n) == {sum(fine)}
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


@pytest.mark.parametrize("rank", [1, 3, 7])
def test_cholesky_finds_the_rank_and_jacobi_the_values(rank):
    rng = np.random.default_rng(rank)
    x = rng.integers(-9, 9, (200, rank)) @ rng.integers(-3, 3, (rank, 7))
    a = (x.T @ x).astype(object)
    order, factor = whitening.pivoted_cholesky(a)
    assert factor.shape[1] == np.linalg.matrix_rank(x)
    np.testing.assert_allclose(factor @ factor.T, a[np.ix_(order, order)].astype(float), rtol=1e-10, atol=1e-6)
    values, columns = whitening.one_sided_jacobi(factor)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(x.T @ x)[::-1][: len(values)], rtol=1e-8)
    np.testing.assert_allclose(columns.T @ columns, np.eye(len(values)), atol=1e-12)


def test_every_pair_of_columns_is_turned_once():
    for n in range(1, 9):
        met = [(int(a), int(b)) for p, q in whitening._rounds(n) for a, b in zip(p, q, strict=True)]
        assert sorted(met) == [(a, b) for a in range(n) for b in range(a + 1, n)]


def test_small_values_keep_their_digits():
    """Squared values 1e-16 of the largest are lost to a decomposition of the squares, not to one of the factor."""
    columns = np.linalg.qr(np.random.default_rng(2).normal(size=(6, 6)))[0]
    wanted = 10.0 ** -np.arange(0, 12, 2)
    values, axes = whitening.one_sided_jacobi(columns * wanted)
    np.testing.assert_allclose(values, wanted**2, rtol=1e-12)
    np.testing.assert_allclose(np.abs(np.diag(axes.T @ columns)), 1, rtol=1e-12)


def test_whitening_edge_cases(spark):
    rows = [
        (1, [1.0, 2.0, 0.0], "a"), (2, [0.5, -2.0, 0.0], "b"), (2, [0.5, -2.0, 0.0], "b"), (None, [3.0, 1.0, 0.0], None),
        (4, None, "c"), (5, [1.0, None, 0.0], "c"), (6, [float("nan"), 1.0, 0.0], "c"), (7, [float("inf"), 1.0, 0.0], "c"),
        (8, [], "d"), (9, [1.0], "e"), (10, [2.0], "e"), (11, [1.0, 1.0], "alone"),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    got = whitening.whiten(table).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == sorted(
        [(v, c, 4) for v in ("1", "2", "2", "None") for c in (1, 2)] + [("9", 1, 2), ("10", 1, 2)]
    )
    assert max(r.identity_error for r in got) < 1e-12
    assert {round(abs(r.whitened), 9) for r in got if r.n == 2} == {1.0}
    assert whitening.whiten(table.where("false")).count() == 0
    assert whitening.whiten(table.where("vec_id = 2")).count() == 0  # no variance
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 5.0]), (3, [0.0, 0.5])], "vec_id long, embedding array<double>")
    far = whitening.whiten(huge).collect()
    # the second dimension's variance is below the last digit of the first's
    assert len(far) == 3 and {r.deviation for r in far} == {None, 320**2} and max(r.identity_error for r in far) < 1e-4


def test_whitening_does_not_depend_on_partitions(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    one, many = (
        {(r.vec_id, r.component): r.whitened for r in whitening.whiten(t, 4).collect()} for t in (table.coalesce(1), table.repartition(7))
    )
    assert one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-12


# ---- packing


def ids_of(text):
    import tokenizers

    return tokenizers.Tokenizer.from_file(WORDS_FILE).encode(text, add_special_tokens=False).ids


def check_packing(rows, documents, capacity):
    """Every id once, nothing above the capacity, no gaps; the number of sequences."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    wanted = []
    for doc_id, ids in documents:
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            wanted.append((str(doc_id), piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(wanted)
    return len(by_sequence)


def test_packing_query(spark, sf):
    rows = queries.QUERIES["op12_best_fit_packing"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    used = check_packing(rows, [(d.doc_id, [*ids_of(d.text or ""), 0]) for d in docs], 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_edge_cases(spark, edge_docs, no_docs):
    rows = best_fit_packing.packed(edge_docs, WORDS_FILE, 0, 50, ids=True)
    held = rows.collect()
    check_packing(held, [(d.doc_id, [*ids_of(d.text or ""), 0]) for d in edge_docs.collect()], 50)
    texts = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in best_fit_packing.sequences(rows).collect()}
    for r in held:
        assert bytes(r.ids) == texts[r.sequence_id][r.offset : r.offset + r.length].tobytes()
    assert best_fit_packing.packed(no_docs, WORDS_FILE, 0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece_and_stay_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 120))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 400)))
    if seed % 2:
        lengths = np.minimum(lengths, 1 + lengths // 3)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    plan = packing_plan.plan(histogram, capacity)
    held: dict[int, int] = {}
    for config, n in plan:
        assert sum(config) <= capacity
        for length in config:
            held[length] = held.get(length, 0) + n
    assert held == histogram
    bins: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= length]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= length
        else:
            bins.append(capacity - length)
    assert sum(n for _, n in plan) <= len(bins) + 1 + len(bins) // 50


def test_plan_beats_best_fit_where_that_is_not_optimal():
    """Three kinds of pieces of which only 4 + 3 + 3 fills a sequence."""
    plan = packing_plan.plan({4: 60, 3: 120}, 10)
    assert sum(n for _, n in plan) == 60
    assert packing_plan.plan({}, 10) == [] and packing_plan.plan({10: 7}, 10) == [((10,), 7)]


def test_knapsack_is_the_greatest_price():
    rng = np.random.default_rng(4)
    lengths, prices = np.array([3, 4, 7]), rng.random(3)
    best = packing_plan.knapsack(prices, lengths, 20)
    for c in range(21):
        every = [a * prices[0] + b * prices[1] + d * prices[2] for a in range(7) for b in range(6) for d in range(3) if 3 * a + 4 * b + 7 * d <= c]
        assert best[c] == pytest.approx(max(every))


def test_plan_grows_with_lengths_not_with_pieces():
    some = packing_plan.plan({k: 5_000_000_000 for k in range(1, 100)}, 100)
    assert sum(n for _, n in some) <= 1.01 * 5_000_000_000 * sum(range(1, 100)) / 100
    assert len(some) < 20_000


# ---- filter audit


def plain_audit(docs, labels):
    failing = {}
    first = {}
    for r in docs:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    for i, r in enumerate(docs):
        text = r.text or ""
        w = WORD.findall(text)
        failing[i] = {
            f
            for f, x in (
                ("A", len(w) < 100),
                ("B", 100 * len(set(w)) < 80 * len(w)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
                ("D", re.search(r"[#$%&*|]", text) is not None),
                ("E", r.doc_id is not None and r.doc_id > first[text]),
            )
            if x
        }
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    out, shapley = [], {}
    for part in {r.lang or "" for r in docs}:
        mine = [i for i, r in enumerate(docs) if (r.lang or "") == part]
        for order in map("".join, permutations("ABCDE")):
            alive = set(mine)
            for step, f in enumerate(order, 1):
                gone = {i for i in alive if f in failing[i]}
                again = sum(f in failing[i] for i in mine) - len(gone)
                alive -= gone
                alone = sum(failing[i] == {f} for i in mine)
                lost = [sum(docs[i].doc_id in s for i in gone) for s in (good, toxic)]
                out.append((part, order, step, len(alive), len(gone), again, alone, *lost))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit_by_brute_force(spark, sf, edge_docs, no_docs):
    copies = edge_docs.unionAll(edge_docs.withColumn("doc_id", F.col("doc_id") + 100)).withColumn("filter", F.lit("x")).withColumn("id", F.lit(1))
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (107, 1, 1), (None, 1, 1), (999, 1, 1), (8, None, 1)], "doc_id long, quality int, toxic int")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = filter_audit.audit(copies, labels).select(columns).collect()
    assert sorted(map(tuple, got)) == plain_audit(copies.collect(), labels.collect())
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert {r.good_lost for r in filter_audit.audit(edge_docs, labels.where("false")).collect()} == {0}


def test_filter_audit_takes_other_filters(spark, edge_docs):
    filters = [("P", F.length("text_") > 50), ("Q", F.col("words_") == 0)]
    got = filter_audit.audit(edge_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), filters, None).collect()
    assert {r.filter_order for r in got} == {"PQ", "QP"} and len(got) == 2 * 2 * len({r.lang for r in edge_docs.collect()})


@pytest.mark.parametrize("shares", [1, 4_096])
def test_copies_are_found_on_either_side_of_the_limit(spark, sf, monkeypatch, shares):
    monkeypatch.setattr(filter_audit, "SHARES", shares)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = filter_audit.audit(docs, labels).select(columns).collect()
    assert sorted(map(tuple, got)) == plain_audit(docs.select("doc_id", "text", "lang").collect(), labels.collect())
