"""Partners found by lists of groups against brute force, with every cut forced."""

from __future__ import annotations

import math
import random

import pytest

from tastemill.operators import listed
from tastemill.operators import similarity as s

WEIGHTS = [{"weight": "base"}, {"weight": "damped"}, {"weight": "decay"}, {"rating": "rating"}]


def made(kind):
    """(user, item, ts, rating): one user holds most items, one item is with most users; a null, a missing time."""
    rnd = random.Random(8)
    pairs = {(0, i) for i in range(90)} | {(u, 3) for u in range(60)}
    pairs |= {(u, i) for u in range(60) for i in rnd.sample(range(100), rnd.randint(1, 6))}
    rows = [(u, i, rnd.choice([None, *range(0, 40 * 86400, 1000)]), float(rnd.randint(0, 300))) for u, i in sorted(pairs)]
    if kind == "string":
        return [(f"u{u}", f"i{i:02d}", ts, x + 0.5) for u, i, ts, x in rows]
    return [*rows, (None, 5, 0, 1.0), (4, None, 0, 1.0)]


def brute(rows, k, weight="base", rating=None):
    degree, sizes, norm, users = {}, {}, {}, {}
    for u, i, ts, x in rows:
        degree[i] = degree.get(i, 0) + 1
        sizes[u] = sizes.get(u, 0) + 1
        norm[i] = norm.get(i, 0.0) + x * x
        if u is not None and i is not None:
            users.setdefault(u, []).append((i, ts or 0, x))
    sums = {}
    for u, held in users.items():
        for a, ta, xa in held:
            for b, tb, xb in held:
                if a == b:
                    continue
                gain = 1.0
                if rating:
                    gain = xa * xb
                elif weight == "damped":
                    gain = 1 / math.log10(1 + sizes[u])
                elif weight == "decay":
                    gain = 1 / (1 + abs(ta - tb) / 86400)
                sums[(a, b)] = sums.get((a, b), 0.0) + gain
    by = norm if rating else degree
    near = {}
    for (a, b), x in sums.items():
        if x > 0:
            near.setdefault(a, []).append((-round(x / math.sqrt(by[a] * by[b]), 6), b))
    return {(a, n + 1): (b, -x) for a, found in near.items() for n, (x, b) in enumerate(sorted(found)[:k])}


def lists_only(monkeypatch):
    """Members count as so many that tiles would copy too much; a table of pairs is an error."""

    def pairs(*_args, **_kw):
        raise AssertionError("a row for every pair of members")

    monkeypatch.setattr(s, "block_count", lambda *_: 10**6)
    monkeypatch.setattr(s, "shared_pairs", pairs)


@pytest.mark.parametrize("kw", WEIGHTS, ids=lambda kw: next(iter(kw.values())))
@pytest.mark.parametrize(("kind", "part", "member"), [("string", 10**6, 10**6), ("long", 20, 300)])
def test_lists_find_what_brute_force_finds(monkeypatch, spark, kw, kind, part, member):
    lists_only(monkeypatch)
    monkeypatch.setattr(listed, "PART", part)
    monkeypatch.setattr(listed, "MEMBER_ENTRIES", member)
    monkeypatch.setattr(listed, "ENTRIES", 8000)
    monkeypatch.setattr(listed, "CELLS", 150)
    rows = made(kind)
    key = "long" if kind == "long" else "string"
    df = spark.createDataFrame(rows, f"user_id {key}, item_id {key}, ts long, rating double")
    got = {(r.a, r["rank"]): (r.b, r.score) for r in s.most_similar(df, "user_id", "item_id", 4, **kw).collect()}
    want = brute(rows, 4, **kw)
    assert got.keys() == want.keys()
    assert [got[x][1] for x in want] == pytest.approx([y for _, y in want.values()], abs=1.01e-6)
    same = [got[x][0] == want[x][0] for x in want]
    assert sum(same) > 0.97 * len(same)  # the order of a sum may flip a tie of the sixth decimal


@pytest.mark.parametrize("kw", WEIGHTS, ids=lambda kw: next(iter(kw.values())))
def test_an_entry_takes_few_bytes(monkeypatch, spark, kw):
    monkeypatch.setattr(listed, "ENTRIES", 8000)
    df = spark.createDataFrame(made("long")[:-2], "user_id long, item_id long, ts long, rating double")
    layout, _ = listed._layout(
        s._list_rows(df, "user_id", "item_id", ts="ts", **({"weight": "base"} | {"rating": None} | kw))
        .withColumnRenamed("key", "id")
    )
    assert layout.itemsize <= 10


def test_ranges_choose_types_that_hold_every_value():
    assert listed._narrowest(0, 255, True) == "u1"
    assert listed._narrowest(0, 256, True) == "<u2"
    assert listed._narrowest(0, 2**32 - 1, True) == "<u4"
    for low, high, whole in ((-1, 5, True), (0, 2**32, True), (0, 5, False)):
        assert listed._narrowest(low, high, whole) == "<f8"


def test_nothing_to_pair(monkeypatch, spark):
    lists_only(monkeypatch)
    df = spark.createDataFrame([(1, 1, 0, 1.0), (2, 2, 0, 1.0)], "user_id long, item_id long, ts long, rating double")
    assert s.most_similar(df, "user_id", "item_id", 4).count() == 0
