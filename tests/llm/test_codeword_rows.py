"""Near-duplicates: rows meet by codeword, keys are made where they meet, pairs that cannot resemble stay there."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tastemill.llm import simhash


def test_sketches_never_rule_out_a_pair_that_resembles():
    rng = random.Random(2)
    ruled_out = 0
    for n in (0, 1, 3, 40, 400, 9_000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for share in (0.0, 0.02, 0.2, 1.0):
            other = [rng.choice("abc") + w if rng.random() < share else w for w in words]
            texts = " ".join(words), " ".join(other)
            _, sizes, sketches = zip(*(simhash._described(t.encode(), 5, (42, 43), True) for t in texts))
            a, b = (s[None, :] for s in sketches)
            for least in (0.0, 0.5, 0.8, 1.0):
                may = simhash.may_resemble(a, b, np.array([sum(sizes)]), least)[0]
                assert may or simhash.resemblance(*texts, 5) < least
                ruled_out += not may
    assert ruled_out


def rows_of(prints, sizes, slices):
    """Rows as ``resembling_links`` sends them, of one table, in order."""
    code = simhash.Golay()
    out = []
    for k, (a, b) in enumerate(simhash.QUARTERS[1]):
        words = [(prints[0] >> np.uint64(simhash.QUARTERS[0][x][0]) & np.uint64(0xFFFF)).astype(np.uint32) for x in (a, b)]
        own, other = (code.keys(w, True) for w in words)
        for i in range(len(own)):
            for x in own[i][own[i] >= 0]:
                out += [(int(x) | k << simhash.MESSAGE_BITS, s, i) for s in {int(y) % slices for y in other[i][other[i] >= 0]}]
    out.sort()
    node = np.array([x[2] for x in out])
    signed = [p.view(np.int64)[node] for p in prints]
    sketch = [np.full(len(node), -1)] * (simhash.SKETCH // 8)
    return [np.array([x[0] for x in out], np.int32), np.array([x[1] for x in out], np.int32), node, *signed, sizes[node], *sketch, node]


@pytest.mark.parametrize("slices,side,rows,most_rows", [(1, 2048, 10**5, 10**6), (4, 2048, 7, 10**6), (1, 3, 20, 10**6), (2, 4, 5, 9), (1, 2048, 3, 12)])
def test_words_connect_what_keys_connect(monkeypatch, slices, side, rows, most_rows):
    for name, value in (("SIDE_ROWS", side), ("WORD_ROWS", rows), ("MOST_WORD_ROWS", most_rows), ("PAIR_BLOCK", 40)):
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, (2, 6)).astype(np.uint64)
    prints = [np.repeat(p, 9) for p in base]
    for p in prints:
        for _ in range(4):
            p ^= np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64)
    code = simhash.Golay()
    want = set()
    held = {}
    for row, key in zip(*simhash.pair_keys(prints[0], 0, True, code, simhash.QUARTERS)):
        held.setdefault(int(key), []).append(int(row))
    flips = lambda i, j: sum(int(p[i] ^ p[j]).bit_count() for p in prints)
    for found in held.values():
        want |= {(i, j) for i in found for j in found if i < j and flips(i, j) <= 37}
    cols = rows_of(prints, np.full(len(prints[0]), 10), slices)
    names = ["word", "slice", *simhash._carried()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + 4]) for c in cols], names) for at in range(0, len(cols[0]), 4)]
    found, by_key = set(), {}
    for out in simhash._worded(1, 37, 0, 0.8, slices)(iter(batches)):
        for r in out.to_pylist():
            if r["key"] is None:
                found.add((r["a"], r["b"]))
            else:
                by_key.setdefault(r["key"], []).append(r["node"])
    assert found <= want and all(len(set(x)) == len(x) and sorted(x) == sorted(held[k]) for k, x in by_key.items())
    assert bool(by_key) == (side < 2048 or most_rows < 100)
    found |= {(i, j) for x in by_key.values() for i in x for j in x if i < j and flips(i, j) <= 37}

    def parts(edges):
        part = list(range(len(prints[0])))
        for _ in part:
            for i, j in edges:
                part[i] = part[j] = min(part[i], part[j])
        return part

    assert parts(found) == parts(want) and len(set(parts(want))) < len(part_ids := parts(set())) == len(part_ids)
