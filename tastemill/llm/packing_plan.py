"""Configurations of piece lengths: a linear program over the length histogram, by multiplicative weights, then rounded.

A configuration is a multiset of lengths that fits a sequence. The program asks for the least number of sequences whose
configurations cover the histogram. Weights on lengths fall as they are covered; the configurations of greatest weight
come from a knapsack by dynamic programming over the capacity; each gets as many sequences as cover half of its scarcest
length, until as many tokens are covered as there are. Whole parts of these numbers are taken, and what no configuration
takes whole is packed best-fit-decreasing. Everything here is bounded by the capacity, not by the number of pieces.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Configurations that one knapsack table gives; each holds the length of greatest weight, and weights fall at once.
AT_ONCE = 64
#: Share of its scarcest length that a configuration covers at a time, and how fast weights fall with it.
STEP, STEEPNESS = 0.5, 6.0
#: Knapsack tables at most; the program ends before if as many tokens are covered as there are.
ROUNDS = 100

#: (lengths in falling order, sequences of that kind)
Plan = list[tuple[tuple[int, ...], int]]


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Greatest price of any multiset of lengths (ascending) of sum c at most, for each c of 0..capacity."""
    by_length = np.full(capacity + 1, -np.inf)
    by_length[lengths] = prices
    least = int(lengths[0])
    back = by_length[::-1].copy()  # back[capacity - l] is the price of l
    best = np.zeros(capacity + 1)
    for c in range(least, capacity + 1):
        # best[c - l] + price(l) for l of least..c
        best[c] = max(best[c - 1], (best[: c - least + 1] + back[capacity - c : capacity - least + 1]).max())
    return best


def _configuration(first: int, value: np.ndarray, lengths: np.ndarray, left: np.ndarray, best: np.ndarray, capacity: int) -> Counter:
    """Places (in ``lengths``) of a configuration of greatest price that holds ``first``; no more of a length than are left."""
    used, room, spent = Counter([first]), capacity - int(lengths[first]), []
    if left[first] <= 1:
        spent.append(first)
    while room >= lengths[0]:
        n = int(np.searchsorted(lengths, room, side="right"))
        total = best[room - lengths[:n]] + value[:n]
        for k in spent:
            if k < n:
                total[k] = -np.inf
        k = int(total.argmax())
        if total[k] == -np.inf:
            break
        used[k] += 1
        if used[k] >= left[k]:
            spent.append(k)
        room -= int(lengths[k])
    return used


def shares(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Sequences of each configuration (places in ``lengths``, ascending) in a nearly optimal fractional cover."""
    covered = np.zeros(len(lengths))
    out: dict[tuple[int, ...], float] = {}
    total, done = float((lengths * counts).sum()), 0.0
    noise = np.random.default_rng(len(lengths))
    for _ in range(rounds):
        # a token of a short piece weighs as much as one of a long piece, but for how far it is covered
        worth = lengths * (1 + 1e-3 * noise.random(len(lengths)))
        low = covered.min()
        prices = np.exp(-STEEPNESS * (covered - low)) * worth
        best = knapsack(prices, lengths, capacity)
        for _ in range(AT_ONCE):
            config = _configuration(int(np.argmax(prices)), prices, lengths, counts, best, capacity)
            places = np.array(list(config))
            n = np.array(list(config.values()))
            size = STEP * float((counts[places] / n).min())
            key = tuple(sorted(config.elements()))
            out[key] = out.get(key, 0.0) + size
            covered[places] += size * n / counts[places]
            prices[places] = np.exp(-STEEPNESS * (covered[places] - low)) * worth[places]
            done += size * float((lengths[places] * n).sum())
        if done >= total:
            break
    return out


def rounded(found: dict[tuple[int, ...], float], counts: np.ndarray, lengths: np.ndarray) -> dict[tuple[int, ...], int]:
    """Whole parts of the shares as far as pieces last, then one more by falling remainder; takes from ``counts``.

    Configurations that are emptier than the program's average are left to what follows.
    """
    out: dict[tuple[int, ...], int] = {}
    filled = {c: int(lengths[list(c)].sum()) for c in found}
    average = sum(filled[c] * x for c, x in found.items()) / sum(found.values())

    def take(config: tuple[int, ...], most: int) -> None:
        places, n = np.unique(np.array(config), return_counts=True)
        k = min(most, int((counts[places] // n).min()))
        if k > 0:
            counts[places] -= k * n
            out[config] = out.get(config, 0) + k

    order = sorted((c for c in found if filled[c] >= average), key=lambda c: (-found[c], c))
    for config in order:
        take(config, int(found[config]))
    for config in sorted(order, key=lambda c: (int(found[c]) - found[c], c)):
        take(config, 1)
    return out


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit-decreasing of the pieces that are left, kinds of open sequences at a time and not one by one."""
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]  # by room, kinds and how many

    def put(kind: tuple[int, ...], room: int, n: int) -> None:
        if n:
            open_[room][kind] = open_[room].get(kind, 0) + n

    for length, n in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        room = length
        while n and room <= capacity:
            if not open_[room]:
                room += 1
                continue
            kind, held = open_[room].popitem()
            fit = min(room // length, n)  # the tightest room goes on taking pieces of this length
            full, rest = min(held, n // fit), 0
            put((*kind, *[length] * fit), room - fit * length, full)
            n -= full * fit
            if full < held and n:
                rest, n = n, 0
                put((*kind, *[length] * rest), room - rest * length, 1)
            put(kind, room, held - full - (rest > 0))
        fit = capacity // length
        put((length,) * fit, capacity - fit * length, n // fit)
        if n % fit:
            put((length,) * (n % fit), capacity - n % fit * length, 1)
    out: dict[tuple[int, ...], int] = {}
    for kinds in open_:
        for kind, n in kinds.items():
            out[kind] = out.get(kind, 0) + n
    return out


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Kinds of sequences and how many of each hold all pieces of the histogram (length: pieces)."""
    out: dict[tuple[int, ...], int] = {}

    def add(config: tuple[int, ...], n: int) -> None:
        key = tuple(sorted(config, reverse=True))
        out[key] = out.get(key, 0) + n

    kept = dict(histogram)
    if kept.get(capacity):
        add((capacity,), kept.pop(capacity))
    lengths = np.array(sorted(k for k, n in kept.items() if n), np.int64)
    counts = np.array([kept[int(k)] for k in lengths], np.int64)
    if len(lengths):
        for config, n in rounded(shares(lengths, counts.copy(), capacity), counts, lengths).items():
            add(tuple(lengths[list(config)].tolist()), n)
    for config, n in best_fit(lengths, counts, capacity).items():
        add(config, n)
    return sorted(out.items(), reverse=True)
