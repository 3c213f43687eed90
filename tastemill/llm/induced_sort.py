"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes are typed S or L by whether the next one is larger or smaller. Those of type S after an L (here: seeds) are
sorted through the text of the ranks of the pieces between them, by the same routine; L suffixes are then induced from
the seeds in rising order and S suffixes from the L ones in falling order. Suffixes travel as tuples (first symbol,
place, common prefix with the one before of that symbol) through priority queues that keep sorted runs on disk; a run
of tuples is taken at once as long as nothing it induces belongs before its end. Sequences of results spill as well.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples that a queue or sequence keeps in memory before it writes a run.
IN_MEMORY = 1 << 20


class Folder:
    """A folder of spilled runs that goes with the task."""

    def __init__(self) -> None:
        self.held: tempfile.TemporaryDirectory | None = None
        self.count = 0

    def put(self, array: np.ndarray) -> np.ndarray:
        """The array as a file mapped into memory."""
        if self.held is None:
            self.held = tempfile.TemporaryDirectory(prefix="suffix-runs-")
        self.count += 1
        path = os.path.join(self.held.name, f"{self.count}.npy")
        np.save(path, array)
        out = np.load(path, mmap_mode="r")
        os.unlink(path)  # the mapping keeps the data; nothing stays when the task ends
        return out

    def close(self) -> None:
        if self.held is not None:
            self.held.cleanup()


NEVER = 1 << 62
TUPLE = np.dtype([("key", "<i8"), ("at", "<i8"), ("common", "<u2")])


class Queue:
    """Priority queue of tuples by key, first in first out among equal keys; long runs lie on disk."""

    def __init__(self, folder: Folder, in_memory: int):
        self.folder, self.in_memory = folder, in_memory
        self.runs: list[np.ndarray] = []
        #: Whether the last call of ``least`` returned all that the queue holds.
        self.complete = True

    def push(self, key: np.ndarray, at: np.ndarray, common: np.ndarray) -> None:
        if not len(key):
            return
        run = np.empty(len(key), TUPLE)
        order = np.argsort(key, kind="stable")
        run["key"], run["at"], run["common"] = key[order], at[order], common[order]
        self.runs.append(run)
        while len(self.runs) > 1 and len(self.runs[-2]) <= 2 * len(self.runs[-1]):
            pair = self.runs[-2:]
            if sum(map(len, pair)) > 4 * self.in_memory:
                break
            both = np.concatenate(pair, dtype=TUPLE)
            self.runs[-2:] = [both[np.argsort(both["key"], kind="stable")]]
        if len(self.runs[-1]) > self.in_memory:
            self.runs[-1] = self.folder.put(self.runs[-1])

    def least(self, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``want`` or more of the least tuples in order, and the run each is from."""
        heads = [r[:want] for r in self.runs]
        # where a run goes on, tuples behind its last one here aren't certain yet
        ends = [(int(h["key"][-1]), k) for k, (h, r) in enumerate(zip(heads, self.runs, strict=True)) if len(h) < len(r)]
        self.complete = not ends
        found = np.concatenate(heads, dtype=TUPLE)
        source = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        order = np.argsort(found["key"], kind="stable")
        found, source = found[order], source[order]
        if ends:
            key, run = min(ends)
            sure = (found["key"] < key) | ((found["key"] == key) & (source <= run))
            found, source = found[sure], source[sure]
        return found, source

    def drop(self, source: np.ndarray) -> None:
        taken = np.bincount(source, minlength=len(self.runs))
        self.runs = [r[t:] for r, t in zip(self.runs, taken.tolist(), strict=True) if t < len(r)]


class Sequence:
    """Arrays appended one after another, on disk where they are many; read in either direction."""

    def __init__(self, folder: Folder, in_memory: int):
        self.folder, self.in_memory = folder, in_memory
        self.parts: list[np.ndarray] = []
        self.small: list[np.ndarray] = []
        self.size = 0

    def add(self, part: np.ndarray) -> None:
        if len(part):
            self.small.append(part)
            self.size += len(part)
            if self.size > self.in_memory:
                self._pack()

    def _pack(self) -> None:
        if self.small:
            joined = np.concatenate(self.small, dtype=self.small[0].dtype)
            self.parts.append(self.folder.put(joined) if len(joined) > self.in_memory else joined)
            self.small, self.size = [], 0

    def read(self, backwards: bool = False) -> Iterator[np.ndarray]:
        self._pack()
        for part in reversed(self.parts) if backwards else self.parts:
            yield part[::-1] if backwards else part


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last symbol is the least and counts as S."""
    n = len(text)
    is_s = np.ones(n, bool)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    decided = np.nonzero(step)[0]
    if len(decided):
        # an equal step takes the type of the next that is not
        nxt = np.searchsorted(decided, np.arange(n - 1))
        ok = nxt < len(decided)
        is_s[: n - 1][ok] = step[decided[nxt[ok]]] > 0
    return is_s


def _ranks_of_pieces(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Dense ranks of the pieces of text from each seed to the next, by symbol and type."""
    sign = 2 * text.astype(np.int64) + is_s
    length = np.append(np.diff(seeds) + 1, 1)
    rank = np.zeros(len(seeds), np.int64)
    open_ = np.arange(len(seeds))
    depth, wide = 0, 4 if int(sign.max()) < (1 << 15) else 1
    while len(open_):
        key = np.zeros(len(open_), np.int64)
        for k in range(depth, depth + wide):
            there = k < length[open_]
            value = np.zeros(len(open_), np.int64)
            value[there] = sign[seeds[open_[there]] + k] + 1
            key = (key << 16) | value if wide > 1 else value
        order = np.lexsort((key, rank[open_]))
        open_, key = open_[order], key[order]
        old = rank[open_]
        first = np.ones(len(open_), bool)
        first[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        group = np.ones(len(open_), bool)
        group[1:] = old[1:] != old[:-1]
        place = np.arange(len(open_))
        start = np.maximum.accumulate(np.where(group, place, 0))
        head = np.maximum.accumulate(np.where(first, place, 0))
        rank[open_] = old + head - start
        alone = first & np.append(first[1:], True)
        depth += wide
        open_ = open_[~alone & (length[open_] > depth)]
    return np.unique(rank, return_inverse=True)[1]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Equal symbols at the starts of suffixes, up to ``most``."""
    out = np.zeros(len(a), np.uint16)
    open_ = np.arange(len(a))
    for k in range(most):
        i, j = a[open_] + k, b[open_] + k
        inside = (i < len(text)) & (j < len(text))
        open_ = open_[inside]
        open_ = open_[text[i[inside]] == text[j[inside]]]
        if not len(open_):
            break
        out[open_] = k + 1
    return out


class _Gaps:
    """Least common prefix since the last tuple of each symbol, along the order in which suffixes are processed."""

    def __init__(self, symbols: int, most: int):
        self.most = most
        self.since = np.zeros(symbols, np.uint16)

    def of(self, symbol: np.ndarray, place: np.ndarray, between: np.ndarray) -> np.ndarray:
        """For pushes of ``symbol`` by the processed ``place``: least of ``between`` since the symbol's last push.

        ``between[k]`` is the common prefix of the k-th processed suffix and the one before it.
        """
        out = np.zeros(len(symbol), np.uint16)
        if len(between):
            for s in np.unique(symbol).tolist():
                mine = np.nonzero(symbol == s)[0]
                at = place[mine]
                bounds = np.append(at + 1, len(between)) if at[-1] + 1 < len(between) else at + 1
                lows = np.minimum.reduceat(between, np.append(0, bounds[:-1]))
                lows[0] = min(lows[0], self.since[s])
                out[mine] = lows[: len(mine)]
                self.since[s] = lows[len(mine)] if len(lows) > len(mine) else self.most
            others = np.ones(len(self.since), bool)
            others[np.unique(symbol)] = False
            self.since[others] = np.minimum(self.since[others], between.min())
        return out


def _equal_before(text: np.ndarray) -> np.ndarray:
    """How many symbols right before each place equal the one there."""
    place = np.arange(len(text))
    starts = np.where(np.append(True, text[1:] != text[:-1]), place, 0)
    return place - np.maximum.accumulate(starts)


def _bucket(queue: Queue, symbol_key: int, want: int, at_most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All tuples of the least key and the runs they are from; None if they are more than ``at_most``."""
    while True:
        found, source = queue.least(want)
        n = int(np.searchsorted(found["key"], symbol_key, side="right"))
        if n > at_most:
            return None
        if n < len(found) or queue.complete:
            return found[:n], source[:n]
        want *= 2


def _induce(
    text: np.ndarray, is_s: np.ndarray, given: Iterator[np.ndarray], down: bool, folder: Folder, in_memory: int, most: int
) -> Sequence:
    """Suffixes of one type in order (falling if ``down``), each with its common prefix with the one before.

    ``given`` yields parts (at, common) of the sorted suffixes that start the induction, in the order of processing:
    of one symbol they come after the induced ones. With ``most`` 0 common prefixes are not carried.
    """
    turn = -1 if down else 1
    out, queue = Sequence(folder, in_memory), Queue(folder, in_memory)
    gaps = _Gaps(int(text.max()) + 1, most) if most else None
    parts = iter(given)
    head = next(parts, None)
    ask = 256
    last_at, last_key, last_given = -1, NEVER, False
    nothing = np.zeros(0, TUPLE)
    alike = None if most else _equal_before(text)

    while queue.runs or head is not None:
        queued, source = queue.least(ask) if queue.runs else (nothing, np.zeros(0, np.int64))
        if head is not None:
            ready = np.array(head[:ask])
            ready["key"] = turn * text[ready["at"]].astype(np.int64)
            if len(head) > ask or not queue.complete:
                # behind the end of either stream here the other's tuples aren't certain
                queued_end = int(queued["key"][-1]) if len(queued) and not queue.complete else NEVER
                ready = ready[ready["key"] < queued_end]
                if len(head) > ask and len(ready):
                    sure = queued["key"] <= int(ready["key"][-1])
                    queued, source = queued[sure], source[sure]
            elif len(queued):
                # the next part of the given suffixes may start with the last symbol of this one, never before it
                sure = queued["key"] <= int(ready["key"][-1])
                queued, source = queued[sure], source[sure]
        else:
            ready = nothing
        both = np.concatenate([queued, ready], dtype=TUPLE)
        is_given = np.arange(len(both)) >= len(queued)
        order = np.argsort(2 * both["key"] + is_given, kind="stable")
        both, is_given = both[order], is_given[order]
        key, at = both["key"], both["at"]
        if alike is not None and not is_given[0] and alike[at[: np.searchsorted(key, key[0], side="right")]].any():
            # a run of one symbol induces itself place by place: all its places at once, the ends of all runs first
            whole = _bucket(queue, int(key[0]), ask, in_memory)
            if whole is not None:
                heads, source = whole
                queue.drop(source)
                many = alike[heads["at"]] + 1
                which = np.repeat(np.arange(len(heads)), many)
                back = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                order = np.argsort(back, kind="stable")
                row = np.zeros(len(which), TUPLE)
                row["key"], row["at"] = key[0], (heads["at"][which] - back)[order]
                out.add(row)
                before = row["at"][(back == many[which] - 1)[order]] - 1
                before = before[before >= 0]
                before = before[is_s[before] == down]
                queue.push(turn * text[before].astype(np.int64), before, np.zeros(len(before), np.uint16))
                continue
        before = at - 1
        ok = before >= 0
        ok[ok] = is_s[before[ok]] == down
        induced = np.full(len(at), NEVER)
        induced[ok] = turn * text[before[ok]].astype(np.int64)
        # what is induced goes behind queued tuples of its symbol and before given ones
        bound = np.minimum.accumulate(induced)
        safe = np.ones(len(at), bool)
        safe[1:] = key[1:] + is_given[1:] <= bound[:-1]
        n = len(at) if safe.all() else int(np.argmin(safe))
        key, at, before, ok, is_given, common = key[:n], at[:n], before[:n], ok[:n], is_given[:n], both["common"][:n].copy()
        n_given = int(is_given.sum())
        queue.drop(source[: n - n_given])
        if n_given:
            head = head[n_given:] if n_given < len(head) else next(parts, None)
        ask = max(256, min(in_memory, 2 * n))
        if most:
            same = np.append(last_key, key[:-1]) == key
            was_given = np.append(last_given, is_given[:-1])
            common[~same] = 0
            meet = np.nonzero(same & (was_given != is_given))[0]
            if len(meet):
                common[meet] = common_prefix(text, np.append(last_at, at[:-1])[meet], at[meet], most)
        last_at, last_key, last_given = int(at[-1]), int(key[-1]), bool(is_given[-1])
        row = np.empty(n - n_given, TUPLE)
        row["key"], row["at"], row["common"] = key[~is_given], at[~is_given], common[~is_given]
        out.add(row)
        place = np.nonzero(ok)[0]
        symbol = text[before[place]].astype(np.int64)
        if most:
            carried = np.minimum(gaps.of(symbol, place, common) + 1, most).astype(np.uint16)
        else:
            carried = np.zeros(len(place), np.uint16)
        queue.push(turn * symbol, before[place], carried)
    return out


def _seed_order(text: np.ndarray, folder: Folder, in_memory: int) -> tuple[np.ndarray, np.ndarray]:
    """(types, places of seeds in suffix order); the last symbol must be the only least one."""
    is_s = types(text)
    seeds = np.nonzero(is_s[1:] & ~is_s[:-1])[0] + 1
    if not len(seeds):
        return is_s, np.array([len(text) - 1])
    names = _ranks_of_pieces(text, is_s, seeds)
    if int(names.max()) + 1 == len(seeds):
        return is_s, seeds[np.argsort(names)]
    order = np.concatenate([p["at"] for p in suffix_order(names, folder, in_memory, 0)])
    return is_s, seeds[order[::-1]]


def suffix_order(text: np.ndarray, folder: Folder, in_memory: int = IN_MEMORY, most: int = 0) -> Iterator[np.ndarray]:
    """Parts of (key: symbol, at: place, common: prefix shared with the suffix before, up to ``most``), in falling order.

    ``common`` relates a suffix to the next larger one, which comes before it here.
    """
    is_s, seeds = _seed_order(text, folder, in_memory)

    def with_common(places: np.ndarray) -> Iterator[np.ndarray]:
        for lo in range(0, len(places), in_memory):
            part = places[lo : lo + in_memory]
            row = np.zeros(len(part), TUPLE)
            row["at"] = part
            if most:
                first = max(1, lo)
                row["common"][first - lo :] = common_prefix(text, places[first - 1 : lo + len(part) - 1], places[first : lo + len(part)], most)
            yield row

    rising = _induce(text, is_s, with_common(seeds), False, folder, in_memory, most)

    def falling_l() -> Iterator[np.ndarray]:
        held = 0  # the common prefix of a suffix with the one after it belongs to that one when read backwards
        for part in rising.read(backwards=True):
            row = np.array(part)
            row["common"][0] = held
            row["common"][1:] = part["common"][:-1]
            held = int(part["common"][-1])
            yield row

    falling_s = _induce(text, is_s, falling_l(), True, folder, in_memory, most)
    yield from _merged(text, falling_s, falling_l(), most)
    end = np.zeros(1, TUPLE)  # the least suffix is the last symbol alone, which nothing induces
    end["at"] = len(text) - 1
    yield end


def _merged(text: np.ndarray, s_part: Sequence, l_parts: Iterator[np.ndarray], most: int) -> Iterator[np.ndarray]:
    """All suffixes in falling order: of each symbol those of type S, then those of type L."""
    streams = [iter(s_part.read()), l_parts]
    heads = [next(x, None) for x in streams]
    last_at, last_key = -1, NEVER

    while any(h is not None for h in heads):
        keys = [None if h is None else 2 * -text[h["at"]].astype(np.int64) + k for k, h in enumerate(heads)]
        # up to the end of the head that ends first, nothing that comes later belongs before
        end = min(int(k[-1]) for k in keys if k is not None)
        counts = [0 if k is None else int(np.searchsorted(k, end, side="right")) for k in keys]
        rows = np.concatenate([h[:n] for h, n in zip(heads, counts, strict=True) if n], dtype=TUPLE)
        key = np.concatenate([k[:n] for k, n in zip(keys, counts, strict=True) if n])
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        if most:
            before_at, before_key = np.append(last_at, rows["at"][:-1]), np.append(last_key, key[:-1])
            rows["common"][before_key >> 1 != key >> 1] = 0
            meet = np.nonzero((before_key >> 1 == key >> 1) & (before_key != key))[0]
            rows["common"][meet] = common_prefix(text, before_at[meet], rows["at"][meet], most)
        last_at, last_key = int(rows["at"][-1]), int(key[-1])
        yield rows
        heads = [
            None if h is None else h[n:] if n < len(h) else next(x, None)
            for h, n, x in zip(heads, counts, streams, strict=True)
        ]
