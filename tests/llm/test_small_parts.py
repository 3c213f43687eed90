"""Parts without Spark against plain versions of themselves."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from tastemill.llm import byte_bpe, html_text, induced_sort, mixing, sharding, simhash, suffix_dedup, token_files, word_tokens


@pytest.mark.parametrize("in_memory", [4, 1 << 20])
def test_suffix_order_and_common_prefixes(in_memory):
    rng = np.random.default_rng(3)
    for trial in range(120):
        n, k = int(rng.integers(0, 50)), int(rng.integers(1, 5))
        body = rng.integers(1, 1 + k, n)
        if trial % 4 == 0 and n:
            body = np.tile(body[: max(1, n // 3)], 3)
        text = np.append(body, 0)
        folder = induced_sort.Folder()
        rows = np.concatenate(list(induced_sort.suffix_order(text, folder, in_memory, 6)))
        folder.close()
        t = text.tolist()
        falling = sorted(range(len(t)), key=lambda i: t[i:], reverse=True)
        assert rows["at"].tolist() == falling

        def shared(a, b):
            m = 0
            while m < 6 and max(a, b) + m < len(t) and t[a + m] == t[b + m]:
                m += 1
            return m

        assert rows["common"].tolist() == [0] + [shared(a, b) for a, b in zip(falling, falling[1:], strict=False)]


@pytest.mark.parametrize("in_memory", [3, 1 << 20])
@pytest.mark.parametrize("most", [0, 5])
def test_suffix_order_of_long_runs_and_periods(in_memory, most):
    rng = np.random.default_rng(11)
    for trial in range(40):
        pieces = []
        for _ in range(int(rng.integers(1, 6))):
            period = rng.integers(1, 4, int(rng.integers(1, 7)))
            pieces.append(np.tile(period, int(rng.integers(1, 25))))
            pieces.append(rng.integers(1, 5, int(rng.integers(0, 4))))
        text = np.append(np.concatenate(pieces), 0)
        folder = induced_sort.Folder()
        at = np.concatenate([p["at"] for p in induced_sort.suffix_order(text, folder, in_memory, most)])
        folder.close()
        t = text.tolist()
        assert at.tolist() == sorted(range(len(t)), key=lambda i: t[i:], reverse=True)


def test_shard_settles_equal_stretches_like_brute_force():
    rng = random.Random(12)
    window, gram = 12, b"GRAM"
    for _ in range(60):
        sides = [bytes(rng.choices(b"ab", k=10)) for _ in range(3)]
        stretches = {}
        for key in range(rng.randint(2, 12)):
            # a stretch is all windows around its gram, so it reaches at most a window less the gram to either side
            left = rng.choice(sides)[-rng.randint(1, 8) :]
            body = left + gram + rng.choice(sides)[: rng.randint(0, 8)]
            if len(body) >= window:
                stretches[rng.randint(1, 2), body] = (key, len(left))
        rows = sorted((g, key, at, body) for (g, body), (key, at) in stretches.items())
        shard = suffix_dedup.Shard(window)
        found = list(shard.add(*([r[k] for r in rows] for k in range(4)))) + list(shard.sort())
        assert shard.size == 0 and not shard.open
        got = {}
        for g, key, places in found:
            got.setdefault((g, key), set()).update(places.tolist())
        want = {}
        for g, key, at, body in rows:
            for s in range(len(body) - window + 1):
                same = [
                    1 for h, other, _, text in rows for r in range(len(text) - window + 1)
                    if g == h and (key, s) != (other, r) and body[s : s + window] == text[r : r + window]
                ]
                if same:
                    want.setdefault((g, key), set()).add(s)
        assert got == want


def test_shards_repeats_by_brute_force():
    rng = random.Random(5)
    words = [bytes(rng.choices(b"abc", k=rng.randint(1, 9))) for _ in range(12)]
    contents = [b" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(25)]
    window = 12
    found = suffix_dedup.shard_repeats(contents, window)
    seen: dict[bytes, int] = {}
    for c in contents:
        for i in range(len(c) - window + 1):
            seen[c[i : i + window]] = seen.get(c[i : i + window], 0) + 1
    for c, got in zip(contents, found, strict=True):
        assert got.tolist() == [i for i in range(len(c) - window + 1) if seen[c[i : i + window]] > 1]


def test_equal_windows_have_equal_anchors(monkeypatch):
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 700, dtype=np.uint8).tobytes()
    a = rng.integers(97, 123, 900, dtype=np.uint8).tobytes() + passage + b"x" * 50
    b = b"y" * 333 + passage + rng.integers(97, 123, 400, dtype=np.uint8).tobytes()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)  # long texts go in parts
    grams: list[dict[int, int]] = [{}, {}]
    for text, first, last, gram, _, at in suffix_dedup.stretches([a, b]):
        assert (at >= 0).all() and (first + at + suffix_dedup.GRAM <= last + 200).all()
        for t, lo, hi, g in zip(text, first, last, gram, strict=True):
            for w in range(lo, hi + 1):
                grams[t][w] = g
    assert sorted(grams[0]) == list(range(len(a) - 199)) and sorted(grams[1]) == list(range(len(b) - 199))
    assert [grams[0][900 + i] for i in range(501)] == [grams[1][333 + i] for i in range(501)]


def test_no_repeated_window_is_trimmed():
    rng = random.Random(8)
    window, gram = 12, b"GRAM"
    for _ in range(40):
        sides = [bytes(rng.choices(b"ab", k=9)) for _ in range(3)]
        contents, places, grams = [], [], []
        for _ in range(rng.randint(2, 9)):
            left = rng.choice(sides)[-rng.randint(0, 8) :] if rng.random() < 0.9 else b""
            right = rng.choice(sides)[: rng.randint(0, 9)]
            body = left + gram + right
            if len(body) >= window:
                contents.append(body)
                places.append(len(left))
                grams.append(rng.randint(1, 2))
        if not contents:
            continue
        first, last = suffix_dedup.possible_windows(grams, places, contents, window)
        for i, (g, p, c) in enumerate(zip(grams, places, contents, strict=True)):
            for s in range(len(c) - window + 1):
                if not s <= p <= s + window - len(gram):
                    continue  # windows hold their gram
                repeats = any(
                    j != i and g == h and c[s : s + window] == d[q - p + s : q - p + s + window] and q - p + s >= 0
                    for j, (h, q, d) in enumerate(zip(grams, places, contents, strict=True))
                )
                assert not repeats or first[i] <= s <= last[i]


def test_runs_join_where_they_touch():
    spans = [{"first": 0, "last": 0}, {"first": 200, "last": 210}, {"first": 500, "last": 500}]
    runs = suffix_dedup.removed_runs(spans)
    assert runs == [(0, 410), (500, 700)]
    assert suffix_dedup.kept_bytes(bytes(range(256)) * 3, [(0, 410), (500, 700)]) == (bytes(range(256)) * 3)[410:500] + (bytes(range(256)) * 3)[700:]


def test_golay_keys():
    code = simhash.Golay()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 4000, dtype=np.uint32)
    near = code.keys(words, True)
    one = code.keys(words, False)[:, 0]
    assert set((near >= 0).sum(axis=1).tolist()) == {1, 6}
    for flips, sides in ((1, one), (2, None)):
        other = words.copy()
        for bit in range(flips):
            other ^= np.uint32(1) << np.uint32(3 + 7 * bit)
        theirs = code.keys(other, True)
        for w, o, mine in zip(near, theirs, sides if sides is not None else [None] * len(words), strict=True):
            keys = {int(mine)} if mine is not None else set(w.tolist()) - {-1}
            assert keys & set(o.tolist())


def test_every_pair_three_flips_apart_shares_a_key():
    code = simhash.Golay()
    rng = random.Random(2)
    a = np.array([rng.getrandbits(64) for _ in range(400)], np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b[k] ^= np.uint64(1 << bit)
    row, key = simhash.pair_keys(a, 0, False, code)
    row2, key2 = simhash.pair_keys(b, 0, True, code)
    theirs: dict[int, set[int]] = {}
    for r, k in zip(row2.tolist(), key2.tolist(), strict=True):
        theirs.setdefault(r, set()).add(k)
    shared = set()
    for r, k in zip(row.tolist(), key.tolist(), strict=True):
        if k in theirs[r]:
            shared.add(r)
    assert shared == set(range(len(a)))


def _parts(edges):
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_forests_connect_what_the_edges_connect():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.integers(0, 40, 30), rng.integers(0, 40, 30)
        keep = a != b
        a, b = a[keep], b[keep]
        weight = rng.integers(0, 9, len(a))
        want = _parts(zip(a.tolist(), b.tolist(), strict=True))
        for u, v in (simhash.forest(a, b), simhash.closest_forest(a, b, weight)):
            assert _parts(zip(u.tolist(), v.tolist(), strict=True)) == want
            assert len(u) == len(want) - len(set(want.values()))
        u, v = simhash.closest_forest(a, b, weight)
        order = np.argsort(weight, kind="stable")
        best, parts = 0, {}
        for k in order.tolist():
            x, y = int(a[k]), int(b[k])
            rx, ry = parts.get(x, x), parts.get(y, y)
            if rx != ry:
                best += int(weight[k])
                parts = {n: (ry if r == rx else r) for n, r in parts.items()} | {x: ry, y: ry}
                parts = {n: (ry if r == rx else r) for n, r in parts.items()}
        lightest = {}
        for i, j, w in zip(a.tolist(), b.tolist(), weight.tolist(), strict=True):
            lightest[min(i, j), max(i, j)] = min(w, lightest.get((min(i, j), max(i, j)), 99))
        assert sum(lightest[min(i, j), max(i, j)] for i, j in zip(u.tolist(), v.tolist(), strict=True)) <= best


@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 1 << 32])
def test_ids_survive_packing(top):
    rng = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 3000):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        if n > 50:
            ids[::41] = 2**32 - 1
        packed, exceptions = token_files.pack_ids(ids)
        assert (token_files.unpack_ids(packed, n, exceptions) == ids).all()
        blocks = -(-n // token_files.BLOCK)
        middle = token_files.unpack_ids(packed, n, exceptions, slice(blocks // 2, blocks))
        assert (middle == ids[blocks // 2 * token_files.BLOCK :]).all()
        keys, lengths, back = token_files.read_file(token_files.file_bytes([None, 7], [0, n], ids))
        assert keys == [None, 7] and lengths.tolist() == [0, n] and (back == ids).all()


def test_words_are_encoded_as_the_whole_text_is():
    encode = word_tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [
        "Don't I'm 's'T école 42% ½ ³ ЖЖ Σίσυφος ΣΑΣ \u0085 a\x1cb İstanbul ﬁ ẞ ß µ ª º <|endoftext|>x a<|startoftext|>",
        "`~^_ [] 日本語です 1234 a1b2 　x \xa0y 한국어 ́ q́ '' ''s !'s \x00 \x7f ÿÀ×÷ Ü.ß, \r\n\x0b\x0c end",
        "",
        " ",
    ]
    for text in texts:
        ids = np.frombuffer(encode(text.encode()), encode.kind).tolist()
        assert ids == encode.whole.encode(text, add_special_tokens=False).ids


def test_word_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(word_tokens, "WORDS_HELD", 5)
    encode = word_tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(40):
        text = f"alpha w{i} beta"
        ids = np.frombuffer(encode(text.encode()), encode.kind).tolist()
        assert ids == encode.whole.encode(text, add_special_tokens=False).ids
        assert len(encode.words) <= 6 and len(encode.words.older) <= 6


def test_best_fit_decreasing_by_a_plain_version():
    rng = random.Random(1)
    for _ in range(60):
        items = [(rng.randint(1, 60), i) for i in range(rng.randint(0, 80))]
        capacity = rng.randint(20, 90)
        free: list[int] = []
        where: list[list[int]] = []
        for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
            fits = [(f, k) for k, f in enumerate(free) if f >= size]
            if fits:
                _, k = min(fits)
                free[k] -= size
                where[k].append(name)
            else:
                free.append(max(capacity, size) - size)
                where.append([name])
        assert sharding.best_fit_decreasing(items, capacity) == where
        packed = sharding.pack_into(items, 7)
        assert len(packed) <= 7 and sorted(n for b in packed for n in b) == sorted(n for _, n in items)


def test_flow_serves_overlapping_sources():
    sizes = {'["a"]': 100, '["a", "b"]': 50, '["b"]': 10}
    flows = mixing.route(sizes, {"a": 100, "b": 60}, 3)
    assert sum(n for f in flows.values() for s, n in f if s == "a") == 100
    assert sum(n for f in flows.values() for s, n in f if s == "b") == 60
    assert all(sum(n for _, n in flows[p]) <= sizes[p] for p in sizes)  # once each is cheapest
    flows = mixing.route(sizes, {"a": 400, "b": 200}, 3)
    assert all(sum(n for _, n in flows[p]) <= 3 * sizes[p] for p in sizes)
    assert sum(n for f in flows.values() for _, n in f) == 480  # all there is, three times


def test_targets_are_capped_and_reshared():
    got = mixing.contract_targets({"a": 10, "b": 1000, "c": 10, None: 100})
    assert got["a"] == 30 and got["c"] == 30 and abs(sum(got.values()) - 1120) < 1e-6 and got[None] == 300


def test_pre_token_boundaries_are_certain():
    c = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "we'll   see  it's 12 'rest \n\n x" * 9
    whole = c.boundaries(text, True)
    for cut in range(1, len(text)):
        some = c.boundaries(text[:cut], False)
        assert some == whole[: len(some)]


PAGES = [
    (
        "<html><head><title>T</title><style>p{}</style></head><body><header><a href='/'>Home</a> Site name</header>"
        "<nav><ul><li><a>One</a></li><li><a>Two</a></li></ul></nav><main><h1>Big  &amp; bold</h1><p>First paragraph with"
        " some words&nbsp;in it.</p><p>Short.</p><aside>Aside words here.</aside><form>Your mail <input><button>Go</button></form>"
        "<script>var a='<p>no</p>'</script></main><div class='cookie-banner'>We use cookies on this site.</div>"
        "<section class='comments'><p>Nice article, thank you very much.</p></section><footer>All rights.</footer></body></html>",
        "Big & bold\nFirst paragraph with some words in it.\nShort.",
    ),
    (
        "<div id=nav><a>x</a></div><article>Text <b>bold<br>next</b> line<p>Second one.<ul><li>a point</ul></article><div class='ad'>Buy now.</div>",
        "Text bold next line\nSecond one.\na point",
    ),
    (
        "<body><div id='header'>Site of many words here.</div><div class='menu'><a>a</a> <a>b</a></div><div class='page'>"
        "<div class='entry-header'><h1>A title</h1></div><div class='entry-content'><p>One paragraph, of a few words.</p>"
        "<div class='advert'><p>Buy this thing today.</p></div><p>Another one</p><blockquote>Said by someone.</blockquote>"
        "<table><tr><td>cell one</td><td>cell two</td></tr></table></div><div id='comments'><article><p>I liked it a lot.</p>"
        "</article></div></div><div class='sidebar'><p>Some other text that is long enough to be read as text.</p></div>"
        "<form><p>Leave your address with us today.</p></form><div id='footer'>Made by us.</div></body>",
        "A title\nOne paragraph, of a few words.\nAnother one\nSaid by someone.\ncell one\ncell two",
    ),
    ("", ""),
    ("plain words only, a whole sentence of them.", "plain words only, a whole sentence of them."),
    ("<article><p>broken <b>markup <i>here.<p>and &lt;more&gt; &#233; text.", "broken markup here.\nand <more> é text."),
    ("<article><p>a < b and c > d, all told.</p></article>", "a < b and c > d, all told."),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text_of_pages(page, text):
    assert html_text.main_text(page, html_text.trained()) == text


def test_tree_agrees_with_most_of_its_table():
    from tastemill.llm.html_examples import labelled_blocks

    tree, right, all_ = html_text.trained(), 0, 0
    for page, labels in labelled_blocks():
        kept = tree.predict(html_text.features(html_text.blocks(page)))
        right += sum(int(k) == n for k, n in zip(kept, labels, strict=True))
        all_ += len(labels)
    assert right / all_ > 0.95


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content-sidebar-wrap'><main>{article}</main><div class='sidebar'>{beside}</div></div>",
        "<div class='ads-enabled sidebar-right'><article>{article}</article><div class='sidebar'>{beside}</div></div>",
        "<div class='layout has-sidebar'><div>{article}</div><div class='sidebar'>{beside}</div></div>",
        "<div class='post no-comments'>{article}</div><div class='related'>{beside}</div>",
        "<form id='aspnetForm'><div>{article}</div><div class='comments'>{beside}</div></form>",
        "<form id='aspnetForm'><nav><a>x</a></nav><div class='content'>{article}</div><div class='sidebar'>{beside}</div></form>",
        "<p class='text-center'>Three words.</p><div>{article}</div><div class='sidebar'>{beside}</div>",
        "<div>{article}</div><div class='text-muted'>Some three words</div><div class='sidebar'>{beside}</div>",
        "<article>{article}</article><section id='comments'><article>{beside}</article></section>",
        "<article>{article}<div class='share'>{beside}</div></article>",
    ],
)
def test_names_do_not_decide_alone(page):
    def sentence(n):
        return " ".join(["word"] * (n - 1)) + " end."

    parts = ["A title of words", sentence(44), sentence(31), sentence(23)]
    article = f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:])
    body = f"<body><nav><a>x</a> <a>y</a></nav>{page.format(article=article, beside='<p>' + sentence(20) + '</p>')}<footer>{sentence(12)}</footer></body>"
    found = html_text.main_text(body, html_text.trained()).split("\n")
    assert [x for x in found if len(x.split()) > 3] == parts  # a line of three words beside it may stay or go


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (
            "<article><p>Words before a <label>note</label> more text here.</p><p>Press <button>Go</button> to start it now.</p></article>",
            "Words before a note more text here.\nPress Go to start it now.",
        ),
        (
            "<article><p>A first paragraph of some plain words, long enough to be read.</p><div class='hidden-gems'><h2>Short title</h2>"
            "<p>A short paragraph here.</p></div></article>",
            "A first paragraph of some plain words, long enough to be read.\nShort title\nA short paragraph here.",
        ),
        ("<article><p>Some text <a href='x>y.</p><p>and more", "Some text y.\nand more"),
    ],
)
def test_inline_labels_names_and_broken_quotes(page, text):
    assert html_text.main_text(page, html_text.trained()) == text


def test_a_list_of_an_article_stays_or_goes_whole():
    six, seven = ("<li><a href=x>" + " ".join(["word"] * n) + "</a></li>" for n in (6, 7))
    page = f"<article><p>A paragraph of plain words that is long enough to be one.</p><ul>{six}{seven}</ul></article>"
    assert len(html_text.main_text(page, html_text.trained()).split("\n")) in (1, 3)


@pytest.mark.parametrize(
    "piece", ["<b>x</i>", "<i><div><b>x</i>", "<div class='ad'>word ", "<a \">\" ", "<h2><a>x", "<p><label>x", "</p></u>x<span>"]
)
def test_time_does_not_grow_with_nesting(piece):
    import time

    page = piece * (2_000_000 // len(piece))
    start = time.monotonic()
    html_text.main_text(page, html_text.trained())
    assert time.monotonic() - start < 60
