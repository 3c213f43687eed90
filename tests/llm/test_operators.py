"""Operators and queries against brute force, edge cases, and the same answers from either side of every limit."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tastemill.llm import (
    byte_bpe,
    components,
    embedding_dedup,
    html_text,
    mixing,
    quality_rules,
    queries,
    sharding,
    simhash,
    suffix_dedup,
    token_files,
    url_filter,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark, sf, name="documents"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in table(spark, sf).select("doc_id", "text").collect()}


def parts_of(nodes, linked):
    """Least node of each node's part."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


# ---- quality rules


def plain_statistics(text):
    words = WORD.findall(text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {k for places in at.values() if len(places) > 1 for i in places for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark, sf, edge_docs):
    for docs in (table(spark, sf), edge_docs):
        rows = quality_rules.statistics(docs.select("doc_id", "text")).collect()
        for r in rows:
            assert tuple(r.stats[n] for n in quality_rules.BASE) == plain_statistics(r.text or "")


def test_learned_rules_find_planted_junk(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = " ".join(f"{words[(i * 7 + k * k) % 5]}{k}" + ("$$$" if bad and k % 2 else "") for k in range(60 + i % 17))
        rows.append((i, text, 5))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality_rules.judged(docs, known).collect()}
    assert got == {i: i % 4 != 0 for i in range(240)}
    none = quality_rules.judged(docs, known.where("quality = 1"))
    assert none.where("not kept").isEmpty() and none.where("rule is not null").isEmpty()


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 0, 0), (5, 1, 0), (None, 0, 1), (8, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.judged(edge_docs, labels)
    assert got.count() == edge_docs.count() and set(edge_docs.columns) <= set(got.columns)
    assert {r.doc_id for r in got.where("kept").collect()} == {5, 6}  # long enough and not repetitive
    assert quality_rules.judged(no_docs, labels).isEmpty()


# ---- pages


def test_extract_edges(spark):
    pages = spark.createDataFrame(
        [(1, None, None, 1), (2, "u", "", 2), (2, "u", "<article><p>Hi there.</p></article>", 3), (None, "v", "<p", 4)],
        "page_id long, url string, html string, text int",
    )
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(0, "v", "", 0), (1, "", "", 0), (2, "u", "", 0), (2, "u", "Hi there.", 9)]
    assert html_text.extract(pages.where("false")).isEmpty()


def test_articles_of_the_pages(spark, sf):
    import html

    for r in html_text.extract(table(spark, sf, "pages")).join(table(spark, sf, "pages").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        plain = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert r.text == "\n".join(b for b in plain if b) and r.n_chars == len(r.text)


# ---- token files


def test_token_files(spark, sf, edge_docs, no_docs, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "FILE_IDS", 5_000)  # several files in a part
    for docs in (table(spark, sf), edge_docs):
        files = token_files.write_token_files(docs, path, end_id=1)
        starts = {(r.s_part, r.s_file): r.start for r in token_files.file_starts(files).collect()}
        rows = docs.select("doc_id", "text").collect()
        want = sorted((r.doc_id is not None, r.doc_id or 0, plain.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in rows)
        got = sorted((starts[r.part, r.file] + r.start_in_file, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(files).collect())
        assert [g[1] for g in got] == [w[1] if w[0] else None for w in want]
        at = 0
        for start, _, n, _ in got:
            assert start == at
            at += n
        crc = [zlib.crc32(np.array(w[2], "<u4").tobytes()) for w in want]
        assert sorted((d or 0, n, c) for _, d, n, c in got) == sorted((w[1], len(w[2]), c) for w, c in zip(want, crc, strict=True))
    assert token_files.read_token_files(token_files.write_token_files(no_docs, path, 1)).isEmpty()


# ---- mixing


def test_mix_edges(spark, edge_docs, no_docs):
    mixed, sizes, targets = mixing.mixed_documents(edge_docs)
    rows = mixed.collect()
    assert len(rows) == edge_docs.count() and set(sizes) == {"a", "b", "c", "", None}
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies for r in rows)
    assert all(t <= 3 * sizes[s] + 1e-9 for s, t in targets.items()) and abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mixed_documents(edge_docs)[0].collect()))
    repeated = mixing.repeated_documents(edge_docs)
    assert repeated.columns == edge_docs.columns
    want = sum(r.copies for r in rows)
    assert repeated.count() == want
    assert mixing.mixed_documents(no_docs)[0].isEmpty()


def test_overlapping_sources_meet_their_quotas(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        (F.col("id") % 7 + 1).alias("size"),
        F.expr("case id % 3 when 0 then array('a') when 1 then array('b', 'a') else array(null, 'b') end").alias("sources"),
    )
    total = docs.agg(F.sum("size")).first()[0]
    quotas = {"a": total, "b": total // 2, None: total // 4}
    mixed = mixing.mix(docs, quotas, seed=3)
    served = {r.s: r.n for r in mixed.select("size", F.explode("serves").alias("s")).groupBy("s").agg(F.sum("size").alias("n")).collect()}
    for s, quota in quotas.items():
        assert abs(served[s] - quota) <= 30
    assert mixed.where("taken > 3 * size or size(serves) <> copies").isEmpty()


# ---- URL filter


def test_url_parts(spark):
    rows = [
        (1, "http://A.Example.ORG/es/1?x=1#y"), (2, "https://m.example.com/de/7.html"), (3, None), (4, "no scheme/x"), (5, "x://"),
        (6, "http://www.b.com/fr/?utm_source=q&z=1"), (7, "http://example.org"), (8, "http://notexample.org/es/"), (9, "http://c.net/p/"),
    ]
    pages = spark.createDataFrame([(i, u, "extra") for i, u in rows], "page_id long, url string, host string")
    listed = spark.createDataFrame([("https://m.c.net/p.html",), (None,), ("b.com/fr",), ("http://b.com/fr?z=1",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.listed, r.verdict) for r in url_filter.judge(pages, listed, url_filter.QUERY_RULES).collect()}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", False, "block"),
        2: ("m.example.com", "/de/7.html", "com/de/", False, "block"),
        3: ("", "", None, False, "allow"),
        4: ("", "", None, False, "allow"),
        5: ("", "", None, False, "allow"),
        6: ("www.b.com", "/fr/", "com/fr/", True, "allow"),
        7: ("example.org", "", None, False, "allow"),
        8: ("notexample.org", "/es/", "org/", False, "allow"),
        9: ("c.net", "/p/", None, True, "block"),
    }
    empty = url_filter.judge(pages, listed.where("false"), [])
    assert empty.count() == 9 and empty.where("listed or verdict <> 'allow'").isEmpty()
    assert url_filter.judge(pages.where("false"), listed, []).isEmpty()


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_bloom_loses_no_listed_key(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
    listed = spark.range(0, 20_000, 7).select(F.concat(F.lit("http://h.net/"), "id").alias("url"))
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h.net/"), "id", F.lit("#a")).alias("url"))
    got = url_filter.judge(pages, listed, [])
    assert got.where("listed <> (page_id % 7 = 0)").isEmpty() and got.count() == 20_000


def test_other_spellings_are_found_by_the_join_only(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    more = pages.select((F.col("page_id") + 10_000_000).alias("page_id"), F.concat("url", F.lit("#again")).alias("url"))
    pages = pages.unionAll(more)
    listed = url_filter.listed_in(pages)
    rows = url_filter.judge(pages, listed, url_filter.QUERY_RULES).join(pages, "page_id").collect()
    keys = {r.canonical for r in rows if r.url is not None and hashlib.md5(r.url.encode()).hexdigest() < "2"} - {""}
    assert all(r.listed == (r.canonical in keys) for r in rows)
    free = [r for r in rows if r.rule is None]
    assert all(r.verdict == ("block" if r.listed else "allow") for r in free)
    by_join = [r for r in free if r.listed and hashlib.md5(r.url.encode()).hexdigest() >= "2"]
    assert by_join and len({r.host for r in free if not r.listed} & {r.host for r in by_join}) > 0
    # the filter alone lets a few more through than the exact join
    known = listed.select(url_filter.canonical(F.col("url")).alias("key")).distinct()
    asked = spark.range(40_000).select(F.concat(F.lit("none.net/"), "id").alias("asked"))
    assert url_filter.maybe_listed(asked, F.col("asked"), known, "key").count() < 400


# ---- byte-level BPE


def plain_digest(codec, text):
    ids = codec.encode(text)
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


@pytest.mark.parametrize(("chunk", "overlap"), [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (300, 60), (70, 12)])
def test_byte_bpe(spark, sf, edge_docs, no_docs, chunk, overlap):
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    runs = spark.createDataFrame(
        [(1, "x" * 900), (2, " " * 700 + "a"), (3, "it's " * 200 + "z" * 333 + "\n\n 'll" * 40), (3, "it's " * 200)], "doc_id long, text string"
    )
    for docs in (table(spark, sf).limit(40) if chunk < 1000 else table(spark, sf), edge_docs, runs):
        rows = docs.select("doc_id", "text").collect()
        got = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, digests=True, chunk=chunk, overlap=overlap).collect()
        want = sorted(((r.doc_id or 0), *plain_digest(codec, r.text or "")) for r in rows)
        assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
        for r in rows:
            assert codec.decode(codec.encode(r.text or "")) == (r.text or "").encode()
    assert byte_bpe.encode_texts(no_docs, RANKS, public_tokenizers.PATTERN).isEmpty()


# ---- vectors


def plain_vectors(rows, threshold=0.95):
    fine = [
        (k, np.array(v, float)) for k, (_, v) in enumerate(rows)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    links = []
    for n, (i, x) in enumerate(fine):
        for j, y in fine[:n]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((j, i))
    count = [sum(k in e for e in links) for k in range(len(rows))]
    part = parts_of(range(len(rows)), links)
    ids = {}
    for k, p in part.items():
        ids.setdefault(p, []).append(rows[k][0])
    least = {p: min((i for i in v if i is not None), default=None) for p, v in ids.items()}
    return sorted(((r[0] if r[0] is not None else -1, count[k], least[part[k]], r[0] == least[part[k]]) for k, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("dense", [embedding_dedup.DENSE, 0.0])
def test_near_vectors(spark, monkeypatch, dense):
    monkeypatch.setattr(embedding_dedup, "DENSE", dense)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 9] + rng.normal(size=12) * s).tolist()) for i, s in enumerate(np.linspace(0.01, 0.9, 150))]
    rows += [(300 + i, (base[3] * (1 + i % 3)).tolist()) for i in range(40)]
    rows += [(400, None), (401, []), (402, [0.0] * 12), (403, [float("nan")] + [1.0] * 11), (404, [float("inf")] + [1.0] * 11),
             (405, [None] + [1.0] * 11), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [1e-30] * 12), (None, base[5].tolist()), (7, base[5].tolist())]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, node int")
    got = embedding_dedup.near_vectors(vectors).collect()
    assert sorted(((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in got), key=str) == plain_vectors(rows)
    assert embedding_dedup.near_vectors(vectors.where("false")).isEmpty()
    assert embedding_dedup.near_vectors(vectors.where("vec_id = 400")).count() == 1


# ---- shards


def test_shards(spark, sf, edge_docs, no_docs):
    for docs, shards in ((table(spark, sf), 24), (edge_docs, 3)):
        rows = sharding.shard_texts(docs, shards).join(docs.select(F.col("doc_id").alias("d"), "text"), F.col("doc_id").eqNullSafe(F.col("d")))
        rows = rows.select("doc_id", "size", "text_crc32", "shard", "slot", "text").distinct().collect()
        places, of_text, total = {}, {}, {}
        for r in rows:
            body = (r.text or "").encode()
            assert r.size == len(body) + 8 and r.text_crc32 == zlib.crc32(body)
            places.setdefault(r.shard, set()).add(r.slot)
            assert of_text.setdefault(r.text or "", r.shard) == r.shard
            total[r.shard] = total.get(r.shard, 0) + r.size
        assert all(s == set(range(len(s))) for s in places.values()) and set(places) <= set(range(shards))
        if docs is not edge_docs:
            biggest = max(sum(r.size for r in rows if (r.text or "") == t) for t in of_text)
            assert max(total.values()) <= max(biggest, 1.1 * sum(total.values()) / shards)
    assert sharding.shard_texts(no_docs, 4).isEmpty()


def test_fixed_capacity_uses_few_shards(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 97 + 3).alias("size"), (F.col("id") % 900).cast("string").alias("g"))
    total = rows.agg(F.sum("size")).first()[0]
    out = sharding.assign(rows, "g", "size", capacity=total // 9)
    sums = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sums) <= 10 and max(sums) <= total // 9
    assert out.groupBy("g").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()


# ---- near-duplicates


def plain_fingerprint(text, size=3):
    words = WORD.findall(text.encode().lower().decode())
    if not words:
        return 0
    pieces = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("side", [simhash.SIDE_ROWS, 3])
def test_simhash_query(spark, sf, monkeypatch, side):
    monkeypatch.setattr(simhash, "SIDE_ROWS", side)
    monkeypatch.setattr(simhash, "PAIR_BLOCK", 50 if side == 3 else simhash.PAIR_BLOCK)
    known = {d: plain_fingerprint(t) for d, t in texts(spark, sf).items()}
    if side == 3:  # a hot group: many fingerprints near one another
        base = next(iter(known.values()))
        prints = [simhash._signed(base ^ (1 << i) ^ (1 << j)) for i in range(30) for j in range(i)]
        rows = spark.createDataFrame([(p,) for p in prints], "fp_0 long")
        edges = [(r.a, r.b) for r in simhash.links(rows).collect()]
        assert set(parts_of(prints, edges).values()) == {min(prints)}
        return
    ids = sorted(known)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (known[a] ^ known[b]).bit_count() <= 3]
    part = parts_of(ids, links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, sf).collect()}
    assert got == {d: (format(known[d], "016x"), part[d]) for d in ids}


def test_simhash_edges(spark, edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    blank = {r.component_id for r in got if r.doc_id in (1, 2, 3)}
    assert blank == {1} and {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert all(r.fp_0 == simhash._signed(plain_fingerprint(t.text or "")) for r in got for t in edge_docs.where(F.col("doc_id") == r.doc_id).collect())
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 7, 8]
    assert simhash.near_duplicates(no_docs).isEmpty() and simhash.one_of_each(no_docs).isEmpty()


def test_near_copies_go_and_others_stay(spark):
    import random

    rng = random.Random(0)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(4000)]
    docs, copies = [], {}
    for i in range(60):
        docs.append((i, " ".join(rng.choices(words, k=rng.randint(150, 500)))))
    for i in range(40):
        text = docs[i][1].split()
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        copies[1000 + i] = i
        docs.append((1000 + i, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(frame).collect()) == list(range(60))


def test_texts_of_equal_fingerprints_are_compared(spark, monkeypatch):
    """Unlike texts that share a ruler stay, also where their fingerprints are all the same."""
    import random

    rng = random.Random(1)
    docs = [(i, " ".join(["x"] * 45 + own_words(rng, 120))) for i in range(20)]
    docs += [(100, docs[3][1] + " end"), (101, None), (102, ""), (103, " \n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each(frame).collect())
    assert kept == [*range(20), 101]


    def alike(docs, key, text, shingle, seeds, once):
        digest = F.unhex(F.md5(F.col(text))).alias("digest")
        return docs.select(F.col(key).alias("doc_id"), digest, *[F.lit(7).cast("long").alias(f"fp_{i}") for i in range(len(seeds))])

    monkeypatch.setattr(simhash, "fingerprints", alike)
    assert sorted(r.doc_id for r in simhash.one_of_each(frame).collect()) == kept


def own_words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=9)) for _ in range(n)]


def test_pairs_just_above_the_bound_are_found(spark):
    import random

    rng = random.Random(11)
    docs = []
    for i in range(300):
        shared, own = own_words(rng, 304), rng.randint(27, 36)
        for k in (0, 1000):
            docs.append((i + k, " ".join(shared + own_words(rng, own))))
        assert 0.8 <= simhash.resemblance(docs[-2][1], docs[-1][1], 5) < 0.85
    kept = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))


def test_families_around_the_bound_keep_every_link(spark):
    import random

    rng = random.Random(5)
    docs, shingles = [], []
    for _ in range(24):
        template = own_words(rng, 304)
        for _ in range(14):
            docs.append((len(docs), " ".join(template + own_words(rng, rng.randint(24, 59)))))
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in docs)]
    edges = []
    for a in range(len(docs)):
        for b in range(a - a % 14, a):
            common = len(shingles[a] & shingles[b])
            if common >= 0.8 * (len(shingles[a]) + len(shingles[b]) - common):
                edges.append((a, b))
    part = parts_of(range(len(docs)), edges)
    kept = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(part.values()))


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, k) for k in range(501, 700)]
    frame = spark.createDataFrame(edges + [(5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(frame).collect()}
    want = parts_of({x for e in edges for x in e}, edges)
    alone = {x for x in want if not any(x in e and e[0] != e[1] for e in edges)}
    assert got == {x: c for x, c in want.items() if x not in alone}
    assert components.components(frame.where("false")).isEmpty()


# ---- repeated passages


def plain_cut(bodies, window=200):
    seen = {}
    for b in bodies:
        for k in range(len(b) - window + 1):
            seen[b[k : k + window]] = seen.get(b[k : k + window], 0) + 1
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def planted(spark):
    import random

    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(3000)] + ["ü", "日本", "𝒳y"]
    passages = [" ".join(rng.choices(words, k=rng.randint(40, 90))) for _ in range(5)]
    rows = []
    for i in range(70):
        own = [" ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(2)]
        rows.append((i, own[0] + " " + (rng.choice(passages) if i % 2 else "") + " " + own[1]))
    rows += [(200, rows[3][1]), (201, "q" * 900), (202, "ab" * 300), (203, rows[5][1][:260]), (204, None), (204, "")]
    return spark.createDataFrame([(i, t, "en", 3) for i, t in rows], "doc_id long, text string, doc string, n_removed int")


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_STRETCHES, 1])
@pytest.mark.parametrize("shard", [suffix_dedup.SHARD_BYTES, 500])
def test_repeats(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "TRIM_BYTES", shard)
    docs = planted(spark)
    rows = docs.collect()
    marks = {bytes(r.doc): r.spans for r in suffix_dedup.repeated_windows(docs, hot=hot).collect()}
    for r, want in zip(rows, plain_cut([(r.text or "").encode() for r in rows]), strict=True):
        body = (r.text or "").encode()
        runs = suffix_dedup.removed_runs([s.asDict() for s in marks.get(hashlib.md5(body).digest(), [])])
        assert (len(body), sum(e - b for b, e in runs), len(runs), suffix_dedup.kept_bytes(body, runs)) == want


def test_repeats_query_and_documents(spark, edge_docs, no_docs):
    docs = planted(spark)
    rows = docs.collect()
    plain = plain_cut([(r.text or "").encode() for r in rows])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect())
    assert got == sorted((r.doc_id, n, m, s, hashlib.sha256(k).hexdigest()) for r, (n, m, s, k) in zip(rows, plain, strict=True))
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns
    left = sorted((r.doc_id, r.text or "") for r in cut.collect())
    assert [x[0] for x in left] == sorted(r.doc_id for r in rows)
    want = sorted((r.doc_id, k.decode(errors="replace")) for r, (_, _, _, k) in zip(rows, plain, strict=True))
    for (_, a), (_, b) in zip(left, want, strict=True):
        assert a.replace("\ufffd", "") == b.replace("\ufffd", "")
    assert suffix_dedup.digests(edge_docs).count() == edge_docs.count()
    assert suffix_dedup.without_repeats(edge_docs).count() == edge_docs.count()
    assert suffix_dedup.digests(no_docs).isEmpty() and suffix_dedup.without_repeats(no_docs).isEmpty()


# ---- pipeline


def test_pipeline_stages_take_edge_cases(spark, sf, edge_docs, no_docs):
    import corpus_pipeline

    own = "stats base_failed rule kept row_ key_ text_ w_ body doc digest node part fp_0 group d k n size pattern source_ id".split()
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edge_docs, no_docs):
            docs = docs.drop("size", "pattern").select("*", *[F.lit(f"own {c}").alias(c) for c in own])
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name != "token ids":
                assert out.columns == docs.columns
                assert all(r[c] == f"own {c}" for r in rows for c in own)
            assert len(rows) == 0 if docs.isEmpty() else len(rows) > 0


def test_registered_queries():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1


def test_long_texts_are_cut_beside_white_space(spark):
    """Every kind of white space on every side of a cut, at small sizes and at the default ones."""
    import random

    import tiktoken

    rng = random.Random(8)
    blanks = [" ", " ", "\t", "\n", "\r\n", "\u00a0", "\u0085", "\u3000", "\u2028", "\x1c", "\x1f", "\x0b"]
    rows = []
    for i in range(1500):
        rows.append((i, "".join(rng.choice(blanks) if rng.random() < 0.5 else rng.choice(["ab", "7", "é", "'s", "!", "日"]) for _ in range(90))))
    size = byte_bpe.CHUNK
    for i, middle in enumerate(["  \u00a07", "  \u00857", " \u3000\t\n 7", "\n\n  x", "  \x1c 7"]):
        for shift in range(-3, 3):
            rows.append((5000 + 10 * i + shift, ("word " * size)[: size + shift] + middle + " tail" * 1500))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    plain = byte_bpe.codec(RANKS, public_tokenizers.PATTERN).merges
    assert isinstance(plain, tiktoken.Encoding)
    want = {i: plain.encode_ordinary(t) for i, t in rows}
    short = byte_bpe.encode_texts(frame.where("doc_id < 4000"), RANKS, public_tokenizers.PATTERN, chunk=40, overlap=8)
    long = byte_bpe.encode_texts(frame.where("doc_id >= 4000"), RANKS, public_tokenizers.PATTERN)
    for r in short.unionAll(long).collect():
        assert list(r.ids) == want[r.doc_id], r.doc_id
