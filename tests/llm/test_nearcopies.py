import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from braidlake.llm import nearcopies, overlaps
from braidlake.operators import graph

ALL = (1 << 64) - 1


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def spread(h, part):
    x = h ^ ((part + 1) * 0x9E3779B97F4A7C15 & ALL)
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & ALL
    return x ^ x >> 31


def brute_print(text):
    """The 512 bits as one integer."""
    words = [sum(spread(xxhash.xxh64_intdigest(g, seed=42), j) << 64 * j for j in range(8)) for g in shingles(text)]
    counts = [0] * 512
    for w in words:
        for b, c in enumerate(reversed(f"{w:0512b}")):
            counts[b] += c == "1"
    return sum(1 << b for b, c in enumerate(counts) if 2 * c > len(words))


def brute_link(a, b):
    x = a ^ b
    if x.bit_count() > 88:
        return False
    parts = [(x >> 16 * i & 0xFFFF).bit_count() for i in range(32)]
    for start in range(32):
        ring = parts[start:] + parts[:start]
        if ring[0] == 0 and all(sum(ring[:k]) <= 112 * k // 32 for k in range(1, 32)):
            return True
    return False


def brute_roots(prints):
    roots = list(range(len(prints)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if find(i) != find(j) and brute_link(prints[i], prints[j]):
                roots[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def brute_components(pairs):
    """pairs: (id, fingerprint); for each the smallest id reachable."""
    least, roots = {}, brute_roots([f for _, f in pairs])
    for (d, _), r in zip(pairs, roots, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(r) for r in roots]


def edited(words, share, rng, vocabulary):
    """The words with some of them replaced, in one run of places, so that about ``share`` of the shingles change."""
    out, n = list(words), max(1, int(share * len(words)))
    at = rng.randrange(len(words) - n)
    out[at : at + n] = [rng.choice(vocabulary) for _ in range(n)]
    return out


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / max(1, len(x | y))


def test_fingerprints_against_brute_force(documents, awkward):
    for df in (documents.limit(30), awkward.where("length(text) < 5000 or text is null")):
        for r in df.select("text").collect():
            assert int.from_bytes(nearcopies.fingerprint(r.text), "little") == brute_print(r.text)
    assert nearcopies.fingerprint(None) == nearcopies.fingerprint(" \t") == bytes(64)


def test_long_texts_are_counted_whole():
    words = [f"w{i * i % 7919}" for i in range(9000)]
    assert int.from_bytes(nearcopies.fingerprint(" ".join(words)), "little") == brute_print(" ".join(words))


def cluster(n, seed, most):
    """Fingerprints in dense groups around centres."""
    rng, out = random.Random(seed), []
    for _ in range(n // 20):
        centre = rng.getrandbits(512)
        for _ in range(20):
            x = centre
            for b in rng.sample(range(512), rng.randint(0, most)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


def check_links(spark, prints, hot=None):
    distinct = spark.createDataFrame([(i, bytearray(p.to_bytes(64, "little"))) for i, p in enumerate(prints)], "node long, fp binary").repartition(3)
    links = nearcopies.links_of(nearcopies.filed(distinct, hot or {}))
    for r in links.collect():
        assert r.a < r.b and brute_link(prints[r.a], prints[r.b])
    found = {r.node: r.root for r in graph.components(links).collect()}
    mine, want = {}, {}
    for i, r in enumerate(brute_roots(prints)):
        mine.setdefault(found.get(i, i), set()).add(i)
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_no_link_is_lost(spark):
    check_links(spark, cluster(240, 3, 60))


def test_large_group_is_searched(spark):
    check_links(spark, cluster(20, 9, 4) + cluster(20, 10, 90) + [(1 << 511) + (1 << i) for i in range(150)])


def test_hot_keys_are_dealt_over_blocks(spark):
    prints = cluster(80, 4, 50)
    keys = {(s << 16) | (p >> 16 * s & 0xFFFF): 3 for p in prints[::2] for s in range(32)}
    check_links(spark, prints, keys)


def test_edited_texts_are_found_by_similarity(documents):
    """Recall by five-word similarity, and no unlike texts linked."""
    rng = random.Random(11)
    texts = [r.text.split() for r in documents.select("text").collect() if r.text and len(r.text.split()) >= 120][:300]
    vocabulary = [f"new{i}" for i in range(5000)]
    hits, seen = {}, {}
    for words in texts:
        for share in (0.02, 0.05, 0.1, 0.3):
            a, b = " ".join(words), " ".join(edited(words, share, rng, vocabulary))
            j = jaccard(a, b)
            band = 0.9 if j >= 0.9 else 0.8 if j >= 0.8 else 0.6 if j >= 0.6 else 0
            seen[band] = seen.get(band, 0) + 1
            hits[band] = hits.get(band, 0) + brute_link(*(int.from_bytes(nearcopies.fingerprint(x), "little") for x in (a, b)))
    assert seen[0.9] > 100 and seen[0.8] > 30
    assert hits[0.9] >= 0.97 * seen[0.9] and hits[0.8] >= 0.85 * seen[0.8] and hits.get(0, 0) <= 0.02 * seen.get(0, 1)


def test_deduplicate_keeps_one_of_each(awkward, empty):
    kept = nearcopies.deduplicate(awkward)
    assert kept.columns == awkward.columns
    rows = awkward.select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, int.from_bytes(nearcopies.fingerprint(r.text), "little")) for r in rows])
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(d for d in got if d is not None) == sorted({c for c in want if c is not None})
    assert not {201, 202, 203, 204} & set(got)
    assert nearcopies.deduplicate(empty).count() == 0
    assert nearcopies.deduplicate(kept).count() == kept.count()
    assert kept.where(F.col("score") != "score").count() == 0


def test_hot_keys_are_estimated(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "SPLIT", 50)
    ring = np.random.default_rng(2).integers(0, 1 << 16, (400, 32)).astype(np.uint16)
    ring[:300, 7] = 1234
    distinct = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(ring)], "node long, fp binary")
    assert nearcopies.hot_keys(distinct) == {7 << 16 | 1234: 6}


def scattered(words, edits, rng):
    """The words with some of them replaced at single places, each of which changes five shingles."""
    out = list(words)
    for at in rng.sample(range(len(words)), edits):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


def near_texts(seed, n):
    """Texts around 0.8, short and long, half of each with a passage that all share."""
    rng, out = random.Random(seed), []
    passage = [f"p{i}" for i in range(60)]
    for i in range(n):
        edits = rng.choice([0, 2, 4, 10])
        size = 45 * edits + 4 or rng.choice([1, 4, 9])
        words = [f"w{rng.randrange(3000)}" for _ in range(size)]
        if edits and i % 2:
            words[:60] = passage
        # one edit more and they are below
        out += [words] + [scattered(words, e, rng) for e in ((edits, edits, edits + 1) if edits else (0, 1))]
    return [" ".join(w) for w in out]


def least_reachable(texts, links):
    roots = list(range(len(texts)))
    for a, b in links:
        x, y = roots[a], roots[b]
        roots = [min(x, y) if r in (x, y) else r for r in roots]
    return roots


def test_no_pair_of_the_threshold_is_left_out(spark):
    texts = near_texts(4, 60)
    prints = [int.from_bytes(nearcopies.fingerprint(t), "little") for t in texts]
    sets = [shingles(t) for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    near = {(a, b) for a, b in pairs if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))}
    linked = {(a, b) for a, b in pairs if brute_link(prints[a], prints[b])}
    assert len(near - linked) > 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in nearcopies.deduplicate(docs).collect())
    assert got == sorted(set(least_reachable(texts, near | linked))) != sorted(set(least_reachable(texts, linked)))


@pytest.mark.parametrize("split", [overlaps.SPLIT, 5])
def test_overlaps_are_exact_whatever_the_order(spark, monkeypatch, split):
    monkeypatch.setattr(overlaps, "SPLIT", split)
    texts = near_texts(6, 40)
    sets = [nearcopies.shingle_hashes(t) for t in texts]
    keyed = spark.createDataFrame(list(enumerate(texts)), "h long, text string").repartition(3)
    want = {(a, b) for b in range(len(texts)) for a in range(b) if 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))}
    sampled = overlaps.order_of(keyed, nearcopies.shingle_hashes)
    assert len(sampled.tokens) and bool(sampled.hot()) == (split == 5)
    for order in (sampled, overlaps.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)):
        rows = [(i, i, *overlaps.columns(s, order), i) for i, s in enumerate(sets)]
        units = spark.createDataFrame(rows, "unit long, root long, sig long, n int, prefix binary, bits binary, h long").repartition(3)
        assert {(r.a, r.b) for r in overlaps.near_roots(keyed, units, order, nearcopies.shingle_hashes).collect()} == want


def test_bitmaps_never_refuse_a_near_pair():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300, 513, 5000, 90_000):
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        y = np.concatenate([x[n // 10 :], rng.integers(0, 1 << 63, n // 10).astype(np.uint64)])
        assert overlaps.allowed(overlaps.bitmap(x), overlaps.bitmap(y), n, len(y))
        assert not overlaps.allowed(overlaps.bitmap(x), overlaps.bitmap(~x), n, n) or n > 60_000 or n < 2
