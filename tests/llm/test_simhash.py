import random
import re

import numpy as np
import xxhash

from braidlake.llm import simhash


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs: (id, fingerprint); the smallest id reachable for each."""
    roots = list(range(len(pairs)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= 4:
                roots[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(pairs)]


def test_fingerprints_against_brute_force(documents, awkward):
    for df in (documents.limit(60), awkward):
        for r in df.select("text").collect():
            assert simhash.fingerprint(r.text) % (1 << 64) == brute_print(r.text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0


def test_components_against_brute_force(documents, awkward, empty):
    for df in (documents, awkward):
        want = brute_components([(r.doc_id, brute_print(r.text)) for r in df.select("doc_id", "text").collect()])
        assert sorted(map(tuple, simhash.components(df).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.components(empty).count() == 0


def planted(n, seed):
    """Fingerprints in clusters: chains of small steps and dense groups around a centre."""
    rng = random.Random(seed)
    out = []
    for _ in range(n // 40):
        x = rng.getrandbits(64)
        for _ in range(20):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
        centre = rng.getrandbits(64)
        for _ in range(20):
            y = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                y ^= 1 << b
            out.append(y)
    return out


def check_links(spark, prints, hot=None):
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(x,) for x in sorted(set(signed))], "fp long")
    links = simhash.links_of(simhash.filed(distinct, hot or {}))
    for r in links.collect():
        assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 4
    from braidlake.operators import graph

    roots = {r.node: r.root for r in graph.components(links).collect()}
    ids = sorted(set(signed))
    want = brute_components([(i, x % (1 << 64)) for i, x in enumerate(ids)])
    by_root = {}
    for (i, _, c), x in zip(want, ids, strict=True):
        by_root.setdefault(c, set()).add(roots.get(x, x))
    assert all(len(v) == 1 for v in by_root.values())
    assert len({next(iter(v)) for v in by_root.values()}) == len(by_root)


def test_no_link_is_lost(spark):
    check_links(spark, planted(400, 3))


def test_large_group_is_searched(spark):
    rng = random.Random(9)
    prints = [0b1011 << 40 ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)]
    check_links(spark, prints)


def test_hot_keys_are_dealt_over_blocks(spark):
    prints = planted(120, 4)
    keys = {int(k): 3 for s in range(5) for k in np.unique(simhash.keys_of(np.array(prints, np.uint64), s))[::2]}
    check_links(spark, prints, keys)
