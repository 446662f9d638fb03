"""Fingerprints and components against brute force."""

from __future__ import annotations

import random

import xxhash

from millrace.llm import simhash
from millrace.llm.components import components
from millrace.llm.queries import QUERIES


def slow_fingerprint(text):
    parts = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        parts = parts.replace(blank, " ")
    words = [w for w in parts.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(marked):
    """{(key, fingerprint): smallest key} by comparing all fingerprints."""
    prints = sorted({fp for _, fp in marked})
    root = {fp: fp for fp in prints}

    def find(fp):
        while root[fp] != fp:
            fp = root[fp]
        return fp

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for key, fp in marked:
        if key is not None:
            least[find(fp)] = min(key, least.get(find(fp), key))
    return {(key, fp): least.get(find(fp)) for key, fp in marked}


def test_query_on_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    marked = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs]
    want = sorted((k, f"{fp:016x}", c) for (k, fp), c in slow_components(marked).items())
    assert sorted(map(tuple, QUERIES["op5_simhash"](spark, small).collect())) == want


def test_odd_texts(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One  two"), (8, "one two"), (7, "ÉÉ É É é"), (7, "ÉÉ É É é"),
            (None, "one\x0btwo"), (1, "word " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 fingerprint", "2 component_id")
    marked = [(k, slow_fingerprint(t)) for k, t in rows]
    want = sorted(((k, fp - (1 << 64) if fp >> 63 else fp, slow_components(marked)[k, fp]) for k, fp in marked), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted(
        [(False, 3), (False, 8), (False, 7), (False, 1), (True, None)], key=lambda x: (x[0], x[1] or 0)
    )


def test_crowded_keys_keep_every_component(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = set(centres)
    for centre in centres:
        for _ in range(400):
            fp = centre
            for bit in rng.sample(range(20), rng.randint(1, 4)):
                fp ^= 1 << bit
            prints.add(fp)
    prints |= {rng.getrandbits(64) for _ in range(300)}
    marked = [(i, fp) for i, fp in enumerate(sorted(prints))]
    signed = [(fp - (1 << 64) if fp >> 63 else fp,) for _, fp in marked]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long")).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in edges)
    assert len(edges) < 64 * 65 * len(prints)
    key = {fp - (1 << 64) if fp >> 63 else fp: k for k, fp in marked}
    root = dict(enumerate(range(len(marked))))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(key[a]), find(key[b])))
        root[y] = x
    want = slow_components(marked)
    assert all(find(k) == want[k, fp] for k, fp in marked)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, i) for i in range(1001, 1200)]
    roots = components(spark.createDataFrame([*chain, *star, (5, 5), (3, 2)], "a long, b long")).collect()
    by_root = {}
    for node, root in roots:
        by_root.setdefault(root, set()).add(node)
    assert sorted(map(min, by_root.values())) == [0, 1000]
    assert sorted(map(len, by_root.values())) == [200, 201]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_keys_with_different_texts(spark):
    """One row of each component stays, whatever else has its key."""
    same, other, third = "one two three four five", "six seven eight nine ten", "some text of its own here"
    rows = [(1, same), (2, same), (2, other), (3, other), (3, third), (3, third), (4, third), (2, other), (1, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, simhash.without_copies(docs).collect()), key=repr)
    assert kept == sorted([(1, same), (2, other), (3, third), (1, None)], key=repr)
