from __future__ import annotations

import random

import numpy as np
import xxhash

from cashloom.llm import simhash as simhash_module
from cashloom.llm.components import components
from cashloom.llm.simhash import close_links, near_duplicates, simhash
from cashloom.llm.vantage import close_groups, grow, route


def plain_simhash(text, words=3):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected(rows, reach=3):
    """Component of each row, by comparing all pairs of fingerprints."""
    prints = [plain_simhash(t) for _, t in rows]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    values = sorted(root)
    for i, p in enumerate(values):
        for q in values[i + 1 :]:
            if (p ^ q).bit_count() <= reach:
                root[find(q)] = find(p)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        known = least.get(find(p))
        least[find(p)] = doc_id if known is None else known if doc_id is None else min(doc_id, known)
    return sorted(((d, p, least[find(p)]) for (d, _), p in zip(rows, prints)), key=str)


def found(frame):
    return sorted(((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in frame.collect()), key=str)


def near_texts():
    rng = random.Random(9)
    vocabulary = [f"W{i}" for i in range(400)]
    rows = []
    for family in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 400))]
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n"]).join(copy)))
    return rows + [(900, ""), (901, None), (902, "a"), (903, "a b"), (None, "a b"), (903, "A  b"), (904, "É x\xa0y z"), (905, "w1 " * 9000)]


def test_against_brute_force(documents):
    rows = near_texts()
    assert found(near_duplicates(documents(rows))) == expected(rows)


def test_small_leaves_and_tiles(documents):
    rows = near_texts()
    assert found(near_duplicates(documents(rows), sample=150, leaf=4, tile=3)) == expected(rows)
    assert found(near_duplicates(documents(rows), sample=20, leaf=4, plain=8)) == expected(rows)


def test_a_leaf_has_a_tree_of_its_own(monkeypatch):
    """A sample too small for the table makes large leaves; not all pairs of them are compared."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    near = base ^ np.array([1 << int(i) for i in rng.integers(0, 64, len(base))], dtype=np.uint64)
    prints = np.unique(np.concatenate([base, near]))
    sizes = []
    plain = simhash_module.close_groups
    monkeypatch.setattr(simhash_module, "close_groups", lambda p, reach: (sizes.append(len(p)), plain(p, reach))[1])
    a, b = simhash_module.connecting(prints, 3, plain=2000)
    assert max(sizes) < 6000 and sum(n * n for n in sizes) < 0.4 * len(prints) ** 2
    linked = set(map(tuple, np.sort(np.stack([a, b], axis=1), axis=1).tolist()))
    assert {tuple(sorted(map(int, p))) for p in zip(base, near)} <= linked


def test_clashing_names(documents):
    rows = near_texts()[:40]
    odd = documents(rows).selectExpr("*", "1 AS row", "2 AS fingerprint", "3 AS root", "4 AS text_hash", "5 AS component_id", "6 AS simhash_text")
    assert found(near_duplicates(odd)) == expected(rows)


def test_query_against_brute_force(spark, middle):
    from cashloom.llm.queries import op3_simhash_near_dedup

    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{middle}/documents.parquet").collect()]
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in op3_simhash_near_dedup(spark, middle).collect()), key=str)
    assert all(len(r.fingerprint) == 16 for r in op3_simhash_near_dedup(spark, middle).limit(5).collect())
    assert got == expected(given)


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0


def test_close_prints_share_a_leaf():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in base], dtype=np.uint64)
    dense = np.uint64(77) ^ np.array([1 << int(i) | 1 << int(j) for i, j in rng.integers(0, 64, (300, 2))], dtype=np.uint64)
    prints = np.concatenate([base, base ^ flips, dense])
    tree = grow(prints[::3], 40)
    assert tree.leaves > 10
    index, leaves = route(tree, prints, 3)
    at = {}
    for i, leaf in zip(index.tolist(), leaves.tolist()):
        at.setdefault(i, set()).add(leaf)
    assert len(at) == len(prints)
    for i in range(len(prints)):
        close = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3)
        assert all(at[i] & at[int(j)] for j in close)


def test_simhash_and_groups():
    for text in ["", "a", "a b", "a b c", "A b  c\td", "x " * 70_000, "É é ß"]:
        assert simhash(text.encode()) == plain_simhash(text)
    prints = np.array([0, 1, 3, 7, 2**63, 2**64 - 1], dtype=np.uint64)
    assert close_groups(prints, 1).tolist() == [0, 0, 0, 0, 0, 5]
    assert close_groups(prints[:0], 1).tolist() == []


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5)]
    pairs += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    links = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.root for r in components(links).collect()} == {x: find(x) for x in root}
    assert components(links.limit(0)).count() == 0
    assert close_links(links.selectExpr("a AS fingerprint").limit(0)).count() == 0
