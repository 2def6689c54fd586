"""SimHash near-duplicates and bottom-k sketches against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from llm_data import make_docs, no_docs, odd_docs, prose  # noqa: F401

from shelfline.llm import queries, simhash, sketch

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_simhash(text: str) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = WORDS.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius=4):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    lowest = {}
    for i, k in enumerate(ids):
        lowest[root(i)] = min(lowest.get(root(i), k), k)
    return [lowest[root(i)] for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", " \n", "one", "A b C d", "É é Ü a b c d e", "the The THE the the the", "\x1c\x1f \x85 a"])
def test_fingerprint_of_small_texts(text):
    assert simhash.simhash(text) == plain_simhash(text)


def test_fingerprint_counts_repeats_over_blocks():
    text = prose(random.Random(1), 70_000, 50)
    assert simhash.simhash(text) == plain_simhash(text)


@pytest.mark.parametrize("shard_rows", [20_000, 6])
def test_components_equal_brute_force(spark, monkeypatch, shard_rows):
    """Random fingerprints with planted chains and clusters; small shards take the split path."""
    r = random.Random(5)
    prints = [r.getrandbits(64) for _ in range(200)]
    for _ in range(150):
        value = prints[r.randrange(len(prints))]
        for _ in range(r.randrange(1, 6)):
            value ^= 1 << r.randrange(64)
        prints.append(value)
    prints += [r.getrandbits(4) for _ in range(60)] + [0, (1 << 64) - 1]
    ids = r.sample(range(10_000), len(prints))
    signed = [(k, p - (1 << 64) if p >> 63 else p) for k, p in zip(ids, prints, strict=True)]
    table = spark.createDataFrame(signed, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *rest: docs)
    found = {x.doc_id: x.component_id for x in simhash.near_duplicates(table, shard_rows=shard_rows).collect()}
    assert found == dict(zip(ids, plain_components(ids, prints), strict=True))


def test_blocks_leave_one_equal_at_any_size():
    for count in (10, 10**7, 10**9, 10**12):
        blocks = simhash._blocks(count, 4)
        masks = simhash._shard_keys(blocks, blocks - 4)
        r = random.Random(count)
        for _ in range(200):
            changed = sum({1 << r.randrange(64) for _ in range(4)})
            assert any(changed & mask == 0 for mask in masks)


def test_tree_finds_every_neighbour():
    r = np.random.default_rng(2)
    points = np.unique(np.concatenate([r.integers(0, 2**63, 2000).astype(np.uint64), np.arange(600, dtype=np.uint64)]))
    tree = simhash.build_tree(points, np.arange(len(points)))
    pairs = {p for a, b in simhash.query_tree(tree, points, points, np.arange(len(points)), 4) for p in zip(a.tolist(), b.tolist(), strict=True)}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_spanning_links_equal_brute_force(seed):
    """Clusters, chains and lone points; only some of the points are in the tree."""
    r = random.Random(seed)
    points = list({r.getrandbits(64) for _ in range(40)} | {r.getrandbits(9) for _ in range(150)} | {(0b11111 << (4 * i)) for i in range(12)})
    ids = r.sample(range(5000), len(points))
    home = np.array([r.random() < (1 if seed % 2 else 0.6) for _ in points])
    found = simhash.spanning_links(np.array(points, np.uint64), np.array(ids, np.int64), home, 4)
    parent = {k: k for k in ids}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, p in enumerate(points):
        for j, q in enumerate(points):
            if home[j] and (p ^ q).bit_count() <= 4:
                a, b = sorted((root(ids[i]), root(ids[j])))
                parent[b] = a
    assert dict(found.tolist()) == {k: root(k) for k in ids if root(k) != k}


def test_one_large_cluster_in_a_task():
    """20,000 different fingerprints that are all linked, each to many others."""
    import time

    points = np.random.default_rng(1).permutation(1 << 15)[:20_000].astype(np.uint64)
    start = time.time()
    found = simhash.spanning_links(points, np.arange(20_000), np.ones(20_000, bool), 4)
    assert time.time() - start < 30 and len(found) == 19_999 and (found[:, 1] == 0).all()


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    prints = [plain_simhash(t or "") for _, t in rows]
    expected = {k: (f"{p:016x}", c) for (k, _), p, c in zip(rows, prints, plain_components([k for k, _ in rows], prints), strict=True)}
    found = {x.doc_id: (x.fingerprint, x.component_id) for x in queries.op9_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert found == expected


def test_odd_rows(odd_docs, no_docs):
    found = [(x.doc_id, x.component_id) for x in simhash.near_duplicates(odd_docs).collect()]
    assert len(found) == odd_docs.count()
    assert dict(f for f in found if f[0] in (1, 2, 3, 4, 5)) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    # The row without id and text is a copy of the empty ones; the other one has a text of its own.
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 7, 8, 9] and ids.count(None) == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_per_group(no_docs).count() == 0


def test_one_per_group_judges_rows(make_docs):
    """Different texts under one id all stay, copies under any id do not; of equal rows one stays."""
    r = random.Random(4)
    a, b, c = (prose(r, 30) for _ in range(3))
    docs = make_docs([(1, a), (1, b), (2, a), (3, c), (3, c), (None, c), (None, "alone " * 9), (None, "alone " * 9), (4, b)])
    kept = simhash.one_per_group(docs)
    assert sorted((x.doc_id or 0, x.text) for x in kept.collect()) == sorted([(1, a), (1, b), (3, c), (0, "alone " * 9)])


def test_one_per_group_equals_brute_force(make_docs):
    r = random.Random(6)
    texts = [prose(r, 40) for _ in range(60)]
    for _ in range(140):
        words = texts[r.randrange(60)].split()
        if r.random() < 0.5:
            words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    ids = r.sample(range(1000), len(texts))
    kept = {x.doc_id for x in simhash.one_per_group(make_docs(list(zip(ids, texts, strict=True))), shard_rows=20).collect()}
    assert kept == set(plain_components(ids, [plain_simhash(t) for t in texts]))


# ---- sketches -------------------------------------------------------------------------------


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_sketches_estimate(spark):
    r = random.Random(3)
    words = prose(r, 4000).split()
    other = words[:3000] + prose(r, 1000).split()
    a, b = " ".join(words), " ".join(other)
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    x, y = sketch.sketch(a), sketch.sketch(b)
    assert abs(sketch.resemblance(x, y) - true) < 0.1
    assert abs(sketch.distinct_count(x) / len(shingles(a)) - 1) < 0.2
    part = sketch.sketch(" ".join(words[:1500]))
    assert sketch.containment(part, x) > 0.85 and abs(sketch.containment(x, part) - 1500 / 4000) < 0.12
    assert sketch.resemblance(x, x) == 1 and sketch.resemblance(sketch.sketch(""), x) == 0


def test_small_texts_are_exact_and_sketches_merge(spark):
    a, b = prose(random.Random(1), 60, 30), prose(random.Random(2), 60, 30)
    x, y = sketch.sketch(a), sketch.sketch(b)
    assert sketch.resemblance(x, y) == len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert sketch.distinct_count(x) == len(shingles(a))
    long = prose(random.Random(3), 3000)
    groups = spark.createDataFrame([(1, a), (1, b), (1, long), (2, ""), (None, b)], "doc_id long, text string")
    merged = {x.doc_id: x.fingerprint for x in sketch.merge_sketches(sketch.sketch_documents(groups), ["doc_id"]).collect()}
    assert merged == {
        1: sketch.to_string(sketch.merge(sketch.merge(x, y), sketch.sketch(long))), 2: "", None: sketch.to_string(y),
    }


@pytest.mark.parametrize("bucket_bytes", [32 << 20, 20_000])
def test_edited_and_next_equal_brute_force(spark, bucket_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(((x.doc_id, x.text or "") for x in docs.collect()), reverse=True)
    found = {x.doc_id: x for x in sketch.compare_with_next(docs, bucket_bytes=bucket_bytes).collect()}
    assert len(found) == len(rows)
    for i, (key, text) in enumerate(rows):
        follows, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + follows[:half]
        x, mine, changed = found[key], sketch.sketch(text), sketch.sketch(edited)
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (x.fingerprint, x.edited_fingerprint) == (sketch.to_string(mine), sketch.to_string(changed))
        assert x.near_edited == sketch.resemblance(mine, changed) and x.near_next == sketch.resemblance(mine, sketch.sketch(follows))


def test_sketch_of_odd_rows(odd_docs, no_docs, make_docs):
    assert sketch.compare_with_next(odd_docs, bucket_bytes=1000).count() == odd_docs.count()
    assert sketch.sketch_documents(odd_docs).count() == odd_docs.count()
    assert sketch.compare_with_next(no_docs).count() == 0
    alone = sketch.compare_with_next(make_docs(["one two three four five six seven"])).first()
    assert alone.near_next == 1.0
