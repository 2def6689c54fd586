"""The prefix trie, packing and centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_data import make_docs, no_docs, odd_docs, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import centroids, packing, queries, trie

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string"
BYTES = public_tokenizers.path("byte_bpe_50k.json")

# ---- trie -----------------------------------------------------------------------------------


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
            own.setdefault(conv, []).append((order, role, text))
    own = {conv: [t[1:] for t in sorted(turns)] for conv, turns in own.items()}
    nodes = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 4
        built = own.get(conv - conv % 20, [])[:head] + turns[head:]
        for depth in range(len(built) + 1):
            node = nodes.setdefault(tuple(built[:depth]), {"members": [], "ends": []})
            node["members"].append(conv)
            if depth == len(built):
                node["ends"].append(conv)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, node in nodes.items():
        leaves = saved = 0
        stack = [path]
        while stack:
            at = stack.pop()
            leaves += at not in children
            saved += (len(nodes[at]["members"]) - 1) * (len(WORDS.findall(at[-1][1])) if at else 0)
            stack += children.get(at, [])
        ends = ",".join(map(str, sorted(node["ends"])))
        parent = min(nodes[path[:-1]]["members"]) if path else None
        out.append((min(node["members"]), len(path), parent, len(node["members"]), len(children.get(path, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_trie(df, **options):
    return sorted((tuple(r)[:8] for r in trie.prefix_trie(df, **options).collect()), key=str)


def random_turns(seed, conversations=90):
    r = random.Random(seed)
    rows = []
    for conv in r.sample(range(200), conversations):
        rows += [(conv, t, r.choice(["user", "assistant"]), r.choice(["a", "b c", "d  e f", ""])) for t in range(r.choice([0, 1, 2, 3, 5, 9]))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("tail_arcs", [20_000, 8])
def test_trie_equals_brute_force(spark, tail_arcs):
    """With 8 arcs for the last task the whole list is ranked by splicing."""
    rows = random_turns(tail_arcs)
    rows += [(400, t, "user", "again") for t in range(60)]  # one long conversation
    rows += [(c, 0, "user", "the same") for c in range(500, 560)]  # one very common conversation
    assert found_trie(spark.createDataFrame(rows, TURNS), tail_arcs=tail_arcs) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (2, 1, "user", None), (2, None, "", ""), (None, 1, "user", "nobody"),
        (3, 0, "user", " \t"), (20, 5, None, "x y"), (20, 4, "user", "word " * 30_000), (21, 0, "user", "own"), (41, 0, "user", "only"), (60, 0, "ab", "c"), (80, 0, "a", "bc"),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS digest", "7 AS place", "8L AS arc", "1 AS part", "'k' AS k1", "2 AS depth", "3 AS id")
    assert found_trie(df) == plain_trie(rows)
    assert found_trie(spark.createDataFrame([], TURNS)) == [] and found_trie(spark.createDataFrame([(None, 0, "user", "x")], TURNS)) == []
    assert found_trie(spark.createDataFrame([(23, 0, "user", "x")], TURNS)) == plain_trie([(23, 0, "user", "x")])


def test_running_totals_across_ranges(spark):
    """One group over several ranges; small ranges would else be put together."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        check_running(spark)
    finally:
        spark.conf.unset(setting)


def check_running(spark):
    df = spark.range(5000).selectExpr("if(id % 10 < 7, 0L, id % 10) g", "id o", "id v").repartition(5)
    dealt = trie.deal(df, ["g"], ["o"])
    assert dealt.where("g = 0").select("part").distinct().count() > 1
    got = {(r.g, r.o): (r.n, r.x) for r in trie.running(dealt.withColumn("one", F.lit(1).cast("long")), "g", "o", {"n": ("one", trie.ADD), "x": ("v", trie.XOR)}).collect()}
    state = {}
    for i in range(5000):
        g = 0 if i % 10 < 7 else i % 10
        n, x = state.get(g, (0, 0))
        state[g] = (n + 1, x ^ i)
        assert got[(g, i)] == state[g]


def test_tour_positions_nest(spark):
    rows = trie.prefix_trie(spark.createDataFrame(random_turns(3), TURNS), tail_arcs=50).collect()
    places = sorted(p for r in rows for p in (r.enter, r["leave"]))
    assert places == list(range(2 * len(rows)))
    for r in rows:
        inside = [x for x in rows if r.enter <= x.enter and x["leave"] <= r["leave"]]
        assert r.leave - r.enter + 1 == 2 * len(inside) and r.n_leaves == sum(x.n_children == 0 for x in inside)


# ---- packing --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTES)


def check_packing(pieces, docs, tokenizer, capacity=1024):
    """Every id in exactly one piece, sequences without gaps, little padding."""
    ids = {key: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0] for key, text in docs}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for key, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            part = ids[key][p.start : p.start + p.length]
            assert (p.start, p.doc_tokens, len(part)) == (at, len(ids[key]), p.length) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p.length
        assert at == len(ids[key])
    padded = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        if own[0]["class"]:
            assert len(own) == own[0]["class"] and all(p.length <= capacity // len(own) for p in own)
        padded += 0 if at & (at - 1) == 0 else capacity - at
    return padded / max(1, sum(map(len, ids.values())))


def test_packing_equals_tokenizers(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = queries.op12_packing(spark, SF).collect()
    assert check_packing(pieces, [(r.doc_id, r.text) for r in docs.collect()], tokenizer) < 0.01


def test_packing_of_odd_rows(spark, tokenizer, odd_docs, no_docs, make_docs):
    pieces = packing.pack_documents(odd_docs, BYTES).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sum(p.doc_tokens for p in pieces if p.start == 0) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    once = [r for r in rows if r[0] not in (None, 4)]
    check_packing([p for p in pieces if p.doc_id not in (None, 4) and p["class"] == 1], [], tokenizer) if not once else None
    assert {p.doc_id for p in pieces} == {k for k, _ in rows}
    assert packing.pack_documents(no_docs, BYTES).count() == 0
    texts = ["<|endoftext|>", "a <|endoftext|>b<|endoftext", "  x   y \n\n z \t", "\x1c \x1d a\x85 b", "", None, "\U0001f600" * 700, "it's I'LL", " " * 5000, "x" * 30_000]
    assert check_packing(packing.pack_documents(make_docs(texts), BYTES).collect(), list(enumerate(texts)), tokenizer) < 0.01


def test_blocks_do_not_change_ids(tokenizer):
    r = random.Random(4)
    encoder = packing.Encoder(open(BYTES, encoding="utf-8").read())
    for _ in range(200):
        text = "".join(r.choice(["ab", " ", "  ", "\n", "\t", "'s", "1", "é", "漢", ".", " ", "\x1c"]) for _ in range(r.randrange(60)))
        expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert b"".join(encoder.blocks(text, size=r.choice([1, 3, 1000]))) == expected, repr(text)


def test_encoder_agrees_on_every_code_point(tokenizer):
    encoder = packing.Encoder(open(BYTES, encoding="utf-8").read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in points[i : i + 4096]) for i in range(0, len(points), 4096)]
    for text, encoded in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert b"".join(encoder.blocks(text)) == np.array(encoded.ids, "<u4").tobytes()


@pytest.mark.parametrize("slack", [0, 16, 1024])
def test_rests_fit_their_classes(slack):
    for n in range(1, 1024):
        pieces = packing.rest_classes(n, 1024, slack)
        assert sum(length for length, _ in pieces) == n and all(0 < length <= 1024 // k for length, k in pieces)


def test_vocabulary_with_other_ranks_is_refused():
    spec = json.load(open(BYTES, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    with pytest.raises(ValueError, match="ranks"):
        packing.Encoder(json.dumps(spec))


# ---- centroids ------------------------------------------------------------------------------


def plain_clusters(rows, k=40, rounds=5, dims=64):
    kept = [(key, v) for key, v in rows if v is not None and len(v) == dims and all(e is not None and np.isfinite(e) for e in v)]
    x = [[int(np.floor(256.0 * float(e))) for e in v] for _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (hashlib.sha256(f"2:{'' if kept[i][0] is None else kept[i][0]}".encode()).hexdigest(), x[i]))
    centres = [x[i] for i in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for v in x:
            members.setdefault(nearest(v)[1], []).append(v)
        for j, own in members.items():
            centres[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = [(key, *reversed(nearest(v))) for (key, _), v in zip(kept, x, strict=True)]
    sums = {}
    for _, c, d in out:
        sums[c] = sums.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((key, c, d, sums[c], sum(sums.values()), digest[c]) for key, c, d in out), key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


def found_clusters(df, **options):
    result = centroids.cluster_embeddings(df, **options).collect()
    return sorted((tuple(r)[:6] for r in result), key=str), sum(r.evaluated for r in result)


def test_clusters_equal_brute_force(spark):
    """Clustered vectors, ties, a third of all rows equal; bounds spare distances."""
    r = np.random.default_rng(1)
    centres = r.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + r.normal(size=8) * 0.3).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8, 0) for i in range(150)]
    found, evaluated = found_clusters(spark.createDataFrame(rows, VECTORS).repartition(3), k=12, dims=8)
    assert found == plain_clusters([x[:2] for x in rows], k=12, dims=8)
    assert evaluated < 0.6 * 12 * 6 * len(rows)


def test_clusters_with_ties(spark):
    rows = [(i, [float(i % 3), float(i % 2)], 0) for i in range(40)]
    assert found_clusters(spark.createDataFrame(rows, VECTORS), k=9, dims=2)[0] == plain_clusters([x[:2] for x in rows], k=9, dims=2)


def test_bounds_hold_for_many_histories():
    """Decisions equal plain iterations when centroids wander back and forth."""
    r = np.random.default_rng(7)
    x = r.integers(-300, 300, (400, 5))
    history = r.integers(-300, 300, (1, 7, 5))
    cluster, bounds, seen, _ = centroids.assign_first(x, history[0])
    for _ in range(20):
        step = r.integers(-40, 41, (1, 7, 5)) * (r.random((1, 7, 1)) < 0.5)
        history = np.concatenate([history, history[-1:] + step])
        cluster, bounds, seen, _ = centroids.assign_again(x, cluster, bounds, seen, history)
        assert (cluster == centroids.squared(x, history[-1]).argmin(axis=1)).all()


def test_clusters_of_odd_rows(spark):
    good = [1.0, -2.5]
    rows = [
        (1, good, 0), (1, good, 0), (None, [3.0, 4.0], None), (None, [0.0, 4.0], 1), (2, None, 0), (3, [1.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 0.0], 0),
        (6, [float("inf"), 0.0], 0), (7, [], 0), (8, [1.0, 2.0, 3.0], 0), (9, [1e-30, -1e-30], 0), (-4, [-0.0, 0.0], 0), (10, [100_000.0, -100_000.0], 0),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS cluster", "2 AS v", "'s' AS seen", "4 AS distance", "5 AS bounds")
    assert found_clusters(df, dims=2)[0] == plain_clusters([x[:2] for x in rows], dims=2)
    assert found_clusters(spark.createDataFrame([], VECTORS))[0] == []
    with pytest.raises(Exception, match="component"):
        found_clusters(spark.createDataFrame([(1, [1e9, 0.0], 0)], VECTORS), dims=2)


@pytest.mark.parametrize("name", ["op11_trie", "op13_centroids"])
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, found.select(*columns).collect()))) == sorted(map(str, result.fetchall()))
