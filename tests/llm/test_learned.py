"""Rules, quality and toxicity by held-out accuracy; mixing and the pipeline by brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from llm_data import make_docs, no_docs, odd_docs, odd_labels, prose  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import mixing, quality, queries, rules, toxicity

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words, windows, covered = WORDS.findall(text), defaultdict(list), set()
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    for places in windows.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(8))
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_equal_brute_force(make_docs, seed):
    r = random.Random(seed)
    pieces = ["a", "b", "a b c d e f g h", " ", "\n", "x\ny\nx", "é", "😀", "#|", "\x0b", "\x85", "<>", "word"]
    texts = [" ".join(r.choices(pieces, k=r.randrange(40))) for _ in range(300)] + ["", None, "w " * 30_000, "\n" * 500, "q\n" * 500]
    found = rules.text_statistics(make_docs(texts)).collect()
    assert len(found) == len(texts)
    for x in found:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == plain_statistics(texts[x.doc_id] or ""), texts[x.doc_id]


def test_rules_are_learned_pruned_and_ordered(spark):
    r = random.Random(7)
    rows = [(i, r.random(), r.random(), r.random()) for i in range(6000)]
    marked = [(*row, (row[1] > 0.8 and row[2] < 0.5) or row[3] > 0.93) for row in rows]
    table = spark.createDataFrame(marked, "doc_id long, a double, b double, c double, bad boolean")
    learned = rules.learn_rules(table.where("doc_id < 4500"), ("a", "b", "c"))
    assert 2 <= len(learned) <= 6 and all(len(rule) <= 3 for rule in learned)
    judged = table.where("doc_id >= 4500").withColumn("kept", rules.verdict(learned))
    wrong = judged.where("kept = bad").count()
    assert wrong < 30
    assert judged.select(rules.fired(learned).isNull().alias("none"), "kept").where("none != kept").count() == 0


def test_rules_query(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = queries.op10_rules(spark, SF).join(labels, "doc_id").toPandas()
    assert not found[found.base_failed].kept.any()
    rest = found[~found.base_failed]
    assert rest[rest.quality == 1].kept.mean() > 0.99 and rest[rest.quality == 0].kept.mean() < 0.4


def test_rules_odd_rows(odd_docs, odd_labels, no_docs):
    assert rules.apply_quality_rules(odd_docs, odd_labels).count() == odd_docs.count()
    assert rules.apply_quality_rules(odd_docs, odd_labels.limit(0)).where("kept != (NOT base_failed)").count() == 0
    assert rules.apply_quality_rules(no_docs, odd_labels).count() == 0


def test_quality_on_rows_without_their_labels(spark):
    """Trained on the labels of even ids, judged on those of odd ids."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.99 and found[found.quality == 0].kept.mean() < 0.15


def test_sites_shrink_to_the_level_above(spark):
    """A path with one bad document stays near its host, one with many leaves it; a site that is
    small stays near the prior."""
    rows = [("h", "h/big", 400.0, 360.0), ("h", "h/bad", 300.0, 30.0), ("h", "h/one", 1.0, 0.0), ("i", "i/x", 500.0, 450.0), ("j", "j/x", 1.0, 0.0)]
    sites, prior = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, weight double, good double"))
    at = {x.path: x for x in sites.collect()}
    assert abs(prior - 840 / 1202) < 1e-9
    assert abs(at["h/big"].path_posterior - 0.9) < 0.05 and at["h/bad"].path_posterior < 0.2
    assert 0 < at["h/one"].path_posterior < at["h/one"].host_posterior
    assert at["j/x"].path_posterior > 0.1


def test_quality_odd_rows(odd_docs, odd_labels, no_docs):
    assert quality.classify(odd_docs, odd_labels).count() == odd_docs.count()
    assert quality.keep_good(odd_docs, odd_labels).columns == odd_docs.columns
    unjudged = quality.classify(odd_docs, odd_labels.limit(0))
    assert unjudged.where("kept AND score = 0.5").count() == odd_docs.count()
    assert quality.classify(no_docs, odd_labels).count() == 0 and quality.keep_good(no_docs, odd_labels).count() == 0


def test_nnpu_beats_treating_unlabelled_as_clean():
    """A third of the unlabelled are positives in hiding; the corrected risk still finds them."""
    r = np.random.default_rng(1)
    rows = lambda toxic, n: [np.flatnonzero(r.random(40) < np.where(np.arange(40) < 20, 0.5 if toxic else 0.03, 0.2)) for _ in range(n)]
    positives, hidden, clean = rows(True, 150), rows(True, 200), rows(False, 400)
    w, b, _ = toxicity.fit_nnpu(positives, hidden + clean, 40, prior=1 / 3)
    z = lambda some: np.array([b + w[f].sum() for f in some])
    assert (z(rows(True, 300)) > 0).mean() > 0.95 and (z(rows(False, 300)) > 0).mean() < 0.1


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = found[found.held_out]
    ranks, toxic = held.score.rank(), held.toxic == 1
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.97 and held.score.between(0, 1).all()
    assert (held.predicted == (held.score >= 0.3)).all() and held[~toxic].predicted.mean() < 0.02
    assert found.held_out.equals(found.doc_id.map(lambda k: __import__("zlib").crc32(str(k).encode()) % 4 == 2))


def planted_toxicity(spark, make_docs, n=2400):
    """Every twentieth document is foul; half of them, and of the others, carry labels."""
    r = random.Random(8)
    foul = "vile scum rotten filth"
    docs = make_docs([f"{prose(r, 20, 300)} {foul if i % 20 == 0 else ''}" for i in range(n)])
    labels = spark.createDataFrame([(i, 1, int(i % 20 == 0)) for i in range(n) if i // 20 % 2], "doc_id long, quality int, toxic int")
    return docs, labels, foul


def test_bounds_of_the_samples_do_not_move_scores(spark, make_docs):
    docs, labels, foul = planted_toxicity(spark, make_docs)
    scores = []
    for bounds in ((6000, 30_000), (6000, 600), (30, 600)):
        model = toxicity.fit(*toxicity.training_sample(docs, labels, *bounds), n_features=256)
        scores.append((model.score(f"{prose(random.Random(9), 20, 300)} {foul}"), model.score(prose(random.Random(9), 20, 300))))
    assert all(x > 0.9 and y < 0.1 for x, y in scores), scores


def test_unlabelled_rows_come_from_all_documents(spark, make_docs):
    """The unlabelled sample is drawn without a look at the labels, held-out rows apart, and the
    prior is the share of toxic ones among the labels."""
    docs, labels, foul = planted_toxicity(spark, make_docs)
    sample, prior = toxicity.training_sample(docs, labels)
    rows = sample.collect()
    training = {x.text for x in docs.where(~toxicity.held_out_rows()).collect()}
    toxic = {x.doc_id for x in labels.where("toxic = 1").where(~toxicity.held_out_rows()).collect()}
    assert {x.text for x in rows if not x.positive} == training
    assert {x.text for x in rows if x.positive} == {x.text for x in docs.collect() if x.doc_id in toxic}
    assert prior == len(toxic) / labels.where(~toxicity.held_out_rows()).count()


def test_correction_takes_steps_back(spark, make_docs):
    """Few positives with words of their own and a prior above their share: plain risk on the
    non-toxic part goes below zero, and the fit of the query takes those steps back."""
    docs, labels, foul = planted_toxicity(spark, make_docs)
    sample, _ = toxicity.training_sample(docs, labels)
    model = toxicity.fit(sample, 0.3, n_features=256)
    assert model.taken_back > 0
    assert model.score(f"plain words {foul}") > 0.9


def test_toxicity_odd_rows(odd_docs, odd_labels, no_docs):
    for docs in (odd_docs, no_docs):
        model = toxicity.fit(*toxicity.training_sample(docs, odd_labels))
        assert toxicity.score_documents(docs, model).where("score between 0 and 1").count() == docs.count()
    unlabelled = toxicity.fit(*toxicity.training_sample(odd_docs, odd_labels.limit(0)))
    assert toxicity.score_documents(odd_docs, unlabelled).where("score < 0.01").count() == odd_docs.count()


# ---- mixing ---------------------------------------------------------------------------------


def plain_fill(budget, children):
    """``children``: (weight, capacity). Pours in rounds until the budget or all are used up."""
    given, left, open_ = [0.0] * len(children), float(budget), set(range(len(children)))
    while left > 1e-9 and open_:
        total = sum(children[i][0] for i in open_)
        poured = {i: min(left * children[i][0] / total, children[i][1] - given[i]) for i in open_}
        for i, amount in poured.items():
            given[i] += amount
        left -= sum(poured.values())
        open_ = {i for i in open_ if children[i][1] - given[i] > 1e-9}
    return given


@pytest.mark.parametrize("budget", [0, 7, 500, 4000, 10**6])
def test_budgets_equal_pouring(spark, budget):
    r = random.Random(budget)
    mix = mixing.Mix(("a", "b"), {"a": {"x": 5, "y": 3}, "b": {"p": 2}})
    leaves = [(a, b, r.randrange(400)) for a in "xyz" for b in "pqrs"]
    found = {(x.a, x.b): x.budget for x in mixing.allocate(spark.createDataFrame(leaves, "a string, b string, capacity long"), mix, budget).collect()}
    tops = plain_fill(budget, [({"x": 5, "y": 3}.get(a, 1), sum(c for k, _, c in leaves if k == a)) for a in "xyz"])
    for a, top in zip("xyz", tops, strict=True):
        own = [(b, c) for k, b, c in leaves if k == a]
        for (b, capacity), share in zip(own, plain_fill(top, [(2 if b == "p" else 1, c) for b, c in own]), strict=True):
            assert share - 3 <= found[a, b] <= min(capacity, share + 1)


def named(key):
    return "" if key != key or key is None else str(int(key))


@pytest.mark.parametrize(("epochs", "share"), [(1, 0.4), (3, 1.7), (2, 50.0), (1, 0.0)])
def test_mix_reads_seeded_prefixes(spark, make_docs, monkeypatch, epochs, share):
    monkeypatch.setattr(mixing, "SLICE_DOCUMENTS", 3)
    r = random.Random(epochs)
    docs = make_docs([(i, prose(r, r.randrange(40))) for i in range(300)] + [(5, "a repeated id"), (None, "no id"), (700, None)])
    mix = mixing.Mix(("domain", "lang", "source"), {"source": {"src0": 3}}, epochs)
    sizes = mixing.sizes_of(docs, mix)
    total = mixing.budget_of(sizes, share)
    chosen = mixing.mix_documents(docs, share, mix).toPandas()
    rows = sizes.toPandas()
    budgets = {x.source: (x.budget, x.capacity) for x in mixing.allocate(
        sizes.groupBy(*mix.levels).agg((F.sum("n_tokens") * epochs).alias("capacity")), mix, total).collect()}
    for source, own in rows.groupby("source"):
        budget, tokens = budgets[source][0], int(own.n_tokens.sum())
        whole, rest = divmod(budget, tokens)
        expected = [(named(k), e) for k in own.doc_id for e in range(whole)]
        groups = defaultdict(list)
        for k, n in zip(own.doc_id, own.n_tokens, strict=True):
            groups[hashlib.md5(f"{mix.seed}:{whole}:{named(k)}".encode()).hexdigest()].append((k, int(n)))
        spent = 0
        for _, members in sorted(groups.items()) if rest else []:
            spent += sum(n for _, n in members)
            if spent > rest:
                break
            expected += [(named(k), whole) for k, _ in members]
        mine = chosen[chosen.source == source]
        assert sorted((named(k), e) for k, e in zip(mine.doc_id, mine.epoch, strict=True)) == sorted(expected)


def test_mix_odd_rows(odd_docs, no_docs):
    taken = mixing.take_mix(odd_docs)
    assert taken.columns == odd_docs.columns and odd_docs.count() <= taken.count() <= 2 * odd_docs.count()
    once = replace(mixing.MIX, max_epochs=1)
    assert mixing.mix_documents(odd_docs, 1.0, once).count() == odd_docs.count() == mixing.take_mix(odd_docs, once).count()
    assert mixing.mix_documents(no_docs, 0.5).count() == 0 and mixing.take_mix(no_docs).count() == 0


@pytest.mark.parametrize("epochs", [1, 2, 5])
def test_least_budget_that_reads_all(spark, epochs):
    """Every leaf is read once or more, and with a budget a few per cent smaller some is not."""
    r = random.Random(epochs)
    mix = mixing.Mix(("a", "b", "c"), {"a": {"x": 5, "y": 3}, "b": {"p": 2}, "c": {"m": 4}}, epochs)
    leaves = [(a, b, c, r.randrange(1, 10 ** r.randrange(2, 7))) for a in "xyz" for b in "pqr" for c in "mno"]
    sizes = spark.createDataFrame(leaves, "a string, b string, c string, n_tokens long")
    budget = mixing.least_whole_budget(sizes, mix)
    capacity = sizes.withColumn("capacity", F.col("n_tokens") * epochs)
    tokens = {x[:3]: x[3] for x in leaves}
    short = lambda b: [x for x in mixing.allocate(capacity, mix, b).collect() if x.budget < tokens[x.a, x.b, x.c]]
    assert not short(budget) and budget <= epochs * sum(tokens.values())
    assert short(int(budget * 0.97))


# ---- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against a plain version of its rule."""
    import public_tokenizers
    from test_near_and_sketch import plain_components, plain_simhash
    from test_scans import plain_secrets
    from tokenizers import Tokenizer

    from shelfline.sources.shared import store

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], sf), name.split()[0]))
        if stage is not corpus_pipeline.encode:
            assert kept[-1].columns == docs.columns
    raw, good, single, clean, mixed, encoded = [{x.doc_id: x for x in df.collect()} for df in kept]
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(good) < set(raw) and all(good[k] == raw[k] for k in good)
    wrong = [k for k, q in labels.items() if (k in good) != (q == 1)]
    assert len(wrong) <= 0.1 * len(labels)  # some 85 labels

    prints = [plain_simhash(x.text) for x in good.values()]
    assert set(single) == set(plain_components(list(good), prints))
    assert all(single[k] == good[k] for k in single)

    assert set(clean) == set(single)
    for k, x in clean.items():
        assert (x.text == single[k].text) == (not plain_secrets(single[k].text)) or "[SECRET]" in x.text
        assert not plain_secrets(x.text) and x.n_chars == len(x.text)
    assert mixed == clean  # no document is lost; some are read twice
    times = Counter(x.doc_id for x in kept[4].select("doc_id").collect())
    assert set(times.values()) <= {1, 2} and sum(times.values()) == kept[5].count()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    assert set(encoded) == set(mixed)
    for k, x in encoded.items():
        ids = tokenizer.encode(mixed[k].text, add_special_tokens=False).ids
        assert bytes(x.ids) == np.array(ids, "<u4").tobytes() and x.n_tokens == len(ids)
        assert x.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, odd_docs, odd_labels, tmp_path):
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    found = {x.doc_id for x in docs.collect()}
    good = {x.doc_id for x in corpus_pipeline.classify(spark, odd_docs, str(tmp_path)).collect()}
    assert found <= good and {8, 9} & good <= found
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
