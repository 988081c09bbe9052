"""What must hold whatever the size: rounds, large groups, hot keys, bounds, and each stage running once."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.llm import common, components, decontaminate, langid, lm, minhash, toxicity


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    plain = common.materialise
    monkeypatch.setattr(components, "materialise", lambda df, name: written.append(name) or plain(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)], "a bigint, b bigint")
    got = components.connected_components(edges)
    assert {r.component for r in got.collect()} == {0} and got.count() == 1001
    assert len(written) <= 15, written


def test_components_against_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == label


def test_a_large_group_is_compared_in_linear_work(spark, monkeypatch):
    compared = []
    plain = minhash._rest
    monkeypatch.setattr(minhash, "_rest", lambda outside, *a: compared.append(outside.where("c <> main").count()) or plain(outside, *a))
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(2000):
        words = list(base)
        words[rng.randrange(60)] = f"x{i}"  # at most six of 56 shingles differ from the base
        rows.append((i, " ".join(words if i else base)))
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=80, block_sets=100)
    assert {r.component_id for r in out.collect()} == {0}
    assert sum(compared) == 0, "all are joined by the leader and a few pivots"


def test_spread_join_is_a_join(spark):
    rows = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as k")
    small = spark.createDataFrame([(7, "hot"), (8, "eight"), (9, "nine")], "k bigint, v string")
    got = common.spread_join(rows, small, ["k"], ["id"])
    assert sorted(map(tuple, got.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, rows.join(small, "k", "left").select("id", "k", "v").collect()), key=str)
    assert got.columns == ["k", "id", "v"]


def test_samples_do_not_shrink_with_the_table(spark, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "count", lambda self: 10**10)
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert len(common.bounded_sample(ids, "doc_id", 300).collect()) == 300
    rows = ids.selectExpr("concat('text ', doc_id % 700) as text", "cast(doc_id % 2 as int) as label")
    assert len(common.bounded_texts(rows, most=200, most_bytes=10**6)) == 200
    per = common.bounded_texts(rows, most=50, most_bytes=10**6, by_label=True)
    assert len(per) == 100 and sum(y for _, y in per) == 50
    assert sum(len(t) for t, _ in common.bounded_texts(rows, most=700, most_bytes=100)) <= 100
    assert common.bounded_texts(rows.where("false"), most=5, most_bytes=5) == []
    assert common.bounded_texts(rows.where("false"), most=5, most_bytes=5, by_label=True) == []


def test_texts_by_label_are_those_with_the_smallest_hashes(spark):
    made = [(f"text {i}", "xy"[i % 7 == 0]) for i in range(3000)] + [("text 1", "x")] * 900 + [("few", "z")]
    rows = spark.createDataFrame(made, "text string, label string")
    hashes = {r.text: r.h for r in rows.distinct().selectExpr("text", "xxhash64(text, 7) h").collect()}
    for most in (1, 40, 5000):
        got = common.bounded_texts(rows, most=most, most_bytes=10**6, by_label=True)
        for label in "xyz":
            want = sorted({t for t, y in made if y == label}, key=hashes.get)[:most]
            assert sorted(t for t, y in got if y == label) == sorted(want)


def test_toxicity_sweeps_a_long_text_in_linear_time():
    lexicon = toxicity.Lexicon(terms={" grum": 1.0, " snark ": 2.0}, exceptions=[" snark fish "])
    text = toxicity.fold("grumbler snark fish " * 32_000)
    began = time.time()
    _, hits = lexicon.evidence(text, lexicon.automaton())
    assert time.time() - began < 2 and len(hits) == 32_000


def test_toxicity_evidence_against_a_plain_scan():
    rng = random.Random(3)
    lexicon = toxicity.Lexicon(terms={" bad": 1.0, " badly ": 3.0, " evil ": 2.0}, exceptions=[" bad luck ", " no evil "])
    machine = lexicon.automaton()
    for _ in range(300):
        words = [rng.choice(["bad", "badly", "baden", "evil", "luck", "no", "evils", "fine"]) for _ in range(rng.randint(0, 12))]
        want = 0.0
        for i, w in enumerate(words):
            excused = w == "bad" and words[i + 1 : i + 2] == ["luck"] or w == "evil" and i > 0 and words[i - 1] == "no"
            want += 0 if excused else 3.0 if w == "badly" else 1.0 if w.startswith("bad") else 2.0 if w == "evil" else 0
        folded = toxicity.fold(" ".join(words))
        assert lexicon.evidence(folded, machine)[0] * np.log2(8 + len(folded) / 6) == pytest.approx(want), words


def test_a_benchmark_beyond_the_bound_is_refused(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b " * 100)], "item_id bigint, text string")
    with pytest.raises(ValueError):
        decontaminate.find_contamination(docs, bench, max_bytes=100)


# the language model


def test_group_model_is_normalised():
    rng = np.random.default_rng(2)
    unigram = rng.random(150)
    model = lm.start(unigram / unigram.sum())
    model.g += rng.standard_normal(model.g.shape).astype("f4")
    model.t += rng.standard_normal(model.t.shape).astype("f4")
    assert (np.diff(model.starts) > 1).any()
    every = np.arange(150)
    for u, v in ((150, 150), (0, 3), (149, 150)):
        assert np.exp(model.log_p(every, np.full(150, u), np.full(150, v))).sum() == pytest.approx(1, abs=1e-4)
    assert model.log_p(every, every * 0, every * 0)[77] == pytest.approx(model.log_p(every[77:78], every[:1], every[:1])[0], abs=1e-4)


def test_tokens_of_whole_batches_are_those_of_single_texts():
    texts = [None, "", " ", "A b", " a\t\tB\x0b\x0cc\r\n", "ÀÉ\xa0x\u2003y\x1cZ\x85", "Kelvin \u212a", "\x00 q", "end\n"]
    for some in (texts, texts[1:2], texts[:0], texts[::-1]):
        tokens, n = lm.split_tokens(pa.array(some, pa.string()))
        assert tokens.to_pylist() == [w for t in some for w in lm.tokens_of(t)]
        assert n.tolist() == [len(lm.tokens_of(t)) for t in some]


def _plain_log_p(model, w, u, v):
    q = model.r[u].astype("f8") @ model.c1 + model.r[v] @ model.c2
    s = model.g @ q + model.a
    k = model.group_of[w]
    first, last = model.starts[k], model.starts[k + 1]
    t = model.t[first:last] @ q + model.b[first:last]
    return s[k] - s.max() - np.log(np.exp(s - s.max()).sum()) + t[w - first] - t.max() - np.log(np.exp(t - t.max()).sum())


@pytest.mark.parametrize("scale", [1, 40])  # 40: the parts' exponentials do not fit into plain numbers
def test_exponentials_of_repeated_contexts_are_shared(monkeypatch, scale):
    rng = np.random.default_rng(5)
    unigram = 1 / np.arange(1, 1001)
    model = lm.start(unigram / unigram.sum(), seed=4)
    model.g += scale * rng.standard_normal(model.g.shape).astype("f4")
    w, u, v = rng.integers(0, 1000, 5000), rng.integers(0, 60, 5000), rng.integers(0, 60, 5000)
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *more, **named: (taken.append(np.size(x)), exp(x, *more, **named))[1])
    got = model.log_p(w, u, v)
    monkeypatch.undo()
    if scale == 1:  # the groups of each word of a context once, and the classes of each token's group
        inner = np.diff(model.starts)[model.group_of[w]].sum()
        assert sum(taken) <= 120 * len(model.g) + inner
    for i in range(0, 5000, 97):
        assert got[i] == pytest.approx(_plain_log_p(model, w[i], u[i], v[i]), rel=1e-4, abs=1e-3), i


def test_a_training_step_against_plain_formulas():
    rng = np.random.default_rng(6)
    unigram = 1 / np.arange(1, 201)
    unigram /= unigram.sum()
    model = lm.start(unigram, seed=4)
    for x in (model.r, model.t, model.g):
        x += rng.standard_normal(x.shape).astype("f4")
    trainer = lm.Trainer(model.copy(), unigram, np.random.default_rng(9), shared=20)
    w, u, v = np.sort(rng.choice(200, 700, p=unigram)), rng.integers(0, 201, 700), rng.integers(0, 201, 700)
    trainer._step(w, u, v)

    rng, p, noise = np.random.default_rng(9), trainer, 15
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    grad = {k: np.zeros(getattr(model, k).shape) for k in ("r", "t", "b", "g", "a", "c1", "c2")}
    fake = np.minimum(np.searchsorted(p.group_upto, rng.random(20)), len(model.g) - 1)
    group = model.group_of[w]
    runs = np.unique(group)
    low, high = p.upto[model.starts[runs]], p.upto[model.starts[runs + 1]]
    drawn = np.searchsorted(p.upto, low[:, None] + (high - low)[:, None] * rng.random((len(runs), 4)), side="right") - 1
    drawn = np.clip(drawn, model.starts[runs][:, None], model.starts[runs + 1][:, None] - 1)
    for x, y, z, k in zip(w, u, v, group):
        q = model.r[y].astype("f8") @ model.c1 + model.r[z] @ model.c2
        pairs = [("g", "a", k, 1.0, p.log_group[k], 1)] + [("g", "a", f, noise / 20, p.log_group[f], 0) for f in fake]
        if model.starts[k + 1] - model.starts[k] > 1:
            pairs += [("t", "b", x, 1.0, p.log_inner[x], 1)]
            pairs += [("t", "b", d, noise / 4, p.log_inner[d], 0) for d in drawn[np.searchsorted(runs, k)]]
        gq = 0
        for vectors, biases, at, weight, log_noise, true in pairs:
            rows = getattr(model, vectors)
            e = weight * (sigmoid(rows[at] @ q + getattr(model, biases)[at] - log_noise - np.log(noise)) - true)
            grad[vectors][at] += e * q
            grad[biases][at] += e
            gq = gq + e * rows[at]
        grad["r"][y] += model.c1 @ gq
        grad["r"][z] += model.c2 @ gq
        grad["c1"] += np.outer(model.r[y], gq)
        grad["c2"] += np.outer(model.r[z], gq)
    for k, g in grad.items():
        if k in ("r", "t"):
            step = g / np.sqrt(1e-2 + (g * g).mean(axis=1, keepdims=True))
        else:
            g = g if k == "b" else g * 50 / 700
            step = g / np.sqrt(1e-2 + g * g)
        assert np.allclose(getattr(trainer.m, k), getattr(model, k) - 0.1 * step, atol=2e-3), k


def test_scores_against_plain_loops_and_averaging_in_several_levels(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 2)  # six tasks: three levels of averaging
    monkeypatch.setattr(lm, "BLOCK", 16)
    rng = random.Random(1)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randint(0, 80))) for _ in range(200)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: r for r in lm.score(frame, classes=60, frequent=40).collect()}
    train_docs = frame.where(common.crc_of_id() % 5 != 1)
    counts = common.materialise(lm.token_counts(train_docs), "counts")
    scorer, c = lm.train(train_docs, counts, classes=60, frequent=40), {bytes(r.token): r.c for r in counts.collect()}
    m = scorer.model
    for i in range(0, 200, 9):
        total, before = 0.0, (len(m.t), len(m.t))
        for w in [*lm.tokens_of(texts[i]), lm.END]:
            k = scorer.words.get(w, (0, 0))[1]
            q = m.r[before[0]] @ m.c1 + m.r[before[1]] @ m.c2
            group = m.group_of[k]
            s = m.g @ q + m.a
            total += s[group] - np.log(np.exp(s).sum())
            a, b = m.starts[group], m.starts[group + 1]
            s = m.t[a:b] @ q + m.b[a:b]
            total += s[k - a] - np.log(np.exp(s).sum())
            if k == 0:
                total += np.log((c.get(w, 0) + 0.5) / (scorer.other_total + 0.5 * (scorer.other_vocabulary + 1)))
            before = (k, before[0])
        assert got[i].score == pytest.approx(total / np.log(10), rel=2e-3, abs=2e-2), i


# language id


def test_labels_against_a_plain_recurrence(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 10**6)  # one piece: the state runs over the whole text
    network = langid.Network.new(["x", "y", "z"], e=4, h=5, seed=2)
    w = network.weights
    sign = lambda a: a / (1 + abs(a))
    for text in ("a", "Größe und", "un été, là", "x" * 70):
        data = langid.bytes_of(text)
        sums = np.zeros((len(data), 3)) + w["c"]
        for d, order, v in (("f", range(len(data)), w["V"][:5]), ("b", range(len(data) - 1, -1, -1), w["V"][5:])):
            state = np.zeros(5)
            for t in order:
                a = w["E"][data[t]] @ w[f"W{d}"] + w[f"b{d}"]
                u = w[f"U{d}"]
                z, r = (0.5 + 0.5 * sign(a[k * 5 : k * 5 + 5] + state @ u[:, k * 5 : k * 5 + 5]) for k in (0, 1))
                n = sign(a[10:] + (r * state) @ u[:, 10:])
                state = n + z * (state - n)
                sums[t] += state @ v
        want = sums - np.log(np.exp(sums).sum(axis=1, keepdims=True))
        (got,) = network.label_scores([data])
        assert np.allclose(got, want, atol=1e-4)
        assert np.allclose(network.position_logits(np.frombuffer(data, np.uint8)[None])[:, 0], sums, atol=1e-4)
        assert np.allclose(network.text_scores([data, data])[1], want.sum(axis=0), atol=1e-3)


def test_pieces_cover_every_byte_once():
    data = langid.bytes_of("né 日本 " * 300)
    spans = langid.pieces_of(data, piece=50, context=7)
    assert [a for _, a, _, _ in spans] == [0, *[b for _, _, b, _ in spans[:-1]]] and spans[-1][2] == len(data)
    assert all(data[a] & 0xC0 != 0x80 for _, a, _, _ in spans) and langid.pieces_of(b"") == []
    assert all(f == max(0, a - 7) and t == min(len(data), b + 7) for f, a, b, t in spans)


def test_language_id_edges(spark):
    network = langid.fit([("aba aca " * 40, "p"), ("zyz xyx " * 40, "q")], steps=60)
    kind = "doc_id bigint, text string, lang_pred string, score string"
    rows = [(1, "aba caa", "mine", "s"), (1, "aba caa", "mine", "s"), (None, "xyz zyx", "m", "s"), (2, None, "m", "s"), (3, "12", "m", "s"), (4, "abac " * 60_000, "m", "s")]
    out = langid.predict(spark.createDataFrame(rows, kind), network)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == 6 and (got[1].lang_pred, got[None].lang_pred, got[2].lang_pred, got[3].lang_pred, got[4].lang_pred) == ("p", "q", "und", "und", "p")
    assert langid.predict(spark.createDataFrame([], kind), network).count() == 0
    assert len(network.label_bytes("aba caa")) == 7


def test_toxicity_and_decontamination_edges(spark):
    lexicon = toxicity.learn_lexicon([("grumbler here", 1)] * 9 + [("fine words", 0)] * 9)
    kind = "doc_id bigint, text string, n_terms string, n_hit string"
    empty = spark.createDataFrame([], kind)
    assert toxicity.score_toxicity(empty, lexicon).count() == 0
    assert toxicity.train(empty, spark.createDataFrame([], "doc_id bigint, toxic int")).terms == {}
    rows = spark.createDataFrame([(1, "a b c", "t", "h")] * 2 + [(None, None, "t", "h")], kind)
    bench = spark.createDataFrame([(1, "b c"), (1, "x"), (2, "b c")], "item_id bigint, text string")
    out = decontaminate.find_contamination(rows, bench)
    assert sorted((r.doc_id or 0, r.n_hit, len(r.hit_items)) for r in out.collect()) == [(0, 0, 0), (1, 2, 2), (1, 2, 2)] and out.columns.count("n_hit") == 1
    assert toxicity.score_toxicity(rows, lexicon).columns == ["doc_id", "text", "n_hit", "score", "predicted", "n_terms"]


def test_toxicity_learns_without_texts_on_the_driver(spark, monkeypatch):
    rng = random.Random(4)
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiouàé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    rows = []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randint(100, 300))]
        if i % 6 == 0:
            words[rng.randrange(1, 90)] = rng.choice(["Gr0mblor"] * 3 + ["snarkig" + rng.choice(plain)])
        elif i % 240 == 1:
            words[-1] = "gromblor fish"
        rows.append((i, " ".join(words) if i % 50 else rng.choice(["", " ", None]), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    known = docs.join(labels, "doc_id").where(common.crc_of_id() % 5 != 0).where("text is not null")
    held = common.bounded_texts(known.selectExpr("text", "toxic as label"), most=2000, most_bytes=10**8)
    got = []
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: got.append(collect(self)) or got[-1])
    lexicon = toxicity.train(docs, labels)
    largest = max((len(v) for rows in got for row in rows for v in row if isinstance(v, str)), default=0)
    assert got and largest < 100 < max(len(t) for t, _ in held)  # no whole text came, only terms and phrases
    plainly = toxicity.learn_lexicon(held)
    assert lexicon == plainly and lexicon.exceptions and lexicon.key() == plainly.key() and any("snarkig" in t for t in lexicon.terms)
    assert not [p for p in common._written if "/folded-" in p or "/families-" in p]


def test_language_model_does_not_depend_on_partitions(spark):
    """The same rows in 1, 3 and 40 partitions: several rounds of several shards each, and one model."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(int(i), " ".join(words[int(j)] for j in rng.zipf(1.3, size=60) % 300)) for i in range(1200)] + [(5000, " ".join(words) * 40), (5001, None), (5002, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    class_of = {lm.END: 1} | {w.encode(): k + 2 for k, w in enumerate(words)}
    unigram = np.full(302, 1 / 302)
    models = [lm.fit_all(docs.repartition(n), class_of, unigram, 84_000, shard_tokens=8_000) for n in (1, 3, 40)]
    for other in models[1:]:
        for part in (*lm.ROWWISE, *lm.DENSE):
            assert np.allclose(getattr(models[0], part), getattr(other, part), atol=1e-4), part
    assert not np.allclose(models[0].t, lm.start(unigram).t)


def test_shards_hold_every_token_and_spread_copies(spark, monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 50)
    rows = [(i, "a b c d e f g h i") for i in range(800)] + [(None, "x " * 9)] * 800 + [(9000, "y " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = lm.shards(docs, {lm.END: 1, b"y": 2}, 4, 4).groupBy("round", "shard").agg(F.sum(F.length("ids") / 4).alias("n")).collect()
    assert sum(r.n for r in found) == 800 * 10 * 2 + 4001
    assert len(found) == 16 and max(r.n for r in found) < 2 * 20001 / 16
