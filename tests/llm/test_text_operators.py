"""Toxicity, decontamination, language id, packing, LM scoring: small fixtures against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import common, decontaminate, langid, lm, packing, toxicity

DOCS = "doc_id bigint, text string, score string, lang string"


def docs(spark, texts, lang=None):
    return spark.createDataFrame([(i, t, "mine", lang[i] if lang else "en") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " \n\t", "a", "x" * 50_000, "é ß ñ", "  "]


# toxicity


def labelled():
    rng = random.Random(1)
    plain = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumblor", "snarkig" + rng.choice(plain)])
        elif i % 7 == 0:
            words[-1] = "grumblor fish"
        rows.append((" ".join(words), int(toxic)))
    return rows


def test_learned_lexicon_finds_words_beginnings_disguises_and_exceptions():
    lexicon = toxicity.learn_lexicon(labelled())
    machine = lexicon.automaton()
    p = lambda t: lexicon.probability(lexicon.evidence(toxicity.fold(t), machine)[0])
    assert p("such a snarkignew thing") >= 0.5 and p("you SNARKIGlen!!") >= 0.5
    assert p("sn4rkigmo here") >= 0.5 and p("snаrkigmo here") >= 0.5  # a digit, a Cyrillic letter
    assert p("a nice walk") < 0.5 and p("") < 0.5 and p("presnarkig") < 0.5
    assert p("a grumblor fish") < 0.5
    assert " grumblor fish " in lexicon.exceptions or not any("grumblor" in t for t in lexicon.terms)


def test_no_toxic_label_scores_below_half(spark):
    lexicon = toxicity.learn_lexicon([("a b", 0)])
    out = toxicity.score_toxicity(docs(spark, ODD), lexicon)
    assert out.columns == ["doc_id", "text", "lang", "score", "predicted", "n_terms"]  # a clashing column is replaced
    assert {r.predicted for r in out.collect()} == {0} and out.count() == len(ODD)


def test_training_never_reads_held_out_labels(spark):
    rows = labelled()
    frame = docs(spark, [t for t, _ in rows])
    truth = [(i, y) for i, (_, y) in enumerate(rows)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    lies = [(i, 1 - y if held(i) else y) for i, y in truth]
    kind = "doc_id bigint, toxic int"
    one = toxicity.train(frame, spark.createDataFrame([*truth, (None, 1), (5, None)], kind))
    two = toxicity.train(frame, spark.createDataFrame(lies, kind))
    assert one.terms == two.terms and one.slope == two.slope


# decontamination


def brute_hits(text, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", decontaminate._lower(t or ""))
    w, marks, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(13, len(v))
        for k in range(len(v) - n + 1) if v else ():
            for at in range(len(w) - n + 1):
                if w[at : at + n] == v[k : k + n]:
                    marks |= set(range(at, at + n))
                    found.add(str(item))
    return len(w), len(marks), sorted(found)


@pytest.mark.parametrize("block", [4_000_000, 60])
def test_decontamination_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)  # the small one needs several automata
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["été", "ß1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([20, 13, 14, 3, 1, 40])] + [(7, "W1 w1!"), (8, "..."), (9, None), (None, "w2 w2")]
    texts = [*ODD, "A, w1-W1. b"]
    for _ in range(30):
        words = [rng.choice(vocabulary).upper() for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(words))
        texts.append("; ".join(words[:at] + rng.choice(items[:6])[1].split() + words[at:]))
    bench = spark.createDataFrame([*items, items[0]], "item_id bigint, text string")
    out = decontaminate.find_contamination(docs(spark, texts), bench).collect()
    known = [(i, t) for i, t in items if i is not None and t is not None]
    for r in out:
        assert (r.n_words, r.n_hit, r.hit_items) == brute_hits(texts[r.doc_id], known), texts[r.doc_id]
        got = sum(len(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", decontaminate._lower(texts[r.doc_id][s.start : s.end]))) for s in r.hit_spans)
        assert got == r.n_hit


def test_empty_benchmark_and_empty_documents(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_hit for r in decontaminate.find_contamination(docs(spark, ODD), bench).collect()} == {0}
    assert decontaminate.find_contamination(docs(spark, ["a"]).where("false"), bench).count() == 0


# language id

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "eit"], "cc": ["ñé", "où", "ça"]}


def tongues(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        out.append((" ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30)), lang))
    return out


def test_gradients_match_finite_differences():
    network = langid.Network.new(["x", "y"], e=3, h=2)
    network.weights = {k: v.astype(np.float64) * 0.5 for k, v in network.weights.items()}
    x, y, weight = np.array([[97, 98, 99], [97, 99, 100]], dtype=np.uint8), np.array([0, 1]), np.array([1.0, 2.0])
    _, g = network.gradients(x, y, weight)
    for name in g:
        w = network.weights[name]
        for at in [tuple(rng) for rng in np.argwhere(np.abs(g[name]) > 1e-4)[:3]]:
            held, losses = w[at], []
            for step in (1e-2, -1e-2):
                w[at] = held + step
                losses.append(network.gradients(x, y, weight)[0])
            w[at] = held
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(g[name][at], rel=0.05, abs=1e-4)


def test_language_id_held_out_accuracy_and_edges(spark):
    rows = tongues(60, 1)
    network = langid.fit(rows, steps=150)
    test = tongues(30, 2)
    texts = [t for t, _ in test] + [*ODD[:3], "123 !?", "x" * 3000]
    out = {r.doc_id: r for r in langid.predict(docs(spark, texts), network).collect()}
    assert sum(out[i].lang_pred == y for i, (_, y) in enumerate(test)) >= 29
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in range(30, 34))
    assert out[34].lang_pred in network.languages and 0 <= out[34].score <= 1
    marks = network.label_positions("kalomi ungung")
    assert [len(m) for _, m in marks] == [6, 6]


def test_language_training_leaves_out_held_out_rows_and_nulls(spark):
    rows = tongues(40, 5)
    lang = [None if i == 3 else "held" if zlib.crc32(str(i).encode()) % 4 == 2 else y for i, (_, y) in enumerate(rows)]
    assert langid.train(docs(spark, [t for t, _ in rows], lang)).languages == ["aa", "bb", "cc"]
    nothing = langid.train(docs(spark, ["a"], [None]))
    assert langid.predict(docs(spark, ["abc"]), nothing).first().lang_pred == "und"


# packing


def test_first_fit_decreasing_against_a_plain_loop():
    rng = random.Random(2)
    for n in (1, 2, 7, 300):
        lengths = [rng.randint(1, 100) for _ in range(n)]
        bins, want = [], [None] * n
        for i in sorted(range(n), key=lambda k: -lengths[k]):
            b = next((k for k, used in enumerate(bins) if used + lengths[i] <= 100), len(bins))
            if b == len(bins):
                bins.append(0)
            want[i] = (b, bins[b])
            bins[b] += lengths[i]
        assert packing.first_fit_decreasing(lengths, 100) == want


def test_fast_and_file_tokenizers_agree():
    both, plain = packing.Encoder(*packing.default_paths()), packing.Encoder(packing.default_paths()[0])
    rng = random.Random(4)
    letters = "abcXYZ0129 \n\t\r.,!'’“”…€$%éßñÀÿŁž-_@/() ́"
    texts = ["", "don't I'LL we've", "a  b \n\n c ", "日本語 <|endoftext|> x", "a<|endoftext|>"] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(400)]
    for t in texts:
        assert both.encode(t).tolist() == plain.encode(t).tolist(), t


def test_packing_round_trip(spark):
    rng = random.Random(6)
    texts = [*ODD, *(" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(0, 3000))) for _ in range(40))]
    frame = docs(spark, texts).union(spark.createDataFrame([(None, "no id", "s", None), (8, texts[8], "again", "en")], DOCS))
    rows = packing.pack(frame, capacity=256, group_docs=10, with_ids=True).collect()
    plain = packing.Encoder(packing.default_paths()[0])
    for doc_id in range(len(texts)):
        want = [*plain.encode(texts[doc_id]).tolist(), packing.END_ID]
        mine = sorted((r.start, r.ids) for r in rows if r.doc_id == doc_id)
        got = [x for _, ids in mine for x in ids]
        assert got == want * (2 if doc_id == 8 else 1) or doc_id == 8 and sorted(got) == sorted(want * 2)
    sequences = collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids)
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(frame.where("false")).count() == 0


# LM scoring


def test_lm_counts_base_and_normalisation(spark):
    rng = random.Random(8)
    texts = [*ODD, *(" ".join(rng.choice(["The", "cat", "dog", "ran", f"n{rng.randint(0, 50)}"]) for _ in range(rng.randint(0, 60))) for _ in range(60))]
    frame = docs(spark, texts).union(spark.createDataFrame([(9, texts[9], "again", "en"), (None, "the cat", "s", None)], DOCS))
    out = lm.score(frame, classes=8, frequent=12)
    ids = [*range(len(texts)), 9, None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = lambda t: [*lm.tokens_of(t), lm.END]
    text = lambda i: "the cat" if i is None else texts[i]
    c = collections.Counter(w for i in ids if not held(i) for w in tokens(text(i)))
    n, v = sum(c.values()), len(c)
    rows = out.collect()
    assert len(rows) == len(ids)
    for r in rows:
        mine = tokens(text(r.doc_id))
        assert (r.held_out, r.n_tokens, r.train_tokens, r.n_known) == (held(r.doc_id), len(mine), n, sum(c[w] > 0 for w in mine))
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in mine), rel=1e-9)
        assert r.score < 0


def test_lm_tables_are_normalised():
    model = lm.fit([np.array([2, 3, 0, 1]), np.array([3, 1])], 4, np.full(4, 0.25), epochs=3)
    near, far, norm = model.tables()
    p = np.exp(near[:, None, :] + far[None, :, :] - norm[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)


def test_lm_learns_from_every_training_document(spark):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id").where(common.crc_of_id() % 5 != 1)
    few = {r.doc_id for r in common.bounded_sample(ids, "doc_id", 1500, seed=13).collect()}
    text = lambda i: "p q " * 30 if i in few else "x y " * 30
    out = lm.score(spark.createDataFrame([(i, text(i)) for i in range(3000)], "doc_id bigint, text string"))
    row = out.where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert row.score > 0.7 * row.base, row


def test_lm_empty_table(spark):
    assert lm.score(docs(spark, ["a"]).where("false")).select(F.count("*")).first()[0] == 0


def test_how_many_families_are_enough_follows_from_chance():
    from collections import Counter

    assert toxicity._need(Counter({3: 1, 40: 5}), Counter(), 0.05) == 3
    assert toxicity._need(Counter({3: 100, 6: 20, 40: 5}), Counter({3: 90, 4: 6}), 0.05) == 6
    assert toxicity._need(Counter({3: 10}), Counter({3: 10}), 0.05) == 4  # no term passes
    assert toxicity._need(Counter(), Counter(), 0.05) == 3


def test_a_word_of_few_toxic_texts_is_a_term_only_where_such_words_are_rare():
    def terms(vocabulary):
        rng = random.Random(5)
        words = ["".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiou") for _ in range(4)) for _ in range(vocabulary)]
        prose = lambda: " ".join(rng.choice(words) for _ in range(60))
        rows = [(prose() + (" grumblorf" if i < 8 else " vilestone"), 1) for i in range(500)] + [(prose(), 0) for _ in range(500)]
        return set(toxicity.learn_lexicon(rows).terms)

    assert terms(2_000) == {" grumblorf ", " vilestone "}
    assert " vilestone " in terms(60_000)
