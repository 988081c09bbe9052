"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

import os
import random
import re

import pytest
from test_structure_operators import brute_components
from test_text_operators import brute_hits

import __spark_entry__ as entry
import corpus_pipeline
from panelforge.llm import packing, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(25))) for i in range(5)]
    rows, labels = [], []
    for i in range(120):
        text = prose(rng.randint(30, 120))
        if i % 6 == 0:
            text[3] = "grumblor"
        if i % 10 == 1:
            text = text[:20] + items[i % 5][1].split()
        if i % 10 == 2:
            text += [f"name{i}@mail.example.com", "4111111111111111"]
        rows.append((i, " ".join(text), "en", "src", len(" ".join(text))))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(40):
        text = rows[i * 2][1].split()
        if i % 2:
            text[10] = "changed"
        rows.append((200 + i, " ".join(text), "en", "src", len(" ".join(text))))
    rows += [(500, None, None, None, None), (501, "", "en", "src", 0), (None, "no id at all", "en", "src", 12)]
    where = f"file://{tmp_path_factory.mktemp('tables')}"
    docs = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, data, kind in (("documents", rows, docs), ("benchmark", items, "item_id bigint, text string"), ("labels", labels, "doc_id bigint, quality int, toxic int")):
        spark.createDataFrame(data, kind).write.parquet(f"{where}/{name}.parquet")
    return where, rows, items, labels


def test_stages_against_brute_force(spark, tables):
    where, rows, items, _ = tables
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, where)
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
    kept = lambda name: {r.doc_id for r in seen[name][1]}

    assert kept("toxicity") == {i for i, t in seen["toxicity"][0] if "grumblor" not in (t or "")}
    before = seen["near_dedup"][0]
    label = brute_components([(i, t) for i, t in before if i is not None], 80)
    assert kept("near_dedup") == {i for i in label if label[i] == i} | {None}
    before = seen["decontamination"][0]
    hit = {i: brute_hits(t, items) for i, t in before}
    assert kept("decontamination") == {i for i, (n, h, _) in hit.items() if not (h > 0 and 20 * h >= n)}
    texts = {r.doc_id: r.text for r in seen["pii"][1]}
    for i, t in seen["pii"][0]:
        if t and "@" in t:
            assert "name" not in re.findall(r"\S+@", texts[i])[0] and "4111111111111111" not in texts[i]
            assert texts[i].split()[:-2] == t.split()[:-2]
        else:
            assert texts[i] == t
    encoder = packing.Encoder(packing.default_paths()[0])
    tokens = {}
    for r in seen["packing"][1]:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: len(encoder.encode(t)) + 1 for i, t in texts.items()}
    final = corpus_pipeline.run(spark, where)
    assert sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in final.collect()) == sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in seen["packing"][1])


def test_toxicity_stage_learned_the_word(spark, tables):
    where, rows, _, labels = tables
    lexicon = toxicity.train(spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet"))
    assert " grumblor " in lexicon.terms


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["op1_chat_formatting", "op2_exact_topk", "op8_minhash_dedup", "op10_decontamination", "op11_source_mix", "op12_centroid_clusters", "op13_fill_in_middle"])
def test_queries_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in "documents embeddings benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    found = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    spell = lambda get: tuple(str(get(c)) for c in order)
    theirs = sorted(spell(dict(zip(names, r)).__getitem__) for r in found.fetchall())
    assert sorted(spell(r.__getitem__) for r in df.collect()) == theirs


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
