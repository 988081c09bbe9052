"""Fill-in-middle against the token pattern, and the way back."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from panelforge.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"
TEXTS = ["", " ", "a", " a", "a ", "\n\n", "a  b\tc \r\n", "ä öü ß", " x y", "x\x1cy z", "😀 😀\x0b😀", "<P", "a <S b", "a<P>b c d e", "< P > <", "x <", "> y"]


def brute(text, key, rate=50, spm=80):
    tokens = TOKEN.findall(text or "")
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return text or "", n, "plain", None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    return (f"<S>{s}<P>{p}<M>{m}", n, "spm", len(p), len(m)) if h4 % 100 < spm else (f"<P>{p}<S>{s}<M>{m}", n, "psm", len(p), len(m))


def random_texts(count):
    rng = random.Random(8)
    return ["".join(rng.choice(" \t\n\r\x0b\x0cab<PSM>é漢😀 \x1f") for _ in range(rng.randint(0, 60))) for _ in range(count)]


def test_ends_against_the_pattern():
    for text in TEXTS + random_texts(500):
        data = text.encode()
        tokens = fim.Tokens(data)
        ends = [0]
        for token in TOKEN.findall(text):
            ends.append(ends[-1] + len(token.encode()))
        assert tokens.n == len(ends) - 1, text
        assert [tokens.end(k) for k in range(tokens.n + 1)] == ends, text


def test_selected_bits():
    rng = random.Random(4)
    for width in (1, 2, 3, 64, 1000, 4097):
        bits = rng.getrandbits(width) | 1
        places = [i for i in range(width) if bits >> i & 1]
        assert [fim.select_bit(bits, width, r) for r in range(len(places))] == places


def test_against_brute_force_and_back(spark):
    rows = list(enumerate(TEXTS + random_texts(800))) + [(None, "no id at all"), (5000, None), (3, "the id three again"), (3, "the id three again")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for options in ({}, {"rate": 100, "spm": 0}, {"rate": 100, "spm": 100}):
        found = fim.transform(docs, **options).withColumn("back", fim.restored()).collect()
        want = sorted(str((k, t, *brute(t, k, **options), t or "")) for k, t in rows)
        assert sorted(str((r.doc_id, r.text, r.output, r.n, r.form, r.prefix_chars, r.middle_chars, r.back)) for r in found) == want
        forms = {r.form for r in found}
        assert forms == {(): {"plain", "psm", "spm"}, (100, 0): {"plain", "psm"}, (100, 100): {"plain", "spm"}}[tuple(options.values())]


def test_forms_keep_their_rates(spark):
    found = fim.transform(spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))).groupBy("form").count().collect()
    share = {r.form: r["count"] / 4000 for r in found}
    assert abs(share["plain"] - 0.5) < 0.03 and abs(share["spm"] - 0.4) < 0.03


def test_a_very_long_text(spark):
    text = "wörd \n" * 1_000_000
    key = next(i for i in range(100) if brute("a b c", i)[2] != "plain")
    row = fim.transform(spark.createDataFrame([(key, text)], SCHEMA)).withColumn("back", fim.restored()).first()
    assert (row.output, row.n, row.form, row.prefix_chars, row.middle_chars) == brute(text, key) and row.back == text


def test_empty_table_and_clashing_columns(spark):
    empty = fim.transform(spark.createDataFrame([], SCHEMA), keep=["doc_id"])
    assert empty.columns == ["doc_id", "output", "n", "form", "prefix_chars", "middle_chars"] and empty.count() == 0
    clash = spark.createDataFrame([(1, "a b", "mine", 2.5, 9)], SCHEMA + ", form string, n double, `x.y` int")
    row = fim.transform(clash).first()
    assert set(row.asDict()) == {"doc_id", "text", "x.y", "output", "n", "form", "prefix_chars", "middle_chars"}
    assert row.n == 2 and row["x.y"] == 9
