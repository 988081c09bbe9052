"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Set
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_rows, bounded_sample, crc_of_id, extend, map_batches, materialise, scratch, worker_slot

# Letters of other scripts, and their lower-case forms, that look like Latin ones.
_HOMOGLYPHS = str.maketrans(
    "абвгеёзіїјкмнорсԛѕтуԝхһӏɑαβεικνοрτυχγω",
    "abbreeziijkmhopcqstywxhlaabeikvoptuxyw",
)
# Digits and signs that stand for letters.
_SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
_SUBSTITUTED = re.compile(r"(?<=[a-z])[013457@$!|89]{1,3}(?=[a-z])|(?<![\w@$!|.-])[013457@$|]{1,2}(?=[a-z])|(?<=[a-z])[013457](?![\w@$!|.-])")
_OTHER_SCRIPT = re.compile("[ɐ-ԯＡ-ｚ]")
_IGNORED = re.compile("[­​-‏⁠﻿]")
_SIGN = re.compile("[\u0080-¿×÷ -⯿　-〿]")
#: UTF-8 bytes: letters and everything from U+0080 on stay, all else is a space.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

#: Labelled documents that the lexicon is learned from, at most (all labelled ones, if fewer).
MAX_TRAIN_DOCS = 8000
#: Bytes of text that it is learned from, at most; whole texts only.
MAX_TRAIN_BYTES = 128_000_000
#: A term must occur in so many toxic texts for each other one, and in so many families of toxic texts that of the terms
#: which do this share, at most, would do so if the labels were dealt at random.
ODDS, CHANCE = 19, 0.05
#: Families that a term needs at least.
LEAST = 3
#: Lengths in bytes of the word beginnings that may become terms.
PREFIXES = (4, 8)
#: Training texts whose terms a task holds at once.
LEARN_ROWS = 50


def fold(text: str | None) -> str:
    """Lower case, homoglyphs and substituted digits as plain letters, then words between single-byte spaces.

    The result holds UTF-8 bytes as Latin-1 characters, so that the automaton sees one alphabet of 256.
    """
    if not text:
        return " "
    low = text.lower()
    if not low.isascii():
        if _OTHER_SCRIPT.search(low):
            low = re.sub("[ａ-ｚ]", lambda m: chr(ord(m[0]) - 0xFEE0), low.translate(_HOMOGLYPHS))
        low = _SIGN.sub(" ", _IGNORED.sub("", low))
    low = _SUBSTITUTED.sub(lambda m: "".join(_SUBSTITUTES[c] for c in m[0]), low)
    return f" {low.encode('utf-8', 'surrogatepass').translate(_LETTERS).decode('latin-1')} "


@dataclass
class Lexicon:
    """``terms``: folded words (``" idiot "``) and word beginnings (``" idio"``), with weights; a word weighs as its
    longest term. ``exceptions``: folded phrases in which a term does not count. ``slope`` and ``offset`` map the
    length-normalised evidence to a probability."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 4.0
    offset: float = -2.0

    def key(self) -> str:
        return xxhash.xxh3_128_hexdigest(repr((sorted(self.terms.items()), self.exceptions)).encode("utf-8", "surrogatepass"))

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for phrase in self.exceptions:
            out.add_word(f" {phrase.strip()} ", (0.0, len(phrase.strip()) + 2, True))
        for term, weight in self.terms.items():
            if f" {term.strip()} " not in self.exceptions:
                out.add_word(term, (weight, len(term), False))
        if not len(out):
            return None
        out.make_automaton()
        return out

    def evidence(self, folded: str, automaton) -> tuple[float, list[tuple[int, int]]]:
        """Weights over the logarithm of the length, and the (start, end) of the words that count."""
        best: dict[int, tuple[float, int]] = {}
        excused: list[tuple[int, int]] = []
        if automaton is None:
            return 0.0, []
        for end, (weight, size, exception) in automaton.iter(folded):
            start = end - size + 2
            if exception:
                excused.append((start, end))
            elif start not in best or size > best[start][1]:
                best[start] = (weight, size)
        hits = dict(best)
        if excused:  # one sweep over starts and stretches, both in order
            excused.sort()
            at, reach = 0, -1
            for s in sorted(best):
                while at < len(excused) and excused[at][0] <= s:
                    reach, at = max(reach, excused[at][1]), at + 1
                if s < reach:
                    del hits[s]
        total = sum(w for w, _ in hits.values())
        return total / math.log2(8 + len(folded) / 6), [(s, s + n) for s, (_, n) in sorted(hits.items())]

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * evidence + self.offset))))


def learn_lexicon(rows: list[tuple[str | None, int]], prefixes: tuple[int, int] = PREFIXES, *, odds: float = ODDS, chance: float = CHANCE) -> Lexicon:
    """A lexicon from (text, 0 or 1) rows in memory; ``train`` learns the same from a table, without holding its texts.

    Terms are words and word beginnings that occur in enough toxic texts and in hardly any other (one for ``odds`` toxic
    ones, at most). Near copies count once: support is the number of families, told apart by the smallest hash of their
    words. How many are enough is told by the same count with the labels dealt anew, by a hash of the text: so many
    that of the terms that pass no more than ``chance`` would pass by chance. A word of few texts is so a term where
    rare words are rare, and none where there are many. A bigram around a term that occurs mostly in texts that are not
    toxic becomes an exception phrase. No toxic row: an empty lexicon, whose score is below one half for all texts.
    """
    folded = [(fold(t), int(bool(y))) for t, y in rows]
    toxic = sum(y for _, y in folded)
    if not toxic:
        return Lexicon()
    dealt = [(t, _dealt(t, toxic / len(folded))) for t, _ in folded]
    found = []
    for labelled in (folded, dealt):
        seen: dict[str, set[int]] = defaultdict(set)
        for term, family in _families((t for t, y in labelled if y), prefixes):
            seen[term].add(family)
        support = {t: len(f) for t, f in seen.items() if len(f) >= LEAST}
        hits, misses = _holding(labelled, support.keys(), prefixes)
        found.append([(t, n, misses[t], support[t]) for t, n in hits.items() if n >= odds * misses[t]])
    need = _need(*(Counter(f for *_, f in terms) for terms in found), chance)
    lexicon = Lexicon(terms=_choose(((t, h, m) for t, h, m, f in found[0] if f >= need), toxic, len(folded) - toxic, prefixes[0]))
    lexicon.exceptions = sorted(f" {p} " for p, c in _phrases(folded, lexicon, lexicon.automaton()).items() if c[0] >= 3 and c[0] >= 4 * c[1])
    _calibrate(_points(folded, lexicon, lexicon.automaton()), lexicon)
    return lexicon


def _dealt(text: str, share: float) -> int:
    """A label of the folded text by chance, 1 for ``share`` of all texts."""
    return int(xxhash.xxh64_intdigest(text.encode("latin-1"), seed=9) < share * 2**64)


def _need(found: Counter[int], by_chance: Counter[int], chance: float) -> int:
    """The least number of families from which on ``by_chance`` holds at most ``chance`` as many terms as ``found``; both count
    terms by their families."""
    real = random = 0
    need = LEAST if not found else max(found) + 1
    for n in sorted({*found, *by_chance}, reverse=True):
        real, random = real + found[n], random + by_chance[n]
        if random > chance * real:
            break
        need = n
    return max(LEAST, need)


def _terms_of(words: set[str], prefixes: tuple[int, int]) -> set[str]:
    # lengths count bytes of UTF-8; a beginning must not end inside a character
    low, high = prefixes
    cut = {f" {w[:n]}" for w in words for n in range(low, min(high, len(w)) + 1) if n == len(w) or ord(w[n]) & 0xC0 != 0x80}
    return cut | {f" {w} " for w in words if len(w) >= 3}


def _families(toxic: Iterable[str], prefixes: tuple[int, int]) -> Iterator[tuple[str, int]]:
    """(term, family) for each term of each text that has words."""
    for text in toxic:
        words = set(text.split())
        if words:
            family = min(xxhash.xxh32_intdigest(w.encode("latin-1")) for w in words)
            for term in _terms_of(words, prefixes):
                yield term, family


def _holding(folded: Iterable[tuple[str, int]], support: Set[str], prefixes: tuple[int, int]) -> tuple[Counter[str], Counter[str]]:
    """How many toxic texts, and how many others, hold each term of ``support``."""
    hits: Counter[str] = Counter()
    misses: Counter[str] = Counter()
    for text, y in folded:
        (hits if y else misses).update(_terms_of(set(text.split()), prefixes) & support)
    return hits, misses


def _choose(kept: Iterable[tuple[str, int, int]], toxic: int, clean: int, low: int) -> dict[str, float]:
    """Terms with weights from (term, toxic texts, other texts) of those that occur in hardly any other text."""
    hits: dict[str, int] = {}
    chosen: dict[str, float] = {}
    for term, hit, miss in sorted(kept, key=lambda k: (-len(k[0]), k[0])):
        hits[term] = hit
        chosen[term] = round(min(7.0, math.log((hit + 0.5) / (toxic + 1)) - math.log((miss + 0.5) / (clean + 1))), 4)
    for term in hits:
        # of a chain of beginnings the longest that says as much stays: " idiot " rather than " idio"
        for n in range(low + 1, len(term)):
            short = term[:n]
            if short in chosen and term in chosen:
                if hits[term] >= 0.98 * hits[short]:
                    del chosen[short]
                else:
                    del chosen[term]
    return chosen


def _phrases(folded: Iterable[tuple[str, int]], lexicon: Lexicon, automaton) -> dict[str, Counter[int]]:
    """How often each bigram around a term occurs in texts of either label."""
    around: dict[str, Counter[int]] = defaultdict(Counter)
    for text, y in folded:
        for start, _ in lexicon.evidence(text, automaton)[1]:
            stop = text.find(" ", start)
            before, after = text[max(0, start - 40) : start].split()[-1:], text[stop : stop + 40].split()[:1]
            term = text[start:stop]
            for phrase in {" ".join([*before, term]), " ".join([term, *after])}:
                if " " in phrase:
                    around[phrase][y] += 1
    return around


def _points(folded: Iterable[tuple[str, int]], lexicon: Lexicon, automaton) -> Counter[tuple[float, int]]:
    return Counter((round(lexicon.evidence(t, automaton)[0], 3), y) for t, y in folded)


def _calibrate(points: Counter[tuple[float, int]], lexicon: Lexicon) -> None:
    """Logistic regression on the one feature, by Newton steps with a little ridge."""
    ordered = sorted(points.items())
    a, b = 4.0, -2.0
    for _ in range(60):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for (x, y), n in ordered:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            r, v = n * (p - y), n * p * (1 - p)
            g0, g1, h00, h01, h11 = g0 + r, g1 + r * x, h00 + v, h01 + v * x, h11 + v * x * x
        g0, g1, h00, h11 = g0 + 0.01 * b, g1 + 0.01 * a, h00 + 0.01, h11 + 0.01
        det = h00 * h11 - h01 * h01
        if det <= 1e-12:
            break
        da, db = (h00 * g1 - h01 * g0) / det, (h11 * g0 - h01 * g1) / det
        a, b = a - max(-2.0, min(2.0, da)), b - max(-2.0, min(2.0, db))
        if abs(da) + abs(db) < 1e-6:
            break
    lexicon.slope, lexicon.offset = max(a, 0.1), min(b, -0.5)


def train(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_TRAIN_DOCS, max_bytes: int = MAX_TRAIN_BYTES, odds: float = ODDS, chance: float = CHANCE) -> Lexicon:
    """The lexicon from documents that ``labels`` marks and whose crc32(doc_id as text) mod 5 is not 0; ``odds`` and ``chance``
    as in ``learn_lexicon``.

    Fitted on ``max_docs`` labelled ids, chosen by hash (so few that they can be broadcast), and on as many of their
    distinct texts within ``max_bytes``, however often an id is repeated. A null label or id teaches nothing; several
    labels of an id count as toxic if one is. Empty tables: an empty lexicon. Texts stay on the executors: the driver gets
    hashes, lengths and counts of terms.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    marked = bounded_sample(marked.where(crc_of_id() % 5 != 0), "doc_id", max_docs)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(marked), "doc_id").where("text is not null")
    rows = bounded_rows(texts.select("text", "label"), most=max_docs, most_bytes=max_bytes)
    if rows is None:
        return Lexicon()
    with scratch(docs.sparkSession):
        return _learn_from(rows.select("text", "label"), odds, chance)


def _learn_from(rows: DataFrame, odds: float, chance: float) -> Lexicon:
    """What ``learn_lexicon`` learns from the rows (text, label), which tasks read and count."""
    folded = materialise(map_batches(rows, lambda b: {"folded": [fold(t) for t in b["text"]], "y": [int(bool(y)) for y in b["label"]]}, "folded string, y int"), "folded")
    sizes = {r.y: r["count"] for r in folded.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Lexicon()
    found = _passing(folded, odds)
    dealt = materialise(map_batches(folded, lambda b: {"folded": b["folded"], "y": [_dealt(t, toxic / (toxic + clean)) for t in b["folded"]]}, "folded string, y int"), "dealt")
    by_chance = _passing(dealt, odds)
    need = _need(*(Counter(f for *_, f in terms) for terms in (found, by_chance)), chance)
    kept = [(t, h, m) for t, h, m, f in found if f >= need]
    bare = Lexicon(terms=_choose(kept, toxic, clean, PREFIXES[0]))

    def phrases(batch: dict) -> dict:
        found = _phrases(zip(batch["folded"], batch["y"], strict=True), bare, worker_slot(("lexicon", bare.key()), bare.automaton))
        return {"phrase": list(found), "toxic": [c[1] for c in found.values()], "clean": [c[0] for c in found.values()]}

    around = map_batches(folded, phrases, "phrase string, toxic bigint, clean bigint").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    exceptions = sorted(f" {r.phrase} " for r in around.where("clean >= 3 and clean >= 4 * toxic").select("phrase").collect())
    lexicon = Lexicon(terms=bare.terms, exceptions=exceptions)

    def points(batch: dict) -> dict:
        found = _points(zip(batch["folded"], batch["y"], strict=True), lexicon, worker_slot(("lexicon", lexicon.key()), lexicon.automaton))
        return {"x": [x for x, _ in found], "y": [y for _, y in found], "n": list(found.values())}

    met = map_batches(folded, points, "x double, y int, n bigint").groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
    _calibrate(Counter({(r.x, r.y): r.n for r in met}), lexicon)
    return lexicon


def _passing(folded: DataFrame, odds: float) -> list[tuple[str, int, int, int]]:
    """(term, toxic texts, other texts, families) of the terms of ``folded`` (folded, y) in LEAST families of toxic texts and in
    hardly any other text. Texts are counted where they are; the driver gets terms of enough families, and their counts."""

    def families(batch: dict) -> dict:
        pairs = list(set(_families((t for t, y in zip(batch["folded"], batch["y"], strict=True) if y), PREFIXES)))
        return {"term": [t for t, _ in pairs], "family": [f for _, f in pairs]}

    pairs = map_batches(folded.where("y = 1"), families, "term string, family bigint", most=LEARN_ROWS)
    support = {r.term: r.n for r in pairs.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).collect()}
    terms = set(support)

    def holding(batch: dict) -> dict:
        hits, misses = _holding(zip(batch["folded"], batch["y"], strict=True), terms, PREFIXES)
        found = list(hits.keys() | misses.keys())
        return {"term": found, "hits": [hits[t] for t in found], "misses": [misses[t] for t in found]}

    sums = map_batches(folded, holding, "term string, hits bigint, misses bigint", most=LEARN_ROWS).groupBy("term").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    return [(r.term, r.hits, r.misses, support[r.term]) for r in sums.where(F.col("hits") >= odds * F.col("misses")).collect()]


def score_toxicity(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``n_terms`` (words of the lexicon in the text).

    Whole texts are scanned once, where they are read, in time that grows with their length; only the lexicon is sent
    out. Null or empty text: the score of no evidence, which is below one half. Null ids matter nothing. A score of
    exactly one half counts as toxic. All columns stay (``keep`` selects them); those with the added names are
    replaced. Repeated rows are scored each; an empty table gives no row.
    """

    def work(texts: list) -> dict:
        machine = worker_slot(("lexicon", lexicon.key()), lexicon.automaton)
        found = [lexicon.evidence(fold(t), machine) for t in texts]
        scores = [lexicon.probability(e) for e, _ in found]
        return {"score": scores, "predicted": [int(s >= 0.5) for s in scores], "n_terms": [len(h) for _, h in found]}

    return extend(docs, text_col, keep, "score double, predicted int, n_terms int", work)
