"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts scans each document once."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import extend, worker_slot

ADDED = ("n_words", "n_hit", "hit_items", "hit_spans")
SCHEMA = (
    "n_words bigint, n_hit bigint, hit_items array<string>, hit_spans array<struct<start:bigint,end:bigint>>, "
    "hit_words array<struct<start:bigint,end:bigint>>"
)

#: Consecutive item words that make a window.
WINDOW = 13
#: Benchmark bytes that one automaton may hold; only the items of a larger benchmark are scanned in further passes.
BLOCK_BYTES = 8_000_000
#: Benchmark bytes that the driver reads at most; a larger benchmark is refused, not cut.
MAX_BENCHMARK_BYTES = 128_000_000

# Fixed values of the contract: word characters are 0-9, a-z (after A-Z is lower-cased) and everything from U+0080 on.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    """The normalised words, as UTF-8: bytes from 0x80 on only occur in characters from U+0080 on."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    if not words:
        return []
    if len(words) <= window:
        return [b" ".join(words)]
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def _automaton(items: list[tuple[str, str]], window: int) -> tuple[dict[bytes, int], object]:
    """The numbers of the items' words, and the automaton of their windows over such numbers: a node for a word."""
    import ahocorasick

    owners: dict[tuple[int, ...], set[str]] = {}
    numbers: dict[bytes, int] = {}
    for item, text in items:
        for piece in windows_of(words_of(text), window):
            owners.setdefault(tuple(numbers.setdefault(w, len(numbers) + 1) for w in piece.split()), set()).add(item)
    if not owners:
        return {}, None
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for piece, who in owners.items():
        automaton.add_word(piece, (len(piece), frozenset(who)))
    automaton.make_automaton()
    return numbers, automaton


def scan(words: list[bytes], machine: tuple[dict[bytes, int], object]) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit stretches, as (first word, end word) in order and disjoint, and the items whose windows occur."""
    numbers, automaton = machine
    if automaton is None or not words:
        return [], set()
    number, found, items = numbers.get, [], set()
    for end, (n, who) in automaton.iter(tuple([number(w, 0) for w in words])):
        found.append((end + 1 - n, end + 1))
        items |= who
    return joined(found), items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int) -> list[list[tuple[str, str]]]:
    """Items in blocks of at most BLOCK_BYTES (a longer item is a block of its own)."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("i")), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the benchmark holds {size} bytes, more than the {max_bytes} that the driver may read")
    blocks: list[list[tuple[str, str]]] = [[]]
    room = BLOCK_BYTES
    for row in sorted(items.collect()):
        size = len(row.t.encode("utf-8", "surrogatepass"))
        if size > room and blocks[-1]:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append((row.i, row.t))
        room -= size
    return blocks


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    max_bytes: int = MAX_BENCHMARK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items`` (strings, sorted) and ``hit_spans`` (code points of the text).

    A document word is hit if it lies in an occurrence of a window: ``window`` consecutive words of an item, or all
    words of a shorter item. Spans cover hit stretches in the original text, end exclusive. Nothing is shuffled:
    documents are scanned where they are read, by one automaton whose letters are words. Only a benchmark above
    BLOCK_BYTES, which one worker's memory can't hold as one automaton, is scanned in further passes, which join their
    stretches to those found before; one above ``max_bytes`` is refused.

    Null or empty text: no words, no hits; long texts are scanned whole. Items with null id or text, or without words,
    are left out; repeated items count once, and an id with several texts is hit by any. An empty benchmark hits
    nothing, no document gives no row, repeated documents are scanned each, null ids matter nothing. Columns of ``docs``
    stay (``keep`` selects them), but those named like the added ones are replaced.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    out = docs.drop(*ADDED)
    blocks = _blocks(benchmark, item_col, item_text_col, max_bytes)
    for k, block in enumerate(blocks):
        through = names if k == len(blocks) - 1 else list(dict.fromkeys([*names, text_col]))
        out = extend(out, text_col, through, SCHEMA, _pass(block, window), also=(ADDED[2], "hit_words") if k else ())
    return out.drop("hit_words")


def _pass(block: list[tuple[str, str]], window: int):
    key = hashlib.sha256(repr((block, window)).encode("utf-8", "surrogatepass")).digest()

    def work(texts: list, items_before: list | None = None, words_before: list | None = None) -> dict:
        automaton = worker_slot(("benchmark", key), lambda: _automaton(block, window))
        made: dict = {c: [] for c in (*ADDED, "hit_words")}
        for i, text in enumerate(texts):
            words = words_of(text)
            stretches, items = scan(words, automaton)
            if words_before is not None:
                stretches = joined([*stretches, *((s["start"], s["end"]) for s in words_before[i])])
                items = items.union(items_before[i])
            made["n_words"].append(len(words))
            made["n_hit"].append(sum(b - a for a, b in stretches))
            made["hit_items"].append(sorted(items))
            made["hit_words"].append([{"start": a, "end": b} for a, b in stretches])
            places = [m.span() for m in _WORD.finditer(_lower(text))] if stretches else []
            made["hit_spans"].append([{"start": places[a][0], "end": places[b - 1][1]} for a, b in stretches])
        return made

    return work


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(0x41, 0x5B)})


def is_contaminated(n_words, n_hit):
    """The contract's rule: a hit, and at least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
