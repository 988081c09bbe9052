"""Fill-in-middle transformation: cuts between tokens found by bit-parallel operations on big integers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import extend

#: Spelled before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = b" \t\n\v\f\r"
#: A byte's class as a binary digit: 1 for white space.
_CLASSES = bytes(ord("1") if b in _SPACE else ord("0") for b in range(256))


class Tokens:
    """The tokens of a text, as the bits of an integer: bit i is set where byte i ends a word.

    A token is a word with the white space before it; white space at the end of the text is one more. The bytes' classes,
    read as binary digits, give the mask of white space; a word ends where a byte is none and the next one, a shift away,
    is or is missing. Bytes within a character are no white space, so ends fall between characters."""

    def __init__(self, data: bytes):
        self.length = len(data)
        space = int(data[::-1].translate(_CLASSES), 2) if data else 0
        every = (1 << self.length) - 1
        self.ends = (every ^ space) & ((space >> 1) | (1 << self.length >> 1))
        self.words = self.ends.bit_count()
        self.n = self.words + (space >> (self.length - 1) if data else 0)

    def end(self, k: int) -> int:
        """The byte after the first ``k`` tokens."""
        if k == 0:
            return 0
        return self.length if k > self.words else select_bit(self.ends, self.length, k - 1) + 1


def select_bit(bits: int, width: int, rank: int) -> int:
    """The place of the set bit of ``bits`` with ``rank`` lower ones: halves are counted and one of them kept, so all steps
    together touch about twice the width."""
    at = 0
    while width > 1:
        half = width // 2
        low = bits & ((1 << half) - 1)
        below = low.bit_count()
        if rank < below:
            bits, width = low, half
        else:
            bits, width, rank, at = bits >> half, width - half, rank - below, at + half
    return at


def draws(seed: int, key) -> list[int]:
    """Four 32-bit numbers of ``seed`` and an id (null: empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(text: str | None, key, *, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple[str, int, str, int | None, int | None]:
    """(output, n, form, prefix_chars, middle_chars) of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    tokens = Tokens(data)
    h1, h2, h3, h4 = draws(seed, key)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return text, tokens.n, "plain", None, None
    first, last = (tokens.end(k) for k in sorted((h1 % (tokens.n + 1), h2 % (tokens.n + 1))))
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass") for part in (data[:first], data[first:last], data[last:]))
    if h4 % 100 < spm:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", tokens.n, "spm", len(prefix), len(middle)
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", tokens.n, "psm", len(prefix), len(middle)


def transform(docs: DataFrame, *, seed: int = 42, rate: int = 50, spm: int = 80, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with output (the rearranged text), n (its tokens), form (plain, psm or spm), prefix_chars and middle_chars
    (code points; null if plain).

    ``rate`` per cent of the texts are cut at two token ends drawn from the hash of ``seed`` and id, ``spm`` per cent of
    those with the suffix first. Empty texts, and texts that spell a mark, stay plain. Null texts are empty; a null id
    draws as an empty one; rows that share an id share their draws; an empty table gives no row. Whole texts are cut, in
    time linear in their bytes and memory of a small multiple of the longest one. ``keep`` names the columns that
    stay (all by default); those called like added ones are replaced. One pass, nothing is shuffled, and a task that
    is run again makes the same rows.
    """

    def work(texts: list, keys: list) -> dict[str, list]:
        made = [rearrange(t, k, seed=seed, rate=rate, spm=spm) for t, k in zip(texts, keys)]
        return dict(zip(("output", "n", "form", "prefix_chars", "middle_chars"), map(list, zip(*made)))) if made else dict.fromkeys(("output", "n", "form", "prefix_chars", "middle_chars"), [])

    return extend(docs, text_col, keep, "output string, n bigint, form string, prefix_chars bigint, middle_chars bigint", work, also=(id_col,))


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that ``transform`` made ``output`` of: its marks can't occur within the parts."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(4), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + 4, F.length(output))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + 4, F.length(output))

    prefix, suffix, middle = parts(SUFFIX)
    spm_suffix, spm_prefix, spm_middle = parts(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(spm_prefix, spm_middle, spm_suffix)).otherwise(output)
