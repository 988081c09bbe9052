"""Packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import arrow_schema, ship, to_batch, worker_slot

#: Tokens in a sequence.
CAPACITY = 2048
#: Appended to each document's ids.
END_ID = 1
#: Documents in a randomised group, on average.
GROUP_DOCS = 8192

# tiktoken gives the ids of the tokenizer file on this range (tests hold the two against each other) several times
# faster; other texts, and those that spell the special token, go through the file itself.
_OTHER = re.compile(r"[^\x00-ͯ‐-‧€]|<\|endoftext\|>")


class Encoder:
    """Ids of ``tokenizer_path`` (a file for ``tokenizers``), with ``ranks_path`` as the fast way to the same ids."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        self.tokenizer_path, self.ranks_path, self._slow, self._fast = tokenizer_path, ranks_path, None, None

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if self.ranks_path and not _OTHER.search(text):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    @property
    def slow(self):
        if self._slow is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.tokenizer_path)
        return self._slow

    @property
    def fast(self):
        if self._fast is None:
            import base64

            import public_tokenizers
            import tiktoken

            with open(self.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return self._fast


def encoder(tokenizer_path: str, ranks_path: str | None) -> Encoder:
    """One per Python worker."""
    return worker_slot(("encoder", tokenizer_path, ranks_path), lambda: Encoder(tokenizer_path, ranks_path))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each item, in the order given. ``lengths`` are from 1 to ``capacity``.

    Items are taken by falling length (ties in the order given) and put into the first bin that has room. The tree's
    leaves are the bins' free room and each inner node holds the largest below it, so a bin is found in log2(bins)
    steps.
    """
    size = 1 << max(0, (len(lengths) - 1).bit_length())
    tree = [capacity] * (2 * size)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need, node = lengths[i], 1
        while node < size:
            node *= 2
            if tree[node] < need:
                node += 1
        out[i] = (node - size, capacity - tree[node])
        tree[node] -= need
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return out


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, paths: tuple[str, str | None] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents as token pieces of at most ``capacity`` ids: full ones, then the rest. ``draw`` is a random 63-bit number.

    The draw depends on the partition and row a document is read from, so a recomputed task repeats it, and copies of
    a row are spread. ``with_ids`` adds the ids themselves.
    """
    paths = paths or default_paths()
    schema = PIECES + ", draw bigint" + (", ids array<int>" if with_ids else "")
    arrow = arrow_schema(schema)
    ship(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        encode, part, row = encoder(*paths).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: dict[str, list] = {f.name: [] for f in arrow}
                some = batch.slice(at, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = np.append(encode(text), np.array([END_ID], dtype="<u4"))
                    draw = xxhash.xxh64_intdigest(f"{part}:{row}") >> 1
                    row += 1
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        values = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), draw, *([piece.astype("i4")] if with_ids else []))
                        for column, value in zip(out.values(), values):
                            column.append(value)
                yield to_batch(out, arrow)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    *,
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
    paths: tuple[str, str | None] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences; a row per piece, with ``sequence_id`` and ``offset``.

    A document's ids (those of the tokenizer file, then END_ID) are cut into full pieces and a rest, and each
    randomised group of about ``group_docs`` documents is packed by itself, so that a task holds one group's lengths
    and never more: the number of groups follows the number of rows. Only lengths and checksums are shuffled, unless
    ``with_ids`` asks for the ids in the result.

    Null text counts as empty (one piece: END_ID), null ids stay null, repeated rows are packed each, and an empty
    table gives no row. Other columns of ``docs`` take no part. sequence_id is the group times 2**31 plus the bin.
    """
    groups = max(1, math.ceil(docs.count() / group_docs))
    made = pieces(docs, capacity=capacity, paths=paths, with_ids=with_ids)
    ids = ", ids array<int>" if with_ids else ""

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "start"], kind="stable")
        placed = first_fit_decreasing(group["length"].tolist(), capacity)
        group["sequence_id"] = (int(group["grp"].iloc[0]) << 31) + np.array([b for b, _ in placed], dtype=np.int64)
        group["offset"] = np.array([o for _, o in placed], dtype=np.int64)
        return group.drop(columns=["draw", "grp"])

    return (
        made.withColumn("grp", F.pmod(F.xxhash64("draw"), F.lit(groups)))
        .groupBy("grp")
        .applyInPandas(place, PIECES + ids + ", sequence_id bigint, offset bigint")
    )
