"""Near-duplicates: MinHash with tensored banding, verified on full shingle sets."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import arrow_schema, map_batches, materialise, one_blas_thread, ship, spread_join, to_batch
from panelforge.llm.components import connected_components

# The first 64 bits of the fractional parts of square roots, made odd, as multipliers of the shingle hash.
_MULTIPLIERS = np.array([0x6A09E667F3BCC909, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B, 0xA54FF53A5F1D36F1, 0x510E527FADE682D1], dtype=np.uint64)


@dataclass(frozen=True)
class Banding:
    """Two collections of ``rows`` band hashes with ``width`` minhashes each; every pair of bands, one from each, is a
    table: rows**2 tables for 2 * rows * width minhashes.

    A pair of similarity s meets in no table with probability at most 2 * (1 - s**width)**rows: 7e-5 at 0.85 and 3e-6
    at 0.9 with the defaults.
    """

    rows: int = 8
    width: int = 2
    seed: int = 20

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        n = 2 * self.rows * self.width
        return rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**64, n, dtype=np.uint64)

    def keys(self, shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The rows**2 table keys of a set of shingle hashes."""
        a, b = functions
        least = np.array([((shingles * x + y) >> np.uint64(16)).min() for x, y in zip(a, b)], dtype=np.uint64)
        bands = least.reshape(2, self.rows, self.width)
        mixed = np.zeros((2, self.rows), dtype=np.uint64)
        for k in range(self.width):
            mixed = _mix(mixed * _MULTIPLIERS[1] + bands[:, :, k])
        table = np.arange(self.rows * self.rows, dtype=np.uint64).reshape(self.rows, self.rows)
        return _mix(mixed[0][:, None] * _MULTIPLIERS[2] + _mix(mixed[1] + _MULTIPLIERS[3])[None, :] + table).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLIERS[0]
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Distinct hashes of a text's word shingles. Words: maximal runs without ASCII white space, A-Z lower-cased."""

    def __init__(self, words: int = 5, remembered: int = 400_000):
        self.words, self.remembered, self.cache = words, remembered, {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint64)
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        cache = self.cache
        if len(cache) > self.remembered:
            cache.clear()
        try:
            ids = np.array([cache[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh3_64_intdigest(w)
            ids = np.array([cache[w] for w in words], dtype=np.uint64)
        n = len(ids) - self.words + 1
        if n < 1:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
        made = np.zeros(n, dtype=np.uint64)
        for k in range(self.words):
            made = _mix(made * _MULTIPLIERS[4] + ids[k : k + n])
        return np.unique(made)


def signatures(docs: DataFrame, *, shingle_words: int = 5, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, n_shingles, digest, keys) of each row of (doc_id, text); digest: 128 bits of the whole set."""
    shingler, functions = Shingler(shingle_words), banding.functions()

    def work(columns: dict) -> dict:
        n, digests, keys = [], [], []
        for text in columns["text"]:
            made = shingler(text)
            n.append(len(made))
            digests.append(xxhash.xxh3_128_digest(made.tobytes()) if len(made) else None)
            keys.append(banding.keys(made, functions).view(np.int64) if len(made) else None)
        return {"doc_id": columns["doc_id"], "n_shingles": n, "digest": digests, "keys": keys}

    return map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>")


#: A group within these bounds is compared all with all by one task; of larger ones a task gets two such blocks.
BLOCK_SETS = 256
BLOCK_SHINGLES = 600_000


def linked(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i > j with 100 * intersection >= percent * union, by exact counting.

    Shingles of one set only can't add to an intersection and are left out. Rare ones add to the pairs that hold
    them; for frequent ones the counts are products of 0/1 matrices, some columns at a time.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if len(sets) < 5:
        found = [(i, j, len(np.intersect1d(sets[i], sets[j], assume_unique=True))) for i in range(len(sets)) for j in range(i)]
        good = [(i, j) for i, j, both in found if 100 * both >= percent * (sizes[i] + sizes[j] - both)]
        return np.array([i for i, _ in good], dtype=np.int64), np.array([j for _, j in good], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    starts = np.concatenate([[0], np.cumsum(times)])
    by_column = owner[order]
    for n in range(2, 9):
        some = np.flatnonzero(times == n)
        if len(some):
            members = by_column[starts[some][:, None] + np.arange(n)]
            for p in range(n):
                for q in range(p):
                    np.add.at(shared.ravel(), members[:, p] * len(sets) + members[:, q], 1)
    often = np.flatnonzero(times > 8)
    for at in range(0, len(often), 2048):
        some = often[at : at + 2048]
        dense = np.zeros((len(sets), len(some)), dtype=np.float32)
        for k, c in enumerate(some):
            dense[by_column[starts[c] : starts[c + 1]], k] = 1
        shared += np.tril(dense @ dense.T, -1)
    i, j = np.nonzero(shared)
    both = shared[i, j].astype(np.int64)
    keep = 100 * both >= percent * (sizes[i] + sizes[j] - both)
    return i[keep], j[keep]


def forest(n: int, pairs: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs: (node, smallest node of its tree)."""
    label = np.arange(n)
    i, j = pairs
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return [(k, int(x)) for k, x in enumerate(label) if x != k]
        label = least


#: Members of a large group that all of it are compared with, before what is left is compared in blocks (bits of a byte).
PIVOTS = 8

#: Members of a large group, on average, that tell which shingles are frequent in it and which members are good pivots.
SAMPLE = 64


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, banding: Banding = Banding(), block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text).

    1. Each text becomes a set of shingle hashes and its table keys; equal sets become one class (smallest doc_id).
    2. Within a table's bucket every class is tied to the bucket's smallest class, its leader: one row per class and
       leader, not per pair. Two classes that meet in any bucket share that bucket's leader.
    3. The sets of a leader's classes are compared exactly, all with all, if they fit into one block. In a larger group
       all are first compared, in one pass, with a few pivots: the leader and those of a sample that link most of it (work
       that grows with the group, not with its square). Pairs within a component need no comparison any more. The
       classes outside of the largest meet only those of the group that share one of their rarest shingles
       (``prefix``), before so few others that they can still be linked: pages of one template, whose own words are
       their rarest, share none, or too late. Each such meeting is tied to its smallest class and compared like a
       bucket, block by block where it is large.
    4. Components are joined over these links and brought back to the documents, whose joins deal out large classes.

    Null, empty and blank texts: no shingles, linked with nothing. Whole texts are compared, however long. Rows with one
    doc_id are one document, so what they link to is joined. A null doc_id takes no part: component null, kept. Ties go
    to the smallest doc_id. Other columns take no part. An empty table gives no row. Whether rows are linked is exact but
    for candidates: see ``Banding`` for the chance to miss one.
    """
    signed = materialise(signatures(docs, shingle_words=shingle_words, banding=banding), "signatures")
    known = signed.where("doc_id is not null and digest is not null")
    reps = known.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "keys")).alias("r")).select("r.*")
    tables = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    leaders = tables.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader <> last")
    ties = materialise(tables.join(leaders, "key").groupBy("leader", "doc_id").agg(F.max("n").alias("n")), "ties")
    sets = materialise(_shingle_sets(docs, ties.select("doc_id").distinct(), shingle_words), "sets")

    sizes = ties.groupBy("leader").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = _blocks(F.col("sets"), F.col("shingles"), block_sets, block_shingles)
    groups = materialise(sizes.select("leader", "sets", blocks.alias("blocks")).where("blocks > 1"), "groups")
    some = not groups.isEmpty()
    single = (ties.join(groups, "leader", "left_anti") if some else ties).select("leader", "doc_id", F.lit(0).alias("low"), F.lit(0).alias("high"))
    links = materialise(_verified(_with_sets(single, sets, ["leader", "low", "high"]), percent), "links")
    if some:
        large = materialise(ties.join(groups, "leader"), "large")
        links = links.unionByName(_large_links(large, sets, percent, block_sets, block_shingles))

    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    several = known.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y")
    same = known.join(several, "doc_id", "left_semi").join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    components = connected_components(links.unionByName(same))
    where = classes.join(components, classes.rep == components.node, "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    joined = spread_join(signed.select("doc_id", "n_shingles", "digest"), where, ["digest"], ["doc_id"]).withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return joined.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _blocks(sets, shingles, block_sets: int, block_shingles: int):
    return F.greatest(F.ceil(sets / block_sets), F.ceil(shingles / block_shingles)).cast("int")


def _large_links(large: DataFrame, sets: DataFrame, percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Links (a, b) that join all linked pairs of each group of ``large`` (leader, doc_id, n, sets, blocks), as in
    ``near_duplicates``.

    Here and in ``_rest``, tables are written before others are joined with them, so that Spark knows their size: it
    broadcasts small ones (all sets need no shuffle for a few), and can split the rows of a large key in other joins."""
    large = materialise(large.join(sets, "doc_id"), "large-sets")
    heads = materialise(_heads(large, percent, block_shingles), "heads")
    marked = materialise(_marked(large, heads, percent), "marked")
    links = heads.select(F.explode(F.arrays_zip("a", "b")).alias("l")).select("l.a", "l.b")
    links = links.unionByName(marked.select(F.col("doc_id").alias("a"), F.explode("pivots").alias("b")).where("a <> b"))
    main = materialise(marked.groupBy("leader", "mask").count().groupBy("leader").applyInPandas(_largest, "leader bigint, main int, outer long"), "main")
    open_groups = main.where("outer > 0")
    if open_groups.isEmpty():
        return links
    outside = marked.join(open_groups, "leader").withColumn("c", F.when(F.col("mask").bitwiseAND(F.col("main")) != 0, F.col("main")).otherwise(0))
    return links.unionByName(_rest(outside, sets, percent, block_sets, block_shingles))


def _largest(rows):
    """(leader, main, outer) of the (leader, mask, count) of one group: the labels of its largest component, as bits, and how
    many are outside of it. A mask has the labels that a class is linked with, and so joins them."""
    parts: list[int] = []
    masks = [(int(m), int(n)) for m, n in zip(rows["mask"], rows["count"])]
    for mask, _ in masks:
        if mask:
            parts = [p for p in parts if not p & mask] + [functools.reduce(operator.or_, (p for p in parts if p & mask), mask)]
    most, main = max((sum(n for m, n in masks if m & p), p) for p in parts)
    return pd.DataFrame({"leader": rows["leader"].iloc[:1], "main": [main], "outer": [sum(n for _, n in masks) - most]})


def pivots(sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """At most PIVOTS of ``sets``, the first one and then always that which links most that none is linked with so far; their
    labels (the place of the first of a component among them); links that join the components of all sets."""
    pairs = linked(sets, percent)
    joined = forest(len(sets), pairs)
    near = np.eye(len(sets), dtype=bool)
    near[pairs[0], pairs[1]] = near[pairs[1], pairs[0]] = True
    chosen, covered = [0], near[0].copy()
    while len(chosen) < PIVOTS and not covered.all():
        chosen.append(int(near[:, ~covered].sum(axis=1).argmax()))
        covered |= near[chosen[-1]]
    root = dict(joined)
    roots = [root.get(k, k) for k in chosen]
    return chosen, [roots.index(r) for r in roots], joined


def _heads(large: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """A row for each group of ``large`` with what its members need: the shingles that a sample has more than once and how
    often, and its pivots: ids, labels and sizes, the union of their sets, for each of it the pivots that have it as
    bits of a byte, and links (a, b) of the sample.

    The sample: about SAMPLE members by a hash of their ids, and the leader. Pivots are taken from as many as hold
    ``block_shingles``, the leader first."""
    drawn = large.where((F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("sets") / SAMPLE)) == 0) | (F.col("doc_id") == F.col("leader")))
    schema = "leader bigint, blocks int, common binary, ranks binary, pivots array<bigint>, labels array<int>, sizes array<bigint>, values binary, bits binary, a array<bigint>, b array<bigint>"
    arrow = arrow_schema(schema)

    def close(leader, blocks, ids: list, held: list) -> dict:
        if not held:
            return {f.name: [] for f in arrow}
        shingles, times = np.unique(np.concatenate(held), return_counts=True)
        often = times > 1
        first = max(1, int(np.searchsorted(np.cumsum([len(s) for s in held]), block_shingles, "right")))
        chosen, labels, joined = pivots(held[:first], percent)
        values, at = np.unique(np.concatenate([held[k] for k in chosen]), return_inverse=True)
        bits = np.zeros(len(values), dtype=np.uint8)
        np.bitwise_or.at(bits, at, np.repeat(np.uint8(1) << np.arange(len(chosen), dtype=np.uint8), [len(held[k]) for k in chosen]))
        made = {"leader": leader, "blocks": blocks, "common": shingles[often].astype("<u8").tobytes(), "ranks": times[often].astype("<i8").tobytes()}
        made |= {"pivots": [ids[k] for k in chosen], "labels": labels, "sizes": [len(held[k]) for k in chosen], "values": values.astype("<u8").tobytes(), "bits": bits.tobytes()}
        made |= {"a": [ids[k] for k, _ in joined], "b": [ids[x] for _, x in joined]}
        return {k: [v] for k, v in made.items()}

    def run(batches):
        one_blas_thread()
        group, ids, held = (None, None), [], []
        for batch in batches:
            for leader, blocks, doc_id, mine in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("leader", "blocks", "doc_id", "shingles"))):
                if leader != group[0]:
                    yield to_batch(close(*group, ids, held), arrow)
                    group, ids, held = (leader, blocks), [], []
                ids.append(doc_id)
                held.append(np.frombuffer(mine, dtype="<u8"))
        yield to_batch(close(*group, ids, held), arrow)

    return drawn.select("leader", "blocks", "doc_id", "shingles").repartition("leader").sortWithinPartitions("leader", "doc_id").mapInArrow(run, schema)


def _marked(large: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """(leader, doc_id, n, size, mask, pivots, keys) of each set of ``large``: its size, the labels of the pivots that it is
    linked with, as bits, such a pivot for each label, and its rarest shingles (``prefix``).

    A group is dealt out in parts, each of which gets the group's row of ``heads``; so all members use one order, and no
    link is missed, whatever was drawn."""
    held = [f.name for f in heads.schema if f.name not in ("leader", "blocks", "a", "b")]
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in heads.schema if f.name in held]
    leading = heads.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(0).alias("role"), *[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "bigint"), ("n", "bigint"), ("shingles", "binary"))], *held)
    rows = large.select("leader", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("part"), F.lit(1).alias("role"), "doc_id", "n", "shingles", *nothing)
    grouped = leading.unionByName(rows).repartition("leader", "part").sortWithinPartitions("leader", "part", "role", "doc_id")
    schema = "leader bigint, doc_id bigint, n bigint, size bigint, mask int, pivots array<bigint>, keys array<bigint>"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in arrow}
            names = ("leader", "role", "doc_id", "n", "shingles", *held)
            for leader, role, doc_id, n, shingles, *more in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in names)):
                if role == 0:
                    head = dict(zip(held, more))
                    common, values = (np.frombuffer(head[c], dtype="<u8") for c in ("common", "values"))
                    ranks, bits = np.frombuffer(head["ranks"], dtype="<i8"), np.frombuffer(head["bits"], dtype=np.uint8)
                    sizes = np.array(head["sizes"], dtype=np.int64)
                    continue
                mine = np.frombuffer(shingles, dtype="<u8")
                at = np.searchsorted(values, mine)
                at[at == len(values)] = 0
                both = np.unpackbits(bits[at[values[at] == mine]][:, None], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)[: len(sizes)]
                near = np.flatnonzero(100 * both >= percent * (len(mine) + sizes - both)).tolist()
                linked_with = {head["labels"][k]: head["pivots"][k] for k in near}
                row = {"leader": leader, "doc_id": doc_id, "n": n, "size": len(mine), "mask": sum(1 << k for k in linked_with), "pivots": list(linked_with.values())}
                for name, value in (row | {"keys": prefix(mine, common, ranks, percent).view(np.int64)}).items():
                    out[name].append(value)
            yield to_batch(out, arrow)

    return grouped.mapInArrow(run, schema)


def _rest(outside: DataFrame, sets: DataFrame, percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Links of the classes outside of their group's main component with all of the group that can be linked to them.
    ``outside``: (leader, doc_id, n, size, keys, c, main)."""
    mine = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = outside.select("leader", "doc_id", "n", "size", (F.col("c") != F.col("main")).alias("outer"), F.posexplode("keys").alias("at", "key"))
    ends = (F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max("outer").alias("any"))
    together = keys.groupBy("leader", "key").agg(F.min("size").alias("least"), *ends).where("first <> last and any").select("leader", "key", "least")
    # two sets whose first shared shingle is this one share none before it, and a linked one has at least so many of them
    other = F.greatest(F.col("least"), F.ceil(F.col("size") * percent / 100))
    enough = F.col("size") - F.col("at") >= F.ceil((F.col("size") + other) * percent / (100 + percent))
    keys = materialise(keys.join(materialise(together, "together"), ["leader", "key"]).where(enough).drop("least"), "meeting")
    meetings = keys.groupBy("leader", "key").agg(*ends).where("first <> last and any").select("leader", "key", "first")
    met = keys.join(materialise(meetings, "meetings"), ["leader", "key"])
    met = met.groupBy(F.xxhash64("leader", "first").alias("leader"), "doc_id").agg(F.max("n").alias("n"), F.max("outer").alias("outer"))
    met = materialise(met, "met")
    sizes = met.groupBy("leader").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"), F.count_if("outer").alias("outer_sets"), F.sum(F.when(F.col("outer"), F.col("n")).otherwise(0)).alias("outer_shingles")
    )
    sizes = sizes.where("outer_sets > 0").select(
        "leader",
        _blocks(F.col("outer_sets"), F.col("outer_shingles"), block_sets, block_shingles).alias("lows"),
        _blocks(F.col("sets"), F.col("shingles"), block_sets, block_shingles).alias("highs"),
    )
    placed = met.join(materialise(sizes, "sizes"), "leader")
    low = placed.where("outer").select("leader", "doc_id", mine("lows").alias("low"), every("highs").alias("high"), F.lit(None).cast("int").alias("own"))
    high = placed.select("leader", "doc_id", every("lows").alias("low"), mine("highs").alias("high"), F.when(F.col("outer"), mine("lows")).alias("own"))
    dealt = low.unionByName(high).where("own is null or own <> low").drop("own")
    dealt = materialise(dealt, "dealt")
    return materialise(_verified(_with_sets(dealt, sets, ["leader", "low", "high"]), percent), "links")


def prefix(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, one more than two linked sets can have without the other: if both sets take theirs in
    one order, linked ones share one. The order: by rank (0 for shingles that are not in ``common``, which is
    sorted), then by value."""
    n = len(shingles)
    at = np.searchsorted(common, shingles)
    at[at == len(common)] = 0
    rank = np.where(common[at] == shingles, ranks[at], 0) if len(common) else np.zeros(n, dtype=np.int64)
    keep = n - -(-n * percent // 100) + 1
    return shingles[np.lexsort((shingles, rank))[:keep]]


def _shingle_sets(docs: DataFrame, ids: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, shingles) of the documents named in ``ids``: sorted distinct hashes as bytes, a row for each distinct set
    of a doc_id."""
    arrow = arrow_schema("doc_id bigint, shingles binary")
    ship(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    # always a sorted, shuffled join: whether the ids are few enough to broadcast must not change how the cost grows
    wanted = texts.join(ids.hint("merge"), "doc_id", "left_semi").sortWithinPartitions("doc_id")

    def run(batches):
        shingler, last, seen = Shingler(shingle_words), None, set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), {"doc_id": [], "shingles": []}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if doc_id != last:
                        last, seen = doc_id, set()
                    made = shingler(text).astype("<u8").tobytes()
                    mark = xxhash.xxh3_128_digest(made)
                    if made and mark not in seen:
                        seen.add(mark)
                        out["doc_id"].append(doc_id)
                        out["shingles"].append(made)
                yield to_batch(out, arrow)

    return wanted.mapInArrow(run, "doc_id bigint, shingles binary")


def _with_sets(dealt: DataFrame, sets: DataFrame, group: list[str], order: tuple | list = ()) -> DataFrame:
    """The rows of ``dealt`` with their sets, each group's in one run."""
    return dealt.join(sets, "doc_id").repartition(*group).sortWithinPartitions(*group, *order, "doc_id")


def _verified(grouped: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of the links within each run of rows with one (leader, low, high)."""
    arrow = arrow_schema("a bigint, b bigint")

    def run(batches):
        one_blas_thread()
        group, ids, sets = None, [], []

        def close() -> dict:
            if len(ids) < 2:
                return {"a": [], "b": []}
            found = forest(len(ids), linked(sets, percent))
            return {"a": [ids[k] for k, _ in found], "b": [ids[x] for _, x in found]}

        for batch in batches:
            columns = [batch.column(batch.schema.names.index(c)).to_pylist() for c in ("leader", "low", "high", "doc_id", "shingles")]
            for leader, low, high, doc_id, shingles in zip(*columns):
                if (leader, low, high) != group:
                    yield to_batch(close(), arrow)
                    group, ids, sets = (leader, low, high), [], []
                ids.append(doc_id)
                sets.append(np.frombuffer(shingles, dtype="<u8"))
        yield to_batch(close(), arrow)

    return grouped.select("leader", "low", "high", "doc_id", "shingles").mapInArrow(run, "a bigint, b bigint")
