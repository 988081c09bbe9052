"""LM scoring: a log-bilinear model trained in numpy with noise-contrastive estimation, over exact corpus counts."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import BATCH_ROWS, arrow_schema, crc_of_id, drop_table, give_back, materialise, one_blas_thread, ship, to_batch

#: The end token; words never hold white space.
END = b"\n"
#: Classes of tokens, at most: the unknown word, the end, and the most frequent words with vectors of their own.
CLASSES = 65_536
#: The class of rank k is one of about 1 + k / SPREAD in its group: groups of like weight, the first of one class each.
SPREAD = 32
#: Components of a vector.
SIZE = 16
#: Words whose counts are sent to every task: the most frequent ones, this many at most. Others are joined.
FREQUENT = 200_000
#: Tokens of a shard of the training documents, about: what one task learns from before models are averaged.
SHARD = 1 << 21
#: Tokens of a document that stay together; longer ones are dealt to shards in pieces.
PIECE = 1 << 16
#: Tokens that a task holds and shuffles before it learns from them.
HELD = 1 << 18
#: Tokens of a batch that meet its shared draws at once.
SHARE = 512
#: Tokens scored at once: they share the exponentials of their contexts' words.
SCORED = 1 << 18
#: Scores of a matrix product that stay in the processor's cache.
CACHED = 1 << 18
#: Exponentials are multiplied for parts of scores below MOST and sums above LEAST; else whole scores are taken.
MOST, LEAST = 30.0, 1e-15
#: Classes in one row of a task's model, and models that are averaged by one task.
BLOCK, FAN = 2048, 32


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, without the end token."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def split_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all ``texts``, as ``tokens_of`` gives them, one after the other, and the number of each text."""
    clean = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    lists = pc.ascii_split_whitespace(clean)
    n = np.array(pc.list_value_length(lists), dtype=np.int64)
    n[np.array(pc.binary_length(clean)) == 0] = 0
    tokens = lists.flatten()
    return tokens.filter(pc.greater(pc.binary_length(tokens), 0)).cast(pa.binary()), n


def _places(tokens: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each token stands in ``known``; the length of ``known``, if nowhere."""
    return np.array(pc.index_in(tokens, value_set=known).fill_null(len(known)), dtype=np.int64)


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all of ``docs``: counted within Arrow batches, then summed."""
    schema = "token binary, c bigint"
    arrow = arrow_schema(schema)
    ship(docs.sparkSession)

    def run(batches):
        ends = 0
        for batch in batches:
            ends += batch.num_rows
            counted = pc.value_counts(split_tokens(batch.column(0))[0])
            yield to_batch({"token": counted.field("values"), "c": counted.field("counts")}, arrow)
        if ends:
            yield to_batch({"token": [END], "c": [ends]}, arrow)

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


def group_starts(classes: int, spread: int = SPREAD) -> np.ndarray:
    """The first class of each group, then the number of classes."""
    starts = [0]
    while starts[-1] < classes:
        starts.append(min(classes, starts[-1] + 1 + starts[-1] // spread))
    return np.array(starts, dtype=np.int64)


@dataclass
class LogBilinear:
    """p(w | u, v) = p(group of w | u, v) p(w | its group, u, v) over classes, for a context of two words.

    With q = C1 r_u + C2 r_v both are softmaxes of log-bilinear scores: g_k . q + a_k over all groups, and
    t_w . q + b_w over the classes of the group. Class 0 is the unknown word, 1 the end, the others are words by falling
    frequency; ``classes`` is the context that stands before a text's first token.
    """

    r: np.ndarray
    t: np.ndarray
    b: np.ndarray
    g: np.ndarray
    a: np.ndarray
    c1: np.ndarray
    c2: np.ndarray

    def __post_init__(self) -> None:
        self.starts = group_starts(len(self.t))
        self.group_of = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def copy(self) -> LogBilinear:
        return LogBilinear(*[x.copy() for x in (self.r, self.t, self.b, self.g, self.a, self.c1, self.c2)])

    def log_p(self, w: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The natural log-probability of each class ``w`` after ``u`` (the last class) and ``v`` (the last but one)."""
        near, far, groups, own = self._ready()
        q = near.take(u, axis=0)  # with the other half, its last component is one and meets the biases
        q += far.take(v, axis=0)
        group = self.group_of[w]
        out = self._log_p_groups(q, group, u, v)
        order, ranked = sorted_places(group)
        bounds = np.searchsorted(ranked, np.arange(len(self.starts)))
        q, w = q.take(order, axis=0), w[order]
        inner = np.zeros(len(w))
        for k in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(self.starts) > 1)):
            first, last = self.starts[k], self.starts[k + 1]
            rows = max(1, CACHED // (last - first))
            for i in range(bounds[k], bounds[k + 1], rows):
                some = slice(i, min(i + rows, bounds[k + 1]))
                inner[some] = _picked(q[some] @ own[:, first:last], w[some] - first)
        out[order] += inner
        return out

    def _log_p_groups(self, q: np.ndarray, group: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The log-probability of each token's group. A score is a part by ``u`` and a part by ``v``, so the exponentials of
        all scores are products of those of the distinct ``u`` and ``v``, which are taken once each."""
        near, far, groups, _ = self._ready()
        direct = lambda at: np.concatenate([_picked(q[at[i : i + 2048]] @ groups, group[at[i : i + 2048]]) for i in range(0, len(at), 2048)])
        (us, ui), (vs, vi) = np.unique(u, return_inverse=True), np.unique(v, return_inverse=True)
        if len(us) + len(vs) > len(u) // 2:
            return direct(np.arange(len(u)))
        parts = []
        for table, at in ((near, us), (far, vs)):
            parts.append(np.empty((len(at), groups.shape[1]), "f4"))
            for i in range(0, len(at), 1024):
                scores = np.matmul(table[at[i : i + 1024]], groups, out=parts[-1][i : i + 1024])
                if not scores.max() < MOST:
                    return direct(np.arange(len(u)))
                np.exp(scores, out=scores)
        z = np.concatenate([np.einsum("ij,ij->i", parts[0].take(ui[i : i + 512], axis=0), parts[1].take(vi[i : i + 512], axis=0)) for i in range(0, len(u), 512)])
        out = np.einsum("ij,ij->i", q, np.ascontiguousarray(groups.T).take(group, axis=0)).astype("f8") - np.log(np.maximum(z, LEAST))
        small = np.flatnonzero(z <= LEAST)  # products may have vanished
        if len(small):
            out[small] = direct(small)
        return out

    def _ready(self) -> tuple[np.ndarray, ...]:
        """The factors of all scores, made once for a model that no longer changes."""
        if not hasattr(self, "_factors"):
            one = np.ones((len(self.r), 1), "f4")
            near, far = np.hstack([self.r @ self.c1, one]), np.hstack([self.r @ self.c2, 0 * one])
            groups, own = np.vstack([self.g.T, self.a]), np.vstack([self.t.T, self.b])
            self._factors = near, far, np.ascontiguousarray(groups), np.ascontiguousarray(own)
        return self._factors

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a model with one class in each group: scores by the last and the last but one class, and the log of the
        normaliser of every context."""
        near, far = (self.r @ self.c1) @ self.g.T + self.a, (self.r @ self.c2) @ self.g.T
        both = near[:, None, :] + far[None, :, :]
        top = both.max(axis=2)
        return near, far, np.log(np.exp(both - top[:, :, None]).sum(axis=2)) + top


def _picked(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log of the softmax of each row at one place; ``scores`` is overwritten."""
    rows = np.arange(len(at))
    chosen, top = scores[rows, at].astype("f8"), scores.max()
    if top > 60 or scores[:, 0].min() < -60:  # too far apart for plain exponentials
        tops = scores.max(axis=1, keepdims=True)
        scores -= tops
        chosen -= tops[:, 0]
    np.exp(scores, out=scores)
    return chosen - np.log(scores @ np.ones(scores.shape[1], "f4"))


def sorted_places(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of ``at`` (not negative), and ``at`` in it: one sort of plain numbers, several times as fast as argsort."""
    bits = len(at).bit_length()
    keys = at.astype(np.int64) << bits
    keys |= np.arange(len(at))
    keys.sort()
    return keys & ((1 << bits) - 1), keys >> bits


def _runs(places: np.ndarray) -> np.ndarray:
    """Where the runs of equal places begin."""
    return np.flatnonzero(np.append(True, places[1:] != places[:-1]))


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of runs of rows. Pairs of components are added as one complex number, which halves numpy's work."""
    if rows.ndim == 2 and rows.shape[1] % 2 == 0 and rows.dtype == np.float32:
        return np.add.reduceat(np.ascontiguousarray(rows).view("c8"), first, axis=0).view("f4")
    return np.add.reduceat(rows, first, axis=0)


def add_rows(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places, rising, with the sums of their rows."""
    order, places = sorted_places(at)
    first = _runs(places)
    return places[first], _sums(rows.take(order, axis=0), first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Noise-contrastive estimation with AdaGrad: tell a token's group from ``noise`` draws of the groups' unigram
    distribution (shared by a batch), and the token from ``noise`` draws within its group (shared by the group).
    ``seen``: AdaGrad's sums, of rows for r, t and b, where training goes on."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, rng: np.random.Generator, *, seen: dict[str, np.ndarray] | None = None, noise: int = 15, batch: int = 8192, shared: int = 128, inner: int = 4, rate: float = 0.1) -> None:
        self.m, self.rng, self.noise, self.batch, self.shared, self.inner, self.rate = model, rng, noise, batch, shared, inner, rate
        starts = model.starts
        self.upto = np.append(0.0, np.cumsum(unigram))
        mass = np.diff(self.upto[starts])
        self.log_group, self.group_upto = np.log(mass).astype("f4"), np.cumsum(mass)
        self.log_inner = (np.log(unigram) - np.log(mass)[model.group_of]).astype("f4")
        self.several = np.diff(starts) > 1
        self.seen = nothing_seen(model) if seen is None else {k: x.copy() for k, x in seen.items()}
        self.counts = np.zeros(len(model.r), "f8")

    def _move(self, name: str, g: np.ndarray) -> None:
        self.seen[name] += g * g
        setattr(self.m, name, getattr(self.m, name) - self.rate * g / np.sqrt(self.seen[name]))

    def _move_rows(self, name: str, at: np.ndarray, g: np.ndarray) -> None:
        """One step size for each row, from the mean square of its gradient."""
        seen = self.seen[name]
        now = seen[at] + (g * g if g.ndim == 1 else np.einsum("ij,ij->i", g, g) / np.float32(g.shape[1]))
        seen[at] = now
        step = self.rate / np.sqrt(now)
        moved = getattr(self.m, name)
        moved[at] = moved.take(at, axis=0) - (step * g if g.ndim == 1 else step[:, None] * g)

    def learn(self, sequences: list[np.ndarray]) -> None:
        """One pass over ``sequences``, in random order."""
        classes = len(self.m.t)
        w, u, v = (np.concatenate(x) for x in zip(*((s, np.append(classes, s[:-1]), np.concatenate([[classes, classes], s[:-2]])[: len(s)]) for s in sequences)))
        self.counts += np.bincount(w, minlength=classes + 1)
        self.counts[classes] += len(sequences)
        for some in np.array_split(self.rng.permutation(len(w)), max(1, len(w) // self.batch)):
            order, rising = sorted_places(w[some])
            some = some[order]
            self._step(rising, u[some], v[some])

    def _step(self, w: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
        """``w`` rises, so classes and groups are runs."""
        m, n, noise = self.m, len(w), self.noise
        log_noise = np.float32(np.log(noise))
        ru, rv = m.r.take(u, axis=0), m.r.take(v, axis=0)
        q = ru @ m.c1 + rv @ m.c2
        gq = np.empty_like(q)
        one = np.hstack([q, np.ones((n, 1), "f4")])  # meets the biases

        # groups drawn for the whole batch, SHARE rows at a time, which stay in the processor's cache
        fake = np.minimum(np.searchsorted(self.group_upto, self.rng.random(self.shared)), len(m.g) - 1)
        against = -np.vstack([m.g[fake].T, m.a[fake] - self.log_group[fake] - log_noise])
        fake_sums = np.zeros((len(fake), one.shape[1]), "f4")
        with np.errstate(over="ignore"):  # an infinite exponential stands for a probability of zero
            for i in range(0, n, SHARE):
                other = one[i : i + SHARE] @ against
                np.exp(other, out=other)
                other += 1
                np.divide(np.float32(noise / len(fake)), other, out=other)
                gq[i : i + SHARE] = other @ m.g[fake]
                fake_sums += other.T @ one[i : i + SHARE]

        # for each run of a group: the words drawn within it, and last the group itself
        group = m.group_of[w]
        first = _runs(group)
        edges = np.append(first, n)
        runs = group[first]
        low, high = self.upto[m.starts[runs]], self.upto[m.starts[runs + 1]]
        drawn = np.searchsorted(self.upto, low[:, None] + (high - low)[:, None] * self.rng.random((len(runs), self.inner)), side="right") - 1
        drawn = np.clip(drawn, m.starts[runs][:, None], m.starts[runs + 1][:, None] - 1)
        sides = np.concatenate([m.t[drawn], m.g[runs][:, None]], axis=1)
        biases = np.hstack([m.b[drawn] - self.log_inner[drawn], (m.a - self.log_group)[runs][:, None]]) - log_noise
        tall = np.concatenate([sides, biases[:, :, None]], axis=2).transpose(0, 2, 1)
        push = np.empty((n, self.inner + 1), "f4")
        bounds = list(zip(range(len(runs)), edges[:-1].tolist(), edges[1:].tolist()))
        for k, i, j in bounds:
            np.matmul(one[i:j], tall[k], out=push[i:j])
        push = _sigmoid(push)
        several = self.several[group].astype("f4")
        push[:, :-1] *= (several * np.float32(noise / self.inner))[:, None]
        push[:, -1] -= 1
        run_sums = np.empty((len(runs), self.inner + 1, one.shape[1]), "f4")
        for k, i, j in bounds:
            gq[i:j] += push[i:j] @ sides[k]
            np.matmul(push[i:j].T, one[i:j], out=run_sums[k])
        run_sums, run_biases = run_sums[:, :, :-1], run_sums[:, :, -1]
        gg, ga = np.zeros_like(m.g), np.zeros_like(m.a)
        gg[runs], ga[runs] = run_sums[:, -1], run_biases[:, -1]
        np.add.at(gg, fake, fake_sums[:, :-1])
        np.add.at(ga, fake, fake_sums[:, -1])

        word = m.t.take(w, axis=0)
        mine = (_sigmoid(np.einsum("ij,ij->i", q, word) + m.b[w] - self.log_inner[w] - log_noise) - 1) * several
        word *= mine[:, None]
        gq += word
        own = _runs(w)
        words = np.append(w[own], drawn.ravel())
        at, sums = add_rows(words, np.concatenate([_sums(mine[:, None] * q, own), run_sums[:, :-1].reshape(-1, q.shape[1])]))
        _, biases = add_rows(words, np.append(np.add.reduceat(mine, own), run_biases[:, :-1].ravel()))

        places, context = add_rows(np.append(u, v), np.concatenate([gq @ m.c1.T, gq @ m.c2.T]))
        dense = np.float32(50 / n)  # AdaGrad's step does not depend on the scale once it exceeds its start
        g1, g2 = ru.T @ gq, rv.T @ gq
        self._move_rows("t", at, sums)
        self._move_rows("b", at, biases)
        self._move_rows("r", places, context)
        for name, g in (("g", gg), ("a", ga), ("c1", g1), ("c2", g2)):
            self._move(name, g * dense)


def nothing_seen(model: LogBilinear) -> dict[str, np.ndarray]:
    """AdaGrad's sums before the first step."""
    return {k: np.full(len(getattr(model, k)), 1e-2, "f4") for k in ROWWISE} | {k: np.full_like(getattr(model, k), 1e-2) for k in DENSE}


#: A model's parts: rows of classes, and the rest.
ROWWISE, DENSE = ("r", "t", "b"), ("g", "a", "c1", "c2")


def start(unigram: np.ndarray, *, size: int = SIZE, seed: int = 3) -> LogBilinear:
    """Scores of the unigram distribution, and small random vectors."""
    rng, classes = np.random.default_rng(seed), len(unigram)
    starts = group_starts(classes)
    mass = np.add.reduceat(unigram, starts[:-1])
    draw = lambda *s: (rng.standard_normal(s) * 0.1).astype("f4")
    inner = np.log(unigram) - np.repeat(np.log(mass), np.diff(starts))
    return LogBilinear(draw(classes + 1, size), draw(classes, size), inner.astype("f4"), draw(len(mass), size), np.log(mass).astype("f4"), np.eye(size, dtype="f4"), np.eye(size, dtype="f4") * 0.5)


def fit(sequences: list[np.ndarray], classes: int, unigram: np.ndarray, *, size: int = SIZE, epochs: int = 2, seed: int = 3) -> LogBilinear:
    """The model of sequences of classes in memory."""
    assert len(unigram) == classes
    trainer = Trainer(start(unigram, size=size, seed=seed), unigram, np.random.default_rng(seed))
    for _ in range(epochs if sequences else 0):
        trainer.learn(sequences)
    return trainer.m


def _blocks(common: LogBilinear, seen: dict[str, np.ndarray], trainer: Trainer):
    """(block, weights, change) of a task's model and of the logs of its AdaGrad sums: rows of classes weigh as often as
    they were seen, the rest as all tokens."""
    m, n = trainer.m, len(common.r)
    logs = {k: np.log(trainer.seen[k] / seen[k]) for k in seen}
    padded = lambda x: np.append(x, np.zeros(n - len(x), x.dtype)) if x.ndim == 1 else np.vstack([x, np.zeros((n - len(x), x.shape[1]), x.dtype)])
    change = np.hstack([m.r - common.r, padded(m.t - common.t), *[padded(x)[:, None] for x in (m.b - common.b, *(logs[k] for k in ROWWISE))]])
    for k, at in enumerate(range(0, n, BLOCK)):
        yield k, trainer.counts[at : at + BLOCK], change[at : at + BLOCK]
    rest = np.concatenate([x.ravel() for x in (*(getattr(m, k) - getattr(common, k) for k in DENSE), *(logs[k] for k in DENSE))])
    yield -1, np.array([trainer.counts.sum()]), rest[None, :]


def _apply(common: LogBilinear, seen: dict[str, np.ndarray], block: int, c: np.ndarray) -> None:
    """Add a block's averaged change."""
    classes, size = common.t.shape
    if block < 0:
        parts = [getattr(common, k) for k in DENSE]
        edges = np.cumsum([0] + [x.size for x in parts] * 2)
        for x, a, b in zip(parts, edges, edges[1:]):
            x += c[0, a:b].reshape(x.shape)
        for k, a, b in zip(DENSE, edges[len(parts) :], edges[len(parts) + 1 :]):
            seen[k] *= np.exp(c[0, a:b]).reshape(seen[k].shape)
        return
    first = block * BLOCK
    last = min(first + len(c), classes)
    common.r[first : first + len(c)] += c[:, :size]
    common.t[first:last] += c[: last - first, size : 2 * size]
    common.b[first:last] += c[: last - first, 2 * size]
    for at, k in enumerate(ROWWISE, 2 * size + 1):
        rows = c if k == "r" else c[: last - first]
        seen[k][first : first + len(rows)] *= np.exp(rows[:, at])


def _pack(weights: np.ndarray, change: np.ndarray) -> tuple[bytes, bytes]:
    return weights.astype("<f8").tobytes(), np.clip(change, -60_000, 60_000).astype("<f2").tobytes()


def _merged(weights, changes) -> tuple[np.ndarray, np.ndarray]:
    """The weighted mean of packed changes; a row that none has seen does not change."""
    total, summed = None, None
    for w, c in zip(weights, changes):
        w = np.frombuffer(w, "<f8")
        c = np.frombuffer(c, "<f2").reshape(len(w), -1).astype("f8") * w[:, None]
        total, summed = (w.copy(), c) if total is None else (total + w, summed + c)
    return total, summed / np.maximum(total, 1e-9)[:, None]


def shards(docs: DataFrame, class_of: dict[bytes, int], rounds: int, width: int) -> DataFrame:
    """(round, shard, ids): the classes of all of ``docs`` (doc_id, text), as int32, in pieces of at most PIECE tokens.

    A piece's round and shard follow from the hash of id and text and its number, never from how the table is cut: the
    same rows give the same shards, in the same order. Copies with ids of their own are spread; rows without an id
    are spread by their place."""
    schema = "round int, shard int, h bigint, ids binary"
    arrow = arrow_schema(schema)
    spark = docs.sparkSession
    ship(spark)
    text = F.col("text").cast("string")
    salt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    sent = spark.sparkContext.broadcast(class_of)

    def run(batches):
        class_of = sent.value
        known, classes = pa.array(list(class_of), pa.binary()), np.array([*class_of.values(), 0], "<i4")
        end = np.array([class_of[END]], "<i4")
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                tokens, n = split_tokens(part.column(1))
                out: dict[str, list] = {f.name: [] for f in arrow}
                for key, s in zip(part.column(0).to_pylist(), np.split(classes[_places(tokens, known)], np.cumsum(n)[:-1])):
                    s = np.append(s, end)
                    for at in range(0, len(s), PIECE):
                        h = xxhash.xxh64_intdigest(f"{key}:{at}".encode()) >> 1
                        for name, value in zip(out, (h % rounds, h // rounds % width, h, s[at : at + PIECE].tobytes())):
                            out[name].append(value)
                yield to_batch(out, arrow)
        give_back()

    dealt = docs.select(F.xxhash64("doc_id", salt, text).alias("h"), text.alias("text")).mapInArrow(run, schema)
    dealt = dealt.repartition(rounds * width, "round", "shard").sortWithinPartitions("round", "shard", "h", "ids")
    out = materialise(dealt.drop("h"), "shards", by=["round"])
    sent.unpersist()
    return out


def fit_all(docs: DataFrame, class_of: dict[bytes, int], unigram: np.ndarray, tokens: int, *, shard_tokens: int = SHARD, seed: int = 3) -> LogBilinear:
    """The model of all of ``docs`` (doc_id, text), which hold ``tokens`` tokens.

    Documents are dealt into shards of about ``shard_tokens``, and these to rounds, as many as shards a round: the number
    of both grows with the root of the corpus, so a larger one is learned from in longer walks as well as in more of
    them. In a round each shard is learned from once, starting at the common model and its AdaGrad sums; the changes of
    both are averaged, FAN at a time, into the next common ones. Shards, their order and their draws depend on the rows
    alone, so the model does not depend on partitions or on which task learns what. The driver gets one model a round.
    """
    spark = docs.sparkSession
    count = max(1, -(-tokens // shard_tokens))
    rounds = math.ceil(math.sqrt(count))
    width = -(-count // rounds)
    schema = "block int, task int, weights binary, change binary"
    arrow = arrow_schema(schema)
    dealt = shards(docs, class_of, rounds, width)
    common = start(unigram, seed=seed)
    seen = nothing_seen(common)
    for at in range(rounds):
        sent = spark.sparkContext.broadcast((common, seen, unigram))

        def run(batches, sent=sent, at=at):
            one_blas_thread()
            common, seen, unigram = sent.value
            shard, trainer, held, waiting = None, None, 0, []

            def learned():
                if waiting:
                    trainer.learn(waiting)
                    waiting.clear()
                for block, weights, change in _blocks(common, seen, trainer):
                    w, c = _pack(weights, change)
                    yield to_batch({"block": [block], "task": [shard], "weights": [w], "change": [c]}, arrow)

            for batch in batches:
                for now, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if now != shard:  # rows of a shard follow each other
                        if trainer is not None:
                            yield from learned()
                        shard, held, trainer = now, 0, Trainer(common.copy(), unigram, np.random.default_rng([seed, at, now]), seen=seen)
                    waiting.append(np.frombuffer(ids, "<i4").astype(np.int64))
                    held += len(waiting[-1])
                    if held >= HELD:
                        trainer.learn(waiting)
                        waiting.clear()
                        held = 0
            if trainer is not None:
                yield from learned()
            trainer = None
            give_back()

        def average(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("task")  # sums in the same order, so to the same bits
            w, c = _pack(*_merged(group["weights"], group["change"]))
            return pd.DataFrame({"block": [group["block"].iloc[0]], "task": [group["slot"].iloc[0]], "weights": [w], "change": [c]})

        made = dealt.where(F.col("round") == at).select("shard", "ids").mapInArrow(run, schema)
        left = width
        while True:
            made = made.withColumn("slot", (F.col("task") / FAN).cast("int")).groupBy("block", "slot").applyInPandas(average, schema)
            left = -(-left // FAN)
            if left == 1:
                break
        common, seen = common.copy(), {k: x.copy() for k, x in seen.items()}
        for row in made.toLocalIterator():
            c = np.frombuffer(row.change, "<f2").reshape(len(row.weights) // 8, -1).astype("f4")
            _apply(common, seen, row.block, c)
        sent.unpersist()
    drop_table(dealt)
    return common


@dataclass
class Scorer:
    """What a task needs: frequent words with count and class (0: no class of its own), the model and the totals."""

    words: dict[bytes, tuple[int, int]]
    model: LogBilinear
    total: int
    vocabulary: int
    other_total: float
    other_vocabulary: int

    @property
    def base_denominator(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.vocabulary + 1)))

    @property
    def other_denominator(self) -> float:
        """Of words without a class: their smoothed counts and one word never seen."""
        return float(np.log10(self.other_total + 0.5 * (self.other_vocabulary + 1)))


def train(docs: DataFrame, counts: DataFrame, *, classes: int = CLASSES, frequent: int = FREQUENT) -> Scorer:
    """Fit counts and vectors on all of ``docs``."""
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, vocabulary = int(totals.n or 0), int(totals.v)
    level = F.floor(F.log2("c") * 8).cast("int")
    levels = sorted(((r["l"], r["count"]) for r in counts.groupBy(level.alias("l")).count().collect()), reverse=True)
    least, room = None, frequent
    for at, n in levels:  # a level goes whole or not at all, so no word's way depends on chance
        room -= n
        if room < 0:
            break
        least = at
    top = [] if least is None else [(bytes(r.token), r.c) for r in counts.where(level >= least).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    owned = [w for w, _ in top if w != END][: max(0, classes - 2)]
    class_of = {END: 1} | {w: k + 2 for k, w in enumerate(owned)}
    held = dict(top)
    held.setdefault(END, 0)
    known = sum(held[w] for w in class_of)
    seen_classes = sum(held[w] > 0 for w in class_of)
    n = len(owned) + 2
    unigram = np.full(n, 0.5)
    unigram[0] += total - known
    for w, k in class_of.items():
        unigram[k] += held[w]
    unigram /= unigram.sum()
    model = fit_all(docs, class_of, unigram, total)
    words = {w: (c, class_of.get(w, 0)) for w, c in held.items()}
    return Scorer(words, model, total, vocabulary, float(total - known), vocabulary - seen_classes)


ROWS = (
    "key bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, token binary, times bigint, own boolean"
)


def _parts(docs: DataFrame, scorer_broadcast) -> DataFrame:
    """A row for each document, with the sums over frequent words, and one for each of its rarer words."""
    arrow = arrow_schema(ROWS)
    ship(docs.sparkSession)

    def run(batches):
        one_blas_thread()
        give_back()
        s: Scorer = scorer_broadcast.value
        words = list(s.words)
        known_words = pa.array(words, pa.binary())
        c = np.array([s.words[w][0] for w in words] + [0], dtype=np.float64)
        k = np.array([s.words[w][1] for w in words] + [0], dtype=np.int64)
        log_c, known = np.log10(c + 0.5), (c > 0)
        log_c[-1], begin = 0.0, len(s.model.t)
        ln10 = np.log(10)
        end, none = words.index(END), len(words)
        out: dict[str, list] = {f.name: [] for f in arrow}
        waiting: list[tuple] = []

        def scored() -> None:
            """The model's log10 probabilities of the texts that wait, SCORED tokens at a time."""
            w = np.concatenate([x for *_, x in waiting])
            edges = np.cumsum([0] + [len(x) for *_, x in waiting])
            u = np.append(begin, w[:-1])
            u[edges[:-1]] = begin
            v = np.append(begin, u[:-1])
            v[edges[:-1]] = begin
            cuts = np.linspace(0, len(w), 1 + max(1, len(w) // SCORED), dtype=np.int64)
            p = np.concatenate([s.model.log_p(w[i:j], u[i:j], v[i:j]) for i, j in zip(cuts, cuts[1:])])
            sums = np.add.reduceat(p.astype("f8"), edges[:-1]) / ln10
            for (row, shares, _), mine in zip(waiting, sums.tolist()):
                for name, value in zip(out, (*row, mine + shares, None, None, True)):
                    out[name].append(value)
            waiting.clear()

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                tokens, n = split_tokens(part.column(1))
                found, cuts = _places(tokens, known_words), np.cumsum(n)[:-1]
                unknown = np.flatnonzero(found == none)
                others = np.split(np.array(tokens.take(pa.array(unknown)).to_pylist(), dtype=object), np.searchsorted(unknown, cuts))
                for doc_id, text, ids, rarer in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), np.split(found, cuts), others):
                    ids = np.append(ids, end)
                    w = k[ids]
                    unowned = w == 0
                    shares = float(log_c[ids[unowned]].sum()) - unowned.sum() * s.other_denominator
                    base = float(log_c[ids].sum()) - len(ids) * s.base_denominator
                    key = xxhash.xxh64_intdigest(f"{doc_id}:".encode() + (text or "").encode("utf-8", "surrogatepass")) - 2**63
                    waiting.append(((key, doc_id, len(ids), int(known[ids].sum()), base), shares, w))
                    held += len(w)
                    rare: dict[bytes, int] = {}
                    for token in rarer:
                        rare[token] = rare.get(token, 0) + 1
                    if rare:
                        n = len(rare)
                        for name, value in (("key", key), ("own", False)):
                            out[name] += [value] * n
                        for name in ("doc_id", "n_tokens", "n_known", "base", "score"):
                            out[name] += [None] * n
                        out["token"] += list(rare)
                        out["times"] += list(rare.values())
                    if held >= SCORED or len(out["key"]) > 50_000:
                        scored()
                        held = 0
                    if len(out["key"]) > 50_000:
                        yield to_batch(out, arrow)
                        out = {f.name: [] for f in arrow}
        if waiting:
            scored()
        yield to_batch(out, arrow)
        out = {}
        give_back()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, ROWS)


def score(docs: DataFrame, *, classes: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs`` (doc_id, text).

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1 and scores all. Tokens: words and one end. ``score``
    is the log10 probability of the text under the model: the log-bilinear model gives the class of each token in its
    context of two, exactly normalised; a word without a class of its own has besides its share, by smoothed counts,
    among all such words (one unseen word counts among them). ``base_score`` is the smoothed unigram's.

    Counts and vectors are learned from all training rows. The most frequent words' counts are sent to the tasks (FREQUENT at most, and
    whole levels only); rarer words are joined by word with the counts, where no key is frequent by construction, and
    summed by document. Null or empty text: only the end. A null doc_id counts as the id "" in the split. Repeated
    rows are scored each; other columns take no part; an empty table gives no row.
    """
    train_docs = docs.where(crc_of_id() % 5 != 1)
    counts = materialise(token_counts(train_docs), "counts")
    scorer = train(train_docs, counts, classes=classes, frequent=frequent)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)
    parts = materialise(_parts(docs, sent), "parts")
    sent.unpersist()
    own, rare = parts.where("own"), parts.where("not own").select("key", "token", "times")
    summed = (
        rare.join(counts, "token", "left")
        .groupBy("key")
        .agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("seen"))
    )
    # a repeated row sends its rare words each time: its sum is shared out again
    times = own.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    sums = summed.join(times, "key")
    added = own.join(sums, "key", "left")
    rare_log = F.coalesce(F.col("rare") / F.col("rows"), F.lit(0.0))
    return added.select(
        "doc_id",
        (crc_of_id() % 5 == 1).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce((F.col("seen") / F.col("rows")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(scorer.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log).alias("base_score"),
        (F.col("score") + rare_log).alias("score"),
    )
