"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy, labels every position."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_texts, crc_of_id, extend

#: Documents and bytes of each language that the network is fitted on, at most, and languages: the most frequent ones.
MAX_DOCS_PER_LANGUAGE = 500
MAX_BYTES_PER_LANGUAGE = 4_000_000
MAX_LANGUAGES = 64
#: Bytes of a piece: within a piece the network's state runs on over all characters, white space included. A piece is
#: read with CONTEXT bytes around it, so that no label lacks what stands beside it.
PIECE, CONTEXT = 512, 24
#: Pieces in one matrix product, and bytes of a training window.
TOGETHER, WINDOW = 1024, 64
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")


def bytes_of(text: str | None) -> bytes:
    """The lower-cased text as UTF-8: what the network reads."""
    return (text or "").lower().encode("utf-8", "surrogatepass")


def pieces_of(data: bytes, piece: int = PIECE, context: int = CONTEXT) -> list[tuple[int, int, int, int]]:
    """(from, first, last, to): bytes first to last are labelled, from to to are read. Pieces begin at characters."""
    cuts, at = [0], piece
    while at < len(data):
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        cuts.append(at)
        at += piece
    cuts = [c for c in cuts if c < len(data)] + [len(data)] if data else []
    return [(max(0, a - context), a, b, min(len(data), b + context)) for a, b in zip(cuts, cuts[1:])]


@dataclass
class Network:
    """Embedding E (256 x e); per direction W (e x 3h), U (h x 3h), b (3h) with the gates update, reset, candidate;
    output V (2h x classes), c."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, languages: list[str], e: int = 8, h: int = 12, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("f4")
        w = {"E": draw(256, e) * 8, "V": draw(2 * h, len(languages)), "c": np.zeros(len(languages), "f4")}
        for d in "fb":
            w |= {f"W{d}": draw(e, 3 * h), f"U{d}": draw(h, 3 * h), f"b{d}": np.zeros(3 * h, "f4")}
        return cls(languages, w)

    def forward(self, x: np.ndarray, d: str, keep: list | None = None) -> list[np.ndarray]:
        """States after each step of one direction; x: (segments, steps) of equal length, read backwards for "b"."""
        w, steps = self.weights, range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1)
        table = w["E"] @ w[f"W{d}"] + w[f"b{d}"]  # (256, 3h): the input's share of the gates
        u, h = w[f"U{d}"], w[f"U{d}"].shape[0]
        state, states = np.zeros((len(x), h), "f4"), [None] * x.shape[1]
        for t in steps:
            a = table[x[:, t]]
            gates = 0.5 + 0.5 * softsign(a[:, : 2 * h] + state @ u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            rs = r * state
            n = softsign(a[:, 2 * h :] + rs @ u[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, z, r, n, rs))
            state = n + z * (state - n)
            states[t] = state
        return states

    def position_logits(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(steps, segments, classes)."""
        w = self.weights
        f = np.stack(self.forward(x, "f", None if keep is None else keep.setdefault("f", [])))
        b = np.stack(self.forward(x, "b", None if keep is None else keep.setdefault("b", [])))
        both = np.concatenate([f, b], axis=2)
        if keep is not None:
            keep["both"] = both
        return both @ w["V"] + w["c"]

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of the weighted mean cross-entropy over positions, by backpropagation through time."""
        w, kept = self.weights, {}
        p = softmax(self.position_logits(x, kept))
        share = (weight / (weight.sum() * x.shape[1])).astype("f4")
        rows = np.arange(len(x))
        loss = -float((np.log(p[:, rows, y] + 1e-9) * share).sum())
        p[:, rows, y] -= 1
        p *= share[None, :, None]
        both, h = kept["both"], w["Uf"].shape[0]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["V"] = np.einsum("tsh,tsc->hc", both, p)
        g["c"] = p.sum((0, 1))
        out = p @ w["V"].T
        for d, part in (("f", out[:, :, :h]), ("b", out[:, :, h:])):
            u, wd = w[f"U{d}"], w[f"W{d}"]
            dstate = np.zeros((len(x), h), "f4")
            for t, before, z, r, n, rs in reversed(kept[d]):
                dstate = dstate + part[t]
                slope = lambda s: (1 - np.abs(s)) ** 2
                dn = dstate * (1 - z) * slope(n)
                dz = dstate * (before - n) * 0.5 * slope(2 * z - 1)
                drs = dn @ u[:, 2 * h :].T
                dr = drs * before * 0.5 * slope(2 * r - 1)
                gates = np.concatenate([dz, dr], axis=1)
                dstate = dstate * z + drs * r + gates @ u[:, : 2 * h].T
                da = np.concatenate([gates, dn], axis=1)
                g[f"U{d}"][:, : 2 * h] += before.T @ gates
                g[f"U{d}"][:, 2 * h :] += rs.T @ dn
                g[f"W{d}"] += w["E"][x[:, t]].T @ da
                g[f"b{d}"] += da.sum(0)
                np.add.at(g["E"], x[:, t], da @ wd.T)
        return loss, g

    def _run(self, x: np.ndarray, d: str) -> np.ndarray:
        """(steps, rows, classes): one direction's share of the logits at each step of ``x`` (steps, rows)."""
        w, h = self.weights, self.weights[f"U{d}"].shape[0]
        table, u = w["E"] @ w[f"W{d}"] + w[f"b{d}"], w[f"U{d}"]
        out = w["V"][:h] if d == "f" else w["V"][h:]
        # arrays of their own for update, reset and candidate: whole rows are read and written
        tables, us = zip(*[(np.ascontiguousarray(table[:, k * h : (k + 1) * h]), np.ascontiguousarray(u[:, k * h : (k + 1) * h])) for k in range(3)])
        rows = x.shape[1]
        state, logits = np.zeros((rows, h), "f4"), np.empty((len(x), rows, out.shape[1]), "f4")
        z, r, n, held = (np.empty((rows, h), "f4") for _ in range(4))

        def gate(k: int, made: np.ndarray, given: np.ndarray, at: np.ndarray) -> None:
            np.matmul(given, us[k], out=made)
            np.take(tables[k], at, axis=0, out=held, mode="clip")
            np.add(made, held, out=made)
            np.abs(made, out=held)
            np.add(held, 1, out=held)
            np.divide(made, held, out=made)

        for t, at in enumerate(x.astype(np.intp)):
            gate(0, z, state, at)
            gate(1, r, state, at)
            r += 1
            r *= 0.5
            r *= state
            gate(2, n, r, at)
            z += 1
            z *= 0.5
            state -= n
            state *= z
            state += n
            np.matmul(state, out, out=logits[t])
        return logits

    def label_scores(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Per piece the log-probabilities of its labels: (bytes, classes). Pieces of like length go together."""
        out: list = [None] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            sizes = np.array([len(pieces[i]) for i in some])
            steps = int(sizes.max())
            ahead, back = np.zeros((steps, len(some)), np.uint8), np.zeros((steps, len(some)), np.uint8)
            for k, i in enumerate(some):
                data = np.frombuffer(pieces[i], np.uint8)
                ahead[: len(data), k], back[: len(data), k] = data, data[::-1]
            turned = np.clip(sizes[None, :] - 1 - np.arange(steps)[:, None], 0, None)
            logits = self._run(ahead, "f") + np.take_along_axis(self._run(back, "b"), turned[:, :, None], axis=0) + self.weights["c"]
            logits -= logits.max(axis=2, keepdims=True)
            logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
            for k, i in enumerate(some):
                out[i] = logits[: sizes[k], k]
        return out

    def text_scores(self, texts: list[bytes]) -> np.ndarray:
        """Per text the sum over all its bytes of the labels' log-probabilities."""
        total = np.zeros((len(texts), len(self.languages)))
        cut = [(i, span) for i, data in enumerate(texts) for span in pieces_of(data)]
        for at in range(0, len(cut), 8 * TOGETHER):
            some = cut[at : at + 8 * TOGETHER]
            for (i, (start, first, last, _)), scores in zip(some, self.label_scores([texts[i][a:b] for i, (a, _, _, b) in some])):
                total[i] += scores[first - start : last - start].sum(axis=0)
        return total

    def label_bytes(self, text: str | None) -> list[str]:
        """The likeliest language at each byte of the lower-cased text, white space included."""
        data = bytes_of(text)
        spans = pieces_of(data)
        found = self.label_scores([data[a:b] for a, _, _, b in spans])
        return [self.languages[k] for (start, first, last, _), s in zip(spans, found) for k in s[first - start : last - start].argmax(axis=1)]

    def label_positions(self, text: str | None) -> list[tuple[bytes, list[str]]]:
        """Each word of a text with the likeliest language at each of its bytes."""
        data, labels = bytes_of(text), self.label_bytes(text)
        return [(m.group(), labels[m.start() : m.end()]) for m in re.finditer(rb"\S+", data)]


def softsign(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the network's one nonlinearity, several times faster than tanh in numpy."""
    return x / (1 + np.abs(x))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], *, steps: int = 300, batch: int = 256, window: int = WINDOW, seed: int = 1, h: int = 10) -> Network:
    """Train on (text, language) rows: windows at random places of random texts, languages alike, Adam."""
    languages = sorted({y for _, y in rows})
    network = Network.new(languages, h=h, seed=seed)
    if len(languages) < 2:
        return network
    rng = np.random.default_rng(seed)
    pools = [np.frombuffer(b" ".join(bytes_of(t) for t, y in rows if y == lang) + b" " * window, np.uint8) for lang in languages]
    weight = np.ones(batch, "f4")
    m = {k: np.zeros_like(v) for k, v in network.weights.items()}
    v = {k: np.zeros_like(a) for k, a in network.weights.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, len(languages), batch)
        size = int(rng.choice([window // 4, window // 2, window, window]))  # short texts come too
        x = np.stack([pools[k][i : i + size] for k, i in zip(y, (rng.random(batch) * [len(pools[k]) - window for k in y]).astype(int))])
        _, g = network.gradients(x, y, weight)
        rate = 0.02 * min(1.0, step / 30) * (1 - 0.9 * step / steps)
        for k in g:
            np.clip(g[k], -1, 1, out=g[k])
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            network.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
    network.weights = {k: a.astype("f4") for k, a in network.weights.items()}
    return network


def train(docs: DataFrame, *, max_docs_per_language: int = MAX_DOCS_PER_LANGUAGE, max_bytes_per_language: int = MAX_BYTES_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Network:
    """Fit on documents with a language whose crc32(doc_id as text) mod 4 is not 2.

    Learned are the ``max_languages`` languages with most documents (ties: by name), each from at most
    ``max_docs_per_language`` distinct texts, those with the smallest hashes, as far as they fit into
    ``max_bytes_per_language`` (a longer text is passed over); so a language with a third of all rows sends no more than
    another. Null ids, texts and languages teach nothing; repeated rows count once; an empty table gives a network that
    knows no language.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(crc_of_id() % 4 != 2)
    known = known.select(F.col("lang").cast("string").alias("label"), F.col("text").cast("string").alias("text"))
    languages = [r.label for r in known.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_languages).collect()]
    if not languages:
        return Network.new([])
    rows = bounded_texts(known.where(F.col("label").isin(languages)), most=max_docs_per_language, most_bytes=max_bytes_per_language, by_label=True)
    return fit(rows)


def predict(docs: DataFrame, network: Network, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    Every byte of the whole text is labelled, white space included; the document's probabilities pool the positions'
    log-probabilities. The state starts anew at a piece (PIECE bytes, read with CONTEXT more on both sides), never at a
    word. Text that is null or has no letter: ``und`` with score 0; so is all text if no language was learned. Equal
    probabilities go to the first language by name. Repeated rows are labelled each, null ids matter nothing, an empty
    table gives no row. All columns stay (``keep`` selects them); those with the added names are replaced.
    """

    def work(texts: list) -> dict:
        labels, best = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        asked = [i for i, t in enumerate(texts) if network.languages and t and _LETTER.search(t)]
        for at in range(0, len(asked), 256):  # bounded memory, however long the texts of a batch are
            some = asked[at : at + 256]
            data = [bytes_of(texts[i]) for i in some]
            for i, d, total in zip(some, data, network.text_scores(data)):
                p = softmax(total / max(1.0, (len(d) / 6) ** 0.5))
                labels[i], best[i] = network.languages[int(p.argmax())], float(p.max())
        return {"lang_pred": labels, "score": best}

    return extend(docs, text_col, keep, "lang_pred string, score double", work)
