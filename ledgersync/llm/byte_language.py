"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions, gives every position probabilities over the languages,
and the document gets their mean. It is trained here, in numpy, by backpropagation through time with Adam, on windows
of labelled texts. Gates use the soft sign x / (1 + |x|), which is cheap and keeps gradients alive.

Training takes a sample bounded by ``per_language`` windows of ``WINDOW`` characters for each language, picked by hash,
so reruns pick and train alike; the driver holds no more than that. Prediction is map-only, and only texts go to Python: they are cut into stretches
of ``STRETCH`` bytes, all of them read, many side by side, so memory is bounded whatever the length of a text.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if nothing is labelled; ties go to the
language first by code point; with one labelled language everything else with a letter is that. Null labels are
unlabelled, null ids are never trained on nor held out, repeated rows are ordinary rows, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import forget_kept, table

HIDDEN = 12
WINDOW = 120  # characters of a training window
STEPS, BATCH = 160, 256
STRETCH, SIDE_BY_SIDE = 256, 1024  # bytes read from one start; stretches read together
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str) -> bool:
    """Whether the text holds a letter by Unicode's categories (the same rule as in training); numerals are none."""
    return _LETTER.search(text) is not None


def _gate(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Network:
    """Per direction: input table (3 * hidden, 257), recurrent weights (3 * hidden, hidden), output weights (languages,
    hidden); rows are update gate, reset gate, candidate. Byte 256 stands for nothing."""

    languages: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: list[np.ndarray]
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 0) -> Network:
        rng, h = np.random.default_rng(seed), HIDDEN
        make = lambda *shape, s=1.0: (rng.normal(size=shape) * s).astype(np.float32)
        return cls(
            languages,
            [make(3 * h, 257, s=0.5) for _ in range(2)],
            [make(3 * h, h, s=h**-0.5) for _ in range(2)],
            [make(len(languages), h, s=h**-0.5) for _ in range(2)],
            np.zeros((len(languages), 1), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.table, *self.recurrent, *self.output, self.bias]

    def states(self, codes: np.ndarray, side: int, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps, hidden, texts) of one direction over ``codes`` (steps, texts); nothing at padding.

        ``keep`` receives what backpropagation needs.
        """
        steps, n = codes.shape
        h, u, table = HIDDEN, self.recurrent[side], self.table[side]
        out = np.zeros((steps, h, n), np.float32)
        state = np.zeros((h, n), np.float32)
        padded = (codes == 256).any()
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            a = np.take(table, codes[t], axis=1)
            g = u[: 2 * h] @ state
            g += a[: 2 * h]
            if keep is None:
                s = np.abs(g)
                s += 1
                g /= s
                g *= 0.5
                g += 0.5
                r = g[h:]
                r *= state
                c = u[2 * h :] @ r
                c += a[2 * h :]
                s = np.abs(c)
                s += 1
                c /= s
                c -= state
                c *= g[:h]
                state += c
            else:
                gate = 0.5 + 0.5 * _gate(g)
                z, r = gate[:h], gate[h:]
                before = state
                raw = u[2 * h :] @ (r * before) + a[2 * h :]
                cand = _gate(raw)
                keep.append((t, before, g, z, r, raw, cand))
                state = before + z * (cand - before)
            if padded:
                state = state * (codes[t] != 256)
            out[t] = state
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(languages, texts): the mean of the positions' probabilities, padding left out."""
        states = [self.states(codes, side) for side in (0, 1)]
        total = np.zeros((len(self.languages), codes.shape[1]))
        for t in range(len(codes)):
            p = self.output[0] @ states[0][t] + self.output[1] @ states[1][t] + self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            p[:, codes[t] == 256] = 0
            total += p
        return total / np.maximum((codes != 256).sum(axis=0), 1)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        h, (steps, n) = HIDDEN, codes.shape
        kept: list[list] = [[], []]
        states = [self.states(codes, side, kept[side]) for side in (0, 1)]
        live = codes != 256
        weight = live / max(live.sum(), 1)
        logits = np.einsum("kh,thn->tkn", self.output[0], states[0]) + np.einsum("kh,thn->tkn", self.output[1], states[1]) + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        loss = -(np.log(np.maximum(p[:, labels, np.arange(n)], 1e-12)) * weight).sum()
        error = p
        error[:, labels, np.arange(n)] -= 1
        error *= weight[:, None]
        error = error.astype(np.float32)
        tables, recurrents, outputs = [], [], []
        for side in (0, 1):
            u, du, dt = self.recurrent[side], np.zeros_like(self.recurrent[side]), np.zeros_like(self.table[side])
            outputs.append(np.einsum("tkn,thn->kh", error, states[side]))
            back = np.zeros((h, n), np.float32)
            for t, before, g, z, r, raw, cand in reversed(kept[side]):
                d = (back + self.output[side].T @ error[t]) * live[t]
                draw = d * z / (1 + np.abs(raw)) ** 2
                dz = d * (cand - before)
                du[2 * h :] += draw @ (r * before).T
                through = u[2 * h :].T @ draw
                dg = np.concatenate([dz, through * before]) * (0.5 / (1 + np.abs(g)) ** 2)
                du[: 2 * h] += dg @ before.T
                back = d * (1 - z) + through * r + u[: 2 * h].T @ dg
                every = np.concatenate([dg, draw])
                np.add.at(dt.T, codes[t], every.T)
            tables.append(dt)
            recurrents.append(du)
        return float(loss), [*tables, *recurrents, *outputs, error.sum(axis=(0, 2))[:, None]]


def train(windows: list[bytes], labels: list[int], languages: list[str], seed: int = 0) -> Network:
    """A network fitted to byte windows by Adam; each step draws ``BATCH`` windows, languages alike."""
    net, rng = Network.fresh(languages, seed), np.random.default_rng(seed + 1)
    length = min(WINDOW, max(map(len, windows)))
    codes = np.full((length, len(windows)), 256, np.int64)
    for k, w in enumerate(windows):
        codes[: len(w[:length]), k] = np.frombuffer(w[:length], np.uint8)
    target = np.array(labels)
    by_label = [np.flatnonzero(target == k) for k in range(len(languages))]
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, STEPS + 1):
        picked = np.concatenate([rng.choice(own, -(-BATCH // len(languages))) for own in by_label])
        _, grads = net.gradients(codes[:, picked], target[picked])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        rate = 0.03 * (1 - 0.9 * step / STEPS)
        for p, g, m, v in zip(net.parameters(), grads, mean, square, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return net


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def fit(docs: DataFrame, per_language: int = 800) -> Network | None:
    """Train on at most ``per_language`` windows of each language of ``docs`` (doc_id, text, lang); None without any.

    Documents whose fold is 2 are held out.
    """
    usable = docs.select("doc_id", "lang", "text").where((fold() != 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    pick = F.xxhash64("doc_id", F.lit("window"))
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not counts:
        return None
    share = F.coalesce(*[F.when(F.col("lang") == name, F.lit(min(1.0, 2.0 * per_language / n))) for name, n in counts.items()])
    some = usable.where(F.pmod(pick, F.lit(1_000_000)) < share * 1_000_000)
    start = F.pmod(F.xxhash64("doc_id", F.lit("start")), F.greatest(F.char_length("text") - WINDOW, F.lit(1))).cast("int") + 1
    cut = some.select("lang", pick.alias("pick"), F.substring(F.col("text"), start, F.lit(WINDOW)).alias("window"))
    order = W.partitionBy("lang").orderBy("pick", "window")
    rows = cut.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).orderBy("lang", "n").collect()
    rows = [r for r in rows if r.window]
    languages = sorted({r.lang for r in rows})
    return train([r.window.encode() for r in rows], [languages.index(r.lang) for r in rows], languages) if rows else None


def _pooled(net: Network, texts: list[str]) -> np.ndarray:
    """(texts, languages): mean probabilities over all bytes of each text."""
    forget_kept()
    data = [t.encode() for t in texts]
    owner, pieces = [], []
    for k, d in enumerate(data):
        for at in range(0, len(d), STRETCH):
            owner.append(k)
            pieces.append(d[at : at + STRETCH])
    order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
    total = np.zeros((len(texts), len(net.languages)))
    for lo in range(0, len(order), SIDE_BY_SIDE):
        part = order[lo : lo + SIDE_BY_SIDE]
        length = len(pieces[part[0]])
        codes = np.full((len(part), length), 256, np.int64)
        for row, i in enumerate(part):
            codes[row, : len(pieces[i])] = np.frombuffer(pieces[i], np.uint8)
        p = net.probabilities(np.ascontiguousarray(codes.T))
        np.add.at(total, np.array(owner)[part], p.T * np.array([[len(pieces[i])] for i in part]))
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score, from ``text`` alone; columns of these names are replaced."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def label(column: pa.Array) -> pa.Array:
        name, score = ["und"] * len(column), [0.0] * len(column)
        for lo in range(0, len(column), 1_000):
            texts = column.slice(lo, 1_000).to_pylist()
            lettered = [k for k, t in enumerate(texts) if t and has_letter(t)] if net else []
            if lettered:
                p = _pooled(net, [texts[k] for k in lettered])
                for k, best, value in zip(lettered, p.argmax(axis=1), p.max(axis=1), strict=True):
                    name[lo + k], score[lo + k] = net.languages[best], float(min(1.0, value))
        return pa.StructArray.from_arrays([pa.array(name), pa.array(score)], ["lang_pred", "score"])

    rest = docs.drop("lang_pred", "score")
    found = rest.select(F.struct(*[F.col(f"`{c}`") for c in rest.columns]).alias("row"), label("text").alias("found"))
    return found.select("row.*", "found.lang_pred", "found.score")


def op5_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs)
    found = identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_byte_language": op5_byte_language}
SQL: dict[str, str] = {}
