"""Toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of four hashed embeddings: two of the word, so that two words share them
only if they collide twice, and two of its beginnings, so that unknown forms of a stem are known. Filters of one to three words run over the whole text; the maximum of
each goes to a logistic output. Training keeps the places of the maxima, so a step touches those
words alone, and ends when the loss on rows that it does not see stops falling. Decision thresholds are calibrated by language on those rows; the
score itself never reads the language.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fold, table
from tagflow.llm.labelled import collected, sample

#: Labelled rows to learn from, at most, and bytes of their hashed words (eight a word).
SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 160 << 20
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
#: Training takes at most so many steps of BATCH texts; every LOOK steps the rows that it does not see are
#: scored, and it ends once their loss has not fallen PATIENCE times by a 20th, with the model of the least loss.
STEPS, BATCH, RATE = 800, 64, 0.05
LOOK, PATIENCE = 200, 1
#: A language's threshold is fitted to its own rows and to those of all languages, which together weigh as many rows as this.
SHARED_ROWS = 40
THRESHOLD = 0.3
SEGMENT = 50_000
_PAD = max(WIDTHS) - 1
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class _Hashes(dict):
    """A word's four 16-bit table rows in one integer; so many words are kept between calls."""

    room = 200_000

    def __missing__(self, word: bytes) -> int:
        whole, four, five = zlib.crc32(word), zlib.crc32(word[:4]), zlib.crc32(word[:5])
        v = whole | (four >> 16) << 32 | (five & 0xFFFF) << 48
        if len(self) < self.room:
            self[word] = v
        return v


_row_of = _Hashes().__getitem__


def word_hashes(text: str) -> np.ndarray:
    words = text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()
    return np.fromiter(map(_row_of, words), np.uint64, len(words))


def _rows(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]


class Cnn:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tables = [r.normal(0, 0.1, (1 << 16, DIM)).astype(np.float32) for _ in range(4)]
        self.w = {k: r.normal(0, 0.5, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS}
        n = FILTERS * len(WIDTHS)
        self.b, self.v, self.c = np.zeros(n, np.float32), r.normal(0.5, 0.1, n).astype(np.float32), np.float32(-2)
        self.thresholds: dict[str, float] = {}

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Every filter at every position of padded vectors ``x``; windows begin at the position."""
        n = len(x) - _PAD
        out = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
        for k, w in enumerate(WIDTHS):
            out[:, k * FILTERS : (k + 1) * FILTERS] = sum(x[i : n + i] @ self.w[w][i] for i in range(w))
        return out + self.b

    def vectors(self, hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(table rows, -1 between texts; vectors; starts); zero vectors after each text keep windows apart."""
        lens = np.array([len(h) + _PAD for h in hashes])
        starts = np.cumsum(lens) - lens
        flat = np.zeros(int(lens.sum()) + _PAD, np.uint64)
        real = np.zeros(len(flat), bool)
        for s, h in zip(starts, hashes):
            flat[s : s + len(h)] = h
            real[s : s + len(h)] = True
        rows = _rows(flat)
        x = sum(t[r] for t, r in zip(self.tables, rows))
        x[~real] = 0
        return np.where(real, rows, -1), x, starts

    def pooled(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Maximum of each filter by text; long texts go in overlapping segments."""
        parts, of = [], []
        for k, h in enumerate(hashes):
            for at in range(0, max(1, len(h)), SEGMENT):
                parts.append(h[at : at + SEGMENT + _PAD])
                of.append(k)
        out = np.full((len(hashes), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        group, size = [], 0
        for k, (p, o) in enumerate(zip(parts, of)):
            group.append(k)
            size += len(p) + _PAD
            if size > 2 * SEGMENT or k == len(parts) - 1:
                _, x, starts = self.vectors([parts[i] for i in group])
                np.maximum.at(out, [of[i] for i in group], np.maximum.reduceat(self.responses(x), starts, axis=0))
                group, size = [], 0
        return out

    def score(self, hashes: list[np.ndarray]) -> np.ndarray:
        if not hashes:
            return np.empty(0)
        z = np.maximum(self.pooled(hashes), 0) @ self.v + self.c
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def loss(self, hashes: list[np.ndarray], y: np.ndarray) -> float:
        """Mean log loss."""
        p = np.clip(self.score(hashes), 1e-6, 1 - 1e-6)
        return float(-np.where(y == 1, np.log(p), np.log(1 - p)).mean())

    def fit(self, hashes: list[np.ndarray], y: np.ndarray, unseen: tuple[list[np.ndarray], np.ndarray] | None = None, seed: int = 11) -> None:
        """Train on ``hashes`` with 0/1 ``y``; ``unseen`` rows of both labels, if given, say when to stop."""
        r = np.random.default_rng(seed)
        watch = unseen is not None and len(set(unseen[1].tolist())) == 2
        best, kept, worse = np.inf, None, 0
        dense = {"b": self.b, "v": self.v, **{f"w{k}": w for k, w in self.w.items()}}
        seen = {k: np.full_like(p, 1e-3) for k, p in dense.items()}
        seen_c, seen_rows = 1e-3, [np.full(1 << 16, 1e-3, np.float32) for _ in self.tables]

        def step(name: str, grad: np.ndarray, rate: float = RATE) -> None:
            seen[name] += grad * grad
            dense[name] -= rate * grad / np.sqrt(seen[name])

        taken = 0
        while taken < STEPS and worse < PATIENCE:
            order = r.permutation(len(hashes))
            for at in range(0, len(order), BATCH):
                if watch and taken and taken % LOOK == 0:
                    now = self.loss(*unseen)
                    worse = 0 if now < 0.95 * best else worse + 1
                    if now < best:
                        best, kept = now, (copy.deepcopy(self.tables), {k: p.copy() for k, p in dense.items()}, self.c)
                    if worse >= PATIENCE:
                        break
                pick, taken = order[at : at + BATCH], taken + 1
                flat, x, starts = self.vectors([hashes[i] for i in pick])
                z = self.responses(x)
                place = np.array([a + z[a:b].argmax(0) for a, b in zip(starts, [*starts[1:], len(z)])])
                top = z[place, np.arange(z.shape[1])]
                act = np.maximum(top, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ self.v + self.c, -30, 30)))
                err = ((p - y[pick]) / len(pick)).astype(np.float32)
                down = err[:, None] * self.v * (top > 0)
                t, f = np.nonzero(down)
                pos, d = place[t, f], down[t, f]
                step("v", err @ act)
                seen_c += float(err.sum()) ** 2
                self.c -= np.float32(RATE * err.sum() / np.sqrt(seen_c))
                step("b", down.sum(0))
                words, grads = [], []
                for k, w in enumerate(WIDTHS):
                    own = f // FILTERS == k
                    po, fo, do = pos[own], f[own] % FILTERS, d[own]
                    g = np.zeros_like(self.w[w])
                    for i in range(w):
                        np.add.at(g[i].T, fo, do[:, None] * x[po + i])
                        words.append(flat[:, po + i])
                        grads.append(do[:, None] * self.w[w][i][:, fo].T)
                    step(f"w{w}", g)
                word, grad = np.concatenate(words, axis=1), np.concatenate(grads)
                real = word[0] >= 0
                word, grad = word[:, real], grad[real]
                for emb, acc, row in zip(self.tables, seen_rows, word):
                    rows, inv = np.unique(row, return_inverse=True)
                    g = np.zeros((len(rows), DIM), np.float32)
                    np.add.at(g, inv, grad)
                    acc[rows] += (g * g).mean(1)
                    emb[rows] -= RATE * g / np.sqrt(acc[rows])[:, None]
        if kept and self.loss(*unseen) > best:
            self.tables, self.c = kept[0], kept[2]
            for k, p in kept[1].items():
                dense[k][:] = p


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray, default: float = THRESHOLD) -> float:
    """The threshold of the largest F1 over weighted rows, of those between 0.1 and 0.9; of equals that nearest the default."""
    grid, bad = np.linspace(0.1, 0.9, 33), weight * (y == 1)
    f1 = np.array([2 * bad[score >= t].sum() / max(1e-9, weight[score >= t].sum() + bad.sum()) for t in grid])
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return float(grid[best[np.argmin(abs(grid[best] - default))]])


def train(docs: DataFrame, labels: DataFrame, label_col: str, learn, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Cnn:
    """Learn from at most ``rows`` labelled rows and ``max_bytes`` of hashed words; every fifth row calibrates the thresholds and says when to stop.

    Whole texts, null ones as empty; which rows, and what becomes of repeats, says ``sample``. With
    one label only, or no rows, every score is the smoothed share of ones.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["s_order", "label", "lang"]].assign(h=[word_hashes(t).tobytes() for t in b["text"]])

    found = sample(docs, labels, label_col, learn, rows, ("lang",)).mapInPandas(run, "s_order long, label int, lang string, h binary")
    got = collected(found, F.octet_length("h"), max_bytes)
    hashes, y = [np.frombuffer(h, np.uint64) for h in got["h"]], got["label"].to_numpy(np.float32)
    model, check = Cnn(), np.arange(len(y)) % 5 == 4
    if len(set(y.tolist())) == 2:
        model.fit([h for h, c in zip(hashes, check) if not c], y[~check], ([h for h, c in zip(hashes, check) if c], y[check]))
    else:
        model.v[:] = 0
        model.c = np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if check.any():
        s, lang, own = model.score([h for h, c in zip(hashes, check) if c]), got["lang"].to_numpy()[check], y[check]
        shared = SHARED_ROWS / len(own)
        model.thresholds = {x: best_threshold(s, own, (lang == x) + shared) for x in {v for v in lang if isinstance(v, str)}}
    return model


def score(docs: DataFrame, model: Cnn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row: doc_id, score, lang_threshold, toxic.

    Null texts are empty and scored so; very long ones are read whole. A language that calibration
    did not see, or null, has the threshold 0.3; a score equal to the threshold is toxic. Repeated
    rows and null ids keep their rows; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s, at = m.score([word_hashes(t.as_py() or "") for t in b.column(1)]), [m.thresholds.get(x, THRESHOLD) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(at, pa.float64())], names=["doc_id", "score", "lang_threshold"])

    out = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")).mapInArrow(run, "doc_id long, score double, lang_threshold double")
    return out.withColumn("toxic", F.col("score") >= F.col("lang_threshold"))


def keep_clean(docs: DataFrame, model: Cnn, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose score reaches their language's threshold; all columns kept.

    Edge cases as in ``score``: each row is judged for itself, so repeats stay or go together.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = m.score([word_hashes(t.as_py() or "") for t in b.column(text_at)])
            at = np.array([m.thresholds.get(x, THRESHOLD) for x in b.column(lang_at).to_pylist()])
            yield b.filter(pa.array(s < at))

    return docs.mapInArrow(run, docs.schema)


def op4(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; edge cases as in ``score``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, train(docs, labels, "toxic", fold("doc_id", 4) != 2))
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "lang_threshold", "toxic")
