"""Toxicity: a word is the sum of its character n-gram vectors, a stretch of text the mean of its words, a softmax decides.

Embeddings and softmax are trained jointly in numpy on a bounded sample of labelled rows. Since a word's vector is
made of 3- and 4-grams, an unseen spelling or inflection shares vectors with the words that were learnt. The mean is taken
over overlapping windows of WINDOW words and a text scores as its worst window, so that a long text does not dilute a few
toxic words; training picks that window in each round too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import bounded_sample, per_text, release

BITS, WIDTH, WINDOW, RATE = 16, 6, 16, 0.5
BUCKETS = 1 << BITS
WORD = re.compile(r"\w+")


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' 3- and 4-grams with ends marked, and of the words themselves, word by word; and how many each has."""
    text = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    room = np.repeat(first + size, size) - np.arange(len(text))  # characters of the word from here on
    owner, bucket = [], []
    code = text.copy()
    for n in (2, 3, 4):
        code[: len(text) - n + 1] = code[: len(text) - n + 1] * np.uint64(0x100000001B3) + text[n - 1 :] + np.uint64(n)
        if n > 2:
            at = np.flatnonzero(room >= n)
            owner.append(word[at])
            bucket.append(code[at])
    owner.append(np.arange(len(words)))
    bucket.append(np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64))
    owner, bucket = np.concatenate(owner), (np.concatenate(bucket) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    order = np.argsort(owner, kind="stable")
    return bucket[order].astype(np.int32), np.bincount(owner, minlength=len(words))


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def once(x: np.ndarray) -> np.ndarray:
    """A word that follows itself counts once, else a line of one word fills a window by itself."""
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def windows(n: int) -> np.ndarray:
    """Starts of the windows over n words: every half window, the last one ends with the text."""
    return np.append(np.arange(0, n - WINDOW, WINDOW // 2), n - WINDOW) if n > WINDOW else np.zeros(1, np.int64)


@dataclass
class SubwordSoftmax:
    """What scoring needs: a logit for each bucket (embedding times softmax weights) and the bias."""

    logit: np.ndarray  # BUCKETS
    bias: float
    kept: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], rounds: int = 70, seed: int = 7) -> SubwordSoftmax:
        rng = np.random.default_rng(seed)
        y = np.array(labels, np.float32)
        if not len(y) or y.min() == y.max():  # one class only, or nothing to learn from
            return cls(np.zeros(BUCKETS, np.float32), -4.0 if not len(y) or y[0] == 0 else 4.0)
        vocab: dict[str, int] = {}
        docs = [once(np.array([vocab.setdefault(w, len(vocab)) for w in tokens(t)], np.int32)) for t in texts]
        flat, lens = grams(list(vocab))
        word_of = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        emb = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
        head = np.stack([-np.ones(WIDTH), np.ones(WIDTH)]).astype(np.float32) * rng.normal(0, 0.5, WIDTH).astype(np.float32)
        b = np.zeros(2, np.float32)
        each = np.where(y > 0, 0.3 / (y > 0).sum(), 0.7 / (y == 0).sum()).astype(np.float32)
        moments = [np.zeros_like(p) for p in (emb, head, b)]
        # N-grams of fewer than three sampled texts have no vector.
        df, seen, ends = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, bool), np.cumsum(lens)
        for d in docs:
            for a in range(0, len(u := np.unique(d)), 4096):
                seen[np.concatenate([flat[ends[w] - lens[w] : ends[w]] for w in u[a : a + 4096]])] = True
            df += seen
            seen[:] = False
        keep = (df >= 3).astype(np.float32)[:, None]
        emb *= keep
        starts = [windows(len(d)) for d in docs]
        for step in range(1, rounds + 1):
            # A word's logit difference decides which window of a text is the worst now; the first rounds take whole texts.
            value = np.bincount(word_of, weights=(emb @ (head[1] - head[0]))[flat], minlength=len(lens)) / np.sqrt(lens)
            spans = []
            for d, s in zip(docs, starts, strict=True):
                if step <= 14 or len(d) <= WINDOW:
                    spans.append(d)
                else:
                    c = np.concatenate([[0], np.cumsum(value[d])])
                    a = s[np.argmax(c[s + WINDOW] - c[s])]
                    spans.append(d[a : a + WINDOW])
            n = np.array([max(1, len(s)) for s in spans], np.float32)
            doc_of = np.repeat(np.arange(len(spans), dtype=np.int32), [len(s) for s in spans])
            word = np.concatenate(spans) if spans else np.zeros(0, np.int32)
            # Forward: words used in this round, their vectors, the means, the softmax.
            used, at = np.unique(word, return_inverse=True)
            mask = np.zeros(len(lens), bool)
            mask[used] = True
            rows = np.flatnonzero(mask[word_of])
            local = np.searchsorted(used, word_of[rows])
            root = 1 / np.sqrt(lens[used]).astype(np.float32)
            vec = np.stack([np.bincount(local, weights=emb[flat[rows], j], minlength=len(used)) for j in range(WIDTH)], 1).astype(np.float32) * root[:, None]
            mean = np.stack([np.bincount(doc_of, weights=vec[at, j], minlength=len(spans)) for j in range(WIDTH)], 1).astype(np.float32) / n[:, None]
            z = mean @ head.T + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            # Backward through softmax, mean and n-gram sums, all jointly.
            dz = (p - np.stack([1 - y, y], 1)) * each[:, None]
            dmean = (dz @ head) / n[:, None]
            dvec = np.stack([np.bincount(at, weights=dmean[doc_of, j], minlength=len(used)) for j in range(WIDTH)], 1) * root[:, None]
            demb = np.stack([np.bincount(flat[rows], weights=dvec[local, j], minlength=BUCKETS) for j in range(WIDTH)], 1).astype(np.float32)
            grads = (demb, dz.T @ mean + 1e-4 * head, dz.sum(0))
            # Steps in proportion to the gradient: a step per weight lets rare n-grams learn single texts by heart.
            for q, g, m, rate in zip((emb, head, b), grads, moments, (RATE, 0.1, 0.2), strict=True):
                m *= 0.9
                m += 0.1 * g
                q -= rate * m / max(float(np.abs(m).max()), 1e-12)
            emb *= keep
        return cls((emb @ (head[1] - head[0])).astype(np.float32), float(b[1] - b[0]))

    def learn_words(self, words: set[str]) -> None:
        """Give each new word its share of the logit; what is kept stays below 250,000 words, or those of one piece of text."""
        new = [w for w in words if w not in self.kept]
        if len(self.kept) + len(new) > 250_000:
            self.kept.clear()
            new = list(words)
        for a in range(0, len(new), 1 << 16):
            some = new[a : a + (1 << 16)]
            flat, lens = grams(some)
            v = np.add.reduceat(self.logit[flat], np.cumsum(lens) - lens) / np.sqrt(lens)
            self.kept.update(zip(some, v.tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of label 1 for the worst window of each text; the bias alone decides for texts without words."""
        split = [tokens(t) for t in texts]
        self.learn_words({w for ws in split for w in ws})
        out = np.full(len(texts), self.bias)
        for i, ws in enumerate(split):
            if ws:
                c = np.concatenate([[0.0], np.cumsum(v := once(np.fromiter(map(self.kept.__getitem__, ws), np.float64, len(ws))))])
                s, w = windows(len(v)), min(WINDOW, len(v))
                out[i] += (c[s + w] - c[s]).max() / w
        return (1 / (1 + np.exp(-np.clip(out, -60, 60)))).tolist()


def fit_toxicity(df: DataFrame, labels: DataFrame, learn: Column, sample: int = 1200, longest: int = 200_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> SubwordSoftmax:
    """Fit on at most `sample` labelled rows of each label where `learn` holds: those with the smallest hashes of the id.

    Null labels, null texts and texts of more than `longest` characters are no examples; without examples of both labels the score is a constant. An id that is
    labelled twice counts once, as toxic if any row says so. The labels are joined by id; only the bounded sample comes
    to the driver.
    """
    key = F.col(id_col)
    marks = labels.where(F.col(label_col).isNotNull() & learn).groupBy(key.alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    chosen = [(r._id, r._y, r._h) for y in (0, 1) for r in bounded_sample(marks.where(F.col("_y") == y), "_id", sample, "_id", "_y")]
    ids = df.sparkSession.createDataFrame(chosen, marks.withColumn("_h", F.lit(0).cast("long")).schema)
    picked = F.broadcast(ids)  # at most 2 * sample rows, whatever the input
    rows = df.select(key.alias("_id"), F.col(text_col).cast("string").alias("_t")).where(F.length("_t") <= longest).join(picked, "_id").select("_t", "_y", "_h").dropDuplicates(["_h", "_t"]).orderBy("_h", "_t").limit(2 * sample).collect()
    model = SubwordSoftmax.fit([r._t for r in rows], [r._y for r in rows])
    release()
    return model


def score_toxicity(df: DataFrame, model: SubwordSoftmax, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: id (or the columns to carry), score (0 to 1), predicted (1 where score >= threshold).

    Null and empty texts get the score of a text without words. Every row gets a result, repeated rows each. Narrow: one
    pass over whole texts; the model (65,536 logits) travels with the task.
    """
    out = per_text(df, text_col, carry or [id_col], "score double", lambda texts: [pa.array(model.scores(texts), pa.float64())])
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
