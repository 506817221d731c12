"""Language identification in two steps: the language family first, then one-versus-one linear SVMs inside it.

Features are hashed byte trigrams of the whole lower-cased text, as a unit vector. The classifiers are trained on the
driver from a bounded sample of labelled rows (`sample` rows, the smallest by a hash in each language); the bound is a parameter.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import bounded_sample, per_text, release

DIM = 4096
#: Families of common language codes; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "turkic": ("tr", "az", "kk"),
    "uralic": ("fi", "et", "hu"),
}


def features(text: str) -> np.ndarray:
    """Unit vector of hashed byte trigrams; the zero vector where a text has fewer than three bytes."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    x = np.zeros(DIM, np.float32)
    for a in range(0, len(b), 1 << 20):  # very long texts in pieces, so that memory stays bounded
        c = b[a : a + (1 << 20) + 2].astype(np.uint32)
        x += np.bincount(((c[:-2] * 961 + c[1:-1] * 31 + c[2:]) * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    n = float(np.sqrt(x @ x))
    return x / n if n else x


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, epochs: int = 60, lam: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, L2) by full-batch descent with momentum; classes weigh the same in total. y is +1 or -1.

    Single precision throughout, so that no copy of x in another type is made.
    """
    y = y.astype(np.float32)
    w, v = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    for _ in range(epochs):
        slack = np.maximum(0, 1 - y * (x @ w[:-1] + w[-1]))
        g = -2 * each * y * slack
        v = np.float32(0.9) * v - np.float32(0.5) * (np.append(g @ x, g.sum()) + np.float32(lam) * np.append(w[:-1], np.float32(0)))
        w = w + v
    return w[:-1], float(w[-1])


def scale(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic that turns margins into probabilities, by a search over a few values."""
    grid = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24], np.float64)
    return float(grid[np.argmin([np.logaddexp(0, -a * margin * y).mean() for a in grid])]) if len(y) else 1.0


@dataclass
class Hierarchy:
    """Classifier planes: one per family (against the rest) and one per pair of languages of a family."""

    families: list[tuple[str, list[str]]]
    w: np.ndarray  # planes x DIM
    b: np.ndarray
    a: np.ndarray
    family_rows: list[int]  # of each family (none where there is one family)
    pair_rows: dict[tuple[str, str], int]

    @classmethod
    def fit(cls, texts: list[str], langs: list[str]) -> Hierarchy:
        known = sorted(set(langs))
        of = {lang: next((f for f, ls in FAMILIES.items() if lang in ls), f"other:{lang}") for lang in known}
        families = [(f, [x for x in known if of[x] == f]) for f in sorted(set(of.values()))]
        x = np.zeros((len(texts), DIM), np.float32)
        for row, t in zip(x, texts, strict=True):
            row[:] = features(t)
        lang = np.array(langs, object)
        fam = np.array([of[z] for z in langs], object)
        planes, family_rows, pair_rows = [], [], {}

        def plane(rows: np.ndarray, y: np.ndarray) -> int:
            some = x if len(rows) == len(x) else x[rows]
            w, b = svm(some, y)
            planes.append((w, b, scale(some @ w + b, y)))
            return len(planes) - 1

        if len(families) > 1:
            every = np.arange(len(langs))
            family_rows = [plane(every, np.where(fam == f, 1.0, -1.0)) for f, _ in families]
        for _, ls in families:
            for p, q in itertools.combinations(ls, 2):
                rows = np.flatnonzero((lang == p) | (lang == q))
                pair_rows[p, q] = plane(rows, np.where(lang[rows] == p, 1.0, -1.0))
        w, b, a = zip(*planes, strict=True) if planes else ([np.zeros(DIM, np.float32)], [0.0], [1.0])
        return cls(families, np.stack(w), np.array(b), np.array(a), family_rows, pair_rows)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score: probability of the family times the mean pairwise probability inside it."""
        if not has_letters(text) or not self.families:
            return "und", 0.0
        p = 1 / (1 + np.exp(-self.a * (self.w @ features(text) + self.b)))
        k, top = 0, 1.0
        if self.family_rows:
            f = p[self.family_rows]
            k = int(np.argmax(f))
            top = float(f[k] / f.sum())
        ls = self.families[k][1]
        if len(ls) == 1:
            return ls[0], top
        votes = dict.fromkeys(ls, 0.0)
        for m, n in itertools.combinations(ls, 2):
            q = float(p[self.pair_rows[m, n]])
            votes[m] += q
            votes[n] += 1 - q
        best = max(ls, key=lambda z: votes[z])
        return best, top * votes[best] / (len(ls) - 1)


def fit_language_id(df: DataFrame, learn: Column, sample: int = 3000, longest: int = 200_000, languages: int = 100, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Hierarchy:
    """Fit on about `sample` rows where `learn` holds, lang is not null and the text has a letter and at most `longest` characters.

    The rows are those with the smallest hashes of their id and text, so reruns agree. Each language has an equal part of
    the sample or all of its rows, so a language with few documents is learnt too; beyond the `languages` most
    frequent ones no language is. Without such rows every prediction is `und`. Only the
    sample comes to the driver.
    """
    good = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}") & (F.length(text_col) <= longest))
    good = good.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    langs = {r.lang: r.n for r in good.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    rows = bounded_sample(good, "id", sample, "text", "lang", groups=("lang", langs))
    model = Hierarchy.fit([r.text for r in rows], [r.lang for r in rows])
    release()
    return model


def identify_language(df: DataFrame, model: Hierarchy, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: id (or the columns to carry), lang_pred, score. Null texts and texts without letters (empty ones too) are `und` with score 0.

    Narrow: one pass over whole texts, the model (a few planes of 4,096 weights) travels with the task. Every row gets a
    result, repeated rows each. Very long texts are counted in pieces.
    """

    def predict(texts: list[str | None]) -> list[pa.Array]:
        got = [model.predict(t) for t in texts]
        return [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]

    return per_text(df, text_col, carry or [id_col], "lang_pred string, score double", predict)
