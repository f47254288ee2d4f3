"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds its letters' vectors, the first rotated by two
places and the second by one, by multiplying them; a text's vector bundles its trigrams' by adding them; a language's
prototype bundles the unit vectors of its texts. A text is given the language whose prototype is the nearest by cosine.

Text is lower-cased, and each run of other characters than letters counts as one blank, at both ends too. Prototypes are
sums of integers (unit vectors times `SCALE`), so they do not depend on partitions. They are one vector of `DIM` numbers
for each language, whatever the input.

Nulls: a null text, or one without a letter, is `und` with score 0; a null language is no label. Rows are judged one by
one, ties go to the first language by name; without any labelled row all is `und`. Extra columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import map_rows, positional, restored

DIM = 1024
SCALE = 1000
SEED = 20_231
#: Trigram vectors that a worker remembers at once.
CACHE = 12_000
UNKNOWN = "und"
#: Standard deviations of an unrelated text's cosine, distinct trigrams from which on it is judged, and by how much a label is wrong.
NOISE, LEAST_TRIGRAMS, MARGIN = 4.0, 50, 0.25


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


class Space:
    """The vectors of letters and trigrams: of one task, so that no worker holds them for longer."""

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.letter = letters()
        self.letters: dict[int, np.ndarray] = {}
        self.at: dict[int, int] = {}
        self.vectors = np.empty((CACHE, dim), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > CACHE:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([SEED, code]).choice(np.array([-1, 1], np.float32), self.dim)
        return self.letters[code]

    def _trigram(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of a text's trigrams; none without a letter."""
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code = np.r_[0, np.where(self.letter[code], code, 0), 0]
        code = code[np.r_[True, (code[1:] != 0) | (code[:-1] != 0)]]
        if len(code) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.unique((code[:-2] << 42) | (code[1:-1] << 21) | code[2:], return_counts=True)

    def _indices(self, keys: list[int]) -> np.ndarray:
        """Where the keys' vectors are; at most CACHE keys."""
        new = [k for k in keys if k not in self.at]
        if len(self.at) + len(new) > CACHE:
            self.at.clear()
            new = keys
        for k in new:
            self.vectors[len(self.at)] = self._trigram(k)
            self.at[k] = len(self.at)
        return np.array([self.at[k] for k in keys])

    def encode(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text, or None without a letter."""
        return self.bundled(*self.trigrams(text or ""))

    def bundled(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
        if not len(keys):
            return None
        out = np.zeros(self.dim, np.float32)
        for i in range(0, len(keys), CACHE):
            part = self._indices(keys[i : i + CACHE].tolist())
            for j in range(0, len(part), 128):  # small enough for one thread
                out += counts[i + j : i + j + 128].astype(np.float32) @ self.vectors[part[j : j + 128]]
        norm = float(np.linalg.norm(out))
        return out / norm if norm else out


def prototypes(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> list[tuple[str, list[int]]]:
    """(language, prototype), sorted by language: one row for each language comes back, of DIM numbers."""

    def bundle(sp, langs, texts):
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(langs, texts):
            if lang is not None and (v := sp.encode(text)) is not None:
                sums[lang] = sums.get(lang, 0) + np.rint(v * SCALE).astype(np.int64)
        return list(sums), [v.tolist() for v in sums.values()]

    parts = map_rows(labelled, [], [lang_col, text_col], [("lang", pa.string()), ("vector", pa.list_(pa.int64()))], bundle, Space)
    sums = parts.select("lang", F.posexplode("vector").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v")).collect()
    return sorted((r["lang"], [x["v"] for x in r["v"]]) for r in rows)


def measured(docs: DataFrame, known: list[tuple[str, list[int]]], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, lang_pred, score (the cosine with that language's prototype, at least 0), margin (over the next
    language's cosine; 1 with one language) and n_trigrams, the distinct ones."""
    names = [lang for lang, _ in known]
    matrix = np.array([v for _, v in known], np.float64).reshape(len(known), DIM)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norms == 0, 1, norms)

    def judge(sp, texts):
        lang, score, margin, size = [], [], [], []
        for text in texts:
            keys, counts = sp.trigrams(text or "")
            v = sp.bundled(keys, counts)
            size.append(len(keys))
            if v is None or not names:
                lang.append(UNKNOWN)
                score.append(0.0)
                margin.append(0.0)
            else:
                cos = matrix @ v
                k = int(np.argmax(cos))
                lang.append(names[k])
                score.append(min(1.0, max(0.0, float(cos[k]))))
                margin.append(float(cos[k] - np.delete(cos, k).max()) if len(names) > 1 else 1.0)
        return lang, score, margin, size

    return map_rows(docs, keep, [text_col], [("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("n_trigrams", pa.int64())], judge, Space)


def identify(docs: DataFrame, known: list[tuple[str, list[int]]], keep: list[str] = ["doc_id"], text_col: str = "text") -> DataFrame:
    """The columns `keep`, lang_pred and score."""
    return measured(docs, known, keep, text_col).drop("margin", "n_trigrams")


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the rows, by id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", noise: float = NOISE, least: int = LEAST_TRIGRAMS, margin: float = MARGIN) -> DataFrame:
    """docs without what is in no known language, and with its language where the label is missing or wrong.

    Rejected are texts without a letter, and texts of `least` distinct trigrams or more that are no nearer to any prototype than
    unrelated vectors are: their score is under noise / sqrt(DIM), so many standard deviations of such a cosine. Shorter
    texts are too short to tell. A label is wrong if another language is nearer by `margin`; null labels are filled. All
    other columns stay as they are. Without any labelled row there is no language, and all rows go.
    """
    rows, names = positional(docs)
    lang = names[docs.columns.index(lang_col)]
    rows = measured(rows, prototypes(labelled, lang_col, text_col), names, names[docs.columns.index(text_col)])
    random = (F.col("n_trigrams") >= least) & (F.col("score") < noise / DIM**0.5)
    sure = F.col(lang).isNull() | ((F.col(lang) != F.col("lang_pred")) & (F.col("margin") >= margin))
    kept = rows.where((F.col("lang_pred") != UNKNOWN) & ~random).withColumn(lang, F.when(sure, F.col("lang_pred")).otherwise(F.col(lang)))
    return restored(kept, names, docs.columns)
