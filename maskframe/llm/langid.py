"""Language identification with language-bitmask n-gram filters.

Every language has a Bloom filter of its character n-grams; the filters are stored bit-sliced: one table of slots whose
words hold one bit per language, so that the AND of an n-gram's few slots returns all languages that contain it at once. A
text's score for a language is its share of n-grams found there (a popcount of that bit), corrected for the share that the
filter reports by mistake; the best language wins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import ready

LETTERS = re.compile(r"[^\W\d_]+")
#: odd multipliers of the n-gram and slot hashes (fixed values; any will do)
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93))


def grams(text: str, sizes: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Hashes of all character n-grams of the lower-cased words of ``text``, each word between spaces; and their number."""
    s = f" {' '.join(LETTERS.findall(text.lower()))} "
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] + c[n - 1 :] + np.uint64(1)) * STEP
        h = h ^ (h >> np.uint64(31))
        if n in sizes:
            out.append(h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), sum(map(len, out))


def slots(h: np.ndarray, k: int, bits: int) -> list[np.ndarray]:
    return [((h * m) >> np.uint64(64 - bits)).astype(np.int64) for m in MIX[:k]]


@dataclass
class Model:
    """``table``: (slots, words of 64 languages) of uint64; ``wrong``: by language, the share of unknown n-grams that its
    filter reports (its fill to the power of the hashes)."""

    langs: list[str]
    table: np.ndarray
    wrong: np.ndarray
    sizes: tuple[int, ...]
    hashes: int

    def shares(self, text: str) -> tuple[np.ndarray, int]:
        """By language the corrected share of the text's n-grams that it contains, and the number of n-grams."""
        h, n = grams(text, self.sizes)
        bits = int(len(self.table)).bit_length() - 1
        hits = np.zeros(len(self.langs))
        for lo in range(0, len(h), 1 << 18):  # a long text in parts: bounded memory, same sums
            rows = None
            for at in slots(h[lo : lo + (1 << 18)], self.hashes, bits):
                rows = self.table[at] if rows is None else rows & self.table[at]
            for i in range(len(self.langs)):
                hits[i] += np.count_nonzero(rows[:, i // 64] & (np.uint64(1) << np.uint64(i % 64)))
        p = hits / max(n, 1)
        return np.clip((p - self.wrong) / np.maximum(1 - self.wrong, 1e-9), 0, 1), n

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share). ``und`` and 0 without a letter (or without a learned language). The score is the best
        language's part of the best two corrected shares, scaled to 0 to 1 by how much of the text it contains; ties go
        to the language that sorts first."""
        if not text or not self.langs or not LETTERS.search(text):
            return "und", 0.0, 0.0
        s, _ = self.shares(text)
        i = int(s.argmax())
        second = float(np.partition(s, -2)[-2]) if len(s) > 1 else 0.0
        return self.langs[i], float(s[i] / (s[i] + second) * s[i] ** 0.5) if s[i] > 0 else 0.0, float(s[i])


def fit(labelled: DataFrame, sizes: tuple[int, ...] = (1, 2, 3, 4), rows_per_language: int = 1500, share: float = 0.25, least: int = 4, bits: int = 18, hashes: int = 2) -> Model:
    """Learns the filters from ``labelled`` (doc_id, text, lang; null langs and texts are left out).

    The fit reads about ``rows_per_language`` whole texts per language at most, chosen by a hash of doc_id (the documented
    bound); a language with fewer gives all. An n-gram belongs to a language when it occurs at least ``least`` times there
    and at no less than ``share`` of the rate of the language in which it is most frequent. The table of ``2 ** bits`` slots
    is the only thing that reaches the driver. No labelled rows: a model that answers ``und``.
    """
    d = ready(labelled).filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    n = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(n)
    keep = F.lit(False)
    for x in langs:
        part = min(1.0, rows_per_language / n[x])
        keep = keep | ((F.col("lang") == x) & (F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))))
    number = {x: i for i, x in enumerate(langs)}

    def count(batches):
        for b in batches:
            for lang, own in b.groupby("lang"):
                parts = [grams(t, sizes)[0] for t in own["text"]]
                g, c = np.unique(np.concatenate(parts), return_counts=True)
                yield pd.DataFrame({"i": np.full(len(g), number[lang], np.int32), "g": g.view(np.int64), "c": c.astype(np.int64)})

    counts = d.filter(keep).mapInPandas(count, "i int, g long, c long").groupBy("i", "g").agg(F.sum("c").alias("c"))
    total = counts.groupBy("i").agg(F.sum("c").alias("t"))
    rates = counts.filter(F.col("c") >= least).join(F.broadcast(total), "i").withColumn("r", F.col("c") / F.col("t"))
    best = rates.groupBy("g").agg(F.max("r").alias("m"))
    held = rates.join(best, "g").filter(F.col("r") >= share * F.col("m")).select("g", "i")

    def place(batches):
        for b in batches:
            at = slots(b["g"].to_numpy().view(np.uint64), hashes, bits)
            i = b["i"].to_numpy().astype(np.int64)
            bit = (np.uint64(1) << (i % 64).astype(np.uint64)).view(np.int64)
            yield pd.DataFrame({"s": np.concatenate(at), "w": np.tile(i // 64, hashes), "b": np.tile(bit, hashes)})

    filled = held.mapInPandas(place, "s long, w long, b long").groupBy("s", "w").agg(F.bit_or("b").alias("b")).toPandas()
    table = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), np.uint64)
    table[filled["s"].to_numpy(np.int64), filled["w"].to_numpy(np.int64)] = filled["b"].to_numpy(np.int64).view(np.uint64)
    fill = np.array([np.count_nonzero(table[:, i // 64] & (np.uint64(1) << np.uint64(i % 64))) / len(table) for i in range(len(langs))])
    return Model(langs, table, fill**hashes, sizes, hashes)


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with the struct column ``out``: lang, score (0 to 1), share (corrected share of n-grams in that language).

    Works on whole texts, however long. Null or empty texts and texts without a letter: ``und``, 0, 0. Other columns and
    repeated rows stay as they are; no shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        m = held.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang", "score", "share"])

    return ready(docs).withColumn(out, F.pandas_udf(predict, "lang string, score double, share double")(F.col(text)))
