"""Token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton over the vocabulary's pieces reports every piece that ends at a character; a dynamic program over
the characters carries, for the best way to reach each, its score and its number of pieces. No back pointers, ids or strings
are kept. Ties follow the tokenizer: of equally good ways to reach a place, the piece that starts first stays; a character
that no piece covers is an unknown of its own score, and neighbouring unknowns make one piece (or one per byte).
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import free_names, ready

_MODELS: dict[tuple, Counter] = {}

#: score of an unknown below the worst piece
UNKNOWN = 10.0
MARK = "▁"
PART = re.compile(f"{MARK}+[^{MARK}]*")


def pieces_of(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model file with unigram log-probabilities. The file ranks its pieces and has
    no probabilities of its own; by Zipf's law the r-th has log-probability -ln r - ln H. (Any other list of pieces and
    scores can be given to ``Counter`` instead.)"""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    h = math.log(sum(1 / r for r in range(1, len(names) + 1)))
    return [(p, -math.log(r) - h) for r, p in enumerate(names, 1)]


class Counter:
    """Counts tokens. ``byte_fallback``: an unknown run counts one token per UTF-8 byte, else one in all."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True, memory: int = 200_000):
        import ahocorasick

        self.fallback, self.memory, self.known = byte_fallback, memory, {}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            if p:
                self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.empty = len(self.automaton) == 0
        # a text may be divided before a mark that follows another character, unless a piece (or an unknown run) spans that
        names = {p for p, _ in pieces}
        self.divides = MARK in names and not any(re.search(f"[^{MARK}]{MARK}", p) for p in names)

    def word(self, w: str) -> tuple[float, int]:
        """(best score, pieces) of one word, however long: the program keeps a row per character."""
        n = len(w)
        ends: list[list] = [[] for _ in range(n + 1)]
        if not self.empty:
            for end, hit in self.automaton.iter(w):
                ends[end + 1].append(hit)
        # score, pieces, and the unknown bytes that end here (0: the last piece is known)
        score, count, open_ = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for e in range(1, n + 1):
            best, at, single = None, 0, False
            for size, s in sorted(ends[e], reverse=True):  # the longest starts first
                single = single or size == 1
                v = s + score[e - size]
                if best is None or v > best:
                    best, at = v, size
            u = self.unknown + score[e - 1]
            if not single and (best is None or u > best):
                b = len(w[e - 1].encode("utf-8", "surrogatepass")) if self.fallback else 1
                more = b if self.fallback or not open_[e - 1] else 0
                score[e], count[e], open_[e] = u, count[e - 1] + more, 1
            else:
                score[e], count[e] = best, count[e - at] + 1
        return score[n], count[n]

    def text(self, text: str | None) -> tuple[float, int]:
        """(score, tokens) of the best segmentation of the whole text. Every blank is a mark and the text begins with one.
        No piece leads from a character into a mark after it, so the text is divided there and the parts' optima add up;
        blanks in a row stay together, as pieces of several marks need. Parts are remembered, ``memory`` of them at most."""
        total, n, known = 0.0, 0, self.known
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        for w in PART.findall(marked) if self.divides else (marked,):
            r = known.get(w)
            if r is None:
                if len(known) >= self.memory:
                    known.clear()
                r = known[w] = self.word(w)
            total += r[0]
            n += r[1]
        return total, n


def counter(path: str, byte_fallback: bool) -> Counter:
    if (path, byte_fallback) not in _MODELS:
        _MODELS[path, byte_fallback] = Counter(pieces_of(path), byte_fallback)
    return _MODELS[path, byte_fallback]


def token_counts(docs: DataFrame, model: str, text: str = "text", byte_fallback: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and ``token_score`` (double): pieces and score of the best segmentation of the whole
    ``text``. A null or empty text has 0 tokens and score 0. Other columns, nulls in them and repeated rows stay as they
    are (columns of the two new names are replaced); no shuffle."""

    def count(texts: pd.Series) -> pd.DataFrame:
        c = counter(model, byte_fallback)
        return pd.DataFrame([(n, s) for s, n in map(c.text, texts)], columns=["n", "s"])

    count = F.pandas_udf(count, "n long, s double")
    (both,) = free_names([*docs.columns, "n_tokens", "token_score"], "counts")
    return ready(docs).withColumn(both, count(F.col(text))).withColumns({"n_tokens": F.col(f"{both}.n"), "token_score": F.col(f"{both}.s")}).drop(both)
