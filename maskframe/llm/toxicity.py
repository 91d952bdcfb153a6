"""Toxicity scores from a learned lexicon, misspellings included.

The lexicon (words, and word beginnings that stand for whole families) is learned from labelled documents. It is held in a
trie; a Levenshtein automaton of each term intersected with that trie, made deterministic state by state as text calls for
it, reads each word once and reports the terms within the allowed distance; two neighbouring characters that changed places
are one error. A window of words around each hit gives a context score that tells quotation from abuse (quotation marks that
pair up around the hit, and words that clean documents use beside terms), and a logistic model over the hits gives the
document's score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import ready, written
from maskframe.llm.hnsw import united

WORD = re.compile(r"[^\W_]+")
MARKS = re.compile(r"[\"“”„«»]")
#: fixed values: words that announce a quotation or a mention, where the labelled documents say nothing else
REPORTING = frozenset("said says say quote quoted quotes called calls word words term terms wrote writes reported means meaning sagte sagt zitat zitiert wort nannte bedeutet dit disait citation mot appelé signifie dijo dice cita palabra llamó significa".split())
#: words on each side of a hit that its context score looks at
WINDOW = 6
N_FEATURES = 6
#: words that a worker remembers at most
MEMORY = 500_000
#: words on each side of a use by which copies of it are known
SIDE = 4


def allowed(term: str) -> int:
    """The edit distance up to which a word is a misspelling of ``term``."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Terms with their allowed distances as one deterministic automaton. A state is a set of (trie node, character still
    owed, errors so far): a character is owed when its successor in a term was read before it, so that a swap is one error.
    States are made when first reached and forgotten together when there are ``memory`` of them."""

    def __init__(self, words: list[str], prefixes: list[str], memory: int = 50_000):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most: list[int] = [0]
        self.memory = memory
        self.heads: dict[int, list[str]] = {}
        for w in words:
            self._add(w, allowed(w))
        self.prefixes = sorted(prefixes, key=len)
        self.by_length = sorted({len(p) for p in prefixes})
        self.prefix_set = frozenset(prefixes)
        self._reset()

    def _add(self, w: str, most: int) -> None:
        at = 0
        self.most[0] = max(self.most[0], most)
        for c in w:
            if c not in self.children[at]:
                self.children[at][c] = len(self.children)
                self.children.append({})
                self.term.append(None)
                self.most.append(0)
            at = self.children[at][c]
            self.most[at] = max(self.most[at], most)
        self.term[at] = w

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.state: list[frozenset] = []
        self.accept: list[tuple[tuple[str, int], ...]] = []
        self.start = self._id(self._closed({(0, "", 0)}))

    def _closed(self, s: set) -> frozenset:
        """With every node reachable by leaving out characters of a term."""
        todo, best = list(s), {}
        while todo:
            n, owed, e = todo.pop()
            if e > self.most[n] or best.get((n, owed), 99) <= e:
                continue
            best[n, owed] = e
            if not owed:
                todo += [(x, "", e + 1) for x in self.children[n].values()]
        return frozenset((n, owed, e) for (n, owed), e in best.items())

    def _id(self, s: frozenset) -> int:
        if s not in self.ids:
            self.ids[s] = len(self.state)
            self.state.append(s)
            self.next.append({})
            self.accept.append(tuple(sorted((self.term[n], e) for n, owed, e in s if not owed and self.term[n] is not None and e <= allowed(self.term[n]))))
        return self.ids[s]

    def _step(self, at: int, c: str) -> int:
        out = set()
        for n, owed, e in self.state[at]:
            if owed:
                if owed == c:
                    out.add((n, "", e))
                continue
            for x, y in self.children[n].items():
                out.add((y, "", e if x == c else e + 1))
                if x != c and c in self.children[y]:
                    out.add((self.children[y][c], x, e + 1))
            out.add((n, "", e + 1))
        if len(self.state) >= self.memory:
            keep = self._closed(out)
            self._reset()
            return self._id(keep)
        to = self.next[at][c] = self._id(self._closed(out))
        return to

    def match(self, word: str) -> tuple[tuple[str, int], ...]:
        """(term, distance) of the words within their distance, and (term + "*", 0) of the beginnings."""
        at = self.start
        for c in word:
            to = self.next[at].get(c)
            at = to if to is not None else self._step(at, c)
            if not self.state[at]:
                hits = ()
                break
        else:
            hits = self.accept[at]
        for n in self.by_length:
            if word[:n] in self.prefix_set and len(word) >= n:
                hits += ((word[:n] + "*", 0),)
        return hits


def quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of the marked quotations in ``text``, in order. A mark opens where a word follows it and none precedes
    it, closes where something precedes it and no word follows; between blanks its shape decides. A closing mark ends the
    nearest opening mark before it; a mark without a partner, such as that of inches, quotes nothing."""
    out, start = [], -1
    for m in MARKS.finditer(text):
        i = m.start()
        before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        left, right = not before or before.isspace(), not after or after.isspace()
        if left and right:
            opens, closes = m.group() in "\u201c\u201e\u00ab", m.group() in "\u201d\u00bb"
        else:
            opens = not right and (left or (not before.isalnum() and after.isalnum()))
            closes = not left and not opens and not after.isalnum()
        if opens:
            start = i
        elif closes and start >= 0:
            out.append((start, i))
            start = -1
    return out


@dataclass
class Model:
    """``terms``: log-odds of words and of beginnings (with a trailing ``*``); ``harmless``: words near a term that clean
    documents use; ``telling``: words beside a hit that speak of it and do not use it; ``weights``: of the logistic model
    over the features, the last one its constant."""

    terms: dict[str, float]
    harmless: frozenset = frozenset()
    telling: frozenset = REPORTING
    weights: np.ndarray = field(default_factory=lambda: np.append(np.zeros(N_FEATURES), -2.0))

    def automaton(self) -> Automaton:
        a = getattr(self, "_automaton", None)
        if a is None:
            a = self._automaton = Automaton([t for t in self.terms if not t.endswith("*")], [t[:-1] for t in self.terms if t.endswith("*")])
        return a

    def known_words(self) -> tuple[set[str], dict[str, tuple[str, int]]]:
        """Words read so far, and those of them that are hits."""
        if "_known" not in self.__dict__:
            self._known: set[str] = set()
            self._found: dict[str, tuple[str, int]] = {}
        return self._known, self._found

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def hits(self, text: str) -> list[tuple[str, str, int, float]]:
        """(word, best term, distance, context) of every hit in ``text``; context 0 abuse to 1 quotation."""
        low = text.lower()
        here = set(WORD.findall(low))
        known, found = self.known_words()
        new = here - known
        if new:
            a = self.automaton()
            if len(known) > MEMORY:  # bounded: what is known of words can be found again
                known.clear()
                found.clear()
                new = here
            for w in new:
                if w not in self.harmless and (m := a.match(w)):
                    found[w] = max(m, key=lambda x: (self.terms.get(x[0], 0.0) - x[1], x[0]))
            known |= new
        if here.isdisjoint(found):
            return []
        words = [(m.group(), m.start()) for m in WORD.finditer(low)]
        quotes = quotations(low)
        out, k = [], 0
        for i, (w, at) in enumerate(words):
            if w in found:
                while k < len(quotes) and quotes[k][1] < at:
                    k += 1
                near = words[max(0, i - WINDOW) : i + WINDOW + 1]
                lo, hi = near[0][1], near[-1][1] + len(near[-1][0])
                # inside a quotation that opens and closes within the window
                quoted = k < len(quotes) and lo - 2 <= quotes[k][0] < at and quotes[k][1] <= hi + 2
                told = sum(x in self.telling for x, _ in near if x != w)
                out.append((w, *found[w], min(1.0, 0.7 * quoted + 0.3 * min(told, 1) * (1 + quoted))))
        return out

    def surroundings(self, text: str) -> list[tuple[int, set[str]]]:
        """For every hit in ``text`` a hash of the words around it and the set of them that are no hits ("" among them)."""
        import xxhash

        out = []
        if self.hits(text):
            found, words = self.known_words()[1], WORD.findall(text.lower())
            for i, w in enumerate(words):
                if w in found:
                    near = words[max(0, i - WINDOW) : i + WINDOW + 1]
                    out.append((xxhash.xxh64_intdigest(" ".join(near).encode("utf-8", "surrogatepass")) >> 1, {"", *(x for x in near if x not in found)}))
        return out

    def features(self, text: str | None) -> np.ndarray:
        """Strength of exact, beginning and misspelled hits (log scale), the strongest hit, the quoted part, and whether
        there is any hit that is not quoted. All 0 for a null or empty text."""
        f = np.zeros(N_FEATURES)
        for _, term, d, c in self.hits(text) if text else ():
            v = max(self.terms.get(term, 0.0), 0.0) * (1 - c)
            f[0 if d == 0 and not term.endswith("*") else 1 if d == 0 else 2] += v
            f[3] = max(f[3], v if d == 0 else v / 2)
            f[4] += c
            f[5] = max(f[5], float(c < 0.5))
        f[[0, 1, 2, 4]] = np.log1p(f[[0, 1, 2, 4]])
        return f

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the constant comes last and is not penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    pen = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen), x.T @ (y - p) - pen * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


class Uses:
    """The words and word beginnings of a text, each with hashes of the ``SIDE`` words before and after its first use."""

    def __init__(self, heads: tuple[int, ...]):
        self.heads, self.known = heads, {}

    def names(self, w: str) -> tuple[int, tuple[str, ...]]:
        """Hash of the word; the word and its beginnings."""
        import xxhash

        if (n := self.known.get(w)) is None:
            if len(self.known) > MEMORY:
                self.known.clear()
            n = self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")), (w, *(w[:k] + "*" for k in self.heads if len(w) > k))
        return n

    def of(self, text: str) -> dict[str, tuple[int, int]]:
        """By word or beginning (32-bit hash before, 32-bit hash after); under "" the text's own two smallest hashes of
        runs of words, which near copies share."""
        words = [self.names(w) for w in WORD.findall(text.lower())]
        h = np.zeros(len(words) + 2 * SIDE, np.uint64)
        h[SIDE : len(h) - SIDE] = [x for x, _ in words]
        n = len(words)
        # the places on either side, each place with a factor of its own
        before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for k in range(1, SIDE + 1):
            factor = np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (2**64 - 1))
            for side, at in ((before, SIDE - k), (after, SIDE + k)):
                x = h[at : at + n] * factor
                side += (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        before, after = ((x >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist() for x in (before, after))
        out = {"": (min(before, default=0), min(after, default=0))}
        for (_, names), b, a in zip(words, before, after, strict=True):
            for w in names:
                if w not in out:
                    out[w] = b, a
        return out


def independent(before: np.ndarray, after: np.ndarray) -> int:
    """How many groups the uses make when those with the same words before, or the same words after, are copies."""
    _, a = np.unique(before, return_inverse=True)
    _, b = np.unique(after, return_inverse=True)
    links = a.max(initial=-1) + 1
    places = links + b.max(initial=-1) + 1
    if len(before) * 2 == places:
        return len(before)
    return len(np.unique(united(np.arange(places), a, links + b)))


def telling_words(around: DataFrame) -> frozenset:
    """Of words beside hits (w, n1 toxic and n0 clean surroundings that hold them; "" counts the surroundings) those that
    speak of a term and do not use it."""
    whole = around.filter("w = ''").first()
    if whole is None:
        return REPORTING
    s1, s0 = max(whole["n1"], 1), max(whole["n0"], 1)
    words = around.filter("w <> ''")
    usual = frozenset(r["w"] for r in words.filter(F.col("w").isin(sorted(REPORTING)) & (F.col("n1") >= 3) & (F.col("n1") / s1 >= F.col("n0") / s0)).select("w").collect())
    if not whole["n1"] or not whole["n0"]:
        return REPORTING - usual
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    both = (n1 + n0) / (s1 + s0)
    llr = n0 * F.log(n0 / s0 / both) + F.when(n1 > 0, n1 * F.log(n1 / s1 / both)).otherwise(0.0)
    tries = max(2, words.filter("n0 >= 3").count())
    learned = words.filter((n0 >= 3) & (n0 / s0 > 3 * n1 / s1) & (llr >= math.log(tries))).select("w").collect()
    return (REPORTING - usual) | frozenset(r["w"] for r in learned)


def fit(docs: DataFrame, labels: DataFrame, rows_per_label: int = 10_000, heads: tuple[int, ...] = (4, 5, 6)) -> Model:
    """Learns lexicon and weights from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic 0/1) name; null
    labels and texts are left out, and an id labelled both ways is toxic.

    The fit reads about ``rows_per_label`` whole documents per label at most, chosen by a hash of doc_id (the documented
    bound; it also bounds the ids that are broadcast to the scan of the texts). A word, or a word beginning of ``heads``
    characters, becomes a term when more toxic documents use it than chance explains (log-likelihood ratio above that of
    the best of all candidates by chance); all such terms stay. Documents of either label whose first use has
    the same ``SIDE`` words before it, or after it, are copies there and count once, with no limit to the count. Words near a term that clean documents use at
    least as often are harmless. Words within ``WINDOW`` of a hit tell of it when more clean than toxic surroundings hold them
    than chance explains, by the same test; those of ``REPORTING`` also count unless toxic surroundings hold them as often.
    Equal surroundings count once. With one label only or none, the model has no terms and answers the labels' share.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = {y: min(1.0, rows_per_label / max(n.get(y, 0), 1)) for y in (0, 1)}
    pick = F.pmod(F.xxhash64("_id", F.lit("toxicity")), F.lit(1 << 30))
    some = known.filter(pick < F.when(F.col("toxic") == 1, int(part[1] * (1 << 30))).otherwise(int(part[0] * (1 << 30))))
    texts = ready(docs).filter("text IS NOT NULL").select("doc_id", "text")
    sample = written(texts.join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic"), "toxicity-sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        p = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
        return Model({}, weights=np.append(np.zeros(N_FEATURES), math.log(p / (1 - p)) if n else -2.0))
    m1, m0 = n[1], n[0]

    def count(batches):
        uses = Uses(heads)

        def held(seen):
            all_ = list(seen[1].keys() | seen[0].keys())
            return pd.DataFrame({"w": all_, "u1": [seen[1].get(w, ()) for w in all_], "u0": [seen[0].get(w, ()) for w in all_]})

        for b in batches:
            seen, size = ({}, {}), 0  # by label and word, the hashes before and after in turn
            for y, t in zip(b["toxic"], b["text"], strict=True):
                own, here = seen[1 if y else 0], uses.of(t)
                for w, sides in here.items():
                    if w in own:
                        own[w] += sides
                    else:
                        own[w] = [*sides]
                size += len(here)
                if size >= 1 << 19:
                    yield held(seen)
                    seen, size = ({}, {}), 0
            yield held(seen)

    def apart(batches):
        for b in batches:
            out = {"w": b["w"]}
            for y in (1, 0):
                sides = [np.concatenate(x).reshape(-1, 2) if len(x) else np.zeros((0, 2), np.int32) for x in b[f"u{y}"]]
                out[f"n{y}"] = [len(x) for x in sides]
                out[f"free{y}"] = [independent(x[:, 0], x[:, 1]) if len(x) > 1 else len(x) for x in sides]
            yield pd.DataFrame(out)

    # a word's uses meet in one row: at most one for each document of the sample
    counts = sample.mapInPandas(count, "w string, u1 array<int>, u0 array<int>").groupBy("w").agg(F.collect_list("u1").alias("u1"), F.collect_list("u0").alias("u0"))
    counts = written(counts.mapInPandas(apart, "w string, n1 long, free1 long, n0 long, free0 long"), "toxicity-words")
    # copies of a text repeat its words with the words around them: documents too are counted without their near copies
    whole = counts.filter("w = ''").first()
    i1, i0 = whole["free1"], whole["free0"]
    counts = counts.filter("w <> ''")
    free, clean = F.least("free1", F.lit(i1)).cast("double"), F.least("free0", F.lit(i0)).cast("double")
    p1, p0 = free / i1, clean / i0
    both = (free + clean) / (i1 + i0)
    llr = free * F.log(p1 / both) + F.when(clean > 0, clean * F.log(p0 / both)).otherwise(0.0)
    some = counts.filter((free >= 3) & (p1 > 3 * p0)).withColumn("llr", llr)
    tries = max(2, counts.filter(free >= 3).count())
    rows = some.filter(F.col("llr") >= math.log(tries)).orderBy(F.desc("llr"), "w").collect()
    # a beginning stands for a family when it tells clearly more than any one word of it; of a family's beginnings the one
    # that tells most stays. Its words stay too: only words are matched with errors
    odds = {r["w"]: math.log((r["n1"] + 0.1) / m1) - math.log((r["n0"] + 0.1) / m0) for r in rows}
    strength = {r["w"]: r["llr"] for r in rows}
    words = [w for w in odds if not w.endswith("*")]
    families: list[str] = []
    for p in sorted((w for w in odds if w.endswith("*")), key=lambda w: (-strength[w], len(w), w)):
        one = max((strength[w] for w in words if w.startswith(p[:-1])), default=0.0)
        if strength[p] > 1.2 * one and not any(p.startswith(f[:-1]) or f.startswith(p[:-1]) for f in families):
            families.append(p)
    terms = {w: odds[w] for w in [*families, *words]}
    model = Model(terms)
    held = sample.sparkSession.sparkContext.broadcast(model)

    def near(batches):
        for b in batches:
            a = held.value.automaton()
            for w, n1, n0 in zip(b["w"], b["n1"], b["n0"], strict=True):
                if not w.endswith("*") and w not in held.value.terms and n0 and n0 / m0 * 3 >= n1 / m1 and (m := a.match(w)) and all(e for _, e in m):
                    yield pd.DataFrame({"w": [w]})

    model.harmless = frozenset(r["w"] for r in counts.filter("n0 > 0").mapInPandas(near, "w string").collect())
    lexicon = sample.sparkSession.sparkContext.broadcast(model)

    def beside(batches):
        for b in batches:
            rows = [(y, n, w) for y, t in zip(b["toxic"], b["text"], strict=True) for n, near in lexicon.value.surroundings(t) for w in near]
            yield pd.DataFrame(rows, columns=["y", "near", "w"]).astype({"y": "int32", "near": "int64"})

    # "" stands for the surroundings themselves
    around = sample.mapInPandas(beside, "y int, near long, w string").distinct().groupBy("w").agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0"))
    around = written(around, "toxicity-around")
    model.telling = telling_words(around)
    final = sample.sparkSession.sparkContext.broadcast(model)

    def feature(batches):
        for b in batches:
            f = np.array([final.value.features(t) for t in b["text"]]).reshape(-1, N_FEATURES)
            yield pd.DataFrame({"y": b["toxic"].astype("int32"), "f": list(f)})

    rows = sample.mapInPandas(feature, "y int, f array<double>").groupBy("y", "f").count().toPandas()
    x, y, k = np.array(rows["f"].tolist()), rows["y"].to_numpy(), rows["count"].to_numpy()
    order = np.lexsort((*x.T, y))
    x, y, k = np.repeat(x[order], k[order], 0), np.repeat(y[order], k[order]), None
    model.weights = logistic(x, y.astype(float))
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the double column ``out`` (0 to 1), from the whole text, however long. A null or empty text, or one
    without a hit, gets the model's base score. Other columns and repeated rows stay as they are; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(t) for t in texts], dtype="float64")

    return ready(docs).withColumn(out, F.pandas_udf(score, "double")(F.col(text)))


def hits(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """One row per hit: doc_id, word, term, distance, context (0 abuse to 1 quotation)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches):
        for b in batches:
            rows = [(i, *h) for i, t in zip(b["doc_id"], b[text], strict=True) for h in (held.value.hits(t) if t else ())]
            yield pd.DataFrame(rows, columns=["doc_id", "word", "term", "distance", "context"]).astype({"doc_id": "Int64", "distance": "int32"})

    return ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInPandas(find, "doc_id long, word string, term string, distance int, context double")
