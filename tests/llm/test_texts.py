import html
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from maskframe.llm import html_extract, langid, ngram_join, toxicity
from maskframe.llm import queries as Q

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- operator 3


@pytest.fixture(scope="module")
def html_model(spark):
    return html_extract.fit(html_extract.labelled_pages(spark))


def article(source):
    """The text of the table's own pages, by their known shape."""
    a = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", source or "", re.S)
    s = re.sub(r"<[a-zA-Z/][^<>]*\Z", "", re.sub(r"<br>", " ", a[1])) if a else ""
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", s)]
    return "\n".join(b for b in blocks if b)


def test_op3_on_whole_table(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF2}/pages.parquet").collect()}
    out = Q.op3_html_text(spark, SF2).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_held_out_labelled_pages(spark, html_model):
    runs = wrong = 0
    for r in html_extract.labelled_pages(spark, copies=4, seed=1234).collect():
        truth = html_extract.states(html_extract.Page(r["html"], labelled=True))
        bare = html_extract.Page(re.sub(r' data-label="."', "", r["html"]))
        for t, x, y in zip(bare.texts, truth, html_model.marginals([bare])[0], strict=True):
            if t is not None:
                runs, wrong = runs + 1, wrong + ((y >= 0.5) != (x == 1))
    assert wrong <= 0.06 * runs


def test_marginals_are_exact(html_model):
    """Against the sum over all states of a small tree."""
    from itertools import product

    p = html_extract.Page('<div class="ad"><p>a b</p></div><article><p>Some words. More.</p></article>')
    n, m = len(p.parents), html_model
    none, total, content = np.zeros(3), 0.0, np.zeros(n)
    for x in product(range(3), repeat=n):
        v = m.first[x[0]]
        for i in range(n):
            v += sum((m.seen.get(f, none) for f in p.feats[i]), none)[x[i]]
            v += -40.0 if p.tags[i] == html_extract.RUN and x[i] == 2 else 0.0
            if i:
                v += m.edge.get(p.tags[i], m.edge[""])[x[p.parents[i]], x[i]]
        total += np.exp(v)
        content += np.exp(v) * (np.array(x) == 1)
    assert np.allclose(m.marginals([p])[0], content / total)


def test_html_odd_pages(spark, html_model):
    art = "<article><p>One &amp; two&nbsp;&#233; three,\n  four.</p><p>Five<!-- x --> <i>six</i>.<br>Seven</p><script>if (a < b) {}</script></article>"
    rows = [(1, None), (2, ""), (3, "plain words only, no tags. " * 5), (4, art), (4, art), (5, "<div"), (6, "<article><p>" + "long text. " * 30_000), (7, "<script>never closed <p>x</p>"), (8, "<" * 2000)]
    d = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'old' AS text", "1 AS n_chars")
    out = html_extract.extract(d, html_model).collect()
    by = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and by[1] == by[2] == by[5] == by[7] == ""
    assert by[4] == "One & two é three, four.\nFive six. Seven" and by[6] == ("long text. " * 30_000).strip()
    assert html_extract.extract(d.limit(0), html_model).count() == 0


def test_html_attributes(spark, html_model):
    """Quotes open only after an equals sign; labels of a page's own are none of ours; unfinished markup is not text."""
    long = " ".join(["some words of a main text, and more of them."] * 6)
    cases = {
        f'<article><p class="x"">{long}</p></article>': long,
        f"<article><p title=don't>{long}</p><p>it's two {long}</p></article>": f"{long}\nit's two {long}",
        f'<article><p title="a > b" data-x=\'c > "d\'>{long}</p></article>': long,
        f'<article><p title = "un>quoted" checked>{long}</p><p a=b"c>{long}</p></article>': f"{long}\n{long}",
        f'<article><p data-label="Price">{long}</p><table><tr><td data-label="0">{long}</td></tr></table></article>': f"{long}\n{long}",
        f"<article><p>{long}</p></article><!-- never > closed {long}": long,
        f"<article><p>{long}</p></article><p class='cut": long,
    }
    d = spark.createDataFrame(list(cases), "string").toDF("html")
    got = {r["html"]: r["text"] for r in html_extract.extract(d, html_model).collect()}
    assert got == cases


def test_hostile_markup_is_read_in_linear_time(html_model):
    for s in ("<" * 1_000_000, "<a" * 500_000, "<!" * 500_000, '<a b="' * 200_000, "<script>" * 100_000, "</p>" * 200_000, "<p a='x" * 100_000 + ">", "=" * 1_000_000, "<p " + "=" * 500_000 + ">x", " " * 1_000_000, "&" * 500_000):
        assert isinstance(html_extract.Page(s).texts, list)


# --- operator 4


def crc(i):
    return zlib.crc32(str(i).encode())


def test_op4_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()}
    out = Q.op4_language_id(spark, SF2).collect()
    assert len(out) == len(docs)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_filters_against_sets():
    """Bit-sliced slots return every language that holds a gram (no misses)."""
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, 400).astype(np.uint64) for _ in range(70)]
    table = np.zeros((1 << 16, 2), np.uint64)
    for i, s in enumerate(sets):
        for at in langid.slots(s, 2, 16):
            np.bitwise_or.at(table[:, i // 64], at, np.uint64(1) << np.uint64(i % 64))
    for i, s in enumerate(sets):
        a, b = langid.slots(s, 2, 16)
        assert ((table[a] & table[b])[:, i // 64] & (np.uint64(1) << np.uint64(i % 64))).all()


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the house is on the hill " * 4, "en"), ("la casa está en la colina " * 4, "es")] * 6)] + [(90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string")
    m = langid.fit(train)
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (4, "the hill"), (4, "the hill"), (5, "la colina está " * 40_000), (None, "the house")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS score", "'y' AS lang")
    out = langid.identify(d, m).collect()
    by = {r["doc_id"]: r["language"]["lang"] for r in out}
    assert len(out) == 7 and by == {1: "und", 2: "und", 3: "und", 4: "en", 5: "es", None: "en"}
    empty = langid.fit(train.limit(0))
    assert {r["language"]["lang"] for r in langid.identify(d, empty).collect()} == {"und"}
    assert langid.identify(d.limit(0), m).count() == 0


# --- operator 10


def distance(a, b):
    """Edits that turn a into b; neighbours that change places are one, and are not edited again."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_against_edit_distance():
    terms = ["idiot", "moron", "disgusting", "scum", "worthless", "trashy"]
    a = toxicity.Automaton(terms, ["lowei"], memory=60)
    rng = np.random.default_rng(1)
    words = ["", "loweixyz", "lowei", "lowe"]
    for t in terms:
        for _ in range(150):
            w = list(t)
            for _ in range(int(rng.integers(0, 4))):
                k, c = int(rng.integers(0, len(w) + 1)), chr(97 + int(rng.integers(0, 26)))
                w[k : k + int(rng.integers(0, 2))] = [c] * int(rng.integers(0, 2))
            words.append("".join(w))
            k = int(rng.integers(0, len(t) - 1))
            words += [t[:k] + t[k + 1] + t[k] + t[k + 2 :], t[:k] + t[k + 1] + t[k] + t[k + 2 :][:-1]]
    assert a.match("idoit") == (("idiot", 1),)
    for w in words:
        want = [(t, distance(w, t)) for t in sorted(terms) if distance(w, t) <= toxicity.allowed(t)]
        assert list(a.match(w)) == want + ([("lowei*", 0)] if w.startswith("lowei") else []), w


def test_op10_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF2}/labels.parquet").collect()}
    out = Q.op10_toxicity(spark, SF2).collect()
    assert len(out) == spark.read.parquet(f"{SF2}/documents.parquet").count()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    held = [(r["score"], labels[r["doc_id"]]) for r in out if r["held_out"] and labels.get(r["doc_id"]) is not None]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) >= 0.75


def fitted(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.fit(d.select("doc_id", "text"), d.select("doc_id", "toxic"))


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = np.random.default_rng(2)
    plain = ["alpha", "beta", "gamma", "delta", "house", "river", "cloud", "motor", "colon"]
    rows = []
    for i in range(400):
        w = rng.choice(plain, 30).tolist()
        if i % 4 == 0:
            w[5], w[20] = "moron", ["stupid", "worthless"][i // 4 % 2]
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    return fitted(spark, [*rows, (900, None, 1), (901, "x", None)])


def test_misspelled_and_quoted(spark, toxic_model):
    m = toxic_model
    assert {"moron", "stupid", "worthless"} <= set(m.terms)
    assert m.score("what a moron you are") > 0.5 > m.score("the river and the house")
    assert m.score("what a mor0n and w0rthles fool") > m.score("what a river and cloud")
    assert m.score('they said the word "moron" is a term') < m.score("such a moron in here now")
    rows = [(1, None), (2, ""), (3, "moron " * 50_000), (4, "moron"), (4, "moron"), (None, "house")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS toxicity", "1 AS label")
    out = toxicity.scored(d, m).collect()
    assert len(out) == 6 and all(0 <= r["toxicity"] <= 1 for r in out)
    assert toxicity.scored(d.limit(0), m).count() == 0
    assert {(r["word"], r["distance"]) for r in toxicity.hits(d, m).collect()} == {("moron", 0)}
    assert fitted(spark, [(1, "a", 0), (2, "b", 0)]).score("a") < 0.5 and fitted(spark, []).score("") < 0.5


def test_marks_pair_locally(toxic_model):
    """A mark of inches, a left-over mark or quotations elsewhere do not turn the marks around a term."""
    m = toxic_model
    context = lambda t: [round(c, 2) for _, _, _, c in m.hits(t)]
    for before in ("", '5" pipe and ', 'a " b ', '"one" and "two" then ', "\u00ab un \u00bb et ", 'the 3" and 4" colon '):
        for quoted in ('he remarked "you moron" to me', "he remarked \u201cyou moron\u201d to me", "er rief \u201edu moron\u201c laut", "il cria \u00ab moron \u00bb fort", 'so ("moron"), he added', 'then "a moron!" again'):
            assert context(before + quoted) == [0.7], before + quoted
        for used in ("you moron at home", '"yes" you moron "no"', 'you moron " at home', 'a 5" moron 6" here'):
            assert context(before + used) == [0.0], before + used
    assert m.score('he remarked "you moron" to me') == m.score('a 5" pipe and he remarked "you moron" to me') < 0.5
    assert m.score("you omron") == m.score("you moorn") > m.score("you river")


def test_words_that_tell_of_a_term_are_learned(spark):
    """Clean documents speak of the term beside a word of their own; a word of the list that abuse uses as often is dropped."""
    rng = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(1200):
        w, y = rng.choice(plain, 20).tolist(), i % 2
        w[0] = "word"
        if y and i % 3 == 0:
            w[9:11] = ["scoundrel", "word"]
        if not y and i % 20 == 0:
            w[8:10] = ["glossary", "scoundrel"]
        rows.append((i, " ".join(w), y))
    rows += [(5000 + i, "x glossary scoundrel used w1", 0) for i in range(40)]  # equal surroundings count once
    m = fitted(spark, rows)
    assert "scoundrel" in m.terms
    assert "glossary" in m.telling and "word" not in m.telling and "quoted" in m.telling
    assert not {"used", "w1"} & m.telling
    assert m.score("a w1 w2 glossary scoundrel w3") < m.score("a w1 w2 w3 scoundrel w3")


def test_lexicon_does_not_depend_on_size(spark):
    """Equal rates of use give the same terms at 1,000 and 10,000 documents per label; copies count once."""
    rng = np.random.default_rng(3)
    plain = [f"w{i}" for i in range(40)]
    found = []
    for n in (1000, 10_000):
        rows = []
        for i in range(2 * n):
            w, y = rng.choice(plain, 20).tolist(), i % 2
            k = i // 2 % 1000
            if k < (300 if y else 15):
                w[8] = "scoundrel"
            if k >= 900:  # as many clean documents as toxic ones
                w[12] = "teapot"
            rows.append((i, " ".join(w), y))
        same = rng.choice(plain, 20).tolist()
        for i in range(n // 50):  # near copies in toxic documents only
            w = [*same[:5], "copied", *same[5:]]
            w[int(rng.integers(0, 3))] = str(rng.choice(plain))
            rows.append((10**6 + i, " ".join(w), 1))
        found.append({t for t in fitted(spark, rows).terms if not t.endswith("*")})
    assert found == [{"scoundrel"}, {"scoundrel"}]


def test_independent_uses():
    a = np.array
    assert toxicity.independent(a([1, 2, 3]), a([1, 2, 3])) == 3
    assert toxicity.independent(a([1, 1, 3, 4]), a([5, 6, 6, 7])) == 2
    assert toxicity.independent(np.zeros(500, int), np.arange(500)) == 1


def test_misspelled_family_words(spark):
    """The words of a family whose beginning is a term are still found when the beginning itself is misspelt."""
    rng = np.random.default_rng(9)
    plain = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(600):
        w = rng.choice(plain, 30).tolist()
        if i % 3 == 0:
            w[9] = ["idiot", "idiots", "idiotic"][i // 3 % 3]
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    m = fitted(spark, rows)
    assert any(t.endswith("*") for t in m.terms) and {"idiot", "idiots", "idiotic"} <= set(m.terms)
    for w in ("1diot", "idjot", "ydiots", "idi0tic"):
        assert [(x, d) for x, _, d, _ in m.hits(f"what a {w} here")] == [(w, 1)]
        assert m.score(f"what a {w} here") > m.score("what a house here")


# --- operator 6


def brute_join(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    n, up, twin = [0] * len(rows), {}, {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        twin[a] = rows[a][0]
        for b in range(len(rows)):
            x, y = sets[a], sets[b]
            if a != b and x and len(x & y) >= threshold * len(x | y) - 1e-12:
                n[a] += 1
                p, q = top(rows[a][0]), top(rows[b][0])
                up[max(p, q)] = min(p, q)
                if x == y:
                    twin[a] = min(twin[a], rows[b][0])
    return sorted((r[0], twin[i], top(r[0]), n[i]) for i, r in enumerate(rows))


def near_rows():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = []
    base = [word() for _ in range(120)]
    for _ in range(60):  # one group of near copies, of any similarity
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 5)):
            w[k] = word()
        rows.append(" ".join(w))
    rows += ["one and the same text of some words"] * 25 + ["Short", "short!", "two words", "", "...", " ".join(word() for _ in range(3000))]
    rows += [" ".join(word() for _ in range(50)) for _ in range(40)]
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_join_against_brute_force(spark):
    rows = near_rows()
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, band int, k0 string")
    for tile in (256, 7):
        got = ngram_join.join(d.repartition(5), tile=tile).select("doc_id", "text_class", "class_id", "n_links").collect()
        assert sorted(map(tuple, got)) == brute_join(rows)


def test_join_odd_rows_and_keep_one(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b, c d e f g"), (3, None), (4, ""), (None, "a b c d e f g"), (5, "other words here entirely now")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS class_id", "0 AS _h")
    got = {(r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join(d).collect()}
    assert got == {(1, 1, 2), (2, 1, 2), (3, 3, 0), (4, 4, 0), (5, 5, 0)}
    kept = ngram_join.keep_one(d.drop("_h"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "None"] and kept.columns == ["doc_id", "text", "class_id"]
    assert ngram_join.join(d.limit(0)).count() == ngram_join.keep_one(d.limit(0)).count() == 0


def test_repeated_ids_lose_no_text(spark):
    """An id with two texts is two nodes: a text unlike all others stays, and every group keeps exactly one row."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(2, a + " tail"), (5, a), (5, b), (7, b + " more"), (7, b + " more"), (7, b.upper()), (9, a + " end"), (9, a + " fin")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'u' AS _text", "1 AS _h", "2 AS _gone", "'r' AS root", "true AS first")
    kept = ngram_join.keep_one(d)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, a + " tail"), (5, b)]
    assert {(r["doc_id"], r["class_id"]) for r in ngram_join.join(d).collect()} == {(2, 2), (5, 2), (5, 5), (7, 5), (9, 2)}
    same = spark.createDataFrame([(1, a), (1, a + " x"), (1, a.replace(" ", ", ")), (1, a)], "doc_id long, text string")
    assert ngram_join.keep_one(same).count() == 1


def test_bands():
    for s in (0.5, 0.8, 0.95):
        b, r = ngram_join.bands_for(s, 0.999)
        assert 1 - (1 - s**r) ** b >= 0.999 and b * r <= 160


def test_op6_is_the_brute_force_join(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, Q.op6_ngram_join(spark, SF).collect())) == brute_join(rows)


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == first.columns, name
        docs = spark.createDataFrame(out.collect(), first.schema)
        assert docs.count() > 0
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    kept = P.near_duplicates(spark, first, SF).collect()
    want = defaultdict(list)
    for i, _, c, _ in brute_join([(r["doc_id"], r["text"]) for r in first.collect()]):
        want[c].append(i)
    assert sorted(r["doc_id"] for r in kept) == sorted(want)
    assert len(P.run(spark, SF).collect()) == len(packed)


def test_pipeline_empty(spark):
    import corpus_pipeline as P

    docs = spark.createDataFrame([], DOCS)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
