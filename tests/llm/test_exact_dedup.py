import hashlib
import re

import pytest

from maskframe.llm import exact_dedup
from maskframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, digest string, _digest string, key int, row int, best string, group_size string, _key string"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(doc_id, keep_id, group_size, sha) of all rows and the number of rows that stay by group."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out, keep = [], {}
    for t, ids in groups.items():
        some = [i for i in ids if i is not None]
        keep[t] = min(some) if some else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep[t], len(ids), sha) for i in ids]
    return out, keep


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def hostile():
    long = "word " * 200_000
    rows = [(i, "the same page over and over") for i in range(500, 900)]  # a third of all rows
    rows += [(1000 + i, f"text {i % 150}") for i in range(300)]
    rows += [(7, "a  b\t\n c"), (3, "a b c"), (3, "a b c"), (3, "a\x0bb\x0cc"), (9, "a b c"), (None, "a b c")]
    rows += [(20, None), (21, ""), (22, " "), (23, "\n\n\t "), (None, None), (None, "only nulls"), (None, "only nulls"), (24, "A b c")]
    rows += [(30, long), (31, long + " "), (32, long.strip()), (33, " " * 1_000_000), (34, "\n" * 1_000_000), (35, "é\U0001f600"), (36, "é\U0001f600")]
    return rows


@pytest.mark.parametrize("support", [0.25, 0.01, 0.0001])
def test_memberships_and_rows_that_stay(spark, support):
    rows = hostile()
    docs = spark.createDataFrame([(i, t, "d", "u", 1, 2, "b", None, "k") for i, t in rows], DOCS).repartition(7)
    got = exact_dedup.memberships(docs, support=support).collect()
    want, keep = brute(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=key) == sorted(want, key=key)
    stay = [r for r in got if r["kept"]]
    assert len(stay) == len(keep) and len({r["text_sha256"] for r in stay}) == len(keep) and all(r["doc_id"] == r["keep_id"] for r in stay)
    left = exact_dedup.keep_first(docs, support=support)
    assert left.columns == docs.columns
    assert sorted([(normal(r["text"]), r["doc_id"]) for r in left.collect()], key=key) == sorted(keep.items(), key=key)


def test_empty_table_and_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact_dedup.memberships(docs).count() == 0
    assert exact_dedup.keep_first(docs).count() == 0
    plan = Q.op13_exact_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "Cartesian" not in plan


def test_frequent_digests_are_all_named_and_bounded(spark):
    rows = spark.range(20_000).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN -1 WHEN id % 50 = 1 THEN -2 ELSE id END AS STRING) AS digest").repartition(23)
    named = [r["digest"] for r in exact_dedup.frequent(rows, "digest", 0.01).collect()]
    assert len(named) <= 100 and {"-1", "-2"} <= set(named)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Q.op13_exact_dedup(spark, SF).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == sorted(brute(docs)[0])
