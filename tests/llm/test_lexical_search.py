"""Ranked lexical search against a plain full scoring of every document."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from daybook.llm import lexical_search
from daybook.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """Every document scored for every item, as the contract says."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        asked, scores = words(text), []
        for i, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_terms():
    text = "Größe ÀB_c a1-B2\x7fx y 日本語 Zz퟿ _ 9"
    assert [t.decode() for t in lexical_search.terms(text)] == words(text)
    assert lexical_search.terms(None) == [] == lexical_search.terms("-- __ \n")


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed, monkeypatch):
    """Small segments, so that skipping, leaving out and pair lists all take part."""
    monkeypatch.setattr(lexical_search, "SEGMENT_DOCS", 50)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "LONG" + "x" * 400]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(900)]
    docs += [(i, docs[3][1]) for i in range(900, 940)] + [docs[3], (None, docs[3][1]), (941, None), (942, " .. ")]
    items = [(i, text(rng.randrange(1, 25))) for i in range(40)] + [
        (50, None), (51, ""), (52, "nowhere"), (53, "w1 w1 w1 w2 w2"), (53, "w1 w1 w1 w2 w2"), (54, "w40"),
        (54, "w41 w42"), (None, "w7"), (55, docs[3][1])]
    got = lexical_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 score", "'x' terms").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 rank"))
    assert found(got) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    """Items in several blocks give the same rows."""
    docs = [(i, f"alpha beta{i % 3} gamma{i % 5} delta") for i in range(40)]
    items = [(i, f"beta{i % 3} gamma{i % 5}") for i in range(9)]
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 5)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(lexical_search.search(d, i)) == brute(docs, items)


def test_pair_bounds_hold_and_skip(spark):
    """Bounds are never under a document's share, and pairs make them tighter."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["a", "b", "c", "d", "e"], k=rng.randrange(1, 9)))) for i in range(300)]
    docs += [(300 + i, "a a a a") for i in range(5)] + [(400 + i, "b b b b") for i in range(5)]
    item = Counter({b"a": 2, b"b": 1, b"c": 1})
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    table = lexical_search.segments(df, [b"a", b"b", b"c"], "doc_id", "text")
    n, length, counts = lexical_search.statistics(table)
    weights = {t: lexical_search.weight(n, x) for t, x in counts.items()}
    pairs = lexical_search.item_pairs([item], weights)
    sent = spark.sparkContext.broadcast((n, length, weights, pairs))
    rows = (table.select("doc_ids", "lengths", "terms", "ends", "places", "tfs")
            .mapInArrow(lexical_search._impacts(sent), lexical_search._INDEX).collect())
    asked = sorted(((t, q) for t, q in item.items()), key=lambda x: (-weights[x[0]], x[0]))
    tighter = 0
    for row in rows:
        segment = lexical_search.Segment(row.asDict(recursive=True))
        chosen = lexical_search.units(segment, asked)
        alone = sum(q * segment.top[segment.number[t]] for t, q in asked if t in segment.number)
        tighter += sum(b for b, _ in chosen) < alone
        at, scores = lexical_search.search_segment(segment, asked, 1)
        assert scores.max() <= sum(b for b, _ in chosen)
        for floor in sorted(set(scores.tolist()))[::20]:
            some, again = lexical_search.search_segment(segment, asked, floor)
            assert dict(zip(some.tolist(), again.tolist())) == {
                a: s for a, s in zip(at.tolist(), scores.tolist()) if s >= floor}
    assert tighter


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical_search.search(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert lexical_search.search(some, items.limit(0)).collect() == []
    assert found(lexical_search.search(some, items)) == brute([(1, "a b")], [(1, "a b")])


def test_query_against_brute_force_and_sql(spark):
    got = found(QUERIES["op12_lexical_search"](spark, SF_SMALL))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    assert got == brute(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    rows = con.sql(ORACLE["op12_lexical_search"])
    at = [rows.columns.index(c) for c in ("item_id", "rank", "doc_id", "score")]
    assert sorted((tuple(r[i] for i in at) for r in rows.fetchall()), key=str) == got
