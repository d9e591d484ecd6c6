"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import CLASHES, prose
from voltlake.llm import lexical_search
from voltlake.llm.lexical_search import Best, Queries, search, search_block

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, k=20):
    """(item_id, rank, doc_id, score), sorted."""
    words = lambda t: TERM.findall((t or "").translate(LOWER))
    docs = [(i, Counter(words(t))) for i, t in rows if words(t)]
    df = Counter(t for _, c in docs for t in c)
    total = sum(sum(c.values()) for _, c in docs)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in docs:
            m = 100 - 25 + (25 * sum(c.values()) * len(docs)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in words(text)
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def results(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


def both(spark, docs, items, **settings):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    return results(search(docs, items, **settings))


def test_test_tables(spark, sf, plain):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute(plain, [(r["item_id"], r["text"]) for r in items.collect()])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert results(search(docs, items)) == want
    assert results(search(docs, items, query_bytes=2_000)) == want


def test_awkward_rows(spark, awkward, nothing):
    items = [
        (1, prose(1, 20)),
        (1, prose(3, 12)),
        (2, None),
        (3, "..."),
        (4, "no no no 日本語のテキスト"),
        (5, "x" * 150_000),
        (6, "never seen at all zzz"),
        (None, "Mail EXAMPLE com"),
        (7, prose(1, 20)),
        (7, prose(1, 20)),
    ]
    extra = spark.createDataFrame([(None, prose(1, 40), *CLASHES), (90, "É é İ ı ß \x00a\x7fb", *CLASHES)], ["doc_id", "text", *CLASHES])
    docs = awkward.select("doc_id", "text", *CLASHES).unionByName(extra)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items += [(8, "é ı A b İ"), (9, "tion the on er")]
    assert both(spark, docs, items) == brute(rows, items)
    assert both(spark, docs, items, k=2) == brute(rows, items, k=2)
    assert both(spark, nothing, items) == []
    assert both(spark, awkward, []) == []


@pytest.fixture(scope="module")
def held(spark):
    rows = [(i, prose(i % 300, 20 + i % 60)) for i in range(1_500)]
    rows += [(5_000 + i, prose(i % 7, 3_000)) for i in range(20)]
    blocks = lexical_search.index(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    items = [(k, prose(10_000 + k, 12)) for k in range(30)] + [(100 + k, rows[k][1]) for k in range(30)]
    queries = Queries([(i, t, 1) for i, t in items])
    lengths = [n for b in blocks for n in b["lengths"]]
    found = Counter(
        queries.number[t] for b in blocks for own in b["terms"] for t in bytes(own).split(b" ") if t in queries.number
    )
    queries.weigh(len(lengths), sum(lengths), found)
    return rows, items, blocks, queries


def as_row(block):
    row = block.asDict()
    return row | {"slices": bytes(row["slices"]), "terms": [bytes(t) for t in row["terms"]], "counts": [bytes(c) for c in row["counts"]]}


def test_no_score_is_above_its_bound(held):
    rows, items, blocks, queries = held
    exact = {(i, d): s for i, _, d, s in brute(rows, items, k=10**9)}
    for block in map(as_row, blocks):
        slices = np.frombuffer(block["slices"], dtype=np.uint8).reshape(block["bits"], -1)
        for group in queries.groups:
            upper = lexical_search.bounds(queries, group, slices, np.array(block["lengths"]), np.array(block["most"]))
            for k, at in enumerate(group):
                for doc, bound in zip(block["doc_ids"], upper[k], strict=True):
                    assert exact.get((items[at][0], doc), 0) <= bound


def test_blocks_in_any_order_give_the_best_documents_and_leave_most_unscored(held):
    rows, items, blocks, queries = held
    want = brute(rows, items, k=5)
    for order in (blocks, blocks[::-1]):
        best, scored = Best(len(items), 5, None), 0
        for block in order:
            scored += search_block(queries, best, as_row(block))
        got = [
            (items[at][0], n + 1, doc, -score) for at, own in enumerate(best.rows) for n, (score, _, doc) in enumerate(own)
        ]
        assert sorted(got, key=repr) == want
        assert scored <= len(rows)
    few = Queries([(101, items[31][1], 1)])
    found = Counter(few.number[t] for b in blocks for own in b["terms"] for t in bytes(own).split(b" ") if t in few.number)
    lengths = [n for b in blocks for n in b["lengths"]]
    few.weigh(len(lengths), sum(lengths), found)
    best = Best(1, 5, None)
    assert sum(search_block(few, best, as_row(b)) for b in blocks) < len(rows) * 0.6
