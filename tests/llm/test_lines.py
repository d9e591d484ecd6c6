"""Line dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm.conftest import CLASHES, prose
from voltlake.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, kept text) of every (doc_id, text)."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(float("-inf") if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        me = float("-inf") if doc_id is None else doc_id
        stays = [len(holders[key(x)]) < min_docs or max(holders[key(x)]) == me for x in lines]
        left = "\n".join(x for x, s in zip(lines, stays, strict=True) if s)
        out.append((doc_id, len(lines), stays.count(False), left))
    return sorted(out, key=repr)


def shared_lines(n, seed=7):
    """Documents of some of a few lines, one of them in every second, and lines of their own."""
    rng = random.Random(seed)
    pool = [prose(1000 + k, 9) for k in range(40)]
    rows = []
    for doc in range(n):
        lines = [rng.choice(pool) for _ in range(rng.randrange(6))] + [prose(5000 + doc, 12)]
        if doc % 2:
            lines += [" \t" + pool[0].upper() + "\x0b"] * rng.randrange(1, 4)
        rng.shuffle(lines)
        rows.append((doc if doc % 17 else doc // 2, "\n".join(lines)))
    return rows


def results(rows):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("partitions", ["1", "23", "200"])
def test_against_brute_force_over_many_tasks(spark, partitions):
    rows = shared_lines(400)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    settings = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = results(line_dedup.drop_repeated_lines(docs))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 400


def test_awkward_rows(spark, awkward, nothing):
    line = prose(77, 30)
    cases = [
        (i, t)
        for i, t in [
            *((k, f"{line}\n\n{line.upper()}\r\n") for k in (20, 21, 22, 22, 23, None)),
            (24, "\n" * 5_000 + line),
            (25, "\n".join([line] * 50_000)),
            (26, line[:39]),
            *((30 + k, line[:39]) for k in range(6)),
            *((40 + k, "é" * 40) for k in range(4)),
            *((50 + k, "ß" * 39 + "Ä" + " ") for k in range(5)),
        ]
    ]
    extra = spark.createDataFrame([(i, t, *CLASHES) for i, t in cases], ["doc_id", "text", *CLASHES])
    docs = awkward.select("doc_id", "text", *CLASHES).unionByName(extra)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = results(line_dedup.drop_repeated_lines(docs))
    assert got == brute(rows)
    assert line_dedup.drop_repeated_lines(nothing).isEmpty()


def test_bitmaps_name_the_lines_to_keep(spark):
    line = prose(3, 20)
    rows = [(k, "\n".join(["a"] * k + [line] + ["b"])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bitmaps = {r["doc"]: (r["n_dropped"], r["keep"]) for r in line_dedup.keep_bitmaps(docs).collect()}
    assert sorted(bitmaps) == list(range(11))
    for doc, (dropped, keep) in bitmaps.items():
        assert dropped == 1 and len(keep) < 40
        assert line_dedup.kept(rows[doc][1], bytes(keep)) == "\n".join(["a"] * doc + ["b"])


def test_query_on_test_tables(spark, sf, plain):
    from voltlake.llm.queries import op13_line_dedup

    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(plain)}
    assert {tuple(r) for r in op13_line_dedup(spark, sf).collect()} == want
