"""Short benchmark items, and blocks of a benchmark with repeated items."""

import random
import time
from collections import Counter

import pytest

from tests.llm.conftest import SCHEMA, prose, row
from tests.llm.test_models import brute_tiles
from voltlake.llm import decontaminate

SCHEMA_OF_ITEMS = "item_id bigint, text string"


def test_short_items_are_found_where_they_occur_whole(spark):
    items = [(1, "Who was Ada?"), (2, "forty-two"), (3, "Paris"), (4, "..."), (5, prose(7, 12))]
    texts = [
        "Tell me: who, was ADA",
        "forty times two is not forty",
        "it is forty two",
        "was Ada who",
        f"in paris {prose(7, 12)}",
        "Parisian",
    ]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], SCHEMA)
    benchmark = spark.createDataFrame(items, SCHEMA_OF_ITEMS)
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert {tuple(r) for r in got} == {(0, 1, 1.0, 1), (2, 2, 1.0, 1), (4, 3, 1.0, 1), (4, 5, 1.0, 1)}
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 5}


def test_blocks_hold_a_repeated_item_once_and_are_within_their_size(spark):
    texts = [prose(100 + k, 12) for k in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0])] * 500 + [(77, prose(5, 400)), (78, None)]
    benchmark = spark.createDataFrame(rows, SCHEMA_OF_ITEMS)
    blocks = list(decontaminate.benchmark_blocks(benchmark, 1000))
    assert sum(len(b.ids) for b in blocks) == 41
    sizes = [sum(len(dict(rows)[i]) for i in b.ids) for b in blocks]
    assert all(s <= 1000 or len(b.ids) == 1 for s, b in zip(sizes, blocks, strict=True))
    docs = spark.createDataFrame([row(1, texts[0]), row(2, texts[3])], SCHEMA)
    got = Counter(tuple(r)[:2] for r in decontaminate.contaminated(docs, benchmark, block_bytes=1000).collect())
    assert got == {(1, 0): 501, (2, 3): 1}


def test_texts_are_sifted_once_for_many_blocks(spark):
    items = [(k, prose(200 + k, 12)) for k in range(30)] + [(90, "Who was Ada?"), (91, "x"), (92, None), (93, "")]
    texts = [f"{prose(k, 40)} {items[k % 30][1]} {prose(k + 1, 9)}" if k % 4 == 0 else prose(1000 + k, 50) for k in range(80)]
    texts += ["He asked: WHO was (ada)", None, "", "an x. Or y"]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], SCHEMA)
    benchmark = spark.createDataFrame(items, SCHEMA_OF_ITEMS)
    one = decontaminate.contaminated(docs, benchmark)
    many = decontaminate.contaminated(docs, benchmark, block_bytes=300)
    assert len(list(decontaminate.benchmark_blocks(benchmark, 300))) > 5
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    seeds = decontaminate.Seeds()
    for block in decontaminate.benchmark_blocks(benchmark, 300):
        seeds.add(block)
    held = {r["doc_id"] for r in one.collect()}
    assert len(held) == 22 and all(seeds.may_hold(texts[k]) for k in held)
    scanned = many.inputFiles()
    assert scanned and all("seeded" in f for f in scanned)


def test_tiles_of_repetitive_texts_as_defined():
    rng = random.Random(4)
    for k in range(150):
        letters = "ab" if k % 2 else "abcd"
        item = " ".join(rng.choices(letters, k=rng.randrange(5, 40)))
        text = " ".join(rng.choices(letters + "x" * (k % 3), k=rng.randrange(90)))
        if k % 5 == 0:
            text += " " + " ".join([item[: len(item) // 2 * 2 // 2], "x", item[len(item) // 2 :].strip()])
        want = brute_tiles(text, item)
        found = decontaminate.Items([(1, item)], coverage=0.0).tiles(text)
        assert (found[0][1] if found else 0) == pytest.approx(want)


def test_long_repetitions_stay_small():
    start = time.perf_counter()
    items = decontaminate.Items([(1, "a " * 2_000), (2, "a b " * 1_000), (3, "a a b " * 300)])
    assert items.tiles("a " * 200_000) == [(1, 1.0, 1)]
    assert {i for i, *_ in items.tiles("a a b " * 60_000)} == {3}
    assert time.perf_counter() - start < 10
