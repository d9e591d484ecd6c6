"""Sharding, exact dedup and SimHash against SQL and brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks.compare import connect
from tests.llm.conftest import prose, row
from tests.llm.conftest import SCHEMA
from voltlake.llm import chunk_dedup, sharding, simhash
from voltlake.llm.components import components
from voltlake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op2_sharding", "op5_chunk_dedup"])
def test_matches_sql(spark, sf, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    want = connect(sf).execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want)


def test_shards_of_awkward_rows(awkward):
    got = sharding.shard_by_bytes(awkward, shards=4).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in awkward.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(want)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r)
    for rows in by_shard.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    spans = [
        [-(10**9) if r["doc_id"] is None else r["doc_id"] for r in rows] for _, rows in sorted(by_shard.items())
    ]
    assert all(max(a) <= min(b) for a, b in zip(spans, spans[1:], strict=False))


def test_one_doc_id_for_all_rows(spark):
    rows = [row(7, prose(k, 5)) for k in range(400)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA)).groupBy("shard").agg(F.sum("size")).collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 200


def test_empty_tables(nothing):
    assert sharding.shard_by_bytes(nothing).isEmpty()
    assert chunk_dedup.copy_groups(nothing).isEmpty()
    assert chunk_dedup.drop_copies(nothing).isEmpty()
    assert simhash.near_duplicates(nothing).isEmpty()
    assert simhash.drop_near_duplicates(nothing).isEmpty()


def groups_of(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["text"] or ""].append(r["doc_id"])
    return out


WEAK = [lambda chunk: F.length(chunk) % 3, lambda chunk: F.substring(chunk, 1, 1)]


@pytest.mark.parametrize("digests", [chunk_dedup.DIGESTS, WEAK, [*WEAK, chunk_dedup.short_digest]])
def test_copy_groups(awkward, digests):
    groups = groups_of(awkward.collect())
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    import hashlib

    want = Counter(
        (i, keep[t], len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids
    )
    got = chunk_dedup.copy_groups(awkward, digests).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter({w[3]: 1 for w in want})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_chunks_put_together_are_the_text(awkward):
    lost = awkward.where(F.array_join(chunk_dedup.chunks(F.col("text")), "") != F.col("text"))
    assert lost.isEmpty()


@pytest.mark.parametrize("digests", [chunk_dedup.DIGESTS, WEAK])
def test_drop_copies(awkward, digests):
    got = chunk_dedup.drop_copies(awkward, digests)
    assert got.schema == awkward.schema
    groups = groups_of(awkward.collect())
    want = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert sorted(((r["text"] or "", r["doc_id"]) for r in got.collect()), key=repr) == sorted(want.items(), key=repr)


def test_native_operators_have_no_python(spark, sf):
    for name in ("op2_sharding", "op5_chunk_dedup"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def test_op6_against_brute_force(spark, sf, plain):
    rows = sorted(plain)
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    want = {i: (f"{p:016x}", rows[r][0]) for (i, _), p, r in zip(rows, prints, roots, strict=True)}
    got = QUERIES["op6_simhash"](spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want


def test_near_duplicates_of_awkward_rows(awkward):
    rows = awkward.collect()
    prints = [brute_print(r["text"]) for r in rows]
    roots = brute_components(prints)
    least = defaultdict(lambda: None)
    for r, k in zip(rows, roots, strict=True):
        least[k] = min((i for i in (least[k], r["doc_id"]) if i is not None), default=None)
    want = Counter((r["doc_id"], f"{p:016x}", least[k]) for r, p, k in zip(rows, prints, roots, strict=True))
    got = simhash.near_duplicates(awkward).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.schema == awkward.schema
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(least[k] for k in set(roots))


@pytest.mark.parametrize("node, depth", [(1 << 20, 4), (40, 2), (5, 0), (1, 6)])
def test_trie_join_finds_every_link(spark, node, depth):
    rng = np.random.default_rng(depth)
    centers = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    values = {int(c) for c in centers} | {0, (1 << 64) - 1}
    for c in centers[:40]:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in flips))
    values |= {int(centers[0]) >> 20 << 20 | k for k in range(150)}  # a crowded corner
    values = sorted(values)
    prints = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp bigint")
    forest = simhash.similar_pairs_forest(prints, node=node, least_depth=depth)
    got = {simhash.signed(v): simhash.signed(v) for v in values}
    got |= {r["node"]: r["root"] for r in components(forest).collect()}
    by_root = defaultdict(set)
    for v, r in got.items():
        by_root[r].add(v)
    want = defaultdict(set)
    for v, r in zip(values, brute_components(values), strict=True):
        want[r].add(simhash.signed(v))
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(60)]
    hub = [(1000, 1000 + k) for k in range(1, 200)]
    links = spark.createDataFrame([*chain, *hub, (5, 5), (3, 2)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {1000 + k: 1000 for k in range(1, 200)}
    assert components(links.limit(0)).isEmpty()
