"""The pipeline against brute force, stage by stage on awkward rows, and what the package may not do."""

import ast
from collections import Counter
from pathlib import Path

import corpus_pipeline
import voltlake
from tests.llm.test_copies import brute_components, brute_print
from voltlake.llm import decontaminate
from voltlake.llm.queries import ORACLES, QUERIES, tokenizer


def test_pipeline_against_brute_force(spark, sf, plain):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer())
    rows = {i: t for i, t in plain if any(c.isalpha() for c in t)}
    rows = {i: t for t, i in sorted((t, i) for i, t in rows.items())}
    last = {t: i for i, t in sorted(rows.items())}
    rows = {i: t for i, t in sorted(rows.items()) if last[t] == i}
    ids = list(rows)
    roots = brute_components([brute_print(rows[i]) for i in ids])
    rows = {ids[k]: rows[ids[k]] for k in sorted(set(roots))}
    items = decontaminate.Items([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows.items() if not items.tiles(t)}
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_stages_on_awkward_rows(spark, awkward, nothing, sf, tmp_path):
    for start, docs in (("awkward", awkward), ("nothing", nothing)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.schema == docs.schema
            out.write.parquet(str(tmp_path / f"{start}-{name}"))
            before, docs = docs, spark.read.parquet(str(tmp_path / f"{start}-{name}"))
            kept = Counter(r["doc_id"] for r in docs.collect())
            assert not kept - Counter(r["doc_id"] for r in before.collect())
        assert docs.isEmpty() == (start == "nothing")


def test_every_operator_is_registered_once():
    numbers = Counter(n.split("_")[0] for n in QUERIES)
    assert numbers == Counter(f"op{k}" for k in range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()


def test_nothing_else_imports_the_package():
    root = Path(voltlake.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            names = [
                a.name if isinstance(n, ast.Import) else n.module or ""
                for n in ast.walk(ast.parse(path.read_text()))
                if isinstance(n, ast.Import | ast.ImportFrom)
                for a in n.names
            ]
            assert not any(".llm" in n for n in names), path
