"""Each stage of the pipeline against a brute-force version over its own input."""

from collections import defaultdict

import pytest
from test_decontaminate import words
from test_lines import slow as slow_lines
from test_mixing import slow_targets
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from monthmill.llm.tables import stored


def test_stages(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, None), (9002, "1234 5678", "en", "src1", 9), (9003, "", None, None, 0)], documents.schema)
    docs = stored(documents.union(extra), "test")
    step = lambda name, given: stored(stages[name](spark, given, folder), "test")
    as_rows = lambda df: {r.doc_id: r for r in df.collect()}

    spoken = step("language ID", docs)
    before, after = as_rows(docs), as_rows(spoken)
    wordless = {k for k, r in before.items() if not any(c.isalpha() for c in r.text or "")}
    assert {9001, 9002, 9003} <= wordless and not wordless & set(after) and len(after) >= 0.99 * (len(before) - len(wordless))
    assert all(after[k] == before[k] for k in after)

    lines = step("line dedup", spoken)
    expected = slow_lines([(k, r.text) for k, r in after.items()])
    found = as_rows(lines)
    assert sorted((k, r.text) for k, r in found.items()) == sorted((k, t) for k, t, _, _ in expected)
    assert all(r.n_chars == len(r.text) for r in found.values())

    single = step("SimHash near-dedup", lines)
    codes = {k: slow_fingerprint(r.text) for k, r in found.items()}
    group = slow_components(codes.values())
    first = {}
    for k in sorted(codes):
        first.setdefault(group[codes[k]], k)
    assert sorted(as_rows(single)) == sorted(first.values())

    clean = step("benchmark decontamination", single)
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    assert min(map(len, windows)) == 10
    left = {k for k, r in as_rows(single).items() if not any(tuple(w[i : i + 10]) in windows for w in [words(r.text)] for i in range(len(w) - 9))}
    assert set(as_rows(clean)) == left and len(left) < single.count()
    for df in (spoken, lines, single, clean):
        assert df.columns == documents.columns

    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in clean.collect():
        sizes[r.source] += len(r.text.split())
        longest[r.source] = max(longest[r.source], len(r.text.split()))
    for r in step("source mixing", clean).collect():
        taken[r.source] += len(r.text.split())
    targets = slow_targets(sizes)
    for source in sizes:
        assert taken[source] == pytest.approx(targets[source], abs=longest[source])


def test_run_is_the_stages_in_order(spark, folder):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "source mixing"]
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "epoch"] and found.count() > 50
