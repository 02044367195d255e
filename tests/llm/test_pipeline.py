"""The pipeline, stage by stage, against brute force; and the queries' SQL."""

import re
import zlib
from collections import Counter

import pytest

llm = pytest.importorskip("loomspark.llm")
import corpus_pipeline  # noqa: E402
from loomspark.llm import mixing, packing, quality, queries  # noqa: E402
from loomspark.llm._common import stage  # noqa: E402
from tests.llm.test_models_and_duplicates import brute, measured  # noqa: E402
from tests.llm.test_native_and_packing import check_packing, drop_brute, words  # noqa: E402
from tests.oracle import compare  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    before, kept = rows_of(docs), None
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near dedup", "source mix", "packing"]
    for name, function in corpus_pipeline.STAGES:
        kept = stage(function(spark, docs, sf), "test")
        after = kept.collect()
        if name != "packing":
            assert tuple(kept.columns) == COLUMNS
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "quality rules":
            rules = quality.fit(stage(quality.statistics(docs), "test"), labels)
            verdict = {r.doc_id: r.rule for r in quality.statistics(docs).withColumn("rule", quality.verdict(rules)).collect()}

            def good(i, t, verdict=verdict):
                n, _, _, _, repeat = measured(t)
                return n >= 50 and 100 * repeat <= 50 * n and verdict[i] is None

            assert Counter(r.doc_id for r in after) == Counter(i for i, t, _, _ in before if good(i, t))
        if name == "line dedup":
            drop = drop_brute(before)
            assert Counter((r.doc_id, r.text) for r in after) == Counter((i, "\n".join(x for x in t.split("\n") if x.strip(" ") not in drop)) for i, t, _, _ in before)
        if name == "near dedup":
            _, root, sets = brute(before, 5, 80, 100)
            least = {}
            for i, r in root.items():
                least[r] = min(least.get(r, before[i][0]), before[i][0])
            want = Counter(least[r] for r in {r for i, r in root.items() if sets[i]}) + Counter(before[i][0] for i in root if not sets[i])
            assert Counter(r.doc_id for r in after) == want
        if name == "source mix":
            taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(docs).collect()}
            assert Counter(r.doc_id for r in after) == Counter({i: int(t / max(s, 1) + 0.5) for i, (t, s) in taken.items() if int(t / max(s, 1) + 0.5)})
        if name == "packing":
            encode = packing.encoder(packing.default_vocabulary())
            lengths = Counter((i, len(encode([t])[0]) + 1) for i, t, _, _ in before)
            got = Counter()
            for r in after:
                got[r.doc_id] += r.length
            assert got == sum((Counter({i: n * k}) for (i, n), k in lengths.items()), Counter())
            check_packing(after)
        docs, before = kept, [] if name == "packing" else [(r.doc_id, r.text, r.lang, r.source) for r in after]


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name])


def test_alike_rows_are_mixed_together(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 4 + [(2, "e f g h", "en", "s", 7), (3, None, None, None, 0), (4, "", "en", "t", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = Counter(r.doc_id for r in mixing.mixed_documents(df, (1,), (1, 1)).collect())
    assert out == Counter({1: 4, 2: 1})
    assert mixing.mixed_documents(df.limit(0)).collect() == []
