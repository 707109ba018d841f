"""Registered queries against SQL, the pipeline stage by stage, the guard."""

import hashlib
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from llm_helpers import documents, words
from test_llm_simhash import brute_fingerprint, brute_groups
from test_llm_substring import brute

import __spark_entry__
import corpus_pipeline
from demandcast.llm import mixing, queries
from demandcast.llm import sentencepiece_bpe as S
from demandcast.llm.common import Scratch, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
TABLES = ["documents", "embeddings", "pages", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, cur.fetchall()))


def test_queries_are_registered():
    known = __spark_entry__.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in known) == 1 for n in range(1, 14)) and "pipeline" in known


def test_pipeline_stages(spark):
    scratch = Scratch(spark, "t")
    docs = table(spark, SF, "documents")
    before = docs.collect()
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.write(stage(spark, docs, SF), name)
        if name != "token_ids":
            assert out.dtypes == docs.dtypes
        after[name] = out.collect()
        docs = out
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after["quality"]}
    judged = [r.doc_id for r in before if r.doc_id in labels]
    assert sum((i in kept) == bool(labels[i]) for i in judged) >= 0.97 * len(judged)

    fps = {r.doc_id: brute_fingerprint(r.text) for r in after["quality"]}
    roots = brute_groups(fps.values())
    first = {}
    for i, f in sorted(fps.items()):
        first.setdefault(roots[f], i)
    assert sorted(r.doc_id for r in after["near_copies"]) == sorted(first.values())

    cut = {r.doc_id: words(r.text) for r in after["repeated_passages"]}
    for i, _, gone, left in brute(sorted((r.doc_id, r.text) for r in after["near_copies"])):
        assert cut.get(i, []) == left if gone else i in cut

    rates = {r._source: r._rate for r in mixing.source_rates(spark.createDataFrame(after["repeated_passages"]), scratch).collect()}
    assert abs(sum(rates[r.source] for r in after["repeated_passages"]) - len(cut)) < 1e-6
    texts = {r.doc_id: r.text for r in after["repeated_passages"]}
    assert all(texts[r.doc_id] == r.text for r in after["mixed"])

    library = S.agenda_for(S.default_model()).library
    want = sorted((r.doc_id, len(ids := library.encode(r.text)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for r in after["mixed"])
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in after["token_ids"]) == want
    assert corpus_pipeline.run(spark, SF).count() == len(want)


def test_pipeline_of_nothing(spark):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "t").write(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['demandcast.llm'] = None\n"
            "import importlib.abc\n"
            "import __spark_entry__ as e\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'demandcast.llm'): raise ModuleNotFoundError(name, name=name)\n"
            "del sys.modules['demandcast.llm']; sys.meta_path.insert(0, Gone())\n"
            "assert 'weekly_features' in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
            "assert 'weekly_features' in e.oracle_sql()")
    root = Path(__file__).resolve().parents[2]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
