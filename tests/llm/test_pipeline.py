import ast
import pathlib
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from test_quality_urls import brute_kept, brute_measures
from test_simhash import brute_components, brute_fingerprint
from test_tokens import FILES, check_packing, ids_of

import corpus_pipeline
from millrace.llm import toxicity
from millrace.llm.queries import ORACLES, QUERIES

ROOT = pathlib.Path(corpus_pipeline.__file__).parent


def test_run_matches_brute_force(spark, sf_dir, documents):
    good = [(i, t) for i, t in documents if brute_kept(brute_measures(t))]
    frame = spark.createDataFrame(good, "doc_id long, text string")
    # The grammar is learned from the rows that the first stage keeps, and is applied here text by text.
    grammar = toxicity.learn(frame, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.train_rows())
    clean = [(i, t) for i, t in good if grammar.score(grammar.evidence(t)) < 0.3]
    groups = set(brute_components([(i, brute_fingerprint(t)) for i, t in clean], 2))
    want = {i: ids_of(FILES[1], t) for i, t in clean if i in groups}
    rows = [tuple(r) for r in QUERIES["pipeline"](spark, sf_dir).collect()]
    assert 0 < len(want) < len(clean) < len(good) < len(documents)
    check_packing(rows, want, 4096)


def test_stages_keep_the_columns(spark, sf_dir, edge):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.schema == docs.schema, name
        assert got.exceptAll(docs).count() == 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = corpus_pipeline.toxicity_stage(spark, docs, sf_dir).select("doc_id")
    clean = labels.filter("toxic = 0").join(docs, "doc_id", "left_semi")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_eleven_queries():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted([f"op{i}" for i in range(1, 11)] + ["pipeline"])
    assert set(ORACLES) < set(QUERIES)


def test_nothing_else_imports_this():
    for path in [*ROOT.glob("millrace/**/*.py"), *ROOT.glob("fixtures/*.py"), *ROOT.glob("*.py")]:
        own = "llm" in path.relative_to(ROOT).parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py")
        names = [getattr(n, "module", None) or "" for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.ImportFrom)]
        assert own or not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


def test_no_forbidden_calls():
    for path in [*ROOT.glob("millrace/llm/*.py"), ROOT / "corpus_pipeline.py"]:
        text = path.read_text()
        for word in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "F.rand(", "except ImportError"):
            assert word not in text, (path.name, word)


def test_split_follows_the_id(spark):
    ids = spark.range(50).select("id", toxicity.remainder(F.col("id"), 4).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in ids)
    assert public_tokenizers.path("word_bpe_49k.json") == FILES[1]
