"""The pipeline's stages against plain Python over the rows that each predecessor kept."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from prospectra.llm import toxicity
from prospectra.llm.common import materialize, table

from ..conftest import SF
from .helpers import texts
from .test_dedup import near_want, sets_of
from .test_text_operators import align_want, tokenizer


def bare(t):
    return "".join(c if c.isalnum() or c.isspace() else " " for c in t).lower().split()


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert name == "bpe" or docs.columns == columns
    text = dict(texts(SF))
    # Toxicity: the threshold on the operator's own scores.
    weights, bias = toxicity.fit(table(spark, SF, "documents"), toxicity.training_labels(table(spark, SF, "labels")))
    bad = {r.doc_id for r in toxicity.scores(table(spark, SF, "documents"), weights, bias).where(F.col("score") >= toxicity.THRESHOLD).collect()}
    assert set(kept["toxicity"]) == set(text) - bad
    best = {}
    for i in kept["toxicity"]:
        key = text[i].encode().lower()
        best[key] = max(best.get(key, -1), i)
    assert sorted(kept["exact_dedup"]) == sorted(best.values())
    near = near_want(sets_of([(i, text[i]) for i in kept["exact_dedup"]]))
    assert sorted(kept["near_dedup"]) == sorted(i for i, w in near.items() if w[2])
    items = [bare(t) for _, t in texts(SF, "benchmark")]
    clean = []
    for i in kept["near_dedup"]:
        w, words = bare(text[i]), set(bare(text[i]))
        hit = any(sum(x in words for x in item) >= min(0.4 * len(item), 32) and align_want(item, w) >= min(0.4 * len(item), 32) for item in items)
        clean += [] if hit else [i]
    assert sorted(kept["decontamination"]) == sorted(clean)
    t = tokenizer(corpus_pipeline.default_vocabulary())
    for r in docs.limit(60).collect():
        ids = t.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == t.decode(ids, skip_special_tokens=False)
    assert sorted(kept["bpe"]) == sorted(clean) and np.isin(clean, list(text)).all()


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() > 0


def put(spark, folder, docs, **others):
    docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        others.get(name, table(spark, SF, name)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    from .helpers import awkward

    got = [r.doc_id for r in corpus_pipeline.run(spark, put(spark, tmp_path, awkward(spark))).collect()]
    # Of null, empty and equal texts the largest doc_id stays; blank texts are linked with nothing; rows without a doc_id stay.
    assert sorted(got, key=str) == sorted([2, 3, 5, 7, 9, 10, 11, None], key=str)


def test_pipeline_loses_no_text_where_ids_repeat(spark, tmp_path):
    from .helpers import fold
    from .test_dedup import repeated_ids

    rows = [(i, t, i % 2) for i, t in repeated_ids()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = corpus_pipeline.run(spark, put(spark, tmp_path, docs, labels=none)).collect()
    # Brute force over rows: the last of equal texts, then the first of near ones.
    last = {}
    for i, t, _ in rows:
        last[fold(t)] = max(last.get(fold(t), -1), i)
    left = sorted((i, t) for t, i in last.items())
    near = near_want(sets_of([(n, t.decode()) for n, (_, t) in enumerate(left)]))
    want = sorted(left[n][0] for n, w in near.items() if w[2])
    assert sorted(r.doc_id for r in out) == want


def test_pipeline_on_empty_tables(spark, tmp_path):
    full = {name: table(spark, SF, name) for name in ("documents", "labels", "benchmark")}
    for gone in ({"documents"}, {"labels"}, {"benchmark"}, set(full)):
        tables = {k: df.limit(0 if k in gone else 40) for k, df in full.items()}
        folder = put(spark, tmp_path / "-".join(sorted(gone)), **{"docs": tables["documents"], "labels": tables["labels"], "benchmark": tables["benchmark"]})
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "ids", "decoded"] and (out.count() > 0) == ("documents" not in gone)
