"""The stages against a plain version, and the queries' columns."""

import re
import string

import numpy as np
import pyarrow as pa

import corpus_pipeline
import __spark_entry__ as entry
from phasegrid.llm import exact_dedup, mixing, quality, queries, shared

from .helpers import empty, nasty
from .test_dedup import FOLD
from .test_text_operators import _greedy_tiles

COLUMNS = {
    "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op6_html_text": ["page_id", "url", "text", "n_chars"],
    "op7_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
}


def test_queries_are_registered(spark, sf):
    known = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in known) == 1
    assert "pipeline" in known
    for name, columns in COLUMNS.items():
        assert queries.QUERIES[name](spark, sf).columns[: len(columns)] == columns


def test_each_stage_keeps_columns_and_clean_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, out = out, stage(spark, out, sf)
        assert out.columns == docs.columns
        assert out.count() <= before.count()
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    bad = [i for i in kept if labels.get(i) == 0]
    assert len(bad) <= 0.1 * sum(v == 0 for v in labels.values()) + 1
    texts = [r["text"] for r in out.select("text").collect()]
    assert len(texts) == len(set(texts))


def test_run_covers_all_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and abs(sum(r["taken"] for r in rows) / sum(r["size"] for r in rows) - 1) < 0.05


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


def _plain_run(docs, scores, bench):
    """The first four stages over lists: the rows that stay, by id."""
    rows = [(i, t or "") for i, t in docs if scores[i] >= 0.7]
    last = {}
    for i, t in sorted(rows):
        last[t.translate(FOLD)] = i
    rows = [(i, t) for i, t in sorted(rows) if last[t.translate(FOLD)] == i]
    shingles = []
    for _, t in rows:
        w = re.findall(r"[^ \t\n\x0b\f\r]+", t.lower())
        shingles.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    first = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if _jaccard(shingles[a], shingles[b]) >= 0.8 - 1e-12 and first[a] != first[b]:
                old, new = max(first[a], first[b]), min(first[a], first[b])
                first = [new if x == old else x for x in first]
    rows = [r for k, r in enumerate(rows) if first[k] == k]
    split = lambda t: [w for w in re.split(rf"[\x20\x09-\x0D{re.escape(string.punctuation)}]+", t.lower()) if w]
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    items = [(w, grams(w)) for w in (split(t or "") for t in bench) if len(w) >= 5]
    out = []
    for i, t in rows:
        words = split(t)
        own = grams(words)
        if not any(own & g and _greedy_tiles(words, w, 5) >= 0.5 * len(w) for w, g in items):
            out.append((i, t))
    return out


def test_run_matches_a_plain_version(spark, sf):
    """The pipeline's rows against the stages over lists, with the classifier's own scores."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scored, name = quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    scores = {r["doc_id"]: r[name] for r in scored.select("doc_id", name).collect()}
    plain = _plain_run([tuple(r) for r in docs.collect()], scores, [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in plain]
    words = {i: len(re.findall(r"[^ \t\n\x0b\f\r]+", t)) for i, t in plain}
    assert all(r["size"] == words[r["doc_id"]] for r in got)
    sources = sorted({r["source"] for r in got}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r["size"] for r in got if r["source"] == s) for s in sources]
    for s, goal in zip(sources, mixing.targets(sizes, [(5.0, 2.0, 1.0)[k % 3] for k in range(len(sources))]), strict=True):
        own = [r for r in got if r["source"] == s]
        assert abs(own[0]["target"] - goal) < 1e-6 and abs(sum(r["taken"] for r in own) - goal) <= max(r["size"] for r in own)
        assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] and len(r["positions"] or ()) == r["copies"] for r in own)
    placed = [r["position"] for r in got if r["position"] is not None]
    assert placed == sorted(placed) and got[len(placed) - 1]["position"] is not None


def test_stages_on_awkward_rows(spark, sf):
    for docs in (nasty(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
        assert corpus_pipeline.mixing_stage(spark, docs, sf).count() == docs.count()


def test_no_list_of_the_driver_goes_through_python_workers(spark, monkeypatch):
    """Those of an RDD are a second set of workers, which stays in each executor's memory."""
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('w ', 1 + id % 7) AS text", "IF(id % 3 = 0, NULL, 's' || id % 2) AS source")
    nothing = empty(spark)

    def refuse(*_, **__):
        raise AssertionError("an RDD of the driver's rows")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    mixed = mixing.with_positions(mixing.mix(docs, schedules=mixing.CURRICULUM)).collect()
    assert len(mixed) == 300 and abs(sum(r["taken"] for r in mixed) / sum(r["size"] for r in mixed) - 1) < 0.05
    groups = exact_dedup.exact_groups(docs, bucket_entries=2).collect()
    assert len(groups) == 300 and {r["keep_id"] for r in groups} == set(range(293, 300))
    assert mixing.mix(nothing).count() == 0


def test_python_gets_small_batches(spark):
    """30 MB of texts in one partition were one batch of 10,000 rows and a rest."""
    docs = spark.range(0, 12_000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 500) || id AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "b"])

    spark.conf.unset(shared.BATCH)
    quality.score(docs, quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0)))
    got = docs.mapInArrow(sizes, "n long, b long").collect()
    spark.conf.set(shared.BATCH, "1g")
    quality.score(docs, quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0)))
    assert spark.conf.get(shared.BATCH) == "1g"
    spark.conf.unset(shared.BATCH)
    assert sum(r["n"] for r in got) == 12_000 and max(r["b"] for r in got) < 1.1 * shared.BATCH_BYTES
