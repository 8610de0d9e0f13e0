"""Exact dedup, n-gram Jaccard join and suffix-array dedup against brute force."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from phasegrid.llm import exact_dedup, jaccard_join, repeats
from phasegrid.llm.components import components

from .helpers import LONG, empty, nasty, row

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_groups_match_brute_force(spark):
    docs = nasty(spark)
    rows = [(r["doc_id"], (r["text"] or "").translate(FOLD)) for r in docs.collect()]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = exact_dedup.exact_groups(docs, bucket_entries=3).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_digest[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == {d: 1 for d in by_digest}


def test_exact_dedup_keeps_columns_and_one_row_each(spark):
    docs = nasty(spark)
    out = exact_dedup.exact_dedup(docs)
    assert out.columns == docs.columns
    texts = [(r["text"] or "").translate(FOLD) for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({(r["text"] or "").translate(FOLD) for r in docs.collect()})


@pytest.mark.parametrize("most", [100, 3])
def test_directory_doubles_until_buckets_fit(spark, most):
    entries = spark.range(4000).selectExpr("xxhash64(id) AS key")
    directory = exact_dedup.grow_directory(entries, most)
    assert len(directory.buckets) == 1 << directory.depth
    filled = exact_dedup.with_bucket(entries, directory).groupBy("bucket").count().collect()
    assert max(r["count"] for r in filled) <= most and sum(r["count"] for r in filled) == 4000
    assert len(set(directory.local_depths)) >= 1 and max(directory.local_depths) == directory.depth


def test_keys_that_share_all_leading_bits_share_a_bucket(spark):
    entries = spark.range(500).selectExpr("id AS key")
    directory = exact_dedup.grow_directory(entries, 100)
    assert directory.depth == exact_dedup.MAX_DEPTH and sorted(set(directory.local_depths))[0] == 1
    assert exact_dedup.with_bucket(entries, directory).select("bucket").distinct().count() == 1


def test_probes_need_the_directory(spark):
    """The index lies by bucket, each file holds a range of keys, and another directory finds less."""
    docs = spark.createDataFrame([(i, f"text {i % 300}") for i in range(900)], "doc_id long, text string")
    rows = exact_dedup.probes(docs)
    index, directory = exact_dedup.build_index(docs, rows, bucket_entries=10)
    assert len(directory.local_depths) > 30 and index.count() == 300
    where = index.groupBy(F.input_file_name().alias("f")).agg(F.min("bucket").alias("a"), F.max("bucket").alias("z")).orderBy("a").collect()
    assert all(x["z"] < y["a"] for x, y in zip(where, where[1:], strict=False))
    key = ["bucket", "key", "digest"]
    assert exact_dedup.with_bucket(rows, directory).join(index, key).count() == 900
    without = exact_dedup.Directory(0, [0], [0])
    assert exact_dedup.with_bucket(rows, without).join(index, key).count() < 900


def test_texts_that_share_a_key_are_chained_by_bytes(spark, monkeypatch):
    """With a key that collides for all texts, the bytes decide."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (4, "c"), (5, "b")], "doc_id long, text string")
    rows = exact_dedup.probes(docs)
    index, _ = exact_dedup.build_index(docs, rows)
    monkeypatch.undo()
    got = index.orderBy("link").collect()
    assert [(r["link"], r["keep_id"], r["group_size"]) for r in got] == [(0, 2, 2), (1, 5, 2), (2, 4, 1)]
    assert [r["digest"] for r in got] == [hashlib.sha256(t).hexdigest() for t in (b"a", b"b", b"c")]


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def _similar(docs, threshold=0.8):
    sets = []
    for _, text in docs:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            same = (docs[a][1] or "") == (docs[b][1] or "")
            both = len(sets[a] | sets[b])
            if same or (both and len(sets[a] & sets[b]) >= threshold * both - 1e-9):
                links[a] += 1
                links[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(len(docs))], links


def _edited(seed, n_base, copies, words):
    r = random.Random(seed)
    out = []
    for base in range(n_base):
        text = [f"w{r.randrange(3000)}" for _ in range(words)]
        out.append(" ".join(text))
        for _ in range(copies):
            changed = list(text)
            for _ in range(r.randrange(0, max(2, words // 25))):
                changed[r.randrange(words)] = f"z{r.randrange(10**6)}"
            out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_join_matches_brute_force(spark, block):
    texts = _edited(3, 6, 9, 60) + _edited(4, 3, 3, 12) + ["the same line"] * 3 + ["one"] * 2 + ["", None]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    roots, links = _similar(docs)
    got = {r["doc_id"]: r for r in jaccard_join.jaccard_join(frame, block=block, max_group=5 if block == 8 else 1000).collect()}
    assert len(got) == len(docs)
    assert [got[i]["n_links"] for i in range(len(docs))] == links
    least = {}
    for i, root in enumerate(roots):
        least.setdefault(root, i)
    assert [got[i]["class_id"] for i in range(len(docs))] == [least[r] for r in roots]
    assert sum(got[i]["keep"] for i in range(len(docs))) == len(set(roots))


def test_prefix_depth_shortens_until_recall():
    assert jaccard_join.prefix_depth(0.8, 20, 8, 0.9999) == 4
    assert jaccard_join.prefix_depth(0.8, 20, 8, 0.5) == 8
    with pytest.raises(ValueError):
        jaccard_join.prefix_depth(0.3, 2, 8, 0.9999)


def _walk(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = jaccard_join.signatures(frame, 5, 20, 8, 4)
    classes = signed.dropDuplicates(["tid"])
    links, steps = jaccard_join.candidate_links(classes, 20, 8, 4, 0.65, 0.8, 0.9999, 1000)
    return {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in links.collect()}, steps


def test_the_walk_shortens_prefixes_only_as_far_as_the_recall_asks(spark):
    """Very similar pairs are all found at full depth; pairs near the threshold need short prefixes."""
    r = random.Random(8)
    base = [[f"w{r.randrange(3000)}" for _ in range(200)] for _ in range(60)]
    close = [" ".join(t) for t in base] + [" ".join(t[:-1]) for t in base]
    found, steps = _walk(spark, close)
    print("close pairs:", steps)
    assert len(found) == 60 and len(steps) == 1 and steps[0][0] == 8 and steps[0][1] >= 0.9999
    far = [" ".join(t) for t in base] + [" ".join([f"z{i}" for i in range(16)] + t[16:-3]) for t in base]
    found, steps = _walk(spark, far)
    print("pairs near the threshold:", steps)
    depths, recalls = zip(*steps, strict=True)
    assert list(depths) == list(range(8, depths[-1] - 1, -1)) and depths[-1] < 7
    assert sorted(recalls) == list(recalls) and recalls[-1] >= 0.9999 and len(found) == 60


def test_links_are_a_spanning_forest():
    import numpy as np

    small = np.array([[1] * 10, [1] * 9 + [0], [2] * 10, [1] * 10, [2] * 9 + [1]], dtype=np.uint8)
    got = jaccard_join.link(small, np.arange(5), 0.9)
    assert {frozenset(x[:2]) for x in got} == {frozenset((0, 1)), frozenset((0, 3)), frozenset((2, 4))}
    assert jaccard_join.link(small, np.array([0, 0, 1, 0, 1]), 0.9) == []


def test_near_dedup_awkward_rows(spark):
    docs = nasty(spark)
    out = jaccard_join.near_dedup(docs)
    assert out.columns == docs.columns
    texts = [r["text"] or "" for r in out.collect()]
    assert texts.count(LONG) == 1 and texts.count("") == 1 and texts.count("lonely text without an id at all") == 1
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0


@pytest.mark.parametrize("small", [100_000, 0])
def test_components_of_a_long_chain(spark, small):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(edges, small_edges=small).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def _covered(texts, length):
    where = collections.Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if where[t[s : s + length]] > 1:
                flags[s : s + length] = b"\1" * length
        kept = bytes(c for c, f in zip(t, flags, strict=True) if not f)
        out.append((len(t), sum(flags), sum(1 for k in range(len(t)) if flags[k] and not (k and flags[k - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("max_group", [50_000, 2])
def test_repeats_match_brute_force(spark, max_group):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(2, 7)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(30):
        own = " ".join(word() for _ in range(r.randint(0, 120)))
        if i % 3 == 0:
            at = r.randint(0, 40)
            own = own[:at] + passage[r.randint(0, 30) :] + own[at:]
        if i % 7 == 0:
            own += passage + passage[: r.randint(10, 200)]
        rows.append((i, own))
    rows += [(100, "z" * 300), (101, "ab" * 150), (102, None), (103, ""), (104, rows[0][1]), (104, rows[0][1]), (None, passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.dedup(frame, max_group=max_group).collect())
    assert got == sorted(_covered([(t or "").encode() for _, t in rows], 200))


def test_maximal_repeats_give_all_occurrences():
    rights = [b"abcdefgh", b"abcdefxx", b"abcdefxy", b"abzz"]
    lefts = [b"321", b"321", b"399", b"3"]
    found = {(before, after, tuple(sorted(m))) for before, after, m in repeats.maximal(rights, lefts, 5)}
    assert (1, 6, (0, 1, 2)) in found  # all three share six bytes after and one before
    assert (3, 6, (0, 1)) in found  # two of them share three before
    assert (1, 7, (1, 2)) in found
    assert all(before + after >= 5 for before, after, _ in found)


def test_intervals_of_a_prefix_array():
    assert repeats.intervals([3, 3, 1, 2]) == [(3, 0, 2), (2, 3, 4), (1, 0, 4)]


def test_repeats_of_awkward_rows(spark):
    out = repeats.dedup(nasty(spark, [row(20, LONG + "tail")]))
    by = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert by[10]["n_removed"] == len(LONG) and by[10]["n_spans"] == 1 and bytes(by[20]["kept"]) == b"tail"
    assert by[12]["n_removed"] == 5000 and by[3]["n_bytes"] == 0
    assert repeats.dedup(empty(spark)).count() == 0
