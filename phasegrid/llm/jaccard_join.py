"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

1. Texts that are equal byte for byte form a class; from here on a class is one row.
2. Each class gets ``trees`` paths of ``max_depth`` min-hash values over its word shingles. Paths sorted
   within a tree are a prefix trie: neighbours' common prefixes are its inner nodes.
3. A pair with similarity s shares d levels in some tree with probability 1 − (1 − s^d)^trees. The
   least depth that is ever needed is the one at which a pair at the threshold reaches
   ``target_recall`` by this formula (``prefix_depth``); what shares no such prefix is left out. The
   sub-tries under each are written once, each in one task, sorted.
4. Walk (``walk``): matching starts at full depth. At each depth the classes that meet at a trie node
   of that depth, from different children, are compared by sketches of all their signatures; pairs
   whose estimate lies ``slack`` standard errors or less below the threshold are linked. From the
   similarities of the links found so far the recall is estimated (each found pair stands for 1/p
   pairs, p its probability of being found at this depth or deeper), and matched prefixes are
   shortened by one level until it reaches ``target_recall``, at most to the depth of step 3.
5. A sub-trie with more than ``max_group`` classes isn't gathered in one task: it is cut into blocks of
   that size and a task compares one pair of blocks, at the least depth at once. Classes that are
   already connected in a task aren't compared again, so a dense group takes linear time.
6. Connected components of these links are candidate groups: every pair of step 4 lies within one.
   Within a group all pairs are verified exactly by the sizes of shingle-set intersections, as a
   product of 0/1 matrices. A group of more than ``block`` classes is cut into blocks, and a task
   verifies one pair of blocks. Only link counts and spanning forests leave a task.
7. Components of the verified links, and of them only, are the near-duplicate classes.

Words are maximal runs of non-space characters, lower-cased. A text of fewer words than a shingle
has one shingle of all of them. Null counts as empty; texts without words are linked only to copies.
A text of any length is read whole. Documents with null ids take part and get a null id back.
Repeated rows are members of the same class; of rows that tie for the least id one is kept. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasegrid.llm import tokens
from phasegrid.llm.components import components
from phasegrid.llm.shared import cut, in_arrow, regrouped, stay, text_or_empty


def prefix_depth(threshold: float, trees: int, max_depth: int, target_recall: float) -> int:
    """Shorten the matched prefix from ``max_depth`` until the expected recall is reached."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= target_recall:
            return depth
    raise ValueError("more trees are needed for this recall")


def min_hashes(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """(texts, count) uint32 minima; texts without shingles get the largest value."""
    random = np.random.default_rng(0x5EED)
    odd = random.integers(1 << 31, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    flip = random.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    some = np.flatnonzero(np.diff(first))
    out = np.full((len(first) - 1, count), np.uint32(0xFFFFFFFF), dtype=np.uint32)
    if len(some):
        for i in range(count):
            out[some, i] = np.minimum.reduceat((short ^ flip[i]) * odd[i], first[some])
    return out


def signatures(docs: DataFrame, k: int, trees: int, max_depth: int, depth: int) -> DataFrame:
    """(tid, doc_id, n_shingles, prefixes, small): tid is the MD5 of the text, ``prefixes`` hash the
    first ``depth`` levels of each tree, ``small`` has one byte of each level, tree by tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in tokens.blocks(batch.column(2)):
                hashes, _, _, first = tokens.words(data, offsets)
                sh, _, first = tokens.shingles(hashes, first, k)
                mins = min_hashes(sh, first, trees * max_depth)
                shaped = mins.reshape(-1, trees, max_depth)
                prefix = np.zeros(shaped.shape[:2], dtype=np.uint64)
                for level in range(depth):
                    prefix = tokens.mix64(prefix * np.uint64(0x9E3779B97F4A7C15) + shaped[:, :, level].astype(np.uint64) + np.uint64(1))
                prefix += np.arange(trees, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                small = np.ascontiguousarray((mins * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8))
                rows = end - at
                lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * trees), pa.array(prefix.ravel().view(np.int64)))
                bins = pa.Array.from_buffers(
                    pa.binary(), rows, [None, pa.py_buffer((np.arange(rows + 1, dtype=np.int32) * small.shape[1]).tobytes()), pa.py_buffer(small.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), batch.column(1).slice(at, rows), pa.array(np.diff(first), pa.int32()), lists, bins],
                    names=["tid", "doc_id", "n_shingles", "prefixes", "small"],
                )

    source = docs.select(F.unhex(F.md5("text")).alias("tid"), "doc_id", F.lower("text").alias("text"))
    return in_arrow(source, run, "tid binary, doc_id long, n_shingles int, prefixes array<long>, small binary")


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``; a group may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        same = np.ones(batch.num_rows, dtype=bool)
        for k, v in zip(keys, last, strict=True):
            same &= pc.equal(batch.column(k), pa.scalar(v, batch.column(k).type)).to_numpy(zero_copy_only=False)
        start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if start:
            held.append(batch.slice(0, start))
            yield pa.Table.from_batches(held).combine_chunks()
            held = [batch.slice(start)]
        else:
            if held and [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys] != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _estimated(pairs: list[tuple[bytes, bytes, float]]) -> pa.RecordBatch:
    a, b, s = ([p[i] for p in pairs] for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(s, pa.float64())], names=["a", "b", "s"])


def _bytes_of(column: pa.ChunkedArray) -> np.ndarray:
    """(rows, width) of a column of equally long byte strings."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def link(small: np.ndarray, apart: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """A spanning forest of the estimated links between rows with different ``apart``: (i, j, estimate).
    Rows that are connected already aren't compared."""
    label, out = np.arange(len(small)), []
    for i in range(len(small) - 1):
        others = i + 1 + np.flatnonzero((apart[i + 1 :] != apart[i]) & (label[i + 1 :] != label[i]))
        if len(others):
            alike = (small[others] == small[i]).mean(axis=1)
            for j, s in zip(others[alike >= least], alike[alike >= least], strict=True):
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    out.append((i, int(j), float(s)))
    return out


def trie_links(tries: DataFrame, depth: int, deepest: bool, least: float) -> DataFrame:
    """(a, b, s): links between classes that meet at a trie node of ``depth`` (or deeper, if
    ``deepest``), from rows (prefix, path, tid, small) sorted by prefix and path. Within a task the
    common prefixes of neighbours are the trie. A path has one byte a level; where two levels differ
    in other bytes only, a pair is compared at a greater depth than its own, never left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["prefix"]):
            key, levels = group.column("prefix").to_numpy(), _bytes_of(group.column("path"))
            same = np.concatenate((levels[1:] == levels[:-1], np.zeros((len(key) - 1, 1), dtype=bool)), axis=1)
            common = np.where(key[1:] == key[:-1], same.argmin(axis=1), -1)
            # Nodes of this depth: maximal runs of rows whose neighbours share ``depth`` levels.
            inside = np.concatenate(([False], common >= depth, [False]))
            starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
            child = np.arange(len(key)) if deepest else np.concatenate(([0], np.cumsum(common <= depth)))
            tid, small = group.column("tid"), _bytes_of(group.column("small"))
            pairs: list[tuple[int, int, float]] = []
            two = starts[ends - starts == 2]
            two = two[child[two] != child[two + 1]]
            alike = (small[two] == small[two + 1]).mean(axis=1)
            pairs += [(int(s), int(s) + 1, float(x)) for s, x in zip(two[alike >= least], alike[alike >= least], strict=True)]
            for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
                pairs += [(s + i, s + j, x) for i, j, x in link(small[s:e], child[s:e], least)]
            yield _estimated([(tid[i].as_py(), tid[j].as_py(), x) for i, j, x in pairs])

    return in_arrow(tries, run, "a binary, b binary, s double")


def block_links(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, s): links within one pair of blocks, from rows (prefix, i, j, side, tid, small) sorted by
    (prefix, i, j, side). Rows of one block are compared by the pair of that block with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["prefix", "i", "j"]):
            key = np.stack([table.column(n).to_numpy().astype(np.int64) for n in ("prefix", "i", "j")], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            tid, small, side = table.column("tid"), _bytes_of(table.column("small")), table.column("side").to_numpy()
            pairs = []
            for s, e in zip(edges, edges[1:], strict=False):
                apart = np.arange(e - s) if key[s, 1] == key[s, 2] else side[s:e]
                pairs += [(tid[s + i].as_py(), tid[s + j].as_py(), x) for i, j, x in link(small[s:e], apart, least)]
            yield _estimated(pairs)

    return in_arrow(rows, run, "a binary, b binary, s double")


def spread_blocks(members: DataFrame, key: str, parts: Column, *columns: str) -> DataFrame:
    """Rows (key, i, j, side, columns) of all pairs of blocks of each group, sorted within tasks."""
    dealt = members.withColumn("parts", parts.cast("int")).withColumn("part", F.pmod(F.xxhash64("tid"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = dealt.select(
        key, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        F.when(F.col("part") <= F.col("other"), 0).otherwise(1).alias("side"), *columns,
    )
    return spread.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "side", "tid")


def estimated_recall(links: DataFrame, trees: int, depth: int, threshold: float) -> float:
    """The share of all pairs that ``links`` at ``depth`` or deeper are, by inverse probabilities."""
    s = F.greatest(F.least(F.col("s"), F.lit(1.0)), F.lit(threshold))
    found = 1 - F.pow(1 - F.pow(s, F.lit(depth)), F.lit(trees))
    every = links.groupBy("a", "b").agg(F.max("s").alias("s")).agg(F.count("*").alias("n"), F.sum(1 / found).alias("all")).first()
    return every["n"] / every["all"] if every["n"] else 1.0


def walk(tries: DataFrame, trees: int, max_depth: int, floor: int, least: float, threshold: float, target_recall: float) -> tuple[DataFrame, list[tuple[int, float]]]:
    """The links of the forest and (depth, estimated recall) of each step: prefixes are shortened until
    the estimate reaches the target or ``floor`` is reached."""
    links, steps = None, []
    for depth in range(max_depth, floor - 1, -1):
        new = cut(trie_links(tries, depth, depth == max_depth, least))
        links = new if links is None else links.unionByName(new)
        steps.append((depth, estimated_recall(links, trees, depth, threshold)))
        if steps[-1][1] >= target_recall:
            break
    return links, steps


def candidate_links(classes: DataFrame, trees: int, max_depth: int, floor: int, least: float, threshold: float, target_recall: float, max_group: int) -> tuple[DataFrame, list[tuple[int, float]]]:
    """(a, b, s) and the steps of the walk."""
    nodes = classes.where("n_shingles > 0").select("tid", F.posexplode("prefixes").alias("tree", "prefix"))
    sizes = nodes.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1")
    under = cut(nodes.join(regrouped(sizes, "prefix"), "prefix"))
    path = F.substring(F.col("small"), F.col("tree") * max_depth + 1, F.lit(max_depth)).alias("path")
    own = classes.select("tid", "small")
    normal = under.where(F.col("n") <= max_group).join(own, "tid").select("prefix", path, "tid", "small")
    tries = cut(normal.repartition("prefix").sortWithinPartitions("prefix", "path", "tid"))
    links, steps = walk(tries, trees, max_depth, floor, least, threshold, target_recall)
    hot = under.where(F.col("n") > max_group)
    if not hot.isEmpty():
        members = hot.join(own, "tid").select("prefix", "n", "tid", "small")
        links = links.unionByName(block_links(spread_blocks(members, "prefix", F.ceil(F.col("n") / max_group), "tid", "small"), least))
    return links, steps


def verified(blocks: DataFrame, k: int, threshold: float) -> DataFrame:
    """From rows (grp, i, j, side, tid, copies, text) sorted by (grp, i, j, side, tid): link counts
    (tid, links, text_links) and forest edges (a, b) in one table."""

    def product(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        every, other = np.concatenate(left), np.concatenate(right)
        common = np.intersect1d(every, other)
        a = np.zeros((len(left), len(right)), dtype=np.float32)
        owner_l = np.repeat(np.arange(len(left)), [len(x) for x in left])
        owner_r = np.repeat(np.arange(len(right)), [len(x) for x in right])
        at_l, at_r = np.searchsorted(common, every), np.searchsorted(common, other)
        in_l = (at_l < len(common)) & (common[np.minimum(at_l, max(0, len(common) - 1))] == every) if len(common) else np.zeros(len(every), bool)
        in_r = (at_r < len(common)) & (common[np.minimum(at_r, max(0, len(common) - 1))] == other) if len(common) else np.zeros(len(other), bool)
        owner_l, at_l, owner_r, at_r = owner_l[in_l], at_l[in_l], owner_r[in_r], at_r[in_r]
        for low in range(0, len(common), 8192):
            width = min(8192, len(common) - low)
            x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
            pick_l, pick_r = (at_l >= low) & (at_l < low + width), (at_r >= low) & (at_r < low + width)
            x[owner_l[pick_l], at_l[pick_l] - low] = 1
            y[owner_r[pick_r], at_r[pick_r] - low] = 1
            a += x @ y.T
        return a

    def sets_of(texts: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, _, data, offsets in tokens.blocks(texts):
            hashes, _, _, first = tokens.words(data, offsets)
            sh, _, first = tokens.shingles(hashes, first, k)
            out += [np.unique(sh[first[r] : first[r + 1]]) for r in range(len(first) - 1)]
        return out

    def one(group: pa.Table, same: bool) -> tuple[list, list]:
        side = group.column("side").to_numpy()
        tid, copies = group.column("tid").to_pylist(), group.column("copies").to_numpy()
        sets = sets_of(group.column("text"))
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return [], []
        inter = product([sets[i] for i in left], [sets[i] for i in right])
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        union = sizes[left][:, None] + sizes[right][None, :] - inter
        # Compared as integers times a hundred thousand, so that 4/5 is 0.8.
        link = np.round(inter * 1e5) >= np.floor(union * threshold * 1e5 + 1e-6)
        if same:
            np.fill_diagonal(link, False)
        counts = [(tid[left[r]], int((link[r] * copies[right]).sum()), int(link[r].sum())) for r in range(len(left))]
        if not same:
            counts += [(tid[right[c]], int((link[:, c] * copies[left]).sum()), int(link[:, c].sum())) for c in range(len(right))]
        forest, edges = Forest(len(tid)), []
        for r in range(len(left)):
            for c in np.flatnonzero(link[r]):
                if forest.join(int(left[r]), int(right[c])):
                    edges.append((tid[left[r]], tid[right[c]]))
        return counts, edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["grp", "i", "j"]):
            i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
            grp = table.column("grp").to_pylist()
            cuts = [0] + [r for r in range(1, len(grp)) if grp[r] != grp[r - 1] or i[r] != i[r - 1] or j[r] != j[r - 1]] + [len(grp)]
            counts, edges = [], []
            for s, e in zip(cuts, cuts[1:], strict=False):
                more_counts, more_edges = one(table.slice(s, e - s), bool(i[s] == j[s]))
                counts += more_counts
                edges += more_edges
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c[0] for c in counts] + [x[0] for x in edges], pa.binary()),
                    pa.array([None] * len(counts) + [x[1] for x in edges], pa.binary()),
                    pa.array([c[1] for c in counts] + [None] * len(edges), pa.int64()),
                    pa.array([c[2] for c in counts] + [None] * len(edges), pa.int64()),
                ],
                names=["a", "b", "links", "text_links"],
            )

    return in_arrow(blocks, run, "a binary, b binary, links long, text_links long")


def jaccard_join(
    docs: DataFrame,
    threshold: float = 0.8,
    k: int = 5,
    trees: int = 20,
    max_depth: int = 8,
    target_recall: float = 0.9999,
    slack: float = 5.0,
    max_group: int = 1000,
    block: int = 256,
) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its near-duplicate class), keep
    (whether it is that document), class_size, n_links (documents with similarity >= ``threshold``,
    copies included), n_text_links (different texts among them), tid (MD5 of the text)."""
    floor = prefix_depth(threshold, trees, max_depth, target_recall)
    error = math.sqrt(threshold * (1 - threshold) / (trees * max_depth))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = cut(signatures(base, k, trees, max_depth, floor))
    classes = cut(
        signed.groupBy("tid").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("prefixes").alias("prefixes"), F.first("small").alias("small"),
        )
    )
    links, _ = candidate_links(classes, trees, max_depth, floor, threshold - slack * error, threshold, target_recall, max_group)
    groups = components(links.select("a", "b")).withColumnsRenamed({"node": "tid", "label": "grp"})  # read from a checkpoint
    members = groups.join(classes.select("tid", "copies", "first_id"), "tid")
    members = members.join(groups.groupBy("grp").agg(F.count("*").alias("m")), "grp")
    # A text is fetched once per member, from its first copy: copies spread over the join by their id.
    texts = base.select(F.unhex(F.md5("text")).alias("tid"), "doc_id", F.lower("text").alias("text"))
    owners = members.withColumnRenamed("tid", "o_tid")
    owned = (texts["tid"] == owners["o_tid"]) & texts["doc_id"].eqNullSafe(owners["first_id"])
    fetched = texts.join(owners, owned).dropDuplicates(["tid"])
    dealt = spread_blocks(fetched, "grp", F.ceil(F.col("m") / block), "tid", "copies", "text")
    checked = cut(verified(dealt, k, threshold))
    links = checked.where("b is null").groupBy(F.col("a").alias("tid")).agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    labels = components(checked.where("b is not null").select("a", "b")).withColumnsRenamed({"node": "tid", "label": "root"})
    plain = classes.select("tid", "copies", "first_id")
    linked = labels.join(plain, "tid")
    least = F.min(F.struct(F.col("first_id").isNull(), "first_id", "tid"))
    by_root = regrouped(linked.groupBy("root").agg(least.alias("least"), F.sum("copies").alias("size")), "root")
    of_class = linked.select("tid", "root").join(by_root, "root").select("tid", "least", "size")
    near = plain.join(of_class, "tid", "left").join(links, "tid", "left")
    near = near.select(
        "tid", F.when(F.col("least").isNull(), F.col("first_id")).otherwise(F.col("least.first_id")).alias("class_id"),
        F.coalesce("least.tid", "tid").alias("keep_tid"), F.coalesce("size", "copies").alias("class_size"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
    )
    out = signed.select("tid", "doc_id").join(regrouped(near, "tid"), "tid")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tid") == F.col("keep_tid"))
    return out.select("doc_id", "class_id", stays.alias("keep"), "class_size", "n_links", "n_text_links", "tid")


def near_dedup(docs: DataFrame, **parameters: float) -> DataFrame:
    """One document of each near-duplicate class, with all its columns: the least ``doc_id``."""
    kept = jaccard_join(docs, **parameters).where("keep").select("doc_id", F.col("tid").alias("digest"))
    return stay(docs, kept, F.unhex(F.md5(text_or_empty())))
