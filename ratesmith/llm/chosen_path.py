"""MinHash near duplicates by chosen paths: a set similarity join by recursive branching on minwise tokens.

Equal shingle sets are one set. Each set has a signature, its minwise token under each of COORDINATES hash functions. A tree has all
sets at its root; a node branches by two coordinates that depend on its path, and sets with one minwise token there go to one child,
so a set is in two children of each of its nodes. Small nodes are compared exhaustively: by signatures first, then pairs whose
signatures leave a link possible by their whole sets. A large node is dealt into blocks, which are compared as small ones are, and
branches on. What is linked has one label from then on, and a node whose sets all have one label is done; so a large group of near
copies ends after a few blocks. A large node in which few sets don't have the commonest label is done, too, when these are compared
with all of it. A pair at the threshold stays together in a tree with a chance of 0.94 or more, however deep it is, so TREES trees
miss fewer than two in 100,000; pairs of two sets that share more are missed less often.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_SHARE, forget, saved, small_batches, spread_join, table
from .components import components
from .shingles import SPACES, _secrets, give_back, mix, new_key, text_slices, windows, words

WORDS, PERCENT = 4, 80
TREES, COORDINATES = 4, 64
#: Sets of a node that are compared with each other in one task.
LEAF = 256
#: Sets of a large node that don't have its commonest label, up to which they are compared with the whole node.
MINOR = 1024
#: Coordinates of two signatures that agree at least where the sets may be linked: at a similarity of 0.8, fewer than 33 of 64 agree
#: with a chance under one in ten millions.
AGREE = 33
#: Rows of nodes, and sets of clusters, that go to one call.
GROUP_ROWS, CLUSTER_ROWS = 8192, 256
#: Sets of a cluster over which its pairs are compared by bits, and the flags of one slice of shingles.
MANY, FLAGS = 32, 1 << 25
#: Nodes in which sets of a block may have met before, those that most of them share: a pair that met elsewhere is compared again.
BEFORE = 512
#: Passes over the blocks of nodes that have no coordinates left, before such a node counts as done.
LAST_PASSES = 3


def _shingle_sets(texts: pa.Array, k: int, key: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after the other; where each text begins; 16 bytes that stand for each set."""
    w = words(texts, SPACES, lower=True)
    fps, text, _ = windows(w.keyed_hashes(key), w.first, k, short=True, key=key)
    order = np.lexsort((fps, text))
    fps, text = fps[order], text[order]
    new = np.r_[True, (fps[1:] != fps[:-1]) | (text[1:] != text[:-1])] if len(fps) else np.zeros(0, bool)
    fps, edge = fps[new], np.searchsorted(text[new], np.arange(len(texts) + 1))
    halves = []
    for salt in _secrets(key, 2, "sets"):
        total = np.r_[np.uint64(0), np.cumsum(mix(fps ^ salt))]
        halves.append(mix(total[edge[1:]] - total[edge[:-1]] + mix(np.diff(edge).astype(np.uint64))))
    return fps, edge, np.ascontiguousarray(np.stack(halves, 1)).view("V16").ravel()


def signatures(fps: np.ndarray, edge: np.ndarray, key: bytes) -> np.ndarray:
    """A row of minwise tokens, 32 bits of each, for every text that has shingles; zeros for others."""
    out = np.zeros((len(edge) - 1, COORDINATES), "<u4")
    full = np.flatnonzero(np.diff(edge))
    if len(full):
        for i, odd in enumerate(_secrets(key, COORDINATES, "coordinates") | np.uint64(1)):
            out[full, i] = np.minimum.reduceat(fps * odd, edge[full]) >> np.uint64(32)
    return out


def _described(k: int, key: bytes):
    """The columns of docs but text, with n_shingles, the set's 16 bytes (null: none) and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch):
                part = batch.slice(a, b - a)
                fps, edge, ids = _shingle_sets(part.column("text"), k, key)
                size, sig = np.diff(edge), signatures(fps, edge, key)
                own = [c for c in part.schema.names if c != "text"]
                ids = pa.array([x.tobytes() if n else None for x, n in zip(ids, size.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(size), ids, pa.array([x.tobytes() for x in sig], pa.binary())], [*own, "n_shingles", "set", "sig"])

    return run


def _branches(trees: int, key: bytes):
    """Children (node, tree, rid) of rows (node, tree, rid, sig): two of each. Without node, from the roots of all trees."""
    salts = _secrets(key, 2, "branches")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u4").reshape(-1, COORDINATES)
            rid, rows = batch.column("rid").to_numpy(), np.arange(batch.num_rows)
            roots = "node" not in batch.schema.names
            for tree in range(trees) if roots else [None]:
                parent = np.full(len(rid), tree, np.uint64) if roots else batch.column("node").to_numpy().view(np.uint64)
                one = (mix(parent ^ salts[0]) % np.uint64(COORDINATES)).astype(np.int64)
                other = (one + 1 + (mix(parent ^ salts[1]) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
                for at in (one * 0 + 2 * tree, one * 0 + 2 * tree + 1) if roots else (one, other):  # no two trees begin alike
                    child = mix(mix(parent ^ salts[0]) ^ mix((at.astype(np.uint64) << np.uint64(32)) + sig[rows, at]))
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array([tree] * len(rid), pa.int32()) if roots else batch.column("tree"), pa.array(rid)], ["node", "tree", "rid"])

    return run


def _pairs(start: np.ndarray, size: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows start[0], start[0] + 1, ... (size[0] of them), and of the others' rows, in parts of about `most`."""
    many = size * (size - 1) // 2
    part = (np.cumsum(many) - many) // most
    for own in np.split(np.arange(len(size)), np.flatnonzero(np.diff(part)) + 1):
        for m in np.unique(size[own]):
            i, j = np.triu_indices(m, 1)
            first = start[own[size[own] == m]][:, None]
            yield (first + i).ravel(), (first + j).ravel()


def _may_link(i: np.ndarray, j: np.ndarray, n: np.ndarray, sig: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs whose sizes and signatures leave a link possible, and how many coordinates agree."""
    fit = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    i, j = i[fit], j[fit]
    agree = np.concatenate([np.zeros(0, np.int64), *((sig[i[x : x + 16384]] == sig[j[x : x + 16384]]).sum(1) for x in range(0, len(i), 16384))])
    near = agree >= AGREE
    return i[near], j[near], agree[near]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of the nodes 0 to n - 1 that each is connected with."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _met(block: np.ndarray, earlier: pa.ListArray) -> np.ndarray:
    """Bits for the nodes in which each row's set was compared before: two rows of one block (numbered) with a bit in common have met."""
    row = np.repeat(np.arange(len(block)), earlier.value_lengths().to_numpy(zero_copy_only=False))
    node = earlier.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    order = np.lexsort((node, block[row]))
    row, node = row[order], node[order]
    new = np.r_[True, (node[1:] != node[:-1]) | (block[row[1:]] != block[row[:-1]])] if len(row) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    count, of = np.bincount(run), block[row[new]]
    place = np.empty(len(of), np.int64)
    often = np.lexsort((-count, of))
    place[often] = np.arange(len(of)) - np.searchsorted(of, of)  # in its block, the node that most rows share first; of is sorted
    keep = (count[run] > 1) & (place[run] < BEFORE)
    flags = np.zeros((len(block), -(-int(place[run[keep]].max(initial=0) + 1) // 64) * 64), bool)
    flags[row[keep], place[run[keep]]] = True
    return np.packbits(flags, axis=1).view(np.uint64)


def _near(percent: int):
    """Of some blocks: the clusters of sets between which links are possible, one row for each member. A cluster's name is made of
    its members, so that it is the same wherever they meet. Sets that are in all blocks meet each other where one is at home. Two sets
    that an earlier node, one of `earlier` of both, has compared don't meet again."""

    def run(_: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        give_back()
        t = t.sort_by([("node", "ascending"), ("block", "ascending"), ("rid", "ascending")])
        node, block, rid, label, n = (t.column(c).to_numpy() for c in ("node", "block", "rid", "label", "n"))
        home = np.array(t.column("home").to_pylist(), bool)
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u4").reshape(-1, COORDINATES)
        new = np.r_[True, (node[1:] != node[:-1]) | (block[1:] != block[:-1])]
        start, met = np.flatnonzero(new), _met(np.cumsum(new), t.column("earlier").combine_chunks())
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _pairs(start, np.diff(np.r_[start, len(node)])):
            other = (label[i] != label[j]) & (home[i] | home[j])
            i, j = i[other], j[other]
            first = ~np.logical_or.reduce([(x[i] & x[j]) != 0 for x in met.T])
            i, j, _agree = _may_link(i[first], j[first], n, sig, percent)
            a.append(i)
            b.append(j)
        a, b = np.concatenate(a), np.concatenate(b)
        root, member = _roots(len(node), a, b), np.unique(np.r_[a, b])
        name = np.zeros(len(node), np.uint64)
        np.add.at(name, root[member], mix(rid[member].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        return pa.table({"cluster": pa.array(mix(name[root[member]]).view(np.int64)), "rid": pa.array(rid[member], pa.int64()), "home": pa.array(home[member])})

    return run


def _common(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which sets have which shingles, in the order of shingles: those that more than one has, numbered from 0."""
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, often = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), count > 1
    row, token = row[often[token]], (np.cumsum(often) - 1)[token[often[token]]]
    order = np.argsort(token, kind="stable")
    return row[order], token[order]


def _shared(n_sets: int, row: np.ndarray, token: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles the sets i[0] and j[0], i[1] and j[1], ... share: bits of each set, a slice of shingles at a time."""
    out, width = np.zeros(len(i), np.int64), max(64, FLAGS // n_sets // 64 * 64)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        own = slice(*np.searchsorted(token, (low, low + width)))
        flags = np.zeros((n_sets, min(width, -(-(int(token[-1]) + 1 - low) // 64) * 64)), bool)
        flags[row[own], token[own] - low] = True
        bits = np.packbits(flags, axis=1).view(np.uint64)
        part = max(1, (1 << 18) // bits.shape[1])
        for x in range(0, len(i), part):
            out[x : x + part] += np.bitwise_count(bits[i[x : x + part]] & bits[j[x : x + part]]).sum(1, dtype=np.int64)
    return out


def _confirmed(k: int, percent: int, key: bytes):
    """Links (a, b) between the labels of some clusters' sets, by their whole sets; pairs that agree most come first, and a pair that
    others have linked already isn't compared. Large clusters, most of whose pairs may be just too far apart to be linked, are
    compared by bits."""

    def run(_: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        give_back()
        t = t.sort_by([("cluster", "ascending"), ("rid", "ascending")])
        cluster, label, home = t.column("cluster").to_numpy(), t.column("label").to_numpy(), np.array(t.column("home").to_pylist(), bool)
        parts = [_shingle_sets(part.column("text").slice(x, y - x), k, key)[:2] for part in t.to_batches() for x, y in text_slices(part)]
        n = np.concatenate([np.diff(edge) for _, edge in parts])
        sets = [fps[x:y] for fps, edge in parts for x, y in itertools.pairwise(edge.tolist())]
        sig = np.concatenate([signatures(fps, edge, key) for fps, edge in parts])
        start, links = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]]), []
        root = {int(x): int(x) for x in np.unique(label)}

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        def meeting(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            other = (label[i] != label[j]) & (home[i] | home[j])
            i, j, agree = _may_link(i[other], j[other], n, sig, percent)
            order = np.argsort(-agree, kind="stable")
            return i[order], j[order]

        size = np.diff(np.r_[start, len(cluster)])
        for i, j in _pairs(start[size <= MANY], size[size <= MANY]):
            for x, y in zip(*(v.tolist() for v in meeting(i, j)), strict=True):
                a, b = top(int(label[x])), top(int(label[y]))
                if a != b:
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= percent * (n[x] + n[y] - both):
                        root[max(a, b)] = min(a, b)
                        links.append((a, b))
        for first, many in zip(start[size > MANY].tolist(), size[size > MANY].tolist(), strict=True):
            i, j = meeting(*(first + v for v in np.triu_indices(many, 1)))
            row, token = _common(sets[first : first + many])
            values, at = np.unique([top(x) for x in label[first : first + many].tolist()], return_inverse=True)
            final, begin, take = np.arange(len(values)), 0, 4 * many
            while begin < len(i):
                x, y = i[begin : begin + take], j[begin : begin + take]
                apart = at[x - first] != at[y - first]
                x, y = x[apart], y[apart]
                both = _shared(many, row, token, x - first, y - first)
                near = 100 * both >= percent * (n[x] + n[y] - both)
                moved = _roots(len(values), at[x[near] - first], at[y[near] - first])
                at, final, begin, take = moved[at], moved[final], begin + take, 2 * take
            for a, b in zip(values[final].tolist(), values.tolist(), strict=True):
                if a != b:
                    root[b] = a
                    links.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


class _Join:
    """The distinct sets (rid, n, sig, doc_id, text_hash), the labels so far, and what has to be done with them."""

    def __init__(self, docs: DataFrame, sets: DataFrame, repeated: bool, k: int, percent: int, key: bytes):
        self.docs, self.sets, self.repeated, self.k, self.percent, self.key = docs, sets, repeated, k, percent, key
        self.changed: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        """rows with the label of their rid."""
        if self.changed is None:
            return rows.withColumn("label", F.col("rid"))
        return rows.join(self.changed, "rid", "left").withColumn("label", F.coalesce("to", "rid")).drop("to")

    def opened(self, children: DataFrame) -> DataFrame:
        """(node, tree, rid, label, size, top, minor) of the nodes in which there is more than one label: the node's sets, its commonest
        label, and how many sets have another."""
        keyed = saved(self.labelled(children), "paths_children")
        nodes = keyed.groupBy("node", "label").agg(F.count("*").alias("n")).groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("labels"))
        nodes = saved(nodes.where("labels > 1").select("node", "size", F.col("m.label").alias("top"), (F.col("size") - F.col("m.n")).alias("minor")), "paths_nodes")
        total = nodes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
        hot = F.broadcast(nodes.where(F.col("size") * HOT_SHARE > total))  # fewer than HOT_SHARE rows
        cold = nodes.where(F.col("size") * HOT_SHARE <= total)
        rows = keyed.join(hot, "node").unionByName(keyed.join(hot.select("node"), "node", "left_anti").join(cold, "node"))
        out = saved(rows.select("node", "tree", "rid", "label", "size", "top", "minor"), "paths_open")
        forget(keyed, nodes)
        return out

    def clusters(self, rows: DataFrame, salt: int) -> DataFrame:
        """Clusters (cluster, rid, home) of the blocks of nodes; a cluster that meets in several nodes counts once.

        A node is whole if all its sets of different labels meet: two sets are compared in the first whole node that both are in, and
        a large group, which is in as many nodes, doesn't meet in each. A signature is fetched once for each set, not for each node."""
        blocks = F.when(F.col("minor") > MINOR, F.ceil(F.col("size") / LEAF)).otherwise(F.greatest(F.lit(1), F.ceil((F.col("size") - F.col("minor")) / LEAF)))
        blocks = F.when(F.col("size") > LEAF, blocks).otherwise(F.lit(1)).cast("long")
        one = F.array(F.pmod(F.xxhash64("rid", F.lit(salt)), F.col("blocks")))
        everywhere = (F.col("minor") <= MINOR) & (F.col("label") != F.col("top"))
        nodes = F.array_sort(F.collect_list(F.struct("tree", "node", "size", "top", "minor"))).alias("nodes")
        each = rows.groupBy("rid").agg(F.first("label").alias("label"), nodes).join(self.sets.select("rid", "n", "sig"), "rid")
        whole = F.filter(F.slice("nodes", 1, F.col("at")), lambda x: (x["size"] <= LEAF) | (x["minor"] <= MINOR))
        placed = each.select("*", F.posexplode("nodes").alias("at", "here")).select("rid", "label", "n", "sig", "here.*", F.transform(whole, lambda x: x["node"]).alias("earlier"))
        dealt = placed.withColumn("blocks", blocks).withColumn("own", one[0]).withColumn("block", F.explode(F.when(everywhere, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(one)))
        groups = max(1, rows.count() // GROUP_ROWS)
        full = dealt.withColumn("group", F.pmod(F.xxhash64("node", "block"), F.lit(groups)))
        full = full.select("group", "node", "block", "rid", "label", "n", "sig", "earlier", (F.col("block") == F.col("own")).alias("home"))
        near = full.groupBy("group").applyInArrow(_near(self.percent), "cluster long, rid long, home boolean")
        return saved(near.groupBy("cluster", "rid").agg(F.max("home").alias("home")), "paths_clusters")

    def link(self, clusters: DataFrame, texts: DataFrame) -> bool:
        """Compare the sets of clusters that have more than one label, and give what is linked one label. False if nothing was."""
        rows = self.labelled(clusters.select("cluster", "rid", "home"))
        open_ = rows.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("cluster")
        rows = saved(rows.join(open_, "cluster"), "paths_compared")
        group = F.pmod(F.xxhash64("cluster"), F.lit(max(1, rows.count() // CLUSTER_ROWS))).alias("group")
        once = rows.groupBy("rid").agg(F.first("label").alias("label"), F.collect_list(F.struct("cluster", "home")).alias("clusters"))
        both = once.join(texts, "rid").select("rid", "label", "text", F.inline("clusters")).select(group, "cluster", "rid", "label", "home", "text")
        links = saved(both.groupBy("group").applyInArrow(_confirmed(self.k, self.percent, self.key), "a long, b long").distinct(), "paths_links")
        forget(rows)
        if linked := not links.isEmpty():
            moved = components(links, "paths_components").withColumnsRenamed({"label": "to", "node": "rid"})
            if before := self.changed:
                of = before.groupBy("to").agg(F.count("*").alias("n_rows")).join(moved.toDF("to", "further"), "to")
                further = spread_join(before, of, "to", before.count()).select("rid", F.coalesce("further", "to").alias("to"))
                moved = further.unionByName(moved.join(before.select("rid"), "rid", "left_anti"))
            self.changed = saved(moved, "paths_labels")
            if before:
                forget(before)
        forget(links)
        return linked

    def texts_of(self, rids: DataFrame) -> DataFrame:
        """(rid, text) of some sets: the text of one document of each."""
        wanted = self.sets.join(rids.distinct(), "rid", "left_semi").select("rid", "doc_id", "text_hash")
        found = self.docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(wanted, ["doc_id", "text_hash"]).select("rid", "text")
        return saved(found.groupBy("rid").agg(F.first("text").alias("text")) if self.repeated else found, "paths_texts")

    def run(self) -> None:
        rows = self.opened(self.sets.select("rid", "sig").mapInArrow(_branches(TREES, self.key), "node long, tree int, rid long"))
        open_ = saved(rows.where((F.col("size") > LEAF) & (F.col("minor") > MINOR)).select("node", "tree", "rid"), "paths_large")
        clusters = self.clusters(rows, 0)
        forget(rows)
        # whatever is compared further down is in a large node now
        texts = self.texts_of(clusters.select("rid").unionByName(open_.select("rid")))
        self.link(clusters, texts)
        forget(clusters)
        level, idle = 1, 0
        while idle < LAST_PASSES and not open_.isEmpty():
            deeper = level < COORDINATES // 2
            once = open_.groupBy("rid").agg(F.collect_list(F.struct("node", "tree")).alias("nodes")).join(self.sets.select("rid", "sig"), "rid")
            children = once.select("rid", "sig", F.inline("nodes")).mapInArrow(_branches(TREES, self.key), "node long, tree int, rid long") if deeper else open_
            rows = self.opened(children)
            clusters = self.clusters(rows, level)
            linked = self.link(clusters, texts)
            idle = 0 if linked or deeper else idle + 1
            forget(open_, clusters)
            open_ = saved(rows.where((F.col("size") > LEAF) & (F.col("minor") > MINOR)).select("node", "tree", "rid"), "paths_large")
            forget(rows)
            level += 1
        forget(open_, texts)


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose sets of k-word shingles have a Jaccard similarity of at least percent / 100, by chosen paths.

    Words are runs without ASCII white space, A-Z as a-z. A text of fewer words is one shingle; a text without words, empty or
    null, has no shingles and no links. Returns doc_id, n_shingles, component_id (the least doc_id of the component) and kept
    (whether that is the row's own), one row for each input row. Rows without doc_id link nothing, have no component and are kept;
    of rows with one doc_id each counts by its own text. Other columns are left out. Every link is confirmed on whole sets, known by
    64-bit hashes under a key that each call draws anew; the trees leave out fewer than two links in 100,000.
    """
    if percent < PERCENT:
        raise ValueError(f"the number of trees is for similarities of {PERCENT} % and more")
    spark, key = docs.sparkSession, new_key()
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_described(k, key), f"doc_id {kind}, text_hash long, n_shingles long, set binary, sig binary")
    each = saved(described, "paths_each")
    known = each.where("doc_id IS NOT NULL AND set IS NOT NULL")
    repeated = not known.groupBy("doc_id").count().where("count > 1").isEmpty()
    one = known.groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_rows"))
    sets = one.join(known.select("set", "doc_id", "text_hash", F.col("n_shingles").alias("n"), "sig"), ["set", "doc_id"])
    sets = saved((sets.dropDuplicates(["set"]) if repeated else sets).withColumn("rid", F.monotonically_increasing_id()), "paths_sets")
    join = _Join(docs, sets, repeated, k, percent, key)
    join.run()
    labels = join.labelled(sets.select("rid", "set", "doc_id", F.col("n_rows").alias("rows_of_set")))
    least = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_rows"))
    final = saved(spread_join(labels, least, "label", sets.count()).select("set", "component_id", F.col("rows_of_set").alias("n_rows")), "paths_final")
    mine = each.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set")).alias("set"))
    out = spread_join(mine, final, "set", each.count()).withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
