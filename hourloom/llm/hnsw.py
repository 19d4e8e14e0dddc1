"""Near duplicates among embeddings with a navigable small-world graph per shard.

Equal vectors of a label become one node. The nodes of a label are dealt by hash to shards of at most about ``SHARD``,
and every shard gets a hierarchy of layers, each a graph of near neighbours; a node reaches layer l with chance
``M``**-l. Every node searches every shard of its label: down the layers to a start, then a beam on the lowest.
A sample of queries is audited against all vectors of the shard, and the beam is doubled until the audit finds
``RECALL`` of the true links; a query whose whole beam links searches on with twice the beam. A node's match with
itself is no link, and the sample grows until it has ``ENOUGH`` links or all queries. A beam as wide as the shard
compares with all of it, so nothing is out of reach. Found pairs are verified by cosine in double precision.

Every pair of shards is a group of its own, however many a label has. It is searched once, in one direction, and counts
for both sides; of its links only the counts by node and a spanning forest leave the task, so a large group never becomes
pairs of rows.

Defined cases: a null, empty or zero vector, one with null or non-finite components, a null label or a null id links
with nothing and is its own component; vectors of different length don't link; equal vectors link, repeated rows
too; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm import words
from hourloom.llm.components import components
from hourloom.llm.storage import stored

THRESHOLD = 0.98
#: Nodes of a shard, fewer if the vectors would take more bytes.
SHARD, SHARD_BYTES = 4096, 32 << 20
#: Neighbours of a node (twice as many on the lowest layer), beam of the construction, first beam of a search.
M, BUILD_BEAM, BEAM = 16, 64, 32
#: Audited queries of a pair of shards, and the share of their links to be found.
AUDITED, RECALL = 256, 0.995
#: Links that tell ``RECALL`` from less; of fewer, none may be missing.
ENOUGH = 200
BLOCK, AT_ONCE = 256, 4
#: Single precision is this far from double at most, for the search to keep a pair for verification.
SLACK = 1e-5


def beam_search(vectors, links, queries, starts, beam):
    """Ids and similarities (best first, -1 for none) found from the starts by a beam of the given width."""
    n, found_ids, found_sims = len(vectors), [], []
    for lo in range(0, len(queries), BLOCK):
        q, first = queries[lo : lo + BLOCK], starts[lo : lo + BLOCK]
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n + 1), dtype=bool)
        seen[:, n] = True
        ids = np.full((len(q), beam), n)
        sims = np.full((len(q), beam), -np.inf, dtype=np.float32)
        done = np.ones((len(q), beam), dtype=bool)
        ids[:, 0], sims[:, 0], done[:, 0] = first, np.einsum("qd,qd->q", q, vectors[first]), False
        seen[rows, first] = True
        live = rows
        while len(live):
            own = np.where(done[live], -np.inf, sims[live])
            width = min(AT_ONCE, beam)
            pick = np.argpartition(-own, width - 1, axis=1)[:, :width]
            open_ = np.take_along_axis(own, pick, 1) > -np.inf
            done[live[:, None], pick] = True
            from_ids = np.where(open_, np.take_along_axis(ids[live], pick, 1), n)
            near = np.where(from_ids[:, :, None] < n, links[np.minimum(from_ids, n - 1)], n).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            near[seen[live[:, None], near]] = n
            seen[live[:, None], near] = True
            fresh = np.einsum("qd,qkd->qk", q[live], vectors[np.minimum(near, n - 1)])
            fresh[near == n] = -np.inf
            all_sims = np.concatenate([sims[live], fresh], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), top, 1)
            flags = np.concatenate([done[live], near == n], axis=1)
            sims[live], done[live] = np.take_along_axis(all_sims, top, 1), np.take_along_axis(flags, top, 1)
            live = live[~done[live].all(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        found_ids.append(np.take_along_axis(ids, order, 1))
        found_sims.append(np.take_along_axis(sims, order, 1))
    if not found_ids:
        return np.zeros((0, beam), np.int64), np.zeros((0, beam), np.float32)
    ids = np.concatenate(found_ids)
    return np.where(ids < n, ids, -1), np.concatenate(found_sims)


def chosen(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Neighbours for one node among candidates, best first: half of them each nearer to the node than to those taken
    before, so that they lead to different places, the rest the nearest."""
    if len(ids) <= most:
        return ids
    between = vectors[ids] @ vectors[ids].T
    taken: list[int] = []
    for i in range(len(ids)):
        if not taken or between[i, taken].max() < sims[i]:
            taken.append(i)
            if len(taken) == most // 2:
                break
    rest = [i for i in range(len(ids)) if i not in set(taken)]
    return ids[taken + rest[: most - len(taken)]]


def linked_layer(vectors: np.ndarray, members: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Neighbour lists (place in ``vectors``, len(vectors) for none) of one layer; members join in batches that double,
    each by a beam search among those before it. ``starts``: a member of the layer above near each member."""
    n = len(vectors)
    links = np.full((n, most), n)
    position = {int(m): i for i, m in enumerate(members)}

    def attach(node: int, others: np.ndarray) -> None:
        kept = links[node][links[node] < n]
        fresh = np.setdiff1d(others[others != node], kept)
        both = np.concatenate([kept, fresh])
        sims = vectors[both] @ vectors[node]
        order = np.argsort(-sims, kind="stable")
        both = chosen(vectors, both[order], sims[order], most)
        links[node] = n
        links[node, : len(both)] = both

    first = members[: 2 * most]
    sims = vectors[first] @ vectors[first].T
    for i, node in enumerate(first.tolist()):
        attach(node, first[np.argsort(-sims[i], kind="stable")][: most + 1])
    at = len(first)
    while at < len(members):
        batch = members[at : min(2 * at, at + 1024)]
        # a start that has not joined yet gives way to the first member
        begin = np.array([s if position.get(s, at) < at else int(members[0]) for s in starts[at : at + len(batch)].tolist()])
        ids, sims = beam_search(vectors, links, vectors[batch], begin, BUILD_BEAM)
        back: dict[int, list[int]] = {}
        for node, own, s in zip(batch.tolist(), ids, sims):
            near = chosen(vectors, own[own >= 0], s[own >= 0], most)
            links[node, : len(near)] = near
            for other in near.tolist():
                back.setdefault(other, []).append(node)
        for other, nodes in back.items():
            attach(other, np.array(nodes))
        at += len(batch)
    # nobody may be out of reach: who has lost all links to it takes the last place at its nearest neighbour
    for node in np.setdiff1d(members, links[members]).tolist():
        near = links[node, 0]
        if near < n:
            links[near, -1] = node
    return links


def built(vectors: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The layers of a graph from the top: members, and neighbour lists."""
    n = len(vectors)
    keys = (keys.astype(np.int64).view(np.uint64) + np.uint64(1)) * words.ODD
    draw = (words.mix(keys) >> np.uint64(11)).astype(np.float64) + 0.5
    height = np.floor(-np.log(draw * 2.0**-53) / np.log(M)).astype(int)
    order = np.argsort(words.mix(keys + words.ODD), kind="stable")
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(int(height.max()) if n else 0, -1, -1):
        members = order[height[order] >= level]
        starts = descend(vectors, layers, vectors[members]) if layers else members
        layers.append((members, linked_layer(vectors, members, starts, M if level else 2 * M)))
    return layers


def descend(vectors, layers, queries) -> np.ndarray:
    """The nearest node that a narrow beam reaches on the given layers, from the top one."""
    at = np.full(len(queries), int(layers[0][0][0]))
    for _, links in layers:
        at = beam_search(vectors, links, queries, at, 2)[0][:, 0]
    return at


class Graph:
    """A shard: nodes, how many vectors each stands for, unit vectors, layers."""

    def __init__(self, row: dict, dim: int):
        self.nodes = np.frombuffer(row["nodes"], dtype=np.int64)
        self.counts = np.frombuffer(row["counts"], dtype=np.int64)
        self.exact = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, dim)
        self.vectors = self.exact.astype(np.float32)
        n, at, self.layers = len(self.nodes), 0, []
        flat = np.frombuffer(row["layers"], dtype=np.int32)
        while at < len(flat):
            size, most = int(flat[at]), int(flat[at + 1])
            members = flat[at + 2 : at + 2 + size].astype(np.int64)
            at += 2 + size
            links = np.full((n, most), n)
            links[members] = flat[at : at + size * most].reshape(size, most)
            at += size * most
            self.layers.append((members, links))

    @staticmethod
    def packed(layers: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
        parts = []
        for members, links in layers:
            parts += [np.array([len(members), links.shape[1]]), members, links[members].ravel()]
        return np.concatenate(parts).astype(np.int32).tobytes()

    def near(self, queries: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of what a beam finds at similarity ``least``; queries whose whole beam is that near widen it."""
        n = len(self.nodes)
        if beam >= n:
            pairs = [np.argwhere(queries[i : i + 1024] @ self.vectors.T >= least) + [i, 0] for i in range(0, len(queries), 1024)]
            pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            return pairs[:, 0], pairs[:, 1]
        starts = descend(self.vectors, self.layers[:-1], queries) if len(self.layers) > 1 else None
        if starts is None:
            starts = np.full(len(queries), int(self.layers[0][0][0]))
        ids, sims = beam_search(self.vectors, self.layers[-1][1], queries, starts, beam)
        hit = (sims >= least) & (ids >= 0)
        full = np.flatnonzero(hit.all(axis=1))
        hit[full] = False
        row, column = np.nonzero(hit)
        place = ids[row, column]
        if len(full):
            more, there = self.near(queries[full], 2 * beam, least)
            row, place = np.concatenate([row, full[more]]), np.concatenate([place, there])
        return row, place

    def audited_beam(self, queries: np.ndarray, least: float, itself: bool = False) -> int:
        """The first beam that finds ``RECALL`` of the links of a sample; ``itself``: the queries are the shard's nodes."""
        n, step = len(self.nodes), max(1, len(queries) // AUDITED)
        while True:
            sample = np.arange(0, len(queries), step)
            # pairs at the very edge of the slack may differ in rounding, and none of them is a link
            row, place = self.near(queries[sample], n, least + SLACK / 2)
            row = sample[row]
            if itself:
                row, place = row[row != place], place[row != place]
            if len(row) >= ENOUGH or step == 1:
                break
            step //= 2
        true, linked = row * n + place, np.unique(row)
        beam = BEAM
        while beam < n and len(true):
            row, place = self.near(queries[linked], beam, least)
            if np.isin(true, linked[row] * n + place).sum() >= RECALL * len(true):
                break
            beam *= 2
        return beam


def build_rows(key, table):
    label, dim, shard = (k.as_py() for k in key)
    exact = np.array(table["vector"].combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)
    exact /= np.abs(exact).max(axis=1, keepdims=True)
    exact /= np.sqrt((exact * exact).sum(axis=1, keepdims=True))
    nodes = table["node"].to_numpy().astype(np.int64)
    layers = built(exact.astype(np.float32), nodes)
    return pa.table(
        {
            "label": pa.array([label], table["label"].type),
            "dim": pa.array([dim], pa.int32()),
            "shard": pa.array([shard], pa.int64()),
            "nodes": pa.array([nodes.tobytes()], pa.binary()),
            "counts": pa.array([table["count"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([exact.tobytes()], pa.binary()),
            "layers": pa.array([Graph.packed(layers)], pa.binary()),
        }
    )


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is linked with."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, u, low[v])
        np.minimum.at(low, v, low[u])
        low = low[low]
        if (low == before).all():
            return low


def search_rows(threshold: float):
    kinds = {"node": pa.int64(), "other": pa.int64(), "links": pa.int64(), "beam": pa.int32()}

    def search(key, table):
        dim = key[1].as_py()
        ends = sorted(table.to_pylist(), key=lambda row: row["shard"])
        if ends[0]["low"] < ends[0]["high"] and len(ends) == 1:  # no vector fell to the other shard
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        graphs = [Graph({k: row[k] for k in ("nodes", "counts", "vectors", "layers")}, dim) for row in ends]
        one, two = graphs[0], graphs[-1]
        least = threshold - SLACK
        beam = two.audited_beam(one.vectors, least, one is two)
        u, v = two.near(one.vectors, beam, least)
        if one is two:
            u, v = np.minimum(u, v), np.maximum(u, v)
            pairs = np.unique(u[u != v] * len(one.nodes) + v[u != v])
            u, v = pairs // len(one.nodes), pairs % len(one.nodes)
        parts = [slice(i, i + (1 << 18)) for i in range(0, len(u), 1 << 18)]
        cosine = [np.einsum("kd,kd->k", one.exact[u[p]], two.exact[v[p]]) for p in parts]
        true = np.concatenate(cosine) >= threshold if cosine else np.zeros(0, bool)
        u, v = u[true], v[true]
        # places of both shards in a row, a shard with itself once
        n = len(one.nodes)
        shift = 0 if one is two else n
        nodes = one.nodes if one is two else np.concatenate([one.nodes, two.nodes])
        links = np.bincount(u, weights=two.counts[v], minlength=len(nodes)).astype(np.int64)
        links += np.bincount(v + shift, weights=one.counts[u], minlength=len(nodes)).astype(np.int64)
        low = forest(len(nodes), u, v + shift)
        some, joined = np.flatnonzero(links), np.flatnonzero(low != np.arange(len(nodes)))
        return pa.table(
            {
                "node": pa.array(np.concatenate([nodes[some], nodes[joined]]), pa.int64()),
                "other": pa.array([None] * len(some) + nodes[low[joined]].tolist(), pa.int64()),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(joined), np.int64)]), pa.int64()),
                "beam": pa.array(np.full(len(some) + len(joined), beam), pa.int32()),
            }
        )

    return search


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", "label", vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    usable = usable & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    nodes = rows.where(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("count"))
    nodes = nodes.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")})
    nodes = stored(nodes, "nodes")
    per = F.least(F.lit(shard), F.greatest(F.lit(SHARD_BYTES) / (8 * F.col("dim")), F.lit(16)))
    total = nodes.groupBy("label", "dim").count().select("label", "dim", F.ceil(F.col("count") / per).alias("shards"))
    dealt = nodes.join(total, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    kind = dict(rows.dtypes)["label"]
    schema = f"label {kind}, dim int, shard long, nodes binary, counts binary, vectors binary, layers binary"
    # dealt anew by the whole key: the join's partitioning by label would put all shards of a label into one task
    dealt = dealt.repartition("label", "dim", "shard")
    graphs = stored(dealt.groupBy("label", "dim", "shard").applyInArrow(build_rows, schema), "graphs")
    ends = graphs.join(total, ["label", "dim"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    ends = ends.withColumns({"low": F.least("shard", "other"), "high": F.greatest("shard", "other")}).drop("other", "shards")
    ends = ends.repartition("label", "dim", "low", "high")
    found = ends.groupBy("label", "dim", "low", "high").applyInArrow(
        search_rows(threshold), "node long, other long, links long, beam int"
    )
    found = stored(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = nodes.join(links, "node", "left").join(classes.withColumnRenamed("id", "node"), "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    known = stored(known.select("label", "vector", "least", "count", "links", "component"), "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "label", "vector", (F.col("count") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.withColumn("usable", usable).join(known.withColumn("usable", F.lit(True)), ["label", "vector", "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
