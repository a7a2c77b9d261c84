"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

Vectors are compared within a label (and a length). Equal vectors are one representative with a weight.
The representatives of a label are dealt to shards of about ``SHARD``; a graph is built per shard and written, and
every vector queries the graph of every shard of its label. Found links are verified by cosine in double precision,
and the sets that they connect are completed by comparing all their members, so that the numbers of links are
whole. In each pair of shards the links of a sample of queries, one in ``AUDIT`` by a hash of the id, are also found by
brute force; while one of them lies across two sets, all beams of the pair are widened, in the end to the whole shard. A
pair with fewer than ``LEAST_AUDIT`` such queries is scanned at once.
A task returns per vector a weight of links and a member of the same set, not the pairs; the sets are united by
distributed components.

Vectors that are null, empty, zero, or hold null or non-finite components, and vectors without label, link with
nothing: n_links 0, own component. Repeated ids are vectors of their own, each with the links of its own label and
components, but share a node. A null id keeps a null component. An empty table gives no rows. Only vec_id, embedding and label
are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import mixed
from meterline.llm.components import components
from meterline.llm.hnsw import Graph, levels
from meterline.session import cut

#: One vector in ``AUDIT``, by a hash of its id, is audited, at least ``LEAST_AUDIT`` in a pair of shards.
SHARD, AUDIT, LEAST_AUDIT = 4096, 20, 32
#: First width of the beams; cosines in the graph are single precision, so the search limit is a little lower.
BEAM, MARGIN = 24, 1e-5

_BUILT = "label {kind}, dim int, shard int, shards int, key string, rep bigint, weight bigint, vec array<double>, level int, links array<array<int>>"


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their class (null: links with nothing), and one representative per class."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    usable = F.col("label").isNotNull() & x.isNotNull() & F.col("vec_id").isNotNull() & ~bad & F.exists(x, lambda v: v != 0)
    key = F.when(usable, F.md5(F.concat_ws(",", F.transform(x, lambda v: v.cast("string"))).cast("binary")))
    rows = vectors.select("vec_id", "label", F.size("embedding").alias("dim"), key.alias("key"), F.transform("embedding", lambda v: v.cast("double")).alias("vec"))
    groups = rows.where(F.col("key").isNotNull()).groupBy("label", "dim", "key")
    reps = groups.agg(F.min(F.col("vec_id").cast("long")).alias("rep"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    return rows.select("vec_id", "label", "key"), reps


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    x = flat.flatten().to_numpy().reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small values stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _build(t: pa.Table) -> pa.Table:
    t = t.sort_by("rep")
    x = _matrix(t["vec"])
    level = levels(t["rep"].to_numpy())
    graph = Graph(x, level)
    links = [[graph.layers[k][i][graph.layers[k][i] >= 0].tolist() for k in range(level[i] + 1)] for i in range(len(x))]
    out = t.append_column("level", pa.array(level, pa.int32()))
    return out.append_column("links", pa.array(links, pa.list_(pa.list_(pa.int32()))))


def _load(t: pa.Table) -> tuple[np.ndarray, Graph]:
    t = t.sort_by("rep")
    x, level = _matrix(t["vec"]), t["level"].to_numpy()
    lists = t["links"].to_pylist()
    width = max(1, max((len(k) for row in lists for k in row), default=1))
    layers = [np.full((len(x), width), -1) for _ in range(int(level.max(initial=0)) + 1)]
    for i, row in enumerate(lists):
        for k, near in enumerate(row):
            layers[k][i, : len(near)] = near
    return x, Graph(x, level, layers)


class _Sets:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def _search(x: np.ndarray, y: np.ndarray, graph: Graph, least: float, width: int, own: bool = False) -> np.ndarray:
    """Links (row of ``x``, row of ``y``) that beams of this width find, verified; beams as wide as ``y`` are a scan."""
    if width >= len(y):
        return np.concatenate([np.stack(np.nonzero(x[s : s + 512] @ y.T >= least), 1) + [s, 0] for s in range(0, len(x), 512)])
    i, j = graph.within(x, least - MARGIN, width, own)
    good = np.einsum("nd,nd->n", x[i], y[j]) >= least
    return np.stack([i[good], j[good]], 1)


def _compare(t: pa.Table, least: float) -> pa.Table:
    """Of one pair of shards: per linked class the weight of its links and the smallest member of its set."""
    own, first = t["shard"].to_numpy(), t["x"][0].as_py()
    same = first == t["y"][0].as_py()
    sides = [t.filter(pa.array(own == first)).sort_by("rep")]
    if not same:
        sides.append(t.filter(pa.array(own != first)).sort_by("rep"))
    rep = np.concatenate([s["rep"].to_numpy() for s in sides])
    weight = np.concatenate([s["weight"].to_numpy() for s in sides])
    key = pa.concat_arrays([c for s in sides for c in s["key"].chunks])
    (x, gx), (y, gy) = _load(sides[0]), _load(sides[-1])
    z, n = np.concatenate([x, y][: len(sides)]), len(x)
    side = np.arange(len(z)) >= n
    allowed = (lambda rows: rows[:, None] != np.arange(len(z))) if same else (lambda rows: side[rows][:, None] != side)
    audit = np.flatnonzero(mixed(rep.astype(np.uint64)) % np.uint64(AUDIT) == 0)
    truth = [np.zeros((0, 2), int)]
    for s in range(0, len(audit), 512):
        part = audit[s : s + 512]
        i, j = np.nonzero((z[part] @ z.T >= least) & allowed(part))
        truth.append(np.stack([part[i], j], 1))
    truth = np.concatenate(truth)
    # too few of them tell nothing of what beams miss: such a pair is scanned
    width, sets = BEAM if len(audit) >= LEAST_AUDIT else len(z), _Sets(len(z))
    while True:
        found = _search(x, y, gy, least, width, same)
        if not same:
            back = _search(y, x, gx, least, width)
            found = np.concatenate([found + [0, n], back[:, ::-1] + [0, n]])
        for i, j in found.tolist():
            sets.join(i, j)
        if width >= n and width >= len(y) or all(sets.find(i) == sets.find(j) for i, j in truth.tolist()):
            break
        width *= 2
    root = np.array([sets.find(i) for i in range(len(z))], int)
    order = np.argsort(root, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(root[order])) + 1, [len(root)]])
    total = np.zeros(len(z), np.int64)
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        who = order[s:e]  # the members of a set, compared with one another in blocks
        for k in range(0, len(who) if len(who) > 1 else 0, 1024):
            part = who[k : k + 1024]
            total[part] = ((z[part] @ z[who].T >= least) & allowed(part)[:, who]) @ weight[who]
    linked = total > 0
    label = pa.repeat(t["label"][0], int(linked.sum()))
    return pa.table({"label": label, "key": key.filter(pa.array(linked)), "rep": rep[linked], "links": total[linked], "member": rep[root[linked]]})


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    kind, label = dict(vectors.dtypes)["vec_id"], dict(vectors.dtypes)["label"]
    rows, reps = classes(vectors)
    reps = cut(reps, "classes")
    sizes = reps.groupBy("label", "dim").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    dealt = dealt.select("label", "dim", "shard", "shards", "key", "rep", "weight", "vec")
    graphs = cut(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, _BUILT.format(kind=label)), "graphs")
    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    pairs = pairs.withColumns({"x": F.least("shard", "other"), "y": F.greatest("shard", "other")}).drop("other")
    found = cut(pairs.groupBy("label", "dim", "x", "y").applyInArrow(lambda t: _compare(t, least), f"label {label}, key string, rep bigint, links bigint, member bigint"), "links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("member").alias("b")))
    counts = found.groupBy("label", "key").agg(F.sum("links").alias("links"))
    each = reps.select("label", "key", "rep", "weight").join(counts, ["label", "key"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    links = (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")
    each = each.select(F.col("label").alias("l"), F.col("key").alias("k"), links, F.coalesce("root", "rep").alias("root"))
    out = rows.join(each, (F.col("label") == F.col("l")) & (F.col("key") == F.col("k")), "left")
    component = F.coalesce(F.col("root").cast(kind), F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
