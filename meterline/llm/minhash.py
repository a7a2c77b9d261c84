"""Near-duplicate documents by HyperMinHash.

A document is the set of its shingles. Each shingle's hash names a bucket (register) and a value; a register keeps the
least value of its bucket as a count of leading zeros and the next mantissa bits, 16 bits in all. Empty registers borrow
from another one by a fixed permutation, so that short documents can be compared too. Bands of registers bring
candidates together, the share of equal registers, corrected for accidental collisions, estimates their similarity,
and what could reach the limit is verified on the full sets.

Copies with equal sets are one representative from the start. Links are then found in two rounds, without emitting
the pairs of a group: first each representative is verified against the best of the first members of its
bands, which joins most of a group through few documents; then, only in buckets that still hold more than one
component, every pair across components is estimated in blocks of bounded size, and verified if near enough, so that
no link is lost to the choice of the first round.

Empty and null texts have no set: n_shingles 0, linked with nothing. Repeated ids are one node (but see
``distinct_documents``). A row without id is kept as its own component (null). Very long texts are sets like others, ties in
estimates go to the smaller id, an empty table gives no rows. Only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import SMALL_TABLE, WordHashes, give_back, map_texts, mixed, ranked, shingles, small_batches, small_table, sorted_slices, word_hashes
from meterline.llm.components import components
from meterline.session import cut

REGISTERS, MANTISSA = 128, 10
BANDS, ROWS = 25, 5
#: Representatives of a bucket that are compared in one block at most (on average).
BLOCK = 512
#: Members of a bucket whose pairs are emitted at most; a row has fewer than so many of them. Larger buckets are compared
#: where their blocks are, and only links that join components are emitted.
FEW = 16
_SHIFT = np.uint64(64 - 7)
#: Accidental equality of two unrelated registers: sum over z of (2 ** -z) ** 2, spread over the mantissa.
COLLISION = (1 / 3) / 2**MANTISSA


def _borrowing() -> np.ndarray:
    """Row j: all registers in the order in which an empty register j looks for a full one."""
    order = np.arange(REGISTERS * REGISTERS, dtype=np.uint64).reshape(REGISTERS, REGISTERS)
    return np.argsort(mixed(order * np.uint64(2) + np.uint64(1)), axis=1)


_ORDER = _borrowing()


def registers(found: np.ndarray) -> np.ndarray:
    """16-bit registers of an ascending array of distinct shingle hashes (at least one)."""
    bucket = (found >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    value = found[first] << np.uint64(7)
    zeros = np.minimum(64 - np.frexp(value.astype(np.float64))[1], 57).astype(np.uint64)
    mantissa = (value << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(REGISTERS, np.uint16)
    full = np.zeros(REGISTERS, bool)
    out[bucket[first]] = (zeros << np.uint64(MANTISSA)) | mantissa
    full[bucket[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        out[empty] = out[_ORDER[empty, full[_ORDER[empty]].argmax(1)]]
    return out


def shingle_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashes.of(text.lower().split()), width))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (size of the set), h (hash of the set) and sig (registers); h and sig are null without words."""
    def work(texts: list[bytes]) -> dict[str, object]:
        hashes = word_hashes()
        n, h, sig = [], [], []
        for text in texts:
            found = shingle_set(text, width, hashes)
            n.append(len(found))
            h.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            sig.append(registers(found).tobytes() if len(found) else None)
        return {"n": pa.array(n, pa.int64()), "h": pa.array(h, pa.binary()), "sig": pa.array(sig, pa.binary())}

    return map_texts(docs, work, "n bigint, h binary, sig binary")


def estimate(equal: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less what accident makes equal."""
    return (equal - COLLISION) / (1 - COLLISION)


def least_estimate(percent: int) -> float:
    """Four standard deviations below the limit."""
    t = percent / 100
    return t - 4 * float(np.sqrt(t * (1 - t) / REGISTERS))


def _as_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _estimated(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, sa, sb) whose estimate may reach the limit, with the estimate."""
    least = least_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            share = estimate((_as_registers(batch.column(2)) == _as_registers(batch.column(3))).mean(axis=1))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], ["a", "b", "est"])
            yield out.filter(pa.array(share >= least))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint, est double")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents named by ``ids``, written; few ids are broadcast, many are joined."""
    ids = cut(ids.distinct(), "ids")
    if ids.count() <= SMALL_TABLE:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return cut(texts.join(ids, "doc_id", "left_semi"), "texts")


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(one) + len(two)
    common = both - len(np.unique(np.concatenate([one, two])))
    return 100 * common >= percent * (both - common)


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough.

    Texts that are in no pair are left behind first; then the text of ``b`` comes to the rows of ``a``. A document that is
    the ``b`` of very many pairs is a hot join key, which the adaptive skew join splits.
    """
    small_batches(docs.sparkSession)
    held = _texts_of(docs, pairs.select("a").unionAll(pairs.select("b")).toDF("doc_id"))
    left = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept, hashes = None, None, word_hashes()
        for batch in batches:
            ok = []
            ids, ta, tb = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for b, x, y in zip(ids, ta, tb, strict=True):
                if last != (b, len(y)):
                    last, kept = (b, len(y)), shingle_set(y, width, hashes)
                ok.append(similar(shingle_set(x, width, hashes), kept, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    binary = [F.col(c).cast("binary").alias(c) for c in ("ta", "tb")]
    return both.select("a", "b", *binary).mapInArrow(run, "a bigint, b bigint")


def _bands(reps: DataFrame) -> DataFrame:
    """rep, band, key: one row per band of a representative."""
    size = 2 * ROWS
    keys = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.expr(f"substring(sig, {1 + size * i}, {size})"), F.lit(i)).alias("key")) for i in range(BANDS)]
    return reps.select("rep", F.explode(F.array(*keys)).alias("k")).select("rep", "k.band", "k.key")


def _first_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """Each representative with the smallest member of each of its bands, estimated."""
    bands = _bands(reps)
    heads = bands.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b < top").drop("top")
    pairs = bands.join(heads, "key").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    sides = pairs.join(reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a").join(
        reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b"
    )
    return _estimated(sides.where(_sizes(percent)), percent)


def _sizes(percent: int):
    return F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")


def _unresolved(reps: DataFrame, roots: DataFrame) -> DataFrame:
    """key, x, y, own, band, rep, root, n, sig, m: members of buckets with more than one component, dealt to pairs of blocks."""
    rooted = reps.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "rep"))
    bands = _bands(reps).join(rooted.select("rep", "root"), "rep")
    mixed_up = bands.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = bands.join(mixed_up.select("key", "m", blocks.alias("blocks")), "key").join(rooted.select("rep", "n", "sig"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "band", "rep", "root", "n", "sig", "m")


def _candidates(t: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of one pair of blocks: a row and the rows that it shares its first band with, by size and estimate near enough."""
    own, rep, n = (t[c].to_numpy() for c in ("own", "rep", "n"))
    x, y, band, least = t["x"][0].as_py(), t["y"][0].as_py(), t["band"][0].as_py(), least_estimate(percent)
    sig = _as_registers(t["sig"])
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    for i in left:
        j = right[rep[right] > rep[i]] if x == y else right
        j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
        if not len(j):
            continue
        same = sig[j] == sig[i]
        good = estimate(same.mean(axis=1)) >= least
        # the pair belongs to the first band that it shares
        first = same[good][:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        yield i, j[good][first]


def _pairs_of(t: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Pairs of different components, not verified."""
    rep, root = t["rep"].to_numpy(), t["root"].to_numpy()
    a, b = [], []
    for i, j in _candidates(t, percent):
        j = j[root[j] != root[i]]
        a += [int(rep[i])] * len(j)
        b += rep[j].tolist()
    return a, b


def _links_of(t: pa.Table, percent: int, width: int) -> tuple[list[int], list[int]]:
    """Verified links that join components; a pair is compared only while its components are apart."""
    rep, texts = t["rep"].to_numpy(), t["text"].to_pylist()
    up = {r: r for r in t["root"].to_pylist()}
    root = t["root"].to_pylist()
    sets: dict[int, np.ndarray] = {}
    hashes = word_hashes()

    def top(r: int) -> int:
        while up[r] != r:
            up[r] = up[up[r]]
            r = up[r]
        return r

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(texts[i], width, hashes)
        return sets[i]

    a, b = [], []
    for i, near in _candidates(t, percent):
        for j in near.tolist():
            p, q = top(root[i]), top(root[j])
            if p != q and similar(of(i), of(j), percent):
                up[max(p, q)] = min(p, q)
                a.append(int(rep[i])), b.append(int(rep[j]))
    return a, b


def _by_block(rows: DataFrame, work) -> DataFrame:
    """``work`` on the rows of every pair of blocks, which are few enough for one table."""
    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        at = None

        def done() -> pa.RecordBatch:
            a, b = work(pa.Table.from_batches(open_))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

        for batch in batches:
            marks = np.stack([batch.column(i).to_numpy() for i in range(3)])
            edges = np.concatenate([[0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s == e:
                    continue
                if open_ and tuple(marks[:, s]) != at:
                    yield done()
                    open_.clear()
                at = tuple(marks[:, s])
                open_.append(batch.slice(s, e - s))
        if open_:
            yield done()

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    held = cut(signatures(rows, width), "signatures")
    full = held.where("n > 0 AND doc_id IS NOT NULL")
    reps = cut(full.groupBy("h", "n").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "classes")
    first = cut(_first_pairs(reps, percent), "pairs")
    best = first.groupBy("a").agg(F.max(F.struct("est", (-F.col("b")).alias("minus"))).alias("m")).select("a", (-F.col("m.minus")).alias("b"))
    links = [cut(verified(best, rows, width, percent), "links")]
    roots = components(links[0])
    open_ = cut(_unresolved(reps, roots), "buckets")
    if not open_.isEmpty():
        small = _by_block(open_.where(F.col("m") <= FEW), lambda t: _pairs_of(t, percent))
        known = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = cut(small.join(known, ["a", "b"], "left_anti"), "pairs")
        links.append(cut(verified(rest, rows, width, percent), "links"))
        large = open_.where(F.col("m") > FEW)
        texts = _texts_of(rows, large.select(F.col("rep").alias("doc_id")))
        texts = texts.select(F.col("doc_id").alias("rep"), F.col("text").cast("binary").alias("text"))
        links.append(cut(_by_block(large.join(texts, "rep").select(*large.columns, "text"), lambda t: _links_of(t, percent, width)), "links"))
        roots = components(reduce(DataFrame.unionAll, links))
    classes = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("h", "n", F.coalesce("root", "rep").alias("component_id"))
    out = held.join(classes, ["h", "n"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component_id").cast(kind).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as __row, __node and text: the id is the node, unless one id has several texts.

    Then the nodes are the places, from 0, of the pairs of id and text in their order, so that every text is a node of
    its own and the node of a smaller id is smaller. A row without id has no node.
    """
    mark = F.xxhash64(F.col("text"), F.col("text").isNull())
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long").alias("__node"), mark.alias("__mark"), "text")
    pairs = cut(rows.where("__node IS NOT NULL").select("__node", "__mark").distinct(), "ids")
    if pairs.groupBy("__node").count().where("count > 1").isEmpty():
        return rows.drop("__mark")
    places = ranked(sorted_slices(pairs, ["__node", "__mark"], "pairs"), []).select("__node", "__mark", F.col("__rank").alias("__place"))
    return rows.join(places, ["__node", "__mark"], "left").select("__row", F.col("__place").alias("__node"), "text")


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: of every component the one with the smallest id.

    Rows without words have no copies and stay, and so do rows without id. Texts that share an id are documents of
    their own: each stays or goes for itself. Of rows with one id and one text, one stays. The nodes that go are few or
    many: few are broadcast, many are joined with the rows.
    """
    rows = _numbered(docs)
    found = cut(near_duplicates(rows.select(F.col("__node").alias("doc_id"), "text"), width, percent), "components")
    gone = small_table(found.where(~F.col("kept")).select(F.col("doc_id").alias("__node")).distinct(), "gone")
    stay = rows.drop("text").join(gone, "__node", "left_anti")
    twice = cut(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__node")), "twice")
    if not twice.isEmpty():
        first = stay.join(twice, "__node", "left_semi").groupBy("__node").agg(F.min("__row").alias("__row"))
        stay = stay.join(twice, "__node", "left_anti").unionByName(first.select("__row", "__node"))
    return stay.select(*[F.col(f"__row.`{n}`").alias(n) for n in docs.columns])
