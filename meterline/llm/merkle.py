"""Merkle manifest of a table with an inclusion witness for every row, grown by appends.

A row's leaf is the hash of its encoded columns. Leaves are ordered by id within a tree (a language) and appended, in
aligned blocks of ``BLOCK`` leaves, to a tree whose open subtrees hold the partial witnesses of what lies below them.
Whenever the last sibling of a run comes, the witnesses below the run grow by the run's other hashes and the
run becomes one node. The root of a block is then one more append, to the tree of blocks, whose witness extends those of
the whole block; so it goes on, in rounds of aligned blocks, until each tree has one root, and the roots of
the trees are appended to the last tree in the same way. A task holds one block; rounds grow with the logarithm of
the number of rows to the base ``BLOCK``.

A witness is a chain of steps from the leaf to the root: the place in the run, the number of siblings (a byte each) and
the siblings' 32 bytes. ``fold`` computes the root that a leaf and a witness lead to.

Null columns are encoded as ``-`` and empty texts as ``0:``. Rows without a tree name make the first tree, rows without
id come first in theirs. Repeated rows are leaves of their own; rows with one id are ordered by their leaf. An empty
table has an empty manifest. Texts of any length are hashed in one pass. Only the named columns are read, whatever else
is there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import ranked, remainder, small_table, sorted_slices
from meterline.session import cut

FAN, HEIGHT = 8, 3
BLOCK = FAN**HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_TREE = ["named", "tree"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(children: Sequence[bytes]) -> bytes:
    """The hash of a run: sha256 of the children's hashes as hexadecimal text."""
    return sha256(b"".join(children).hex().encode()).digest()


def step(run: Sequence[bytes], at: int) -> bytes:
    """What a run adds to the witness of its child ``at``."""
    return bytes((at, len(run) - 1)) + b"".join(run[:at]) + b"".join(run[at + 1 :])


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place and siblings of every step, from the leaf upwards."""
    i = 0
    while i < len(witness):
        at, n = witness[i], witness[i + 1]
        i += 2
        yield at, [witness[i + 32 * k : i + 32 * k + 32] for k in range(n)]
        i += 32 * n


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that ``leaf`` has if ``witness`` is its witness."""
    for at, siblings in steps(witness):
        leaf = digest([*siblings[:at], leaf, *siblings[at:]])
    return leaf


class Appender:
    """A tree that grows by appends.

    ``open[h]`` is the unfinished run of height h: hashes of whole subtrees, each with the range of appends below it.
    ``witness[i]`` is the witness of append i as far as its siblings are known.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, range]]] = []
        self.witness: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        n = len(self.witness)
        self.witness.append(bytearray())
        self._put(0, leaf, range(n, n + 1))

    def _put(self, height: int, node: bytes, below: range) -> None:
        if height == len(self.open):
            self.open.append([])
        self.open[height].append((node, below))
        if len(self.open[height]) == FAN:
            self._finish(height)

    def _finish(self, height: int) -> None:
        run, self.open[height] = self.open[height], []
        nodes = [node for node, _ in run]
        for at, (_, below) in enumerate(run):
            more = step(nodes, at)
            for i in below:
                self.witness[i] += more
        self._put(height + 1, digest(nodes), range(run[0][1].start, run[-1][1].stop))

    def close(self, height: int | None = None) -> bytes:
        """Finish the open runs from below, up to ``height`` or until one node is left; that node."""
        at = 0
        while True:
            run = self.open[at]
            last = len(run) == 1 and not any(self.open[at + 1 :])
            if last if height is None else at == height:
                return run[0][0]
            if run:
                self._finish(at)
            at += 1


def _encoded(name: str, column: Column) -> Column:
    text = column if name == "text" else column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**columns: Column) -> Column:
    """The leaf of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[_encoded(k, v) for k, v in columns.items()]).cast("binary"), 256))


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """named, tree, at, doc_id, leaf, claim of every row: its tree, its place there and its leaf.

    ``claim`` is the leaf with ``claimed`` in place of the text, null if there is no such column.
    """
    own = {name: F.col(name) for name in COLUMNS}
    claim = F.lit(None).cast("binary") if claimed is None else leaf_hash(**own | {"text": claimed})
    rows = docs.select(
        F.col("lang").isNotNull().alias("named"),
        F.coalesce("lang", F.lit("")).alias("tree"),
        F.col("doc_id").isNotNull().alias("known"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "doc_id",
        leaf_hash(**own).alias("leaf"),
        claim.alias("claim"),
    )
    held = sorted_slices(rows, [*_TREE, "known", "id", "leaf"], "leaves")
    return ranked(held, _TREE).select(*_TREE, F.col("__rank").alias("at"), "doc_id", "leaf", "claim")


def _grown(group: list[str], carry: list[str]):
    def grow(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        tree = Appender()
        for node in t["node"].to_pylist():
            tree.append(node)
        alone = t["alone"][0].as_py()
        top = tree.close(None if alone else HEIGHT)
        lists = {name: t[name].to_pylist() for name in carry} | {"witness": [bytes(w) for w in tree.witness]}
        head = t.slice(0, 1)
        out = {name: head[name] for name in [*group, "block", "alone"]} | {"node": pa.array([top], pa.binary())}
        kinds = {name: t.schema.field(name).type for name in carry} | {"witness": pa.binary()}
        return pa.table(out | {k: pa.array([v], pa.list_(kinds[k])) for k, v in lists.items()})

    return grow


def _tree(nodes: DataFrame, group: list[str], carry: list[str]) -> DataFrame:
    """Blocks of the trees over ``nodes`` (group, at, node, columns to carry).

    A row has the lists of what its block carries and of the witnesses within the block, ``more``, by which the block's own
    witness extends each of them, and ``root``, the root of its tree.
    """
    sizes = nodes.groupBy(*group).agg((F.count("*") <= BLOCK).alias("alone"))
    kinds = dict(nodes.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in group) + ", block bigint, alone boolean, node binary, "
    schema += ", ".join([f"`{c}` array<{kinds[c]}>" for c in carry] + ["witness array<binary>"])
    rows = nodes.join(small_table(sizes, "trees"), group).withColumn("block", F.shiftright("at", 3 * HEIGHT))
    blocks = cut(rows.groupBy(*group, "block").applyInArrow(_grown(group, carry), schema), "blocks")
    open_ = blocks.where(~F.col("alone")).select(*group, F.col("block").alias("at"), "node")
    if open_.isEmpty():
        return blocks.withColumns({"more": F.lit(b""), "root": F.col("node")})
    above = _opened(_tree(open_, group, ["at"]), ["at"], group)
    above = above.select(*group, F.col("at").alias("block"), F.col("witness").alias("more"), "root")
    joined = blocks.join(small_table(above, "witnesses"), [*group, "block"], "left")
    return joined.withColumns({"more": F.coalesce("more", F.lit(b"")), "root": F.coalesce("root", "node")})


def _opened(blocks: DataFrame, carry: list[str], keep: list[str]) -> DataFrame:
    """One row per node of ``blocks`` with its whole witness."""
    each = blocks.select(*keep, "more", "root", F.explode(F.arrays_zip(*carry, "witness")).alias("_e"))
    whole = F.concat("_e.witness", "more").alias("witness")
    return each.select(*keep, *[F.col(f"_e.{c}").alias(c) for c in carry], whole, "root")


def manifest(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """Blocks of up to ``BLOCK`` rows: lists doc_id, leaf, claim and witness, and more, subroot and root of the block.

    A leaf's whole witness is its own followed by ``more``.
    """
    nodes = leaves(docs, claimed).withColumn("node", F.col("leaf"))
    blocks = _tree(nodes, _TREE, ["doc_id", "leaf", "claim"])
    subroots = blocks.where("block = 0").select(*_TREE, F.col("root").alias("node"))
    ordered = ranked(sorted_slices(subroots, _TREE, "subroots"), [])
    top = _tree(ordered.select(F.lit(0).alias("all"), F.col("__rank").alias("at"), "node", *_TREE), ["all"], _TREE)
    above = _opened(top, _TREE, []).select(*_TREE, F.col("witness").alias("last"), F.col("root").alias("top"))
    joined = blocks.join(small_table(above, "subroots"), _TREE)
    return joined.select(
        *_TREE, "block", "doc_id", "leaf", "claim", "witness", F.concat("more", "last").alias("more"), F.col("root").alias("subroot"), F.col("top").alias("root")
    )


def verify(blocks: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of a manifest.

    The claim (the leaf, where there is none) is folded with the witness; it is verified if that gives the root.
    """
    kind = dict(blocks.dtypes)["doc_id"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                more, subroot, root = (row[k].as_py() for k in ("more", "subroot", "root"))
                ids, leaf, claim, witness = (row[k].values for k in ("doc_id", "leaf", "claim", "witness"))
                leaf, proofs, folded = leaf.to_pylist(), [], []
                for own, other, part in zip(leaf, claim.to_pylist(), witness.to_pylist(), strict=True):
                    whole = part + more
                    siblings = b"".join(s for _, run_ in steps(whole) for s in run_)
                    proofs.append(sha256(siblings.hex().encode()).hexdigest())
                    folded.append(fold(own if other is None else other, whole))
                n = len(leaf)
                out = [ids, pa.array([v.hex() for v in leaf]), pa.array([subroot.hex()] * n), pa.array([root.hex()] * n)]
                out += [pa.array(proofs), pa.array([v.hex() for v in folded]), pa.array([v == root for v in folded])]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return blocks.select("doc_id", "leaf", "claim", "witness", "more", "subroot", "root").mapInArrow(run, schema)


def tampered_text(modulus: int = 3) -> Column:
    """The text in lower case (A-Z only) where ``modulus`` divides the id's crc32; a null id is left alone."""
    hit = F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) == 0)
    return F.when(hit, F.translate("text", _UPPER, _UPPER.lower())).otherwise(F.col("text"))
