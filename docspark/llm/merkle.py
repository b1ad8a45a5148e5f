"""A Merkle manifest of a dataset, as a tree of SHA-256 midstates.

Every document is a leaf.  The leaves of a source ascend by doc_id; each three neighbours
become one node, whose digest is that of their digests as hex text, until one is left: the
source's subroot.  The subroots in turn, ordered by source, become the root.

A child's hex digest is as long as a block of SHA-256, so the hash of a parent passes through
one whole state per child.  A parent retains a copy of the state before each of its child
slots.  To fold a changed leaf into the root, each level resumes the state before the changed
child and adds the new digest and the siblings to its right only.

Trees are grown in rounds of several levels.  In a round the nodes of a tree are dealt to
groups of 3^``levels`` neighbours, so neither a task nor the driver sees a whole tree, a large
source is split like all others, and each round's table is so many times smaller than that
before it.  A leaf's way to the root is its group, and the group's way, which is shared.

Defined results: leaves with one doc_id stand by their digest; a null doc_id comes first and is
never tampered with; a source of one document is its leaf; no documents give no rows.
Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docspark.sources import staging

ARITY = 3
# Levels that a group grows in one round.
LEVELS = 7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# One level of the way up: the state before the changed child, its right siblings, all
# siblings from left to right, and the number of children.
STEP = "struct<state: binary, right: binary, siblings: binary, children: int>"
_STEP = pa.struct([("state", pa.binary()), ("right", pa.binary()), ("siblings", pa.binary()), ("children", pa.int32())])
_WAYS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("above", pa.list_(_STEP))])
GROUP = "tree string, pos long, n long, levels int, digest binary, members binary, nodes binary, states binary"


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _fraction(n: int, root: int) -> int:
    """The first 32 bits of the fraction of a square or cube root."""
    x = int(round((n ** (1 / root)) * 2**32))
    while x**root > n << 32 * root:
        x -= 1
    while (x + 1) ** root <= n << 32 * root:
        x += 1
    return x & 0xFFFFFFFF


_ROUND = np.array([_fraction(p, 3) for p in _primes(64)], np.uint32)
_START = np.array([_fraction(p, 2) for p in _primes(8)], np.uint32)[:, None]
# Two bytes as four characters of hex text, in one number.
_HEX = np.frombuffer(b"".join(b"%04x" % i for i in range(1 << 16)), ">u4").astype(np.uint32)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One step of SHA-256 for many hashes: eight rows of state, sixteen of message."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        low = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        high = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + low + w[t - 7] + high)
    a, b, c, d, e, f, g, h = np.broadcast_to(state, (8, block.shape[1]))
    for t in range(64):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.stack([a, b, c, d, e, f, g, h]) + state


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after one more child each."""
    block = np.empty((16, digests.shape[1]), np.uint32)
    block[0::2], block[1::2] = _HEX[digests >> np.uint32(16)], _HEX[digests & np.uint32(0xFFFF)]
    return compress(state, block)


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """The digests of parents that have had all their children."""
    block = np.zeros((16, state.shape[1]), np.uint32)
    block[0], block[15] = 1 << 31, children * 512
    return compress(state, block)


def _words(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u4").reshape(-1, 8).T.astype(np.uint32)


def _bytes(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def levels_of(n: int, most: int) -> int:
    """How often n nodes are joined until one is left, or ``most`` times."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def grow(digests: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """All levels over neighbouring nodes, and the states that each parent retains.

    The states before slot 0 are the start of SHA-256; those before slots 1 and 2 stand one after
    the other for every parent, zero where it has no such child.
    """
    found, states = [digests], []
    for _ in range(levels):
        children = found[-1]
        n = children.shape[1]
        parents = -(-n // ARITY)
        before = np.zeros((8, parents, ARITY - 1), np.uint32)
        state = absorb(_START, children[:, 0::ARITY])
        for slot in range(1, ARITY):
            own = children[:, slot::ARITY]
            before[:, : own.shape[1], slot - 1] = state[:, : own.shape[1]]
            state[:, : own.shape[1]] = absorb(state[:, : own.shape[1]], own)
        found.append(finish(state, _children(n, np.arange(parents))))
        states.append(before.reshape(8, -1))
    return found, states


def _children(n: int, parents: np.ndarray) -> np.ndarray:
    return np.minimum(ARITY, n - ARITY * parents)


def _sizes(n: int, levels: int) -> list[int]:
    sizes = [n]
    for _ in range(levels):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


@dataclass
class _Group:
    """A group read back: its digests by level and the states of its parents."""

    found: list[np.ndarray]
    states: list[np.ndarray]

    @classmethod
    def read(cls, members: bytes, nodes: bytes, states: bytes, levels: int) -> _Group:
        digests, sizes = _words(members), _sizes(len(members) // 32, levels)
        upper, before, found, kept = _words(nodes), _words(states), [digests], []
        at = 0
        for size in sizes[1:]:
            found.append(upper[:, at : at + size])
            kept.append(before[:, (ARITY - 1) * at : (ARITY - 1) * (at + size)])
            at += size
        return cls(found, kept)

    def way(self, member: int) -> list[dict]:
        """The steps from one member to the top of the group."""
        steps = []
        for digests, states in zip(self.found, self.states):
            parent, slot = divmod(member, ARITY)
            children = min(ARITY, digests.shape[1] - ARITY * parent)
            first = ARITY * parent
            left, right = (_bytes(digests[:, i:j]) for i, j in ((first, member), (member + 1, first + children)))
            state = _START if not slot else states[:, [(ARITY - 1) * parent + slot - 1]]
            steps.append({"state": _bytes(state), "right": right, "siblings": left + right, "children": children})
            member = parent
        return steps

    def fold(self, changed: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The top of the group for each changed member alone, and the members' siblings."""
        siblings = [b""] * len(places)
        for digests, states in zip(self.found, self.states):
            parent, slot = np.divmod(places, ARITY)
            children = _children(digests.shape[1], parent)
            kept = states[:, np.maximum((ARITY - 1) * parent + slot - 1, 0)]
            state = absorb(np.where(slot == 0, _START, kept), changed)
            for other in range(1, ARITY):
                right = np.flatnonzero((slot < other) & (other < children))
                state[:, right] = absorb(state[:, right], digests[:, ARITY * parent[right] + other])
            changed = finish(state, children)
            data = _bytes(digests)
            for i, (p, first, n) in enumerate(zip(places.tolist(), (ARITY * parent).tolist(), children.tolist())):
                siblings[i] += data[32 * first : 32 * p] + data[32 * p + 32 : 32 * (first + n)]
            places = parent
        return changed, siblings


def _follow(changed: np.ndarray, steps: list[dict]) -> np.ndarray:
    """Fold many digests of one place along its way up."""
    for step in steps:
        state = absorb(_words(step["state"]), changed)
        for i in range(0, len(step["right"]), 32):
            state = absorb(state, np.broadcast_to(_words(step["right"][i : i + 32]), state.shape))
        changed = finish(state, np.full(state.shape[1], step["children"]))
    return changed


def leaf_of(*columns: Column) -> Column:
    """The digest of a row: each value with its number of bytes, ``-`` for null."""
    values = [c.cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*marked), 256))


def _ranked(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """Write nodes with their place in their ``tree`` as ``pos`` and the tree's size as ``n``.

    Rows are sorted by ranges, so a large tree lies in many tasks.
    """
    tied = nodes.withColumn("_row", F.monotonically_increasing_id())
    tied, _ = staging.stage(tied, f"{name}_nodes")  # the numbers are made once
    keys = ["tree", *order, "_row"]
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = tied.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("_row")
    laid = laid.withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id())
    laid, _ = staging.stage(laid, name)
    runs = laid.groupBy("_part", "tree").agg(F.count("*").alias("_held"), F.min("_nth").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "_part", "tree", "_first",
        F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"), F.sum("_held").over(whole).alias("n"),
    )
    joined = laid.join(runs, ["_part", "tree"]).withColumn("pos", F.col("_nth") - F.col("_first") + F.col("_before"))
    return joined.drop("_part", "_nth", "_first", "_before")


def _grow_group(rows: pa.Table, tree: str, pos: int, most: int) -> pa.Table:
    order = np.argsort(rows.column("pos").to_numpy())
    digests = [rows.column("digest")[int(i)].as_py() for i in order]
    n = rows.column("n")[0].as_py()
    levels = levels_of(n, most)
    found, states = grow(_words(b"".join(digests)), levels)
    return pa.table(
        {
            "tree": pa.array([tree], pa.string()),
            "pos": pa.array([pos], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "levels": pa.array([levels], pa.int32()),
            "digest": pa.array([_bytes(found[-1])], pa.binary()),
            "members": pa.array([b"".join(digests)], pa.binary()),
            "nodes": pa.array([b"".join(map(_bytes, found[1:]))], pa.binary()),
            "states": pa.array([b"".join(map(_bytes, states))], pa.binary()),
        }
    )


def _rounds(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Grow trees (tree, pos, n, digest); the groups of each round, and each tree's top."""
    width = ARITY**levels

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return _grow_group(rows, key[0].as_py(), key[1].as_py(), levels)

    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    tops = nodes.where("n = 1").select("tree", "digest")
    while most > 1:
        grouped = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {width}").alias("_group"))
        groups, _ = staging.stage(grouped.applyInArrow(run, GROUP), "groups")
        rounds.append(groups)
        nodes = groups.select("tree", "pos", "digest", F.expr(f"(n + {width - 1}) div {width}").alias("n"))
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // width)
    return rounds, tops


@dataclass
class Manifest:
    """``leaves`` have their tree (source) and place; ``rounds`` the groups above them; ``heads``
    the groups above the subroots; ``subroots`` one row per source with its place."""

    leaves: DataFrame
    rounds: list[DataFrame]
    heads: list[DataFrame]
    subroots: DataFrame
    root: bytes | None
    levels: int

    @property
    def width(self) -> int:
        """Members of a full group."""
        return ARITY**self.levels


def build(docs: DataFrame, levels: int = LEVELS, **also: Column) -> Manifest:
    """Grow the manifest of documents (doc_id, source, lang, n_chars, text).

    ``also`` are further digests of each row, such as that of a changed copy, to be folded
    later.
    """
    tree = F.coalesce(F.concat(F.lit(":"), "source"), F.lit("")).alias("tree")
    digest = leaf_of(*(F.col(c) for c in FIELDS)).alias("digest")
    made = docs.select(F.col("doc_id").cast("long"), tree, digest, *(c.alias(name) for name, c in also.items()))
    leaves = _ranked(made, ["doc_id", "digest"], "leaves")
    rounds, tops = _rounds(leaves.select("tree", "pos", "n", "digest"), levels)
    tops = tops.select(F.lit("all").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    subroots = _ranked(tops, ["source_tree"], "subroots")
    heads, top = _rounds(subroots.select("tree", "pos", "n", "digest"), levels)
    found = top.first()
    return Manifest(leaves, rounds, heads, subroots, bytes(found.digest) if found else None, levels)


def _member_ways(groups: DataFrame, width: int) -> DataFrame:
    """The way up of every member of a round's groups, given that of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                group = _Group.read(r["members"], r["nodes"], r["states"], r["levels"])
                ways = [group.way(i) + r["above"] for i in range(group.found[0].shape[1])]
                places = [r["pos"] * width + i for i in range(len(ways))]
                rows = {"tree": [r["tree"]] * len(ways), "pos": places, "above": ways}
                yield pa.RecordBatch.from_pydict(rows, schema=_WAYS)

    return groups.mapInArrow(run, f"tree string, pos long, above array<{STEP}>")


def _ways(rounds: list[DataFrame], start: DataFrame, width: int) -> DataFrame:
    """The groups of the first round with ``above``, their way up; ``start`` has that of each tree's top."""
    members = None
    for groups in reversed(rounds):
        known = groups.where(f"n <= {width}").join(start, "tree")
        if members is not None:
            known = known.unionByName(groups.where(f"n > {width}").join(members, ["tree", "pos"]))
        members, lowest = _member_ways(known, width), known
    return lowest


def fold(manifest: Manifest, column: str) -> DataFrame:
    """Recompute the root for each leaf alone, with the digest in ``column`` in its place.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root (hex) and verified.
    """
    spark, width = manifest.leaves.sparkSession, manifest.width
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    start = _subroot_ways(spark, manifest)
    tops = start.select("tree", "above")
    lone = start.where("lone").select("tree", F.lit(0).cast("long").alias("pos"), F.lit(0).alias("levels"), "above")
    lone = lone.select("*", *(F.lit(None).cast("binary").alias(c) for c in ("members", "nodes", "states")))
    groups = lone
    if manifest.rounds:
        groups = groups.unionByName(_ways(manifest.rounds, tops, width).select(lone.columns))
    groups = groups.join(start.select("tree", "digest"), "tree")
    root = manifest.root

    def run(key: tuple, leaves: pa.Table, group: pa.Table) -> pa.Table:
        g = group.to_pylist()[0]
        places = leaves.column("pos").to_numpy() % width
        changed = _words(b"".join(leaves.column("changed").to_pylist()))
        siblings = [b""] * len(places)
        if g["levels"]:
            changed, siblings = _Group.read(g["members"], g["nodes"], g["states"], g["levels"]).fold(changed, places)
        above = b"".join(s["siblings"] for s in g["above"])
        folded = [data.hex() for data in _split(_bytes(_follow(changed, g["above"])))]
        proofs = [hashlib.sha256((own + above).hex().encode()).hexdigest() for own in siblings]
        n = len(places)
        return pa.table(
            {
                "doc_id": leaves.column("doc_id"),
                "leaf": [d.hex() for d in leaves.column("digest").to_pylist()],
                "subroot": [g["digest"].hex()] * n,
                "root": [root.hex()] * n,
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [f == root.hex() for f in folded],
            }
        )

    leaves = manifest.leaves.select("doc_id", "tree", "pos", "digest", F.col(column).alias("changed"))
    left = leaves.groupBy("tree", F.expr(f"pos div {width}").alias("_group"))
    return left.cogroup(groups.groupBy("tree", F.col("pos").alias("_group"))).applyInArrow(run, schema)


def _split(data: bytes) -> list[bytes]:
    return [data[i : i + 32] for i in range(0, len(data), 32)]


def _subroot_ways(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Each source's subroot and its way to the root; ``lone`` says that it is a leaf."""
    width = manifest.width
    grown = [groups.where(f"n <= {width}").select("tree") for groups in manifest.rounds]
    lone = F.lit(True)
    subroots = manifest.subroots.select(F.col("source_tree").alias("tree"), "pos", "digest")
    if manifest.heads:
        none = spark.createDataFrame([("all", [])], f"tree string, above array<{STEP}>")
        ways = _member_ways(_ways(manifest.heads, none, width), width).select("pos", "above")
        start = subroots.join(ways, "pos")
    else:
        start = subroots.withColumn("above", F.expr(f"cast(array() as array<{STEP}>)"))
    if grown:
        tall = grown[0]
        for more in grown[1:]:
            tall = tall.unionByName(more)
        start = start.join(tall.withColumn("_tall", F.lit(True)), "tree", "left")
        lone = F.col("_tall").isNull()
    start = start.select("tree", "digest", "above", lone.alias("lone"))
    return staging.stage(start, "starts")[0]
