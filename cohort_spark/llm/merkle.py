"""Operator 12: Merkle dataset manifest in van Emde Boas layout.

Leaves stand in order within groups; in each group every three consecutive nodes (the last run:
fewer, even one) become the hash of their hex digests until one node, the group's subroot, is
left; the subroots, ordered by group, become the root likewise.

A group's leaves are cut into aligned blocks of ``3 ** height``, each a subtree that one task
builds and stores as one binary value: its levels are split at half height, the top half first,
then the bottom subtrees from left to right, each laid out the same way, so a walk from leaf to
block root touches few cache lines whatever their size (``address``).  The block roots of a group
are the leaves of the next tier of blocks, until a group has one block.  Top down, every block
then takes the path from its own root to the root of all, so a claim about a leaf meets one block
and nothing else: siblings come from the block by address arithmetic, the rest from the path.

``positions`` gives every row its place in its group by a range sort, so a group that holds a
third of all rows is sorted, hashed and proved by many tasks.

Results for odd input: null fields are the ``-`` of the leaf; null groups and ids come first; rows
that share group and id order by leaf digest, identical rows stay, each a leaf of its own; a group
of one leaf has that leaf as subroot, a table of one group its subroot as root; texts of any
length are hashed whole where they are read and go no further; an empty table gives an empty
manifest; further columns are ignored, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_width, stage, table

#: Children of a node, levels of a block above its leaves, bytes of a digest.
ARITY, HEIGHT, DIGEST = 3, 6, 32
#: Identical rows that one task numbers at a time.
COPIES = 4096


# ---- places of rows
def positions(rows: DataFrame, group: str, order: list[str], name: str = "places") -> DataFrame:
    """``rows`` with ``pos``, the place (from 0) in its ``group`` by ``order`` (nulls first).

    Identical rows are counted before the shuffle; a range sort deals the rest out, each task
    numbers its own run, and a table of one row a task moves the runs that continue a group.
    """
    spark, names = rows.sparkSession, rows.columns
    keys = [group, *order, *(c for c in names if c != group and c not in order)]
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    counted = stage(counted, f"{name}-rows")  # the range sort reads its input twice
    chunks = counted.withColumn("__c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES))))
    dealt = chunks.repartitionByRange(shuffle_width(spark), *keys, "__c").sortWithinPartitions(*keys, "__c")
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("__n") - F.col("__c") * COPIES))
    dealt = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__copy", F.explode(copies)).drop("__n", "__c", "__copy")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, first = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(names.index(group)).to_pylist()
            places = np.empty(len(values), np.int64)
            for i, v in enumerate(values):
                at = at + 1 if not first and v == now else 0
                places[i], now, first = at, v, False
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], [*batch.schema.names, "__at"])

    placed = stage(dealt.mapInArrow(number, dealt.select(*names, "__part").schema.add("__at", "long")), name)
    runs = placed.groupBy("__part", F.col(group).alias("__g")).agg((F.max("__at") + 1).alias("__n"))
    # only a task's first run can continue a group: at most one row a task
    runs = runs.withColumn("__before", F.sum("__n").over(
        Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    moved = stage(runs.where("__before IS NOT NULL").drop("__n"), f"{name}-moved")
    moved = moved.withColumnRenamed("__part", "__p")
    out = placed.join(F.broadcast(moved), (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")), "left")
    return out.select(*names, (F.col("__at") + F.coalesce("__before", F.lit(0))).alias("pos"))


# ---- van Emde Boas layout
def nodes_of(levels: int) -> int:
    """Nodes of a full subtree of so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` of one depth (0: the root) in a subtree of ``levels`` levels."""
    index = np.asarray(index, np.int64)
    at = np.zeros_like(index)
    while levels > 1:
        top = (levels + 1) // 2
        if depth < top:
            levels = top
            continue
        wide = ARITY ** (depth - top)
        at = at + nodes_of(top) + index // wide * nodes_of(levels - top)
        index, depth, levels = index % wide, depth - top, levels - top
    return at


@lru_cache(maxsize=64)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Per height above the leaves, the places of that level's nodes."""
    return tuple(address(levels - 1 - h, np.arange(ARITY ** (levels - 1 - h)), levels) for h in range(levels))


def climb(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def hashed(nodes: list[bytes]) -> bytes:
    return sha256(b"".join(nodes).hex().encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The digests of an aligned subtree, laid out; levels beyond the leaves stay zero."""
    places = addresses(height + 1)
    store = bytearray(DIGEST * nodes_of(height + 1))
    level = leaves
    for h in range(height + 1):
        for at, digest in zip(places[h], level):
            store[at * DIGEST:at * DIGEST + DIGEST] = digest
        level = [hashed(level[i:i + ARITY]) for i in range(0, len(level), ARITY)]
    return bytes(store)


def siblings(store: bytes, n: int, height: int, slot: int) -> bytes:
    """Path of one leaf to its block root: per level a byte of left and of right siblings
    (4 left + right), then their digests."""
    places, out = addresses(height + 1), []
    for h in range(height):
        first = slot - slot % ARITY
        run = range(first, min(first + ARITY, n))
        out.append(bytes([4 * (slot - first) + len(run) - 1 - (slot - first)]))
        out += [store[(at := int(places[h][i]) * DIGEST):at + DIGEST] for i in run if i != slot]
        slot, n = slot // ARITY, -(-n // ARITY)
    return b"".join(out)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    at = 0
    while at < len(path):
        left, right = divmod(path[at], 4)
        own = at + 1 + DIGEST * left
        at = own + DIGEST * right
        leaf = hashed([path[own - DIGEST * left:own], leaf, path[own:at]])
    return leaf


def digests_of(path: bytes) -> bytes:
    """The digests of a path alone, one after the other."""
    at, out = 0, []
    while at < len(path):
        size = DIGEST * sum(divmod(path[at], 4))
        out.append(path[at + 1:at + 1 + size])
        at += 1 + size
    return b"".join(out)


# ---- tiers of blocks
@dataclass
class Forest:
    """Tiers of blocks (grp, block, n, height, store, root, many), the leaves' own first; ``many``
    blocks have their root in the next tier, the others are their group's last, with its root."""
    tiers: list[DataFrame]
    roots: DataFrame


def build_forest(leaves: DataFrame, name: str, height: int = HEIGHT) -> Forest:
    """``leaves``: grp, pos (gapless from 0), digest (binary)."""
    size = ARITY ** height
    tiers, roots, level = [], None, leaves

    def build(key, group):
        order = np.argsort(group.column("pos").to_numpy())
        digests = group.column("digest").to_pylist()
        # a full first block climbs as far alone as it does before others: it may go on as well
        many = key[1].as_py() > 0 or len(digests) == size
        up = height if many else climb(len(digests))
        store = build_block([digests[i] for i in order], up)
        return pa.table({"grp": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([len(digests)], pa.int32()), "height": pa.array([up], pa.int32()),
                         "store": [store], "root": [store[:DIGEST]], "many": [many]})

    while True:
        blocks = level.select("grp", "pos", "digest", F.floor(F.col("pos") / size).alias("block")).groupBy("grp", "block").applyInArrow(
            build, "grp string, block long, n int, height int, store binary, root binary, many boolean")
        blocks = stage(blocks, f"{name}-tier{len(tiers)}")
        tiers.append(blocks)
        done = blocks.where("NOT many").select("grp", "root")
        roots = done if roots is None else roots.unionByName(done)
        level = blocks.where("many").select("grp", F.col("block").alias("pos"), F.col("root").alias("digest"))
        if level.isEmpty():
            return Forest(tiers, stage(roots, f"{name}-roots"))


def child_paths(blocks: DataFrame) -> DataFrame:
    """grp, pos, path, subroot of every leaf of blocks that have their own ``path``."""
    def spread(key, group):
        r = group.to_pylist()[0]  # a block is one row
        first = r["block"] * r["size"]
        paths = [siblings(r["store"], r["n"], r["height"], s) + r["path"] for s in range(r["n"])]
        return pa.table({"grp": pa.array([r["grp"]] * r["n"], pa.string()), "pos": pa.array(range(first, first + r["n"]), pa.int64()),
                         "path": pa.array(paths, pa.binary()), "subroot": pa.array([r["subroot"]] * r["n"], pa.binary())})

    return blocks.groupBy("grp", "block").applyInArrow(spread, "grp string, pos long, path binary, subroot binary")


def with_paths(forest: Forest, above: DataFrame | None, name: str, height: int = HEIGHT) -> DataFrame:
    """The leaf tier's blocks with ``path`` from the block's root to the root of all; ``above``
    has grp, path and subroot (the root) of every group, None stands for empty paths."""
    size, below = ARITY ** height, None
    for k in range(len(forest.tiers) - 1, -1, -1):
        blocks = forest.tiers[k].withColumn("size", F.lit(size).cast("long"))
        last = blocks.where("NOT many")
        if above is None:
            ready = last.withColumns({"path": F.lit(b""), "subroot": F.col("root")})
        else:
            ready = last.join(above.select(F.col("grp").alias("__g"), "path", "subroot"), F.col("grp") == F.col("__g")).drop("__g")
        if below is not None:
            parents = below.select(F.col("grp").alias("__g"), F.col("pos").alias("__b"), "path", "subroot")
            ready = ready.unionByName(blocks.where("many").join(
                parents, (F.col("grp") == F.col("__g")) & (F.col("block") == F.col("__b"))).drop("__g", "__b"))
        ready = stage(ready, f"{name}-paths{k}")
        if k:
            below = child_paths(ready)
    return ready


# ---- the manifest of a table
@dataclass
class Manifest:
    """``leaves`` (the rows given, their grp, pos and digest) and ``blocks`` of the leaf tier with
    path, subroot and root."""
    leaves: DataFrame
    blocks: DataFrame


def group_key(source: Column) -> Column:
    """A string that is never null and sorts null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def build_manifest(leaves: DataFrame, order: list[str], height: int = HEIGHT) -> Manifest:
    """``leaves``: grp (see ``group_key``), digest (binary), ``order`` and any further columns."""
    placed = stage(positions(leaves, "grp", order, "merkle-places"), "merkle-leaves")
    sources = build_forest(placed.select("grp", "pos", "digest"), "merkle", height)
    subroots = sources.roots.select(F.lit("").alias("all"), "grp", F.col("root").alias("digest"))
    ranked = stage(positions(subroots, "all", ["grp"], "merkle-sources"), "merkle-subroots")
    top = build_forest(ranked.select(F.col("all").alias("grp"), "pos", "digest"), "merkle-top", height)
    root = top.roots.select("root").first()
    paths = child_paths(with_paths(top, None, "merkle-top", height)).select(F.col("pos").alias("__pos"), "path")
    above = ranked.join(paths, F.col("pos") == F.col("__pos")).select("grp", "path", F.col("digest").alias("subroot"))
    blocks = with_paths(sources, above, "merkle", height)
    return Manifest(placed, blocks.withColumn("total", F.lit(bytes(root["root"]) if root else b"")))


def prove(manifest: Manifest, claims: DataFrame, keep: list[str], height: int = HEIGHT) -> DataFrame:
    """Folds each claim (grp, pos, ``claimed`` digest, null: the stored leaf) along the stored
    siblings: ``keep`` columns of the claims, leaf, subroot, root, folded (binary), siblings."""
    size = ARITY ** height
    claims = claims.withColumn("block", F.floor(F.col("pos") / size))
    schema = claims.select(*keep).schema
    for c in ("leaf", "subroot", "root", "folded", "siblings"):
        schema = schema.add(c, "binary")

    def meet(key, asked, blocks):
        out: dict[str, list] = {c: [] for c in ("leaf", "subroot", "root", "folded", "siblings")}
        if asked.num_rows:
            b = blocks.to_pylist()[0]  # a block is one row
            store, places = b["store"], addresses(b["height"] + 1)[0]
            for pos, claimed in zip(asked.column("pos").to_pylist(), asked.column("claimed").to_pylist()):
                slot = pos - b["block"] * size
                path = siblings(store, b["n"], b["height"], slot) + b["path"]
                at = int(places[slot]) * DIGEST
                leaf = store[at:at + DIGEST]
                for c, v in zip(out, (leaf, b["subroot"], b["total"], fold(claimed or leaf, path), digests_of(path))):
                    out[c].append(v)
        return pa.table([*(asked.column(c) for c in keep), *(pa.array(v, pa.binary()) for v in out.values())], names=[*keep, *out])

    return claims.groupBy("grp", "block").cogroup(manifest.blocks.groupBy("grp", "block")).applyInArrow(meet, schema)


# ---- the query
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(columns[c]) for c in FIELDS]), 256))


def document_leaves(docs: DataFrame) -> DataFrame:
    """grp, doc_id, digest and claimed (the tampered leaf, or null) of every row."""
    own = {c: F.col(c) for c in FIELDS}
    tampered = own | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select(group_key(F.col("source")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(**own).alias("digest"), F.when(even, leaf_digest(**tampered)).alias("claimed"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``documents``, and what its tampered form folds to."""
    leaves = document_leaves(table(spark, sf_dir, "documents").select(*FIELDS))
    manifest = build_manifest(leaves, ["doc_id", "digest"])
    claims = manifest.leaves.select("grp", "pos", "doc_id", "claimed")
    text = lambda c: F.lower(F.hex(c))
    return prove(manifest, claims, ["doc_id"]).select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text("siblings"), 256).alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


#: The same by recursive queries: crc32 bit by bit, levels upward, then every leaf's walk.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::UBIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), told AS (
  SELECT coalesce('=' || source, '') AS grp, d.doc_id, text, coalesce(xor(crc, 4294967295::UBIGINT) % 2 = 0, FALSE) AS tampered,
         coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents d LEFT JOIN bits b ON b.doc_id = d.doc_id
), hashed AS (
  SELECT grp, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN tampered THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS claimed
  FROM told
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM hashed
), tree AS (
  SELECT grp, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT grp, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY grp, lvl, idx // 3, n
), subroots AS (
  SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS m FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, place AS idx, m AS n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n
), nodes AS (
  SELECT grp, lvl, idx, n, h FROM tree UNION ALL SELECT NULL, lvl, idx, n, h FROM top
), beside AS (
  SELECT a.grp, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.grp IS NOT DISTINCT FROM b.grp AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY a.grp, a.lvl, a.idx
), walk AS (
  SELECT l.grp, l.idx AS leaf_idx, s.place, FALSE AS above, 0 AS lvl, l.idx, coalesce(claimed, leaf) AS f, '' AS proof
  FROM leaves l JOIN subroots s USING (grp)
  UNION ALL
  SELECT w.grp, w.leaf_idx, w.place, w.above OR b.l IS NULL, CASE WHEN b.l IS NULL THEN 0 ELSE w.lvl + 1 END,
         CASE WHEN b.l IS NULL THEN w.place ELSE w.idx // 3 END,
         CASE WHEN b.l IS NULL THEN w.f ELSE sha256(b.l || w.f || b.r) END, w.proof || coalesce(b.l || b.r, '')
  FROM walk w LEFT JOIN beside b ON b.grp IS NOT DISTINCT FROM (CASE WHEN w.above THEN NULL ELSE w.grp END) AND b.lvl = w.lvl AND b.idx = w.idx
  WHERE NOT w.above OR b.l IS NOT NULL
), folded AS (
  SELECT grp, leaf_idx, max_by(f, lvl) AS f, max_by(proof, lvl) AS proof FROM walk WHERE above GROUP BY grp, leaf_idx
)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
FROM leaves l JOIN subroots s USING (grp) JOIN folded w ON w.grp = l.grp AND w.leaf_idx = l.idx CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""
