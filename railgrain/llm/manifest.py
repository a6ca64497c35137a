"""A Merkle manifest of a table, by time-forward processing: digests go up the trees, proofs come back down.

A node's label is (round, tree, index); a message is addressed to a label.  Within a block of 2 ** BITS neighbouring nodes a
priority queue ordered by label hands the digests of children to their parents; between blocks a shuffle sorted by label is
that queue, kept outside memory.  A block's top is a node of the next round, so a tree of n leaves takes log(n) / BITS
rounds.  The reversed sweep begins at the root: each block receives one message, the proof above its top, and hands
every node its own (its sibling, then what its parent was handed); the nodes' proofs are the next messages, down to the
leaves.  A tree that holds all rows is cut into blocks like any other, and a task holds one block.

Rows: nulls are a field of their own kind (``-``), a null group is the first tree, null keys come first in their tree.  Rows with equal
keys are in the order of their digests, and equal rows are leaves of their own.  An empty table has no tree and no
proof.  Columns that are not named as fields take no part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import parts, save, table, written

#: Levels of a tree that one block covers.
BITS = 12
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digest_of(*values: Column) -> Column:
    """sha256 of values, each with its length in bytes in front; nulls differ from empty values."""
    marked = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
              for v in values]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


# -- inside a block ----------------------------------------------------------------------------------


def _width(total: int, level: int) -> int:
    """Nodes that a tree of ``total`` leaves has ``level`` levels up."""
    return -(-total >> level)


def climb(first: int, digests: list[str], total: int) -> list[dict[int, str]]:
    """Digests by level and index of the block that begins at ``first``; the last level is the block's top alone."""
    queue = [(0, first + i, d) for i, d in enumerate(digests)]  # ascending, so a heap
    levels: list[dict[int, str]] = []
    while queue:
        level, index, digest = heapq.heappop(queue)
        if level == len(levels):
            levels.append({})
        levels[level][index] = digest
        if level == BITS or _width(total, level) == 1:
            continue
        below = digest
        while queue and queue[0][0] == level and queue[0][1] >> 1 == index >> 1:
            _, other, digest = heapq.heappop(queue)
            levels[level][other] = digest
            below += digest
        heapq.heappush(queue, (level + 1, index >> 1, sha(below)))
    return levels


def descend(levels: list[dict[int, str]], above: str) -> dict[int, str]:
    """The proof of each node of a block's lowest level, given the proof of its top: siblings, level by level."""
    handed = dict.fromkeys(levels[-1], above)
    for level in range(len(levels) - 2, -1, -1):
        nodes = levels[level]
        handed = {i: nodes.get(i ^ 1, "") + handed[i >> 1] for i in nodes}
    return handed


def fold(digest: str, proof: str, *places: tuple[int, int]) -> str:
    """The root that follows from a leaf and its proof; ``places`` are its index in its tree and the tree's size, upwards."""
    at = 0
    for index, total in places:
        while total > 1:
            if index ^ 1 < total:
                sibling, at = proof[at:at + DIGEST], at + DIGEST
                digest = sha(sibling + digest if index & 1 else digest + sibling)
            else:
                digest = sha(digest)
            index, total = index >> 1, _width(total, 1)
    return digest


# -- sweeps over all blocks --------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], n_key: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches, grouped by their first ``n_key`` columns; holds one group."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return ((key, list(group)) for key, group in groupby(rows, itemgetter(*range(n_key))))


def _upwards(nodes: DataFrame) -> DataFrame:
    """(tree, index, total, digest) of a round to those of the next one: the tops of its blocks."""
    block = F.shiftright("index", BITS)
    sent = nodes.select("tree", block.alias("block"), "index", "total", "digest").repartition("tree", "block").sortWithinPartitions(
        "tree", "block", "index")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block_), rows in _blocks(batches, 2):
            top = climb(rows[0][2], [r[4] for r in rows], rows[0][3])[-1]
            total = _width(rows[0][3], BITS)
            yield pa.RecordBatch.from_pylist(
                [{"tree": tree, "index": block_, "total": total, "digest": d} for d in top.values()],
                pa.schema([("tree", pa.int64()), ("index", pa.int64()), ("total", pa.int64()), ("digest", pa.string())]))

    return sent.mapInArrow(sweep, "tree long, index long, total long, digest string")


def _downwards(nodes: DataFrame, messages: DataFrame, out: Callable[[list[tuple], list[str], tuple], list[tuple]],
               schema: str) -> DataFrame:
    """Hand each block its message, and each node its proof.

    ``nodes`` have (tree, index, total, digest, payload struct or null); ``messages`` (tree, index, proof, note struct), index the block's.
    Both go to the block, the message first.  ``out`` gives the result rows of a block from its nodes, proofs and note.
    """
    spark = nodes.sparkSession
    kinds = {n: nodes.schema["payload"].dataType.simpleString() if n == "payload" else messages.schema["note"].dataType.simpleString()
             for n in ("payload", "note")}
    sent = nodes.select("tree", F.shiftright("index", BITS).alias("block"), "index", "total", "digest", "payload",
                        F.lit(None).cast("string").alias("proof"), F.lit(None).cast(kinds["note"]).alias("note"))
    told = messages.select("tree", F.col("index").alias("block"), F.lit(-1).cast("long").alias("index"), F.lit(0).cast("long").alias("total"),
                           F.lit(None).cast("string").alias("digest"), F.lit(None).cast(kinds["payload"]).alias("payload"), "proof", "note")
    both = sent.unionByName(told).repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
    fields = spark.createDataFrame([], schema).schema.fields
    arrow = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_ = [pa.field(f.name, arrow[f.dataType.simpleString()]) for f in fields]
        for _, rows in _blocks(batches, 2):
            message, nodes_ = rows[0], rows[1:]
            levels = climb(nodes_[0][2], [r[4] for r in nodes_], nodes_[0][3])
            proofs = descend(levels, message[6])
            found = out(nodes_, [proofs[r[2]] for r in nodes_], message[7])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*found, strict=True), kinds_, strict=True)], schema=pa.schema(kinds_))

    return both.mapInArrow(sweep, schema)


def _rounds(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Nodes of all rounds; the last one has one node a tree.  ``most`` is the size of the largest tree."""
    out = [nodes]
    while most > 1:
        out.append(written(_upwards(out[-1]), "nodes"))
        most = _width(most, BITS)
    return out


def _to_blocks(rounds: list[DataFrame], messages: DataFrame) -> DataFrame:
    """Messages to the tops of trees, handed down to the blocks of the lowest round but one: (tree, index, proof, note)."""
    for nodes in reversed(rounds[1:]):
        if nodes is rounds[-1]:
            continue  # these are the tops
        note = messages.schema["note"].dataType
        flat = [f.name for f in note.fields]
        schema = "tree long, index long, proof string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in note.fields)

        def out(rows, proofs, told, flat=flat):
            return [(r[0], r[2], p, *(told[n] for n in flat)) for r, p in zip(rows, proofs, strict=True)]

        down = _downwards(nodes.withColumn("payload", F.lit(None).cast("struct<none:int>")), messages, out, schema)
        messages = written(down.select("tree", "index", "proof", F.struct(*flat).alias("note")), "messages")
    return messages


# -- manifests ---------------------------------------------------------------------------------------


def write_manifest(df: DataFrame, path: str, key: str, group: str, leaf: Column, changed: Column | None = None) -> None:
    """Leaves and roots of ``df`` at ``path``: a tree for each ``group``, leaves by ``key``; the trees' tops are a tree by group.

    ``leaves``: key_, digest, changed (the digest of the row as it is now, where that is asked for), tree, index, total.
    ``trees``: tree (its index among trees), group_, total, subroot.  ``root``: one row, or none for an empty table.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key_"), F.col(group).alias("group_"), leaf.alias("digest"),
                     (F.lit(None).cast("string") if changed is None else changed).alias("changed"))
    order = ["group_", "key_", "digest"]
    # Digests are written before they are sorted, so that sampling the order doesn't read the texts again.
    placed = written(rows, "digests").repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    runs = written(placed.withColumn("run", F.shiftright(place, 33)).withColumn("row", place.bitwiseAND((1 << 33) - 1)), "leaves")
    # Where trees begin: a row for each run and each tree, found from counts.
    pieces = written(runs.groupBy("run", "group_").agg(F.min("row").alias("first"), F.count("*").alias("n")), "pieces")
    ahead = Window.partitionBy("group_").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    begun = pieces.groupBy("group_").agg(F.min(F.struct("run", "first")).alias("at"), F.sum("n").alias("total")).select(
        "group_", "total", "at.run", "at.first")
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = begun.groupBy("run").count().select("run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    in_run = F.row_number().over(Window.partitionBy("run").orderBy("first"))
    trees = written(begun.join(base, "run").select("group_", "total", (F.col("base") + in_run - 1).alias("tree")), "trees")
    offset = pieces.withColumn("offset", F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("p").join(
        trees.alias("t"), F.col("p.group_").eqNullSafe(F.col("t.group_"))).select("run", "p.group_", "offset", "total", "tree")
    leaves = runs.alias("r").join(offset.alias("o"), (F.col("r.run") == F.col("o.run")) & F.col("r.group_").eqNullSafe(F.col("o.group_")))
    leaves = leaves.select("key_", "digest", "changed", "tree", (F.col("row") + F.col("offset")).alias("index"), "total")
    save(leaves, f"{path}/leaves")
    leaves = spark.read.schema(leaves.schema).parquet(f"{path}/leaves")
    sizes = trees.agg(F.max("total").alias("most"), F.count("*").alias("n")).first()
    rounds = _rounds(leaves.select("tree", "index", "total", "digest"), sizes["most"] or 0)
    tops = rounds[-1].select("tree", F.col("digest").alias("subroot"))
    save(trees.join(tops, "tree").select("tree", "group_", "total", "subroot"), f"{path}/trees")
    found = spark.read.parquet(f"{path}/trees")
    top = _rounds(found.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(sizes["n"]).alias("total"),
                               F.col("subroot").alias("digest")), sizes["n"])
    save(top[-1].select(F.col("digest").alias("root"), F.lit(sizes["n"]).alias("trees")).coalesce(1), f"{path}/root")
    for i, nodes in enumerate(rounds[1:], 1):
        save(nodes, f"{path}/nodes/round={i}")
    for i, nodes in enumerate(top[1:], 1):
        save(nodes, f"{path}/tops/round={i}")


def prove(spark: SparkSession, path: str) -> DataFrame:
    """A row for each leaf of a manifest: key_, leaf, subroot, root, proof (the sha256 of its siblings' digests, level by level to
    the root), folded (the root that follows from the changed leaf, else the leaf, and the proof), verified.
    """
    node = "tree long, index long, total long, digest string"
    root = spark.read.schema("root string, trees long").parquet(f"{path}/root").first()
    leaves = spark.read.parquet(f"{path}/leaves")
    if root is None:
        return leaves.select("key_", F.lit("").alias("leaf"), F.lit("").alias("subroot"), F.lit("").alias("root"),
                             F.lit("").alias("proof"), F.lit("").alias("folded"), F.lit(True).alias("verified"))
    trees = spark.read.parquet(f"{path}/trees")

    def stored(kind: str, lowest: DataFrame, most: int) -> list[DataFrame]:
        out = [lowest]
        while most > 1:
            out.append(spark.read.schema(node).parquet(f"{path}/{kind}/round={len(out)}"))
            most = _width(most, BITS)
        return out

    # Down the tree of trees: its leaves are the trees' tops, and what they are handed are the messages to the trees.
    n = root["trees"]
    lowest = trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(n).alias("total"), F.col("subroot").alias("digest"))
    tops = stored("tops", lowest, n)
    start = tops[-1].select("tree", "index", F.lit("").alias("proof"), F.struct(F.col("digest").alias("root")).alias("note"))
    if len(tops) > 1:
        messages = _to_blocks(tops, start)

        def to_trees(rows, proofs, told):
            return [(r[2], p, told["root"], r[4]) for r, p in zip(rows, proofs, strict=True)]

        down = _downwards(lowest.withColumn("payload", F.lit(None).cast("struct<none:int>")), messages, to_trees,
                          "tree long, proof string, root string, subroot string")
    else:
        down = lowest.select(F.col("index").alias("tree"), F.lit("").alias("proof"), F.col("digest").alias("root"), F.col("digest").alias("subroot"))
    messages = written(down.select("tree", F.lit(0).cast("long").alias("index"), "proof", F.struct("root", "subroot").alias("note")), "messages")
    # Down the trees.
    most = trees.agg(F.max("total")).first()[0]
    rounds = stored("nodes", leaves.select("tree", "index", "total", "digest"), most)
    messages = _to_blocks(rounds, messages)

    def to_leaves(rows, proofs, told):
        out = []
        for r, proof in zip(rows, proofs, strict=True):
            payload = r[5]
            folded = fold(payload["changed"] or r[4], proof, (r[2], r[3]), (r[0], n))
            out.append((payload["key_"], r[4], told["subroot"], told["root"], sha(proof), folded, folded == told["root"]))
        return out

    kind = leaves.schema["key_"].dataType.simpleString()
    full = leaves.select("tree", "index", "total", "digest", F.struct("key_", "changed").alias("payload"))
    return _downwards(full, messages, to_leaves, f"key_ {kind}, leaf string, subroot string, root string, proof string, "
                                                 "folded string, verified boolean")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "manifest")
    leaf = digest_of(*(F.col(c) for c in FIELDS))
    more = digest_of(*((F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c)) for c in FIELDS))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    write_manifest(docs, path, "doc_id", "lang", leaf, F.when(hit, more))
    return prove(spark, path).select(F.col("key_").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                                     F.col("folded").alias("folded_root"), "verified")


_CRC = """list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), x -> ord(x)::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)) + y))"""

SQL = rf"""
with recursive docs as (
    select row_number() over () as id, doc_id, lang, source, n_chars, text,
        (xor({_CRC.replace("x -> ", "lambda x: ")}, 4294967295::UBIGINT)) % 7 = 0 as hit
    from documents
), marked as (
    select id, doc_id, lang, hit,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') as head,
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') as n,
        coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') as n1,
        coalesce(strlen(text) || ':' || text, '-') as body
    from docs
), leaves as (
    select id, doc_id, lang, sha256(head || n || body) as leaf, case when hit then sha256(head || n1 || body) end as changed from marked
), placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
        count(*) over (partition by lang) as total,
        dense_rank() over (order by lang nulls first) - 1 as tree
    from leaves
), up as (
    select tree, 0 as level, idx, total, leaf as digest from placed
    union all
    select tree, level + 1, idx, max(total), sha256(string_agg(digest, '' order by child))
    from (select tree, level, idx // 2 as idx, idx as child, (total + 1) // 2 as total, digest from up where total > 1)
    group by tree, level, idx
), subroots as (
    select tree, digest as subroot, (select count(distinct tree) from placed) as n from up where total = 1
), top as (
    select 0 as level, tree as idx, n as total, subroot as digest from subroots
    union all
    select level + 1, idx, max(total), sha256(string_agg(digest, '' order by child))
    from (select level, idx // 2 as idx, idx as child, (total + 1) // 2 as total, digest from top where total > 1)
    group by level, idx
), the_root as (
    select digest as root from top where total = 1
), path as (
    select p.id, u.level, p.idx >> u.level as idx, u.total, s.digest as sibling
    from placed p join (select distinct tree, level, total from up where total > 1) u on u.tree = p.tree
    left join up s on s.tree = p.tree and s.level = u.level and s.idx = xor(p.idx >> u.level, 1)
    union all
    select p.id, 1000 + u.level, p.tree >> u.level, u.total, s.digest
    from placed p cross join (select distinct level, total from top where total > 1) u
    left join top s on s.level = u.level and s.idx = xor(p.tree >> u.level, 1)
), steps as (
    select id, row_number() over (partition by id order by level) as step, idx, sibling from path
), folding as (
    select id, 0::BIGINT as step, coalesce(changed, leaf) as digest from placed
    union all
    select f.id, s.step, sha256(case when s.idx & 1 = 1 then coalesce(s.sibling, '') || f.digest else f.digest || coalesce(s.sibling, '') end)
    from folding f join steps s on s.id = f.id and s.step = f.step + 1
), folded as (
    select id, arg_max(digest, step) as folded_root from folding group by id
), proofs as (
    select id, sha256(string_agg(coalesce(sibling, ''), '' order by step)) as proof_sha256 from steps group by id
)
select p.doc_id, p.leaf, s.subroot, r.root, coalesce(f.proof_sha256, sha256('')) as proof_sha256, g.folded_root, g.folded_root = r.root as verified
from placed p join subroots s on s.tree = p.tree cross join the_root r left join proofs f on f.id = p.id join folded g on g.id = p.id
"""
