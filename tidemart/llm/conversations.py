"""Prefix trie of conversations: what sharing their beginnings saves.

A node of the trie is a distinct sequence of first turns (role and text); the conversations that begin with it are
its members. It is known by a digest chained from turn to turn. Turns are numbered by exact ranks
that no task holds a whole conversation for, and conversations are chained in blocks of `BLOCK` turns, whose
ends are then chained among themselves, so a conversation of any length is cut into pieces. Sums over
subtrees come from `centroids`.

Turns are known by 128 bits of the SHA-256 of their role and text, nodes by 128 bits of the chain.

Defined results: turns come in the order of their number, null first, and of equal numbers in the order of their
digests; repeated rows are repeated turns; null roles and texts are empty; rows without a conv_id take no part;
texts of any length are digested whole; an empty table has no conversations, hence no nodes, not even a root.
Only conv_id, turn, role and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.centroids import ROLLED, roll_up
from tidemart.operators.ranking import ranked
from tidemart.session import checkpointed

# Turns that are chained one after another.
BLOCK = 4096
# Bytes of a joined list of ids that are held at once.
CHUNK = 1 << 20
# Conversations that take their first turns from one of them, and the bound of the number of such turns.
FAMILY = 100
SHARED = 6

ROOT = bytes(16)


def digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*[part.cast("binary") for part in parts]), 256)), 1, 16)


def chain(before: bytes, turn: bytes) -> bytes:
    """The same as `digest` of two parts."""
    return hashlib.sha256(before + turn).digest()[:16]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place from 1, digest and code points of every turn."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    # The length of the role keeps role and text apart.
    turns = rows.select(
        "conv_id",
        "turn",
        digest(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).alias("digest"),
        F.length("text").cast("long").alias("n_chars"),
    )
    return ranked(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], "place").drop("turn")


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, digest, n_chars, length) and conversations (conv_id, length) after sharing.

    A conversation takes its first turns from the first of its family, as many as a hash of its id tells.
    """
    own_id = F.col("conv_id")
    turn = F.struct("place", "digest", "n_chars")
    heads = (
        turns.where((F.col("place") < shared) & (own_id % family == 0))
        .groupBy(own_id.alias("head_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))
    )
    taken = (F.crc32(own_id.cast("string").cast("binary")) % shared).cast("int")
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n_own"))
    convs = convs.withColumns({"head_id": own_id - own_id % family, "taken": taken}).join(heads, "head_id", "left")
    head = F.when(F.col("head").isNotNull() & (F.col("taken") > 0), F.slice("head", 1, F.greatest("taken", F.lit(1))))
    convs = convs.withColumn("head", head).withColumn("n_head", F.coalesce(F.size("head"), F.lit(0)))
    convs = convs.withColumn("n_head", F.greatest("n_head", F.lit(0)))
    length = F.col("n_head") + F.greatest(F.col("n_own") - F.col("taken"), F.lit(0))
    # Written, so that long conversations can be split in the join below.
    convs = checkpointed(convs.select("conv_id", "taken", "head", "n_head", length.cast("long").alias("length")))
    first = convs.select("conv_id", "length", F.inline("head")).withColumnRenamed("place", "depth")
    rest = turns.join(convs.select("conv_id", "taken", "n_head", "length"), "conv_id").where("place > taken")
    rest = rest.withColumn("depth", (F.col("place") - F.col("taken") + F.col("n_head")).cast("long"))
    columns = ["conv_id", "depth", "digest", "n_chars", "length"]
    return first.select(*columns).unionByName(rest.select(*columns)), convs.select("conv_id", "length")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds what is chained up to a row, and up to the row before it in its block."""
    current, before = None, b""
    for batch in batches:
        found, previous = [], []
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "block", "digest"))
        for conv_id, block, turn in zip(*columns, strict=True):
            if (conv_id, block) != current:
                current, before = (conv_id, block), b""
            previous.append(before)
            before = chain(before, turn)
            found.append(before)
        yield batch.append_column("local", pa.array(found, pa.binary())).append_column("before", pa.array(previous, pa.binary()))


def _blocks_chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node that a conversation has reached before each block but its first."""
    current, node = None, ROOT
    for batch in batches:
        found = []
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "local"))
        for conv_id, local in zip(*columns, strict=True):
            if conv_id != current:
                current, node = conv_id, ROOT
            node = chain(node, local)
            found.append(node)
        following = pa.array([block + 1 for block in batch.column("block").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), following, pa.array(found, pa.binary())], ["conv_id", "block", "reached"])


def passages(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """seq, depth, node, parent, n_chars and length: every node that every conversation passes, the root included."""
    cut = turns.withColumn("block", F.floor((F.col("depth") - 1) / block).cast("long"))
    dealt = cut.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    schema = "conv_id long, depth long, digest binary, n_chars long, length long, block long, local binary, before binary"
    chained = checkpointed(dealt.mapInArrow(_chained, schema))
    full = chained.where((F.col("depth") % block == 0) & (F.col("depth") < F.col("length")))
    ends = full.select("conv_id", "block", "local").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    reached = ends.mapInArrow(_blocks_chained, "conv_id long, block long, reached binary")
    root = F.lit(bytearray(ROOT))
    far = chained.where("block > 0").join(checkpointed(reached), ["conv_id", "block"])
    near = chained.where("block = 0").withColumn("reached", root)
    parent = F.when(F.octet_length("before") == 0, F.col("reached")).otherwise(digest(F.col("reached"), F.col("before")))
    below = near.unionByName(far).select(
        F.col("conv_id").alias("seq"), "depth", digest(F.col("reached"), F.col("local")).alias("node"), parent.alias("parent"),
        "n_chars", "length",
    )
    zero = F.lit(0).cast("long")
    top = convs.select(
        F.col("conv_id").alias("seq"), zero.alias("depth"), root.alias("node"), F.lit(None).cast("binary").alias("parent"),
        zero.alias("n_chars"), "length",
    )
    return checkpointed(below.unionByName(top))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node joined to text of bounded size, with the first of them."""
    current, first, ids, size = None, None, [], 0
    names = ["node", "first", "ids"]

    def packed(rows: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for node, seq in zip(batch.column("node").to_pylist(), batch.column("seq").to_pylist(), strict=True):
            if node != current or size > CHUNK:
                if ids:
                    rows.append((current, first, ",".join(ids)))
                current, first, ids, size = node, seq, [], 0
            ids.append(str(seq))
            size += len(ids[-1]) + 1
        yield packed(rows)
    if ids:
        yield packed([(current, first, ",".join(ids))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each node, which come in order."""
    current, state = None, None
    for batch in batches:
        found = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if node != current:
                if state is not None:
                    found.append((current, state.hexdigest()))
                current, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _hash_rows(found)
    if state is not None:
        yield _hash_rows([(current, state.hexdigest())])


def _hash_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    nodes, hashes = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])


def ends_of(passed: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes that conversations end in.

    Ids are joined by tasks that hold ranges of (node, id); a node of many ends is cut into several. The hash of
    one node is made by one task, as SHA-256 runs through its input, but from chunks that pass by.
    """
    ends = passed.where("depth = length").select("node", "seq")
    chunks = ends.repartitionByRange("node", "seq").sortWithinPartitions("node", "seq")
    chunks = chunks.mapInArrow(_chunks, "node binary, first long, ids string")
    dealt = chunks.repartition("node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(_hashed, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rolled: int = ROLLED, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = checkpointed(numbered_turns(conversations))
    passed = passages(*rebuilt(turns), block)
    # Conversations from here down, added up over the subtree: the turns that members have left, this one included.
    left = F.col("length") - F.col("depth") + 1
    nodes = checkpointed(
        passed.groupBy("node", "parent", "depth").agg(
            F.min("seq").alias("seq"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
            F.sum(left).alias("weight"),
        )
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("seq").alias("parent_conv_id"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    saved = (F.col("n_convs") - 1) * F.col("n_chars")
    nodes = checkpointed(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": saved}))
    values = ["n_leaves", "saved_tokens"]
    sums = roll_up(passed.select("seq", "depth", "node", "parent"), nodes, values, rolled)
    none = hashlib.sha256(b"").hexdigest()
    found = nodes.drop(*values).join(sums, "node").join(ends_of(passed), "node", "left").join(parents, "parent", "left")
    return found.select(
        F.col("seq").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", *values,
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


# CRC-32 of the decimal id is computed bit by bit, as DuckDB has no function for it.
TRIE_SQL = """
WITH RECURSIVE ids AS (
    SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS digits FROM conversations WHERE conv_id IS NOT NULL
),
crc AS (
    SELECT conv_id, digits, 0 AS step, CAST(4294967295 AS BIGINT) AS state FROM ids
    UNION ALL
    SELECT conv_id, digits, step + 1,
           CASE WHEN mixed % 2 = 1 THEN xor(mixed // 2, CAST(3988292384 AS BIGINT)) ELSE mixed // 2 END
    FROM (SELECT *, CASE WHEN step % 8 = 0 THEN xor(state, CAST(ascii(substr(digits, step // 8 + 1, 1)) AS BIGINT))
                         ELSE state END AS mixed
          FROM crc WHERE step < 8 * length(digits))
),
taken AS (
    SELECT conv_id, CAST(xor(state, CAST(4294967295 AS BIGINT)) % 6 AS BIGINT) AS h
    FROM crc WHERE step = 8 * length(digits)
),
own AS (
    SELECT conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL)
),
sizes AS (SELECT conv_id, max(place) AS n_own FROM own GROUP BY conv_id),
convs AS (
    SELECT conv_id, h, n_own, least(h, coalesce(head.n, 0)) AS n_head
    FROM sizes JOIN taken USING (conv_id)
    LEFT JOIN (SELECT conv_id AS head_id, n_own AS n FROM sizes) head ON head_id = conv_id - conv_id % 100
),
built AS (
    SELECT c.conv_id, place AS depth, role, text FROM convs c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
    UNION ALL
    SELECT conv_id, place - h + n_head, role, text FROM convs JOIN own USING (conv_id) WHERE place > h
),
lengths AS (SELECT conv_id, n_head + greatest(n_own - h, 0) AS length FROM convs),
passed AS (
    SELECT conv_id, 0 AS depth, '' AS node, 0 AS n_chars, length FROM lengths JOIN sizes USING (conv_id)
    UNION ALL
    SELECT conv_id, depth,
           string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth),
           length(text), length
    FROM built JOIN lengths USING (conv_id)
),
placed AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM passed
),
nodes AS (
    SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
           CASE WHEN node = '' THEN 0 ELSE (count(*) - 1) * any_value(n_chars) END AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
    FROM placed GROUP BY node
),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
    SELECT above.node, count(*) FILTER (children.n IS NULL) AS n_leaves, CAST(sum(below.saved) AS BIGINT) AS saved_tokens
    FROM nodes below JOIN placed above ON above.conv_id = below.conv_id AND above.depth <= below.depth
    LEFT JOIN children ON children.node = below.node
    GROUP BY above.node
)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(children.n, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes up ON up.node = nodes.parent"""
