"""Document fingerprints by winnowing, and how they change with an edit.

The tokens of a text are its lower-cased words. Every three consecutive words are hashed to 32 bits; of
every six consecutive hashes the smallest is kept, the rightmost one in a tie, with its position.
So any eight words that two documents share leave a common hash in both, and runs of fewer than three
words are never matched. A text of fewer than three words has one hash of all its words, one of
fewer than six hashes has one window of all of them.

Everything is a native expression over the words of one row. The text of the next document (in
descending order of ids) comes from a window over blocks of neighbouring ids; the last document of a
block finds its neighbour through a list of the blocks' largest ids, which is cut into blocks in
the same way until one block is left. No step sorts all documents in one task.

Defined results: a null text counts as empty; an empty text has the empty fingerprint; likeness is the share
of common hashes among all hashes of both, 1 if both have none; rows of one id follow one another
in the order of their texts; rows without an id come last; a single document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.columns import let, named
from tidemart.session import checkpointed

SHINGLE = 3
WINDOW = 6
# Ids of one block of neighbours, and blocks that are linked in one task, as powers of two.
BLOCK_BITS = 8
LINK_BITS = 12
_LAST = -(1 << 62)


def winnow(text: Column) -> Column:
    """array<long> of the kept hashes: hash above, and below it how far from the end it stands."""
    words = F.filter(F.split(F.lower(text), r"[\s\u0000]+"), lambda word: word != "")
    hashes = F.transform(words, lambda word: F.xxhash64(word))

    def grams(h: Column) -> Column:
        count = F.size(h)
        whole = F.when(count > 0, F.array(_packed(F.xxhash64(h), F.lit(0)))).otherwise(
            F.array().cast("array<long>")
        )
        each = F.transform(
            F.slice(h, 1, F.greatest(count - (SHINGLE - 1), F.lit(0))),
            lambda first, at: _packed(F.xxhash64(first, F.get(h, at + 1), F.get(h, at + 2)), at),
        )
        return F.when(count < SHINGLE, whole).otherwise(each)

    def least(g: Column) -> Column:
        return F.when(F.size(g) <= WINDOW, F.filter(F.array(F.array_min(g)), lambda x: x.isNotNull())).otherwise(
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.size(g) - (WINDOW - 1)),
                    lambda at: F.array_min(F.slice(g, at, WINDOW)),
                )
            )
        )

    return let(let(hashes, grams), least)


def _packed(value: Column, at: Column) -> Column:
    """Hash and position as one number; the smaller one is the smaller hash, then the later place."""
    high = F.shiftrightunsigned(value, 33)
    return F.shiftleft(high, 31) + (F.lit((1 << 31) - 1) - at.cast("long"))


def hashes_of(marks: Column) -> Column:
    return F.transform(marks, lambda mark: F.shiftright(mark, 31).cast("int"))


def positions_of(marks: Column) -> Column:
    """First word of every kept hash."""
    low = (1 << 31) - 1
    return F.transform(marks, lambda mark: (F.lit(low) - mark.bitwiseAND(F.lit(low))).cast("int"))


def as_string(hashes: Column) -> Column:
    """Eight hexadecimal digits per hash, in the order of the text."""
    return F.lower(
        F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 8, "0")), "")
    )


def likeness(left: Column, right: Column) -> Column:
    return let(
        F.array_distinct(left),
        lambda a: let(
            F.array_distinct(right),
            lambda b: let(
                F.size(F.array_intersect(a, b)),
                lambda both: F.when(
                    F.size(a) + F.size(b) > 0,
                    both / (F.size(a) + F.size(b) - both).cast("double"),
                ).otherwise(F.lit(1.0)),
            ),
        ),
    )


def with_next(docs: DataFrame, keep: list[str]) -> DataFrame:
    """docs and, as next_<column>, columns of the following row by descending key."""
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id"), F.lit(_LAST)))
    # Both uses below need the same columns, so that Spark shuffles once for both.
    placed = keyed.withColumn("block", _block_of("key")).repartition("block")
    order = Window.partitionBy("block").orderBy(F.desc("key"), "text")
    inside = placed.withColumns(
        {
            "following": F.lead(F.struct(*keep)).over(order),
            "last_of_block": F.lead(F.lit(1)).over(order).isNull(),
        }
    )
    heads = (
        placed.withColumn("place", F.row_number().over(order))
        .where("place = 1")
        .select(F.col("block").alias("next_block"), F.struct(*keep).alias("head"))
    )
    links = _next_block(checkpointed(keyed.select(_block_of("key").alias("block")).distinct()))
    across = links.join(heads.hint("merge"), "next_block").select(
        F.col("block").alias("link_block"), F.lit(True).alias("link_last"), F.col("head")
    )
    joined = inside.join(
        across.hint("merge"),
        (F.col("block") == F.col("link_block")) & (F.col("last_of_block") == F.col("link_last")),
        "left",
    )
    following = F.coalesce("following", "head")
    return joined.select(*docs.columns, *[following[name].alias(f"next_{name}") for name in keep])


def _block_of(column: str) -> Column:
    return F.shiftright(column, BLOCK_BITS)


def _next_block(blocks: DataFrame) -> DataFrame:
    """block, next_block: the next lower block that exists, after the lowest the highest.

    A block below which its group has no other takes the largest block of the next lower group.
    """
    group = F.shiftright("block", LINK_BITS)
    level = blocks.select("block", F.col("block").alias("lowest"), F.col("block").alias("highest"))
    found = None
    # So many levels leave a single group for any 64-bit id.
    for _ in range(-(-(64 - BLOCK_BITS) // LINK_BITS)):
        below = F.lead("highest").over(Window.partitionBy(group).orderBy(F.desc("block")))
        links = level.select(F.col("lowest").alias("block"), below.alias("next_block"))
        links = links.where("next_block IS NOT NULL")
        found = links if found is None else found.union(links)
        level = level.groupBy(group.alias("block")).agg(
            F.min("lowest").alias("lowest"), F.max("highest").alias("highest")
        )
    # The groups 0 and -1 are left.
    around = level.agg(F.min("lowest").alias("block"), F.max("highest").alias("next_block"))
    across = level.agg(
        F.min(F.when(F.col("block") >= 0, F.col("lowest"))).alias("block"),
        F.max(F.when(F.col("block") < 0, F.col("highest"))).alias("next_block"),
    )
    return found.union(across.where("block + next_block IS NOT NULL")).union(
        around.where("block IS NOT NULL")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, with the likenesses to compare."""
    slim = named(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    marked = slim.withColumn("marks", winnow(F.col("text")))
    pairs = with_next(marked, ["doc_id", "text", "marks"])
    third = F.expr("CAST(n_chars DIV 3 AS INT)")
    edited = (
        pairs.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")),
                F.substring(F.col("next_text"), F.lit(1), third),
            ),
        )
        .withColumn("edited_marks", winnow(F.col("edited")))
    )
    own, other = hashes_of(F.col("marks")), hashes_of(F.col("edited_marks"))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(own).alias("fingerprint"),
        as_string(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, hashes_of(F.col("next_marks"))).alias("near_next"),
        positions_of(F.col("marks")).alias("positions"),
    )
