"""Prefix trie of conversations by whole-sequence collapse.

Identical rebuilt conversations become one weighted sequence with the list of
the conversations that end there.  Only one conversation of each sequence goes
on: its prefixes are trie nodes, weighted sums over them give every count, and
an anti-join of the sequences with the proper prefixes leaves the leaves.

A prefix is known by its length and the running XOR of 2 x 64 bits of hash of
(position, role, text digest); XOR is associative, so a conversation's turns
may lie in several range partitions ("parts"), each with its own running
values, and the values of earlier parts are added per (conversation, part).
No step needs a conversation, a node or a sequence in one task.

Words under a node are summed without walking the tree: a sequence's words from
a depth on are its total less the running total before that depth, and each
node's own words are counted by the one sequence that owns it (the one that
holds the node's smallest conversation; it owns a suffix of its path).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import tables

#: Conversations whose ids share their quotient by this take their first turns from the smallest of them.
EVERY = 20
#: The number of turns taken is the crc32 of the id modulo this.
SHARED = 4
#: Characters of ids that travel in one row when an end list is hashed.
LIST_CHARS = 8192
KEY = ["depth", "k1", "k2"]
NO_IDS = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns in range partitions of (conversation, order), with digests in place of texts."""
    text = F.coalesce("text", F.lit(""))
    rows = tables.columns(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.sha2(text, 256).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"))  # equal turns of one conversation still spread
    ranged = rows.repartitionByRange("conv_id", "turn", "role", "digest", "row")
    return tables.keep(ranged.withColumn("part", F.spark_partition_id()).drop("row"), "turns")


def _shared(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % SHARED


def _terms(depth: Column, role: Column, digest: Column) -> tuple[Column, Column]:
    return F.xxhash64(depth, role, digest), F.xxhash64(F.lit("second"), digest, role, depth)


def _running(rows: DataFrame, order: list[str]) -> DataFrame:
    """Running terms and words inside each (conversation, part)."""
    w = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({"r1": F.bit_xor("t1").over(w), "r2": F.bit_xor("t2").over(w), "upto": F.sum("words").over(w)})


def rebuilt(conversations: DataFrame, every: int = EVERY) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows) of the rebuilt conversations.

    A conversation c starts with the first h turns of conversation c - c % every
    and goes on with its own turns after its first h, h = crc32(c) % 4.
    Conversations: conv_id, n_shared.  Rows: conv_id, part, depth, words, terms
    and their running values inside the part (part -1: the taken turns).
    """
    turns = _turns(conversations)
    parts = tables.keep(turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("c")), "parts")
    sizes = parts.groupBy("conv_id").agg(F.sum("c").alias("n"))
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    convs = tables.keep(sizes.select("conv_id", base, _shared(F.col("conv_id")).alias("h")).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_shared")), "convs")

    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("c").over(earlier), F.lit(0))).drop("c").join(
        convs.drop("base"), "conv_id")
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "digest")
    numbered = turns.withColumn("n", F.row_number().over(inside)).join(starts, ["conv_id", "part"])
    pos = F.col("n") + F.col("before")
    placed = numbered.withColumns({"pos": pos, "depth": pos - F.col("h") + F.col("n_shared")})
    own = F.col("pos") > F.col("h")
    t1, t2 = _terms(F.col("depth"), F.col("role"), F.col("digest"))
    head = (F.col("conv_id") % every == 0) & (F.col("pos") < SHARED)  # only these rows' contents are needed again
    running = _running(placed.select(
        "conv_id", "part", "n", "pos", "depth", own.alias("own"), F.col("words").alias("all_words"),
        F.when(head, F.col("role")).alias("role"), F.when(head, F.col("digest")).alias("digest"),
        F.when(own, t1).otherwise(0).alias("t1"), F.when(own, t2).otherwise(0).alias("t2"),
        F.when(own, F.col("words")).otherwise(0).alias("words")), ["n"])
    kept = tables.keep(running.drop("n"), "placed")

    heads = kept.where("digest is not null").select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"),
                                                    "role", "digest", F.col("all_words").alias("words"))
    b1, b2 = _terms(F.col("depth"), F.col("role"), F.col("digest"))
    taken = heads.join(convs, "base").where("depth <= n_shared").select(
        "conv_id", F.lit(-1).alias("part"), "depth", "words", b1.alias("t1"), b2.alias("t2"))
    names = ["conv_id", "part", "depth", "words", "t1", "t2", "r1", "r2", "upto"]
    return convs, kept.where("own").select(names).unionByName(_running(taken, ["depth"]).select(names))


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows to rows of joined ids of a key, at most about LIST_CHARS each."""
    key, first, ids, chars, out = None, None, [], 0, []

    def schema(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema(
            [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

    for b in batches:
        for *k, c in zip(*(b[n].to_pylist() for n in (*KEY, "conv_id"))):
            if k != key or chars > LIST_CHARS:
                if ids:
                    out.append(dict(zip(KEY, key)) | {"first": first, "ids": ",".join(ids)})
                key, first, ids, chars = k, c, [], 0
            ids.append(str(c))
            chars += len(ids[-1]) + 1
        if out:
            yield schema(out)
            out = []
    if ids:
        yield schema([dict(zip(KEY, key)) | {"first": first, "ids": ",".join(ids)}])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of ``_ids`` to one digest per key; the ids only stream through."""
    key, state, out = None, None, []

    def schema(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema(
            [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]))

    for b in batches:
        for *k, ids in zip(*(b[n].to_pylist() for n in (*KEY, "ids"))):
            if k == key:
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    out.append(dict(zip(KEY, key)) | {"ends_sha256": state.hexdigest()})
                key, state = k, hashlib.sha256(ids.encode())
        if out:
            yield schema(out)
            out = []
    if key is not None:
        yield schema([dict(zip(KEY, key)) | {"ends_sha256": state.hexdigest()}])


def end_lists(members: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's ascending ids (comma-joined).

    Ids are joined in range partitions first, so the task of a sequence with a
    third of all conversations streams pieces of ``LIST_CHARS`` through one hash
    state, which is as far as a SHA-256 can be split.
    """
    by = [*KEY, "conv_id"]
    pieces = members.select(by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _ids, "depth long, k1 long, k2 long, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        _hash_ids, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, every: int = EVERY) -> DataFrame:
    """One row per trie node of the rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Rows without a conv_id
    take no part; null roles and texts count as empty; turns with equal numbers
    stand in the order of role, then SHA-256 of the text, and repeated rows are
    turns of their own; an empty table has no nodes, not even a root.  Other
    columns of the input are not read.
    """
    convs, rows = rebuilt(conversations, every)
    totals = tables.keep(rows.groupBy("conv_id", "part").agg(
        F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"), F.sum("words").alias("words"),
        F.count(F.lit(1)).alias("n")), "totals")
    whole = totals.groupBy("conv_id").agg(F.bit_xor("t1").alias("k1"), F.bit_xor("t2").alias("k2"),
                                          F.sum("words").alias("total"), F.sum("n").alias("depth"))
    zero = F.lit(0).cast("long")
    members = tables.keep(convs.select("conv_id").join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("depth", "k1", "k2", "total")]), "members")
    sequences = tables.keep(members.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.max("total").alias("total")), "sequences")

    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "part", *[F.coalesce(f(c).over(earlier), zero).alias(a) for f, c, a in (
        (F.bit_xor, "t1", "c1"), (F.bit_xor, "t2", "c2"), (F.sum, "words", "cw"))]).join(
        sequences.select("conv_id", "weight", "total"), "conv_id")
    k1, k2 = (F.col(r).bitwiseXOR(F.col(c)) for r, c in (("r1", "c1"), ("r2", "c2")))
    below = rows.join(carried, ["conv_id", "part"]).select(
        "conv_id", "part", "depth", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("t1")).alias("p1"),
        k2.bitwiseXOR(F.col("t2")).alias("p2"), "words", (F.col("cw") + F.col("upto") - F.col("words")).alias("ahead"),
        "weight", "total")
    roots = sequences.select("conv_id", F.lit(-2).alias("part"), *[zero.alias(c) for c in (*KEY, "p1", "p2", "words", "ahead")],
                             "weight", "total")
    prefixes = tables.keep(below.unionByName(roots), "prefixes")

    nodes = tables.keep(prefixes.groupBy(KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("ahead").alias("ahead"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")), "nodes")
    parents = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                               F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    leaves = sequences.join(parents, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("ahead").alias("since"))
    facts = sequences.select("conv_id", "total").join(leaves, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("since", "total").alias("since"))
    by_part = prefixes.select("conv_id", "part").distinct().join(facts, "conv_id")
    rest = F.col("total") - F.col("ahead")
    sums = prefixes.join(by_part, ["conv_id", "part"]).groupBy(KEY).agg(
        F.sum(F.col("weight") * rest - F.col("total") + F.greatest("ahead", "since")).alias("saved_tokens"),
        F.sum("leaf").alias("n_leaves"))

    known = nodes.join(sums, KEY).join(parents, KEY, "left").join(end_lists(members), KEY, "left")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    deep = known.where("depth > 1").join(above, ["depth", "p1", "p2"])
    # the root, one row, is the parent of all nodes of depth 1
    flat = known.where("depth <= 1").join(F.broadcast(above.where("depth = 1").drop("p1", "p2")), "depth", "left")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
             "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256")]
    return deep.select(names).unionByName(flat.select(names))
