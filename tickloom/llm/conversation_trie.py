"""Prefix trie of conversations by fixed-length block hashing.

1. Turns are sorted over the cluster by (conversation, turn). Tasks number the turns of their part and hash each prefix with a polynomial
   modulo a prime of 127 bits; such hashes compose, so a conversation of any length may lie in many parts, and only
   the few at a part's edges are mended afterwards.
2. Prefixes are cut into blocks of ``block`` turns. Conversations are grouped by (digest before a block, digest after it) first, which
   leaves one row per distinct block with its members counted.
3. Where a block has no sibling, its turns have the block's members and are nodes as they are. Only where siblings diverge are the
   blocks refined: their turns are grouped by prefix, weighted by the blocks' members.
4. Every node belongs to the path of its smallest member. Sums over subtrees are sums over paths, added up along the tree of paths
   by doubling, and then along each path from its end, in chunks of bounded length.
5. The identifiers of conversations that end at a node are joined in sorted runs and hashed as a stream.

Defined results: null role or text is empty; turns are ordered by turn (null first), ties by a hash of role and text, and repeated rows are
turns of their own. Rows of a null conversation belong to none and are left out. An empty table has no nodes, as no
conversation begins with the empty sequence. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.skew import lookup_join
from tickloom.llm.storage import saved

PRIME = 2**127 - 1
BASE = 0x3C6EF372FE94F82B9E3779B97F4A7C15  # any number of about the prime's size
ROOT = bytes(16)
_CHUNK = 1_024
_RUN = 512
_ROWS_IN_PART = 250_000


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big") % PRIME


def _digest(number: int) -> bytes:
    return number.to_bytes(16, "big")


class _Powers:
    """Powers of the base; the first ones are kept."""

    def __init__(self) -> None:
        self.first = [1]
        for _ in range(64):
            self.first.append(self.first[-1] * BASE % PRIME)

    def __getitem__(self, n: int) -> int:
        return self.first[n] if n < len(self.first) else pow(BASE, n, PRIME)


_TURN = "conv long, part int, place long, digest binary, before binary, size long, edge boolean"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix digests of sorted turns (conv, hash, size), both from the part's first turn of a conversation."""
    part = TaskContext.get().partitionId()
    first = now = None
    place, state = 0, 0
    held = None  # last row so far, not yet sent: the part's last row is an edge

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["conv", "part", "place", "digest", "before", "size", "edge"])

    for batch in batches:
        rows = []
        for conv, turn, size in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != now:
                if held is not None:
                    rows.append((*held, now == first))
                    held = None
                first = conv if first is None else first
                now, place, state = conv, 0, 0
            if held is not None:
                rows.append((*held, False))
            before = _digest(state)
            place, state = place + 1, (state * BASE + _number(turn)) % PRIME
            held = (conv, part, place, _digest(state), before, size)
        if rows:
            yield batch_of(rows)
    if held is not None:
        yield batch_of([(*held, True)])


def _carried(edges: list) -> dict[tuple[int, int], tuple[int, int]]:
    """(place, state) with which a part continues a conversation, from the last turns (conv, part, place, digest) at the parts' edges."""
    powers = _Powers()
    carried = {}
    conv, place, state = None, 0, 0
    for row in sorted(edges, key=lambda r: (r["conv"], r["part"])):
        if row["conv"] != conv:
            conv, place, state = row["conv"], 0, 0
        if place:
            carried[row["conv"], row["part"]] = (place, state)
        state = (state * powers[row["place"]] + _number(row["digest"])) % PRIME
        place += row["place"]
    return carried


def _turns(rows: DataFrame) -> DataFrame:
    """(conv, place, digest, before, size) of all turns: place from 1, digests of the turns up to it and before it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("hash"),
        F.octet_length(text).cast("long").alias("size"),
    )
    total = rows.count()
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // _ROWS_IN_PART))
    # equal rows can be told apart by nothing else, and a part must not have to hold all of them
    keyed = narrow.withColumn("copy", F.monotonically_increasing_id())
    order = ["conv", F.col("turn").asc_nulls_first(), "hash", "copy"]
    sorted_rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "hash", "size")
    local = saved(sorted_rows.mapInArrow(_numbered, _TURN), "turns")
    # two rows of each part at most
    carried = _carried(local.where("edge").select("conv", "part", "place", "digest").collect())

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("conv", "part", "place", "digest", "before")}
            places, digests, befores = columns["place"], columns["digest"], columns["before"]
            for k, key in enumerate(zip(columns["conv"], columns["part"])):
                if key in carried:
                    place, state = carried[key]
                    digests[k] = _digest((state * powers[places[k]] + _number(digests[k])) % PRIME)
                    befores[k] = _digest((state * powers[places[k] - 1] + _number(befores[k])) % PRIME)
                    places[k] += place
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(places, pa.int64()), pa.array(digests, pa.binary()), pa.array(befores, pa.binary()), batch.column("size")],
                ["conv", "place", "digest", "before", "size"],
            )

    settled = local.drop("edge")
    return saved(settled.mapInArrow(moved, "conv long, place long, digest binary, before binary, size long"), "places") if carried else settled.drop("part")


def _root() -> Column:
    return F.lit(bytearray(ROOT))


def rebuilt(rows: DataFrame, head_of: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Prefixes (conv, depth, digest, before, size) of the rebuilt conversations, and the conversations (conv).

    Conversation c starts with the first h turns of conversation c - c % ``head_of`` and goes on with its own turns after its first h;
    h is the crc32 of c's decimal text modulo ``most``.
    """
    turns = _turns(rows)
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    first = turns.where(F.col("place") < most).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "before", "size"))).alias("own"))
    first = saved(first.withColumn("h", taken), "heads")
    heads = first.select(F.col("conv").alias("from_conv"), F.col("own").alias("base"))
    wide = first.withColumn("from_conv", F.col("conv") - F.col("conv") % head_of).join(heads, "from_conv", "left")
    base = F.coalesce(F.slice("base", F.lit(1), F.col("h").cast("int")), F.expr("slice(own, 1, 0)"))
    wide = saved(wide.select("conv", "h", "own", base.alias("base")), "bases")

    def last(turns_of: str, count: Column) -> Column:
        return F.when(count > 0, F.element_at(turns_of, count.cast("int"))["digest"]).otherwise(_root())

    scalars = wide.select(
        "conv", F.size("base").cast("long").alias("kept"), last("base", F.size("base")).alias("start"), last("own", F.least(F.col("h"), F.size("own").cast("long"))).alias("left_out")
    )
    tails = turns.where(F.col("place") > taken).withColumn("h", taken)
    joined = lookup_join(tails, scalars, "conv")

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("place", "digest", "before", "h", "start", "left_out")}
            digests, befores = columns["digest"], columns["before"]
            for k, (place, h, start, left_out) in enumerate(zip(columns["place"], columns["h"], columns["start"], columns["left_out"])):
                if start != left_out:
                    shift = _number(start) - _number(left_out)
                    digests[k] = _digest((shift * powers[place - h] + _number(digests[k])) % PRIME)
                    befores[k] = _digest((shift * powers[place - h - 1] + _number(befores[k])) % PRIME)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("depth"), pa.array(digests, pa.binary()), pa.array(befores, pa.binary()), batch.column("size")],
                ["conv", "depth", "digest", "before", "size"],
            )

    moved = joined.withColumn("depth", F.col("place") - F.col("h") + F.col("kept")).mapInArrow(replaced, "conv long, depth long, digest binary, before binary, size long")
    copied = wide.select("conv", F.inline("base")).withColumnRenamed("place", "depth")
    return saved(copied.select("conv", "depth", "digest", "before", "size").unionByName(moved), "prefixes"), first.select("conv")


def trie_nodes(prefixes: DataFrame, conversations: DataFrame, block: int = 4) -> DataFrame:
    """(digest, before, depth, size, n, conv): all nodes with their members' number and smallest id, by blocks first."""
    turn = F.struct("depth", "digest", "before", "size")
    paths = prefixes.groupBy("conv", F.expr(f"(depth - 1) div {block}").alias("k")).agg(F.sort_array(F.collect_list(turn)).alias("path"))
    blocks = paths.select("conv", F.element_at("path", 1)["before"].alias("begin"), F.element_at("path", -1)["digest"].alias("end"), "path")
    blocks = saved(blocks.groupBy("begin", "end").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("path").alias("path")), "blocks")
    alone = blocks.groupBy("begin").agg(F.count(F.lit(1)).alias("siblings"), F.min("end").alias("end")).where("siblings = 1").select("end")
    marked = blocks.join(alone.withColumn("alone", F.lit(True)), "end", "left").select("n", "conv", F.col("alone").isNotNull().alias("alone"), F.inline("path"))
    whole = marked.where("alone").select("digest", "before", "depth", "size", "n", "conv")
    refined = marked.where("NOT alone").groupBy("digest", "before", "depth", "size").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))
    top = conversations.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0")
    top = top.select(_root().alias("digest"), F.lit(None).cast("binary").alias("before"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), "n", "conv")
    return whole.unionByName(refined).unionByName(top)


def _path_totals(paths: DataFrame) -> DataFrame:
    """(conv, leaves, saved) of paths (conv, up, leaves, saved) with all paths below them, by doubling the distance looked down."""
    known = saved(paths, "paths")
    while not known.where("up IS NOT NULL").isEmpty():
        open_paths = known.where("up IS NOT NULL")
        below = open_paths.groupBy(F.col("up").alias("conv")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = lookup_join(open_paths.select("conv", "up"), known.select(F.col("conv").alias("up"), F.col("up").alias("next")), "up")
        known = saved(
            known.join(below, "conv", "left")
            .join(above.select("conv", "next"), "conv", "left")
            .select(
                "conv",
                F.col("next").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "paths",
        )
    return known.select("conv", "leaves", "saved")


def _from_the_end(nodes: DataFrame) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` along each path (conv), from its end to the node, in chunks of bounded length."""
    chunked = nodes.withColumn("chunk", F.expr(f"depth div {_CHUNK}"))
    sums = chunked.groupBy("conv", "chunk").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("conv").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv", "chunk", F.sum("leaves").over(later).alias("more_leaves"), F.sum("saved").over(later).alias("more_saved")).where("more_leaves IS NOT NULL")
    inside = Window.partitionBy("conv", "chunk").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.join(carried, ["conv", "chunk"], "left")
        .withColumn("leaves", F.sum("leaves").over(inside) + F.coalesce("more_leaves", F.lit(0)))
        .withColumn("saved", F.sum("saved").over(inside) + F.coalesce("more_saved", F.lit(0)))
        .drop("chunk", "more_leaves", "more_saved")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv) as runs of at most ``_RUN`` ids of one node, joined by commas."""
    at, ids = None, []

    def run() -> tuple:
        return at, ids[0], ",".join(map(str, ids))

    for batch in batches:
        rows = []
        for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (digest != at or len(ids) >= _RUN):
                rows.append(run())
                ids = []
            at = digest
            ids.append(conv)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["digest", "first", "ids"])
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in run()], ["digest", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's runs, which follow each other in order; only the hash's state is kept."""
    at, state = None, None
    for batch in batches:
        rows = []
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest != at:
                if state is not None:
                    rows.append((at, state.hexdigest()))
                at, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["digest", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], ["digest", "ends"])


def end_hashes(prefixes: DataFrame, conversations: DataFrame) -> DataFrame:
    """(digest, ends): SHA-256 of the ids of the conversations that end at a node, ascending and joined by commas."""
    last = prefixes.groupBy("conv").agg(F.max_by("digest", "depth").alias("digest"))
    ends = conversations.join(last, "conv", "left").select(F.coalesce("digest", _root()).alias("digest"), "conv")
    parts = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = saved(ends, "ends").repartitionByRange(parts, "digest", "conv").sortWithinPartitions("digest", "conv")
    runs = ordered.mapInArrow(_runs, "digest binary, first long, ids string")
    return runs.repartition("digest").sortWithinPartitions("digest", "first").select("digest", "ids").mapInArrow(_hashed, "digest binary, ends string")


def conversation_trie(rows: DataFrame, head_of: int = 5, most: int = 9, block: int = 4) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see the module for the method and the defined results."""
    prefixes, conversations = rebuilt(rows, head_of, most)
    nodes = saved(trie_nodes(prefixes, conversations, block), "nodes")
    children = nodes.where("before IS NOT NULL").groupBy(F.col("before").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("digest").alias("before"), F.col("conv").alias("parent"))
    placed = lookup_join(nodes, parents, "before", "left").join(children, "digest", "left").join(end_hashes(prefixes, conversations), "digest", "left")
    placed = saved(
        placed.select(
            "conv", "depth", "parent", "n", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved"), "ends",
        ),
        "placed",
    )
    tops = placed.where("parent IS NULL OR parent <> conv").select("conv", F.col("parent").alias("up"), (F.col("depth") - 1).alias("at"))
    own = placed.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = _path_totals(tops.select("conv", "up").join(own, "conv"))
    hung = totals.join(tops.where("up IS NOT NULL"), "conv").groupBy(F.col("up").alias("conv"), F.col("at").alias("depth"))
    hung = hung.agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    summed = placed.join(hung, ["conv", "depth"], "left").withColumns(
        {"leaves": F.col("leaves") + F.coalesce("hung_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("hung_saved", F.lit(0))}
    )
    done = _from_the_end(saved(summed.drop("hung_leaves", "hung_saved"), "summed"))
    return done.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
