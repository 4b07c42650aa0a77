"""Near-duplicate documents by SetSketch registers.

A document is the set of its shingles of five words. Its sketch has 128 registers: each is the minimum of
exponentially distributed hash values over the set, kept as a truncated logarithm to base 1.001 in 16
bits. Registers of a union are the larger ones of its parts, and equal registers are likelier the more two sets share.

1. Documents with equal sets form one class; everything further works on classes.
2. Registers are banded, four at a time in 32 bands. Two sets of similarity 0.85 share no band with a probability below
   10**-10. In every band bucket all members are paired with the bucket's smallest member only.
3. A pair's similarity is estimated from all 128 registers by maximum likelihood. Pairs that are more than
   five standard deviations below the threshold are dropped; the others are verified on the full sets.
4. Verified links give components. A bucket whose members are all in one component needs nothing more. In the others,
   members of different components are compared by their sketches. Those of small buckets that pass the same estimate are
   verified like the first pairs. A large bucket is cut into blocks, and each task compares one or two blocks with the
   full sets at hand, likeliest pairs first; it reports only links that join components, at most one per member.
   So no link between two components is lost, and no group is ever expanded into all its pairs.

Defined results: a null or blank text has the empty set, links with nothing and is its own component. Rows that
repeat another are members of its class. A row with a null id belongs to its component but never names it, unless
no member has an id. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.storage import saved

WORDS = 5
REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.001, 20.0, 65_535
BLOCK = 2_048
SMALL_BUCKET = 32

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _odd(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers from a seed."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return _mixed(x) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACE = _odd(3, WORDS + 1)
_REGISTER = _odd(5, REGISTERS)
_BAND_MIX = _odd(7, REGISTERS // BAND)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of so many words; fewer words are one shingle as a whole."""
    from xxhash import xxh3_64_intdigest

    parts = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = len(w) - words + 1
    if n < 1:
        total = np.uint64(len(w)) * _PLACE[words]
        for i in range(len(w)):
            total = total + w[i : i + 1] * _PLACE[i]
        return _mixed(total)
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total += w[i : i + n] * _PLACE[i]
    return np.unique(_mixed(total))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; all zero for the empty set."""
    if not len(hashes):
        return np.zeros(REGISTERS, np.uint16)
    most = np.zeros(REGISTERS, np.uint64)
    for a in range(0, len(hashes), 8192):
        h = hashes[a : a + 8192]
        for r in range(0, REGISTERS, 16):
            most[r : r + 16] = np.maximum(most[r : r + 16], (h * _REGISTER[r : r + 16, None]).max(1))
    # The largest of uniform values is the smallest of exponential ones.
    least = -np.log((most.astype(np.float64) + 1.0) / 2.0**64)
    k = np.floor(1.0 - np.log(np.maximum(least, 1e-300) / RATE) / np.log(BASE)) + TOP // 4
    return np.clip(k, 0, TOP).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of registers."""
    bands = np.ascontiguousarray(registers, "<u2").view("<u8")
    return (_mixed(bands * _BAND_MIX + _BAND_MIX[::-1])).view(np.int64)


def likely_similarity(more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of sets of n and m elements from the counts of registers that are larger in the first or the second.

    A register differs in favour of the first set with probability p(u - v J), u and v being the two sets'
    shares of their sum and p(x) = -log_b(1 - x (b - 1) / b).
    """
    u = (n / (n + m))[:, None]
    v = 1.0 - u
    j = np.linspace(0.0, 1.0, 201)[None, :] * np.minimum(u / v, v / u)
    scale = (BASE - 1.0) / BASE

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-x * scale) / np.log(BASE), 1e-12, 1.0)

    first, second = p(u - v * j), p(v - u * j)
    same = np.clip(1.0 - first - second, 1e-12, 1.0)
    d1, d2 = more[:, None], less[:, None]
    score = d1 * np.log(first) + d2 * np.log(second) + (REGISTERS - d1 - d2) * np.log(same)
    return np.take_along_axis(j, score.argmax(1)[:, None], 1)[:, 0]


def least_estimate(threshold: float, deviations: float = 5.0) -> float:
    return threshold - deviations * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column(1)]
        digests = np.array([(s.sum(dtype=np.uint64), np.bitwise_xor.reduce(_mixed(s + np.uint64(1)), initial=np.uint64(len(s)))) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([sketch(s).tobytes() for s in sets], pa.binary())],
            names=["doc_id", "n", "d1", "d2", "sketch"],
        )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_registers(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], names=["key", "node"])


def _promising(cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _registers(batch.column(4)), _registers(batch.column(5))
                n, m = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
                keep = pa.array(likely_similarity((x > y).sum(1), (x < y).sum(1), n, m) >= cut)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of the texts whose set is the wanted one."""
    for batch in batches:
        nodes, found = [], []
        for node, d1, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            s = shingles(text)
            if int(s.sum(dtype=np.uint64)) == d1 & (1 << 64) - 1:
                nodes.append(node)
                found.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])


def _cross_pairs(table: pa.Table, key: tuple, cut: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, js, estimates): promising pairs of different components, within one block or between two of a bucket.

    A pair that meets in several buckets is handled in that of its first common band.
    """
    x, n = _registers(table["sketch"].combine_chunks()), table["n"].to_numpy().astype(float)
    node, root, block = (table[c].to_numpy() for c in ("node", "root", "block"))
    keys = band_keys(x)
    band = int((keys[0] == key[0].as_py()).argmax())
    own, other = key[1].as_py(), key[2].as_py()
    left, right = np.flatnonzero(block == own), np.flatnonzero(block == other)
    alike = (cut - 0.1) * REGISTERS  # an estimate of cut needs more equal registers than this
    for i in left:
        js = right[(root[right] != root[i]) & ((own != other) | (node[right] > node[i]))]
        js = js[(x[js] == x[i]).sum(1) >= alike]
        js = js[(keys[js] == keys[i]).argmax(1) == band]
        if len(js):
            j = likely_similarity((x[js] < x[i]).sum(1), (x[js] > x[i]).sum(1), np.full(len(js), n[i]), n[js])
            if (j >= cut).any():
                yield int(i), js[j >= cut], j[j >= cut]


def _pair_table(pairs: list[np.ndarray]) -> pa.Table:
    both = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
    return pa.table({"a": pa.array(both.min(1, initial=1 << 62)), "b": pa.array(both.max(1, initial=-1))})


def _across(cut: float):
    """Promising pairs of a small bucket."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        return _pair_table([np.column_stack([np.full(len(js), node[i]), node[js]]) for i, js, _ in _cross_pairs(table, key, cut)])

    return run


def _links_across(cut: float, whole: int):
    """Links of a large bucket that join components: promising pairs, likeliest first, verified on their full sets."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, sets = table["node"].to_numpy(), [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in table["shingles"]]
        above = {int(r): int(r) for r in table["root"].to_numpy()}
        root = table["root"].to_pylist()

        def top(r: int) -> int:
            while above[r] != r:
                above[r] = above[above[r]]
                r = above[r]
            return r

        links = []
        pairs = [(-e, i, int(j)) for i, js, es in _cross_pairs(table, key, cut) for j, e in zip(js, es)]
        for _, i, j in sorted(pairs):
            r, q = top(root[i]), top(root[j])
            if r != q:
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= whole * (len(sets[i]) + len(sets[j]) - shared):
                    above[r] = q
                    links.append(np.array([[node[i], node[j]]]))
        return _pair_table(links)

    return run


def full_sets(nodes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, shingles) of the given nodes, from the text of one document of each class."""
    wanted = saved(classes.join(nodes, "node", "left_semi").select("node", "d1", "least_id"), "wanted")
    # Shuffled whatever the sizes are: the wanted rows grow with the input, so they are never broadcast.
    fetched = texts.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("least_id"))).select("node", "d1", "text")
    return saved(fetched.mapInArrow(_sets, "node long, shingles array<bigint>"), "sets")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def verified(pairs: DataFrame, sets: DataFrame, whole: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, in hundredths."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return pairs.join(second, "b").join(first, "a").where(shared * 100 >= union * whole).select("a", "b").distinct()


def near_components(documents: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text", block: int = BLOCK, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """One row per document: size of its set, the smallest id reachable over links, and whether that is its own."""
    texts = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = saved(texts.mapInArrow(_sketched, "doc_id long, n long, d1 long, d2 long, sketch binary"), "sketches")
    classes = base.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("least_id"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    cut = least_estimate(threshold)

    bands = classes.select("node", "sketch").mapInArrow(_banded, "key long, node long")
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count(F.lit(1)).alias("members")).where("hub <> last").drop("last")
    members = saved(bands.join(hubs, "key"), "members")
    tested = saved(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "hub-pairs")
    small = classes.select("node", "n", "sketch")
    sides = tested.join(small.toDF("a", "n", "x"), "a").join(small.toDF("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y")
    near = saved(sides.mapInArrow(_promising(cut), "a long, b long"), "near-pairs")
    whole = int(round(threshold * 100))
    links = saved(verified(near, full_sets(ends_of(near), classes, texts), whole), "links")
    roots = saved(components(links), "roots")

    # Buckets of three or more whose members are not all in one component; those of two have been tested.
    placed = members.where("members > 2").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("size")).where("r1 <> r2")
    mixed = placed.join(saved(mixed.select("key", "size"), "mixed"), "key")
    own = ["key", "one", "two"]
    few = mixed.where(F.col("size") <= small_bucket).select("key", F.lit(0).alias("one"), F.lit(0).alias("two"), F.lit(0).alias("block"), "node", "root")
    rest = few.join(small, "node").groupBy(*own).applyInArrow(_across(cut), "a long, b long")
    rest = saved(rest.join(tested, ["a", "b"], "left_anti"), "cross-pairs")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = mixed.where(F.col("size") > small_bucket).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = saved(dealt.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "root"), "blocks")
    sets = full_sets(ends_of(rest).unionByName(dealt.select("node")).distinct(), classes, texts)
    many = dealt.join(small, "node").join(sets.dropDuplicates(["node"]), "node").groupBy(*own).applyInArrow(_links_across(cut, whole), "a long, b long")
    roots = saved(components(saved(links.unionByName(verified(rest, sets, whole)).unionByName(many), "all-links")), "all-roots")

    least = classes.join(roots, "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = roots.join(least, "root").select("node", "component_id")
    of_class = classes.join(named, "node", "left").select("d1", "d2", F.coalesce("component_id", "least_id").alias("component_id"))
    out = base.where("n > 0").select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"]).select("doc_id", "n", "component_id")
    out = out.unionByName(base.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
