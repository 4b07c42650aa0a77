"""Spelling variants by an index of variable-length grams.

Words are near if one inserted, deleted or replaced code point makes one of the other. They are found over distinct words:

1. Grams of ``shortest`` to ``longest`` code points of all words (with a mark at either end) are counted. The dictionary keeps those
   above a frequency; its size is bounded by ``dictionary_size`` per length, whatever the number of words.
2. A word is decomposed: from each place the gram grows while it is frequent, so it ends as soon as few words hold it; grams
   inside an earlier gram are left out. Few places hold a frequent gram's extension, so the lists stay short.
3. One edit can only change the grams that touch the edited place or begin right after it: a longer gram from further left would have
   to hold a frequent string that already reached as far before the edit. The largest number of grams so touched at one place is the word's
   bound: a near word keeps all other grams, at the same place from the start or from the end.
4. Of two near words' grams, ordered from rare to frequent, the first that both keep is therefore among the first ``bound + 1`` of
   either. Only these lists are merged, by gram, word length and place; longer lists are skipped. What meets is verified on the words.
5. Words whose bound leaves no gram, or whose rarest grams still are frequent ones of full length, cannot rely on that. They are compared
   among themselves by their forms with one code point masked or deleted, so no pair is lost and no list is unbounded.

Defined results: null texts have no words; a null id counts as empty text in the hash. Repeated rows count as often as they
occur. An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.skew import lookup_join
from tickloom.llm.storage import saved

RUNS = re.compile(rb"[a-z]+(?:\xc3[\x80-\xbf][a-z]*)*|(?:\xc3[\x80-\xbf][a-z]*)+")
MARK = "\x01"
MASK = "\x02"
_FLUSH_AT = 200_000


def _flushed(counts: Counter, name: str, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    items = list(counts.items())
    counts.clear()
    for k in range(0, len(items), size):
        part = items[k : k + size]
        keys = pa.array([w for w, _ in part]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([keys, pa.array([n for _, n in part], pa.int64())], [name, "n"])


def distorted(run: bytes, head: int, every: int) -> bytes:
    """The run, without one code point if ``every`` divides its hash (``head``: crc32 of what precedes it)."""
    h = zlib.crc32(run, head)
    if h % every:
        return run
    word = run.decode()
    place = h % len(word)
    return (word[:place] + word[place + 1 :]).encode()


def word_counts(docs: DataFrame, every: int = 97, least_chars: int = 5, least_n: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of all texts: runs of letters, A-Z in lower case; counted per text, per task, then overall."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                head = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(RUNS.findall(text.as_py().lower())).items():
                    if len(run) >= least_chars:  # no run of fewer bytes has that many code points, and none grows
                        counts[distorted(run, head, every)] += n
                if len(counts) >= _FLUSH_AT:
                    yield from _flushed(counts, "word")
        yield from _flushed(counts, "word")

    texts = docs.where(F.col(text_column).isNotNull()).select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"), F.col(text_column).cast("binary").alias("text")
    )
    counted = texts.mapInArrow(count, "word string, n long").where(F.char_length("word") >= least_chars)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def gram_counts(words: DataFrame, shortest: int, longest: int) -> DataFrame:
    """(gram, n): occurrences of all grams of these lengths in the distinct words, end marks included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                padded = f"{MARK}{word}{MARK}"
                for size in range(shortest, longest + 1):
                    counts.update([padded[p : p + size] for p in range(len(padded) - size + 1)])
                if len(counts) >= _FLUSH_AT:
                    yield from _flushed(counts, "gram")
        yield from _flushed(counts, "gram")

    return words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def decomposed(word: str, counts: dict[str, int], frequent: int, shortest: int, longest: int) -> list[tuple[int, str]]:
    """(start, gram) of the marked word: from each place the gram grows while it is frequent; none lies inside an earlier one."""
    padded = f"{MARK}{word}{MARK}"
    size = len(padded)
    end = 0
    grams = []
    for start in range(size - shortest + 1):
        stop = start + shortest
        while stop < size and stop - start < longest and counts.get(padded[start:stop], 0) > frequent:
            stop += 1
        if stop > end:
            grams.append((start, padded[start:stop]))
            end = stop
    return grams


def most_touched(grams: list[tuple[int, str]], size: int) -> int:
    """Largest number of grams that one edit of the word (marked length ``size``) can change."""
    starts = [start - 1 for start, _ in grams]
    ends = [start + len(gram) - 1 for start, gram in grams]
    most = begun = done = 0
    for place in range(1, size - 1):
        while begun < len(starts) and starts[begun] <= place:
            begun += 1
        while ends[done] < place:
            done += 1
        most = max(most, begun - done)
    return most


def merged_lists(word: str, counts: dict[str, int], frequent: int, shortest: int, longest: int) -> tuple[list[tuple[int, str]], bool]:
    """Grams whose lists must be merged to find the word's near words, and whether these lists alone do not suffice."""
    grams = decomposed(word, counts, frequent, shortest, longest)
    bound = most_touched(grams, len(word) + 2)
    first = sorted(grams, key=lambda g: (counts.get(g[1], 0), g[1], g[0]))[: bound + 1]
    rare = [g for g in first if counts.get(g[1], 0) <= frequent]
    return rare, bound >= len(grams) or len(rare) < len(first)


def letters_of(word: str) -> int:
    """Set of the word's letters as bits; one edit changes two bits at most."""
    bits = 0
    for letter in word:
        bits |= 1 << ord(letter) % 63
    return bits


def _keys(grams: Column) -> Column:
    """List keys of a gram: words of equal length meet at one place, longer and shorter ones at one place from the start or the end."""
    length, start = F.char_length("word"), grams["start"]
    rest = length - start

    def key(kind: str, short: Column, place: Column) -> Column:
        return F.xxhash64(grams["gram"], F.lit(kind), short, place)

    return F.array(
        F.struct(key("same", length, start).alias("key"), F.lit(0).alias("side")),
        F.struct(key("start", length, start).alias("key"), F.lit(1).alias("side")),
        F.struct(key("end", length, rest).alias("key"), F.lit(1).alias("side")),
        F.struct(key("start", length - 1, start).alias("key"), F.lit(2).alias("side")),
        F.struct(key("end", length - 1, rest).alias("key"), F.lit(2).alias("side")),
    )


def _met(entries: DataFrame) -> DataFrame:
    """(a, b) of all entries (key, side, word, letters) that meet: equal lengths once, shorter with longer words."""
    left = entries.where("side <> 2").select("key", "side", F.col("word").alias("a"), F.col("letters").alias("c"))
    right = entries.where("side <> 1").select("key", F.col("side").alias("other"), F.col("word").alias("b"), F.col("letters").alias("d"))
    meet = "bit_count(c ^ d) <= 2 AND (side = 1 AND other = 2 OR side = 0 AND other = 0 AND a < b)"
    return left.join(right.hint("shuffle_merge"), "key").where(meet).select("a", "b")


def near_pairs(words: DataFrame, shortest: int = 2, longest: int = 6, most_in_list: int = 1024, dictionary_size: int = 50_000) -> DataFrame:
    """(a, b): all pairs of distinct words (column ``word``) that are one edit apart, each once.

    ``most_in_list``: occurrences from which a gram counts as frequent; ``dictionary_size`` bounds the grams of each length that tasks are
    sent. Both change the work only.
    """
    spark = words.sparkSession
    grams = saved(gram_counts(words, shortest, longest), "grams")
    total = grams.where(F.char_length("gram") == shortest).agg(F.sum("n")).first()[0] or 0
    known = max(most_in_list // 8, total // dictionary_size)  # fewer than dictionary_size grams of a length occur more often than that
    frequent = max(most_in_list, known)
    counts = spark.sparkContext.broadcast({row["gram"]: row["n"] for row in grams.where(F.col("n") > known).toLocalIterator()})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_words = batch.column(0).to_pylist()
            found = [merged_lists(word, counts.value, frequent, shortest, longest) for word in all_words]
            lists = pa.array([[{"start": s, "gram": g} for s, g in rare] for rare, _ in found], pa.list_(pa.struct([("start", pa.int32()), ("gram", pa.string())])))
            letters = pa.array([letters_of(word) for word in all_words], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), letters, lists, pa.array([left for _, left in found], pa.bool_())], ["word", "letters", "grams", "left"])

    parts = saved(words.select("word").mapInArrow(split, "word string, letters long, grams array<struct<start int, gram string>>, left boolean"), "decomposed")
    lists = parts.select("word", "letters", F.explode("grams").alias("g"))
    entries = lists.select("word", "letters", F.inline(_keys(F.col("g"))))
    verified = _met(entries).where(F.levenshtein("a", "b") == 1)
    places = F.sequence(F.lit(1), F.char_length("word"))

    def without(place: Column, by: Column) -> Column:
        return F.xxhash64(F.substring(F.col("word"), F.lit(1), place - 1), by, F.substring(F.col("word"), place + 1, F.char_length("word")))

    masked = F.transform(places, lambda p: F.struct(without(p, F.concat(F.lit(MASK), p)).alias("key"), F.lit(0).alias("side")))
    cut = F.transform(places, lambda p: F.struct(F.xxhash64(F.concat(F.substring(F.col("word"), F.lit(1), p - 1), F.substring(F.col("word"), p + 1, F.char_length("word")))).alias("key"), F.lit(2).alias("side")))
    whole = F.array(F.struct(F.xxhash64("word").alias("key"), F.lit(1).alias("side")))
    forms = parts.where("left").select("word", "letters", F.inline(F.concat(masked, F.array_distinct(cut), whole)))
    return verified.unionByName(_met(forms).where(F.levenshtein("a", "b") == 1)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form): the last word reached by following forms; the word itself where there is none.

    Paths are halved round by round, so the number of rounds grows with the logarithm of the longest one.
    """
    known = saved(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNull().alias("done")), "roots")
    while not known.where("NOT done").isEmpty():
        targets = known.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("done").alias("ends"))
        moved = lookup_join(known.where("NOT done"), targets, "root")
        known = saved(
            known.where("done").unionByName(moved.select("word", F.col("next").alias("root"), F.col("ends").alias("done"))),
            "roots",
        )
    return known.select("word", "root")


def spelling_groups(words: DataFrame, **index: int) -> DataFrame:
    """A table (word, n) with each word's near words counted, its form, the root of its forms and the form's n.

    The form is the near word of largest n (ties: smallest in code-point order), if that n is twice the word's at least.
    """
    pairs = saved(near_pairs(words, **index), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("other_n"))
    best = F.min_by(F.struct(F.col("b"), F.col("other_n")), F.struct(-F.col("other_n"), F.col("b")))
    near = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    follows = F.col("best.other_n") >= 2 * F.col("n")
    table = saved(
        joined.select(
            "word",
            F.when(follows, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(follows, F.col("best.other_n")).alias("form_n"),
        ),
        "forms",
    )
    return table.join(roots(table), "word").select("word", "form", "root", "n", "n_near", "form_n")
