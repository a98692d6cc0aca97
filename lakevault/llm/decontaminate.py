"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks,
exact weighted-shingle similarity.

1. Anchors. A window that is similar to an item shares a shingle with it, so only places where a
   document has some item's shingle can matter. A bitmap of the items' shingle hashes, at most
   2**23 bits whatever the benchmark, finds them inside the row; a join by hash then drops its
   false hits. No document leaves its row for this.
2. Windows. An anchor at word p, standing at word q of an item of n words, gives the window of n
   words at p - q. Where words were put in or left out, one item has several such diagonals; the
   windows at the first and last anchor of each are tried too, since the number of words that an
   item-sized window loses is least at one of these places.
3. Fingerprints. Each window's 64-bit SimHash over its multiset of shingles, as it is verified, is
   looked up among the items of its length. Blocks of ``BLOCKS`` bits: two fingerprints within
   ``RADIUS`` bits differ in at most RADIUS // 6 bits of one of the six, and the item side lists
   every block value that near, so all pairs within the radius meet. At a similarity of 0.8 the
   multisets' cosine is 8/9 at least, so a bit differs with probability 0.15 at most: 9.7 of 64
   are expected, and over 23 have a chance of some 1e-5.
4. Pairs within the radius are verified: similarity of the two multisets of shingles, the sum of
   the smaller counts over the sum of the larger, at least ``SIMILARITY``.

Words are runs of letters and digits in lower case. Items and texts shorter than a shingle are
shingles as they are.

Defined results: null, empty and wordless texts and items match nothing; repeated rows are reported
each for itself; repeated items likewise; an empty table on either side gives no pairs; columns of
any name are carried by ``keep_clean``.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.storage import stored

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = (11, 11, 11, 11, 10, 10)
RADIUS = 23
MOST_BITS = 1 << 23


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.coalesce(F.filter(words, lambda w: w != ""), F.array().cast("array<string>"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: Column, k: int) -> Column:
    """A hash of each run of k words, from the words' hashes; none if there are fewer."""
    return F.when(F.size(hashes) < k, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(hashes) - k),
        lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k)))))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of a set of hashes: a bit is one if over half of them have it."""
    def fold(a: Column, bit: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.getbit(h, bit) == 1))
        return a.bitwiseOR(F.when(2 * ones > F.size(hashes), F.call_function(
            "shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), fold)


def _shingles_up_to(hashes: Column, k: Column, most: int) -> Column:
    """Shingles of k words, k a column of 1 to ``most``."""
    cut = F.array().cast("array<bigint>")
    for j in range(1, most + 1):
        cut = F.when(k == j, _shingles(hashes, j)).otherwise(cut)
    return cut


def _counted(shingles: Column) -> Column:
    """A multiset as a set: the same shingle's second, third ... occurrence get other hashes."""
    return _let(F.array_sort(shingles), lambda s: F.transform(
        s, lambda x, i: F.xxhash64(x, i - F.array_position(s, x))))


def _longs(values) -> Column:
    """A literal array; Spark folds the cast once."""
    text = ",".join(map(str, values))
    return F.split(F.lit(text), ",").cast("array<bigint>") if text else F.array().cast(
        "array<bigint>")


def item_table(items: DataFrame, text: str, key: str, shingle: int = SHINGLE) -> DataFrame:
    """Items with a word, stored: row number, key, length, shingle length, shingles, SimHash."""
    listed = items.select(F.col(f"`{key}`").alias("item"),
                          _hashes(words_of(F.col(f"`{text}`").cast("string"))).alias("h"))
    sized = listed.filter(F.size("h") > 0).withColumn("n", F.size("h")).withColumn(
        "k", F.least("n", F.lit(shingle)))
    cut = sized.withColumn("shingles", _shingles_up_to(F.col("h"), F.col("k"), shingle))
    return stored(cut.select(
        F.monotonically_increasing_id().alias("iid"), "item", "n", "k", "shingles",
        _let(_counted(F.col("shingles")), simhash).alias("fp")), "benchmark_items")


def _bitmap(shingles: DataFrame) -> tuple[int, Column]:
    """Three bits for each hash in column h: number of bits, and the bitmap as an array of longs."""
    bits = 1 << 10
    while bits < MOST_BITS and bits < 64 * shingles.count():
        bits *= 2
    places = shingles.select(F.explode(F.array(*_places(F.col("h"), bits))).alias("p"))
    rows = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    ).alias("bits")).collect()
    table = [0] * (bits >> 6)
    for r in rows:
        table[r["w"]] = r["bits"]
    return bits, _longs(table)


def _places(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(bits - 1)) for s in (0, 20, 40)]


def _anchors(hashes: Column, ks: list[int], bits: int, bitmap: Column) -> Column:
    """Structs (h, p, k) of the places whose shingle passes the bitmap."""
    def passes(h: Column) -> Column:
        out = F.lit(True)
        for p in _places(h, bits):
            out = out & (F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")),
                                  p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out

    def of(k: int) -> Column:
        return F.filter(
            F.transform(_shingles(hashes, k), lambda h, p: F.when(passes(h), F.struct(
                h.alias("h"), p.alias("p"), F.lit(k).alias("k")))),
            lambda a: a.isNotNull())

    found = [of(k) for k in ks]
    return F.concat(*found) if found else F.array().cast(
        "array<struct<h:bigint,p:int,k:int>>")


def _screen(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """Every document with its word hashes ``h`` and anchors ``hits``, both empty without one."""
    listed = items.select("k", F.explode("shingles").alias("h")).distinct()
    ks = sorted(r["k"] for r in listed.select("k").distinct().collect())
    bits, bitmap = _bitmap(listed)
    hashed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         _hashes(words_of(F.col(f"`{text}`").cast("string"))).alias("h"))
    hit = hashed.withColumn("hits", _anchors(F.col("h"), ks, bits, bitmap))
    some = F.size("hits") > 0
    return hit.select("row", F.when(some, F.col("h")).alias("h"),
                      F.when(some, F.col("hits")).alias("hits"),
                      F.monotonically_increasing_id().alias("rid"))


def _windows(screened: DataFrame, items: DataFrame) -> DataFrame:
    """(rid, n, start, h): item-sized windows at the anchors, with their words' hashes."""
    at = items.select("k", "n", F.posexplode("shingles").alias("q", "h")).distinct()
    anchors = screened.filter(F.col("hits").isNotNull()).select(
        "rid", F.explode("hits").alias("a")).select("rid", "a.*").join(at, ["h", "k"])
    runs = anchors.groupBy("rid", "n", "k", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.min("p").alias("first"), F.max("p").alias("last"))
    starts = runs.select("rid", "n", F.explode(F.array(
        F.col("diagonal"), F.col("first"), F.col("last") + F.col("k") - F.col("n"))).alias("s"))
    wanted = starts.groupBy("rid").agg(F.collect_set(F.struct("n", "s")).alias("w"))
    placed = wanted.join(screened.filter(F.col("hits").isNotNull()).select("rid", "h"), "rid")
    inside = placed.withColumn("w", F.array_distinct(F.transform("w", lambda w: F.struct(
        w["n"].alias("n"),
        F.greatest(F.least(w["s"], F.size("h") - w["n"]), F.lit(0)).alias("start")))))
    return inside.select("rid", F.explode(F.transform("w", lambda w: F.struct(
        w["n"].alias("n"), w["start"].alias("start"),
        F.slice("h", w["start"] + 1, w["n"]).alias("h")))).alias("w")).select("rid", "w.*")


def _block(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, sum(BLOCKS[:b])).bitwiseAND(F.lit((1 << size) - 1))
            for b, size in enumerate(BLOCKS)]


def _near_masks() -> list[int]:
    """For the widest block; in others some make values that no window has."""
    return [sum(1 << b for b in c) for r in range(RADIUS // len(BLOCKS) + 1)
            for c in combinations(range(max(BLOCKS)), r)]


def matches(screened: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(rid, iid, similarity, start, n_words) of each pair of a stored screened document and an
    item that some window of the document is similar to: the best window, the first of equals."""
    shingles = _shingles_up_to(F.col("h"), F.least("n", F.lit(SHINGLE)), SHINGLE)
    windows = _windows(screened, items).withColumn("fp", _let(_counted(shingles), simhash))
    asked = windows.select("*", F.posexplode(F.array(*_block(F.col("fp")))).alias("b", "v"))
    near = items.select("iid", "n", F.col("fp").alias("item_fp"), F.posexplode(
        F.array(*_block(F.col("fp")))).alias("b", "own")).select(
        "iid", "n", "item_fp", "b", F.explode(F.transform(
            _longs(_near_masks()), lambda m: F.col("own").bitwiseXOR(m))).alias("v"))
    # the index grows with the benchmark and its size is not known beforehand: no broadcast
    met = asked.join(near.hint("merge"), ["n", "b", "v"]).filter(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    pairs = met.select("rid", "iid", "start", "h").dropDuplicates(["rid", "iid", "start"])
    cut = _shingles_up_to(F.col("h"), F.col("k"), SHINGLE)
    both = pairs.join(items.select("iid", "k", "shingles"), "iid").select(
        "rid", "iid", "start", F.size("h").alias("n_words"), _counted(cut).alias("a"),
        _counted(F.col("shingles")).alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    scored = both.withColumn("similarity", shared / (F.size("a") + F.size("b") - shared))
    return scored.filter(F.col("similarity") >= similarity).groupBy("rid", "iid").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("at"), "n_words")).alias("m")).select(
        "rid", "iid", "m.similarity", (-F.col("m.at")).alias("start"), "m.n_words")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id",
          text: str = "text", item_text: str = "text") -> DataFrame:
    """(key, item_key, similarity, start, n_words) of each document and item of it."""
    listed = item_table(items, item_text, item_key)
    body = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    screened = stored(_screen(body, listed, "t").filter(F.col("hits").isNotNull()).select(
        F.col("row.k").alias("k"), "h", "hits", "rid"), "screened")
    return (matches(screened, listed)
            .join(screened.select("rid", F.col("k").alias(key)), "rid")
            .join(listed.select("iid", F.col("item").alias(item_key)), "iid")
            .select(key, item_key, "similarity", "start", "n_words"))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """The rows without any item, with the columns they came with."""
    listed = item_table(items, item_text, item_key)
    screened = stored(_screen(docs, listed, text), "screened")
    found = matches(screened, listed).select("rid").distinct()
    clean = screened.filter(F.col("hits").isNull())
    doubted = screened.filter(F.col("hits").isNotNull()).join(found, "rid", "left_anti")
    return clean.select("row.*").union(doubted.select("row.*"))
