"""Benchmark decontamination with DataFrame functions only.

A text is contaminated by an item where one of its windows of exactly the
item's number of words reaches a weighted similarity of 0.75 with the item:
sum of minima over sum of maxima of the counts of their 5-word shingles (items
of fewer words are one shingle). Words are what stands between the six white
space characters, in lower case.

Windows get a 64-bit SimHash of their weighted shingles. Fingerprints within
``radius`` bits agree in at least one of radius + 1 bit blocks (pigeonhole), so
an equi-join on (item, block, value) finds all of them; every pair found is
verified exactly. At a similarity of 0.75 the expected distance is 11 bits with
a deviation of 3, so the radius of 23 lies 4 deviations above.

Windows are made only where one can reach the threshold: a window with
similarity 0.75 holds 6/7 of its item's shingles, so a text whose own counts do
not cover 6/7 of an item's shingles needs no windows for it. This test loses no
pair. Before it a streamed test of single words leaves out texts that lack words
such a window must have. Items' words and shingles and keys of texts that pass
a test are broadcast only up to ``broadcast_limit`` rows and shuffled above it.

Missing and empty texts and items have no windows and match nothing. Rows that
repeat an id, of texts or items, are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import keyed, narrow, stored

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
RADIUS = 23
SEPARATOR = "[ \t\n\u000b\f\r]+"
TELLING_WORDS = 8
BROADCAST_LIMIT = 1_000_000  # rows of 8 to 16 bytes


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


def shingles(w: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words."""
    n = F.size(w) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(F.slice(w, i + 1, size)))).otherwise(F.array().cast("array<bigint>"))


def fingerprint(features: DataFrame, *keys: str, lanes: int = 4) -> DataFrame:
    """64-bit SimHash per key of rows (keys, h, weight): bit i says whether most of the weight has bit i of h set.

    Each sum counts ``lanes`` bits side by side: 4 lanes of 15 bits hold a weight of up to 32,767, 2 lanes of 31 bits
    more than any text has words.
    """
    width, words = {4: 15, 2: 31}[lanes], 64 // lanes
    sums = []
    for k in range(words):
        bits = None
        for lane in range(lanes):
            bit = F.shiftleft(F.shiftrightunsigned("h", k + words * lane).bitwiseAND(1), width * lane)
            bits = bit if bits is None else bits + bit
        sums.append(F.sum(bits * F.col("weight")).alias(f"s{k}"))
    sums = features.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)
    bit = [
        F.when(F.shiftrightunsigned(f"s{k}", width * lane).bitwiseAND((1 << width) - 1) * 2 > F.col("total"), F.shiftleft(F.lit(1).cast("long"), k + words * lane)).otherwise(F.lit(0).cast("long"))
        for k in range(words)
        for lane in range(lanes)
    ]
    while len(bit) > 1:
        bit = [bit[i].bitwiseOR(bit[i + 1]) for i in range(0, len(bit), 2)]
    return sums.select(*keys, bit[0].alias("fp"))


def bit_blocks(fp: str, radius: int) -> Column:
    """Values of radius + 1 consecutive bit blocks of a fingerprint."""
    if not 0 <= radius < 64:
        raise ValueError("radius must be between 0 and 63")
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.shiftrightunsigned(fp, a).bitwiseAND((1 << (b - a)) - 1 if b - a < 64 else -1) for a, b in zip(edges, edges[1:])])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    radius: int = RADIUS,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per text row and benchmark item found in it: (row, doc_id, item_id, start_word, n_words, similarity).

    The window is the most similar one, the first of equals.
    """
    texts = keyed(docs, id_col, text_col)
    items = narrow(benchmark, item_id=item_col, text=item_text_col).withColumn("w", words(F.col("text"))).withColumn("n", F.size("w")).where("n > 0")
    items = stored(items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "w", "n", F.least("n", F.lit(SHINGLE_WORDS)).alias("k")).dropDuplicates(["item"]), "items")
    longest_of = {r.k: r.n for r in items.groupBy("k").agg(F.max("n").alias("n")).collect()}  # at most SHINGLE_WORDS values
    sizes, lanes = sorted(longest_of), 4 if max(longest_of.values(), default=0) <= 32_767 else 2

    def by_size(df: DataFrame, make) -> DataFrame:
        parts = [make(df.where(F.col("k") == k), k) for k in sizes] or [make(df.where("false"), SHINGLE_WORDS)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    item_features = stored(
        by_size(items, lambda df, k: df.select("item", "n", "k", F.explode(shingles(F.col("w"), k)).alias("h"))).groupBy("item", "n", "k", "h").agg(F.count("*").alias("weight")),
        "item-shingles",
    )
    # A window that reaches the threshold lacks at most S / 7 of its item's S shingles, so it lacks at most as many
    # of the item's distinct words; of any m of them it has at least m - floor(S / 7).
    spare = F.floor((F.col("n") - F.col("k") + 1) * F.lit(100 - THRESHOLD_PERCENT) / F.lit(100 + THRESHOLD_PERCENT)).cast("int")
    longest = F.slice(F.sort_array(F.transform(F.array_distinct("w"), lambda w: F.struct(F.length(w).alias("l"), w.alias("w"))), asc=False), 1, spare + TELLING_WORDS)
    telling = items.select("item", spare.alias("spare"), longest.alias("x")).select("item", (F.size("x") - F.col("spare")).alias("need"), F.explode("x").alias("x"))
    telling = stored(telling.select("item", "need", F.xxhash64("x.w").alias("word")).distinct(), "telling-words")

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_limit else df

    each = texts.select("row", F.explode(F.split(F.lower("text"), SEPARATOR)).alias("word")).select("row", F.xxhash64("word").alias("word"))
    having = each.join(bounded(telling.select("word").distinct()), "word", "left_semi").distinct()
    likely = having.join(telling, "word").groupBy("row", "item", "need").agg(F.count("*").alias("m")).where("m >= need").select("row").distinct()
    likely = stored(likely, "texts-left")
    split = stored(texts.join(bounded(likely), "row", "left_semi").select("row", words(F.col("text")).alias("w")), "words-left")
    vocabulary = bounded(item_features.select("k", "h").distinct())

    def positions(k: int) -> DataFrame:
        own = split.select("row", F.lit(k).alias("k"), F.explode(shingles(F.col("w"), k)).alias("h"))
        return own.join(vocabulary.where(F.col("k") == k).select("h"), "h", "left_semi")

    hits = [positions(k) for k in sizes] or [positions(SHINGLE_WORDS)]
    found = hits[0]
    for part in hits[1:]:
        found = found.unionByName(part)
    counted = stored(found.groupBy("row", "k", "h").agg(F.count("*").alias("m")), "hits")
    covered = (
        counted.join(item_features, ["k", "h"])
        .groupBy("row", "item", "n", "k")
        .agg(F.sum(F.least("m", "weight")).alias("both"))
        .where(f"{100 + THRESHOLD_PERCENT} * both >= {2 * THRESHOLD_PERCENT} * (n - k + 1)")
    )
    covered = stored(covered.select("row", "item", "n", "k"), "covered")

    # The shingles of the texts left, with their places; windows that start where one of them can hold a hit.
    left = split.join(covered.select("row").distinct(), "row", "left_semi")
    wanted = covered.select("row", "n", "k").distinct()
    placed = by_size(
        left.join(wanted, "row"),
        lambda df, k: df.select("row", "n", "k", shingles(F.col("w"), k).alias("sh"), (F.size("w") - F.col("n")).alias("last")),
    )
    placed = stored(placed.where("last >= 0"), "placed")
    hit_places = (
        placed.select("row", "n", "k", "last", F.posexplode("sh").alias("p", "h"))
        .join(counted.select("row", "k", "h"), ["row", "k", "h"], "left_semi")
        .groupBy("row", "n", "k", "last")
        .agg(F.collect_set("p").alias("ps"))
    )
    # A start s sees hit p where s <= p <= s + n - k; enough hits must lie in the window.
    need = F.ceil(F.lit(2 * THRESHOLD_PERCENT) * (F.col("n") - F.col("k") + 1) / F.lit(100 + THRESHOLD_PERCENT)).cast("int")
    starts = (
        hit_places.withColumn("ps", F.array_sort("ps"))
        .withColumn("need", need)
        .select("row", "n", "k", "last", "need", "ps", F.posexplode("ps").alias("i", "p"))
        .where("i + need <= size(ps)")
        .withColumn("q", F.expr("ps[i + need - 1]"))
        .where("q - p <= n - k")
        .select("row", "n", "k", F.explode(F.expr("sequence(greatest(0, q - (n - k)), least(p, last))")).alias("s"))
        .distinct()
    )
    windows = (
        placed.select("row", "n", "k", "sh")
        .join(starts, ["row", "n", "k"])
        .select("row", "n", "k", "s", F.explode(F.expr("slice(sh, s + 1, n - k + 1)")).alias("h"))
        .groupBy("row", "n", "k", "s", "h")
        .agg(F.count("*").alias("weight"))
    )
    windows = stored(windows, "windows")
    key = ["row", "n", "k", "s"]
    prints = fingerprint(windows, *key, lanes=lanes).join(covered, ["row", "n", "k"])
    indexed = prints.select(*key, "item", "fp", F.posexplode(bit_blocks("fp", radius)).alias("block", "value"))
    item_prints = fingerprint(item_features, "item", lanes=lanes).select("item", F.col("fp").alias("item_fp"), F.posexplode(bit_blocks("fp", radius)).alias("block", "value"))
    candidates = (
        indexed.join(item_prints, ["item", "block", "value"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select(*key, "item")
        .distinct()
    )
    exact = (
        candidates.join(windows, key)
        .join(item_features.select("item", "k", "h", F.col("weight").alias("item_weight")), ["item", "k", "h"])
        .groupBy(*key, "item")
        .agg(F.sum(F.least("weight", "item_weight")).alias("both"))
        .where(f"{100 + THRESHOLD_PERCENT} * both >= {2 * THRESHOLD_PERCENT} * (n - k + 1)")
        .withColumn("similarity", F.col("both") / (2 * (F.col("n") - F.col("k") + 1) - F.col("both")))
    )
    best = exact.groupBy("row", "item").agg(F.max(F.struct("similarity", (-F.col("s")).alias("back"), "n")).alias("b"))
    return (
        best.join(items.select("item", "item_id"), "item")
        .join(texts.select("row", F.col("id").alias("doc_id")), "row")
        .select("row", "doc_id", "item_id", (-F.col("b.back")).cast("long").alias("start_word"), F.col("b.n").cast("long").alias("n_words"), F.col("b.similarity").alias("similarity"))
    )
