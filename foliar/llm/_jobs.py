"""Helpers around Spark tables: settings, stored intermediate tables, text columns, grouping of links."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.session import configure, discard, materialize

__all__ = ["among", "configure", "discard", "groups", "keyed", "labelled_sample", "link_buckets", "narrow", "odd_ids", "read", "share", "stored"]

stored = materialize
# The keys of all nodes are dealt out in so many turns.
KEY_TURNS = 4


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    configure(spark)
    # A stored table needs none of the shuffles it was made with.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def narrow(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; whatever else the table has cannot clash."""
    return docs.select(*[F.col(f"`{name}`").alias(own) for own, name in columns.items()])


def _forest(batches):
    """Union-find over the links of one task: every node once, with the smallest node it is linked to."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                low, high = (a, b) if a < b else (b, a)
                parent[high] = low
                parent.setdefault(low, low)
        if len(parent) > 500_000:
            # The table of one task stays bounded: links found so far go on as they are.
            yield _rows([(x, find(x)) for x in parent if find(x) != x], schema)
            parent = {}
    if parent:
        yield _rows([(x, find(x)) for x in parent if find(x) != x], schema)


def _rows(pairs, schema):
    columns = [pa.array([p[i] for p in pairs], type=schema.types[i]) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def groups(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected groups of links (a, b): one row (node, root) per node that has a link, root the smallest node.

    Every task joins its own links by union-find and passes on one link per
    node; the rest is joined by alternating star rounds over the whole table,
    each one a grouped minimum and an equi-join, until nothing changes. The
    number of rounds grows with the logarithm of the group size. Each round is
    written to the shared folder.
    """
    names = links.columns
    kind = links.schema[names[0]].dataType.simpleString()
    edges = links.select(F.col(names[0]).alias("a"), F.col(names[1]).alias("b")).where("a <> b").mapInArrow(_forest, f"a {kind}, b {kind}")
    edges = stored(edges.where("b < a").distinct(), "links")
    for _ in range(max_rounds):
        # Is every node below exactly one root, and no root below another node?
        roots = edges.groupBy("a").agg(F.count("*").alias("n"))
        tangled = roots.where("n > 1").select("a").unionByName(edges.select(F.col("b").alias("a")).distinct().join(roots.select("a"), "a", "left_semi"))
        if tangled.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    else:
        raise RuntimeError("groups did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _members(facts: DataFrame, spot: list[str]) -> list[DataFrame]:
    """Stored tables (key, node, head) of the keys that several nodes share, with the spot if there is one; ``head`` is one node of the key.

    Most keys are some node's alone. The keys are dealt out in turns, and the
    shuffle of a turn goes once its shared keys are written.
    """
    each = facts.select(F.explode(F.array_distinct("keys")).alias("key"), "node")
    if spot:
        each = each.select("key.key", "node", "key.spot")
    turns = []
    for turn in range(KEY_TURNS):
        dealt = each.where(F.pmod(F.xxhash64("key"), F.lit(KEY_TURNS)) == turn).repartition("key")
        # Hashed order: one node is the head of all its keys, whichever keys it shares.
        ends = [F.min("node").alias("low"), F.max("node").alias("high"), F.min_by("node", F.xxhash64("node")).alias("head")]
        # All columns are asked for, so both sides of the join read one shuffle.
        shared = dealt.groupBy("key").agg(*ends, *[F.count(c).alias("n") for c in spot]).where(" and ".join(["low < high", *["n > 0" for _ in spot]])).select("key", "head")
        turns.append(stored(dealt.join(shared.hint("shuffle_hash"), "key"), "members"))
    return turns


def link_buckets(facts: DataFrame, alike: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame], near: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Groups of the nodes of ``facts`` (node, keys, sketch), where ``verify`` keeps the pairs (a, b) that are true links.

    Every two nodes that share a key and whose sketches are ``alike`` are either
    verified or already in one group, and no group is multiplied out: first each
    node is compared with one head per key only, which joins copies and near
    copies; then pairs are made only between nodes of one key that are still in
    different groups, each pair under one of the keys they share. ``alike`` is part
    of both joins, so pairs it refuses are never rows. With ``near`` the keys are
    (key, spot), and a pair is made under each shared key whose spots, put beside
    the sketches, are near. Returns (node, root) for nodes with links. Stored
    tables go once the next one is written, ``facts`` too if it is one.
    """
    spot = ["spot"] if near is not None else []
    turns = _members(facts, spot)
    members = reduce(DataFrame.unionByName, turns)
    sketches = stored(facts.select("node", "sketch"), "sketches")
    discard(facts)
    sketched = sketches.select(F.col("node").alias("head"), F.col("sketch").alias("head_sketch"))
    stars = members.where("node <> head").select("node", "head").distinct()
    stars = stars.join(sketches, "node").join(sketched, "head").where(alike(F.col("sketch"), F.col("head_sketch")))
    links = stored(verify(stars.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))).select("a", "b"), "star-links")
    grouped = members.join(groups(links), "node", "left").select("key", "node", *spot, F.coalesce("root", "node").alias("root"))
    grouped = stored(grouped, "grouped")
    discard(*turns)
    # The largest group of a key needs no comparing within: of two nodes of different groups one is outside it.
    sizes = grouped.groupBy("key", "root").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1").select("key", "main")
    opened = stored(grouped.join(mains, "key"), "open")
    discard(grouped)
    if near is None:
        own = opened.groupBy("node").agg(F.collect_list("key").alias("own")).join(sketches, "node")
        left = stored(opened.join(own, "node"), "open-sketches")
    else:
        left = stored(opened.join(sketches, "node").withColumn("sketch", F.col("sketch").withField("spot", F.col("spot"))), "open-sketches")
    discard(opened, sketches)
    minor = left.where("root <> main").drop("main")
    other = left.select(*[F.col(c).alias(f"{c}2") for c in left.columns])
    apart = (F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("main2")) | (F.col("root") < F.col("root2")))
    # Without spots a pair is made once, under the lowest key the two nodes share.
    sure = near(F.col("sketch"), F.col("sketch2")) if near is not None else F.lit(True)
    once = F.array_min(F.array_intersect("own", "own2")) == F.col("key") if near is None else F.lit(True)
    pairs = minor.join(other, (F.col("key") == F.col("key2")) & apart & sure & alike(F.col("sketch"), F.col("sketch2")) & once)
    pairs = pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))
    pairs = pairs if near is None else pairs.distinct()
    found = stored(verify(pairs).select("a", "b"), "links-between")
    discard(left)
    return groups(links.unionByName(found))


def among(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is in ``wanted``, of which most others are left out before anything is shuffled.

    The sieve is a bitmap of hashes of at most 512 kB, whatever the tables; the join after it is exact.
    """
    place = F.pmod(F.xxhash64(column), F.lit(1 << 22))
    bits = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position(place)
    placed = rows.select(F.struct(*rows.columns).alias("row_"), F.bitmap_bucket_number(place).alias("bucket"), at.alias("at"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = placed.join(F.broadcast(bits), "bucket").where(F.call_function("getbit", byte, (F.col("at") % 8).cast("int")) == 1)
    return found.select("row_.*").join(wanted, column, "left_semi")


def odd_ids(texts: DataFrame) -> bool:
    """Does an id repeat, or a row lack one?"""
    return not texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty()


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text) with one ``row`` key per row of the table.

    The key is the id where ids are unique and present; otherwise the rows are
    stored once with a number each, so rows that repeat an id stay apart.
    """
    texts = narrow(docs, id=id_col, text=text_col)
    if not odd_ids(texts):
        return texts.select(F.col("id").alias("row"), "id", "text")
    return stored(texts.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "numbered")


def share(rows: Column | str, total: int, wanted: int) -> Column:
    """Is a row in a sample of at most ``wanted`` of ``total`` rows, chosen by the hash of ``rows``?

    The share lies four deviations below the bound, so more rows come with a
    chance of 3e-5. No rows are sorted or brought together for it.
    """
    if total <= wanted:
        return F.lit(True)
    part = max(wanted - 4 * wanted**0.5, wanted / 2) / total
    return F.pmod(F.xxhash64(rows), F.lit(1 << 31)) < int(part * (1 << 31))


def labelled_sample(rows: DataFrame, labels: DataFrame, wanted: int) -> DataFrame:
    """Rows (id, ...) joined with the labels (id, ...; one row per id) of at most ``wanted`` ids that have rows.

    Of an id with several rows the least row is taken, so the bound is on rows
    too. Ids are chosen on narrow tables; texts are only read, and one per chosen
    id is shuffled.
    """
    known = stored(labels.join(rows.select("id").distinct(), "id", "left_semi"), "labelled-ids")
    chosen = known.where(share("id", known.count(), wanted))
    joined = rows.join(F.broadcast(chosen), "id")  # at most ``wanted`` ids
    rest = [c for c in joined.columns if c != "id"]
    return joined.groupBy("id").agg(F.min(F.struct(*rest)).alias("least")).select("id", "least.*")
