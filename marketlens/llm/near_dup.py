"""Near-duplicate documents: MinHash with tensored banding.

A document is its set of word shingles; documents with the same set are one node. Two small
collections of ``SIDE`` hash values, each made of ``ROWS`` minhashes, are computed for a node,
and every pair of a value of the one and a value of the other is a table key. This gives
``SIDE ** 2`` tables of ``2 * ROWS`` minhashes each from only ``2 * SIDE * ROWS`` minhashes. Two
sets of similarity s share no key with probability 1 - (1 - (1 - s**ROWS)**SIDE)**2, that is
about 1 in 10,000 at s = 0.8 and far less above.

A key can only be shared if both its values are, so keys are formed from values that occur
twice or more. In a bucket, members are compared with one hub, the same for as many buckets as
possible, first in the buckets of ``SIDE`` of the tables and then in all; linked members form
components, and only buckets that still hold several components go on, at last to all pairs across
components whose rarest shingles leave the similarity possible. Every comparison counts full
sets, so the links found are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.components import connected
from marketlens.llm.storage import Scratch
from marketlens.llm.text import SPACES, Texts, mixed, rows_of, slices, windows

WORDS = 5  # words of a shingle
MIN_PERCENT = 80
SIDE, ROWS = 14, 3
HUB_ROUNDS = 2  # the first in SIDE of the tables
CELLS = 1 << 20
_WORD = ~SPACES
_SEEDS = np.random.default_rng(99).integers(1, 1 << 63, (2, 2 * SIDE * ROWS), dtype=np.uint64) | np.uint64(1)
_KEEP = np.uint64(0xFFFFFFFFFFFF)  # sets are compared by 48 bits of a shingle's hash


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and the first of each text. A text of fewer
    words has one shingle, all its words."""
    texts = Texts(column, lower=True)
    starts, ends, firsts = texts.spans(_WORD)
    hashes = texts.hashes(starts, ends)
    found, at = windows(hashes, firsts, width)
    text = rows_of(firsts)[at]
    words = np.diff(firsts)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width - 1):
                has = words[short] > k
                whole[has] = mixed(whole[has] * np.uint64(31) + hashes[firsts[short[has]] + k])
        found, text = np.append(found, whole), np.append(text, short)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.append(0, np.cumsum(np.bincount(text[new], minlength=texts.n)))


def signatures(sets: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """2 * SIDE hash values of each set (0 for an empty one)."""
    n, full = len(firsts) - 1, np.diff(firsts) > 0
    out = np.zeros((2 * SIDE, n), np.uint64)
    if full.any():
        with np.errstate(over="ignore"):
            for k in range(2 * SIDE * ROWS):
                lowest = np.minimum.reduceat((sets ^ _SEEDS[0, k]) * _SEEDS[1, k], firsts[:-1][full])
                out[k // ROWS][full] = mixed(out[k // ROWS][full] * np.uint64(0x9E3779B97F4A7C15) + lowest)
    return out.T


def _described(docs: DataFrame, width: int) -> DataFrame:
    """(id, body, n_shingles, a, b, signature): set size, a 128-bit digest of the set, hash values."""
    schema = T.StructType([
        docs.schema["id"], docs.schema["body"], T.StructField("n_shingles", T.LongType()), T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()), T.StructField("signature", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, firsts = shingle_sets(batch.column("text"), width)
            with np.errstate(over="ignore"):
                sums = [np.append(np.uint64(0), np.cumsum(mixed(sets ^ salt))) for salt in (np.uint64(1), np.uint64(0xABCDEF))]
                digests = [(s[firsts[1:]] - s[firsts[:-1]]).view(np.int64) for s in sums]
            values = np.ascontiguousarray(signatures(sets, firsts)).view(np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(firsts)) * 2 * SIDE, pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("body"), pa.array(np.diff(firsts)), *map(pa.array, digests), listed], names=schema.names)

    return docs.select("id", "body", "text").mapInArrow(run, schema)


def _buckets(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, n, bucket, diagonal): table keys that two or more nodes have. ``diagonal`` marks the
    ``SIDE`` tables that pair the collections' values of one place."""
    values = nodes.select("node", "n", F.posexplode("signature").alias("at", "value"))
    shared = values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("at", "value")
    kept = values.join(shared, ["at", "value"])
    own = kept.groupBy("node", "n").agg(F.collect_list(F.struct("at", "value")).alias("v"))  # 2 * SIDE at most
    sides = own.select("node", "n", F.filter("v", lambda x: x["at"] < SIDE).alias("u"), F.filter("v", lambda x: x["at"] >= SIDE).alias("w"))
    pairs = sides.select("node", "n", F.explode("u").alias("u"), "w").select("node", "n", "u", F.explode("w").alias("w"))
    keys = scratch.save(pairs.select("node", "n", F.xxhash64("u.at", "u.value", "w.at", "w.value").alias("bucket"), (F.col("u.at") + SIDE == F.col("w.at")).alias("diagonal")), "keys")
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    found = scratch.save(keys.join(shared, "bucket").select("node", "n", "bucket", "diagonal"), "buckets")
    scratch.drop("keys")
    return found


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _to_hubs(members: DataFrame, salt: int, percent: int) -> DataFrame:
    """(x, y): each member of a bucket with the bucket's hub, if they are in different components."""
    place = F.struct(F.xxhash64(F.col("node"), F.lit(salt)).alias("order"), F.col("node").alias("x"), F.col("n").alias("nx"), F.col("label").alias("lx"))
    hubs = members.groupBy("bucket").agg(F.min(place).alias("hub"))
    pairs = members.join(hubs, "bucket").where((F.col("label") != F.col("hub.lx")) & _sizes_allow(F.col("n"), F.col("hub.nx"), percent))
    return pairs.select(F.least("node", "hub.x").alias("x"), F.greatest("node", "hub.x").alias("y")).distinct()


def _rare_first(rows: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, label, place): the rarest shingles of each set, as many as a similar set
    must share at least one of.

    Rarity is counted in ``CELLS`` cells, a table of fixed size; any order that all sets share
    is right, a good one only makes fewer pairs.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for items in batch.column("items"):
                cells += np.bincount((unpacked(items.as_buffer()) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        own = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({"cell": own, "c": cells[own]})

    sums = rows.select("items").mapInArrow(counted, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[sums.column("cell").to_numpy()] = sums.column("c").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, places = [], []
            for items in batch.column("items"):
                own = unpacked(items.as_buffer())
                order = np.lexsort((own, shared.value[(own % np.uint64(CELLS)).astype(np.int64)]))
                found.append(own[order[: len(own) - -(-percent * len(own) // 100) + 1]])
                places.append(np.arange(len(found[-1])))
            sizes = [len(x) for x in found]
            of = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), *(batch.column(c).take(of) for c in ("node", "n", "label")), pa.array(np.concatenate(places))],
                    names=["token", "node", "n", "label", "place"])

    return rows.mapInArrow(run, "token long, node long, n long, label long, place long")


def _across(members: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(x, y): pairs of members in different components that may still be similar.

    In a group of many near copies of one text, most pairs share keys but not enough shingles.
    Similar sets share one of their rarest shingles, early enough in both that the rest can
    still make up the overlap; in such a group the rarest shingles are each copy's own, so only
    pairs with a change in common are made.
    """
    rows = scratch.save(members.select("node", "n", "label").distinct().join(sets, "node"), "residual")
    rare = scratch.save(_rare_first(rows, percent), "rare")
    mixed_up = rare.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
    rare = rare.join(mixed_up, "token")
    left, right = (rare.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "label", "place"))) for side in "xy")
    most = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    fits = (F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y")) & (most * (100 + percent) >= percent * (F.col("n_x") + F.col("n_y")))
    return left.join(right, "token").where(fits).select(F.col("node_x").alias("x"), F.col("node_y").alias("y")).distinct()


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = pairs.join(sets.select(F.col("node").alias("y"), F.col("items").alias("ys")), "y")
    both = left.join(sets.select(F.col("node").alias("x"), F.col("items").alias("xs")), "x").select("x", "y", "xs", "ys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (xs, ys) in enumerate(zip(batch.column("xs"), batch.column("ys"), strict=True)):
                a, b = (unpacked(v.as_buffer()) for v in (xs, ys))
                common = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
                good[k] = 100 * common >= percent * (len(a) + len(b) - common)
            yield batch.select(["x", "y"]).filter(pa.array(good))

    return both.mapInArrow(run, "x long, y long")


def packed(items: np.ndarray) -> bytes:
    """48 bits of each hash."""
    return np.unique(items & _KEEP).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.pad(rows, ((0, 0), (0, 2))).view(np.uint64).ravel()


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, items): the sets of the wanted nodes, from the text of one document each."""
    named = nodes.join(wanted, "node", "left_semi").select("node", F.col("rep.id").alias("of_id"), F.col("rep.body").alias("of_body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, firsts = shingle_sets(batch.column("text"), width)
            items = [packed(sets[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(items, pa.binary())], names=["node", "items"])

    texts = docs.join(named, (F.col("id") == F.col("of_id")) & (F.col("body") == F.col("of_body"))).select("node", "text")
    return texts.mapInArrow(run, "node long, items binary").dropDuplicates(["node"])


def _labelled(own: DataFrame, scratch: Scratch, width: int, percent: int) -> DataFrame:
    """(id, body, n_shingles, first) of every row; ``first`` is the smallest (id, body) that links
    lead to, null if there can be no links."""
    known = scratch.save(_described(own, width), "described")
    linkable = F.col("id").isNotNull() & (F.col("n_shingles") > 0)
    grouped = known.where(linkable).groupBy("a", "b").agg(F.min(F.struct("id", "body", "n_shingles", "signature")).alias("rep"))
    nodes = scratch.save(grouped.select("a", "b", "rep", F.monotonically_increasing_id().alias("node")), "nodes")
    labels = scratch.save(_components(own, nodes, scratch, width, percent), "labels")
    ids = nodes.join(labels, "node", "left").select("a", "b", F.struct("rep.id", "rep.body").alias("rep"), F.coalesce("label", "node").alias("label"))
    found = ids.join(ids.groupBy("label").agg(F.min("rep").alias("first")), "label").select("a", "b", "first")
    rows = known.select("id", "body", "n_shingles", "a", "b").join(found, ["a", "b"], "left")
    return rows.select("id", "body", "n_shingles", F.when(linkable, F.col("first")).alias("first"))


def _own(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("body"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Rows are linked if their sets have a similarity of ``percent`` or more; ``component_id`` is
    the smallest key that links lead to, its own included, and ``kept`` marks the rows whose key
    that is. One row for each input row; rows with one key and several texts are linked only by
    their texts. A row without words, null text included, is linked with nothing; so is a row
    with a null key, which has no component and is kept. Other columns are not read.
    """
    rows = _labelled(_own(docs, key, text), Scratch(docs.sparkSession, "near-dup"), width, percent)
    component = F.coalesce("first.id", "id")
    return rows.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: one row of each component stays.

    It is the one with the smallest key, null keys being the largest; of texts that share the key,
    the one with the smallest hash, and of rows with the same key and text any one. Rows that are
    linked with nothing stay; rows without words are linked only with rows of the same key and
    text.
    """
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"))
    own = docs.select(place.alias("id"), F.xxhash64(text).alias("body"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _labelled(own, Scratch(docs.sparkSession, "near-dup"), width, percent)
    stays = F.col("first").isNull() | ((F.col("first.id") == F.col("id")) & (F.col("first.body") == F.col("body")))
    kept = rows.where(stays).select(F.col("id.key").alias("__id"), F.col("body").alias("__body")).distinct()
    found = docs.withColumn("__hash", F.xxhash64(F.col(text))).join(kept, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__body")), "left_semi")
    return found.dropDuplicates([key, "__hash"]).drop("__hash")


def _joined_up(labels: DataFrame, links: DataFrame, scratch: Scratch, step: int) -> DataFrame:
    """Labels after new links, which are links between the components that were."""
    for side in "xy":
        of = labels.select(F.col("node").alias(side), F.col("label").alias("of"))
        links = links.join(of, side, "left").withColumn(side, F.coalesce("of", side)).drop("of")
    joined = connected(links, scratch, f"star{step}-").select(F.col("node").alias("label"), F.col("label").alias("low"))
    old = labels.join(joined, "label", "left").select("node", F.coalesce("low", "label").alias("label"))
    new = joined.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(F.col("label").alias("node"), F.col("low").alias("label"))
    return scratch.save(old.unionByName(new), f"labels{step}")


def _components(docs: DataFrame, nodes: DataFrame, scratch: Scratch, width: int, percent: int) -> DataFrame:
    """(node, label) of the linked nodes."""
    buckets = _buckets(nodes.select("node", F.col("rep.n_shingles").alias("n"), F.col("rep.signature").alias("signature")), scratch)
    sets = scratch.save(_sets(docs, nodes, buckets.select("node").distinct(), width), "sets")
    labels = nodes.select("node", F.col("node").alias("label")).limit(0)
    tested: list[DataFrame] = []
    for step in range(HUB_ROUNDS + 1):
        own = buckets if step else buckets.where("diagonal")
        members = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed_up = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        members = members.join(mixed_up.select("bucket"), "bucket", "left_semi")
        pairs = _to_hubs(members, step, percent) if step < HUB_ROUNDS else _across(members, sets, scratch, percent)
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["x", "y"], "left_anti")
        tested.append(scratch.save(pairs, f"pairs{step}"))
        links = scratch.save(_similar(tested[-1], sets, percent), f"links{step}")
        labels = _joined_up(labels, links, scratch, step) if step else connected(links, scratch, "star0-")
    scratch.drop("buckets", "sets", "residual", "rare", *(f"pairs{k}" for k in range(HUB_ROUNDS + 1)))
    return labels
