"""Near-duplicate documents by circulant MinHash.

Shingles are five consecutive words, lower-cased in A-Z. One permutation of the
numbers below 2^32 renumbers them, a second one, shifted circularly by k, gives
coordinate k of a signature: ``min(second(first(x) - k))`` over the set. Bands of five
coordinates meet documents; there are as many as it takes that a pair at the wanted
similarity s shares none with probability ``(1 - s^5)^bands < 1e-6`` (24 at 0.85, 35 at
0.80). Every candidate is confirmed on the full sets.

Documents with equal sets are one class from the start, so copies cost one row each.
The members of all buckets that have the same busiest member (their hub) make a group.
Each is compared with the hub once, in blocks of GROUP_BYTES. Those not linked with it,
and no others, meet all members, a block of the ones and a block of the others in each
task. A task sends on at most one link for each member.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.tables import text_key, written
from spoor.llm.words import Words, mix, pieces_of, portions, runs_hash

WORDS = 5
ROWS = 5
PERCENT = 85
"""The least similarity of near duplicates, unless a caller asks for another."""
GROUP_BYTES = 16 << 20


@functools.cache
def bands_for(percent: int) -> int:
    """The fewest bands that pairs at this similarity miss with probability below 1e-6."""
    if not 0 < percent <= 100:
        raise ValueError(f"no similarity in percent: {percent}")
    missed = 1 - (percent / 100) ** ROWS
    return math.ceil(math.log(1e-6) / math.log(missed)) if missed else 1


@functools.cache
def sure_for(percent: int) -> int:
    """Pairs whose signatures agree in fewer coordinates are not compared: at this
    similarity that happens with probability below 1e-8."""
    n, share = bands_for(percent) * ROWS, percent / 100
    total, least = 0.0, 0
    while least < n:
        total += math.comb(n, least) * share**least * (1 - share) ** (n - least)
        if total >= 1e-8:
            break
        least += 1
    return least


def _spread(x: np.ndarray) -> np.ndarray:
    """A permutation of the numbers below 2^32; changes ``x``."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. A text of fewer than WORDS
    words has its whole sequence as one shingle, one without words none."""
    words = Words(texts, lower=True)
    single = words.hashes()
    runs = runs_hash(single, WORDS)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= WORDS:
            sets.append(np.unique(runs[a : b - WORDS + 1]))
        elif b > a:
            sets.append(runs_hash(single[a:b], int(b - a)) ^ np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], bands: int) -> np.ndarray:
    """Circulant signatures, one row of bands * ROWS numbers for each set (not empty)."""
    result = np.empty((len(sets), bands * ROWS), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (not total or total + len(sets[last]) <= 1 << 16):
            total += len(sets[last])
            last += 1
        start = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        renumbered = _spread((np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32))
        for k in range(bands * ROWS):
            result[first:last, k] = np.minimum.reduceat(_spread(renumbered - np.uint32(k)), start)
        first = last
    return result


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    bands = signature.shape[1] // ROWS
    parts = signature.reshape(len(signature), bands, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for j in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return total.view(np.int64)


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("node", pa.binary()),
     ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64()))]
)


def _sign(n_bands: int):
    """(doc_id, text_key, text) -> _SIGNED"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2):
            ids, keys = batch.column(0), batch.column(1)
            texts = (t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist())
            for first, piece in pieces_of(texts):
                sets = shingle_sets(piece)
                full = [k for k, s in enumerate(sets) if len(s)]
                bands = dict(zip(full, _bands(signatures([sets[k] for k in full], n_bands)).tolist())) if full else {}
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(piece)),
                        keys.slice(first, len(piece)),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([bands.get(k) for k in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    schema=_SIGNED,
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 0):
        texts = (t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist())
        for _, piece in pieces_of(texts):
            sets = [s for s in shingle_sets(piece) if len(s)]
            yield pa.RecordBatch.from_pydict(
                {"node": [_digest(s) for s in sets], "shingles": [s.tobytes() for s in sets]},
                schema=pa.schema([("node", pa.binary()), ("shingles", pa.binary())]),
            )


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, on sorted distinct numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def links_between(
    nodes: list, sets: list[np.ndarray], asks: list[bool], met: list[bool], percent: int = PERCENT
) -> list[tuple]:
    """Links that connect whatever is connected by the members that ask, fewer than nodes.

    asks: members that are compared with all others here; those with ``met`` are connected
    to each other already, by their hub.
    """
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    one = [x for x in range(len(nodes)) if met[x]]
    for x in one[1:]:
        parent[x] = one[0]
    found = []
    signed, sure = signatures(sets, bands_for(percent)), sure_for(percent)
    size = np.array([len(s) for s in sets])
    for x in (x for x in range(len(nodes)) if asks[x]):
        small, large = np.minimum(size, size[x]), np.maximum(size, size[x])
        near = np.flatnonzero(100 * small >= percent * large)
        alike = (signed[near] == signed[x]).sum(axis=1)
        for y in near[np.argsort(-alike, kind="stable")][: int((alike >= sure).sum())].tolist():
            if root(x) != root(y) and linked(sets[x], sets[y], percent):
                parent[root(x)] = root(y)
                found.append((nodes[x], nodes[y]))
    return found


def _meet_hub(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        hub = bytes(group["hub"].iloc[0])
        nodes = [bytes(n) for n in group["node"]]
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        own = sets[nodes.index(hub)]
        rows = [(hub, n, linked(s, own, percent)) for n, s in zip(nodes, sets) if n != hub]
        return pd.DataFrame(rows, columns=["hub", "node", "met"])

    return run


def _meet_all(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # A member that asks may be among those asked as well: once is enough.
        group = group.assign(node=[bytes(n) for n in group["node"]])
        group = group.sort_values("asks", ascending=False, kind="stable").drop_duplicates("node")
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        links = links_between(group["node"].tolist(), sets, group["asks"].tolist(), group["met"].tolist(), percent)
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _every(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def _blocks(sized: DataFrame, name: str) -> DataFrame:
    """(hub, name): as many blocks as the members' bytes need."""
    return sized.groupBy("hub").agg(F.ceil(F.sum("size") / GROUP_BYTES).cast("int").alias(name))


def _with_blocks(rows: DataFrame, blocks: DataFrame, name: str, place: str) -> DataFrame:
    """rows with their hub's number of blocks, and the block ``place`` of their node.

    Only hubs of two blocks or more are joined: they are few, so that no hub's rows need
    meet in one task.
    """
    many = written(blocks.filter(F.col(name) > 1))
    counted = rows.join(many, "hub", "left").withColumn(name, F.coalesce(name, F.lit(1)))
    return counted.withColumn(place, F.pmod(F.xxhash64("node"), F.col(name)).cast("int"))


def _hub_tasks(sized: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, block, node, shingles): each member in one block, the hub in all of them."""
    placed = _with_blocks(sized, _blocks(sized, "blocks"), "blocks", "block")
    is_hub = F.col("node") == F.col("hub")
    tasks = (
        placed.filter(~is_hub).select("hub", "block", "node")
        .unionByName(placed.filter(is_hub).select("hub", _every("blocks").alias("block"), "node"))
    )
    return tasks.join(sets, "node")


def _rest_tasks(met: DataFrame, sized: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, one, other, node, asks, met, shingles): the members that their hub did not
    meet in blocks ``one``, all members in blocks ``other``; every two blocks are a task."""
    members = _with_blocks(met.join(sized, ["hub", "node"]), _blocks(sized, "others"), "others", "other")
    apart = members.filter("NOT met")
    ones = _blocks(apart, "ones")
    asking = _with_blocks(apart.drop("other"), ones, "ones", "one").select(
        "hub", "one", _every("others").alias("other"), "node", F.lit(True).alias("asks"), "met"
    )
    # Hubs whose members ask, once for each block of theirs.
    asked_of = apart.groupBy("hub").agg(F.max("others").alias("others")).join(ones, "hub")
    asked = members.drop("others").join(
        asked_of.select("hub", "ones", _every("others").alias("other")), ["hub", "other"]
    )
    return asking.unionByName(
        asked.select("hub", _every("ones").alias("one"), "other", "node", F.lit(False).alias("asks"), "met")
    ).join(sets, "node")


def _links(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect whatever is connected within each hub's group."""
    sized = written(star.join(sets.select("node", F.length("shingles").cast("long").alias("size")), "node"))
    met = written(
        _hub_tasks(sized, sets)
        .groupBy("hub", "block")
        .applyInPandas(_meet_hub(percent), "hub binary, node binary, met boolean")
    )
    rest = (
        _rest_tasks(met, sized, sets)
        .groupBy("hub", "one", "other")
        .applyInPandas(_meet_all(percent), "a binary, b binary")
    )
    return met.filter("met").select(F.col("hub").alias("a"), F.col("node").alias("b")).unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of links (a, b): the smallest node reachable.

    Alternates two steps, each of which hangs neighbours below the smallest node they
    can see, until nothing changes; the rounds grow with the logarithm of the nodes.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct())
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u AND v <> m").select("v", "m").toDF("u", "v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(below, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", "e.m")
            .filter("u <> m")
            .distinct()
            .toDF("a", "b")
        )
        after = written(small)
        settled = after.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if settled == edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first():
            return after.groupBy("a").agg(F.min("b").alias("b")).toDF("node", "component")
        edges = after


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """near_duplicates() with the component's smallest node, null without words."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    signed = written(
        source.mapInArrow(
            _sign(bands_for(percent)), "doc_id long, text_key long, node binary, n_shingles long, keys array<long>"
        )
    )
    classes = written(
        signed.filter("node IS NOT NULL")
        .groupBy("node")
        # One real row, of the least doc_id: texts that differ in case or white space
        # share a node, and their least doc_id and text_key may be of different rows.
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"),
            F.first("keys").alias("keys"),
        )
        .select("node", "least.doc_id", "least.text_key", "keys")
    )
    members = classes.select("node", F.explode("keys").alias("key"))
    met = written(members.join(members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"))
    busy = met.groupBy("node").agg(F.sum(F.col("n") - 1).alias("busy"))
    ranked = met.join(busy, "node").select("key", F.struct("busy", "node").alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max("rank")["node"].alias("hub"))
    star = written(ranked.join(hubs, "key").select("hub", F.col("rank.node").alias("node")).distinct())
    wanted = classes.join(star.select("node").distinct(), "node", "left_semi").select("doc_id", "text_key")
    texts = source.join(
        wanted,
        source.doc_id.eqNullSafe(wanted.doc_id) & (source.text_key == wanted.text_key),
        "left_semi",
    ).select("text")
    sets = written(texts.mapInArrow(_sets, "node binary, shingles binary").dropDuplicates(["node"]))
    labels = components(_links(star, sets, percent))
    lowest = (
        labels.join(classes.select("node", "doc_id"), "node")
        .unionByName(
            labels.select("component").distinct().withColumn("node", F.col("component"))
            .join(classes.select("node", "doc_id"), "node")
        )
        .groupBy("component")
        .agg(F.min("doc_id").alias("lowest"))
    )
    named = (
        classes.select("node", F.col("doc_id").alias("own"))
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(lowest, "component", "left")
        .select("node", "component", F.coalesce("lowest", "own").alias("component_id"))
    )
    return (
        signed.drop("keys")
        .join(named, "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select(
            "doc_id", "text_key", "n_shingles", "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "component",
        )
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for each row of docs.

    percent: texts are linked at this similarity of their shingle sets or more.
    docs: doc_id, text, and any other columns, which are ignored. A null or empty text
    and one without words has no shingles and is linked with nothing. Rows may repeat:
    equal texts are linked, whatever their doc_id. component_id is null only where all
    doc_id of a component are null; kept is true where doc_id equals it. An empty table
    gives an empty one.
    """
    return grouped(docs, percent).drop("component")


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: one of each component, and all rows without words.

    Where several rows have the component's doc_id, the one with the least text_key
    stays, and one only of equal rows. All columns of docs are kept as they are.
    """
    found = grouped(docs, percent)
    lone = found.filter("n_shingles = 0").select("doc_id", "text_key").distinct()
    first = (
        found.filter("n_shingles > 0 AND kept")
        .groupBy("component")
        .agg(F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"))
    )
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("k_id"), text_key().alias("k_text"))

    def of(kept: DataFrame) -> DataFrame:
        return keyed.join(
            kept, keyed.k_id.eqNullSafe(kept.doc_id) & (keyed.k_text == kept.text_key), "left_semi"
        )

    return of(first).dropDuplicates(["k_id", "k_text"]).select("row.*").unionByName(of(lone).select("row.*"))
