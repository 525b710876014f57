"""Mixing sources to target weights over output shards, by a splitting tree.

Documents of a source fall into blocks by hash. Each source draws whole passes over its
blocks, then permuted blocks until its target is met; the last document of the last
block is taken in part, so the words taken meet the target exactly. A tree deals the
drawn blocks to the shards: each node halves its number of blocks, and how many of each
source go left follows the multivariate hypergeometric law, as if blocks were dealt from
a shuffled deck. A shard then takes the next blocks of each source's permutation, no
block twice, and orders its documents by hash.

DataFrame operations only. The tree handles one number for each source at a node, and
each source's blocks are a few rows for thousands of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.llm.tables import text_key, word_count, written

WEIGHTS = (5, 2, 1)
MOST = 3
"""A source gives at most so many times its words."""
BLOCK_DOCS = 4096
SHARDS = 16
SEED = 20240501


def _hash(*parts) -> Column:
    return F.xxhash64(*[F.lit(p) if isinstance(p, (int, str)) else p for p in parts])


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds weight and target to sources (source, size, ...): shares of the whole by
    weight, none above MOST times its size, the excess dealt to the others by weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn("number", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(turn, (F.col("number") % len(weights) + 1).cast("int")).cast("long")
    )
    # In order of what fills first, a source is full if its share of what is left exceeds it.
    fill = Window.orderBy(F.col("size") * MOST / F.col("weight"), "number")
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("size").over(whole) - F.coalesce(F.sum(F.col("size") * MOST).over(before), F.lit(0))
    full = (F.col("size") * MOST).cast("decimal(38,0)") * F.sum("weight").over(after).cast(
        "decimal(18,0)"
    ) <= F.col("weight").cast("decimal(18,0)") * left.cast("decimal(38,0)")
    marked = ranked.withColumn("full", full)
    rest = F.sum("size").over(whole) - F.sum(F.when(F.col("full"), F.col("size") * MOST).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    return marked.withColumn(
        "target",
        F.when(F.col("full"), (F.col("size") * MOST).cast("double")).otherwise(
            (F.col("weight") * rest).cast("double") / open_weight
        ),
    ).drop("full")


def _hypergeometric(total: str, good: str, drawn: str, u: str) -> str:
    """SQL for how many of ``good`` among ``total`` are in a draw of ``drawn``, by
    inversion at ``u``: from the mode upwards, then downwards."""
    step_up = "(v.c - x + 1.0D) * (v.k - x + 1.0D) / (x * (v.n - v.c - v.k + x + 0.0D))"
    step_down = "x * (v.n - v.c - v.k + x + 0.0D) / ((v.c - x + 1.0D) * (v.k - x + 1.0D))"
    ups = "if(v.m < v.hi, sequence(v.m + 1L, v.hi), cast(array() AS array<bigint>))"
    downs = "if(v.m > v.lo, sequence(v.m, v.lo + 1L, -1L), cast(array() AS array<bigint>))"

    def total_of(steps: str, step: str) -> str:
        return (
            f"aggregate({steps}, named_struct('w', 1.0D, 's', 0.0D),"
            f" (a, x) -> named_struct('w', a.w * {step}, 's', a.s + a.w * {step})).s"
        )

    def search(steps: str, step: str, start: str, at: str) -> str:
        return (
            f"aggregate({steps}, {start}, (a, x) -> named_struct('w', a.w * {step}, 's', a.s + a.w * {step},"
            f" 'p', if(a.p IS NULL AND a.s + a.w * {step} >= t, {at}, a.p)))"
        )

    first = "named_struct('w', 1.0D, 's', 1.0D, 'p', if(1.0D >= t, v.m, cast(NULL AS bigint)))"
    up = search(ups, step_up, first, "x")
    down = search(downs, step_down, "named_struct('w', 1.0D, 's', r.s, 'p', r.p)", "x - 1L")
    found = f"transform(array({up}), r -> coalesce({down}.p, v.m))[0]"
    mass = f"1.0D + {total_of(ups, step_up)} + {total_of(downs, step_down)}"
    bounds = (
        f"named_struct('n', {total}, 'c', {good}, 'k', {drawn}, 'u', {u},"
        f" 'lo', greatest(0L, {drawn} - ({total} - {good})), 'hi', least({good}, {drawn}),"
        f" 'm', cast(floor(({drawn} + 1.0D) * ({good} + 1.0D) / ({total} + 2.0D)) AS bigint))"
    )
    clipped = "named_struct('n', b.n, 'c', b.c, 'k', b.k, 'u', b.u, 'lo', b.lo, 'hi', b.hi, 'm', least(greatest(b.m, b.lo), b.hi))"
    return (
        f"transform(transform(array({bounds}), b -> {clipped}),"
        f" v -> transform(array(v.u * ({mass})), t -> {found})[0])[0]"
    )


def split(nodes: DataFrame, seed: int = SEED) -> DataFrame:
    """The children of nodes (node, counts): the left one gets half of all blocks,
    rounded down, and of each source what a draw without replacement would."""
    u = f"(pmod(xxhash64({seed}, node, i), 9007199254740992L) + 0.5D) / 9007199254740992.0D"
    drawn = _hypergeometric("acc.n", "counts[i]", "acc.k", u)
    total = "aggregate(counts, 0L, (a, c) -> a + c)"
    left = (
        f"aggregate(sequence(0, size(counts) - 1),"
        f" named_struct('n', {total}, 'k', {total} div 2L, 'left', cast(array() AS array<bigint>)),"
        f" (acc, i) -> transform(array({drawn}), d -> named_struct('n', acc.n - counts[i], 'k', acc.k - d,"
        f" 'left', concat(acc.left, array(d))))[0]).left"
    )
    halves = nodes.withColumn("left", F.expr(left))
    return halves.select(
        F.expr(
            "inline(array(named_struct('node', node * 2L, 'counts', left),"
            " named_struct('node', node * 2L + 1L, 'counts', zip_with(counts, left, (c, l) -> c - l))))"
        )
    )


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(number, shard, blocks) for quotas (number, blocks) of sources 0, 1, ...; shards
    is a power of two."""
    nodes = quotas.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("number", "blocks"))), lambda x: x["blocks"]).alias("counts")
    ).select(F.lit(1).cast("long").alias("node"), "counts").filter(F.size("counts") > 0)
    for _ in range(shards.bit_length() - 1):
        nodes = split(nodes, seed)
    return nodes.select((F.col("node") - shards).cast("int").alias("shard"), F.posexplode("counts").alias("number", "blocks"))


def draw_blocks(sized: DataFrame, weights: tuple[int, ...], shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(sources, draws) of sized (source, size, place): draws has a row for each block of
    a source, with its draws (epoch, shard, rest); rest is null for a whole block."""
    sources = targets(
        sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")), weights
    ).withColumnsRenamed({"source": "s_source", "size": "source_size"})
    sources = written(
        sources.withColumn("n_blocks", F.ceil(F.col("docs") / BLOCK_DOCS))
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    )
    blocks = in_blocks(sized, sources, seed).groupBy("number", "block").agg(
        F.sum("size").alias("size"), F.first("passes").alias("passes"), F.first("rest").alias("rest")
    )
    epochs = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    permuted = Window.partitionBy("number", "epoch").orderBy(_hash(seed, F.col("epoch"), F.col("number"), F.col("block")), "block")
    draws = (
        epochs.withColumn("before", F.sum("size").over(permuted) - F.col("size"))
        .withColumn("last", F.col("epoch") == F.col("passes"))
        .filter(~F.col("last") | (F.col("before") < F.col("rest")))
        .withColumn("rest", F.when(F.col("last") & (F.col("before") + F.col("size") > F.col("rest")), F.col("rest") - F.col("before")))
        .withColumn("turn", F.row_number().over(Window.partitionBy("number").orderBy("epoch", "before", _hash(seed, F.col("epoch"), F.col("number"), F.col("block")), "block")) - 1)
    )
    draws = written(draws.select("number", "block", "epoch", "rest", "turn"))
    quotas = sources.select("number").join(
        draws.groupBy("number").agg(F.count("*").alias("blocks")), "number", "left"
    ).select("number", F.coalesce("blocks", F.lit(0)).alias("blocks"))
    dealt = shard_quotas(quotas, shards, seed).filter("blocks > 0")
    upto = F.sum("blocks").over(Window.partitionBy("number").orderBy("shard"))
    turns = dealt.withColumn("upto", upto).select(
        "number", "shard", F.explode(F.sequence(F.col("upto") - F.col("blocks"), F.col("upto") - 1)).alias("turn")
    )
    return sources, (
        draws.join(turns, ["number", "turn"])
        .groupBy("number", "block")
        .agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "rest"))).alias("draws"))
    )


def in_blocks(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """sized with its source's columns and its block in the source."""
    return sized.join(sources, F.col("source").eqNullSafe(F.col("s_source"))).withColumn(
        "block", F.pmod(F.shiftright(F.col("place"), 11), F.col("n_blocks"))
    )


def place(seed: int) -> Column:
    """Where a document stands in its source's order."""
    return _hash(seed, F.col("doc_id"), text_key())


def mixed(docs: DataFrame, weights=WEIGHTS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """docs with the columns source_size, target, draws (epoch, shard, rest), size and
    taken: the words that all draws take, in rows of (row, ...), where ``row`` has the
    columns of docs as they are.

    docs: doc_id, text, source, and any others. A null source is a source of its own, the
    last one; a null, empty or blank text has size 0 and takes nothing. Equal rows share a
    place and come out in any order among themselves. An empty table gives an empty one.
    """
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs["source"].alias("source"),
        word_count(docs["text"]).alias("size"),
        _hash(seed, docs["doc_id"], text_key()).alias("place"),
    )
    sized = written(keyed.select("source", "size", "place"))
    sources, draws = draw_blocks(sized, weights, shards, seed)
    whole = in_blocks(keyed, sources.drop("rest", "passes", "words", "docs", "weight"), seed).join(
        draws, ["number", "block"], "left"
    )
    part = F.expr("get(filter(draws, d -> d.rest IS NOT NULL), 0).rest")
    marked = whole.withColumn("part", part)
    in_part = Window.partitionBy("number", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        marked.filter("part IS NOT NULL")
        .withColumn("before", F.coalesce(F.sum("size").over(in_part), F.lit(0)))
        .withColumn("part", F.least("size", F.greatest(F.lit(0), F.col("part") - F.col("before"))))
        .drop("before")
    )
    both = marked.filter("part IS NULL").unionByName(cut)
    passes = F.coalesce(F.expr("size(filter(draws, d -> d.rest IS NULL))"), F.lit(0))
    return both.withColumn(
        "taken", F.when(F.col("draws").isNull(), 0).otherwise(F.col("size") * passes) + F.coalesce("part", F.lit(0))
    ).select("row", "source_size", "target", "draws", "size", F.coalesce("part", F.lit(0)).alias("part"), "taken", "place")


def mixture(docs: DataFrame, weights=WEIGHTS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: docs' columns, one row for each time a document is taken, dealt to
    ``shards`` partitions and shuffled in each. Of the document that is taken in part,
    the leading words stay, joined by one space; n_chars, where docs have it, is counted
    anew for it. Documents of size 0 are not taken."""
    found = mixed(docs, weights, shards, seed).filter("size > 0 AND draws IS NOT NULL")
    copies = found.withColumn("draw", F.explode("draws")).withColumn(
        "words", F.when(F.col("draw.rest").isNull(), F.col("size")).otherwise(F.col("part"))
    )
    bare = F.btrim(F.col("row.text"), F.lit(" \t\n\x0b\x0c\r"))
    leading = F.array_join(F.slice(F.split(bare, "[\\x20\\x09-\\x0D]+"), 1, F.col("words").cast("int")), " ")
    text = F.when(F.col("words") < F.col("size"), leading).otherwise(F.col("row.text"))
    dealt = (
        copies.filter("words > 0")
        .withColumn("text", text)
        .select("row", "text", (F.col("words") < F.col("size")).alias("cut"), F.col("draw.shard").alias("shard"),
                _hash(seed + 1, F.col("draw.epoch"), F.col("place")).alias("turn"))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "turn")
    )
    columns = []
    for name in docs.columns:
        value = F.col(f"row.`{name}`")
        if name == "text":
            value = F.col("text")
        elif name == "n_chars":
            value = F.when(F.col("cut"), F.length("text").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return dealt.select(*columns)
