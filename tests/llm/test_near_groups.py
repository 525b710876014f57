"""Groups of near copies: each member meets the hub once, and only the rest more."""

import collections

from spoor.llm import near


def variants(n, length=300, step=1):
    """Texts that differ from the first in one word each, or step by step from the last."""
    base = [f"w{k}" for k in range(length)]
    return [" ".join(f"x{i}" if k == (i * 7) % length and i else w for k, w in enumerate(base)) for i in range(n)]


def star_of(spark, texts):
    found = near.shingle_sets([t.encode() for t in texts])
    nodes = [near._digest(s) for s in found]
    sets = spark.createDataFrame([(n, s.tobytes()) for n, s in zip(nodes, found)], "node binary, shingles binary")
    star = spark.createDataFrame([(nodes[0], n) for n in nodes], "hub binary, node binary")
    return star, sets, nodes, found


def test_near_copies_meet_their_hub_once(spark, monkeypatch):
    monkeypatch.setattr(near, "GROUP_BYTES", 1 << 16)
    star, sets, nodes, _ = star_of(spark, variants(1000))
    sized = star.join(sets.selectExpr("node", "CAST(length(shingles) AS BIGINT) AS size"), "node")
    first = near._hub_tasks(sized, sets)
    blocks = first.select("block").distinct().count()
    assert blocks > 20 and first.count() == 999 + blocks
    met = first.groupBy("hub", "block").applyInPandas(near._meet_hub(85), "hub binary, node binary, met boolean")
    assert met.count() == met.filter("met").count() == 999
    rest = near._rest_tasks(met, sized, sets)
    assert rest.count() == 0 and first.count() + rest.count() <= 3 * 1000
    assert near._links(star, sets, 85).count() == 999


def test_members_apart_from_the_hub_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(near, "GROUP_BYTES", 1 << 13)
    # A chain: neighbours are linked, the hub only with its own.
    words, texts = [f"w{k}" for k in range(300)], []
    for step in range(60):
        words = [f"s{step}" if k == (step * 53) % 300 or k == (step * 97 + 1) % 300 else w for k, w in enumerate(words)]
        texts.append(" ".join(words))
    star, sets, nodes, found = star_of(spark, texts)
    number = {bytes(n): k for k, n in enumerate(nodes)}
    links = [(number[bytes(r.a)], number[bytes(r.b)]) for r in near._links(star, sets, 85).collect()]
    assert all(near.linked(found[a], found[b], 85) for a, b in links)

    def classes(pairs):
        parent = list(range(len(nodes)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = collections.defaultdict(set)
        for x in range(len(nodes)):
            groups[root(x)].add(x)
        return sorted(map(sorted, groups.values()))

    whole = [(a, b) for a in range(len(nodes)) for b in range(a) if near.linked(found[a], found[b], 85)]
    direct = {0, *(a for a, b in whole if b == 0)}
    assert len(direct) < 30 and classes(links) == classes(whole)
