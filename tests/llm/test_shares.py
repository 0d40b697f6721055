"""Mixing and sharding against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

from sievegate.llm.mixing import mix_sources
from sievegate.llm.sharding import Node, assign_shards, shard_of, shard_tree


def targets_of(sizes):
    """Targets by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        live = [s for s in order if s not in fixed]
        unit = (total - sum(fixed.values())) / max(1, sum(weights[s] for s in live))
        over = [s for s in live if unit * weights[s] >= 3 * sizes[s]]
        if not over:
            return fixed | {s: unit * weights[s] for s in live}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix_meets_targets_and_repeats(rows_of):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 50), rng.choice(["big"] * 6 + ["a", "bé", None, "z"])) for i in range(300)]
    rows += [(7, "extra words here", "a"), (7, "extra words here", "a"), (900, None, "nothing"), (901, "", "nothing"),
             (902, "one", "tiny"), (None, "no id", "a")]
    got = mix_sources(rows_of(rows)).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = targets_of(sizes), Counter()
    assert len(got) == len(rows) and sum(want.values()) == sum(sizes.values())
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    again = mix_sources(rows_of(rows, 7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = mix_sources(rows_of(rows), seed=1).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))
    assert mix_sources(rows_of(rows).limit(0)).count() == 0
    assert {r.taken for r in mix_sources(rows_of([(1, "", "s"), (2, None, None)])).collect()} == {0}


def test_shards_follow_the_law(rows_of):
    rows = [(i, f"text é {i % 900}") for i in range(4000)] + [(5, None), (5, ""), (5, ""), (None, "x")]
    got = assign_shards(rows_of(rows)).collect()
    assert len(got) == len(rows)
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert set(slots) == set(range(8)) and all(len(v) == 1 for v in by_id.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(400 < len(v) < 600 for v in slots.values())
    assert 350 < sum(r.grown_shard == 8 for r in got) < 550
    assert assign_shards(rows_of(rows).limit(0)).count() == 0


def test_weights_move_only_what_they_must(spark):
    def placed(heavy):
        inner = Node("a", (Node("a1", shard=0, own_weight=heavy), Node("a2", shard=1)))
        tree = Node("root", (inner, Node("b", (Node("b1", shard=2), Node("b2", shard=3)))))
        frame = spark.range(20_000)
        return [r[0] for r in frame.select(shard_of(tree, frame.id)).collect()]

    light, heavy = placed(1.0), placed(4.0)
    assert abs(Counter(heavy)[0] / 20_000 - 4 / 7) < 0.02
    moved = {(x, y) for x, y in zip(light, heavy, strict=True) if x != y}
    assert moved and not moved & {(2, 3), (3, 2)} and all(y in (0, 1) for _, y in moved)
    assert shard_tree(3).weight == 3 and len(shard_tree(9).children) == 3
