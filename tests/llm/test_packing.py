from __future__ import annotations

import random

from quire.llm import packing


def test_fullest_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 12): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(0, 40)
        use = packing.fullest(room, dict(counts))
        best = {0}
        for x, n in counts.items():
            best = {b + k * x for b in best for k in range(n + 1) if b + k * x <= room}
        assert sum(x * k for x, k in use.items()) == max(best)
        assert all(k <= counts[x] for x, k in use.items())


def check(rows, sizes, capacity):
    back, room = {}, {}
    for key, piece, size, container in rows:
        back.setdefault(key, []).append((piece, size))
        room[container] = room.get(container, 0) + size
    assert set(back) == set(sizes)
    for key, parts in back.items():
        parts.sort()
        assert sum(s for _, s in parts) == sizes[key] and [p for p, _ in parts] == list(range(len(parts)))
        assert len(parts) == 1 or sizes[key] > capacity
    assert max(room.values(), default=0) <= capacity
    return room


def test_whole_and_tight(spark):
    rng = random.Random(7)
    sizes = {i: rng.choice([0, 7, 7, 7, rng.randrange(1, 100), rng.randrange(100, 350)]) for i in range(1500)}
    df = spark.createDataFrame(list(sizes.items()), "id long, n int")
    rows = [tuple(r) for r in packing.pack(df, "id", "n", capacity=100, rank_rows=50).collect()]
    room = check(rows, sizes, 100)
    assert len(room) <= -(-sum(sizes.values()) // 100) + 2


def test_only_empty_items_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id long, n int")
    assert {(r.id, r.container) for r in packing.pack(df, "id", "n", 10).collect()} == {(1, 0), (2, 0)}
    assert packing.pack(df.limit(0), "id", "n", 10).count() == 0
