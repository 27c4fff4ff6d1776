"""Small graphs and what their answers must be, worked out in plain Python."""

from __future__ import annotations

import random

from amity import schemas


def random_arcs(seed: int, users: int, arcs: int) -> list[tuple[int, int]]:
    """One-way and two-way friendships, repeated ones and self-friendships."""
    rng = random.Random(seed)
    rows = []
    for _ in range(arcs):
        # Squaring favours small ids, which become the crowded users.
        x = int(users * rng.random() ** 2)
        y = rng.randrange(users)
        rows.append((x, y))
        if rng.random() < 0.7:
            rows.append((y, x))
    return rows


def star_arcs(leaves: int) -> list[tuple[int, int]]:
    """User 0 and user 1 are friends of everybody, leaves also of the next leaf."""
    rows = [(0, 1), (1, 0)]
    for leaf in range(2, leaves + 2):
        for hub in (0, 1):
            rows += [(hub, leaf), (leaf, hub)]
        if leaf > 2:
            rows += [(leaf - 1, leaf), (leaf, leaf - 1)]
    return rows


def mutual(arcs) -> dict[tuple[int, int], set[int]]:
    """Mutual friends of every pair of friends."""
    lists: dict[int, set[int]] = {}
    for x, y in arcs:
        if x != y:
            lists.setdefault(x, set()).add(y)
    answer = {}
    for x, friends in lists.items():
        for y in friends:
            both = x in lists.get(y, ())
            answer[min(x, y), max(x, y)] = lists[x] & lists[y] if both else set()
    return answer


def edges(spark, arcs):
    return spark.createDataFrame(arcs, schemas.EDGES)
