"""Suffix arrays by linear grouping construction (Baier, 2016)."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of a text of small non-negative integers, in ascending order.

    Phase 1 puts suffixes into groups by their Lyndon prefix.  Groups are taken from the highest to
    the lowest.  When one is taken, each of its members points to the nearest position before it
    that still is in a lower group, its previous smaller suffix; the prefix of that position grows
    by the group's, so it moves to a new group just above its old one (further above, if the
    group's prefix follows it several times).  Phase 2 goes through the suffixes in ascending order
    and puts the chain of pointers from the position before each to the next places of their
    groups.  Neither phase renames the text or recurses.  An empty text gives an empty list.
    """
    group = list(text)
    n = len(group)
    if not n:
        return []
    members: list[list[int]] = [[] for _ in range(max(group) + 1)]
    for i, symbol in enumerate(group):
        members[symbol].append(i)
    below = [-1] * len(members)
    above = [-1] * len(members)
    present = [g for g, m in enumerate(members) if m]
    for low, high in zip(present, present[1:], strict=False):
        below[high], above[low] = low, high

    taken = bytearray(n)
    smaller = [-1] * n
    descending: list[int] = []
    current = present[-1]
    while current >= 0:
        own = members[current]
        for i in own:
            taken[i] = 1
        follows: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and taken[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                follows[j] = follows.get(j, 0) + 1
        grown: dict[int, list[tuple[int, int]]] = {}
        for j, times in follows.items():
            grown.setdefault(group[j], []).append((times, j))
        for old, moves in grown.items():
            _split(old, moves, members, group, below, above)
        descending.append(current)
        current = below[current]

    place = [0] * len(members)
    total = 0
    for g in reversed(descending):
        place[g] = total
        total += len(members[g])
    order = [-1] * n
    placed = bytearray(n)

    def put_chain(j: int) -> None:
        while j >= 0 and not placed[j]:
            g = group[j]
            order[place[g]] = j
            place[g] += 1
            placed[j] = 1
            j = smaller[j]

    put_chain(n - 1)
    for k in range(n):
        put_chain(order[k] - 1)
    return order


def _split(old: int, moves: list[tuple[int, int]], members: list[list[int]], group: list[int],
           below: list[int], above: list[int]) -> None:
    """Move positions from group ``old`` to new groups right above it, by how often they grew."""
    held = members[old]
    moves.sort()
    if len(moves) < len(held):
        gone = {j for _, j in moves}
        members[old] = [j for j in held if j not in gone]
        emptied = False
    else:
        emptied = True
    at, start = old, 0
    while start < len(moves):
        times, end = moves[start][0], start
        while end < len(moves) and moves[end][0] == times:
            end += 1
        block = [j for _, j in moves[start:end]]
        start = end
        if emptied:  # the least of them keep the place of the emptied group
            members[old] = block
            emptied = False
            continue
        new, up = len(members), above[at]
        members.append(block)
        for j in block:
            group[j] = new
        above.append(up)
        below.append(at)
        above[at] = new
        if up >= 0:
            below[up] = new
        at = new
