"""The order in which tables that refer to each other are changed."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from graphlib import CycleError, TopologicalSorter


def parents_first(names: Collection[str], edges: Iterable[tuple[str, str]]) -> list[list[str]]:
    """Groups of tables, each after those it refers to; edges: (child, parent).  Tables of a cycle are one group, sorted by name; edges from
    or to other tables, and of a table with itself, do not count."""
    edges = [(c, p) for c, p in edges if c in names and p in names and c != p]
    group = {n: frozenset([n]) for n in sorted(names)}
    while True:
        graph: dict[frozenset, set] = {g: set() for g in group.values()}
        for c, p in edges:
            graph[group[c]] |= {group[p]} - {group[c]}
        try:
            return [sorted(g) for g in TopologicalSorter(graph).static_order()]
        except CycleError as e:
            merged = frozenset().union(*e.args[1])
            group |= dict.fromkeys(merged, merged)


def linked(names: Collection[str], edges: Iterable[tuple[str, str]]) -> list[list[str]]:
    """Tables that refer to each other, directly or by others, in one list each, in the order of names."""
    part = {n: [n] for n in names}
    for c, p in edges:
        if c in part and p in part and part[c] is not part[p]:
            part[c] += part[p]
            for n in part[p]:
                part[n] = part[c]
    seen: dict[int, list[str]] = {id(x): x for x in part.values()}
    return [sorted(x, key=list(names).index) for x in seen.values()]
