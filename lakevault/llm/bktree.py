"""BK-tree over 64-bit fingerprints: a child hangs on the edge of its distance to its parent.

A tree travels as three lists in insertion order: fingerprints, parents and edges.
"""

from __future__ import annotations

_MASK = (1 << 64) - 1


def build(points: list[int]) -> tuple[list[int], list[int]]:
    """Parents and edges of distinct points, inserted in their order; the first is the root."""
    parents, edges = [-1], [0]
    children: list[dict[int, int]] = [{}]
    for i in range(1, len(points)):
        point, at = points[i], 0
        while True:
            d = ((point ^ points[at]) & _MASK).bit_count()
            below = children[at].get(d)
            if below is None:
                children[at][d] = i
                break
            at = below
        parents.append(at)
        edges.append(d)
        children.append({})
    return parents, edges


class Tree:
    def __init__(self, points: list[int], parents: list[int], edges: list[int]):
        self.points = points
        self.children: list[list[tuple[int, int]]] = [[] for _ in points]
        for i in range(1, len(points)):
            self.children[parents[i]].append((edges[i], i))

    def within(self, point: int, radius: int) -> list[int]:
        """Points at most ``radius`` bits away. By the triangle inequality they lie only below
        edges that differ from the distance to their parent by at most the radius."""
        found, stack, points, children = [], [0], self.points, self.children
        while stack:
            at = stack.pop()
            d = ((point ^ points[at]) & _MASK).bit_count()
            if d <= radius:
                found.append(points[at])
            low, high = d - radius, d + radius
            stack += [i for edge, i in children[at] if low <= edge <= high]
        return found
