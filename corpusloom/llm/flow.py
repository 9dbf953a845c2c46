"""Min-cost maximum flow on small graphs of integer capacities and costs: primal-dual with blocking flows."""

from __future__ import annotations

import heapq


class Network:
    """Arcs are kept in pairs, an arc and its reverse, so ``i ^ 1`` is the reverse of arc ``i``."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        """An arc and its number."""
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def run(self, source: int, sink: int) -> int:
        """Sends as much as goes through, at the least cost; costs of arcs are not negative."""
        n, total = len(self.out), 0
        potential = [0] * n
        while True:
            dist: list[float] = [float("inf")] * n
            dist[source] = 0
            heap = [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > dist[a]:
                    continue
                for i in self.out[a]:
                    if self.room[i] and (e := d + self.cost[i] + potential[a] - potential[self.to[i]]) < dist[self.to[i]]:
                        dist[self.to[i]] = e
                        heapq.heappush(heap, (e, self.to[i]))
            if dist[sink] == float("inf"):
                return total
            for a in range(n):
                potential[a] += int(min(dist[a], dist[sink]))
            while sent := self._block(source, sink, potential):
                total += sent

    def _block(self, source: int, sink: int, potential: list[int]) -> int:
        """One blocking flow through the arcs of no reduced cost, by levels."""
        level = {source: 0}
        front = [source]
        while front and sink not in level:
            after = []
            for a in front:
                for i in self.out[a]:
                    b = self.to[i]
                    if self.room[i] and b not in level and self.cost[i] + potential[a] == potential[b]:
                        level[b] = level[a] + 1
                        after.append(b)
            front = after
        if sink not in level:
            return 0
        at = [0] * len(self.out)
        total = 0
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                sent = min(self.room[i] for i in path)
                for i in path:
                    self.room[i] -= sent
                    self.room[i ^ 1] += sent
                total += sent
                path, a = [], source
                continue
            while at[a] < len(self.out[a]):
                i = self.out[a][at[a]]
                b = self.to[i]
                if self.room[i] and level.get(b) == level[a] + 1 and self.cost[i] + potential[a] == potential[b]:
                    break
                at[a] += 1
            if at[a] < len(self.out[a]):
                path.append(self.out[a][at[a]])
                a = self.to[path[-1]]
            elif path:
                back = path.pop()
                a = self.to[back ^ 1]
                at[a] += 1
            else:
                return total
