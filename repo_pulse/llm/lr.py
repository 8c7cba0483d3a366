"""A small LR automaton and graph-structured stacks over it, for context-free role grammars.

A stack vertex is an LR state above another vertex; equal stacks are one
vertex, and stacks with a common lower part share it, so the vertices form the
graph that a generalised LR parser walks. Conflicts are followed on all sides:
``advance`` returns every vertex that reading a terminal can lead to.
"""

from __future__ import annotations

from functools import cache

END = ""  # the end of input


class Stacks:
    """productions: (left side, right side) pairs, the first one's left side is the start."""

    def __init__(self, productions: tuple[tuple[str, tuple[str, ...]], ...]):
        self.rules = productions
        self.heads = {left for left, _ in productions}
        self.states: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.vertices: dict[tuple[int, int], int] = {}
        self.of: list[tuple[int, int]] = []  # (state, vertex below) by vertex
        start = self._state(frozenset((i, 0) for i, (left, _) in enumerate(productions) if left == productions[0][0]))
        self.root = self._vertex(start, -1)
        self.advance = cache(self.advance)
        self.accepts = cache(self.accepts)

    def _state(self, kernel: frozenset) -> int:
        if kernel not in self.states:
            items, todo = set(kernel), list(kernel)
            while todo:
                rule, dot = todo.pop()
                right = self.rules[rule][1]
                if dot < len(right) and right[dot] in self.heads:
                    new = {(i, 0) for i, (left, _) in enumerate(self.rules) if left == right[dot]} - items
                    items |= new
                    todo += new
            self.states[kernel] = len(self.items)
            self.items.append(frozenset(items))
        return self.states[kernel]

    def _vertex(self, state: int, below: int) -> int:
        if (state, below) not in self.vertices:
            self.vertices[state, below] = len(self.of)
            self.of.append((state, below))
        return self.vertices[state, below]

    def _push(self, vertex: int, symbol: str) -> int | None:
        kernel = frozenset((i, dot + 1) for i, dot in self.items[self.of[vertex][0]] if dot < len(self.rules[i][1]) and self.rules[i][1][dot] == symbol)
        return self._vertex(self._state(kernel), vertex) if kernel else None

    def _reduced(self, vertex: int) -> set[int]:
        """The vertex and all that reductions make of it."""
        found, todo = {vertex}, [vertex]
        while todo:
            v = todo.pop()
            for i, dot in self.items[self.of[v][0]]:
                left, right = self.rules[i]
                if dot == len(right) and left != self.rules[0][0]:
                    base = v
                    for _ in right:
                        base = self.of[base][1]
                    new = self._push(base, left)
                    if new is not None and new not in found:
                        found.add(new)
                        todo.append(new)
        return found

    def advance(self, vertex: int, terminal: str) -> tuple[int, ...]:
        """Vertices after reading a terminal, as far as they can still read or accept."""
        after = self._push(vertex, terminal)
        if after is None:
            return ()
        return tuple(sorted(v for v in self._reduced(after) if self.accepts(v) or self._reads(v)))

    def _reads(self, vertex: int) -> bool:
        return any(dot < len(self.rules[i][1]) and self.rules[i][1][dot] not in self.heads for i, dot in self.items[self.of[vertex][0]])

    def accepts(self, vertex: int) -> bool:
        """Whether the input may end here: a rule of the start symbol is complete."""
        return any(dot == len(self.rules[i][1]) and self.rules[i][0] == self.rules[0][0] for i, dot in self.items[self.of[vertex][0]])
