"""Sequential finite-state transducers over symbols, and their composition."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import NamedTuple


class Transducer(NamedTuple):
    """From a state and a symbol read to the next state and the symbol written."""

    start: Hashable
    arcs: dict[tuple[Hashable, Hashable], tuple[Hashable, Hashable]]

    def run(self, tape: Iterable[Hashable]) -> list[Hashable]:
        state, out = self.start, []
        for symbol in tape:
            state, written = self.arcs[state, symbol]
            out.append(written)
        return out

    def writes(self) -> set[Hashable]:
        return {written for _, written in self.arcs.values()}


def build(start: Hashable, alphabet: Iterable[Hashable],
          step: Callable[[Hashable, Hashable], tuple[Hashable, Hashable]]) -> Transducer:
    """The arcs of every state that can be reached from ``start``."""
    alphabet, arcs, seen, todo = list(alphabet), {}, {start}, [start]
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            arcs[state, symbol] = step(state, symbol)
            after = arcs[state, symbol][0]
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return Transducer(start, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One machine that writes what ``second`` writes when it reads what ``first`` writes."""
    def step(state, symbol):
        a, between = first.arcs[state[0], symbol]
        b, written = second.arcs[state[1], between]
        return (a, b), written

    return build((first.start, second.start), dict.fromkeys(s for _, s in first.arcs), step)


def tables(machine: Transducer, reads: list[Hashable], writes: list[Hashable]
           ) -> list[list[tuple[int, int]]]:
    """Arcs by number of state and symbol; the start is state 0."""
    states = {machine.start: 0}
    for state, _ in machine.arcs:
        states.setdefault(state, len(states))
    written = {s: i for i, s in enumerate(writes)}
    rows: list[list[tuple[int, int]]] = [[(0, 0)] * len(reads) for _ in states]
    for (state, symbol), (after, out) in machine.arcs.items():
        rows[states[state]][reads.index(symbol)] = (states[after], written[out])
    return rows
