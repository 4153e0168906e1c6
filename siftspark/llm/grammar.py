"""Weighted finite-state transducers over a clause's tokens, and their composition.

A machine is a table (state, symbol) -> (state, symbol, weight); symbols it has no row for
pass unchanged with weight 0. `compose` feeds one machine's output to the next and gives
one table over the reachable pairs of states, so a clause is read once whatever the number of parts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

OTHER, INSULT, TARGET, NEGATION, REPORT, HARM = "other", "insult", "target", "not", "report", "harm"
DENIED, QUOTED, BOTH, THREAT, AIMED = "denied", "quoted", "denied quoted", "threat", "aimed"
SYMBOLS = (OTHER, INSULT, TARGET, NEGATION, REPORT, HARM)
INSULTS = (INSULT, DENIED, QUOTED, BOTH)


@dataclass
class Machine:
    start: object = 0
    moves: dict = field(default_factory=dict)

    def step(self, state, symbol: str) -> tuple[object, str, float]:
        return self.moves.get((state, symbol)) or (state, symbol, 0.0)


def compose(first: Machine, second: Machine, symbols: tuple[str, ...] = SYMBOLS) -> Machine:
    whole = Machine((first.start, second.start))
    todo, seen = [whole.start], {whole.start}
    while todo:
        pair = todo.pop()
        for symbol in symbols:
            a, middle, weight = first.step(pair[0], symbol)
            b, out, more = second.step(pair[1], middle)
            whole.moves[pair, symbol] = ((a, b), out, weight + more)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return whole


def negation(reach: int = 2) -> Machine:
    """An insult among the `reach` tokens after a negation is denied."""
    machine = Machine()
    for left in range(reach + 1):
        after = max(left - 1, 0)
        for symbol in SYMBOLS:
            denied = symbol == INSULT and left > 0
            machine.moves[left, symbol] = (after, DENIED if denied else symbol, 0.0)
        machine.moves[left, NEGATION] = (reach, NEGATION, 0.0)
    return machine


def reported_speech() -> Machine:
    """An insult after a verb of saying is quoted, up to the end of its clause."""
    machine = Machine()
    machine.moves[0, REPORT] = (1, REPORT, 0.0)
    machine.moves[1, INSULT] = (1, QUOTED, 0.0)
    machine.moves[1, DENIED] = (1, BOTH, 0.0)
    return machine


def threat(reach: int = 3, weight: float = 4.0) -> Machine:
    """A verb of harm with a person among the next `reach` tokens is a threat."""
    machine = Machine()
    for left in range(reach + 1):
        after = max(left - 1, 0)
        for symbol in (*SYMBOLS, *INSULTS):
            machine.moves[left, symbol] = (after, symbol, 0.0)
        machine.moves[left, HARM] = (reach, HARM, 0.0)
        if left:
            machine.moves[left, TARGET] = (0, THREAT, weight)
    return machine


def aim(weight: float = 0.5) -> Machine:
    """A person and an insult in one clause, in either order, weigh more, once a clause."""
    machine = Machine("none")
    for insult in INSULTS:
        machine.moves["none", insult] = ("insult", insult, 0.0)
        machine.moves["person", insult] = ("both", insult, weight)
    for person in (TARGET, THREAT):
        machine.moves["none", person] = ("person", person, 0.0)
        machine.moves["insult", person] = ("both", AIMED, weight)
    return machine


def clause_machine() -> Machine:
    machine = negation()
    for part in (reported_speech(), threat(), aim()):
        machine = compose(machine, part)
    return machine
