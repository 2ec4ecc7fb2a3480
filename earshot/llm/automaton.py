"""Rule regexes compiled to minimal deterministic automata over bytes.

A rule's syntax tree (from the standard ``re`` parser) becomes a nondeterministic automaton;
subset construction over byte classes and partition refinement turn it into transition
arrays. Rules may use literals, classes, ``|``, groups, greedy repeats and ``(?i:...)``,
all in ASCII.
"""

from __future__ import annotations

import re
from itertools import accumulate, compress, count
from operator import getitem, itemgetter

ALL_BYTES = (1 << 256) - 1
_LAST = itemgetter(-1)


def _category(cat) -> int:
    name = str(cat)
    ranges = {"DIGIT": "0123456789", "SPACE": " \t\n\r\f\v",
              "WORD": "".join(map(chr, [*range(48, 58), *range(65, 91), 95, *range(97, 123)]))}
    for key, chars in ranges.items():
        if name.endswith(key):
            mask = sum(1 << ord(c) for c in chars)
            return ALL_BYTES & ~mask if "NOT" in name else mask
    raise ValueError(f"unsupported class {name}")


def _mask(items, flags: int) -> int:
    mask, negate = 0, False
    for op, arg in items:
        op = str(op)
        if op == "NEGATE":
            negate = True
        elif op == "LITERAL":
            mask |= 1 << arg
        elif op == "RANGE":
            mask |= sum(1 << b for b in range(arg[0], arg[1] + 1))
        elif op == "CATEGORY":
            mask |= _category(arg)
        else:
            raise ValueError(f"unsupported in a class: {op}")
    if flags & re.IGNORECASE:
        for b in range(65, 91):
            pair = (1 << b) | (1 << (b + 32))
            if mask & pair:
                mask |= pair
    return ALL_BYTES & ~mask if negate else mask


class Nfa:
    """Thompson automaton: ``eps[s]`` and ``move[s]`` (byte mask, target)."""

    def __init__(self) -> None:
        self.eps: list[list[int]] = []
        self.move: list[list[tuple[int, int]]] = []
        self.accept: dict[int, int] = {}

    def state(self) -> int:
        self.eps.append([])
        self.move.append([])
        return len(self.eps) - 1

    def add(self, tree, at: int, flags: int, backwards: bool) -> int:
        """Append ``tree`` (a sequence of parsed nodes) behind state ``at``; its end state."""
        for op, arg in reversed(list(tree)) if backwards else tree:
            op = str(op)
            if op in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
                items = {"LITERAL": lambda: [("LITERAL", arg)], "IN": lambda: arg,
                         "NOT_LITERAL": lambda: [("NEGATE", None), ("LITERAL", arg)],
                         "ANY": lambda: [("NEGATE", None), ("LITERAL", 10)]}[op]()
                end = self.state()
                self.move[at].append((_mask(items, flags), end))
                at = end
            elif op == "SUBPATTERN":
                _, on, off, inner = arg
                at = self.add(inner, at, (flags | on) & ~off, backwards)
            elif op == "BRANCH":
                end = self.state()
                for part in arg[1]:
                    start = self.state()
                    self.eps[at].append(start)
                    self.eps[self.add(part, start, flags, backwards)].append(end)
                at = end
            elif op == "MAX_REPEAT":
                least, most, inner = arg
                for _ in range(least):
                    at = self.add(inner, at, flags, backwards)
                if str(most) == "MAXREPEAT":
                    loop, start = self.state(), self.state()
                    self.eps[at].append(loop)
                    self.eps[loop].append(start)
                    self.eps[self.add(inner, start, flags, backwards)].append(loop)
                    at = loop
                else:
                    end = self.state()
                    self.eps[at].append(end)
                    for _ in range(most - least):
                        at = self.add(inner, at, flags, backwards)
                        self.eps[at].append(end)
                    at = end
            else:
                raise ValueError(f"unsupported in a rule: {op}")
        return at


def compiled(patterns: list[str], *, anywhere: bool, backwards: bool = False, detect: bool = False) -> dict:
    """Minimal automaton of all ``patterns`` at once.

    ``anywhere``: it looks for matches from every position on; otherwise only for those that
    begin where it begins. ``backwards``: it reads the text from its end. ``detect``: where a pattern
    is accepted, its matches are followed no further, which keeps the automaton small. Returns ``classes``
    (256 bytes: byte -> class), ``next`` (a row of target states per state), ``accept`` (bit
    mask of patterns per state); state 0 is the start.
    """
    nfa = Nfa()
    root = nfa.state()
    if anywhere:
        nfa.move[root].append((ALL_BYTES, root))
    owner = [0]                               # by state: the bit of its pattern
    for i, p in enumerate(patterns):
        parsed = re._parser.parse(p)
        start = nfa.state()
        nfa.eps[root].append(start)
        nfa.accept[nfa.add(parsed, start, parsed.state.flags, backwards)] = 1 << i
        owner += [1 << i] * (len(nfa.eps) - len(owner))
    masks = sorted({m for moves in nfa.move for m, _ in moves})
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(m >> b & 1 for m in masks), len(kinds)) for b in range(256))
    sample = [classes.index(c) for c in range(len(kinds))]

    def closed(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            s = todo.pop()
            for t in () if detect and s in nfa.accept else nfa.eps[s]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        over = sum({nfa.accept[s] for s in seen if s in nfa.accept}) if detect else 0
        return frozenset(s for s in seen if s in nfa.accept or nfa.move[s] and not owner[s] & over)

    first = closed({root})
    number, rows, accept, todo = {first: 0}, [], [], [first]
    for subset in todo:                       # grows while it is read
        accept.append(sum({nfa.accept[s] for s in subset if s in nfa.accept}))
        row = []
        for b in sample:
            target = closed({t for s in subset if not (detect and s in nfa.accept)
                             for m, t in nfa.move[s] if m >> b & 1})
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    block, blocks = list(accept), -1          # partition refinement until nothing splits
    while len(set(block)) != blocks:
        blocks, ids = len(set(block)), {}
        block = [ids.setdefault((block[s], *(block[t] for t in rows[s])), len(ids)) for s in range(len(rows))]
    some = {b: s for s, b in reversed(list(enumerate(block)))}
    return {"classes": classes, "next": [[block[t] for t in rows[some[b]]] for b in range(blocks)],
            "accept": [accept[some[b]] for b in range(blocks)]}


class Automaton:
    """Runs a compiled automaton. Each state is a list: its successors by byte class, then its
    accept mask, so that ``accumulate(..., getitem)`` walks a text without Python code per byte."""

    def __init__(self, tables: dict) -> None:
        self.classes = tables["classes"]
        states: list[list] = [[] for _ in tables["next"]]
        for s, row, mask in zip(states, tables["next"], tables["accept"], strict=True):
            s.extend(states[t] for t in row)
            s.append(mask)
        self.start = states[0]
        self.dead = next((s for s in states if not s[-1] and all(t is s for t in s[:-1])), None)

    def accepts(self, data: bytes) -> list[int]:
        """Offsets (bytes read so far) at which some pattern accepts."""
        walk = accumulate(data.translate(self.classes), getitem, initial=self.start)
        return list(compress(count(), map(_LAST, walk)))

    def masks(self, data: bytes) -> int:
        """All patterns that accept somewhere."""
        out = 0
        for m in set(map(_LAST, accumulate(data.translate(self.classes), getitem, initial=self.start))):
            out |= m
        return out

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at`` (``at`` if none)."""
        state, end, classes, dead = self.start, at, self.classes, self.dead
        for i in range(at, len(data)):
            state = state[classes[data[i]]]
            if state is dead:
                break
            if state[-1]:
                end = i + 1
        return end


class RuleScanner:
    """Spans of all rules. One forward pass of the combined automaton over a text's bytes tells
    which rules match at all; only for those, a backward pass of the rule's own automaton marks
    every start, and from the leftmost free start the longest match is taken."""

    def __init__(self, tables: dict) -> None:
        self.names = tables["names"]
        self.all = Automaton(tables["all"])
        self.begin = [Automaton(t) for t in tables["starts"]]
        self.whole = [Automaton(t) for t in tables["whole"]]

    @staticmethod
    def tables(rules: list[tuple[str, str]]) -> dict:
        patterns = [p for _, p in rules]
        return {"names": [n for n, _ in rules], "all": compiled(patterns, anywhere=True, detect=True),
                "starts": [compiled([p], anywhere=True, backwards=True) for p in patterns],
                "whole": [compiled([p], anywhere=False) for p in patterns]}

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule number, start byte, end byte), leftmost-longest and non-overlapping per rule."""
        out: list[tuple[int, int, int]] = []
        walk = accumulate(data.translate(self.all.classes), getitem, initial=self.all.start)
        if not any(map(_LAST, walk)):
            return out
        found, n = self.all.masks(data), len(data)
        for r in range(len(self.names)):
            if found >> r & 1:
                free = 0
                for s in reversed(self.begin[r].accepts(data[::-1])):
                    if (s := n - s) >= free:
                        free = self.whole[r].longest(data, s)
                        out.append((r, s, free))
        return out
